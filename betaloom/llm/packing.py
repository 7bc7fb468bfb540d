"""Packing documents into sequences by a plan made over the length histogram.

A document becomes pieces of at most `capacity` tokens, the first one holding what is left over, so all others are
full. Scan tasks tokenise and number their pieces within each length. The histogram of lengths (`capacity` counts at
most) goes to the driver, which packs counts instead of documents by best fit in decreasing length: a run of the plan
says that the pieces of one length with ranks lo..hi-1 go to consecutive sequences, so many in each, from one offset.
Pieces find their run by length and rank; a rank is the number within the task plus the counts of the tasks before.
"""

from __future__ import annotations

import functools
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encode_text, encoder
from .store import materialize

# In texts of these characters alone both tokenizer libraries split alike (tests hold them against each other).
_PLAIN = re.compile("[\x00-ɏ‐-‧€]*")


@functools.lru_cache(maxsize=2)
def _json_tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def token_ids(text: str, json_path: str, ranks_path: str | None, pattern: str | None) -> np.ndarray:
    """The ids of the tokenizer file at json_path. The rank file of the same vocabulary, if given, serves plain texts faster."""
    if ranks_path and "<|" not in text and _PLAIN.fullmatch(text):
        return encode_text(encoder(ranks_path, pattern), text)
    return np.array(_json_tokenizer(json_path).encode(text, add_special_tokens=False).ids, dtype="<u4")


def _pieces(json_path, ranks_path, pattern, end_id, capacity, keep_ids):
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "pid", "rank", "ids")

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        pid, met = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            rows = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = np.append(token_ids(text.as_py() or "", json_path, ranks_path, pattern), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    raw, length = ids[lo:hi].tobytes(), hi - lo
                    rows.append((doc, piece, lo, length, zlib.crc32(raw), pid, int(met[length]), raw if keep_ids else None))
                    met[length] += 1
                    if len(rows) >= 20_000:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    return run


def plan_best_fit(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit decreasing over counts. Returns runs (length, lo, hi, first sequence, pieces in each, offset) and the number of sequences.

    Sequences of equal room are handled as one group, so work and plan grow with the number of lengths, not documents.
    """
    runs, sequences = [], 0
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in room:
                room[left] = []
                insort(rooms, left)
            room[left].append((first, n))

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        rank, count = 0, histogram[length]
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, n = capacity, sequences, -(-count // (capacity // length))
                sequences += n
            each = left // length
            filled = min(n, count // each)
            if not filled:  # fewer are left than one sequence takes
                each, filled = count, 1
            put(left, first + filled, n - filled)
            runs.append((length, rank, rank + filled * each, first, each, capacity - left))
            put(left - each * length, first, filled)
            rank, count = rank + filled * each, count - filled * each
    return runs, sequences


def pack_documents(docs: DataFrame, json_path: str, *, ranks_path: str | None = None, pattern: str | None = None, end_id: int = 2, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and with keep_ids the ids (little-endian 32-bit).

    A null text counts as empty: one piece of the end id alone. Repeated rows are packed each; equal lengths are
    interchangeable. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, rank long, ids binary"
    pieces = materialize(rows.mapInArrow(_pieces(json_path, ranks_path, pattern, end_id, capacity, keep_ids), schema), "pack-pieces")
    counts = pieces.groupBy("length", "pid").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # capacity rows at most
    runs, _ = plan_best_fit(histogram, capacity)
    plan = spark.createDataFrame(runs, "length long, lo long, hi long, first long, each long, at long")  # grows with capacity only
    earlier = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "pid", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = pieces.join(counts, ["length", "pid"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(F.broadcast(plan), "length").where("rank >= lo and rank < hi")
    out = placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("first + (rank - lo) div each").alias("sequence_id"),
        (F.col("at") + F.expr("(rank - lo) % each") * F.col("length")).alias("offset"),
        "ids",
    )
    return out if keep_ids else out.drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence of packed documents (with keep_ids): sequence_id, length and ids in order of offset. An empty table gives no rows."""
    parts = packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    return parts.select("sequence_id", "length", F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"))
