"""Importance resampling of documents towards a target corpus, by hashed n-gram features.

Each task takes its texts a slice at a time and builds a suffix array over the slice's word ids, sorted as deep as the
longest feature (rank doubling, so log2(max_n) sorts). Suffixes that share their first n words stand together: where the
common prefix (LCP) of neighbours falls below n a new run of equal n-grams begins. A run is hashed once, and its bucket
is scattered back to all its occurrences. A document then is a list of bucket numbers, written once to the shared
folder; what follows (bucket counts, weights, scores) reads that table and no text.

Bucket counts leave a task as one row per bucket it met. The driver sees one number per bucket of each corpus, `buckets`
at most, and the gains made of them are the only thing sent to tasks. The draw ranks scores through a range partitioning
with counts per partition, so no task holds all of them, however large the draw.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import materialize, shuffle_partitions

SLICE_BYTES = 4 << 20  # of text in one suffix array

# fixed values: bytes that make words, upper case lowered; all others part words
_WORD = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TABLE = bytes(b if b in _WORD else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def suffix_runs(ids: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of word ids and the LCP of each suffix with the one before it, both to `depth` words.

    ends: for each position the end of its text, which no suffix crosses. Equal suffixes stand in order of position.
    """
    n, at = len(ids), np.arange(len(ids))
    rank, sorted_to = ids.astype(np.int64), 1
    while sorted_to < depth:
        ahead = at + sorted_to
        follow = np.where(ahead < ends, rank[np.minimum(ahead, n - 1)] + 1, 0)
        rank = np.unique(rank * (int(rank.max(initial=0)) + 2) + follow, return_inverse=True)[1]
        sorted_to *= 2
    suffixes = np.argsort(rank, kind="stable")
    lcp, alive = np.zeros(n, np.int64), np.ones(max(n - 1, 0), bool)
    for k in range(depth):
        a, b = suffixes[1:] + k, suffixes[:-1] + k
        alive &= (a < ends[suffixes[1:]]) & (b < ends[suffixes[:-1]])
        alive &= ids[np.minimum(a, n - 1)] == ids[np.minimum(b, n - 1)]
        lcp[1:] += alive
    return suffixes, lcp


def slice_buckets(texts: list[list[bytes]], fresh: list[int], max_n: int, buckets: int) -> list[np.ndarray]:
    """Of each list of words the buckets of its n-grams of 1 to max_n words, of those only that reach beyond its first `fresh` words."""
    sizes = np.array([len(t) for t in texts])
    stops = np.cumsum(sizes)
    words = list(itertools.chain.from_iterable(texts))
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    ends, begins = np.repeat(stops, sizes), np.repeat(stops - sizes + np.array(fresh, np.int64), sizes)
    suffixes, lcp = suffix_runs(ids, ends, max_n)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for n in range(1, max_n + 1):
        run = np.cumsum(lcp < n) - 1
        firsts = suffixes[lcp < n]
        whole = firsts + n <= ends[firsts]
        hashed = np.zeros(len(firsts), np.int64)
        hashed[whole] = [zlib.crc32(b" ".join(words[i : i + n])) % buckets for i in firsts[whole].tolist()]
        scattered = np.empty(len(ids), np.int64)
        scattered[suffixes] = hashed[run]
        at = np.arange(len(ids))
        taken = (at + n <= ends) & (at + n > begins)
        for k, (a, b) in enumerate(itertools.pairwise([0, *stops.tolist()])):
            out[k].append(scattered[a:b][taken[a:b]])
    return [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]


def _pieces(text: str, max_n: int):
    """The words of a text in pieces of some SLICE_BYTES, each with the max_n - 1 words before it and how many these are."""
    data = text.encode().translate(_TABLE)
    at, tail = 0, []
    while True:
        cut = len(data) if len(data) - at <= SLICE_BYTES else data.rfind(b" ", at, at + SLICE_BYTES)
        cut = data.find(b" ", at + SLICE_BYTES) if cut < at else cut  # one word longer than a piece
        cut = len(data) if cut < at else cut
        words = tail + data[at:cut].split()
        yield words, len(tail), cut - at
        if cut >= len(data):
            return
        at, tail = cut + 1, words[len(words) - min(len(words), max_n - 1) :]


def _features(max_n: int, buckets: int):
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        def flush():
            found: list[list[np.ndarray]] = [[] for _ in docs]
            for k, bs in zip(owner, slice_buckets(texts, fresh, max_n, buckets)):
                found[k].append(bs.astype(kind))
            return found

        for b in batches:
            docs: list = []
            parts: list[list[np.ndarray]] = []  # of docs, from slices flushed before
            n_words: list[int] = []
            texts, fresh, owner, size, held = [], [], [], 0, 0

            def batch():
                joined = [np.concatenate(p) if p else np.zeros(0, kind) for p in parts]
                cols = [pa.array(docs, b.column("doc_id").type), pa.array(n_words, pa.int64()), pa.array([len(j) for j in joined], pa.int64()), pa.array([j.tobytes() for j in joined], pa.binary())]
                return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_words", "n_features", "buckets"])

            for doc, text in zip(b.column("doc_id"), b.column("text")):
                docs.append(doc.as_py())
                parts.append([])
                n_words.append(0)
                for words, carried, taken in _pieces(text.as_py() or "", max_n):
                    n_words[-1] += len(words) - carried
                    texts.append(words)
                    fresh.append(carried)
                    owner.append(len(docs) - 1)
                    size += taken
                    if size >= SLICE_BYTES:
                        for p, f in zip(parts, flush()):
                            p.extend(f)
                        held += size
                        texts, fresh, owner, size = [], [], [], 0
                if held >= 4 * SLICE_BYTES and not texts:
                    yield batch()
                    docs, parts, n_words, held = [], [], [], 0
            if texts:
                for p, f in zip(parts, flush()):
                    p.extend(f)
            if docs:
                yield batch()

    return run


def ngram_buckets(docs: DataFrame, *, max_n: int = 1, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, buckets (binary: the bucket of every n-gram occurrence, as
    little-endian unsigned 16-bit numbers, 32-bit beyond 65,536 buckets).

    Words are runs of digits, a-z (A-Z lowered) and all characters beyond ASCII; a feature is a run of 1 to max_n of
    them joined by one space, its bucket the crc32 of its bytes modulo `buckets`. Null and wordless texts have no
    features. Texts beyond SLICE_BYTES are read in pieces that carry max_n - 1 words over. Other columns are ignored,
    repeated rows count each, an empty table gives no rows.
    """
    if max_n < 1 or buckets < 1:
        raise ValueError("max_n and buckets must be positive")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_features(max_n, buckets), f"doc_id {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs in a table of ngram_buckets: counted per task, then summed; `buckets` numbers on the driver."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for v in b.column("buckets"):
                total += np.bincount(np.frombuffer(v.as_py(), kind), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in features.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        out[r.bucket] = r.n
    return out


def bucket_gains(target: np.ndarray, raw: np.ndarray) -> list[int]:
    """1,000 times the log of each bucket's share in the target over its share in the raw corpus, both smoothed by one, rounded down."""
    b, t_all, s_all = float(len(raw)), float(target.sum()), float(raw.sum())
    return [math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for t, s in zip(target.tolist(), raw.tolist())]


def _weighed(gains: list[int], kind: str):
    table = np.array(gains, np.int64)

    def run(batches):
        for b in batches:
            sums = [int(table[np.frombuffer(v.as_py(), kind)].sum()) for v in b.column("buckets")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("n_words"), b.column("n_features"), pa.array(sums, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def gumbel(doc_id: Column, seed: int) -> Column:
    """1,000 times a standard Gumbel number made of the seed and the id, rounded down; a null id counts as an empty string."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def importance_resample(docs: DataFrame, target: DataFrame, *, max_n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: int = 2024, id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_words, n_features, weight, score, rank.

    docs: id_col, text; target: text. weight is the sum of the gains of a document's features (see bucket_gains), score
    adds Gumbel noise, so the highest scores are a sample without replacement by importance. Of the N documents with
    at least min_words words the floor(percent * N / 100) highest scores are drawn; rank numbers them from 1, ties to the
    smaller id (null first), equal rows in any order; rank is null for all others.

    Null texts have no features and weight 0. Repeated rows are documents of their own. Other columns are ignored. An
    empty target makes all gains those of no occurrence; an empty docs gives no rows.
    """
    spark, kind = docs.sparkSession, "<u2" if buckets <= 1 << 16 else "<u4"
    features = materialize(ngram_buckets(docs, max_n=max_n, buckets=buckets, id_col=id_col), "importance-buckets")
    raw = bucket_counts(features, buckets)
    wanted = bucket_counts(ngram_buckets(target.select(F.lit(0).alias("id"), "text"), max_n=max_n, buckets=buckets, id_col="id"), buckets)
    id_kind = features.schema["doc_id"].dataType.simpleString()
    weighed = features.mapInArrow(_weighed(bucket_gains(wanted, raw), kind), f"doc_id {id_kind}, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)).withColumn("uid", F.monotonically_increasing_id())
    able = F.col("n_words") >= min_words
    order = [F.col("able").desc(), F.col("score").desc(), F.col("doc_id"), F.col("uid")]
    placed = scored.withColumn("able", able).repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).drop("uid")
    placed = materialize(placed.withColumn("place", F.monotonically_increasing_id()), "importance-order")

    part = F.shiftright("place", 33).cast("int")
    counts = {r.part: r.n for r in placed.where("able").groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    drawn = sum(counts.values()) * percent // 100
    parts = sorted(counts)
    before = dict(zip(parts, itertools.accumulate([0, *(counts[p] for p in parts)])))
    offsets = spark.createDataFrame([(p, before[p]) for p in parts], "part int, before long")
    ranked = placed.withColumn("part", part).join(F.broadcast(offsets), "part", "left")
    rank = F.col("before") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("able") & (rank <= drawn), rank).alias("rank"))
