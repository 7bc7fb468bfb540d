"""Exact de-duplication through an extendible-hash index kept on shared files.

1. Scan tasks fold their own rows: equal normalised texts of one task become one entry (key, text, ids). A text that
   fills a third of the table thus becomes a few entries, one per task and flush.
2. Keys are counted without texts; only entries whose key others share too ship theirs. Entries of a key of very many
   are folded once more by (key, salt), so the text of a hot group moves once per salt.
3. The entries' key prefixes are counted (some 16 counts per bucket, 2**max_depth at most, reach the driver) and a
   directory over the key's leading bits is grown by doubling: buckets over capacity split until they fit or max_depth is reached.
4. Contiguous key ranges of buckets go to owner tasks. An owner chains entries of one key, compares their bytes, and
   writes each entry's class to the index on shared files.
5. Entries look up their class by entry number and hand it to their rows.

With index_path, directory and buckets stay there, one text per class, and lookup() holds other tables against them.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import run_groups
from .store import materialize, shuffle_partitions

ENTRY = "entry long, key long, sha string, text binary, doc_ids array<long>, min_id long, min_pos int, n long"
CLASS = "entry long, bucket int, key long, chain int, keep_id long, group_size long, winner boolean"


def _fold(key_bits: int, flush_bytes: int):
    """Entries of one task's rows. Memory: flush_bytes of distinct texts and of ids, then the entries so far are handed on."""

    def run(batches):
        serial = TaskContext.get().partitionId() << 33
        held: dict[bytes, list] = {}
        held_bytes = 0

        def entries():
            nonlocal serial
            cols = [[] for _ in range(8)]
            for text, ids in held.items():
                digest = hashlib.sha256(text).digest()
                key = int.from_bytes(digest[:8], "big") >> (64 - key_bits) << (64 - key_bits)
                known = [i for i in ids if i is not None]
                low = min(known) if known else None
                for c, v in zip(cols, (serial, key - (key >> 63 << 64), digest.hex(), text, ids, low, ids.index(low), len(ids))):
                    c.append(v)
                serial += 1
            types = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[f.split()[0] for f in ENTRY.split(", ")])

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                if text in held:
                    held[text].append(i)
                    held_bytes += 16
                else:
                    held[text] = [i]
                    held_bytes += len(text) + 100
                if held_bytes > flush_bytes:
                    yield entries()
                    held_bytes = 0
        if held:
            yield entries()

    return run


def grow_directory(counts: np.ndarray, sizes: np.ndarray, capacity_bytes: int, capacity_rows: int) -> tuple[int, np.ndarray, list[tuple[int, int]]]:
    """Extendible hashing over the counts of 2**max_depth key prefixes.

    Returns the global depth, the directory (bucket number for each prefix of that depth) and (start, stop) of each
    bucket in units of the finest prefix. Buckets are numbered in key order.
    """
    max_depth = int(np.log2(len(counts)))
    rows, size = (np.concatenate([[0], np.cumsum(x)]) for x in (counts, sizes))
    depth, final, todo = 0, [], [(0, len(counts), 0)]
    while todo:
        lo, hi, local = todo.pop()
        overfull = size[hi] - size[lo] > capacity_bytes or rows[hi] - rows[lo] > capacity_rows
        if overfull and local < max_depth:
            mid = (lo + hi) // 2
            depth = max(depth, local + 1)  # the directory doubles when a bucket is split as deep as it
            todo += [(lo, mid, local + 1), (mid, hi, local + 1)]
        else:
            final.append((lo, hi))
    final.sort()
    step = len(counts) >> depth
    starts = np.array([lo for lo, _ in final])
    return depth, np.searchsorted(starts, np.arange(1 << depth) * step, "right") - 1, final


def _merge(group: pa.Table):
    """Of the entries of one key and salt, each text once: the member with the smallest id stands for all (rep)."""
    chain: dict[bytes, list] = {}
    for entry, text, low, n in zip(*(group.column(c).to_pylist() for c in ("entry", "text", "min_id", "n"))):
        chain.setdefault(text, []).append(((low is None, low or 0, entry), low, n))
    key, out = group.column("key")[0].as_py(), []
    for text, members in chain.items():
        first = min(members)
        for m in members:
            rep = m is first
            out.append((m[0][2], first[0][2], key, text if rep else None, m[1], sum(x[2] for x in members) if rep else m[2]))
    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["entry", "rep", "key", "text", "min_id", "n"])


def _own(batches):
    """Classes of the entries of one key range: chains by key, bytes compared within a chain. A key of one entry comes without its text."""
    chains: dict[int, list[list]] = {}
    for b in batches:
        for entry, bucket, key, text, low, n in zip(*(b.column(c).to_pylist() for c in ("entry", "bucket", "key", "text", "min_id", "n"))):
            chain = chains.setdefault(key, [])
            link = next((x for x in chain if x[0] == text), None)
            if link is None:
                chain.append([text, bucket, [(low is None, low or 0, entry)], n])
            else:
                link[2].append((low is None, low or 0, entry))
                link[3] += n
    out = [[] for _ in range(7)]
    for key, chain in chains.items():
        for place, (_, bucket, members, n) in enumerate(chain):
            first = min(members)
            for m in members:
                for c, v in zip(out, (m[2], bucket, key, place, None if first[0] else first[1], n, m == first)):
                    c.append(v)
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[f.split()[0] for f in CLASS.split(", ")])


def _entries(docs: DataFrame, id_col: str, text_col: str, key_bits: int, flush_bytes: int) -> DataFrame:
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("text")).mapInArrow(_fold(key_bits, flush_bytes), ENTRY)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, key_bits: int = 64, max_depth: int = 20, capacity_bytes: int = 16 << 20, capacity_rows: int = 200_000, flush_bytes: int = 48 << 20, fold_over: int = 64, broadcast_keys: int = 1_000_000, index_path: str | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of space, tab, LF, VT, FF, CR becomes one space; null counts as
    empty. The smallest doc_id of a group stays; null ids count as largest. Of repeated rows with that id exactly one
    stays (the first met). Other columns are ignored. An empty table gives no rows. Keys with over fold_over entries
    are folded by salt; up to broadcast_keys shared keys are broadcast to pick the texts to ship, more are joined by
    shuffle. index_path: a folder to which the index is written for lookup().
    """
    spark = docs.sparkSession
    entries = materialize(_entries(docs, id_col, text_col, key_bits, flush_bytes), "dedup-entries")
    slim = entries.select("entry", "key", "min_id", "n", F.octet_length("text").alias("size"))
    shared = materialize(slim.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"), "dedup-shared")
    pick = F.broadcast(shared) if shared.count() <= broadcast_keys else shared
    keys = materialize(slim.join(pick, "key", "left").withColumn("size", F.when(F.col("c") > 1, F.col("size")).otherwise(0)), "dedup-keys")
    texts = entries.select("entry", "key", "text", "min_id", "n").join(pick, "key")
    salt = F.pmod(F.xxhash64("entry"), F.ceil(F.sqrt("c"))).cast("int")
    hot = texts.where(F.col("c") > fold_over).select("entry", "key", salt.alias("salt"), "text", "min_id", "n")
    folded = materialize(run_groups(hot, ["key", "salt"], shuffle_partitions(spark), _merge, "entry long, rep long, key long, text binary, min_id long, n long"), "dedup-folded")

    total = keys.agg(F.sum("size"), F.count(F.lit(1))).head()
    need = max((total[0] or 0) / capacity_bytes, total[1] / capacity_rows, 1)
    finest = min(max_depth, math.ceil(math.log2(need)) + 4)  # about 16 prefixes for each bucket to come
    counts, sizes = np.zeros(1 << finest, np.int64), np.zeros(1 << finest, np.int64)
    prefix = F.shiftrightunsigned("key", 64 - finest)
    found = keys.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).toArrow()  # 2**finest rows at most
    at = found["p"].to_numpy()
    counts[at], sizes[at] = found["n"].to_numpy(), found["size"].to_numpy()
    depth, directory, buckets = grow_directory(counts, sizes, capacity_bytes, capacity_rows)
    weight = np.array([sizes[lo:hi].sum() + 200 * counts[lo:hi].sum() for lo, hi in buckets], np.int64)
    owners = max(1, min(len(buckets), round(weight.sum() / (capacity_bytes / 2))))
    owner = np.minimum(owners - 1, (np.cumsum(weight) - weight / 2) * owners // max(1, weight.sum())).astype(int)
    table = spark.createDataFrame(pa.table({"prefix": np.arange(len(directory)), "bucket": directory.astype(np.int32), "owner": owner[directory].astype(np.int32)}))
    at = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    cols = ["entry", "key", "text", "min_id", "n"]
    alone = keys.where("c is null").withColumn("text", F.lit(None).cast("binary")).select(cols)
    owned = alone.unionByName(texts.where(F.col("c") <= fold_over).select(cols)).unionByName(folded.where("entry = rep").select(cols))
    dealt = owned.withColumn("prefix", at).join(F.broadcast(table), "prefix").drop("prefix").repartitionById(owners, F.col("owner"))
    index = materialize(dealt.mapInArrow(_own, CLASS), "dedup-index")
    if index_path:
        table.withColumn("depth", F.lit(depth)).withColumn("key_bits", F.lit(key_bits)).write.mode("overwrite").parquet(f"{index_path}/directory")
        classes = index.where("winner").join(entries.select("entry", "sha", "text"), "entry").join(F.broadcast(table.select("bucket", "owner").distinct()), "bucket")
        classes = classes.repartitionById(owners, F.col("owner")).sortWithinPartitions("bucket", "key", "chain")
        classes.select("bucket", "key", "chain", "keep_id", "group_size", F.col("sha").alias("text_sha256"), "text").write.mode("overwrite").parquet(f"{index_path}/buckets")

    member = folded.where("entry <> rep").select("entry", "rep").join(index.withColumnRenamed("entry", "rep").select("rep", "keep_id", "group_size"), "rep")
    classes = index.select("entry", "keep_id", "group_size", "winner").unionByName(member.select("entry", "keep_id", "group_size", F.lit(False).alias("winner")))
    rows = entries.select("entry", "sha", "doc_ids", "min_pos").join(classes, "entry")
    return rows.select("keep_id", "group_size", "winner", "min_pos", F.col("sha").alias("text_sha256"), F.posexplode("doc_ids").alias("pos", "doc_id")).select(
        "doc_id", "keep_id", "group_size", (F.col("winner") & (F.col("pos") == F.col("min_pos"))).alias("kept"), "text_sha256"
    )


def lookup(docs: DataFrame, index_path: str, id_col: str = "doc_id", text_col: str = "text", *, flush_bytes: int = 48 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id (of the class of equal text in the index, null if there is none), known, text_sha256.

    Texts are normalised and equal as in exact_dedup(). A key finds its bucket through the directory, and bytes are
    compared there. Null text counts as empty; repeated rows fare alike; an empty table gives no rows.
    """
    spark = docs.sparkSession
    directory = spark.read.parquet(f"{index_path}/directory")
    depth, key_bits = directory.select("depth", "key_bits").head()
    entries = _entries(docs, id_col, text_col, key_bits, flush_bytes)
    at = F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")
    entries = entries.withColumn("prefix", at).join(F.broadcast(directory.select("prefix", "bucket")), "prefix")  # 2**max_depth rows at most
    buckets = spark.read.parquet(f"{index_path}/buckets").select("bucket", "key", "text", "keep_id", F.lit(True).alias("known"))
    met = entries.join(buckets, ["bucket", "key", "text"], "left")
    return met.select(F.explode("doc_ids").alias("doc_id"), "keep_id", F.coalesce("known", F.lit(False)).alias("known"), F.col("sha").alias("text_sha256"))
