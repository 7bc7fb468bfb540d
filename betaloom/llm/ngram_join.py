"""Similarity join on word n-grams: MinHash candidates, Bayesian pruning, exact verification.

1. Scan tasks turn each text into its set of hashed shingles and keep a 128-bit digest of the set and 128 MinHash
   values of 16 bits. Texts with equal sets become one class by aggregation, so copies are never paired.
2. Classes that agree in four consecutive values meet in a bucket (32 bands: a pair at similarity 0.8 meets nowhere
   with probability 5e-8). There the values are compared 16 at a time; a pair is dropped as soon as the posterior
   probability, under a uniform prior, that its similarity reaches the threshold falls below the tolerance. A bucket
   hands on a spanning set of the pairs left, never all of them.
3. Components of the pairs left that fit a task are verified whole: all their pairs that the same rule does not drop
   by exact set intersection. Larger ones are cut into cells: the classes whose smallest neighbour is the same, in
   slices of bounded size. Two cells meet only if a bucket's pairs connect them, so a chain of many small clusters
   costs what its own pairs cost, not the square of its length; classes of two cells meet in one task only, so no pair
   is counted twice.
Sets go to these tasks as sorted hashes, made once. Buckets of many classes are worked on as pairs of blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import blocked, roots, run_chunks, run_groups, spanning, spread_join
from .components import connected_components
from .store import materialize, release, shuffle_partitions
from .textvec import SPACE, Hasher, freed, mix, shingles, slices, utf8, words

VALUES, BAND, STEP = 128, 4, 16
_MULTIPLIERS = mix(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)


def minhash(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """128 MinHash values of 16 bits for each non-empty set."""
    out = np.empty((len(offsets) - 1, VALUES), np.uint16)
    for k, a in enumerate(_MULTIPLIERS):
        low = np.minimum.reduceat(sets * a, offsets[:-1])
        out[:, k] = mix(low) >> np.uint64(48)
    return out


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(n, k): after n values, a pair with fewer than k equal ones is dropped.

    With a uniform prior the similarity has posterior Beta(k + 1, n - k + 1), and the chance that it is at least t is
    the chance of at most k successes in n + 1 trials of chance t.
    """
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        chance, k = 0.0, 0
        while k <= n:
            chance += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
            if chance >= tolerance:
                break
            k += 1
        out.append((n, k))
    return out


def unpruned(values: np.ndarray, left: np.ndarray, right: np.ndarray, rule: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs outlast the pruning; each step looks at the pairs that outlasted the one before."""
    alive, same, at = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, k in rule:
        same = same + (values[left[alive], at:n] == values[right[alive], at:n]).sum(axis=1)
        stay = same >= k
        alive, same, at = alive[stay], same[stay], n
    return alive


def _text_sets(column: pa.Array, width: int):
    for lo, hi in slices(column):
        data, offsets = utf8(column.slice(lo, hi - lo))
        starts, ends, before = words(data, offsets, ~SPACE)
        hashes = Hasher(data).of(starts, ends)
        yield lo, *shingles(hashes, before, width)


def _sign(width: int):
    """(doc_id, text) to (doc_id, number of shingles, digest of the set in two halves, MinHash values)."""

    def run(batches):
        for b in freed(batches):
            for lo, sets, offsets in _text_sets(b.column("text"), width):
                n = np.diff(offsets)
                full = n > 0
                values = [None] * len(n)
                digests = np.zeros((len(n), 2), np.uint64)
                if full.any():
                    edges = np.append(offsets[:-1][full], offsets[-1])
                    for k, sig in zip(np.flatnonzero(full).tolist(), minhash(sets, edges)):
                        values[k] = sig.tobytes()
                    for half, salt in enumerate((np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D))):
                        digests[full, half] = np.add.reduceat(mix(sets ^ salt), edges[:-1])
                part = b.slice(lo, len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("t"), pa.array(n.astype(np.int64)), pa.array(digests[:, 0].view(np.int64)), pa.array(digests[:, 1].view(np.int64)), pa.array(values, pa.binary())],
                    names=["doc_id", "t", "n", "d1", "d2", "sig"],
                )

    return run


def _bands(batches):
    """(cid, sig) to a row for each band; its four values of 16 bits and its number make its key."""
    for b in batches:
        if b.num_rows:
            keys = np.frombuffer(b"".join(b.column("sig").to_pylist()), "<u8").reshape(b.num_rows, -1)
            keys = mix(mix(keys) + np.arange(1, keys.shape[1] + 1, dtype=np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(b.column("cid").to_numpy(), keys.shape[1]))], names=["key", "cid"])


def _sets(width: int):
    """(cid, text) to (cid, sorted 64-bit hashes of its shingles)."""

    def run(batches):
        for b in freed(batches):
            for lo, sets, offsets in _text_sets(b.column("text"), width):
                raw = [sets[i:j].tobytes() for i, j in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([b.column("cid").slice(lo, len(raw)), pa.array(raw, pa.binary())], names=["cid", "sets"])

    return run


def _pairs(group: pa.Table, step: int = 256):
    """The pairs of a group, or across its two blocks, a strip of rows at a time."""
    n = group.num_rows
    across = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
    block = group.column("block").to_numpy()
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        wanted = np.arange(n)[None, :] > np.arange(lo, hi)[:, None]
        if across:
            wanted &= block[lo:hi, None] != block[None, :]
        left, right = np.nonzero(wanted)
        yield left + lo, right


def _values(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint16).reshape(group.num_rows, -1)


def _join(rule):
    """Pairs of buckets that outlast the pruning as (cid, smallest cid of a pair), a spanning set of each bucket."""

    def alive(rows: pa.Table):
        values = _values(rows)

        def test(left, right):
            good = np.zeros(len(left), bool)
            good[unpruned(values, left, right, rule)] = True
            return good

        return test

    def of_large(group: pa.Table, root):
        values = _values(group)
        for left, right in _pairs(group):
            apart = root()[left] != root()[right]  # what is connected already need not be compared
            left, right = left[apart], right[apart]
            kept = unpruned(values, left, right, rule)
            yield left[kept], right[kept]

    return lambda chunk, bounds: spanning(chunk, bounds, alive, of_large)


def _common(sets: np.ndarray, offsets: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many shingles the two sets of each pair share."""
    if len(left) < 64:
        return np.array([len(np.intersect1d(sets[offsets[i] : offsets[i + 1]], sets[offsets[j] : offsets[j + 1]], assume_unique=True)) for i, j in zip(left.tolist(), right.tolist())], np.int64)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    names, where, times = np.unique(sets, return_inverse=True, return_counts=True)
    kept = (times > 1)[where]
    place = np.cumsum(times > 1) - 1
    owner, where = owner[kept], place[where[kept]]
    order = np.argsort(where, kind="stable")
    owner, where = owner[order], where[order]
    shared = np.zeros((n, n), np.float32)
    width = max(256, (32 << 20) // (4 * n))
    for lo in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(where, (lo, lo + width))
        has = np.zeros((n, width), np.float32)
        has[owner[a:b], where[a:b] - lo] = 1
        shared += has @ has.T  # counts below 2**24 are exact
    return shared[left, right].astype(np.int64)


def _verify(rule, threshold):
    """How many documents each class of a component or of two cells is linked to in this task, and its smallest linked class."""

    def work(group: pa.Table):
        if group.num_rows < 2:
            return
        group = group.take(pa.array(np.argsort(group.column("cid").to_numpy(), kind="stable"))).combine_chunks()
        cid, m = group.column("cid").to_numpy(), group.column("m").to_numpy()
        values, kept = _values(group), []
        for left, right in _pairs(group):
            alive = unpruned(values, left, right, rule)
            kept.append((left[alive], right[alive]))
        left, right = (np.concatenate(x) for x in zip(*kept))
        if not len(left):
            return
        raw = group.column("sets").to_pylist()
        sets, sizes = np.frombuffer(b"".join(raw), "<u8"), np.array([len(x) // 8 for x in raw])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        common = _common(sets, offsets, left, right)
        linked = common >= threshold * (sizes[left] + sizes[right] - common) - 1e-9
        left, right = left[linked], right[linked]
        links = np.bincount(left, m[right], len(cid)) + np.bincount(right, m[left], len(cid))
        root = roots(len(cid), left, right)
        got = np.flatnonzero(links)
        if len(got):
            yield pa.RecordBatch.from_arrays([pa.array(cid[got]), pa.array(links[got].astype(np.int64)), pa.array(cid[root[got]])], names=["cid", "links", "root"])

    return work


def _cells(near: DataFrame, edges: DataFrame, block_rows: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Classes of large components in cells, and which cells meet.

    near: cid, bytes; edges: (a, b), b being the smallest class of a's pairs in a bucket. Returns (cid, cell, slice) and
    (cell, slice, u1, s1, u2, s2, block): the rows of a cell's slice take part in the task (u1, s1, u2, s2) as its block.
    """
    lead = edges.groupBy("a").agg(F.min("b").alias("b")).withColumnRenamed("a", "cid")
    led = materialize(near.join(lead, "cid", "left").select("cid", "bytes", F.coalesce("b", "cid").alias("cell")), "gram-cells")
    width = F.greatest(F.ceil(F.count(F.lit(1)) / block_rows), F.least(F.ceil(F.sum("bytes") / block_bytes), F.count(F.lit(1)))).cast("int")
    sizes = materialize(led.groupBy("cell").agg(width.alias("slices"), F.count(F.lit(1)).alias("n")), "gram-cell-sizes")
    cells = spread_join(led, sizes, ["cell"], "n").select("cid", "cell", F.pmod(F.xxhash64("cid", F.lit(7)), F.col("slices")).cast("int").alias("slice"))
    # the two classes of a pair have the bucket's smallest class in common
    of = led.select("cid", "cell")
    ends = edges.select(F.col("a").alias("cid"), "b").join(of, "cid").select("b", "cell").unionByName(edges.select("b").distinct().join(of.withColumnRenamed("cid", "b"), "b"))
    ends = materialize(ends.distinct(), "gram-cell-ends")
    across = ends.select("b", F.col("cell").alias("u1")).join(ends.select("b", F.col("cell").alias("u2")), "b").where("u1 < u2").select("u1", "u2").distinct()
    wide = sizes.select("cell", "slices")
    across = across.join(wide.toDF("u1", "n1"), "u1").join(wide.toDF("u2", "n2"), "u2")
    met = across.unionByName(sizes.select(F.col("cell").alias("u1"), F.col("cell").alias("u2"), F.col("slices").alias("n1"), F.col("slices").alias("n2")))
    met = met.withColumn("s1", F.explode(F.sequence(F.lit(0), F.col("n1") - 1))).withColumn("s2", F.explode(F.sequence(F.lit(0), F.col("n2") - 1))).where("u1 < u2 or s1 <= s2")
    sides = F.when((F.col("u1") == F.col("u2")) & (F.col("s1") == F.col("s2")), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    met = met.withColumn("block", F.explode(sides))
    return cells, met.select(F.when(F.col("block") == 0, F.col("u1")).otherwise(F.col("u2")).alias("cell"), F.when(F.col("block") == 0, F.col("s1")).otherwise(F.col("s2")).alias("slice"), "u1", "s1", "u2", "s2", "block")


def ngram_join(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8, tolerance: float = 1e-7, block_rows: int = 512, block_bytes: int = 4 << 20, broadcast_rows: int = 1_000_000) -> DataFrame:
    """One row per input row: doc_id, class_id, n_links, kept, text_hash (xxhash64 of the text).

    Two documents are linked when the Jaccard similarity of their sets of `width`-word shingles (lower case, words
    end at ASCII white space) is at least the threshold. class_id is the smallest doc_id reachable by links, n_links
    the number of other rows linked directly, kept true for one row of each class: the first with the smallest id.
    A text of fewer words is one shingle; null, empty and blank texts link with nothing: class_id is their own id,
    kept true. Repeated rows are linked copies. Rows with null id take part; a class of such rows only has a null
    class_id. Other columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    n = shuffle_partitions(spark)
    rule = least_matches(threshold, tolerance)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("t"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    signed = texts.mapInArrow(_sign(width), "doc_id long, t long, n long, d1 long, d2 long, sig binary")
    signed = materialize(signed.withColumn("row", F.monotonically_increasing_id()), "gram-signs")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row"))
    classes = signed.where("n > 0").groupBy("d1", "d2", "n").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("m"))
    classes = classes.select("d1", "d2", "n", "m", F.col("first.doc_id").alias("low"), F.col("first.row").alias("cid"))
    classes = materialize(classes, "gram-classes")
    reps = materialize(signed.select(F.col("row").alias("cid"), "doc_id", "t", "n", "sig").join(classes.select("cid", "m"), "cid"), "gram-reps")

    # candidates
    bands = materialize(reps.select("cid", "sig").mapInArrow(_bands, "key long, cid long"), "gram-bands")
    met = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = bands.join(met, "key").join(reps.select("cid", "sig"), "cid")
    dealt = blocked(dealt, ["key"], "cid", F.ceil(F.col("size") / block_rows).cast("long"))
    edges = materialize(run_chunks(dealt, ["key", "lo", "hi"], n, _join(rule), "a long, b long").distinct(), "gram-edges")
    release(bands)
    near = materialize(connected_components(edges), "gram-candidates").withColumnRenamed("node", "cid")

    # each candidate once, with the sorted hashes of its shingles
    wanted = materialize(reps.join(near, "cid"), "gram-members")
    keys = wanted.select("cid", F.col("doc_id").alias("d"), F.col("t").alias("h"))
    same = texts["doc_id"].eqNullSafe(F.col("d")) & (texts["t"] == F.col("h"))
    found = texts.join(F.broadcast(keys) if wanted.count() <= broadcast_rows else keys, same).select("cid", "text").dropDuplicates(["cid"])
    members = materialize(wanted.select("cid", "m", "n", "sig", "component").join(found.mapInArrow(_sets(width), "cid long, sets binary"), "cid"), "gram-sets")
    release(wanted)

    # verification: a component that fits a task there, larger ones cell by cell
    sizes = materialize(members.groupBy("component").agg(F.count(F.lit(1)).alias("size"), F.sum(F.col("n") * 8).alias("bytes")), "gram-sizes")
    fits = (F.col("size") <= block_rows) & (F.col("bytes") <= block_bytes)
    zero = F.lit(0)
    held = ["cid", "m", "sig", "sets"]
    units = members.join(sizes.where(fits).select("component"), "component").select(F.col("component").alias("u1"), zero.alias("s1"), F.col("component").alias("u2"), zero.alias("s2"), zero.alias("block"), *held)
    large = spread_join(members.select("cid", "component", (F.col("n") * 8).alias("bytes")), sizes.where(~fits).select("component", "size"), ["component"], "size").select("cid", "bytes")
    if not sizes.where(~fits).isEmpty():
        cells, meetings = _cells(large, edges, block_rows, block_bytes)
        placed = members.select(held).join(cells, "cid").join(meetings, ["cell", "slice"])
        units = units.unionByName(placed.select("u1", "s1", "u2", "s2", "block", *held))
    units = units.withColumn("lo", zero).withColumn("hi", F.when((F.col("u1") == F.col("u2")) & (F.col("s1") == F.col("s2")), zero).otherwise(1))
    links = materialize(run_groups(units, ["u1", "s1", "u2", "s2"], n, _verify(rule, threshold), "cid long, links long, root long"), "gram-links")
    release(members)
    release(reps)

    # classes of linked documents, back to all rows
    linked = connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "cid")
    ends = classes.join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(linked, "cid", "left")
    ends = materialize(ends.withColumn("component", F.coalesce("component", "cid")), "gram-ends")
    head = F.min(F.struct(F.col("low").isNull().alias("no_id"), F.col("low"), F.col("cid")))
    heads = materialize(ends.groupBy("component").agg(head.alias("head"), F.count(F.lit(1)).alias("size")), "gram-heads")
    ends = spread_join(ends, heads, ["component"], "size").select("d1", "d2", "n", "m", F.col("head.low").alias("class_id"), F.col("head.cid").alias("keep"), (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    ends = materialize(ends, "gram-classes-of")
    out = spread_join(signed.where("n > 0").drop("sig"), ends, ["d1", "d2", "n"], "m").select("doc_id", "class_id", "n_links", (F.col("row") == F.col("keep")).alias("kept"), F.col("t").alias("text_hash"))
    return out.unionByName(signed.where("n = 0").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"), F.col("t").alias("text_hash")))
