"""Near-duplicate vectors through spherical-cap filters of a random product code.

Equal vectors of a label become one class first, folded in each task before the one shuffle of vectors. Each code is a random rotation and a set of random unit vectors for
each block of coordinates: a filter direction is a choice of one codeword per block, so codes of a few words span
millions of directions, and the directions whose product with a vector exceeds the threshold are list-decoded from
the blocks' sorted scores without visiting the others. Classes that share a filter meet in its bucket and are
verified in double precision; a bucket hands on a spanning set of its links, never all pairs. The components of these
links are then gathered once and every link inside them is counted. The number of directions follows from the number
of classes of each label, so a bucket holds few unrelated vectors at any size; the number of codes follows from how
often pairs at the threshold meet among so many directions, so the share of missed pairs stays bounded at any size.
Buckets and components of many classes are joined as pairs of blocks.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import blocked, run_chunks, run_groups, spanning, spread_join
from .components import connected_components
from .store import materialize, shuffle_partitions
from .textvec import freed, mix

MOST_LABELS = 1_000_000  # whose sizes are broadcast; of more, the join shuffles


@functools.lru_cache(maxsize=8)
def product_code(dim: int, words: int, blocks: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation and, for each block of coordinates, `words` random unit vectors."""
    rng = np.random.default_rng([seed, dim, words])
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    codes = []
    for part in np.array_split(np.arange(dim), blocks):
        c = rng.standard_normal((words, len(part)))
        codes.append(c / np.maximum(np.linalg.norm(c, axis=1), 1e-30)[:, None])
    return rotation, codes


def _halves(units: np.ndarray, words: int, blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """For each unit vector its products with all choices of words of the first half of the blocks, and of the second."""
    rotation, codes = product_code(units.shape[1], words, blocks, seed)
    spun, at, sides = units @ rotation, 0, []
    for part in (codes[: blocks // 2], codes[blocks // 2 :]):
        s = np.zeros((len(units), 1))
        for c in part:
            s = (s[:, :, None] + (spun[:, at : at + c.shape[1]] @ c.T)[:, None, :]).reshape(len(units), -1)
            at += c.shape[1]
        sides.append(s)
    return sides[0], sides[1]


@functools.lru_cache(maxsize=4096)
def cap_threshold(dim: int, words: int, blocks: int, per_vector: float, seed: int) -> float:
    """The threshold that leaves per_vector directions to a random unit vector on average, from 128 random vectors."""
    v = np.random.default_rng([seed, dim, 1]).standard_normal((128, dim))
    first, second = _halves(v / np.linalg.norm(v, axis=1)[:, None], words, blocks, seed)
    keep = min(first.shape[1], second.shape[1], 1024)
    first, second = (-np.partition(-s, keep - 1, axis=1)[:, :keep] for s in (first, second))
    second.sort(axis=1)
    lo, hi = -2.0 * blocks, 2.0 * blocks
    for _ in range(40):
        mid = (lo + hi) / 2
        n = sum(keep * keep - np.searchsorted(b, mid - a).sum() for a, b in zip(first, second))
        lo, hi = (mid, hi) if n > per_vector * len(v) else (lo, mid)
    return hi


def _best(parts: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest sums of one score of each part, in falling order, and which choice of words each is. parts: (vectors, words) each."""
    value = index = None
    for s in parts:
        order = np.argpartition(-s, k, axis=1)[:, :k] if s.shape[1] > 3 * k else np.broadcast_to(np.arange(s.shape[1]), s.shape)
        top = np.take_along_axis(s, order, axis=1)
        rank = np.argsort(-top, axis=1)[:, :k]
        order, top = np.take_along_axis(order, rank, axis=1), np.take_along_axis(top, rank, axis=1)
        if value is None:
            value, index = top, order
            continue
        # the sum of rank i and rank j has (i + 1)(j + 1) sums at least as large, itself included
        i, j = np.nonzero(np.outer(np.arange(value.shape[1]) + 1, np.arange(top.shape[1]) + 1) <= k)
        sums, at = value[:, i] + top[:, j], index[:, i] * s.shape[1] + order[:, j]
        order = np.argsort(-sums, axis=1)[:, :k]
        value, index = np.take_along_axis(sums, order, axis=1), np.take_along_axis(at, order, axis=1)
    return value, index


def decode(units: np.ndarray, words: int, blocks: int, per_vector: float, least: int, seed: int, k: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """list_decode() as two arrays: the vector's number, ascending, and the filter.

    Of each half of the blocks only the k best sums are formed; a vector whose k-th sum could still reach the threshold
    with the best of the other half is done again with more of them. So work grows with the words of a block, not with
    the directions.
    """
    rotation, codes = product_code(units.shape[1], words, blocks, seed)
    cap = cap_threshold(units.shape[1], words, blocks, per_vector, seed)
    spun, at, scores = units @ rotation, 0, []
    for c in codes:
        scores.append(spun[:, at : at + c.shape[1]] @ c.T)
        at += c.shape[1]
    half = blocks // 2
    sizes = words**half, words ** (blocks - half)
    least = min(least, *sizes)
    owners, filters, left = [], [], [(np.arange(len(units)), k)]
    while left:
        todo, k = left.pop()
        rows = max(1, (1 << 20) // min(max(k, least), max(sizes)) ** 2)
        if len(todo) > rows:
            left += [(todo[rows:], k), (todo[:rows], k)]
            continue
        (a, ia), (b, ib) = (_best([s[todo] for s in part], max(k, least)) for part in (scores[:half], scores[half:]))
        done = ((a.shape[1] >= sizes[0]) | (a[:, -1] + b[:, 0] < cap)) & ((b.shape[1] >= sizes[1]) | (b[:, -1] + a[:, 0] < cap))
        row, i, j = np.nonzero((a[:, :, None] + b[:, None, :] >= cap) & done[:, None, None])
        n = np.bincount(row, minlength=len(todo))
        keep = n[row] >= least
        owners.append(todo[row[keep]])
        filters.append(ia[row[keep], i[keep]] * sizes[1] + ib[row[keep], j[keep]])
        few = np.flatnonzero(done & (n < least))
        if len(few):
            i, j = np.nonzero(np.outer(np.arange(least) + 1, np.arange(least) + 1) <= least)
            pick = np.argsort(-(a[few][:, i] + b[few][:, j]), axis=1)[:, :least]
            owners.append(np.repeat(todo[few], least))
            filters.append((ia[few[:, None], i[pick]] * sizes[1] + ib[few[:, None], j[pick]]).ravel())
        if not done.all():
            left.append((todo[~done], 4 * k))
    owner, found = (np.concatenate([np.empty(0, np.int64), *x]) for x in (owners, filters))
    order = np.argsort(owner, kind="stable")
    return owner[order], found[order].astype(np.int64)


def list_decode(units: np.ndarray, words: int, blocks: int, per_vector: float, least: int, seed: int) -> list[np.ndarray]:
    """The filters of each unit vector: all directions of the code whose product with it reaches the threshold.

    A vector that reaches it in fewer than `least` directions gets its `least` best ones.
    """
    owner, found = decode(units, words, blocks, per_vector, least, seed)
    return np.split(found, np.searchsorted(owner, np.arange(1, len(units)))) if len(units) else []


def words_of(level: int, blocks: int, per_vector: float, spread: int) -> int:
    """Words of each block for a label of at most 2**level classes."""
    return max(4, math.ceil((2**level * per_vector * spread) ** (1 / blocks)))


def code_shape(level: int, per_vector: float, spread: int, most_words: int) -> tuple[int, int]:
    """Words and blocks: the fewest blocks of at most most_words words each, so the cost of a vector and code stays bounded."""
    blocks = 2
    while words_of(level, blocks, per_vector, spread) > most_words:
        blocks += 1
    return words_of(level, blocks, per_vector, spread), blocks


def pairs_at(threshold: float, n: int, dim: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """n pairs of random unit vectors whose product is the threshold."""
    v, g = rng.standard_normal((2, n, dim))
    v /= np.linalg.norm(v, axis=1)[:, None]
    g -= (g * v).sum(axis=1)[:, None] * v
    w = threshold * v + math.sqrt(max(0.0, 1 - threshold**2)) * g / np.maximum(np.linalg.norm(g, axis=1), 1e-30)[:, None]
    return v, w / np.maximum(np.linalg.norm(w, axis=1), 1e-30)[:, None]


@functools.lru_cache(maxsize=4096)
def codes_needed(dim: int, words: int, blocks: int, per_vector: float, least: int, threshold: float, miss: float, seed: int) -> int:
    """How many codes leave a pair at the threshold without a common filter with a probability of `miss` at most.

    Codes are independent, so the share of pairs that miss falls by the same factor with each. The factor is measured
    on 2,000 random pairs over eight codes, plus two standard errors.
    """
    rng, met, n = np.random.default_rng([seed, dim, 2]), 0, 2000
    step = max(10, min(250, (1 << 20) // words ** (blocks - blocks // 2)))
    for code in range(8):
        v, w = pairs_at(threshold, n // 8, dim, rng)
        for lo in range(0, len(v), step):
            a, b = (list_decode(x[lo : lo + step], words, blocks, per_vector, least, seed + code) for x in (v, w))
            met += sum(not set(p.tolist()).isdisjoint(q.tolist()) for p, q in zip(a, b))
    share = met / n
    share = min(max(share - 2 * math.sqrt(share * (1 - share) / n), 1 / n), 1 - 1 / n)
    return math.ceil(math.log(miss) / math.log(1 - share))


def _digest(raw: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(raw, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _fold(kind: str, ids: bool, flush_bytes: int = 32 << 20):
    """(label, vec, vec_id): equal vectors of a task become one row, with the vector or with its digest and their ids."""

    def run(batches):
        held: dict[tuple[str, bytes], list] = {}
        size = 0

        def rows():
            label, raw = [k[0] for k in held], [k[1] for k in held]
            if ids:
                digests = [_digest(r) for r in raw]
                cols = [pa.array(label, pa.string()), pa.array([d[0] for d in digests], pa.int64()), pa.array([d[1] for d in digests], pa.int64()), pa.array(list(held.values()), pa.list_(pa.int64()))]
                names = ["label", "k1", "k2", "ids"]
            else:
                cols = [pa.array(label, pa.string()), pa.array(raw, pa.binary()), pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())]
                names = ["label", "vec", "low", "m"]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in freed(batches):
            vec = b.column("vec")
            flat, at = np.asarray(vec.values, kind) + np.array(0.0, kind), np.asarray(vec.offsets).tolist()  # -0 becomes 0
            for label, i, lo, hi in zip(b.column("label").to_pylist(), b.column("vec_id").to_pylist(), at, at[1:]):
                key = label, flat[lo:hi].tobytes()
                known = held.get(key)
                if known is None:
                    held[key] = [i] if ids else [i, 1]
                    size += len(key[1]) + 200
                elif ids:
                    known.append(i)
                    size += 16
                else:
                    known[0], known[1] = min(known[0], i), known[1] + 1
                if size > flush_bytes:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    return run


def _units(vecs: list, kind: str) -> np.ndarray:
    x = np.array([np.frombuffer(v, kind) for v in vecs], np.float64)
    x /= np.abs(x).max(axis=1)[:, None]  # against overflow in the squares
    return x / np.linalg.norm(x, axis=1)[:, None]


CLASSES = "cid long, f long, lh long, label string, k1 long, k2 long, low long, m long, vec binary"


def _decode(kind, plan, per_vector, least, seed):
    """(label, dim, level, vec, low, m), one row per class, to a row for the class and one for each filter of its vector.

    plan: words, blocks and codes by (dim, level). A filter f is hashed with label and dim, so each has its own.
    """
    schema = pa.schema([(f.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in CLASSES.split(", ")])

    def batch(n, **cols):
        return pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else pa.nulls(n, f.type) for f in schema], schema=schema)

    def run(batches):
        serial = TaskContext.get().partitionId() << 33
        for b in freed(batches):
            n, vecs = b.num_rows, b.column("vec").to_pylist()
            cid = np.arange(serial, serial + n)
            serial += n
            label, dims, levels = (b.column(c).to_pylist() for c in ("label", "dim", "level"))
            own = {k: _digest(repr(k).encode())[0] for k in set(zip(label, dims))}
            lh = np.array([own[k] for k in zip(label, dims)], np.int64)
            digests = [_digest(v) for v in vecs]
            k1, k2 = (pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1))
            yield batch(n, cid=pa.array(cid), lh=pa.array(lh), label=b.column("label"), k1=k1, k2=k2, low=b.column("low"), m=b.column("m"), vec=b.column("vec"))
            shapes = np.array(list(zip(dims, levels)), np.int64).reshape(-1, 2)
            for dim, level in sorted(set(zip(dims, levels))):
                words, blocks, codes = plan[dim, level]
                rows = np.flatnonzero((shapes == (dim, level)).all(axis=1))
                for lo in range(0, len(rows), 512):
                    at = rows[lo : lo + 512]
                    units = _units([vecs[i] for i in at], kind)
                    for code in range(codes):
                        owner, found = decode(units, words, blocks, per_vector, least, seed + code)
                        f = mix(mix(found.astype(np.uint64) + np.uint64(code * words**blocks % (1 << 64))) ^ lh[at[owner]].view(np.uint64))
                        yield batch(len(f), cid=pa.array(cid[at[owner]]), f=pa.array(f.view(np.int64)))

    return run


def _links(group: pa.Table, kind: str, threshold: float, step: int = 512):
    """The linked pairs of a bucket, or of two blocks of it, a strip of rows at a time."""
    lh, block = group.column("lh").to_numpy(), group.column("block").to_numpy()
    across = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
    vecs = group.column("vec").to_pylist()
    for own in np.unique(lh):  # one, but where two labels' hashed filters are equal by chance
        rows = np.flatnonzero(lh == own)
        x = _units([vecs[i] for i in rows], kind)
        for lo in range(0, len(rows), step):
            left, right = np.nonzero(x[lo : lo + step] @ x[lo:].T >= threshold)
            left, right = rows[left[left < right] + lo], rows[right[left < right] + lo]
            if across:
                meet = block[left] != block[right]
                left, right = left[meet], right[meet]
            yield left, right


def _join(kind, threshold):
    """Links of buckets as (cid, smallest cid it is linked to), a row per class and bucket at most."""

    def alive(rows: pa.Table):
        lh, vecs = rows.column("lh").to_numpy(), rows.column("vec").to_pylist()
        length = np.array([len(v) for v in vecs])
        units = {n: _units([v for v in vecs if len(v) == n], kind) for n in np.unique(length).tolist()}
        place = np.empty(len(vecs), int)
        for n in units:
            place[length == n] = np.arange((length == n).sum())

        def test(left, right):
            good = lh[left] == lh[right]  # one label and length, but where two hashed filters are equal by chance
            for n, x in units.items():
                at = np.flatnonzero(good & (length[left] == n))
                for lo in range(0, len(at), 8192):
                    k = at[lo : lo + 8192]
                    good[k] = np.einsum("ij,ij->i", x[place[left[k]]], x[place[right[k]]]) >= threshold
            return good

        return test

    return lambda chunk, bounds: spanning(chunk, bounds, alive, lambda group, _: _links(group, kind, threshold))


def _count(kind, threshold):
    """How many vectors each class of a component is linked to, within these blocks."""

    def work(group: pa.Table):
        cid, m = group.column("cid").to_numpy(), group.column("m").to_numpy()
        links = np.zeros(len(cid))
        for left, right in _links(group, kind, threshold):
            links += np.bincount(left, m[right], len(cid)) + np.bincount(right, m[left], len(cid))
        got = np.flatnonzero(links)
        if len(got):
            yield pa.RecordBatch.from_arrays([pa.array(cid[got]), pa.array(links[got].astype(np.int64))], names=["cid", "links"])

    return work


def embedding_near_dedup(vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.93, codes: int = 8, miss: float = 1e-3, per_vector: float = 2, least: int = 2, most_words: int = 1024, spread: int = 64, block_rows: int = 512, seed: int = 11) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors with equal, non-null labels and equal length are compared by cosine in double precision. Null, empty or
    zero vectors, those with null or non-finite components, and rows with null id link with nothing: n_links 0,
    component_id their own id, kept true. Equal vectors are linked; each row counts as a vector, repeated rows too.
    Other columns are ignored. An empty table gives no rows.

    codes: independent rotations and codes, at least; miss: the share of random pairs at the threshold that may be
    without a common filter, at any number of vectors of a label: codes are added until it is kept. per_vector: filters
    of a vector in each code, on average; least: and at least; spread: directions per vector and filter, against chance
    meetings; most_words: of a block, beyond which a code gets another block. Links inside a component are found whether
    or not they share a filter.
    """
    spark = vectors.sparkSession
    n = shuffle_partitions(spark)
    kind, vec = ("<f4", F.col(vec_col)) if vectors.schema[vec_col].dataType.elementType.typeName() == "float" else ("<f8", F.col(vec_col).cast("array<double>"))
    sound = F.coalesce(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vec) > 0) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), vec.alias("vec"), sound.alias("sound"))
    good = rows.where("sound").drop("sound")

    # how large each label is decides its code
    sizes = good.groupBy("label", F.size("vec").alias("dim")).agg(F.approx_count_distinct(F.xxhash64("vec"), 0.02).alias("n"))
    sizes = materialize(sizes.select("label", "dim", F.length(F.bin(F.ceil(F.col("n") * 1.05))).alias("level")), "vec-sizes")  # n < 2**level
    plan = {}
    for dim, level in sizes.select("dim", "level").distinct().collect():
        words, blocks = code_shape(level, per_vector, spread, most_words)
        plan[dim, level] = words, blocks, max(codes, codes_needed(dim, words, blocks, per_vector, least, threshold, miss, seed))
    level = F.broadcast(sizes) if sizes.count() <= MOST_LABELS else sizes

    # classes of equal vectors and their filters; vectors are shuffled once
    folded = good.mapInArrow(_fold(kind, False), "label string, vec binary, low long, m long").repartition(n, "label", "vec")
    classes = folded.groupBy("label", "vec").agg(F.min("low").alias("low"), F.sum("m").alias("m")).withColumn("dim", (F.octet_length("vec") / int(kind[-1])).cast("int"))
    table = materialize(classes.join(level, ["label", "dim"]).mapInArrow(_decode(kind, plan, per_vector, least, seed), CLASSES), "vec-classes")
    classes, filters = table.where("f is null").drop("f"), table.where("f is not null").select("f", "cid")

    # links in buckets, a spanning set of each
    met = filters.groupBy("f").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = blocked(filters.join(met, "f"), ["f"], "cid", F.ceil(F.col("n") / block_rows).cast("long")).join(classes.select("cid", "lh", "vec"), "cid")
    edges = run_chunks(dealt, ["f", "lo", "hi"], n, _join(kind, threshold), "a long, b long")

    # all links inside the components
    linked = materialize(connected_components(edges), "vec-components").withColumnRenamed("node", "cid")
    sizes = linked.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    members = spread_join(linked, sizes, ["component"], "n").join(classes.select("cid", "lh", "m", "vec"), "cid")
    dealt = blocked(members, ["component"], "cid", F.ceil(F.col("n") / block_rows).cast("long"))
    links = run_groups(dealt, ["component", "lo", "hi"], n, _count(kind, threshold), "cid long, links long")

    ends = classes.select("cid", "label", "k1", "k2", "low", "m").join(links.groupBy("cid").agg(F.sum("links").alias("links")), "cid", "left").join(linked, "cid", "left")
    ends = materialize(ends.withColumn("component", F.coalesce("component", "cid")), "vec-ends")
    first = materialize(ends.groupBy("component").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n")), "vec-heads")
    ends = spread_join(ends, first, ["component"], "n").select("label", "k1", "k2", "component_id", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    # back to rows by a 128-bit digest; a task's equal vectors come as one row
    own = good.mapInArrow(_fold(kind, True), "label string, k1 long, k2 long, ids array<long>")
    out = own.join(ends, ["label", "k1", "k2"]).select(F.explode("ids").alias("vec_id"), "n_links", "component_id").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return out.unionByName(rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
