"""Shared parts of similarity joins: walking over sorted buckets, hot buckets as pairs of blocks, union of links."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blocked(rows: DataFrame, key: list[str], id_col: str, n_blocks: Column) -> DataFrame:
    """rows of a bucket dealt to block pairs (lo <= hi): block b of B meets each block once, so a task holds two blocks.

    Adds block, lo and hi. A bucket of one block gives each row once, with lo = hi = 0.
    """
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.col(id_col), F.lit(7)), n_blocks).cast("int"))
    other = F.explode(F.when(n_blocks > 1, F.sequence(F.lit(0), (n_blocks - 1).cast("int"))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("other", other).withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other")).drop("other")


def by_group(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The groups of rows sorted by key; rows of one group may span batches."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [np.asarray(b.column(k).to_numpy(zero_copy_only=False)) for k in key]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1 if b.num_rows > 1 else np.empty(0, int)
        bounds = [0, *cuts.tolist(), b.num_rows]
        if held and all(held[-1].column(k)[-1].as_py() == c[0] for k, c in zip(key, cols)):
            held.append(b.slice(0, bounds[1]))
            bounds = bounds[1:]
        for lo, hi in zip(bounds, bounds[1:]):
            if held:
                yield pa.Table.from_batches(held)
            held = [b.slice(lo, hi - lo)]
    if held:
        yield pa.Table.from_batches(held)


def by_chunk(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole groups of rows sorted by key, a batch of them at a time, and where each begins (and the last one ends)."""

    def cuts(table) -> np.ndarray:
        cols = [np.asarray(table.column(k).to_numpy()) for k in key]
        return np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in cols])) + 1

    held: list[pa.RecordBatch] = []  # of one group that may go on
    for b in batches:
        if not b.num_rows:
            continue
        table = pa.Table.from_batches([*held, b])
        at = cuts(table)
        if len(at):
            last = int(at[-1])
            yield table.slice(0, last), np.append(np.concatenate([[0], at[:-1]]), last)
            table = table.slice(last)
        held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def pairs_of_small(bounds: np.ndarray, most: int = 32, at_once: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows inside groups of 2 to `most` rows, many groups at once."""
    size = np.diff(bounds)
    for s in np.unique(size[(size > 1) & (size <= most)]).tolist():
        starts, (i, j) = bounds[:-1][size == s], np.triu_indices(s, 1)
        step = max(1, at_once // len(i))
        for lo in range(0, len(starts), step):
            yield (starts[lo : lo + step, None] + i).ravel(), (starts[lo : lo + step, None] + j).ravel()


def spanning(chunk: pa.Table, bounds: np.ndarray, alive: Callable, of_large: Callable, most: int = 32) -> Iterator[pa.RecordBatch]:
    """The links of all groups of a chunk as (cid, smallest cid it is linked to in its group), a row per class and group at most.

    Rows have cid, block, lo, hi. alive(rows in order, left, right) says which pairs of small groups are linked;
    of_large(group) yields linked pairs of a larger one, both after rows are ordered by cid inside groups.
    """
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    chunk = chunk.take(pa.array(np.lexsort((chunk.column("cid").to_numpy(), group)))).combine_chunks()
    cid, block = chunk.column("cid").to_numpy(), chunk.column("block").to_numpy()
    across = chunk.column("lo").to_numpy() != chunk.column("hi").to_numpy()
    links = [(np.empty(0, int), np.empty(0, int))]
    test = alive(chunk)
    for left, right in pairs_of_small(bounds, most):
        meet = ~across[left] | (block[left] != block[right])
        left, right = left[meet], right[meet]
        good = test(left, right)
        links.append((left[good], right[good]))
    for k in np.flatnonzero(np.diff(bounds) > most).tolist():
        lo, hi = int(bounds[k]), int(bounds[k + 1])
        root = np.arange(hi - lo)
        for left, right in of_large(chunk.slice(lo, hi - lo), lambda: root):  # noqa: B023
            if len(left):
                every = np.arange(len(root))
                root = roots(len(root), np.concatenate([left, every]), np.concatenate([right, root]))
        got = np.flatnonzero(root != np.arange(len(root)))
        links.append((got + lo, root[got] + lo))
    left, right = (np.concatenate(x) for x in zip(*links))
    root = roots(len(cid), left, right)
    got = np.flatnonzero(root != np.arange(len(root)))
    if len(got):
        yield pa.RecordBatch.from_arrays([pa.array(cid[got]), pa.array(cid[root[got]])], names=["a", "b"])


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of n items the smallest item it is linked to, through any number of links (left[i], right[i])."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        was = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, was[left], low)
        np.minimum.at(root, was[right], low)
        root = root[root]
        if (root[left] == root[right]).all() and (root == root[root]).all():
            break
    return root


def run_chunks(rows: DataFrame, key: list[str], n: int, work: Callable, schema: str) -> DataFrame:
    """work(whole groups as a Table, their bounds) yields RecordBatches; groups are dealt to n tasks by key."""

    def run(batches):
        for chunk, bounds in by_chunk(batches, key):
            yield from work(chunk, bounds)

    return rows.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, schema)


def run_groups(rows: DataFrame, key: list[str], n: int, work: Callable, schema: str) -> DataFrame:
    """work(group as a Table) yields RecordBatches; groups are dealt to n tasks by key."""

    def run(batches):
        for group in by_group(batches, key):
            yield from work(group)

    return rows.repartition(n, *key).sortWithinPartitions(*key).mapInArrow(run, schema)


def spread_join(rows: DataFrame, table: DataFrame, key: list[str], size: str, most: int = 200_000, hot_keys: int = 100_000) -> DataFrame:
    """rows joined (inner) to table, which has one row per key and in `size` how many rows have it.

    Rows of a key that has over `most` are dealt to ceil(size / most) salts, and its row of the table goes to each. The
    hot keys, which are broadcast, number at most hot_keys: `most` grows with the sum of sizes.
    """
    total = table.agg(F.sum(size)).head()[0] or 0
    most = max(most, total // hot_keys)
    salts = F.ceil(F.col(size) / most).cast("int")
    hot = F.broadcast(table.where(F.col(size) > most).select(*key, salts.alias("__salts")))
    dealt = rows.join(hot, key, "left").withColumn("__salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("__salts", F.lit(1))).cast("int")).drop("__salts")
    spread = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.join(spread, [*key, "__salt"]).drop("__salt")
