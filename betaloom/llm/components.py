"""Connected components by alternating large-star and small-star steps; nothing but counts reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, release

SALTS, PER_SALT = 32, 500_000


def _lowest(rows: DataFrame, own: bool, salts: int = SALTS) -> DataFrame:
    """rows (u, v) with m, the smallest v of the same u (or u itself, with own), and s, a salt of v.

    Nodes with very many neighbours are dealt by (u, s): the minimum is taken per salt, then over a node's salts.
    """
    rows = rows.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
    part = rows.groupBy("u", "s").agg(F.min("v").alias("m"))
    low = part.groupBy("u").agg(F.min("m").alias("low"))
    low = part.select("u", "s").join(low, "u").select("u", "s", (F.least("low", "u") if own else F.col("low")).alias("m"))
    return rows.join(low, ["u", "s"])


def connected_components(edges: DataFrame) -> DataFrame:
    """edges (a long, b long) to (node, component), the smallest node reachable; nodes without edges are absent.

    Loops, repeated and reversed edges do no harm; an empty table gives no rows. Every round is written to the shared
    folder; the number of rounds grows with the logarithm of the longest path. A hub's neighbours are dealt to so many
    salts that a task gets some PER_SALT of them at most, however many links there are.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    mark = F.struct(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"))
    seen = now.agg(mark).head()[0]
    while seen["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        salts = max(SALTS, seen["n"] // PER_SALT)
        large = _lowest(both, True, salts).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large, "large-star")
        low = _lowest(large, False, salts)
        small = low.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.where("v = m").select("u", "v")).distinct()
        after = materialize(small, "small-star")
        got = after.agg(mark).head()[0]
        release(large)
        release(now)
        now = after
        if got == seen:
            break
        seen = got
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).groupBy("node").agg(F.min("component").alias("component"))
