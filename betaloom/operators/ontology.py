"""Terms that inherit from other terms: transitive closure, cycles, and genes of a term's descendants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.operators.order import numbered
from betaloom.sources.scratch import materialize, release


def closure(edges: DataFrame, *, child_col: str = "child", parent_col: str = "parent") -> DataFrame:
    """(term, ancestor, distance): every pair joined by a path of parents, with the fewest steps; (t, t) only where t is on a cycle.

    The longest distance doubles in each round, so the rounds grow with the logarithm of the longest path: a shortest path
    of more than `step` and up to twice as many steps passes a term exactly `step` above its lower end, so only the pairs
    at that distance are joined, with all that are known, and none is left to join once no pair is that far apart. Rows with
    a null end are left out, repeated edges count once, an empty table gives no rows. Every round is written to the shared
    folder; nothing but one number reaches the driver. Paths go on from their upper end, and what lies above a term is few,
    so no key meets a third of all rows on both sides.
    """
    now = edges.where(F.col(child_col).isNotNull() & F.col(parent_col).isNotNull()).select(F.col(child_col).alias("term"), F.col(parent_col).alias("ancestor"), F.lit(1).alias("distance")).distinct()
    now, step = materialize(now, "closure"), 1
    while not (far := now.where(F.col("distance") == step).select("term", "ancestor")).isEmpty():
        ahead = now.select(F.col("term").alias("ancestor"), F.col("ancestor").alias("above"), F.col("distance").alias("more"))
        longer = far.join(ahead.hint("merge"), "ancestor").select("term", F.col("above").alias("ancestor"), (F.col("more") + step).alias("distance"))
        after = materialize(now.unionByName(longer).groupBy("term", "ancestor").agg(F.min("distance").alias("distance")), "closure")
        release(now)
        now, step = after, 2 * step
    return now


def cycles(closed: DataFrame) -> DataFrame:
    """(term, distance): terms that are their own ancestor, and the length of the shortest way round; none in a proper hierarchy."""
    return closed.where(F.col("term") == F.col("ancestor")).select("term", "distance")


def with_ancestors(annotations: DataFrame, closed: DataFrame, *, term_col: str = "term", member_col: str = "gene") -> DataFrame:
    """annotations (member, term), each also for all ancestors of its term, once each. Terms that the closure lacks keep their own rows."""
    own = annotations.select(member_col, term_col).distinct()
    above = own.join(closed.select(F.col("term").alias(term_col), "ancestor"), term_col).select(member_col, F.col("ancestor").alias(term_col))
    return own.unionByName(above).distinct()


def term_sizes(annotations: DataFrame, closed: DataFrame, *, term_col: str = "term", member_col: str = "gene") -> DataFrame:
    """(term, n_direct, n_members): members annotated with the term itself, and with it or any descendant."""
    direct = annotations.select(member_col, term_col).distinct().groupBy(term_col).agg(F.count(F.lit(1)).alias("n_direct"))
    every = with_ancestors(annotations, closed, term_col=term_col, member_col=member_col).groupBy(term_col).agg(F.count(F.lit(1)).alias("n_members"))
    return every.join(direct, term_col, "left").select(term_col, F.coalesce("n_direct", F.lit(0)).alias("n_direct"), "n_members")


def member_counts(annotations: DataFrame, edges: DataFrame, *, term_col: str = "term", member_col: str = "gene", child_col: str = "child", parent_col: str = "parent") -> DataFrame:
    """term_sizes() from the edges, without the closure and without a row per member and ancestor; null members do not count.

    Members are numbered, and those of a term are bits of words of 64, so a member that reaches a term by several paths
    costs nothing twice. A round doubles the distance that members have come up: each term adds what the terms exactly
    `step` below it hold. It ends once no path is that long or, where terms lie on cycles, once no term gains a member.
    Every round is written to the shared folder; two numbers a round reach the driver.
    """
    pairs = annotations.select(F.col(member_col).alias("member"), F.col(term_col).alias("term"))
    numbers = numbered(pairs.where("member is not null").select("member").distinct(), [F.col("member")], name="n")
    bits = pairs.join(numbers, "member", "left").selectExpr("term", "(n - 1) div 64 word", "shiftleft(1L, cast((n - 1) % 64 as int)) bits")
    own = materialize(bits.groupBy("term", "word").agg(F.bit_or("bits").alias("bits")), "members")
    ways = edges.where(F.col(child_col).isNotNull() & F.col(parent_col).isNotNull()).select(F.col(child_col).alias("child"), F.col(parent_col).alias("parent")).distinct()
    held, ways, size = own, materialize(ways, "ways"), None
    while not ways.isEmpty():
        below = held.join(ways.hint("merge"), F.col("term") == F.col("child")).select(F.col("parent").alias("term"), "word", "bits")
        after = materialize(held.unionByName(below).groupBy("term", "word").agg(F.bit_or("bits").alias("bits")), "members")
        if held is not own:
            release(held)
        held, before, size = after, size, tuple(after.agg(F.count(F.lit(1)), F.sum(F.bit_count("bits"))).head())
        if size == before:
            break
        on = ways.select(F.col("child").alias("parent"), F.col("parent").alias("above"))
        longer = materialize(ways.join(on.hint("merge"), "parent").select("child", F.col("above").alias("parent")).distinct(), "ways")
        release(ways)
        ways = longer
    both = own.select("term", F.bit_count("bits").alias("d"), F.lit(0).alias("m")).unionByName(held.select("term", F.lit(0).alias("d"), F.bit_count("bits").alias("m")))
    return both.groupBy(F.col("term").alias(term_col)).agg(F.coalesce(F.sum("d"), F.lit(0)).alias("n_direct"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_members"))
