"""Numbers, running totals and chunks over a whole table in order, without ever holding the table in one task.

Rows are range-partitioned by the order and sorted inside partitions. One row per partition (its count, its totals, the
values at its bounds) goes to the driver, where what came before each partition is added up; that small table is
broadcast and shifts every row's place. A value whose rows fill several partitions keeps one rank: the number at which
its run began is carried over the bounds.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from betaloom.sources.scratch import materialize, shuffle_partitions

_OF = (1 << 33) - 1  # monotonically_increasing_id keeps a row's place in its partition in the lower 33 bits
_HOW: dict[str, tuple[Callable[[Column | str], Column], Callable]] = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, min), "max": (F.max, max)}


def placed(rows: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """rows with __part and __at (from 0 within it), written once in order. The last order columns should tell rows apart."""
    n = parts or shuffle_partitions(rows.sparkSession)
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    dealt = materialize(dealt, "ordered")
    return dealt.select("*", F.shiftright("__place", 33).cast("int").alias("__part"), F.col("__place").bitwiseAND(F.lit(_OF)).alias("__at")).drop("__place")


def _shifted(rows: DataFrame, table: list[tuple], schema: str) -> DataFrame:
    """rows with the columns of a table that has one row per partition."""
    return rows.join(F.broadcast(rows.sparkSession.createDataFrame(table, f"__part int, {schema}")), "__part")


def numbered(rows: DataFrame, order: list[Column], *, name: str = "n", tie: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """rows with a number from 1 in the order, over the whole table.

    With `tie`, columns that lead the order, rows of equal values share the number of their first one (a competition
    rank), however many partitions they fill; nulls are equal to each other. An empty table gives no rows. Without it
    rows that the order does not tell apart get different numbers in any order.
    """
    own = rows.columns
    at = placed(rows, order, parts)
    if not tie:
        counts = {r["__part"]: r["c"] for r in at.groupBy("__part").agg(F.count(F.lit(1)).alias("c")).collect()}  # a row per partition
        keys = sorted(counts)
        before = list(itertools.accumulate((counts[k] for k in keys), initial=0))
        return _shifted(at, list(zip(keys, before)), "__before long").select(*own, (F.col("__before") + F.col("__at") + 1).alias(name))
    at = at.withColumn("__v", F.xxhash64(F.struct(*(F.struct(F.col(c).isNull().alias("no"), F.col(c).alias("v")) for c in tie))))
    run = Window.partitionBy("__part", *tie)
    at = at.withColumn("__first", F.min("__at").over(run))
    stats = at.groupBy("__part").agg(F.count(F.lit(1)).alias("c"), F.min_by("__v", "__at").alias("head"), F.max_by("__v", "__at").alias("tail"), F.max("__first").alias("last")).orderBy("__part").collect()  # a row per partition
    table, before, begun, tail = [], 0, 0, None
    for s in stats:
        carried = begun if s["head"] == tail else before
        table.append((s["__part"], before, carried, s["head"]))
        begun = carried if s["last"] == 0 else before + s["last"]
        before, tail = before + s["c"], s["tail"]
    shifted = _shifted(at, table, "__before long, __carried long, __head long")
    first = F.when((F.col("__v") == F.col("__head")) & (F.col("__first") == 0), F.col("__carried")).otherwise(F.col("__before") + F.col("__first"))
    return shifted.select(*own, (first + 1).alias(name))


def running(rows: DataFrame, order: list[Column], totals: dict[str, tuple[str, str]], *, name: str = "n", parts: int | None = None) -> DataFrame:
    """rows with a number from 1 and, for each {new column: (column, "sum", "min" or "max")}, its total up to and with the row.

    Nulls are passed over; until the first value a total is null. Sums of doubles are added in order inside partitions.
    """
    own = rows.columns
    at = placed(rows, order, parts)
    up = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    stats = at.groupBy("__part").agg(F.count(F.lit(1)).alias("__c"), *(_HOW[how][0](F.col(c)).alias(new) for new, (c, how) in totals.items())).orderBy("__part").collect()  # a row per partition
    table, before, held = [], 0, dict.fromkeys(totals)
    for s in stats:
        table.append((s["__part"], before, *held.values()))
        before += s["__c"]
        for new, (_, how) in totals.items():
            got = [v for v in (held[new], s[new]) if v is not None]
            held[new] = _HOW[how][1](*got) if len(got) == 2 else got[0] if got else None
    kinds = {f.name: f.dataType.simpleString() for f in at.groupBy().agg(*(_HOW[how][0](F.col(c)).alias(new) for new, (c, how) in totals.items())).schema}
    shifted = _shifted(at, table, ", ".join(["__before long", *(f"`__{new}` {kinds[new]}" for new in totals)]))

    def joined(new: str, c: str, how: str) -> Column:
        mine, carried = _HOW[how][0](F.col(c)).over(up), F.col(f"__{new}")
        both = mine + carried if how == "sum" else F.least(mine, carried) if how == "min" else F.greatest(mine, carried)
        return F.when(mine.isNull(), carried).when(carried.isNull(), mine).otherwise(both).alias(new)

    return shifted.select(*own, (F.col("__before") + F.col("__at") + 1).alias(name), *(joined(new, c, how) for new, (c, how) in totals.items()))


def chunked(rows: DataFrame, order: list[Column], size: int, *, name: str = "chunk", parts: int | None = None) -> DataFrame:
    """rows with a chunk number from 0: in order, `size` rows in each chunk but the last."""
    own = rows.columns
    return numbered(rows, order, name="__n", parts=parts).select(*own, F.expr(f"(__n - 1) div {int(size)}").cast("long").alias(name))
