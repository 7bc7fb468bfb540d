"""What figures are drawn from: tables whose size depends on the figure, not on the number of points."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import present
from betaloom.operators.order import numbered


def violin_density(scores: DataFrame, *, value_col: str = "hms_count", group_col: str = "clinical_category", points: int = 64, bins: int = 256, cut: float = 2.0) -> DataFrame:
    """Per group a row for each of `points` places: n, q1, median, q3, bandwidth, at (from 0), x and density.

    A Gaussian kernel density: bandwidth is the group's standard deviation times n ** -0.2, values are counted in `bins`
    equal bins first, and the places reach `cut` bandwidths beyond the values. Groups without spread have one row with the
    value as x and no density; null values and null groups are left out. One aggregation gives all of a group's numbers.
    """
    rows = scores.select(F.col(group_col).alias("group"), present(value_col).alias("v")).where("group is not null and v is not null")
    stats = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"), F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"),
    )
    stats = stats.select("group", "n", "lo", "hi", *(F.col("q")[i].alias(c) for i, c in enumerate(("q1", "median", "q3"))), F.when(F.col("sd") > 0, F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bandwidth"))
    step = (F.col("hi") - F.col("lo")) / bins
    binned = rows.join(stats, "group").select("group", F.when(step > 0, F.least(F.floor((F.col("v") - F.col("lo")) / step), F.lit(bins - 1))).otherwise(F.lit(0)).alias("b"))
    counted = binned.groupBy("group", "b").agg(F.count(F.lit(1)).alias("c")).join(stats, "group")
    low, high = F.col("lo") - cut * F.col("bandwidth"), F.col("hi") + cut * F.col("bandwidth")
    places = counted.withColumn("at", F.explode(F.sequence(F.lit(0), F.when(F.col("bandwidth").isNotNull(), F.lit(points - 1)).otherwise(F.lit(0)))))
    places = places.withColumn("x", F.when(F.col("bandwidth").isNull(), F.col("lo")).otherwise(low + (high - low) * F.col("at") / (points - 1)))
    z = (F.col("x") - (F.col("lo") + (F.col("b") + 0.5) * step)) / F.col("bandwidth")
    density = F.sum(F.col("c") * F.exp(-z * z / 2)) / (F.first("n") * F.first("bandwidth") * 2.5066282746310002)
    per = places.groupBy("group", "at").agg(*(F.first(c).alias(c) for c in ("n", "q1", "median", "q3", "bandwidth", "x")), density.alias("density"))
    return per.select("group", "n", "q1", "median", "q3", "bandwidth", "at", "x", "density")


def extent(points: DataFrame, x: str, y: str) -> tuple[float, float, float, float]:
    """Least and largest x and y; (0, 1, 0, 1) without points."""
    r = points.agg(F.min(x).alias("a"), F.max(x).alias("b"), F.min(y).alias("c"), F.max(y).alias("d")).head()
    return (0.0, 1.0, 0.0, 1.0) if r["a"] is None else (float(r["a"]), float(r["b"]), float(r["c"]), float(r["d"]))


def grid_counts(points: DataFrame, x: str, y: str, kind: str, *, nx: int = 120, ny: int = 80, bounds: tuple[float, float, float, float] | None = None) -> DataFrame:
    """(kind, ix, iy, n): how many points of each kind fall in each of nx by ny cells of the bounds, the points' own if not given."""
    x0, x1, y0, y1 = bounds or extent(points, x, y)

    def cell(v: str, lo: float, hi: float, n: int):
        return F.lit(0) if hi <= lo else F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((F.col(v) - lo) / (hi - lo) * n).cast("int")))

    return points.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(kind).alias("kind"), cell(x, x0, x1, nx).alias("ix"), cell(y, y0, y1, ny).alias("iy")).agg(F.count(F.lit(1)).alias("n"))


def heatmap_bins(cells: DataFrame, n_columns: int = 200, *, group_col: str = "clinical_category", sample_col: str = "sample_id", feature_col: str = "gene", value_col: str = "z") -> DataFrame:
    """(feature, column, group, n_samples, value): a heat map's samples, in order of group and id, averaged into n_columns columns.

    A column holds samples of one group only: each group gets columns by its share, one at least, so there may be a few
    more than n_columns.
    """
    samples = cells.select(F.col(group_col).cast("string").alias("group"), sample_col).distinct()
    ordered = numbered(samples, [F.col("group"), F.col(sample_col)], name="nth")
    sizes = ordered.groupBy("group").agg(F.count(F.lit(1)).alias("size"), F.min("nth").alias("first"))
    total = F.sum("size").over(Window.partitionBy())  # a row per group
    sizes = sizes.withColumn("columns", F.greatest(F.lit(1), F.least(F.col("size"), F.round(F.col("size") * n_columns / total).cast("long"))))
    sizes = sizes.withColumn("offset", F.coalesce(F.sum("columns").over(Window.partitionBy().orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    dealt = ordered.join(sizes, "group").select("group", sample_col, (F.col("offset") + F.expr("(nth - first) * columns div size")).alias("column"))
    return cells.join(dealt.drop("group"), sample_col).join(dealt.select("column", "group").distinct(), "column").groupBy(F.col(feature_col).alias("feature"), "column", "group").agg(F.count_distinct(sample_col).alias("n_samples"), F.avg(value_col).alias("value"))
