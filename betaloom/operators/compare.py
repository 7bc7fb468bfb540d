"""Two-group comparisons per feature: means, effect sizes, rank and distribution tests, false-discovery control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import present
from betaloom.functions.special import ks_p, mwu_exact_p, normal_sf, student_p
from betaloom.sources.scratch import materialize

DEFAULT_CONTRASTS = [("CRC", "Control"), ("polyps", "Control"), ("CRC", "polyps")]
FDR_METHODS = ("fdr_bh", "fdr_by", "bonferroni", "holm")
TESTS = ("mannwhitneyu", "ttest", "ks")


def labelled(matrix: DataFrame, metadata: DataFrame, contrasts: list[tuple[str, str]], *, feature_col: str = "feature", sample_col: str = "sample_id", group_col: str = "clinical_category", value_col: str = "value", meta_sample_col: str | None = None) -> DataFrame:
    """(label, feature, first, value): the cells of each contrast, first telling its first group; missing values dropped."""
    spark = matrix.sparkSession
    sides = spark.createDataFrame([(f"{a}_vs_{b}", g, g == a) for a, b in contrasts for g in (a, b)], "label string, grp string, first boolean")
    meta = metadata.select(F.col(meta_sample_col or sample_col).alias(sample_col), F.col(group_col).cast("string").alias("grp")).join(F.broadcast(sides), "grp").drop("grp")
    return matrix.select(F.col(feature_col).alias("feature"), sample_col, present(value_col).alias("value")).join(meta, sample_col).where("value is not null").select("label", "feature", "first", "value")


def _effects(agg: DataFrame) -> DataFrame:
    pooled = F.sqrt(F.try_divide((F.col("n1") - 1) * F.col("var1") + (F.col("n2") - 1) * F.col("var2"), F.col("n1") + F.col("n2") - 2))
    delta = F.col("mean_group1") - F.col("mean_group2")
    d = F.when((F.col("n1") < 2) | (F.col("n2") < 2) | (pooled == 0), F.lit(0.0)).otherwise(F.try_divide(delta, pooled))
    return agg.select("*", delta.alias("delta_mean"), d.alias("cohens_d"))


def effect_sizes(cells: DataFrame) -> DataFrame:
    """Per (label, feature): n1, n2, mean_group1, mean_group2, delta_mean, cohens_d and the variances."""
    one, two = F.when(F.col("first"), F.col("value")), F.when(~F.col("first"), F.col("value"))
    return _effects(cells.groupBy("label", "feature").agg(F.count(one).alias("n1"), F.count(two).alias("n2"), F.avg(one).alias("mean_group1"), F.avg(two).alias("mean_group2"), F.var_samp(one).alias("var1"), F.var_samp(two).alias("var2")))


def contrast_effects(matrix: DataFrame, metadata: DataFrame, contrasts: list[tuple[str, str]], *, feature_col: str = "feature", sample_col: str = "sample_id", group_col: str = "clinical_category", value_col: str = "value", meta_sample_col: str | None = None) -> DataFrame:
    """effect_sizes() of all contrasts from the moments of each (group, feature): a cell is read once, in however many contrasts its group is."""
    spark = matrix.sparkSession
    sides = spark.createDataFrame([(f"{a}_vs_{b}", g, g == a) for a, b in contrasts for g in (a, b)], "label string, grp string, first boolean")
    wanted = [g for c in contrasts for g in c]
    meta = metadata.select(F.col(meta_sample_col or sample_col).alias(sample_col), F.col(group_col).cast("string").alias("grp")).where(F.col("grp").isin(wanted))
    cells = matrix.select(F.col(feature_col).alias("feature"), sample_col, present(value_col).alias("value")).join(meta, sample_col).where("value is not null")
    moments = cells.groupBy("grp", "feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.var_samp("value").alias("var"))
    of = lambda side, c: F.max(F.when(F.col("first") if side == 1 else ~F.col("first"), F.col(c)))
    rows = moments.join(F.broadcast(sides), "grp").groupBy("label", "feature")  # sides: two rows a contrast
    return _effects(rows.agg(F.coalesce(of(1, "n"), F.lit(0)).alias("n1"), F.coalesce(of(2, "n"), F.lit(0)).alias("n2"), *[of(k, c).alias(f"{name}{k}") for c, name in (("mean", "mean_group"), ("var", "var")) for k in (1, 2)]))


def mann_whitney(cells: DataFrame) -> DataFrame:
    """Per (label, feature): statistic (U of the first group), z and p_value of the two-sided test.

    Exact when the smaller group has at most 8 values and there are no ties, else normal with tie and continuity
    correction. Fewer than two values on a side give nulls.
    """
    # one sort per feature: ranks of ties are shared through counts of equal values
    counts = cells.groupBy("label", "feature", "value").agg(F.count_if("first").alias("a"), F.count(F.lit(1)).alias("t"))
    below = Window.partitionBy("label", "feature").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("rank", F.coalesce(F.sum("t").over(below), F.lit(0)) + (F.col("t") + 1) / 2.0)
    agg = ranked.groupBy("label", "feature").agg(F.sum(F.col("a") * F.col("rank")).alias("r1"), F.sum("a").alias("n1"), (F.sum("t") - F.sum("a")).alias("n2"), F.sum(F.expr("cast(t as double) * t * t - t")).alias("ties"))
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    u1 = F.col("r1") - n1 * (n1 + 1) / 2
    n = n1 + n2
    s = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.coalesce(F.try_divide(F.col("ties"), n * (n - 1)), F.lit(0.0))))
    z = F.try_divide(F.greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5, s)
    enough = (F.col("n1") >= 2) & (F.col("n2") >= 2)
    out = agg.select("label", "feature", "n1", "n2", "ties", F.when(enough, u1).alias("statistic"), F.when(enough, z).alias("z"))
    exact = (F.least("n1", "n2") <= 8) & (F.col("ties") == 0) & F.col("statistic").isNotNull()
    asymptotic = F.when(F.col("statistic").isNotNull(), F.least(F.lit(1.0), F.coalesce(2 * normal_sf("z"), F.lit(1.0))))
    return out.withColumn("p_value", F.when(exact, mwu_exact_p(F.when(exact, F.col("statistic")), "n1", "n2")).otherwise(asymptotic)).drop("ties")


def welch(cells: DataFrame) -> DataFrame:
    """Per (label, feature): statistic, df and p_value of Welch's t test; nulls with fewer than two values on a side."""
    e = effect_sizes(cells)
    a, b = F.try_divide(F.col("var1"), F.col("n1")), F.try_divide(F.col("var2"), F.col("n2"))
    enough = (F.col("n1") >= 2) & (F.col("n2") >= 2)
    t = F.when(enough, F.try_divide(F.col("delta_mean"), F.sqrt(a + b)))
    df = F.when(enough, F.try_divide((a + b) * (a + b), a * a / (F.col("n1") - 1) + b * b / (F.col("n2") - 1)))
    return e.select("label", "feature", "n1", "n2", t.alias("statistic"), df.alias("df")).withColumn("p_value", student_p("statistic", "df"))


def kolmogorov_smirnov(cells: DataFrame) -> DataFrame:
    """Per (label, feature): the largest distance of the two distribution functions and its two-sided p_value."""
    counts = cells.groupBy("label", "feature", "value").agg(F.count_if("first").alias("a"), F.count_if(~F.col("first")).alias("b"))
    up = Window.partitionBy("label", "feature").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("label", "feature")
    steps = counts.select("label", "feature", F.sum("a").over(up).alias("ca"), F.sum("b").over(up).alias("cb"), F.sum("a").over(all_).alias("n1"), F.sum("b").over(all_).alias("n2"))
    gap = F.abs(F.try_divide(F.col("ca"), F.col("n1")) - F.try_divide(F.col("cb"), F.col("n2")))
    agg = steps.groupBy("label", "feature").agg(F.max(gap).alias("statistic"), F.max("n1").alias("n1"), F.max("n2").alias("n2"))
    return agg.withColumn("statistic", F.when((F.col("n1") >= 2) & (F.col("n2") >= 2), F.col("statistic"))).withColumn("p_value", ks_p("statistic", "n1", "n2"))


_RUN = {"mannwhitneyu": mann_whitney, "ttest": welch, "ks": kolmogorov_smirnov}


def compare(matrix: DataFrame, metadata: DataFrame, contrasts: list[tuple[str, str]], *, test: str = "mannwhitneyu", **cols) -> DataFrame:
    """All contrasts in one job: label, feature, means, delta_mean, cohens_d, statistic, p_value."""
    if test not in _RUN:
        raise ValueError(f"unknown test {test!r}: one of {TESTS}")
    cells = labelled(matrix, metadata, contrasts, **cols)
    tested = _RUN[test](cells).select("label", "feature", "statistic", "p_value")
    return contrast_effects(matrix, metadata, contrasts, **cols).join(tested, ["label", "feature"]).select("label", "feature", "mean_group1", "mean_group2", "delta_mean", "cohens_d", "statistic", "p_value")


def compare_groups(matrix: DataFrame, metadata: DataFrame, group1: str, group2: str, *, test: str = "mannwhitneyu", group_col: str = "clinical_category", **cols) -> DataFrame:
    """One contrast, sorted by p (missing last), then feature. ValueError if a group has no rows in metadata."""
    here = {r[0] for r in metadata.where(F.col(group_col).cast("string").isin(group1, group2)).select(F.col(group_col).cast("string")).distinct().collect()}  # two rows at most
    for g in (group1, group2):
        if g not in here:
            raise ValueError(f"no sample in group {g!r}")
    return compare(matrix, metadata, [(group1, group2)], test=test, group_col=group_col, **cols).drop("label").orderBy(F.col("p_value").asc_nulls_last(), "feature")


def harmonic(n: Column | str) -> Column:
    """1 + 1/2 + ... + 1/n: summed up to 100, by its asymptotic series beyond (to double precision)."""
    n = F.col(n) if isinstance(n, str) else n
    x = n.cast("double")
    few = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(n, F.lit(100)), F.lit(1)).cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / i)
    return F.when(n <= 100, few).otherwise(F.ln(x) + 0.57721566490153286 + 1 / (2 * x) - 1 / (12 * x * x) + 1 / (120 * x * x * x * x))


def adjust(results: DataFrame, method: str = "fdr_bh", alpha: float = 0.05, *, p_col: str = "p_value", by: list[str] | None = None, tie: str = "feature") -> DataFrame:
    """results with q_value and significant, within each group of `by` columns (none: over all rows).

    Missing p count as tests with p 1; their q stays null and they are not significant.
    """
    if method not in FDR_METHODS:
        raise ValueError(f"unknown method {method!r}: one of {FDR_METHODS}")
    by = by or []
    p = F.coalesce(present(p_col), F.lit(1.0))
    frame = results.withColumn("__p", p)
    n = F.count(F.lit(1)).over(Window.partitionBy(*by))
    frame = frame.withColumn("__n", n)
    if method == "bonferroni":
        q = F.col("__p") * F.col("__n")
    else:
        frame = frame.withColumn("__r", F.row_number().over(Window.partitionBy(*by).orderBy("__p", tie)))
        if method == "holm":
            up = Window.partitionBy(*by).orderBy("__r").rowsBetween(Window.unboundedPreceding, 0)
            q = F.max(F.col("__p") * (F.col("__n") - F.col("__r") + 1)).over(up)
        else:
            down = Window.partitionBy(*by).orderBy(F.desc("__r")).rowsBetween(Window.unboundedPreceding, 0)
            scale = harmonic("__n") if method == "fdr_by" else F.lit(1.0)
            frame = frame.withColumn("__s", scale)
            q = F.min(F.col("__p") * F.col("__n") * F.col("__s") / F.col("__r")).over(down)
    out = frame.withColumn("q_value", F.when(present(p_col).isNotNull(), F.least(F.lit(1.0), q)))
    return out.withColumn("significant", F.coalesce(F.col("q_value") <= alpha, F.lit(False))).drop("__p", "__n", "__r", "__s")


def adjust_large(results: DataFrame, method: str = "fdr_bh", alpha: float = 0.05, *, p_col: str = "p_value", by: list[str] | None = None) -> DataFrame:
    """q_value and significant as adjust() gives them, for families (groups of `by`, without nulls) too large for one task.

    Equal p are counted first. Each family is cut at quantiles of its p into 256 stretches; counts and extremes of the
    stretches, a few rows a family, give global ranks and carry the running minimum or maximum from one to the next.
    Rows and cuts are written once: means recomputed in another order differ in their last bits, and so do approximate
    quantiles, but every branch below must see the same p and the same stretches.
    """
    if method not in FDR_METHODS:
        raise ValueError(f"unknown method {method!r}: one of {FDR_METHODS}")
    frame = results.withColumn("__p", F.coalesce(present(p_col), F.lit(1.0))).withColumn("__all", F.lit(1))
    frame = materialize(frame, "adjust-rows")
    family = [*(by or []), "__all"]
    ties = frame.groupBy(*family, "__p").agg(F.count(F.lit(1)).alias("__c"))
    cuts = ties.groupBy(*family).agg(F.percentile_approx("__p", [i / 256 for i in range(1, 256)], 10_000).alias("__cuts"), F.sum("__c").alias("__n"))
    stretch = F.size(F.filter("__cuts", lambda e: e < F.col("__p")))
    ties = materialize(ties.join(cuts, family).withColumn("__s", stretch).drop("__cuts"), "adjust-ties")
    order = Window.partitionBy(*family).orderBy("__s")
    held = ties.groupBy(*family, "__s").agg(F.sum("__c").alias("__held"))
    held = held.withColumn("__before", F.coalesce(F.sum("__held").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__held")
    inside = Window.partitionBy(*family, "__s").orderBy("__p")
    last = F.col("__before") + F.sum("__c").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    ranked = ties.join(held, [*family, "__s"]).withColumn("__last", last)
    if method == "bonferroni":
        found = ranked.withColumn("__q", F.col("__p") * F.col("__n"))
    else:
        if method == "holm":
            x, best, ahead, way = F.col("__p") * (F.col("__n") - F.col("__last") + F.col("__c")), F.max, order, inside
        else:
            x = F.col("__p") * F.col("__n") * (harmonic("__n") if method == "fdr_by" else F.lit(1.0)) / F.col("__last")
            best, ahead, way = F.min, Window.partitionBy(*family).orderBy(F.desc("__s")), Window.partitionBy(*family, "__s").orderBy(F.desc("__p"))
        ranked = ranked.withColumn("__x", x)
        extremes = ranked.groupBy(*family, "__s").agg(best("__x").alias("__e"))
        extremes = extremes.withColumn("__carried", best("__e").over(ahead.rowsBetween(Window.unboundedPreceding, -1))).drop("__e")
        within = best("__x").over(way.rowsBetween(Window.unboundedPreceding, 0))
        carry = F.greatest if method == "holm" else F.least
        found = ranked.join(extremes, [*family, "__s"]).withColumn("__q", carry(within, F.col("__carried")))  # both skip nulls
    out = frame.join(found.select(*family, "__p", "__q"), [*family, "__p"])
    out = out.withColumn("q_value", F.when(present(p_col).isNotNull(), F.least(F.lit(1.0), "__q"))).withColumn("significant", F.coalesce(F.col("q_value") <= alpha, F.lit(False)))
    return out.select(*[c for c in results.columns if c not in ("q_value", "significant")], "q_value", "significant")


def run_all_comparisons(matrix: DataFrame, metadata: DataFrame, contrasts: list[tuple[str, str]] | None = None, *, test: str = "mannwhitneyu", fdr_method: str = "fdr_bh", alpha: float = 0.05, group_col: str = "clinical_category", large: bool = False, **cols) -> DataFrame:
    """Every contrast whose groups exist, each adjusted on its own: the columns of compare(), q_value, significant.

    large: a contrast has more features than one task should sort (some 100,000), see adjust_large; results are equal.
    """
    contrasts = contrasts or DEFAULT_CONTRASTS
    wanted = sorted({g for c in contrasts for g in c})
    here = {r[0] for r in metadata.where(F.col(group_col).cast("string").isin(wanted)).select(F.col(group_col).cast("string")).distinct().collect()}  # names of groups
    usable = [c for c in contrasts if set(c) <= here]
    found = compare(matrix, metadata, usable, test=test, group_col=group_col, **cols)
    return (adjust_large if large else adjust)(found, fdr_method, alpha, by=["label"])


def z_scores(cells: DataFrame, by: list[str], value: Column, clip: float = 3.0) -> Column:
    """(x - mean) / population deviation within `by`; deviation 0 counts as 1, missing as 0, clipped."""
    w = Window.partitionBy(*by)
    sd = F.stddev_pop(value).over(w)
    z = (value - F.avg(value).over(w)) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
    return F.greatest(F.lit(-clip), F.least(F.lit(clip), F.coalesce(z, F.lit(0.0))))
