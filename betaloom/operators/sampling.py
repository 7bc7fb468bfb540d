"""Stratified subsets of sites and samples, reproducible from a seed: about n rows by rounded shares, or exactly n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from betaloom.operators.order import numbered
from betaloom.sources.scratch import materialize


def stratified(rows: DataFrame, n: int, *, stratum_col: str, key_col: str, least: int = 1, seed: int = 42) -> DataFrame:
    """About n rows, each stratum by its share: the rows with the smallest seeded hash of their key.

    Distributed: only stratum sizes (one row per chromosome or category) reach the driver. Shares are rounded half to
    even, and no stratum gives fewer than min(least, its size), so the total can differ from n by the rounding. Rows whose
    hash is too large to be among those wanted, by ten standard deviations, are dropped before a stratum is sorted.
    """
    total = rows.groupBy().count().withColumnRenamed("count", "__total")
    sizes = rows.groupBy(stratum_col).agg(F.count(F.lit(1)).alias("__size")).withColumn("k", F.lit(1)).join(F.broadcast(total.withColumn("k", F.lit(1))), "k").drop("k")
    want = F.least(F.col("__size"), F.greatest(F.lit(least), F.bround(F.col("__size") * F.lit(float(n)) / F.col("__total")))).cast("long")
    sizes = sizes.withColumn("__want", want)
    share = (F.col("__want") + 10 * F.sqrt("__want") + 50) / F.col("__size")
    sizes = sizes.select(stratum_col, "__want", F.lower(F.lpad(F.hex(F.least(F.floor(share * 4294967296.0), F.lit(4294967295)).cast("long")), 8, "0")).alias("__most"))
    near = rows.withColumn("__hash", F.md5(F.concat_ws(":", F.col(key_col).cast("string"), F.lit(str(seed))))).join(F.broadcast(sizes), stratum_col).where(F.left("__hash", F.lit(8)) <= F.col("__most"))
    ranked = near.withColumn("__rank", F.row_number().over(Window.partitionBy(stratum_col).orderBy("__hash", key_col)))
    return ranked.where("__rank <= __want").drop("__rank", "__want", "__hash", "__most")


def _all() -> WindowSpec:
    """All strata, one row each."""
    return Window.partitionBy()


def _dealt(strata: DataFrame, amount: Column, weight: Column, name: str) -> DataFrame:
    """strata with `amount`, the same for all rows and at most the sum of weights, dealt by weight in whole parts.

    What rounding down leaves goes, one each, to the largest remainders, ties by stratum; none gets more than its weight.
    """
    rows = strata.withColumn("__amount", amount).withColumn("__weight", weight).withColumn("__whole", F.sum("__weight").over(_all()))
    rows = rows.withColumn(name, F.coalesce(F.expr("case when __whole > 0 then __amount * __weight div __whole end"), F.lit(0).cast("long")))
    rows = rows.withColumn("__rest", F.expr("case when __whole > 0 then __amount * __weight % __whole else 0 end")).withColumn("__left", F.col("__amount") - F.sum(name).over(_all()))
    nth = F.row_number().over(_all().orderBy(F.desc("__rest"), F.col("stratum").asc_nulls_last()))
    return rows.withColumn(name, F.col(name) + (nth <= F.col("__left")).cast("long")).drop("__amount", "__weight", "__whole", "__rest", "__left")


def quotas(sizes: DataFrame, n: int, least: int = 1) -> DataFrame:
    """(stratum, size, quota) from (stratum, size): whole numbers that sum to min(n, all rows).

    A stratum's quota is its share of n, rounded half to even, but no less than min(least, size). Where these sum to more
    than n, strata give back by what they have above that floor, and only if n is below all floors together do the floors
    give way; where they sum to less, the rest is dealt by how many rows strata have left. The null stratum has no share:
    it only fills. Decided on the strata alone, whose number bounds the work.
    """
    rows = sizes.select("stratum", F.col("size").cast("long").alias("size")).withColumn("want", F.least(F.lit(n).cast("long"), F.sum("size").over(_all())))
    named, known = F.sum(F.when(F.col("stratum").isNotNull(), F.col("size"))).over(_all()), F.col("stratum").isNotNull()
    share = F.bround(F.col("size") * F.col("want").cast("double") / named).cast("long")
    rows = rows.withColumn("floor", F.when(known, F.least("size", F.lit(least).cast("long"))).otherwise(F.lit(0).cast("long"))).withColumn("base", F.when(known, F.least("size", F.greatest("floor", share))).otherwise(F.lit(0).cast("long")))
    rows = rows.withColumn("over", F.sum("base").over(_all()) - F.col("want")).withColumn("above", F.sum(F.col("base") - F.col("floor")).over(_all()))
    back = F.greatest("over", F.lit(0))
    rows = _dealt(rows, F.least(back, F.col("above")), F.col("base") - F.col("floor"), "back")
    rows = _dealt(rows, F.greatest(F.col("over") - F.col("above"), F.lit(0)), F.col("floor"), "more_back")
    rows = _dealt(rows, F.greatest(-F.col("over"), F.lit(0)), F.col("size") - F.col("base"), "filled")
    return rows.select("stratum", "size", (F.col("base") - F.col("back") - F.col("more_back") + F.col("filled")).alias("quota"))


def stratified_exact(rows: DataFrame, n: int, *, stratum_col: str, key_col: str, least: int = 1, seed: int = 42) -> DataFrame:
    """Exactly min(n, all) rows: from each stratum as many as quotas() says, those with the smallest md5("key:seed").

    Rows are numbered over the whole table by stratum and hash (see order.numbered), so a stratum that holds most rows is
    no task of its own; rows whose hash is too large to be taken, by ten standard deviations, are left out before that.
    Rows of equal keys are rows of their own, taken in any order among themselves. Null strata only fill, see quotas().
    """
    sizes = rows.groupBy(F.col(stratum_col).alias("stratum")).agg(F.count(F.lit(1)).alias("size"))
    wanted = materialize(quotas(sizes, n, least), "quotas")
    share = F.least(F.lit(1.0), (F.col("quota") + 10 * F.sqrt("quota") + 50) / F.col("size"))
    bounds = wanted.where("quota > 0").select(F.col("stratum").alias("__stratum"), F.col("quota").alias("__quota"), F.lower(F.lpad(F.hex(F.least(F.floor(share * 4294967296.0), F.lit(4294967295)).cast("long")), 8, "0")).alias("__most"))
    hashed = rows.withColumn("__hash", F.md5(F.concat_ws(":", F.col(key_col).cast("string"), F.lit(str(seed)))))
    near = hashed.join(bounds, F.col(stratum_col).eqNullSafe(F.col("__stratum"))).where(F.left("__hash", F.lit(8)) <= F.col("__most")).drop("__most", "__stratum")
    ranked = numbered(near, [F.col(stratum_col), F.col("__hash"), F.col(key_col)], name="__n")
    first = ranked.groupBy(F.col(stratum_col).alias("__stratum")).agg(F.min("__n").alias("__first"))
    taken = ranked.join(first, F.col(stratum_col).eqNullSafe(F.col("__stratum"))).where(F.col("__n") - F.col("__first") < F.col("__quota"))
    return taken.select(*rows.columns)


def select_sites(sites: DataFrame, n: int, seed: int = 42, chromosomes: list[str] | None = None) -> DataFrame:
    """Exactly min(n, all) of the sites (cpg_id, chrom), distinct, by share of chromosome, at least one of each."""
    every = sites.select("cpg_id", "chrom").distinct()
    return stratified_exact(every.where(F.col("chrom").isin(chromosomes)) if chromosomes is not None else every, n, stratum_col="chrom", key_col="cpg_id", seed=seed)


def select_samples(samples: DataFrame, n: int, categories: DataFrame | None = None, *, least: int = 1, seed: int = 42) -> DataFrame:
    """Exactly min(n, all) of the samples (sample_id), distinct, with clinical_category: by share of category where they have one.

    categories: barcode, clinical_category; samples without one fill up, and are chosen alike when no sample has one.
    """
    every = samples.select("sample_id").distinct()
    known = categories.select(F.col("barcode").alias("sample_id"), "clinical_category").dropDuplicates(["sample_id"]) if categories is not None else None
    named = every.join(known, "sample_id", "left") if known is not None else every.withColumn("clinical_category", F.lit(None).cast("string"))
    return stratified_exact(named, n, stratum_col="clinical_category", key_col="sample_id", least=least, seed=seed)


def subset(beta: DataFrame, sites: DataFrame, samples: DataFrame) -> DataFrame:
    """The cells of chosen sites (cpg_id) and samples (sample_id)."""
    return beta.join(sites.select("cpg_id").distinct(), "cpg_id", "left_semi").join(samples.select("sample_id").distinct(), "sample_id", "left_semi")
