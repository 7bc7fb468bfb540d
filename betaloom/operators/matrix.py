"""The long site-by-sample relation (sample_id, chrom, pos, cpg_id, beta) and its coverage and value statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.functions.ids import is_site_id, present, site_chrom, site_order, site_pos


def long_matrix(wide: DataFrame, sample_col: str = "sample_id", sites: list[str] | None = None) -> DataFrame:
    """Unpivot a wide matrix to (sample_id, chrom, pos, cpg_id, beta). Columns that are no site ids are left out."""
    import re

    from betaloom.functions.ids import SITE_ID

    names = [c for c in (sites or wide.columns) if c != sample_col and re.match(SITE_ID, c)]
    long = wide.select(F.col(sample_col).cast("string").alias("sample_id"), F.explode(F.array(*[F.struct(F.lit(c).alias("cpg_id"), F.col(f"`{c}`").try_cast("float").alias("beta")) for c in names])).alias("cell"))
    cell = F.col("cell.cpg_id")
    return long.select("sample_id", site_chrom(cell).alias("chrom"), site_pos(cell).alias("pos"), cell.alias("cpg_id"), present("cell.beta").cast("float").alias("beta"))


def wide_matrix(features: DataFrame, samples: list[str], feature_col: str = "feature", sample_col: str = "sample_id", value_col: str = "value") -> DataFrame:
    """A row per feature, a column per sample, for the compatibility edge. The sample list spares a pass over the data."""
    return features.groupBy(feature_col).pivot(sample_col, samples).agg(F.first(value_col))


def coverage(beta: DataFrame, site_col: str = "cpg_id", value_col: str = "beta") -> DataFrame:
    """Per site n_present, n_total and coverage."""
    v = present(value_col)
    return beta.groupBy(site_col).agg(F.count(v).alias("n_present"), F.count(F.lit(1)).alias("n_total")).withColumn("coverage", F.coalesce(F.try_divide(F.col("n_present"), F.col("n_total")), F.lit(0.0)))


def coverage_filter(beta: DataFrame, min_coverage: float = 0.95, site_col: str = "cpg_id", value_col: str = "beta") -> DataFrame:
    """(site, coverage, kept): kept where coverage >= min_coverage."""
    return coverage(beta, site_col, value_col).select(site_col, "coverage", (F.col("coverage") >= min_coverage).alias("kept"))


def filter_sites(beta: DataFrame, min_coverage: float = 0.95, site_col: str = "cpg_id", value_col: str = "beta") -> DataFrame:
    """The cells of sites with enough coverage."""
    return beta.join(coverage_filter(beta, min_coverage, site_col, value_col).where("kept").select(site_col), site_col, "left_semi")


def site_stats(beta: DataFrame, site_col: str = "cpg_id", value_col: str = "beta") -> DataFrame:
    """Per site chromosome, position, mean_beta, variance (n - 1; 0 for one value, null for none), missingness, n_samples.

    Ids that are no sites get chromosome "unknown" and position 0.
    """
    v = present(value_col)
    agg = beta.groupBy(site_col).agg(F.avg(v).alias("mean_beta"), F.when(F.count(v) == 1, F.lit(0.0)).otherwise(F.var_samp(v)).alias("variance"), (1 - F.try_divide(F.count(v), F.count(F.lit(1)))).alias("missingness"), F.count(v).alias("n_samples"))
    return agg.select(site_col, F.coalesce(site_chrom(site_col), F.lit("unknown")).alias("chromosome"), F.coalesce(site_pos(site_col), F.lit(0)).alias("position"), "mean_beta", "variance", "missingness", "n_samples")


def variable_sites(stats: DataFrame, min_variance: float = 0.01, min_coverage: float = 0.5) -> DataFrame:
    return stats.where((F.col("variance") >= min_variance) & (F.col("missingness") <= 1 - min_coverage))


def chromosome_histogram(sites: DataFrame, site_col: str = "cpg_id") -> DataFrame:
    """Distinct sites per chromosome; ids that are no sites are skipped."""
    return sites.where(is_site_id(site_col)).select(site_col).distinct().groupBy(site_chrom(site_col).alias("chrom")).agg(F.count(F.lit(1)).alias("n_sites"))


def dataset_stats(beta: DataFrame, site_col: str = "cpg_id", value_col: str = "beta", sample_col: str = "sample_id", cuts: tuple[float, ...] = (0.95, 0.9, 0.8, 0.5)) -> DataFrame:
    """One row: n_samples, n_sites, total_nulls, null_fraction and the number of sites at each coverage cut."""
    cov = coverage(beta, site_col, value_col)
    at = [F.count_if(F.col("coverage") >= c).alias(f"n_cov_{int(c * 100)}") for c in cuts]
    sums = cov.agg(F.count(F.lit(1)).alias("n_sites"), (F.sum("n_total") - F.sum("n_present")).alias("total_nulls"), F.try_divide(F.sum("n_total") - F.sum("n_present"), F.sum("n_total")).alias("null_fraction"), *at)
    samples = beta.agg(F.count_distinct(sample_col).alias("n_samples"))  # one row
    return sums.withColumn("k", F.lit(1)).join(samples.withColumn("k", F.lit(1)), "k").drop("k")


def value_stats(beta: DataFrame, n_sites: int = 100, site_col: str = "cpg_id", value_col: str = "beta") -> DataFrame:
    """Mean, median and standard deviation (population) over the first n_sites sites in site order."""
    first = beta.select(site_col).distinct().orderBy(*site_order(site_col)).limit(n_sites)
    v = present(value_col)
    return beta.join(F.broadcast(first), site_col, "left_semi").agg(F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"))


def select_sites(beta: DataFrame, sites: DataFrame | list[str], site_col: str = "cpg_id") -> DataFrame:
    """Cells of the listed sites; unknown and malformed ids are dropped. For a few sites of a store see site_store.read_sites."""
    if isinstance(sites, list):
        sites = beta.sparkSession.createDataFrame([(s,) for s in sites], f"{site_col} string")
    return beta.join(sites.where(is_site_id(site_col)).select(site_col).distinct(), site_col, "left_semi")
