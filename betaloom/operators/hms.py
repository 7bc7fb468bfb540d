"""Hypermethylation scores: how many genes of a sample exceed a quantile of the control samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.functions.ids import file_label, present

QUANTILES = (0.95, 0.99, 0.999)


def gene_thresholds(features: DataFrame, metadata: DataFrame, *, control: str = "Control", quantiles: tuple[float, ...] = QUANTILES, gene_col: str = "gene", sample_col: str = "sample_id", group_col: str = "clinical_category", value_col: str = "value") -> DataFrame:
    """(gene, quantile, threshold): exact linear quantiles over the control samples, all in one pass."""
    controls = metadata.where(F.col(group_col).cast("string") == control).select(sample_col).distinct()
    if controls.isEmpty():
        raise ValueError(f"no sample of group {control!r}")
    at = F.percentile(present(value_col), F.array(*[F.lit(q) for q in quantiles]))
    per = features.join(controls, sample_col, "left_semi").groupBy(gene_col).agg(at.alias("t"))
    return per.select(gene_col, F.explode(F.arrays_zip(F.array(*[F.lit(q) for q in quantiles]).alias("q"), F.col("t").alias("t"))).alias("z")).select(gene_col, F.col("z.q").alias("quantile"), F.col("z.t").alias("threshold"))


def score_samples(features: DataFrame, thresholds: DataFrame, *, gene_col: str = "gene", sample_col: str = "sample_id", value_col: str = "value") -> DataFrame:
    """(quantile, sample_id, hms_count): genes strictly above their threshold; samples without any are there with 0."""
    return features.join(thresholds, gene_col).groupBy("quantile", sample_col).agg(F.count_if(present(value_col) > F.col("threshold")).alias("hms_count"))


def with_groups(scores: DataFrame, metadata: DataFrame, *, sample_col: str = "sample_id", group_col: str = "clinical_category") -> DataFrame:
    return scores.join(metadata.select(sample_col, group_col), sample_col, "left")


def summarize(scores: DataFrame, group_col: str = "clinical_category") -> DataFrame:
    """Per quantile and group: n, mean, median and max of hms_count."""
    return scores.groupBy("quantile", group_col).agg(F.count(F.lit(1)).alias("n"), F.avg("hms_count").alias("mean"), F.median("hms_count").alias("median"), F.max("hms_count").alias("max"))


def digest(scores: DataFrame, group_col: str = "clinical_category") -> DataFrame:
    """Per quantile one text: group=mean with one digit, joined by "; " in group order."""
    means = scores.where(F.col(group_col).isNotNull()).groupBy("quantile", F.col(group_col).cast("string").alias("g")).agg(F.avg("hms_count").alias("m"))
    return means.groupBy("quantile").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("g", "m"))), lambda s: F.concat(s["g"], F.lit("="), F.call_function("format_number", s["m"], F.lit("0.0")))), "; ").alias("hms_summary"))


def run(features: DataFrame, metadata: DataFrame, out: str | None = None, *, quantiles: tuple[float, ...] = QUANTILES, control: str = "Control", **cols) -> tuple[DataFrame, DataFrame]:
    """(thresholds with a column per quantile, scores with groups); written as Parquet below out if given."""
    t = gene_thresholds(features, metadata, control=control, quantiles=quantiles, **cols)
    gene = cols.get("gene_col", "gene")
    wide = t.groupBy(gene).agg(*[F.max(F.when(F.col("quantile") == q, F.col("threshold"))).alias(f"q{q}") for q in quantiles])
    scores = with_groups(score_samples(features, t, gene_col=gene), metadata)
    if out:
        wide.write.mode("overwrite").parquet(f"{out}/gene_thresholds.parquet")
        for q in quantiles:
            scores.where(F.col("quantile") == q).drop("quantile").write.mode("overwrite").parquet(f"{out}/hms_scores_q{file_label(q)}.parquet")
    return wide, scores
