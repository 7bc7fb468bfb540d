"""Report sections and data of plots. Everything is a DataFrame; render_markdown() turns bounded sections into text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import percent, present
from betaloom.operators.compare import z_scores


def frequency(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    """Counts per value, largest first, ties by value."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), column)


def shares(df: DataFrame, column: str) -> DataFrame:
    """Counts per value and their percentage with one digit."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(column, "n", percent("n", F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("pct"))  # a row per value


def distinct_counts(mapping: DataFrame) -> DataFrame:
    """One row: n_rows, n_sites and n_genes (blank genes left out)."""
    return mapping.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("cpg_id").alias("n_sites"), F.count_distinct(F.when(F.col("gene_symbol") != "", F.col("gene_symbol"))).alias("n_genes"))


def comparison_summary(results: DataFrame) -> DataFrame:
    """One row: n_genes, n_nominal (p < 0.05) and n_significant."""
    return results.agg(F.count(F.lit(1)).alias("n_genes"), F.count_if(present("p_value") < 0.05).alias("n_nominal"), F.count_if("significant").alias("n_significant"))


def top_significant(results: DataFrame, n: int = 15, tie: str = "feature") -> DataFrame:
    return results.where("significant").orderBy(F.col("p_value").asc_nulls_last(), tie).limit(n)


def named(enrichment: DataFrame, names: DataFrame, *, id_col: str = "pathway", key: str = "pathway_id", name_col: str = "pathway_name", width: int | None = 60) -> DataFrame:
    """enrichment with display_name: the set's name, or its id, cut to width."""
    known = names.select(F.col(key).alias(id_col), F.col(name_col).alias("__name")).dropDuplicates([id_col])
    label = F.coalesce("__name", id_col)
    return enrichment.join(known, id_col, "left").withColumn("display_name", F.left(label, F.lit(width)) if width else label).drop("__name")


def volcano_points(results: DataFrame, q_threshold: float = 0.05, effect_threshold: float = 0.3) -> DataFrame:
    """feature, delta_mean, neg_log10_p and point_class; rows without p or delta are dropped.

    grey: not significant; red: q below its threshold; blue: and the effect reaches its own.
    """
    p, d, q = present("p_value"), present("delta_mean"), present("q_value")
    hit = F.coalesce(q < q_threshold, F.lit(False))
    kind = F.when(hit & (F.abs(d) >= effect_threshold), "blue").when(hit, "red").otherwise("grey")
    return results.where(p.isNotNull() & d.isNotNull()).select("feature", d.alias("delta_mean"), (-F.log10(F.greatest(p, F.lit(1e-300)))).alias("neg_log10_p"), kind.alias("point_class"))


def volcano_labels(points: DataFrame, n: int = 10) -> DataFrame:
    return points.withColumn("weight", F.col("neg_log10_p") * F.abs("delta_mean")).orderBy(F.desc("weight"), "feature").limit(n)


def dot_plot(enrichment: DataFrame, names: DataFrame, n: int = 20) -> DataFrame:
    """display_name, neg_log10_q, n_overlap and odds_ratio of the n sets with the smallest p."""
    best = enrichment.orderBy(F.col("p_value").asc_nulls_last(), "pathway").limit(n)
    return named(best, names, width=None).select("pathway", "display_name", (-F.log10(F.greatest(present("q_value"), F.lit(1e-300)))).alias("neg_log10_q"), "n_overlap", "odds_ratio")


def violin(scores: DataFrame, group_col: str = "clinical_category") -> DataFrame:
    return scores.where(F.col(group_col).isNotNull() & (F.col(group_col) != "excluded"))


def most_variable(features: DataFrame, n: int = 50, *, feature_col: str = "gene", value_col: str = "value") -> DataFrame:
    """(gene, variance) of the n genes with the largest population variance."""
    return features.groupBy(feature_col).agg(F.var_pop(present(value_col)).alias("variance")).orderBy(F.col("variance").desc_nulls_last(), feature_col).limit(n)


def heatmap(features: DataFrame, metadata: DataFrame, n: int = 50, *, genes: DataFrame | None = None, feature_col: str = "gene", sample_col: str = "sample_id", group_col: str = "clinical_category", value_col: str = "value") -> DataFrame:
    """(group, sample, gene, z) of the chosen or most variable genes, z-scored per gene and clipped at 3."""
    chosen = genes if genes is not None else most_variable(features, n, feature_col=feature_col, value_col=value_col)
    meta = metadata.where(F.col(group_col).isNotNull() & (F.col(group_col).cast("string") != "excluded")).select(sample_col, group_col)
    cells = features.join(F.broadcast(chosen.select(feature_col)), feature_col, "left_semi").join(meta, sample_col)
    return cells.select(group_col, sample_col, feature_col, z_scores(cells, [feature_col], present(value_col)).alias("z"))


def render_markdown(title: str, sections: list[tuple[str, DataFrame]], max_rows: int = 50) -> str:
    """A Markdown report; a section shows at most max_rows rows and says so if there are more."""
    out = [f"# {title}", ""]
    for name, df in sections:
        rows = df.limit(max_rows + 1).collect()
        more, rows = len(rows) > max_rows, rows[:max_rows]
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
        out += ["", f"The first {max_rows} rows; the table has more.", ""] if more else [""]
    return "\n".join(out)
