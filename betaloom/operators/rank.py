"""Candidate ranking at site, gene and pathway level, and the consolidated report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import present

LEAST_Q = 1e-300


def strength(q: Column | str) -> Column:
    """-log10 of q, where a missing, zero or negative q counts as the least."""
    q = present(q)
    return -F.log10(F.when(q > 0, F.greatest(q, F.lit(LEAST_Q))).otherwise(F.lit(LEAST_Q)))


def top(df: DataFrame, score: str, n: int, tie: str) -> DataFrame:
    """The n best rows by score (null last), ties by `tie`: a top-k plan, not a full sort."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(tie)).limit(n)


def rank_sites(results: DataFrame, n: int = 100, *, id_col: str = "feature", effect_col: str = "delta_mean", q_col: str = "q_value", annotations: DataFrame | None = None, annotation_id: str = "cpg_id") -> DataFrame:
    """cpg_id, effect_size, q_value and score = |effect| * -log10 q of the n best, left-joined to annotations."""
    out = results.select(F.col(id_col).alias("cpg_id"), present(effect_col).alias("effect_size"), present(q_col).alias("q_value"), (F.abs(present(effect_col)) * strength(q_col)).alias("score"))
    out = top(out, "score", n, "cpg_id")
    if annotations is None:
        return out
    # the annotations of n sites are picked first, so the table is read but not shuffled
    notes = annotations.withColumnRenamed(annotation_id, "cpg_id").join(F.broadcast(out.select("cpg_id")), "cpg_id", "left_semi")
    return out.join(notes, "cpg_id", "left")


def enrichment_bonus(enrichment: DataFrame, q_col: str = "q_value", genes_col: str = "overlap_genes") -> DataFrame:
    """(gene, enrichment_bonus): the sum of -log10 q over the sets whose overlap holds the gene."""
    return enrichment.select(F.explode(genes_col).alias("gene"), strength(q_col).alias("s")).groupBy("gene").agg(F.sum("s").alias("enrichment_bonus"))


def rank_genes(results: DataFrame, enrichment: DataFrame | None = None, n: int = 50, *, id_col: str = "feature", effect_col: str = "cohens_d", q_col: str = "q_value", weight: float = 0.5) -> DataFrame:
    """gene, effect_size, q_value, carried delta_mean and significant, diff_score, enrichment_bonus, score: the n best."""
    carried = [c for c in ("delta_mean", "significant") if c in results.columns and c not in (effect_col, q_col)]
    out = results.select(F.col(id_col).alias("gene"), present(effect_col).alias("effect_size"), present(q_col).alias("q_value"), *carried, (F.abs(present(effect_col)) * strength(q_col)).alias("diff_score"))
    if enrichment is not None and "overlap_genes" in enrichment.columns:
        out = out.join(enrichment_bonus(enrichment), "gene", "left").withColumn("enrichment_bonus", F.coalesce("enrichment_bonus", F.lit(0.0)))
    else:
        out = out.withColumn("enrichment_bonus", F.lit(0.0))
    return top(out.withColumn("score", F.col("diff_score") + weight * F.col("enrichment_bonus")), "score", n, "gene")


def rank_pathways(enrichment: DataFrame, n: int = 20, *, id_col: str = "pathway", q_col: str = "q_value") -> DataFrame:
    """pathway, q_value, p_value, what there is of odds_ratio, nes, es, n_overlap, n_hits, and score: the n best.

    The score is |log2 odds| or |nes|, times -log10 q, or -log10 q alone. Odds that are zero, infinite or missing give
    a null score, which comes last.
    """
    have = [c for c in ("odds_ratio", "nes", "es", "n_overlap", "n_hits") if c in enrichment.columns]
    if "odds_ratio" in have:
        odds = present("odds_ratio")
        score = F.when((odds > 0) & (odds < float("inf")), F.abs(F.log2(odds)) * strength(q_col))
    elif "nes" in have:
        score = F.abs(present("nes")) * strength(q_col)
    else:
        score = strength(q_col)
    return top(enrichment.select(F.col(id_col).alias("pathway"), present(q_col).alias("q_value"), present("p_value").alias("p_value"), *have, score.alias("score")), "score", n, "pathway")


def gene_island_context(mapping: DataFrame, context: DataFrame) -> DataFrame:
    """(gene_symbol, cpg_island_status), a row per mapped site with a gene."""
    named = mapping.where("gene_symbol is not null and gene_symbol <> ''")
    return named.join(context.select("cpg_id", "context"), "cpg_id").select("gene_symbol", F.col("context").alias("cpg_island_status"))


def island_digest(pairs: DataFrame, gene_col: str = "gene_symbol", status_col: str = "cpg_island_status") -> DataFrame:
    """(gene, cpg_island_context): "status:count/total" by count descending, then status, joined by "; "."""
    counts = pairs.groupBy(gene_col, status_col).agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy(gene_col).agg(F.sum("n").alias("t"), F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(status_col).alias("s")))).alias("c"))
    return per.select(F.col(gene_col).alias("gene"), F.array_join(F.transform("c", lambda x: F.concat(x["s"], F.lit(":"), (-x["m"]).cast("string"), F.lit("/"), F.col("t").cast("string"))), "; ").alias("cpg_island_context"))


def pathway_lists(enrichment: DataFrame, *, id_col: str = "pathway", genes_col: str = "overlap_genes") -> DataFrame:
    """(gene, pathways): the sets whose overlap holds the gene, by p and name, joined by "; "."""
    rows = enrichment.select(F.explode(genes_col).alias("gene"), F.struct(F.coalesce(present("p_value"), F.lit(2.0)).alias("p"), F.col(id_col).alias("s")).alias("x"))
    return rows.groupBy("gene").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["s"]), "; ").alias("pathways"))


REPORT = "level string, identifier string, score double, effect_size double, q_value double, rank long, pathways string, cpg_island_context string, hms_summary string"


def report(sites: DataFrame | None = None, genes: DataFrame | None = None, pathways: DataFrame | None = None, *, enrichment: DataFrame | None = None, island_pairs: DataFrame | None = None, hms_summary: str | None = None) -> DataFrame:
    """The candidates of all levels in the columns of REPORT, ranked from 1 within each level."""
    parts = []

    def part(level: str, df: DataFrame, identifier: str, effect: Column) -> DataFrame:
        order = Window.partitionBy("level").orderBy(F.col("score").desc_nulls_last(), "identifier")
        rows = df.select(F.lit(level).alias("level"), F.col(identifier).cast("string").alias("identifier"), F.col("score").cast("double"), effect.cast("double").alias("effect_size"), F.col("q_value").cast("double"))
        return rows.withColumn("rank", F.row_number().over(order).cast("long"))

    blank = {c: F.lit("") for c in ("pathways", "cpg_island_context", "hms_summary")}
    if sites is not None:
        parts.append(part("cpg", sites, "cpg_id", F.col("effect_size")).withColumns(blank))
    if genes is not None:
        rows = part("gene", genes, "gene", F.col("effect_size")).withColumn("hms_summary", F.lit(hms_summary or ""))
        for name, table in (("pathways", pathway_lists(enrichment) if enrichment is not None and "overlap_genes" in enrichment.columns else None), ("cpg_island_context", island_digest(island_pairs) if island_pairs is not None else None)):
            rows = rows.withColumn(name, F.lit("")) if table is None else rows.join(table.withColumnRenamed("gene", "identifier"), "identifier", "left").withColumn(name, F.coalesce(name, F.lit("")))
        parts.append(rows)
    if pathways is not None:
        effect = F.col("odds_ratio") if "odds_ratio" in pathways.columns else F.col("nes") if "nes" in pathways.columns else F.lit(None)
        parts.append(part("pathway", pathways, "pathway", effect).withColumns(blank))
    names = [f.split()[0] for f in REPORT.split(", ")]
    if not parts:
        from pyspark.sql import SparkSession

        return SparkSession.active().createDataFrame([], REPORT)
    out = parts[0].select(names)
    for p in parts[1:]:
        out = out.unionByName(p.select(names))
    return out


def export_flags(sites: DataFrame, candidates: DataFrame, site_col: str = "cpg_id") -> DataFrame:
    """Site vertices with is_biomarker_candidate set for the candidates."""
    marked = candidates.select(site_col).distinct().withColumn("__hit", F.lit(True))
    return sites.drop("is_biomarker_candidate").join(marked, site_col, "left").withColumn("is_biomarker_candidate", F.coalesce("__hit", F.lit(False))).drop("__hit")
