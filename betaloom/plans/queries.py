"""Every operator as a query over the generic test tables.

The tables hold no methylation data, so adapters give them the shapes the operators want: vectors are samples and
their dimensions sites; parts are genes, features and sets; orders are points on chromosomes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions import ids
from betaloom.operators import clinical, compare, density, enrich, graph, hms, intervals, matrix, ontology, order, rank, report, rollup, sampling
from betaloom.sources import annotations as ann
from betaloom.sources import batches, beta_csv, scratch, site_store
from betaloom.sources import wide as wide_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
DIMS = 64


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def r(c: Column | str, digits: int = 6) -> Column:
    """c rounded alike in both engines; adding 0 takes the sign from a zero."""
    return F.round(ids.col(c), digits) + F.lit(0.0)


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r(c, digits) for c in cols})


# adapters


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """(sample_id, d, chrom, pos, cpg_id, beta): one in eleven values is missing."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_id"), F.posexplode("embedding").alias("d", "v"))
    chrom = F.concat(F.lit("chr"), F.expr("cast(d % 4 + 1 as string)"))
    e = e.select("sample_id", "d", chrom.alias("chrom"), F.expr("cast((d + 1) * 1000 as bigint)").alias("pos"), F.when(F.expr("(sample_id * 31 + d) % 11 <> 0"), F.col("v").cast("double")).alias("beta"))
    return e.withColumn("cpg_id", F.concat_ws("_", "chrom", F.col("pos").cast("string")))


def meta(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("label").cast("string").alias("clinical_category"))


def site_genes(spark: SparkSession) -> DataFrame:
    """(gene, cpg_id): blocks of four dimensions, and a second gene that cuts across them."""
    d = spark.range(DIMS).selectExpr("concat('chr', cast(id % 4 + 1 as string), '_', cast((id + 1) * 1000 as string)) cpg_id", "id")
    return d.selectExpr("concat('g', cast(id div 4 as string)) gene", "cpg_id").union(d.selectExpr("concat('g', cast((id * 7) % 16 as string)) gene", "cpg_id"))


def gene_sets(spark: SparkSession, name: str = "pathway") -> DataFrame:
    g = spark.range(DIMS // 4)
    return g.selectExpr(f"concat('p', cast(id % 5 as string)) {name}", "concat('g', cast(id as string)) gene").union(g.selectExpr(f"concat('p', cast((id * 3) % 5 as string)) {name}", "concat('g', cast(id as string)) gene"))


def gene_features(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.rollup_sites(cells(spark, sf), site_genes(spark), "mean")


def points(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").selectExpr("concat('chr', cast(o_orderkey % 3 + 1 as string)) chrom", "cast(o_orderkey * 2500 + 1 as bigint) pos")
    return o.withColumn("cpg_id", F.concat_ws("_", "chrom", F.col("pos").cast("string")))


def genes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr(
        "concat('ENSG', cast(p_partkey as string)) gene_id", "concat('S', cast(p_partkey as string)) gene_symbol", "concat('chr', cast(p_partkey % 3 + 1 as string)) chrom",
        "cast(p_partkey * 20000 + 200 as bigint) start", "cast(p_partkey * 20000 + 200 + p_size * 4000 as bigint) end", "case when p_partkey % 2 = 0 then '+' else '-' end strand", "p_type biotype",
    )


def islands(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").selectExpr("concat('chr', cast(p_partkey div 2 % 3 + 1 as string)) chrom", "cast(p_partkey * 3000 as bigint) start", "cast(p_partkey * 3000 + p_size * 60 as bigint) end")


def results(spark: SparkSession, sf: str) -> DataFrame:
    """feature, p_value (one in fifty missing), cohens_d, delta_mean."""
    return table(spark, sf, "part").selectExpr(
        "concat('f', cast(p_partkey as string)) feature",
        "case when p_partkey % 50 <> 0 then power(((p_partkey * 7919) % 100003 + 1) / 100004.0D, 3) end p_value",
        "(p_size - 25) / 10.0D cohens_d", "(p_size - 25) / 50.0D delta_mean",
    )


def adjusted(spark: SparkSession, sf: str) -> DataFrame:
    return compare.adjust(results(spark, sf))


def feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    feature = "concat('f', cast(p_partkey as string)) gene"
    return p.selectExpr("p_brand pathway", feature).union(p.selectExpr("p_type pathway", feature))


def set_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_brand").distinct().where("p_brand like '%1'").select(F.col("p_brand").alias("pathway_id"), F.concat(F.lit("Name of "), "p_brand").alias("pathway_name"))


def enrichment(spark: SparkSession, sf: str, found: DataFrame | None = None) -> DataFrame:
    """Fisher over sets of features with q below 0.2; p and q rounded, so equal sets tie in any engine."""
    return enrich.run_enrichment(adjusted(spark, sf) if found is None else found, feature_sets(spark, sf), q_threshold=0.2).withColumns({c: r(c, 10) for c in ("p_value", "q_value")})


# matrix


@query
def long_matrix(spark, sf):
    wide = table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_id"), F.lit(1).alias("note"), *[F.col("embedding")[d].alias(f"chr{d % 4 + 1}_{(d + 1) * 1000}") for d in range(DIMS)])
    return rounded(matrix.long_matrix(wide).withColumn("beta", F.col("beta").cast("double")), "beta")


@query
def wide_matrix(spark, sf):
    f = gene_features(spark, sf).join(meta(spark, sf), "sample_id").groupBy("gene", "clinical_category").agg(F.avg("value").alias("value"))
    groups = [str(g) for g in range(10)]
    return rounded(matrix.wide_matrix(f, groups, "gene", "clinical_category").toDF("gene", *[f"c{g}" for g in groups]), *[f"c{g}" for g in groups])


def _raw_ids(spark, sf):
    return table(spark, sf, "orders").selectExpr("o_orderkey", "case o_orderkey % 5 when 0 then concat('chr', cast(o_orderkey % 30 as string), '_', cast(o_orderkey as string)) when 1 then concat('chrX_', cast(o_orderkey as string)) when 2 then concat('cg', cast(o_orderkey as string)) when 3 then 'chr1_x9' else concat('chr2_', cast(o_orderkey as string)) end site")


@query
def id_parse(spark, sf):
    fast = ids.split_site("site")
    return _raw_ids(spark, sf).select("o_orderkey", "site", ids.is_site_id("site").alias("valid"), ids.site_chrom("site").alias("chrom"), ids.site_pos("site").alias("pos"), fast[0].alias("fast_chrom"), fast[1].alias("fast_pos"), ids.chrom_index(ids.site_chrom("site")).alias("chrom_idx"))


@query
def id_make(spark, sf):
    return points(spark, sf).select(ids.make_site_id("chrom", "pos").alias("made"), ids.overlaps(F.col("pos") - 10, F.col("pos") + 10, F.lit(1000), F.lit(5000)).alias("near"))


@query
def id_sort(spark, sf):
    s = _raw_ids(spark, sf).select("site").distinct()
    return order.numbered(s, ids.site_order("site"), name="ord").withColumn("ord", F.col("ord").cast("int"))


@query
def chrom_histogram(spark, sf):
    return matrix.chromosome_histogram(_raw_ids(spark, sf), "site")


@query
def coverage(spark, sf):
    return rounded(matrix.coverage(cells(spark, sf)), "coverage")


@query
def coverage_filter(spark, sf):
    return rounded(matrix.coverage_filter(cells(spark, sf), 0.909), "coverage")


@query
def coverage_kept_cells(spark, sf):
    return matrix.filter_sites(cells(spark, sf), 0.909).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"), r(F.sum("beta"), 4).alias("total"))


@query
def cpg_stats(spark, sf):
    return rounded(matrix.site_stats(cells(spark, sf)), "mean_beta", "variance", "missingness")


@query
def variance_filter(spark, sf):
    return rounded(matrix.variable_sites(matrix.site_stats(cells(spark, sf)), 0.0155, 0.909), "mean_beta", "variance", "missingness")


@query
def dataset_stats(spark, sf):
    return rounded(matrix.dataset_stats(cells(spark, sf)), "null_fraction")


@query
def value_stats(spark, sf):
    return rounded(matrix.value_stats(cells(spark, sf)), "mean", "median", "std")


@query
def site_select(spark, sf):
    return matrix.select_sites(cells(spark, sf), ["chr1_1000", "chr2_2000", "chr9_1", "drop table", "chr4_64000"]).groupBy("cpg_id").agg(F.count("beta").alias("n"))


# the store


def _store(spark, sf):
    """The cells of the tables as a store in the shared folder; its files go when the driver ends."""
    out = f"{scratch.shared_dir(spark)}/betaloom/{spark.sparkContext.applicationId}/store-{uuid.uuid4().hex}"
    at, files = scratch.target(spark, out)
    files.deleteOnExit(at)
    site_store.write_store(cells(spark, sf).drop("d"), out)
    return out


@query
def store_sites(spark, sf):
    asked = ["chr1_1000", "chr2_2000", "chr9_1", "drop table", "chr4_64000", "chr1_1000"]
    found = site_store.read_sites(spark, _store(spark, sf), asked)
    return found.groupBy("chrom", "pos", "cpg_id").agg(F.count("beta").alias("n"), r(F.sum("beta"), 4).alias("total"))


@query
def store_sites_joined(spark, sf):
    asked = site_genes(spark).where("gene in ('g1', 'g5')").select("cpg_id")
    return site_store.read_sites(spark, _store(spark, sf), asked).groupBy("cpg_id").agg(F.count("beta").alias("n"), r(F.sum("beta"), 4).alias("total"))


@query
def store_value_stats(spark, sf):
    return rounded(site_store.store_value_stats(spark, _store(spark, sf), 20), "mean", "median", "std")


@query
def store_dictionary(spark, sf):
    return site_store.site_dictionary(spark, _store(spark, sf)).select("ord", "cpg_id", "chrom", "pos", "n_cells")


@query
def store_counts(spark, sf):
    return site_store.chromosome_counts(spark, _store(spark, sf))


@query
def row_chunks(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    chunks = beta_csv.row_chunks(o, 100, "o_orderkey")
    return chunks.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))


@query
def running_totals(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    run = order.running(o, [F.desc("price"), F.col("o_orderkey")], {"total": ("price", "sum"), "least_customer": ("o_custkey", "min")})
    return run.select("o_orderkey", "n", F.col("total").cast("double").alias("total"), "least_customer")


@query
def tied_ranks(spark, sf):
    o = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return order.numbered(o, [F.desc("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber")], tie=["l_quantity"], name="rank")


# intervals


@query
def gene_overlap(spark, sf):
    return intervals.gene_overlap(points(spark, sf), genes(spark, sf))


@query
def gene_overlap_intergenic(spark, sf):
    return intervals.gene_overlap(points(spark, sf), genes(spark, sf), include_intergenic=True)


@query
def island_context(spark, sf):
    return intervals.island_context(points(spark, sf), islands(spark, sf))


@query
def region_overlap_one_based(spark, sf):
    return intervals.region_overlap(points(spark, sf), graph.regions(genes(spark, sf)), one_based=True)


@query
def region_overlap(spark, sf):
    return intervals.region_overlap(points(spark, sf), graph.regions(genes(spark, sf)))


@query
def point_lookup(spark, sf):
    return intervals.find_overlapping(genes(spark, sf), "chr2", 800_500).select("gene_id", "start", "end")


# roll-ups


@query
def rollup_mean(spark, sf):
    return rounded(gene_features(spark, sf), "value")


@query
def rollup_median(spark, sf):
    return rounded(rollup.rollup_sites(cells(spark, sf), site_genes(spark), "median"), "value")


@query
def rollup_weighted(spark, sf):
    w = site_genes(spark).select("cpg_id").distinct().withColumn("weight", F.substring_index("cpg_id", "_", -1).cast("double") / 1000)
    return rounded(rollup.rollup_sites(cells(spark, sf), site_genes(spark), "weighted", weights=w), "value")


@query
def rollup_by_chrom(spark, sf):
    return rounded(rollup.rollup_by_chromosome(cells(spark, sf), site_genes(spark).where("gene <> 'g3' or cpg_id like 'chr1%'"), "mean", min_sites=3), "value")


@query
def pathway_rollup(spark, sf):
    return rounded(rollup.rollup_sets(gene_features(spark, sf), gene_sets(spark)), "value")


@query
def term_rollup(spark, sf):
    return rounded(rollup.rollup_sets(gene_features(spark, sf), gene_sets(spark, "term"), "median", set_col="term"), "value")


# hypermethylation


def _hms(spark, sf):
    f, m = gene_features(spark, sf), meta(spark, sf)
    t = hms.gene_thresholds(f, m, control="0")
    return t, hms.with_groups(hms.score_samples(f, t), m)


@query
def hms_threshold(spark, sf):
    return rounded(_hms(spark, sf)[0], "threshold")


@query
def hms_score(spark, sf):
    return _hms(spark, sf)[1]


@query
def hms_summary(spark, sf):
    return rounded(hms.summarize(_hms(spark, sf)[1]), "mean", "median")


@query
def hms_digest(spark, sf):
    return hms.digest(_hms(spark, sf)[1])


# comparisons

CONTRASTS = [("0", "1"), ("0", "2"), ("1", "2")]
AS_CELLS = {"feature_col": "cpg_id", "value_col": "beta"}


def _labelled(spark, sf, n=3):
    return compare.labelled(cells(spark, sf), meta(spark, sf), CONTRASTS[:n], **AS_CELLS)


@query
def effect_size(spark, sf):
    return rounded(compare.effect_sizes(_labelled(spark, sf)).drop("var1", "var2"), "mean_group1", "mean_group2", "delta_mean", "cohens_d")


@query
def mwu_stat(spark, sf):
    return rounded(compare.mann_whitney(_labelled(spark, sf)).select("label", "feature", "n1", "n2", "statistic", "z"), "statistic", "z")


@query
def mwu_ties(spark, sf):
    tied = cells(spark, sf).withColumn("beta", F.round("beta", 1))
    return rounded(compare.mann_whitney(compare.labelled(tied, meta(spark, sf), CONTRASTS, **AS_CELLS)).select("label", "feature", "statistic", "z"), "statistic", "z")


@query
def welch_stat(spark, sf):
    return rounded(compare.welch(_labelled(spark, sf)).select("label", "feature", "statistic", "df"), "statistic", "df", digits=5)


@query
def ks_stat(spark, sf):
    return rounded(compare.kolmogorov_smirnov(_labelled(spark, sf)).select("label", "feature", "statistic"), "statistic")


@query
def all_contrasts(spark, sf):
    return rounded(compare.run_all_comparisons(cells(spark, sf), meta(spark, sf), [*CONTRASTS, ("0", "none")], **AS_CELLS), "mean_group1", "mean_group2", "delta_mean", "cohens_d", "statistic").withColumns({c: r(c, 8) for c in ("p_value", "q_value")})


@query
def compare_pvalues(spark, sf):
    found = compare.run_all_comparisons(cells(spark, sf), meta(spark, sf), CONTRASTS, test="ttest", large=True, **AS_CELLS)
    return rounded(found, "mean_group1", "mean_group2", "delta_mean", "cohens_d", "statistic").withColumns({c: r(c, 8) for c in ("p_value", "q_value")})


def _few(spark, sf):
    """Cells of seven samples against nine, few enough for exact tests; all others are in neither group."""
    groups = table(spark, sf, "embeddings").selectExpr("vec_id as sample_id", "case when vec_id < 7 then 'a' when vec_id < 16 then 'b' else 'rest' end clinical_category")
    return compare.labelled(cells(spark, sf), groups, [("a", "b")], **AS_CELLS)


@query
def mwu_exact(spark, sf):
    return rounded(compare.mann_whitney(_few(spark, sf)).select("feature", "n1", "n2", "statistic", "p_value"), "statistic", "p_value", digits=8)


@query
def ks_exact(spark, sf):
    return rounded(compare.kolmogorov_smirnov(_few(spark, sf)).select("feature", "n1", "n2", "statistic", "p_value"), "statistic", "p_value", digits=8)


def _fdr(method):
    def f(spark, sf):
        return rounded(compare.adjust(results(spark, sf), method), "p_value", "cohens_d", "delta_mean", "q_value", digits=8)

    f.__name__ = method if method.startswith("fdr") else f"fdr_{method}"
    return query(f)


for _m in compare.FDR_METHODS:
    _fdr(_m)


def _fdr_large(method):
    def f(spark, sf):
        return rounded(compare.adjust_large(results(spark, sf), method), "p_value", "cohens_d", "delta_mean", "q_value", digits=8)

    f.__name__ = f"fdr_large_{method.removeprefix('fdr_')}"
    return query(f)


for _m in ("fdr_by", "holm", "bonferroni"):
    _fdr_large(_m)


@query
def fdr_large(spark, sf):
    return rounded(compare.adjust_large(results(spark, sf)).select("feature", "q_value", "significant"), "q_value", digits=8)


# enrichment


@query
def fisher_enrich(spark, sf):
    e = enrichment(spark, sf).select("pathway", "odds_ratio", "p_value", "n_overlap", "n_significant", "n_pathway", "n_background")
    return rounded(e, "odds_ratio", "p_value")


def _ranked(spark, sf):
    return results(spark, sf).where("p_value is not null").select(F.col("feature").alias("gene"), enrich.signed_rank("cohens_d", "p_value").alias("metric"))


@query
def rank_metric(spark, sf):
    return rounded(_ranked(spark, sf), "metric")


@query
def gsea_es(spark, sf):
    return rounded(enrich.running_sum(_ranked(spark, sf), feature_sets(spark, sf)), "es")


@query
def gsea_perm(spark, sf):
    return rounded(enrich.gsea_preranked(_ranked(spark, sf), feature_sets(spark, sf)), "es", "nes")


def _gsea(spark, sf):
    found = enrich.run_enrichment(results(spark, sf), feature_sets(spark, sf), method="gsea", n_permutations=200, seed=7)
    return found.withColumns({c: r(c, 8) for c in ("p_value", "q_value", "nes", "es")})


@query
def gsea_enrichment(spark, sf):
    return _gsea(spark, sf).select("pathway", "es", "nes", "p_value", "q_value", "significant", "n_genes", "n_hits")


@query
def rank_pathway_nes(spark, sf):
    ranked = rank.rank_pathways(_gsea(spark, sf))
    return rounded(ranked.select("pathway", "q_value", "p_value", "nes", "es", "n_hits", "score"), "q_value", "p_value", "nes", "es", "score", digits=5)


# ranking and report


@query
def rank_cpg(spark, sf):
    notes = results(spark, sf).select(F.col("feature").alias("cpg_id"), F.length("feature").alias("width"))
    return rounded(rank.rank_sites(adjusted(spark, sf), 100, annotations=notes), "effect_size", "q_value", "score")


@query
def rank_gene(spark, sf):
    return rounded(rank.rank_genes(adjusted(spark, sf)), "effect_size", "q_value", "delta_mean", "diff_score", "score")


def _genes_with_bonus(spark, sf):
    return rank.rank_genes(adjusted(spark, sf), enrichment(spark, sf))


@query
def rank_gene_bonus(spark, sf):
    return rounded(_genes_with_bonus(spark, sf), "effect_size", "q_value", "delta_mean", "diff_score", "enrichment_bonus", "score", digits=5)


@query
def rank_pathway(spark, sf):
    return rounded(rank.rank_pathways(enrichment(spark, sf)).select("pathway", "q_value", "p_value", "odds_ratio", "n_overlap", "score"), "q_value", "p_value", "odds_ratio", "score", digits=5)


def _mapped(spark, sf):
    return intervals.gene_overlap(points(spark, sf), genes(spark, sf), include_intergenic=True)


@query
def report_union(spark, sf):
    found = scratch.materialize(adjusted(spark, sf), "report-results")  # read by three parts
    e = scratch.materialize(enrichment(spark, sf, found), "report-enrichment")
    return rounded(rank.report(rank.rank_sites(found), rank.rank_genes(found, e), rank.rank_pathways(e), enrichment=e), "score", "effect_size", "q_value", digits=5)


@query
def gene_island_context(spark, sf):
    return rank.gene_island_context(_mapped(spark, sf), intervals.island_context(points(spark, sf), islands(spark, sf)))


@query
def island_digest(spark, sf):
    return rank.island_digest(gene_island_context(spark, sf))


@query
def pathway_list(spark, sf):
    e = enrichment(spark, sf).withColumn("p_value", F.round("p_value", 6))
    return rank.pathway_lists(e)


@query
def biomarker_flags(spark, sf):
    return rank.export_flags(results(spark, sf).select(F.col("feature").alias("cpg_id")), rank.rank_sites(adjusted(spark, sf), 10))


# report data


@query
def overlap_freq(spark, sf):
    return report.frequency(_mapped(spark, sf), "overlap_type")


@query
def overlap_shares(spark, sf):
    return report.shares(_mapped(spark, sf), "overlap_type")


@query
def distinct_counts(spark, sf):
    return report.distinct_counts(_mapped(spark, sf))


@query
def comparison_summary(spark, sf):
    return report.comparison_summary(adjusted(spark, sf))


@query
def top_significant(spark, sf):
    return rounded(report.top_significant(adjusted(spark, sf)).select("feature", "p_value"), "p_value", digits=9)


@query
def enrichment_named(spark, sf):
    return report.named(enrichment(spark, sf).select("pathway", "n_overlap"), set_names(spark, sf), width=12)


@query
def volcano_class(spark, sf):
    return rounded(report.volcano_points(adjusted(spark, sf)), "delta_mean", "neg_log10_p")


@query
def volcano_labels(spark, sf):
    return rounded(report.volcano_labels(report.volcano_points(adjusted(spark, sf))).select("feature", "weight"), "weight")


@query
def dotplot_data(spark, sf):
    return rounded(report.dot_plot(enrichment(spark, sf).withColumn("p_value", F.round("p_value", 8)), set_names(spark, sf)), "neg_log10_q", "odds_ratio", digits=5)


@query
def violin_data(spark, sf):
    return report.violin(_hms(spark, sf)[1].withColumn("clinical_category", F.when(F.col("clinical_category") == "9", F.lit("excluded")).when(F.col("clinical_category") != "8", F.col("clinical_category"))))


@query
def violin_density(spark, sf):
    scores = _hms(spark, sf)[1].where("quantile = 0.95")
    return rounded(density.violin_density(report.violin(scores), points=32, bins=100), "q1", "median", "q3", "bandwidth", "x", "density")


@query
def volcano_grid(spark, sf):
    points = report.volcano_points(adjusted(spark, sf))
    return density.grid_counts(points.withColumn("delta_mean", F.round("delta_mean", 6) + 1e-7), "delta_mean", "neg_log10_p", "point_class", nx=40, ny=25, bounds=(-0.5, 0.5, 0.0, 12.0))


@query
def heatmap_columns(spark, sf):
    return rounded(density.heatmap_bins(report.heatmap(gene_features(spark, sf), meta(spark, sf), 5), 30), "value")


def _wide_files(spark, sf):
    """Files of chr1 to chr3, a row per vector and a column per dimension, written and read back."""
    base = scratch.shared_dir(spark) + f"/betaloom/{spark.sparkContext.applicationId}/wide-{uuid.uuid4().hex}"
    at, files = scratch.target(spark, base)
    files.deleteOnExit(at)
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("sample_id"), "embedding").orderBy(F.desc("vec_id"))
    paths = {}
    for k in range(3):
        wide = e.select("sample_id", F.lit("x").alias("note"), *[F.col("embedding")[d].alias(f"chr{k + 1}_{(d + 1) * 1000}") for d in range(k, DIMS, 4)])
        paths[f"chr{k + 1}"] = f"{base}/chr{k + 1}"
        wide.coalesce(1).write.parquet(paths[f"chr{k + 1}"])
    return wide_files.read_wide(spark, paths)


@query
def stitched(spark, sf):
    found = wide_files.stitch(_wide_files(spark, sf))
    return rounded(found.withColumn("beta", F.col("beta").cast("double")), "beta")


@query
def stitched_order(spark, sf):
    """Files of which one lacks samples and one has others moved."""
    frames = _wide_files(spark, sf)
    frames["chr2"] = frames["chr2"].where("sample_id % 7 <> 0")
    frames["chr3"] = frames["chr3"].where("sample_id % 5 <> 0").unionByName(frames["chr3"].where("sample_id % 5 = 0").withColumn("__file", F.lit("zz")))
    return wide_files.order_report(frames)


@query
def topk_variance(spark, sf):
    return rounded(report.most_variable(gene_features(spark, sf), 5), "variance")


@query
def zscore_heatmap(spark, sf):
    return rounded(report.heatmap(gene_features(spark, sf), meta(spark, sf), 5), "z")


# clinical


def _sheets(spark, sf):
    c = table(spark, sf, "customer")
    kind = "case c_custkey % 4 when 0 then ' CRC ' when 1 then 'Polyp' when 2 then 'healthy' else c_mktsegment end"
    a = c.where("c_custkey % 2 = 0").selectExpr("concat(' bc-', cast(c_custkey as string), ' ') `Sample_ID`", f"{kind} `Diagnosis`")
    b = c.where("c_custkey % 2 = 1 or c_custkey % 3 = 0").selectExpr("case when c_custkey % 15 = 0 then 'nan' else concat('BC-', cast(c_custkey as string)) end barcode", f"upper({kind}) `group`")
    return {"CLIN_A": a, "CLIN_B": b}


@query
def barcode_norm(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey", "concat('\\t\u00a0 \u3000', c_name, case when c_custkey % 7 = 0 then '!' else '' end, ' \u00a0\u2003\\n') raw")
    return c.select("c_custkey", ids.normalize_barcode("raw").alias("barcode"), ids.is_barcode(ids.normalize_barcode("raw")).alias("valid"))


@query
def category_norm(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey", "case c_custkey % 6 when 0 then '\u00a0CRC' when 1 then 'adenoma\u2009' when 2 then 'Ctrl ' when 3 then 'PENDING' when 4 then 'hgd' else concat(' ', c_mktsegment, ' ') end raw")
    return c.select("c_custkey", ids.normalize_category("raw").alias("category"))


@query
def clinical_merge(spark, sf):
    return clinical.merge(_sheets(spark, sf))


@query
def keep_first(spark, sf):
    l = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return clinical.keep_first(l, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"])


@query
def exclusion_anti(spark, sf):
    gone = table(spark, sf, "customer").where("c_custkey % 10 = 0").selectExpr("concat(' bc-', cast(c_custkey as string)) barcode")
    return clinical.merge(_sheets(spark, sf), [gone])


@query
def symbol_map(spark, sf):
    p = table(spark, sf, "part")
    edges = p.selectExpr("concat(case when p_partkey % 5 = 0 then 'LRG' else 'ENSG' end, cast(p_partkey as string)) gene_id", "p_brand pathway_id")
    g = genes(spark, sf).withColumn("gene_symbol", F.concat(F.lit("S"), F.expr("cast(cast(substr(gene_id, 5) as int) % 100 as string)")))
    return clinical.symbol_mapping(g, edges)


# text sources, rebuilt from tables as lines


CSV_HEADER = ",".join(["", " note", *[f" chr{d % 4 + 1}_{(d + 1) * 1000} " for d in range(DIMS)], "cg99", "chr30_5"]) + "\r"


@query
def csv_header(spark, sf):
    """The site index of a header with a blank first name, spaces, and names that are no sites."""
    return beta_csv.header_index(spark, beta_csv.parse_header(CSV_HEADER))


def _csv_lines(spark, sf):
    """Lines of a beta CSV with missing tokens, cells that are no numbers, short rows and carriage returns."""
    cell = "case (vec_id * 31 + d) % 11 when 0 then '' when 1 then 'NA' when 2 then 'NaN' when 3 then concat('x', d) when 4 then ' 12 ' else cast(cast(round(cast(v as double) * 1000) as int) as string) end"
    line = f"concat(case when vec_id % 3 = 0 then ' ' else '' end, 's', vec_id, ',n,', array_join(slice(transform(embedding, (v, d) -> {cell}), 1, case when vec_id % 7 = 0 then 60 else 64 end), ','), case when vec_id % 2 = 0 then '\\r' else '' end) value"
    return table(spark, sf, "embeddings").selectExpr(line, "vec_id + 1 as sample_ord")


@query
def csv_parse(spark, sf):
    return beta_csv.parse_lines(_csv_lines(spark, sf), beta_csv.parse_header(CSV_HEADER)).withColumn("beta", F.col("beta").cast("double"))


@query
def csv_convert(spark, sf):
    """A CSV file of the vectors, converted: what the store holds of each site, in chromosomes whose counts the conversion gave."""
    base = f"{scratch.shared_dir(spark)}/betaloom/{spark.sparkContext.applicationId}/csv-{uuid.uuid4().hex}"
    at, files = scratch.target(spark, base)
    files.deleteOnExit(at)
    header = spark.createDataFrame([(CSV_HEADER, 0)], "value string, sample_ord long")
    header.unionByName(_csv_lines(spark, sf)).repartition(1).sortWithinPartitions("sample_ord").select("value").write.text(f"{base}/m.csv")
    counts, bad = beta_csv.convert(spark, f"{base}/m.csv", f"{base}/store", ["chr1", "chr2", "chr4"])
    store = site_store.cells_of(spark, f"{base}/store").groupBy("chrom", "pos", "cpg_id")
    held = store.agg(F.count(F.lit(1)).alias("n_cells"), F.count("beta").alias("n_present"), F.count_if("bad").alias("n_bad"), F.sum(F.col("beta").cast("double")).alias("total"), F.min_by("sample_id", "sample_ord").alias("first_sample"))
    numbers = spark.createDataFrame([(c, n, bad) for c, n in counts.items()], "chrom string, chrom_sites long, all_bad long")
    return held.join(numbers, "chrom")


@query
def sorted_p(spark, sf):
    """The place of each result by p, ties by name: NaN after all numbers, null last."""
    p = results(spark, sf).select("feature", F.when(F.expr("cast(substr(feature, 2) as int) % 77 = 0"), F.lit(float("nan"))).otherwise(F.round("p_value", 4)).alias("p"))
    return order.numbered(p, [F.col("p").asc_nulls_last(), F.col("feature")], name="place").select("feature", "place")


def _lines(df: DataFrame, expr: str, order: str) -> DataFrame:
    return df.selectExpr(f"{expr} value", f"cast({order} as bigint) n")


@query
def gtf_parse(spark, sf):
    expr = "concat('chr', cast(p_partkey % 3 + 1 as string), '\\tX\\t', case when p_partkey % 4 = 0 then 'exon' else 'gene' end, '\\t', cast(p_partkey as string), '\\t', cast(p_partkey + p_size as string), '\\t.\\t+\\t.\\tgene_id \"E', cast(p_partkey % 700 as string), '.3\"; gene_type \"', p_type, '\"; gene_name \"', p_name, '\";')"
    return ann.gtf(_lines(table(spark, sf, "part"), expr, "p_partkey"))


def _stanzas(spark, sf):
    """OBO text made of parts: a term's parents are the terms at half and at a third of its number; one in ten is obsolete."""
    line = lambda k, b: f"case when p_partkey div {k} > 0 then concat('{b}', lpad(cast(p_partkey div {k} as string), 7, '0'), ' ! a parent\\n') else '' end"
    head = "case when p_partkey % 50 = 0 then '[Typedef]\\n' else '\\n[Term]\\n' end"
    text = f"concat({head}, 'id: GO:', lpad(cast(p_partkey as string), 7, '0'), '\\nname: ', p_name, '\\nnamespace: biological_process\\ndef: \"is_a: none\"\\n', {line(2, 'is_a: GO:')}, {line(3, 'relationship: part_of GO:')}, 'relationship: regulates GO:0000001\\n', case when p_partkey % 10 = 7 then 'is_obsolete: true\\n' else '' end)"
    return table(spark, sf, "part").selectExpr(f"{text} value")


@query
def obo_parse(spark, sf):
    terms = ann.obo_terms(_stanzas(spark, sf))
    return terms.select("term_id", "name", "namespace", F.array_join(F.transform("parents", lambda p: F.concat_ws(" ", p["relation"], p["parent_id"])), "; ").alias("parents"))


def _term_edges(spark, sf):
    return ann.obo_edges(ann.obo_terms(_stanzas(spark, sf)))


def _closed(spark, sf):
    return ontology.closure(_term_edges(spark, sf))


@query
def go_closure(spark, sf):
    return _closed(spark, sf)


@query
def go_cycles(spark, sf):
    """Terms on a cycle once the root is put below one of its descendants."""
    edges = ann.obo_edges(ann.obo_terms(_stanzas(spark, sf))).select("child", "parent")
    wrong = spark.createDataFrame([("GO:0000001", "GO:0000012")], "child string, parent string")
    return ontology.cycles(ontology.closure(edges.unionByName(wrong)))


@query
def go_term_sizes(spark, sf):
    notes = table(spark, sf, "lineitem").selectExpr("concat('S', cast(l_orderkey % 500 as string)) gene", "concat('GO:', lpad(cast(l_partkey as string), 7, '0')) term")
    return ontology.member_counts(notes, _term_edges(spark, sf))


@query
def go_ancestor_rollup(spark, sf):
    notes = spark.range(DIMS // 4).selectExpr("concat('g', cast(id as string)) gene", "concat('GO:', lpad(cast(id + 16 as string), 7, '0')) term")
    return rounded(rollup.rollup_sets(gene_features(spark, sf), ontology.with_ancestors(notes, _closed(spark, sf)), set_col="term"), "value")


class _Choosy:
    """A sink that keeps nothing and refuses batches with a gene whose number ends in 777."""

    def has(self, name):
        return name.endswith("3")

    def write(self, name, rows):
        if rows["gene_id"].str.endswith("777").any():
            raise ValueError("777")


@query
def sink_outcomes(spark, sf):
    outcomes, _ = batches.write_batches(genes(spark, sf).select("gene_id", "gene_symbol"), [F.col("gene_id")], _Choosy, table="gene", size=100)
    return outcomes


@query
def sink_failed_rows(spark, sf):
    return batches.write_batches(genes(spark, sf).select("gene_id", "gene_symbol"), [F.col("gene_id")], _Choosy, table="gene", size=100)[1]


@query
def gaf_parse(spark, sf):
    expr = "concat('DB\\tid\\t', p_brand, '\\tinvolved_in\\tGO:', cast(p_size as string), '\\tref\\tIEA\\t\\t', case p_partkey % 4 when 0 then 'F' when 1 then 'P' when 2 then 'C' else 'Z' end, '\\t\\t\\tprotein\\ttaxon:', case when p_partkey % 5 = 0 then '10090' else '9606' end, '\\t2020\\tDB')"
    return ann.gaf(_lines(table(spark, sf, "part"), expr, "p_partkey"))


@query
def reactome_parse(spark, sf):
    expr = "concat('ENSG', cast(p_partkey as string), '.1\\tR-', p_brand, '\\turl\\t', p_name, '\\tTAS\\t', case when p_partkey % 3 = 0 then 'Mus musculus' else 'Homo sapiens' end)"
    return ann.reactome_genes(_lines(table(spark, sf, "part"), expr, "p_partkey"))


@query
def reactome_pathway_parse(spark, sf):
    expr = "concat('R-', cast(p_partkey as string), '\\t', p_name, '\\t', case when p_partkey % 3 = 0 then 'Mus musculus' else 'Homo sapiens' end)"
    return ann.reactome_pathways(_lines(table(spark, sf, "part"), expr, "p_partkey"))


@query
def island_parse(spark, sf):
    expr = "concat('1\\tchr2\\t', cast(p_partkey as string), '\\t', cast(p_partkey + p_size as string), '\\tCpG: ', cast(p_size as string), '\\t9\\t', cast(p_size as string), '\\t7\\t3\\t', case when p_partkey % 6 = 0 then '' else cast(p_size as string) end, '\\t0.5')"
    return rounded(ann.islands(_lines(table(spark, sf, "part"), expr, "p_partkey")), "gc_fraction", "obs_exp_ratio")


@query
def gmt_parse(spark, sf):
    rows = table(spark, sf, "part").groupBy("p_brand").agg(F.concat_ws("\t", F.first("p_brand"), F.lit("about"), F.array_join(F.array_sort(F.collect_list("p_name")), "\t")).alias("value"))
    return ann.gmt(rows.withColumn("n", F.lit(0)))


# graph


def _graph(spark, sf):
    n, s, p, l, c = (table(spark, sf, x) for x in ("nation", "supplier", "part", "lineitem", "customer"))
    g = graph.Graph(
        v_gene=p.selectExpr("cast(p_partkey as string) gene_id", "p_name gene_symbol"),
        v_cpg=table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) cpg_id", "o_orderkey % 97 = 0 is_biomarker_candidate"),
        v_pathway=s.selectExpr("cast(s_suppkey as string) pathway_id", "s_name pathway_name"),
        v_term=n.selectExpr("cast(n_nationkey as string) term_id", "n_name term_name"),
        v_region=table(spark, sf, "region").selectExpr("cast(r_regionkey as string) region_id", "r_name region_type"),
        v_sample=c.selectExpr("cast(c_custkey as string) barcode", "c_mktsegment clinical_category"),
        e_cpg_gene=l.selectExpr("cast(l_orderkey as string) cpg_id", "cast(l_partkey as string) gene_id", "case when l_linenumber = 1 then 'promoter' else 'gene_body' end overlap_type"),
        e_gene_pathway=l.selectExpr("cast(l_partkey as string) gene_id", "cast(l_suppkey as string) pathway_id"),
        e_gene_term=p.selectExpr("cast(p_partkey as string) gene_id", "cast(p_size % 25 as string) term_id", "'IEA' evidence_code"),
        e_cpg_region=table(spark, sf, "orders").selectExpr("cast(o_orderkey as string) cpg_id", "cast(o_orderkey % 5 as string) region_id"),
        f_gene_sample=gene_features(spark, sf).select(F.col("gene").alias("gene_id"), F.col("sample_id").alias("barcode"), "value"),
        r_gene_diff=adjusted(spark, sf).select(F.lit("A_vs_B").alias("label"), F.col("feature").alias("gene_id"), "q_value"),
        r_pathway_diff=enrichment(spark, sf).select(F.lit("A_vs_B").alias("label"), F.col("pathway").alias("pathway_id"), "q_value"),
    )
    return g


def _lookup(name: str, f):
    def run(spark, sf):
        return f(_graph(spark, sf))

    run.__name__ = f"g_{name}"
    return query(run)


_lookup("genes_in_pathway", lambda g: graph.genes_in_pathway(g, "3"))
_lookup("cpgs_for_gene", lambda g: graph.cpgs_for_gene(g, "5"))
_lookup("cpgs_in_pathway", lambda g: graph.cpgs_in_pathway(g, "3"))
_lookup("pathways_for_gene", lambda g: graph.pathways_for_gene(g, "5"))
_lookup("go_terms_for_gene", lambda g: graph.go_terms_for_gene(g, "5"))
_lookup("genes_with_term", lambda g: graph.genes_with_term(g, "4"))
_lookup("samples_in_category", lambda g: graph.samples_in_category(g, "BUILDING"))
_lookup("cpgs_in_region_type", lambda g: graph.cpgs_in_region_type(g, "ASIA"))
_lookup("significant_genes", lambda g: rounded(graph.significant_genes(g, "A_vs_B", 0.2), "q_value"))
_lookup("significant_pathways", lambda g: rounded(graph.significant_pathways(g, "A_vs_B", 0.9999), "q_value"))
_lookup("biomarker_cpgs", graph.biomarker_cpgs)
_lookup("gene_methylation_for_sample", lambda g: rounded(graph.gene_methylation_for_sample(g, 3), "value"))


def _imported(spark, sf, region_base: bool = False):
    """All importers over parsed shapes."""
    p = table(spark, sf, "part")
    g0, pts = genes(spark, sf), points(spark, sf)
    inputs = {
        "genes": g0,
        "pathways": p.selectExpr("p_brand pathway_id", "p_brand pathway_name", "'Reactome' pathway_source").distinct(),
        "go": p.selectExpr("concat('S', cast(p_partkey * 2 as string)) gene_symbol", "concat('GO:', cast(p_size as string)) go_id", "'IEA' evidence_code", "'biological_process' aspect", "'' qualifier"),
        "islands": islands(spark, sf),
        "gene_pathway": p.selectExpr("concat('ENSG', cast(p_partkey * 3 as string)) gene_id", "p_brand pathway_id"),
        "clinical": meta(spark, sf).select(F.col("sample_id").alias("barcode"), "clinical_category"),
        "cpg_stats": pts.select("cpg_id", F.col("chrom").alias("chromosome"), F.col("pos").alias("position"), F.lit(0.5).alias("mean_beta"), F.expr("case when pos % 3 = 0 then 0.001D else 0.25D end").alias("variance"), F.lit(0.125).alias("missingness"), F.lit(9).alias("n_samples")),
        "mapping": intervals.gene_overlap(pts, g0, include_intergenic=True),
    }
    return graph.build(inputs)


PARTS = ("v_gene", "v_pathway", "v_term", "v_region", "e_gene_pathway", "e_gene_term", "v_sample", "v_cpg", "e_cpg_gene", "e_cpg_region")


@query
def graph_import(spark, sf):
    """The sizes of what the importers made."""
    g, out = _imported(spark, sf), None
    for name in PARTS:
        row = getattr(g, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query
def graph_contents(spark, sf):
    """Every vertex and edge that the importers made, its columns in order of name."""
    g, out = _imported(spark, sf), None
    for name in PARTS:
        df = getattr(g, name)
        row = df.select(F.lit(name).alias("part"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns)]).alias("row"))
        out = row if out is None else out.unionByName(row)
    return out


@query
def graph_validation(spark, sf):
    return graph.validate(_graph(spark, sf), clinical=table(spark, sf, "customer"), spot_gene="none of that name")


@query
def graph_spot_check(spark, sf):
    """A gene that exists, by the name of part 5."""
    name = table(spark, sf, "part").where("p_partkey = 5").head()["p_name"]
    return graph.validate(_graph(spark, sf), spot_gene=name).where("name like 'spot%'")


# sampling


@query
def exact_sites(spark, sf):
    return sampling.select_sites(points(spark, sf), 1001)


def _customers(spark, sf):
    return table(spark, sf, "customer").selectExpr("concat('C', cast(c_custkey as string)) barcode", "case when c_custkey % 9 = 0 then null when c_custkey % 40 = 1 then 'rare' else c_mktsegment end clinical_category")


@query
def exact_samples(spark, sf):
    """More floors than the number wanted leaves to share: strata give back."""
    c = _customers(spark, sf)
    return sampling.select_samples(c.select(F.col("barcode").alias("sample_id")), 101, c.where("clinical_category is not null"), least=19)


@query
def quota_table(spark, sf):
    c = _customers(spark, sf).groupBy(F.col("clinical_category").alias("stratum")).agg(F.count(F.lit(1)).alias("size"))
    out = None
    for n, least in ((3, 2), (40, 9), (97, 1), (10**9, 5)):
        q = sampling.quotas(c, n, least).withColumn("n", F.lit(n))
        out = q if out is None else out.unionByName(q)
    return out


@query
def stratified_sites(spark, sf):
    return sampling.stratified(points(spark, sf), 1000, stratum_col="chrom", key_col="cpg_id").select("chrom", "cpg_id")


@query
def stratified_samples(spark, sf):
    return sampling.stratified(meta(spark, sf), 50, stratum_col="clinical_category", key_col="sample_id", least=3)


@query
def subset_extract(spark, sf):
    s = spark.createDataFrame([("chr1_1000",), ("chr2_2000",), ("chr3_7000",)], "cpg_id string")
    return rounded(sampling.subset(cells(spark, sf), s, meta(spark, sf).where("clinical_category = '1'")).select("sample_id", "cpg_id", "beta"), "beta")
