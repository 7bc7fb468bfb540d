"""The step runner: thirteen steps from raw files to report, each a set of tables written once and read by later steps.

A step is skipped when its output is complete (a _SUCCESS mark, or a plain file), unless forced. State is kept as
JSON beside the results; a state of another mode, or a broken one, is started anew.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.ids import file_label, site_chrom, site_pos
from betaloom.logs import configure, get_logger
from betaloom.operators import clinical, compare, density, enrich, graph, hms, intervals, matrix, rank, report, rollup, sampling
from betaloom.plans import docx, figures
from betaloom.session import session
from betaloom.sources import annotations, beta_csv, tables

log = get_logger("betaloom")
TITLE = "Methylation biomarker report"


@dataclass
class Config:
    """Where things are and the settings of a mode: "dev" works on a few chromosomes and keeps genes of one site."""

    mode: str = "production"
    data: str = "data"
    results: str = "results"
    beta_csv: str = field(default_factory=lambda: os.environ.get("BETA_MATRIX_PATH", "data/raw/beta_matrix.csv"))
    clinical_xlsx: str = field(default_factory=lambda: os.environ.get("CLINICAL_XLSX_PATH", "data/raw/clinical.xlsx"))
    sheet_pattern: str = "CLIN_*"
    exclude_file: str | None = None
    exclude_sheet: str | None = None
    chromosomes: list[str] | None = None
    min_coverage: float = 0.95
    filter_mapping: bool = False
    control: str = "Control"
    contrasts: list[tuple[str, str]] = field(default_factory=lambda: list(compare.DEFAULT_CONTRASTS))
    test: str = "mannwhitneyu"
    fdr: str = "fdr_bh"
    alpha: float = 0.05
    gene_bonus: bool = False  # add the enrichment of a gene's pathways to its score in the report

    @property
    def min_sites(self) -> int:
        return 1 if self.mode == "dev" else 3

    def path(self, name: str) -> str:
        tail = "_dev" if self.mode == "dev" else ""
        return {
            "external": f"{self.data}/external",
            "clinical": f"{self.data}/processed/clinical_metadata.parquet",
            "beta": f"{self.data}/processed/beta{tail}",
            "coverage": f"{self.data}/processed/cpg_coverage{tail or '_full'}.parquet",
            "mapping": f"{self.data}/processed/cpg_gene_mapping{tail or '_full'}.parquet",
            "islands": f"{self.data}/processed/cpg_island_context{tail}.parquet",
            "features": f"{self.data}/processed/gene_features{tail or '_full'}.parquet",
            "hms": f"{self.results}/hypermethylation{tail}",
            "comparisons": f"{self.results}/comparisons{tail}",
            "enrichment": f"{self.results}/enrichment{tail}",
            "reports": f"{self.results}/reports{tail}",
            "plots": f"{self.results}/plotdata{tail}",
            "stats": f"{self.results}/reports{tail}/dataset_stats.md",
            "state": f"{self.results}/pipeline_state.json",
        }[name]


class State:
    """{"mode", "steps": {name: {"status", "timestamp", "elapsed_s"}}} as JSON."""

    def __init__(self, path: str, mode: str):
        self.path, self.value = path, {"mode": mode, "steps": {}}
        try:
            with open(path) as f:
                old = json.load(f)
            if old.get("mode") == mode and isinstance(old.get("steps"), dict):
                self.value = old
        except (OSError, ValueError, AttributeError):
            pass

    def completed(self, step: str) -> bool:
        return self.value["steps"].get(step, {}).get("status") == "completed"

    def record(self, step: str, status: str, seconds: float) -> None:
        self.value["steps"][step] = {"status": status, "timestamp": datetime.now(timezone.utc).isoformat(), "elapsed_s": round(seconds, 2)}
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        with open(f"{self.path}.part", "w") as f:
            json.dump(self.value, f, indent=2)
        os.replace(f"{self.path}.part", self.path)


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder of any file system Spark reads, sorted; none if it is no folder."""
    fs, target = _files(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) and fs.getFileStatus(target).isDirectory() else []


def output_exists(spark: SparkSession, path: str) -> bool:
    """A finished Spark table, a folder with such tables, or a file, in any file system Spark reads."""
    fs, target = _files(spark, path)
    if not fs.exists(target):
        return False
    if not fs.getFileStatus(target).isDirectory():
        return True
    done = lambda p: fs.exists(_files(spark, f"{p}/_SUCCESS")[1])
    return done(path) or any(done(f"{path}/{d}") for d in _folders(spark, path))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_parquet(spark, path)


def step_clinical(spark: SparkSession, c: Config) -> None:
    sheets = tables.read_workbook(spark, c.clinical_xlsx, c.sheet_pattern)
    gone = []
    if c.exclude_sheet:
        sheet = tables.read_workbook(spark, c.clinical_xlsx, c.exclude_sheet)[c.exclude_sheet]
        code = clinical.resolve_column(sheet.columns, clinical.BARCODE_ALIASES) or sheet.columns[0]
        gone.append(sheet.select(F.col(f"`{code}`").alias("barcode")))
    if c.exclude_file:
        gone.append(clinical.read_exclusions(spark, c.exclude_file))
    tables.write_parquet(clinical.merge(sheets, gone), c.path("clinical"))


RAW = {"genes": ["gencode.gtf.gz", "gencode.gtf"], "go": ["goa_human.gaf.gz", "goa_human.gaf"], "pathways": ["ReactomePathways.txt"], "members": ["Ensembl2Reactome.txt"], "islands": ["cpgIslandExt.txt.gz", "cpgIslandExt.txt"]}


def step_annotations(spark: SparkSession, c: Config) -> None:
    ext = c.path("external")
    raw = {k: next((p for n in names if tables.path_exists(spark, p := f"{ext}/{n}")), None) for k, names in RAW.items()}
    if raw["genes"]:
        tables.write_parquet(annotations.read_gtf(spark, raw["genes"]), f"{ext}/genes.parquet")
    if raw["go"]:
        tables.write_parquet(annotations.read_gaf(spark, raw["go"]), f"{ext}/go_annotations.parquet")
        tables.write_parquet(clinical.term_mapping(_read(spark, f"{ext}/go_annotations.parquet")), f"{ext}/go_symbol_term.parquet")
    if raw["pathways"] and raw["members"]:
        pathways, members = annotations.read_reactome(spark, raw["pathways"], raw["members"])
        tables.write_parquet(pathways, f"{ext}/reactome_pathways.parquet")
        tables.write_parquet(members, f"{ext}/reactome_gene_pathway.parquet")
        if raw["genes"]:
            tables.write_parquet(clinical.symbol_mapping(_read(spark, f"{ext}/genes.parquet"), members), f"{ext}/reactome_symbol_pathway.parquet")
    if raw["islands"]:
        tables.write_parquet(annotations.read_islands(spark, raw["islands"]), f"{ext}/cpg_islands.parquet")


def step_convert(spark: SparkSession, c: Config) -> None:
    counts, bad = beta_csv.convert(spark, c.beta_csv, c.path("beta"), c.chromosomes)
    log.info("converted", sites_per_chromosome=counts, unparsable_cells=bad)


def step_coverage(spark: SparkSession, c: Config) -> None:
    tables.write_parquet(matrix.coverage(_read(spark, c.path("beta"))), c.path("coverage"))


def _sites(spark: SparkSession, c: Config) -> DataFrame:
    cov = _read(spark, c.path("coverage"))
    if c.filter_mapping:
        cov = cov.where(F.col("coverage") >= c.min_coverage)
    return cov.select("cpg_id", site_chrom("cpg_id").alias("chrom"), site_pos("cpg_id").alias("pos"))


def step_mapping(spark: SparkSession, c: Config) -> None:
    tables.write_parquet(intervals.gene_overlap(_sites(spark, c), _read(spark, f"{c.path('external')}/genes.parquet"), include_intergenic=True), c.path("mapping"))


def step_islands(spark: SparkSession, c: Config) -> None:
    sites = _read(spark, c.path("mapping")).select("cpg_id", F.col("chromosome").alias("chrom"), F.col("position").alias("pos"))
    tables.write_parquet(intervals.island_context(sites, _read(spark, f"{c.path('external')}/cpg_islands.parquet")), c.path("islands"))


def step_aggregate(spark: SparkSession, c: Config) -> None:
    mapped = _read(spark, c.path("mapping")).where("overlap_type <> 'intergenic' and gene_symbol is not null and gene_symbol <> ''").select(F.col("gene_symbol").alias("gene"), "cpg_id")
    tables.write_parquet(rollup.rollup_by_chromosome(_read(spark, c.path("beta")), mapped, min_sites=c.min_sites), c.path("features"))


def _metadata(spark: SparkSession, c: Config) -> DataFrame:
    return _read(spark, c.path("clinical")).withColumnRenamed("barcode", "sample_id")


def step_hypermethylation(spark: SparkSession, c: Config) -> None:
    hms.run(_read(spark, c.path("features")), _metadata(spark, c), c.path("hms"), control=c.control)


def step_compare(spark: SparkSession, c: Config) -> None:
    """All contrasts in one job, then a folder for each."""
    features = _read(spark, c.path("features"))
    large = features.select(F.approx_count_distinct("gene")).head()[0] > 100_000
    found = compare.run_all_comparisons(features, _metadata(spark, c), c.contrasts, test=c.test, fdr_method=c.fdr, alpha=c.alpha, feature_col="gene", large=large).persist()
    for a, b in c.contrasts:
        part = found.where(F.col("label") == f"{a}_vs_{b}").drop("label")
        if not part.isEmpty():
            tables.write_parquet(part, f"{c.path('comparisons')}/{a}_vs_{b}.parquet")
    found.unpersist()


def _labels(spark: SparkSession, folder: str) -> list[str]:
    return [f.removesuffix(".parquet") for f in _folders(spark, folder) if f.endswith(".parquet")]


def step_enrichment(spark: SparkSession, c: Config) -> None:
    ext, comparisons = c.path("external"), c.path("comparisons")
    sets = {"reactome": (f"{ext}/reactome_symbol_pathway.parquet", "pathway_id", _labels(spark, comparisons)), "go": (f"{ext}/go_symbol_term.parquet", "term_id", [x for x in _labels(spark, comparisons) if x == "CRC_vs_Control"])}
    for name, (path, set_id, labels) in sets.items():
        if not output_exists(spark, path):
            continue
        members = _read(spark, path).select(F.col(set_id).alias("pathway"), F.col("gene_symbol").alias("gene"))
        for label in labels:
            tables.write_parquet(enrich.run_enrichment(_read(spark, f"{comparisons}/{label}.parquet"), members, fdr_method=c.fdr, alpha=c.alpha), f"{c.path('enrichment')}/{label}_{name}_fisher.parquet")


def _scores(spark: SparkSession, c: Config) -> DataFrame | None:
    """The scores of the first quantile there is of 0.99, 0.95, 0.999."""
    for q in (0.99, 0.95, 0.999):
        if output_exists(spark, path := f"{c.path('hms')}/hms_scores_q{file_label(q)}.parquet"):
            return _read(spark, path).withColumn("quantile", F.lit(q))
    return None


def _optional(spark: SparkSession, path: str) -> DataFrame | None:
    return _read(spark, path) if output_exists(spark, path) else None


def step_report(spark: SparkSession, c: Config) -> None:
    main = _read(spark, f"{c.path('comparisons')}/CRC_vs_Control.parquet")
    enriched = _optional(spark, f"{c.path('enrichment')}/CRC_vs_Control_reactome_fisher.parquet")
    mapping, context, scores = _optional(spark, c.path("mapping")), _optional(spark, c.path("islands")), _scores(spark, c)
    pairs = rank.gene_island_context(mapping, context) if mapping is not None and context is not None else None
    line = hms.digest(scores).head() if scores is not None else None
    genes = rank.rank_genes(main.where("significant"), enriched if c.gene_bonus else None, 100)
    out = rank.report(None, genes, rank.rank_pathways(enriched) if enriched is not None else None, enrichment=enriched, island_pairs=pairs, hms_summary=line["hms_summary"] if line else None)
    tables.write_parquet(out, f"{c.path('reports')}/biomarker_report.parquet")
    tables.write_csv(_read(spark, f"{c.path('reports')}/biomarker_report.parquet").coalesce(1), f"{c.path('reports')}/biomarker_report.csv")
    sections = report_sections(spark, c)
    tables.write_bytes(spark, f"{c.path('reports')}/report.md", report.render_markdown(TITLE, sections).encode())
    tables.write_bytes(spark, f"{c.path('reports')}/report.docx", docx.build(TITLE, [*sections, *report_images(spark, c)]))


def build_report(spark: SparkSession, c: Config) -> str:
    """All sections for which there are tables, as Markdown."""
    return report.render_markdown(TITLE, report_sections(spark, c))


def report_images(spark: SparkSession, c: Config) -> list[tuple[str, bytes]]:
    """A volcano per comparison and the heat map, as PNG."""
    images = [(f"Volcano {label}", figures.volcano_png(report.volcano_points(_read(spark, f"{c.path('comparisons')}/{label}.parquet")))) for label in _labels(spark, c.path("comparisons"))]
    if output_exists(spark, c.path("features")) and output_exists(spark, c.path("clinical")):
        images.append(("Most variable genes", figures.heat_png(density.heatmap_bins(report.heatmap(_read(spark, c.path("features")), _metadata(spark, c))))))
    return images


def report_sections(spark: SparkSession, c: Config) -> list[tuple[str, DataFrame]]:
    """All sections for which there are tables."""
    sections = []
    if (df := _optional(spark, c.path("clinical"))) is not None:
        sections.append(("Cohorts", report.frequency(df, "clinical_category")))
    if (df := _optional(spark, c.path("mapping"))) is not None:
        sections += [("Gene overlap", report.shares(df, "overlap_type")), ("Mapping", report.distinct_counts(df))]
    if (df := _optional(spark, c.path("islands"))) is not None:
        sections.append(("Island context", report.shares(df, "context")))
    for label in _labels(spark, c.path("comparisons")):
        df = _read(spark, f"{c.path('comparisons')}/{label}.parquet")
        sections += [(f"Comparison {label}", report.comparison_summary(df)), (f"Top features {label}", report.top_significant(df).select("feature", "delta_mean", "cohens_d", "p_value", "q_value"))]
    names = _optional(spark, f"{c.path('external')}/reactome_pathways.parquet")
    for label in _labels(spark, c.path("enrichment")):
        df = _read(spark, f"{c.path('enrichment')}/{label}.parquet")
        best = df.orderBy(F.col("p_value").asc_nulls_last(), "pathway").limit(15)
        best = report.named(best, names) if names is not None else best.withColumn("display_name", F.col("pathway"))
        sections += [(f"Enrichment {label}", df.agg(F.count(F.lit(1)).alias("n_tested"), F.count_if("significant").alias("n_significant"))), (f"Top sets {label}", best.select("display_name", "n_overlap", "odds_ratio", "p_value", "q_value"))]
    if (df := _scores(spark, c)) is not None:
        sections.append(("Hypermethylation", hms.summarize(df)))
    return sections


def step_visualise(spark: SparkSession, c: Config) -> None:
    """The data of the figures, as tables, and the figures as SVG, whose size does not depend on the number of features."""
    out, comparisons = c.path("plots"), c.path("comparisons")
    draw = lambda name, svg: tables.write_bytes(spark, f"{out}/{name}.svg", svg.encode())
    for label in _labels(spark, comparisons):
        points = report.volcano_points(_read(spark, f"{comparisons}/{label}.parquet"))
        tables.write_parquet(points, f"{out}/volcano_{label}.parquet")
        tables.write_parquet(report.volcano_labels(points), f"{out}/volcano_{label}_labels.parquet")
        draw(f"volcano_{label}", figures.volcano(points, report.volcano_labels(points), label))
    enriched, names = _optional(spark, f"{c.path('enrichment')}/CRC_vs_Control_reactome_fisher.parquet"), _optional(spark, f"{c.path('external')}/reactome_pathways.parquet")
    if enriched is not None and names is not None:
        tables.write_parquet(report.dot_plot(enriched, names), f"{out}/dotplot_reactome_CRC_vs_Control.parquet")
        draw("dotplot_reactome_CRC_vs_Control", figures.dots(report.dot_plot(enriched, names)))
    for q in hms.QUANTILES:
        if (df := _optional(spark, f"{c.path('hms')}/hms_scores_q{file_label(q)}.parquet")) is not None:
            tables.write_parquet(report.violin(df), f"{out}/hms_distribution_q{file_label(q)}.parquet")
            draw(f"hms_distribution_q{file_label(q)}", figures.violins(density.violin_density(report.violin(df)), f"Hypermethylation, quantile {q}"))
    main = _optional(spark, f"{comparisons}/CRC_vs_Control.parquet")
    genes = main.orderBy(F.col("p_value").asc_nulls_last(), "feature").limit(50).select(F.col("feature").alias("gene")) if main is not None else None
    cells = report.heatmap(_read(spark, c.path("features")), _metadata(spark, c), genes=genes)
    tables.write_parquet(cells, f"{out}/heatmap_CRC_vs_Control.parquet")
    draw("heatmap_CRC_vs_Control", figures.heat(density.heatmap_bins(_read(spark, f"{out}/heatmap_CRC_vs_Control.parquet"))))


def step_stats(spark: SparkSession, c: Config) -> None:
    tables.write_bytes(spark, c.path("stats"), overview(spark, c).encode())


def overview(spark: SparkSession, c: Config) -> str:
    sections = []
    if (df := _optional(spark, c.path("beta"))) is not None:
        sections += [("Beta matrix", matrix.dataset_stats(df)), ("Values", matrix.value_stats(df)), ("Chromosomes", matrix.chromosome_histogram(df))]
    if (df := _optional(spark, c.path("clinical"))) is not None:
        sections.append(("Clinical categories", report.frequency(df, "clinical_category")))
    ext = c.path("external")
    for name, column in (("genes", "biotype"), ("go_annotations", "aspect"), ("cpg_islands", "chrom")):
        if (df := _optional(spark, f"{ext}/{name}.parquet")) is not None:
            sections.append((name, report.frequency(df, column)))
    return report.render_markdown("Dataset overview", sections)


#: step name: (function, output that shows it is done)
STEPS = {
    "clinical": (step_clinical, "clinical"),
    "annotations": (step_annotations, None),
    "convert": (step_convert, "beta"),
    "coverage": (step_coverage, "coverage"),
    "mapping": (step_mapping, "mapping"),
    "islands": (step_islands, "islands"),
    "aggregate": (step_aggregate, "features"),
    "hypermethylation": (step_hypermethylation, "hms"),
    "compare": (step_compare, "comparisons"),
    "enrichment": (step_enrichment, "enrichment"),
    "report": (step_report, None),
    "visualise": (step_visualise, "plots"),
    "stats": (step_stats, "stats"),
}


def run(spark: SparkSession, c: Config, steps: list[str] | None = None, *, force: bool = False, start_from: str | None = None) -> list[str]:
    """Run the steps in order and return those that ran. Unknown names are logged and skipped; a failure is raised."""
    for s in steps or []:
        if s not in STEPS:
            log.warning("unknown_step", step=s)
    chosen = [s for s in STEPS if steps is None or s in steps]
    if start_from:
        if start_from not in STEPS:
            raise ValueError(f"unknown step {start_from!r}")
        chosen = [s for s in chosen if list(STEPS).index(s) >= list(STEPS).index(start_from)]
    state, ran = State(c.path("state"), c.mode), []
    for name in chosen:
        work, output = STEPS[name]
        if not force and (output_exists(spark, c.path(output)) if output else state.completed(name)):
            log.info("step_skipped", step=name)
            continue
        began = time.time()
        try:
            work(spark, c)
        except Exception:
            state.record(name, "failed", time.time() - began)
            raise
        state.record(name, "completed", time.time() - began)
        log.info("step_completed", step=name, seconds=round(time.time() - began, 2))
        ran.append(name)
    return ran


# command line


def _commands() -> dict:
    read = lambda s, p: tables.read_parquet(s, p)
    write = tables.write_parquet
    cfg = lambda a: Config(mode=a.mode, data=a.data, results=a.results)

    def subset(s, a):
        header = beta_csv.header_index(s, beta_csv.read_header(s, a.beta_matrix))
        sites = sampling.select_sites(header, a.n_cpgs, a.seed)
        samples = sampling.select_samples(beta_csv.sample_ids(s, a.beta_matrix), a.n_samples, read(s, a.clinical_metadata) if a.clinical_metadata else None, seed=a.seed)
        cells = sampling.subset(beta_csv.read_beta_csv(s, a.beta_matrix), sites, samples)
        write(cells.select("sample_id", "sample_ord", "pos", "cpg_id", "beta", "chrom"), a.output, partition_by=["chrom"])

    def compare_cmd(s, a):
        c = Config(mode=a.mode, data=a.data, results=a.results, test=a.test, fdr=a.fdr_method, alpha=a.alpha)
        step_compare(s, c)

    def rank_cmd(s, a):
        enriched = read(s, a.pathway_enrichment) if a.pathway_enrichment else None
        sites = rank.rank_sites(read(s, a.cpg_diff), a.n_top[0]) if a.cpg_diff else None
        genes = rank.rank_genes(read(s, a.gene_diff), enriched, a.n_top[1]) if a.gene_diff else None
        write(rank.report(sites, genes, rank.rank_pathways(enriched, a.n_top[2]) if enriched is not None else None, enrichment=enriched), a.output)

    def graph_cmd(s, a, check=False):
        ext, c = f"{a.data}/external", cfg(a)
        stats = matrix.site_stats(read(s, c.path("beta")))
        inputs = {"genes": read(s, f"{ext}/genes.parquet"), "pathways": read(s, f"{ext}/reactome_pathways.parquet"), "go": read(s, f"{ext}/go_annotations.parquet"), "islands": read(s, f"{ext}/cpg_islands.parquet"), "gene_pathway": read(s, f"{ext}/reactome_gene_pathway.parquet"), "clinical": read(s, c.path("clinical")), "cpg_stats": stats, "mapping": read(s, c.path("mapping"))}
        g = graph.build(inputs, a.step or None, a.min_variance, a.min_coverage)
        if not check:
            return g.save(a.output)
        rows = graph.validate(g, clinical=inputs["clinical"], spot_gene=a.spot_check_gene).collect()
        for row in rows:
            print(*row, sep="\t")
        if a.strict and not all(row["passed"] for row in rows):
            sys.exit(1)

    data = [("--mode", {"default": "production", "choices": ["dev", "production"]}), ("--data", {"default": "data"}), ("--results", {"default": "results"})]
    gopts = [*data, ("--output", {"default": "results/graph"}), ("--step", {"action": "append"}), ("--min-variance", {"type": float, "default": 0.01}), ("--min-coverage", {"type": float, "default": 0.5}), ("--spot-check-gene", {"default": "TP53"}), ("--strict", {"action": "store_true"})]
    need = {"required": True}
    io = [("--input", need), ("--output", need)]
    return {
        "run-pipeline": ([*data, ("--steps", {}), ("--force", {"action": "store_true"}), ("--start-from", {}), ("--status", {"action": "store_true"})], lambda s, a: print(json.dumps(State(cfg(a).path("state"), a.mode).value, indent=2)) if a.status else print(*run(s, cfg(a), a.steps.split(",") if a.steps else None, force=a.force, start_from=a.start_from))),
        "create-dev-subset": ([("--beta-matrix", need), ("--clinical-metadata", {}), ("--output", need), ("--n-cpgs", {"type": int, "default": 1000}), ("--n-samples", {"type": int, "default": 50}), ("--seed", {"type": int, "default": 42})], subset),
        "ingest-clinical": ([("--xlsx-path", need), ("--output", need), ("--sheet-pattern", {"default": "CLIN_*"})], lambda s, a: write(clinical.merge(tables.read_workbook(s, a.xlsx_path, a.sheet_pattern)), a.output)),
        "build-annotations": (data, lambda s, a: step_annotations(s, cfg(a))),
        "convert-beta": ([("--csv-path", need), ("--output-dir", need), ("--chromosomes", {"nargs": "*"})], lambda s, a: print(beta_csv.convert(s, a.csv_path, a.output_dir, a.chromosomes))),
        "dataset-stats": (data, lambda s, a: print(overview(s, cfg(a)))),
        "filter-cpgs": ([*io, ("--min-coverage", {"type": float, "default": 0.95})], lambda s, a: write(matrix.filter_sites(read(s, a.input), a.min_coverage), a.output, partition_by=["chrom"])),
        "map-cpg-genes": ([("--cpg-list", need), ("--genes-parquet", need), ("--output", need), ("--include-intergenic", {"action": "store_true"})], lambda s, a: write(intervals.gene_overlap(tables.read_ids(s, a.cpg_list).select("cpg_id", site_chrom("cpg_id").alias("chrom"), site_pos("cpg_id").alias("pos")), read(s, a.genes_parquet), include_intergenic=a.include_intergenic), a.output)),
        "map-cpg-islands": ([("--cpg-mapping", need), ("--islands", need), ("--output", need)], lambda s, a: write(intervals.island_context(read(s, a.cpg_mapping).select("cpg_id", F.col("chromosome").alias("chrom"), F.col("position").alias("pos")), read(s, a.islands)), a.output)),
        "derive-features": ([("--beta-parquet", need), ("--mapping", need), ("--output", need), ("--method", {"default": "mean", "choices": list(rollup.METHODS)}), ("--weights", {})], lambda s, a: write(rollup.rollup_sites(read(s, a.beta_parquet), read(s, a.mapping).where("gene_symbol <> ''").select(F.col("gene_symbol").alias("gene"), "cpg_id"), a.method, weights=read(s, a.weights) if a.weights else None), a.output)),
        "hypermethylation": ([("--gene-features", need), ("--metadata", need), ("--output-dir", need), ("--quantiles", {"type": float, "nargs": "*", "default": list(hms.QUANTILES)}), ("--control-label", {"default": "Control"})], lambda s, a: hms.run(read(s, a.gene_features), read(s, a.metadata).withColumnRenamed("barcode", "sample_id"), a.output_dir, quantiles=tuple(a.quantiles), control=a.control_label)),
        "run-analysis": ([*data, ("--test", {"default": "mannwhitneyu", "choices": compare.TESTS}), ("--fdr-method", {"default": "fdr_bh", "choices": compare.FDR_METHODS}), ("--alpha", {"type": float, "default": 0.05})], compare_cmd),
        "pathway-enrichment": ([("--diff-results", need), ("--gene-pathway-mapping", need), ("--output", need), ("--method", {"default": "fisher", "choices": ["fisher", "gsea"]}), ("--q-threshold", {"type": float, "default": 0.05}), ("--n-permutations", {"type": int, "default": 1000}), ("--fdr-method", {"default": "fdr_bh", "choices": compare.FDR_METHODS})], lambda s, a: write(enrich.run_enrichment(read(s, a.diff_results), read(s, a.gene_pathway_mapping).toDF("gene", "pathway"), method=a.method, q_threshold=a.q_threshold, n_permutations=a.n_permutations, fdr_method=a.fdr_method), a.output)),
        "biomarker-candidates": ([("--cpg-diff", {}), ("--gene-diff", {}), ("--pathway-enrichment", {}), ("--output", need), ("--n-top", {"type": int, "nargs": 3, "default": [100, 50, 20]})], rank_cmd),
        "generate-report": ([*data, ("--output", need)], lambda s, a: open(a.output, "w").write(build_report(s, cfg(a)))),
        "visualise": (data, lambda s, a: step_visualise(s, cfg(a))),
        "import-graph": (gopts, graph_cmd),
        "validate-import": (gopts, lambda s, a: graph_cmd(s, a, check=True)),
        "parse-betamatrix": ([("--csv", need), ("--output", need), ("--stats-output", {})], lambda s, a: (beta_csv.convert(s, a.csv, a.output), a.stats_output and write(matrix.site_stats(read(s, a.output)), a.stats_output))),
    }


def main(argv: list[str] | None = None) -> None:
    configure()
    commands = _commands()
    top = argparse.ArgumentParser(prog="betaloom", description=__doc__)
    subs = top.add_subparsers(dest="command", required=True)
    for name, (options, _) in commands.items():
        p = subs.add_parser(name)
        for flag, kw in options:
            p.add_argument(flag, **kw)
    args = top.parse_args(argv)
    commands[args.command][1](session(master=os.environ.get("SPARK_MASTER")), args)


if __name__ == "__main__":
    main()
