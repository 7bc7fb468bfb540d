"""The knowledge graph as one DataFrame per entity and relation, its lookups as joins, and its validation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from betaloom.operators.intervals import region_overlap
from betaloom.operators.matrix import variable_sites
from betaloom.sources.batches import FAILED, Sink, write_batches


@dataclass
class Graph:
    """Vertices v_*, edges e_*, and results r_* and f_*. A part that is not loaded is None."""

    v_sample: DataFrame | None = None  # barcode, clinical_category
    v_cpg: DataFrame | None = None  # cpg_id, chromosome, position, mean_beta, variance, missingness, n_samples, is_biomarker_candidate
    v_gene: DataFrame | None = None  # gene_id, gene_symbol, chrom, start, end, strand, biotype
    v_pathway: DataFrame | None = None  # pathway_id, pathway_name, pathway_source
    v_term: DataFrame | None = None  # term_id, term_name, namespace
    v_region: DataFrame | None = None  # region_id, region_type, chrom, start, end
    v_cohort: DataFrame | None = None  # cohort_id, cohort_name
    v_provenance: DataFrame | None = None
    e_cpg_gene: DataFrame | None = None  # cpg_id, gene_id, overlap_type
    e_gene_pathway: DataFrame | None = None  # gene_id, pathway_id
    e_gene_term: DataFrame | None = None  # gene_id, term_id, evidence_code
    e_cpg_region: DataFrame | None = None  # cpg_id, region_id
    e_sample_cohort: DataFrame | None = None  # barcode, cohort_id
    f_gene_sample: DataFrame | None = None  # gene_id, barcode, value
    r_gene_diff: DataFrame | None = None  # label, gene_id, q_value
    r_pathway_diff: DataFrame | None = None  # label, pathway_id, q_value

    def save(self, path: str) -> None:
        for f in fields(self):
            if getattr(self, f.name) is not None:
                getattr(self, f.name).write.mode("overwrite").parquet(f"{path}/{f.name}")

    def send(self, connect: Callable[[], Sink], size: int = 1000) -> tuple[DataFrame, dict[str, DataFrame]]:
        """Write all parts to a sink in batches of `size`, vertices before the edges that name them: (outcomes, failed rows of each part that has any).

        Rows are ordered by all their columns, so a batch's name means the same rows in every run, see write_batches. An
        outcome has part, batch, name, n_rows, status and error.
        """
        found, failed = [], {}
        for f in fields(self):
            rows = getattr(self, f.name)
            if rows is None:
                continue
            outcomes, left = write_batches(rows, [F.col(f"`{c}`") for c in rows.columns], connect, table=f.name, size=size)
            found.append(outcomes.select(F.lit(f.name).alias("part"), "*"))
            if not outcomes.where(F.col("status") == FAILED).isEmpty():
                failed[f.name] = left
        if not found:
            raise ValueError("the graph has no part")
        return reduce(DataFrame.unionByName, found), failed


# importers: relations from parsed files; edges need both ends


def genes(parsed: DataFrame) -> DataFrame:
    return parsed.select("gene_id", "gene_symbol", "chrom", "start", "end", "strand", "biotype")


def pathways(parsed: DataFrame) -> DataFrame:
    return parsed.select("pathway_id", "pathway_name", "pathway_source")


def terms(annotations: DataFrame) -> DataFrame:
    """A term per id, named by it; of several namespaces the first by name."""
    return annotations.groupBy(F.col("go_id").alias("term_id")).agg(F.min("aspect").alias("namespace")).select("term_id", F.col("term_id").alias("term_name"), "namespace")


def regions(islands: DataFrame) -> DataFrame:
    """Islands by coordinate id, which unlike their names is unique."""
    return islands.select(F.format_string("%s:%d-%d", "chrom", "start", "end").alias("region_id"), F.lit("cpg_island").alias("region_type"), "chrom", "start", "end")


def gene_pathway_edges(mapping: DataFrame, v_gene: DataFrame, v_pathway: DataFrame) -> DataFrame:
    return mapping.select("gene_id", "pathway_id").distinct().join(v_gene.select("gene_id").distinct().hint("merge"), "gene_id", "left_semi").join(v_pathway.select("pathway_id").distinct(), "pathway_id", "left_semi")


def gene_term_edges(annotations: DataFrame, v_gene: DataFrame, v_term: DataFrame) -> DataFrame:
    """Annotations name genes by symbol. Genes are never broadcast: estimated from a file's size they look small."""
    rows = annotations.select("gene_symbol", F.col("go_id").alias("term_id"), "evidence_code").distinct()
    return rows.join(v_gene.select("gene_symbol", "gene_id").hint("merge"), "gene_symbol").join(v_term.select("term_id"), "term_id", "left_semi").select("gene_id", "term_id", "evidence_code")


def samples(clinical: DataFrame) -> DataFrame:
    return clinical.select("barcode", "clinical_category")


def cpgs(stats: DataFrame, min_variance: float = 0.01, min_coverage: float = 0.5) -> DataFrame:
    return variable_sites(stats, min_variance, min_coverage).withColumn("is_biomarker_candidate", F.lit(False))


def cpg_gene_edges(mapping: DataFrame, v_cpg: DataFrame, v_gene: DataFrame) -> DataFrame:
    rows = mapping.where("overlap_type <> 'intergenic'").select("cpg_id", "gene_id", "overlap_type")
    return rows.join(v_cpg.select("cpg_id").hint("merge"), "cpg_id", "left_semi").join(v_gene.select("gene_id").distinct().hint("merge"), "gene_id", "left_semi")


def cpg_region_edges(v_cpg: DataFrame, v_region: DataFrame, one_based: bool = False) -> DataFrame:
    return region_overlap(v_cpg.select("cpg_id", F.col("chromosome").alias("chrom"), F.col("position").alias("pos")), v_region, one_based=one_based)


STEPS = ["genes", "pathways", "terms", "regions", "gene_pathway", "gene_term", "samples", "cpgs", "cpg_gene", "cpg_region"]


def build(inputs: dict[str, DataFrame], steps: list[str] | None = None, min_variance: float = 0.01, min_coverage: float = 0.5) -> Graph:
    """The graph from parsed inputs (genes, pathways, go, islands, gene_pathway, clinical, cpg_stats, mapping), by step in order."""
    g, steps = Graph(), steps or STEPS
    unknown = set(steps) - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    make = {
        "genes": ("v_gene", lambda: genes(inputs["genes"])),
        "pathways": ("v_pathway", lambda: pathways(inputs["pathways"])),
        "terms": ("v_term", lambda: terms(inputs["go"])),
        "regions": ("v_region", lambda: regions(inputs["islands"])),
        "gene_pathway": ("e_gene_pathway", lambda: gene_pathway_edges(inputs["gene_pathway"], g.v_gene, g.v_pathway)),
        "gene_term": ("e_gene_term", lambda: gene_term_edges(inputs["go"], g.v_gene, g.v_term)),
        "samples": ("v_sample", lambda: samples(inputs["clinical"])),
        "cpgs": ("v_cpg", lambda: cpgs(inputs["cpg_stats"], min_variance, min_coverage)),
        "cpg_gene": ("e_cpg_gene", lambda: cpg_gene_edges(inputs["mapping"], g.v_cpg, g.v_gene)),
        "cpg_region": ("e_cpg_region", lambda: cpg_region_edges(g.v_cpg, g.v_region)),
    }
    for step in (s for s in STEPS if s in steps):
        name, rows = make[step]
        setattr(g, name, rows())
    return g


# lookups


def genes_in_pathway(g: Graph, pathway_id: str) -> DataFrame:
    return g.v_gene.join(g.e_gene_pathway.where(F.col("pathway_id") == pathway_id).select("gene_id").distinct(), "gene_id", "left_semi")


def cpgs_for_gene(g: Graph, gene_id: str) -> DataFrame:
    return g.v_cpg.join(g.e_cpg_gene.where(F.col("gene_id") == gene_id).select("cpg_id").distinct(), "cpg_id", "left_semi")


def cpgs_in_pathway(g: Graph, pathway_id: str) -> DataFrame:
    members = g.e_gene_pathway.where(F.col("pathway_id") == pathway_id).select("gene_id").distinct()
    return g.v_cpg.join(g.e_cpg_gene.join(members, "gene_id", "left_semi").select("cpg_id").distinct(), "cpg_id", "left_semi")


def pathways_for_gene(g: Graph, gene_id: str) -> DataFrame:
    return g.v_pathway.join(g.e_gene_pathway.where(F.col("gene_id") == gene_id).select("pathway_id").distinct(), "pathway_id", "left_semi")


def go_terms_for_gene(g: Graph, gene_id: str) -> DataFrame:
    return g.v_term.join(g.e_gene_term.where(F.col("gene_id") == gene_id).select("term_id").distinct(), "term_id", "left_semi")


def genes_with_term(g: Graph, term_id: str) -> DataFrame:
    return g.v_gene.join(g.e_gene_term.where(F.col("term_id") == term_id).select("gene_id").distinct(), "gene_id", "left_semi")


def samples_in_category(g: Graph, category: str) -> DataFrame:
    return g.v_sample.where(F.col("clinical_category") == category)


def cpgs_in_region_type(g: Graph, region_type: str) -> DataFrame:
    kind = g.v_region.where(F.col("region_type") == region_type).select("region_id").distinct()
    return g.v_cpg.join(g.e_cpg_region.join(kind, "region_id", "left_semi").select("cpg_id").distinct(), "cpg_id", "left_semi")


def significant_genes(g: Graph, label: str, threshold: float) -> DataFrame:
    return g.r_gene_diff.where((F.col("label") == label) & (F.col("q_value") <= threshold)).select("gene_id", "q_value")


def significant_pathways(g: Graph, label: str, threshold: float) -> DataFrame:
    return g.r_pathway_diff.where((F.col("label") == label) & (F.col("q_value") <= threshold)).select("pathway_id", "q_value")


def biomarker_cpgs(g: Graph) -> DataFrame:
    return g.v_cpg.where("is_biomarker_candidate")


def gene_methylation_for_sample(g: Graph, barcode) -> DataFrame:
    return g.f_gene_sample.where(F.col("barcode") == barcode).select("gene_id", "value")


def validate(g: Graph, *, clinical: DataFrame | None = None, spot_gene: str = "TP53") -> DataFrame:
    """Check rows (name, passed, expected, actual, message): entities and relations are there, samples agree, a gene has links."""
    rows = []

    def check(df: DataFrame, name: str, expected: DataFrame | None = None) -> None:
        n = df.agg(F.count(F.lit(1)).alias("actual")).withColumn("k", F.lit(1))
        want = expected.agg(F.count(F.lit(1)).alias("e")).withColumn("k", F.lit(1)) if expected is not None else None
        n = n.join(want, "k") if want is not None else n.withColumn("e", F.lit(None).cast("long"))  # one row each
        passed = F.col("actual") == F.col("e") if expected is not None else F.col("actual") > 0
        want_text = F.col("e").cast("string") if expected is not None else F.lit("> 0")
        rows.append(n.select(F.lit(name).alias("name"), passed.alias("passed"), want_text.alias("expected"), F.col("actual").cast("string").alias("actual"), F.when(passed, "ok").otherwise("unexpected count").alias("message")))

    for name in ("v_sample", "v_cpg", "v_gene", "v_pathway", "v_term", "v_region", "e_cpg_gene", "e_gene_pathway", "e_gene_term", "e_cpg_region"):
        if getattr(g, name) is not None:
            check(getattr(g, name), name)
    if clinical is not None and g.v_sample is not None:
        check(g.v_sample, "samples_match_clinical", clinical)
    if g.v_gene is not None:
        own = g.v_gene.where(F.col("gene_symbol") == spot_gene).select("gene_id")
        for name in ("e_gene_pathway", "e_gene_term", "e_cpg_gene"):
            if getattr(g, name) is not None:
                check(getattr(g, name).join(own, "gene_id", "left_semi"), f"spot_{name}")
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out
