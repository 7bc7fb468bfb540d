"""Genes, ontology annotations, pathways, islands and gene sets from their public text formats."""

from __future__ import annotations

import os
import urllib.parse
import urllib.request

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import aspect_name, strip_version


def lines(spark: SparkSession, path: str, comment: str) -> DataFrame:
    """value and its place n; lines that begin with the comment mark are left out. Reads gzip by name."""
    return spark.read.text(path).withColumn("n", F.monotonically_increasing_id()).where(~F.col("value").startswith(comment))


def fields(rows: DataFrame, least: int) -> DataFrame:
    """The tab-separated fields f of rows with at least `least` of them."""
    return rows.withColumn("f", F.split("value", "\t", -1)).where(F.size("f") >= least)


def attribute(attributes: Column, name: str) -> Column:
    """The value of the last `name "value"` in a list of attributes, null if there is none."""
    found = F.regexp_extract_all(attributes, F.lit(rf'(?:^|;)\s*{name}\s+"([^"]*)"'), F.lit(1))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def gtf(rows: DataFrame, feature: str = "gene") -> DataFrame:
    """gene_id (no version), gene_symbol, chrom, start, end, strand, biotype; the first line of a gene stays. rows: value, n."""
    f = fields(rows, 9).where(F.col("f")[2] == feature)
    attrs = F.col("f")[8]
    biotype = F.coalesce(attribute(attrs, "gene_type"), attribute(attrs, "gene_biotype"), F.lit(""))
    out = f.select("n", strip_version(F.coalesce(attribute(attrs, "gene_id"), F.lit(""))).alias("gene_id"), F.coalesce(attribute(attrs, "gene_name"), F.lit("")).alias("gene_symbol"), F.col("f")[0].alias("chrom"), F.col("f")[3].try_cast("bigint").alias("start"), F.col("f")[4].try_cast("bigint").alias("end"), F.col("f")[6].alias("strand"), biotype.alias("biotype"))
    first = F.row_number().over(Window.partitionBy("gene_id").orderBy("n"))
    return out.withColumn("k", first).where("k = 1").drop("k", "n")


def gaf(rows: DataFrame, taxon: str = "taxon:9606") -> DataFrame:
    """gene_symbol, go_id, evidence_code, aspect, qualifier of the taxon, distinct."""
    f = fields(rows, 15).where(F.col("f")[12].contains(taxon))
    return f.select(F.col("f")[2].alias("gene_symbol"), F.col("f")[4].alias("go_id"), F.col("f")[6].alias("evidence_code"), aspect_name(F.col("f")[8]).alias("aspect"), F.col("f")[3].alias("qualifier")).distinct()


def reactome_pathways(rows: DataFrame, species: str = "Homo sapiens") -> DataFrame:
    f = fields(rows, 3).where(F.col("f")[2].contains(species))
    return f.select(F.col("f")[0].alias("pathway_id"), F.col("f")[1].alias("pathway_name"), F.lit("Reactome").alias("pathway_source"))


def reactome_genes(rows: DataFrame, species: str = "Homo sapiens") -> DataFrame:
    f = fields(rows, 6).where(F.col("f")[5].contains(species))
    return f.select(strip_version(F.col("f")[0]).alias("gene_id"), F.col("f")[1].alias("pathway_id"), F.col("f")[4].alias("evidence_code")).distinct()


def _tag(line: Column, name: str) -> Column:
    """What follows "name: ", without a trailing comment."""
    return F.trim(F.regexp_replace(F.substr(line, F.lit(len(name) + 3)), r"\s+!.*$", ""))


def obo_stanzas(spark: SparkSession, path: str) -> DataFrame:
    """The stanzas of an OBO file, a row each (value): blank lines part them, so the file splits as any other text."""
    return spark.read.text(path, lineSep="\n\n")


def obo_terms(stanzas: DataFrame, keep_obsolete: bool = False) -> DataFrame:
    """term_id, name, namespace, is_obsolete and parents (array of relation, parent_id) of the [Term] stanzas with an id."""
    of = F.filter(F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(x)), lambda x: x != "")

    def first(name: str) -> Column:
        return F.get(F.transform(F.filter("l", lambda x: x.startswith(f"{name}: ")), lambda x: _tag(x, name)), 0)

    lines_ = stanzas.select(of.alias("l")).where(F.get("l", 0) == "[Term]")
    is_a = F.transform(F.filter("l", lambda x: x.startswith("is_a: ")), lambda x: F.struct(F.lit("is_a").alias("relation"), F.split_part(_tag(x, "is_a"), F.lit(" "), F.lit(1)).alias("parent_id")))
    related = F.transform(F.filter("l", lambda x: x.startswith("relationship: ")), lambda x: F.struct(F.split_part(_tag(x, "relationship"), F.lit(" "), F.lit(1)).alias("relation"), F.split_part(_tag(x, "relationship"), F.lit(" "), F.lit(2)).alias("parent_id")))
    out = lines_.select(first("id").alias("term_id"), F.coalesce(first("name"), F.lit("")).alias("name"), F.coalesce(first("namespace"), F.lit("")).alias("namespace"), F.coalesce(first("is_obsolete") == "true", F.lit(False)).alias("is_obsolete"), F.concat(is_a, related).alias("parents"))
    out = out.where("term_id is not null")
    return out if keep_obsolete else out.where("not is_obsolete")


def obo_edges(terms: DataFrame, relations: tuple[str, ...] = ("is_a", "part_of")) -> DataFrame:
    """(child, parent, relation) of the wanted relations, distinct."""
    edges = terms.select(F.col("term_id").alias("child"), F.explode("parents").alias("p")).select("child", F.col("p.parent_id").alias("parent"), F.col("p.relation").alias("relation"))
    return edges.where(F.col("relation").isin(*relations) & (F.col("parent") != "")).distinct()


def islands(rows: DataFrame) -> DataFrame:
    """region_id (the name), chrom, start, end, cpg_count, gc_fraction (percent / 100, blank 0), obs_exp_ratio."""
    f, cell = fields(rows, 11), F.col("f")
    return f.select(cell[4].alias("region_id"), cell[1].alias("chrom"), cell[2].try_cast("bigint").alias("start"), cell[3].try_cast("bigint").alias("end"), cell[6].try_cast("bigint").alias("cpg_count"), F.coalesce(cell[9].try_cast("double") / 100, F.lit(0.0)).alias("gc_fraction"), F.coalesce(cell[10].try_cast("double"), F.lit(0.0)).alias("obs_exp_ratio"))


def gmt(rows: DataFrame) -> DataFrame:
    """(set_id, description, gene) of a gene set file, distinct."""
    f = fields(rows, 3)
    return f.select(F.col("f")[0].alias("set_id"), F.col("f")[1].alias("description"), F.explode(F.slice("f", 3, F.size("f"))).alias("gene")).where("gene <> ''").distinct()


def read_gtf(spark: SparkSession, path: str, feature: str = "gene") -> DataFrame:
    return gtf(lines(spark, path, "#"), feature)


def read_gaf(spark: SparkSession, path: str) -> DataFrame:
    return gaf(lines(spark, path, "!"))


def read_reactome(spark: SparkSession, pathways: str, genes: str) -> tuple[DataFrame, DataFrame]:
    return reactome_pathways(lines(spark, pathways, "#")), reactome_genes(lines(spark, genes, "#"))


def read_islands(spark: SparkSession, path: str) -> DataFrame:
    return islands(lines(spark, path, "#"))


def read_gmt(spark: SparkSession, path: str) -> DataFrame:
    return gmt(lines(spark, path, "#"))


def download(url: str, path: str, *, force: bool = False, tries: int = 3) -> str:
    """Fetch url to path unless it is there; http, https and ftp only."""
    if urllib.parse.urlparse(url).scheme not in ("http", "https", "ftp"):
        raise ValueError(f"scheme not allowed: {url}")
    if os.path.exists(path) and not force:
        return path
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    for left in reversed(range(tries)):
        try:
            urllib.request.urlretrieve(url, f"{path}.part")
            os.replace(f"{path}.part", path)
            return path
        except OSError:
            if not left:
                raise
    return path
