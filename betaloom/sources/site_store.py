"""The cell store on disk: a folder per chromosome, sorted by position, with a dictionary of its sites.

A question about a few sites reads a few files. The dictionary (`_sites` in the store's folder: number in site order, id,
chromosome, position, files, cells) is written once with the store and is itself sorted, so a look-up reads one of its
row groups. Sites asked for by name are turned into literal filters: chromosomes prune folders, the dictionary names the
files, and positions reach the Parquet scan, where statistics of row groups and pages skip the rest.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.ids import SITE_ID, present, site_order
from betaloom.operators.order import numbered
from betaloom.sources.scratch import materialize

SITES = "_sites"
SPAN = 4_000_000  # positions that go to one task
LITERALS = 1_000  # sites up to which a list becomes literal filters; longer lists are joined


def write_store(cells: DataFrame, out: str, *, sample_blocks: int = 1, row_group_bytes: int = 8 << 20) -> None:
    """Write cells (sample_id, chrom, pos, cpg_id, beta and any others) below out, and the dictionary of their sites.

    A task holds SPAN positions of a chromosome for one of `sample_blocks` blocks of samples, or the part of them that
    adaptive execution cuts off where they hold more than its advisory size: few sites of many samples are not left to a
    few tasks. Cells without chromosome or position are left out, repeated cells stay. An empty table gives an empty store.
    """
    rows = cells.where(F.col("chrom").isNotNull() & F.col("pos").isNotNull()).withColumn("__span", F.floor(F.col("pos") / SPAN)).withColumn("__block", F.pmod(F.xxhash64("sample_id"), F.lit(sample_blocks)))
    order = ["sample_ord"] if "sample_ord" in cells.columns else ["sample_id"]
    rows = rows.hint("rebalance", "chrom", "__span", "__block").sortWithinPartitions("chrom", "pos", *order).drop("__span", "__block")
    rows.write.mode("overwrite").partitionBy("chrom").option("compression", "zstd").option("parquet.block.size", row_group_bytes).parquet(out)
    write_sites(cells.sparkSession, out, _kinds(rows))


def _kinds(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def write_sites(spark: SparkSession, out: str, schema: str | None = None) -> None:
    """The dictionary of a store, from its id columns alone; to be written again when cells have been added."""
    reader = spark.read.schema(schema) if schema else spark.read
    file = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    # cells are counted by site and file first, and once: numbering looks at its rows twice
    held = reader.parquet(out).select("cpg_id", "chrom", "pos", F.col("_metadata.file_path").alias("path")).groupBy("cpg_id", "chrom", "pos", "path").agg(F.count(F.lit(1)).alias("n"))
    sites = held.groupBy("cpg_id", "chrom", "pos").agg(F.array_sort(F.collect_set(file)).alias("files"), F.sum("n").alias("n_cells"))
    ordered = numbered(materialize(sites, "sites"), site_order("cpg_id"), name="ord")
    ordered.repartitionByRange(max(1, spark.sparkContext.defaultParallelism), "ord").sortWithinPartitions("ord").write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 1 << 20).parquet(f"{out}/{SITES}")


def site_dictionary(spark: SparkSession, store: str) -> DataFrame:
    """ord (from 1, in site order), cpg_id, chrom, pos, files, n_cells."""
    return spark.read.parquet(f"{store}/{SITES}")


def cells_of(spark: SparkSession, store: str) -> DataFrame:
    """All cells of a store."""
    return spark.read.parquet(store)


def parsed(sites: list[str]) -> dict[str, tuple[str, int]]:
    """Chromosome and position of the valid ids among sites, once each."""
    return {s: (m[1], int(m[2])) for s in dict.fromkeys(sites) if (m := re.match(SITE_ID, s))}


def at_sites(cells: DataFrame, sites: list[str]) -> DataFrame:
    """Cells (chrom, pos, cpg_id and others) of the listed sites by literal filters, which reach a scan; malformed ids are passed over."""
    known = parsed(sites)
    if not known:
        return cells.where("false")
    chroms, places = zip(*known.values())
    low, high = min(places), max(places)
    return cells.where(F.col("chrom").isin(*sorted(set(chroms))) & F.col("pos").isin(*sorted(set(places))) & F.col("pos").between(low, high) & F.col("cpg_id").isin(*known))


def read_sites(spark: SparkSession, store: str, sites: list[str] | DataFrame) -> DataFrame:
    """The cells of the sites asked for: a list of ids, or a table with a cpg_id column.

    Up to LITERALS ids of a list read the files that the dictionary names, and of these only what lies at their
    positions. More ids, or a table, are joined by chromosome and position. Unknown and malformed ids give no cells, an
    id that is asked for twice gives its cells once.
    """
    if isinstance(sites, list) and len(known := parsed(sites)) <= LITERALS:
        if not known:
            return cells_of(spark, store).where("false")
        found = at_sites(site_dictionary(spark, store), list(known)).select(F.explode("files").alias("file")).distinct().collect()  # files of at most LITERALS sites
        files = sorted(f"{store}/{r.file}" for r in found)
        schema = cells_of(spark, store).schema
        return at_sites(spark.read.schema(schema).option("basePath", store).parquet(*files), list(known)) if files else cells_of(spark, store).where("false")
    asked = spark.createDataFrame([(s,) for s in sites], "cpg_id string") if isinstance(sites, list) else sites.select("cpg_id")
    places = site_dictionary(spark, store).join(asked.distinct(), "cpg_id", "left_semi").select("chrom", "pos", "cpg_id")
    return cells_of(spark, store).join(places, ["chrom", "pos", "cpg_id"], "left_semi")


def first_sites(spark: SparkSession, store: str, n: int = 100) -> list[str]:
    """The first n sites in site order, from the dictionary alone."""
    return [r.cpg_id for r in site_dictionary(spark, store).where(F.col("ord") <= n).select("ord", "cpg_id").orderBy("ord").collect()]


def store_value_stats(spark: SparkSession, store: str, n_sites: int = 100) -> DataFrame:
    """Mean, median and standard deviation (population) over the first n_sites sites, reading only these."""
    v = present("beta")
    return read_sites(spark, store, first_sites(spark, store, n_sites)).agg(F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"))


def chromosome_counts(spark: SparkSession, store: str) -> DataFrame:
    """(chrom, n_sites, n_cells) of a store, from its dictionary."""
    return site_dictionary(spark, store).groupBy("chrom").agg(F.count(F.lit(1)).alias("n_sites"), F.sum("n_cells").alias("n_cells"))
