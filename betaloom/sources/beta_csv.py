"""The wide beta CSV (a row per sample, a column per site) to the long, chromosome-partitioned Parquet store."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.ids import CHROMOSOMES, SITE_ID, strip
from betaloom.operators.order import chunked
from betaloom.sources.scratch import target
from betaloom.sources.site_store import cells_of, write_store

MISSING = ["", "NA", "NaN"]
SPANS = 800  # stretches of 4 million positions in a genome, about


def parse_header(line: str) -> list[str]:
    """The column names of a header line; a blank first one is sample_id."""
    names = line.rstrip("\r\n").split(",")
    return ["sample_id" if i == 0 and not n.strip() else n.strip() for i, n in enumerate(names)]


def read_header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).head(1)
    return parse_header(first[0][0]) if first else []


def header_index(spark: SparkSession, header: list[str], chromosomes: list[str] | None = None) -> DataFrame:
    """(idx, cpg_id, chrom, pos) of the columns whose names are site ids, on the chosen chromosomes."""
    rows = [(i, n, m[1], int(m[2])) for i, n in enumerate(header) if i and (m := re.match(SITE_ID, n)) and (chromosomes is None or m[1] in chromosomes)]
    return spark.createDataFrame(rows, "idx int, cpg_id string, chrom string, pos long")


def sample_ids(spark: SparkSession, path: str) -> DataFrame:
    """The first column of every row but the header: only a prefix of each line is looked at."""
    lines = spark.read.text(path).withColumn("n", F.monotonically_increasing_id())
    return lines.where("n > 0").select(strip(F.substring_index("value", ",", 1)).alias("sample_id"))


def read_beta_csv(spark: SparkSession, path: str, chromosomes: list[str] | None = None) -> DataFrame:
    """The long relation of a CSV file, see parse_lines."""
    lines = spark.read.text(path).withColumn("sample_ord", F.monotonically_increasing_id()).where("sample_ord > 0")
    return parse_lines(lines, read_header(spark, path), chromosomes)


def parse_lines(lines: DataFrame, header: list[str], chromosomes: list[str] | None = None) -> DataFrame:
    """lines (value, sample_ord) to the long relation with a raw column: sample_id, sample_ord, chrom, pos, cpg_id, raw, beta.

    Missing tokens and cells that are no numbers give a null beta; a short row simply has fewer cells. A line is split
    once and its cells find their site by position, so the plan does not grow with the number of columns.
    """
    index = header_index(lines.sparkSession, header, chromosomes)
    cells = F.split(F.regexp_replace("value", r"\r$", ""), ",", -1)
    rows = lines.where(strip("value") != "").select("sample_ord", strip(cells[0]).alias("sample_id"), F.posexplode(cells).alias("idx", "raw")).where("idx > 0")
    value = F.when(~strip("raw").isin(MISSING), strip("raw").try_cast("float"))
    # the index is metadata of the one header line, some 40 bytes a column; past 5 million columns it is shuffled instead
    joined = rows.join(F.broadcast(index) if len(header) <= 5_000_000 else index, "idx")
    return joined.select("sample_id", "sample_ord", "chrom", "pos", "cpg_id", "raw", F.when(~F.isnan(value), value).alias("beta"))


def convert(spark: SparkSession, path: str, out: str, chromosomes: list[str] | None = None) -> tuple[dict[str, int], int]:
    """Write the long store below out, a folder per chromosome, and its dictionary of sites; returns ({chromosome: sites}, unparsable cells).

    A task takes some 4 million positions of a chromosome, and of the samples a block: so many blocks that a task gets
    about 128 MB of the file, however many samples there are.
    """
    if chromosomes is not None and (bad := set(chromosomes) - set(CHROMOSOMES)):
        raise ValueError(f"unknown chromosomes: {sorted(bad)}")
    cells = read_beta_csv(spark, path, chromosomes)
    store = cells.select("sample_id", "sample_ord", "pos", "cpg_id", "beta", "chrom", (F.col("beta").isNull() & ~strip("raw").isin(MISSING)).alias("bad"))
    at, files = target(spark, path)
    write_store(store, out, sample_blocks=max(1, files.getContentSummary(at).getLength() // (SPANS * 128 << 20)))
    counts = {r[0]: r[1] for r in header_index(spark, read_header(spark, path), chromosomes).groupBy("chrom").count().collect()}  # a row per chromosome
    return counts, cells_of(spark, out).where("bad").count()


def column_chunks(df: DataFrame, size: int = 10_000, key: str = "sample_id", progress=None) -> Iterator[DataFrame]:
    """Projections of key and `size` further columns each; each reads its own columns only."""
    rest = [c for c in df.columns if c != key]
    for at in range(0, len(rest), size):
        yield df.select(key, *[F.col(f"`{c}`") for c in rest[at : at + size]])
        if progress:
            progress(min(at + size, len(rest)), len(rest))


def row_chunks(df: DataFrame, size: int = 100, order: str = "sample_id") -> DataFrame:
    """df with a chunk number: rows in order (nulls first), `size` in each chunk but the last; no task holds the table."""
    return chunked(df, [F.col(order)], size)


def to_parquet(spark: SparkSession, path: str, out: str, compression: str = "zstd") -> None:
    """The CSV as one wide Parquet table of strings and doubles, for narrow files."""
    spark.read.csv(path, header=True, nanValue="NaN").write.mode("overwrite").option("compression", compression).parquet(out)
