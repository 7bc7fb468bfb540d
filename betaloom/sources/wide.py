"""Wide files, one per chromosome, with a row per sample and a column per site, back into one long relation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.operators.matrix import long_matrix
from betaloom.operators.order import numbered

PLACE = ["__file", "__row"]


def read_wide(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The file of each chromosome with the place of every row, so that the order of samples is known."""
    return {chrom: spark.read.parquet(p).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row")) for chrom, p in paths.items()}


def missing_columns(frames: dict[str, DataFrame], sites: list[str]) -> list[str]:
    """Those of the wanted sites that no file has, in their order."""
    have = {c for f in frames.values() for c in f.columns}
    return [s for s in dict.fromkeys(sites) if s not in have]


def sample_order(frame: DataFrame, key: str = "sample_id") -> DataFrame:
    """(sample, sample_ord from 1) in the file's order; of repeated samples the first row counts."""
    rows = frame.select(F.col(key).cast("string").alias(key), *PLACE).groupBy(key).agg(F.min(F.struct(*PLACE)).alias("p")).select(key, "p.*")
    return numbered(rows, [F.col(c) for c in PLACE], name="sample_ord").select(key, "sample_ord")


def order_report(frames: dict[str, DataFrame], key: str = "sample_id") -> DataFrame:
    """Per file: n_samples, n_missing (samples of the first file that it lacks), n_extra and n_moved (others in another place)."""
    names = list(frames)
    first = sample_order(frames[names[0]], key).withColumnRenamed("sample_ord", "a")

    def one(name: str) -> DataFrame:
        own = sample_order(frames[name], key).withColumnRenamed("sample_ord", "b")
        a, b = F.col("a"), F.col("b")
        return first.join(own, key, "full").agg(F.lit(name).alias("chrom"), F.count(b).alias("n_samples"), F.count_if(b.isNull()).alias("n_missing"), F.count_if(a.isNull()).alias("n_extra"), F.count_if(a != b).alias("n_moved"))

    return reduce(DataFrame.unionByName, [one(n) for n in names])


def stitch(frames: dict[str, DataFrame], key: str = "sample_id", *, sites: list[str] | None = None, strict: bool = True) -> DataFrame:
    """The cells of all files: sample_id, sample_ord (place in the first file), chrom, pos, cpg_id, beta.

    Cells find their sample by its id, so no file is joined to another. strict: files must hold the same samples in the
    same order, else ValueError; otherwise samples that all files have are kept, in the first file's order. sites: only
    these columns, KeyError for those that no file has. Columns that are no site ids are left out.
    """
    if sites is not None and (lost := missing_columns(frames, sites)):
        raise KeyError(f"no file has {lost}")
    names = list(frames)
    if strict:
        off = [r.chrom for r in order_report(frames, key).where("n_missing + n_extra + n_moved > 0").collect()]  # a row per file
        if off:
            raise ValueError(f"other samples, or another order, than in {names[0]}: {off}")
    order = sample_order(frames[names[0]], key)
    if not strict and len(names) > 1:
        for n in names[1:]:
            order = order.join(frames[n].select(F.col(key).cast("string").alias(key)).distinct(), key, "left_semi")
    wanted = {n: [c for c in f.columns if sites is None or c in set(sites)] for n, f in frames.items()}
    parts = [long_matrix(f.drop(*PLACE), key, wanted[n]) for n, f in frames.items() if any("_" in c and c not in (key, *PLACE) for c in wanted[n])]
    cells = reduce(DataFrame.unionByName, parts)
    return cells.join(order.withColumnRenamed(key, "sample_id"), "sample_id").select("sample_id", "sample_ord", "chrom", "pos", "cpg_id", "beta")
