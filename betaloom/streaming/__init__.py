"""Structured Streaming: cells of new samples into the store, and running site statistics from mergeable moments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.functions.ids import present

CELL = "sample_id string, chrom string, pos long, cpg_id string, beta float"


def read_cells(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(CELL).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def append_to_store(cells: DataFrame, store: str, checkpoint: str):
    """Append new cells to the store; the checkpoint makes each file count once."""
    return cells.writeStream.partitionBy("chrom").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(store, format="parquet", outputMode="append")


def moments(cells: DataFrame) -> DataFrame:
    """Per site n_samples, n_total, mean_beta and variance so far, from central moments that merge across batches without cancelling."""
    v = present("beta")
    agg = cells.groupBy("cpg_id").agg(F.count(v).alias("n_samples"), F.count(F.lit(1)).alias("n_total"), F.avg(v).alias("mean_beta"), F.var_samp(v).alias("variance"))
    return agg.withColumn("variance", F.when(F.col("n_samples") == 1, F.lit(0.0)).otherwise(F.col("variance")))
