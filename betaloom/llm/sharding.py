"""Contiguous shards of near-equal bytes from global prefix sums.

Rows are ordered by (doc_id, position in the input), nulls first, and dealt to range partitions. Every partition
sums its bytes and rows; the driver sees one total per partition only, adds them up, and every row then knows its
global byte offset and row number. A row goes to the shard in which the middle of its bytes falls when the whole
is cut at equal targets, so a shard misses the target by half a document at each end at most.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, shuffle_partitions


def _running(batches):
    pid, base, row = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        size = b.column("size").to_numpy()
        cum = np.cumsum(size, dtype=np.int64)
        n = len(size)
        if n:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, pid, np.int32)), pa.array(base + cum - size), pa.array(np.arange(row, row + n, dtype=np.int64))],
                names=[*b.schema.names, "pid", "before", "row"],
            )
            base, row = base + int(cum[-1]), row + n


def shard_by_bytes(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", seq_col: str | None = None) -> DataFrame:
    """One row per input row: doc_id, seq, size (UTF-8 bytes + 1), text_crc32, shard, slot (gapless from 0 in its shard).

    Null or empty text: size 1, checksum 0. Null ids come first. Repeated rows and equal ids keep a place each, in
    input order. Other columns are ignored. An empty table gives no rows; with fewer rows than shards, some shards
    stay empty.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    sized = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8")).alias("text_crc32"),
        (F.col(seq_col) if seq_col else F.monotonically_increasing_id()).alias("seq"),
    )
    sized = materialize(sized, "shard-sizes")
    dealt = sized.repartitionByRange(shuffle_partitions(spark), "doc_id", "seq").sortWithinPartitions("doc_id", "seq")
    dealt = materialize(dealt.mapInArrow(_running, "doc_id long, size long, text_crc32 long, seq long, pid int, before long, row long"), "shard-runs")
    totals = sorted(tuple(r) for r in dealt.groupBy("pid").agg(F.sum("size"), F.count(F.lit(1))).collect())  # a row per partition
    bytes_before = list(accumulate((t[1] for t in totals), initial=0))
    rows_before = list(accumulate((t[2] for t in totals), initial=0))
    total = bytes_before[-1]
    offsets = spark.createDataFrame([(t[0], b, r) for t, b, r in zip(totals, bytes_before, rows_before)], "pid int, bytes_before long, rows_before long")
    placed = (
        dealt.join(F.broadcast(offsets), "pid")
        .withColumn("before", F.col("before") + F.col("bytes_before"))
        .withColumn("row", F.col("row") + F.col("rows_before"))
        .withColumn("shard", F.expr(f"cast(((2 * before + size) * {n_shards}L) div {max(1, 2 * total)}L as int)"))
    )
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "seq", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of docs as shard=N folders below path, each in slot order within its files; null texts and repeated rows are written each."""
    kept = materialize(docs.withColumn("__seq", F.monotonically_increasing_id()), "shard-input")
    plan = shard_by_bytes(kept, n_shards, id_col, text_col, seq_col="__seq").select(F.col("seq").alias("__seq"), F.col("shard").alias("__shard"), "slot")
    rows = kept.join(plan.withColumnRenamed("slot", "__slot"), "__seq").drop("__seq").withColumnRenamed("__shard", "shard")
    rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "shard", "__slot").sortWithinPartitions("shard", "__slot").drop("__slot").write.partitionBy("shard").parquet(path)
