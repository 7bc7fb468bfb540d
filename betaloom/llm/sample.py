"""Bounded samples of whole training rows; the driver and the plan hold no more than the stated bounds, however often a row repeats."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, release


def quotas(counts: dict, total: int) -> dict:
    """How many of `total` rows each class gives: as even as the classes' own numbers allow."""
    out, left = {}, total
    for k, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], str(x[0])))):
        out[name] = min(n, left // (len(counts) - k))
        left -= out[name]
    return out


def training_sample(rows: DataFrame, keys: DataFrame, by: str | None, max_rows: int, max_bytes: int) -> DataFrame:
    """The rows of `rows` whose (doc_id, t) was chosen, each distinct one once; t is a hash of what is learned from.

    keys: doc_id, t, size and further columns, among them `by`, by which the rows are to be spread evenly (None: all
    are one class). At most max_rows distinct keys are chosen, those of smallest hash in each class (of more than
    max_rows classes, the largest ones), and of them, class by class in turn, whole rows until their sizes come to
    max_bytes; a row that would go beyond is passed over. Repeated rows are one row. The result has the columns of
    rows and those of keys.
    """
    spark = rows.sparkSession
    names = [c for c in keys.columns if c != "size"]
    keys = keys.withColumn("__class", F.col(by).cast("string") if by else F.lit("all")).withColumn("__h", F.xxhash64(*names))
    keys = materialize(keys, "sample-keys")
    largest = keys.groupBy("__class").agg(F.approx_count_distinct("__h", 0.02).alias("n")).orderBy(F.desc("n"), "__class").limit(max_rows).collect()
    quota = quotas({r[0]: r[1] for r in largest}, max_rows)
    # so many hashes that the quota is met by all odds; what is ranked then does not grow with the table
    share = {r[0]: 1.2 * (quota[r[0]] + 6 * math.sqrt(quota[r[0]]) + 20) / max(1, r[1]) for r in largest}
    limits = [(c, quota[c], min((1 << 63) - 1, int(min(1.0, s) * (1 << 64)) - (1 << 63))) for c, s in share.items()]
    near = keys.join(F.broadcast(spark.createDataFrame(limits, "__class string, __quota int, __limit long")), "__class").where("__h <= __limit")
    near = near.select(*keys.columns, "__quota").distinct()
    rank = F.row_number().over(Window.partitionBy("__class").orderBy("__h", *names))
    found = near.withColumn("__rank", rank).where("__rank <= __quota").drop("__quota").collect()  # max_rows at most
    release(keys)
    chosen, held = [], 0
    for r in sorted(found, key=lambda r: (r["__rank"], r["__class"])):
        if held + r["size"] <= max_bytes:
            held += r["size"]
            chosen.append(tuple(r[c] for c in names))
    picked = spark.createDataFrame(chosen, keys.select(*names).schema)
    return rows.join(F.broadcast(picked), ["doc_id", "t"]).dropDuplicates(names)
