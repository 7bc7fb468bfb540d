"""Tables in the folder that all executors share, used to cut lineage and to keep what must not be computed twice."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir; a folder of our own only where a local session names none (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{tempfile.gettempdir()}/checkpoints/betaloom"


def target(spark: SparkSession, path: str):
    """path in its file system, and that file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


_open: contextvars.ContextVar[tuple[list[DataFrame], ...]] = contextvars.ContextVar("betaloom_tables", default=())


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back.

    The table outlives any executor, so later stages never recompute df, and two readers see the same rows. It goes
    with release(), at the end of the temporary() block it was written in, or when the driver ends; what a killed
    driver leaves is below a folder named by its application.
    """
    path = f"{shared_dir(df.sparkSession)}/betaloom/{df.sparkSession.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    at, files = target(df.sparkSession, path)
    files.deleteOnExit(at)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._betaloom_path = path
    for tables in _open.get():
        tables.append(out)
    return out


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Tables that this thread materialises inside go at its end, but those written by the function it gives."""
    tables: list[DataFrame] = []
    kept: list[str] = []

    def keep(df: DataFrame, tag: str) -> DataFrame:
        out = materialize(df, tag)
        kept.append(out._betaloom_path)
        return out

    before = _open.set((*_open.get(), tables))
    try:
        yield keep
    finally:
        _open.reset(before)
        for t in tables:
            if t._betaloom_path not in kept:
                release(t)


def release(df: DataFrame) -> None:
    """Delete a table that materialize() wrote, once nothing reads it any more."""
    path = getattr(df, "_betaloom_path", None)
    if path:
        at, files = target(df.sparkSession, path)
        files.delete(at, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
