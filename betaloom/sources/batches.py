"""Writing a table to a store outside Spark, in numbered batches that can be repeated without harm.

Rows get a number from their order, so batch k holds the same rows in every attempt and in every run. A batch goes to the
sink in one call with its name; the sink writes all of it or nothing, and a name that it has already is passed over. So a
task that Spark starts again, or a run that is started again, leaves every batch once. A batch that fails does not stop
the others: what failed, and why, comes back as rows.
"""

from __future__ import annotations

import json
import os
import traceback
from collections.abc import Callable
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.operators.order import numbered
from betaloom.sources.scratch import materialize

WRITTEN, PRESENT, FAILED = "written", "present", "failed"


class Sink(Protocol):
    """Where batches go. It is made in the task that writes, by the function given to write_batches."""

    def has(self, name: str) -> bool:
        """Whether a batch of this name was committed before."""

    def write(self, name: str, rows: pd.DataFrame) -> None:
        """Commit all rows under the name, or raise and leave nothing."""


class FolderSink:
    """Batches as files of JSON lines in a folder that all workers mount; a file appears under its name when it is whole."""

    def __init__(self, folder: str):
        self.folder = folder
        os.makedirs(folder, exist_ok=True)

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, f"{name}.jsonl")

    def has(self, name: str) -> bool:
        return os.path.exists(self._path(name))

    def write(self, name: str, rows: pd.DataFrame) -> None:
        part = f"{self._path(name)}.{os.getpid()}.part"
        with open(part, "w", encoding="utf-8") as f:
            f.writelines(json.dumps(r, default=str, sort_keys=True) + "\n" for r in rows.to_dict("records"))
        os.replace(part, self._path(name))


def write_batches(rows: DataFrame, order: list[Column], connect: Callable[[], Sink], *, table: str, size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Write rows by `size` in the order, which should tell rows apart, as batches "table-00000000", "table-00000001", ...

    Returns (outcomes, failed rows). An outcome is batch, name, n_rows, status (written, present: it was there before, or
    failed) and error (the last line of the failure, else null). The failed rows have the table's columns and batch.
    An empty table gives no batch. Batches are written side by side, a task holds one at a time.
    """
    columns = rows.columns
    dealt = materialize(numbered(rows, order, name="__n").withColumn("batch", F.expr(f"(__n - 1) div {int(size)}")), f"batches-{table}")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        batch = int(pdf["batch"].iloc[0])
        name, status, error = f"{table}-{batch:08d}", WRITTEN, None
        try:
            sink = connect()
            if sink.has(name):
                status = PRESENT
            else:
                sink.write(name, pdf.sort_values("__n")[columns])
        except Exception as e:  # one batch's failure is that batch's outcome
            status, error = FAILED, traceback.format_exception_only(e)[-1].strip()
        return pd.DataFrame({"batch": [batch], "name": [name], "n_rows": [len(pdf)], "status": [status], "error": [error]})

    outcomes = dealt.groupBy("batch").applyInPandas(write, "batch long, name string, n_rows long, status string, error string")
    outcomes = materialize(outcomes, f"outcomes-{table}")  # a second reader must not write again
    return outcomes, dealt.join(outcomes.where(F.col("status") == FAILED).select("batch"), "batch", "left_semi").select(*columns, "batch")


__all__ = ["FAILED", "PRESENT", "WRITTEN", "FolderSink", "Sink", "write_batches"]
