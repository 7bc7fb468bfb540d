"""Parquet, text, CSV, workbooks and remote paths."""

from __future__ import annotations

import fnmatch
import os
import re
import zipfile
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession

from betaloom.sources.scratch import target


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A lazy scan, of the named columns only if given; FileNotFoundError if there is nothing."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_parquet(df: DataFrame, path: str, *, compression: str = "zstd", block_bytes: int | None = None, partition_by: list[str] = (), mode: str = "overwrite") -> None:
    w = df.write.mode(mode).option("compression", compression)
    if block_bytes:
        w = w.option("parquet.block.size", block_bytes)
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file through Hadoop's file systems, so that path may be any that Spark reads; folders are made."""
    at, files = target(spark, path)
    out = files.create(at, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def path_exists(spark: SparkSession, path: str) -> bool:
    at, files = target(spark, path)
    return files.exists(at)


def parquet_shape(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Rows and column names, from footers."""
    df = spark.read.parquet(path)
    return df.count(), df.columns


def write_ids(df: DataFrame, path: str) -> None:
    """The first column, one id per line, as one text file: for lists of ids that people read."""
    df.select(df[df.columns[0]].cast("string")).coalesce(1).write.mode("overwrite").text(path)


def read_ids(spark: SparkSession, path: str, name: str = "cpg_id") -> DataFrame:
    return spark.read.text(path).selectExpr(f"trim(value) as {name}").where(f"{name} <> ''")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def sheet_names(path: str, pattern: str = "*") -> list[str]:
    """The workbook's sheets that match the pattern, sorted."""
    with zipfile.ZipFile(path) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    return sorted(n for s in book.iterfind("m:sheets/m:sheet", _NS) if fnmatch.fnmatch(n := s.get("name"), pattern))


def read_workbook(spark: SparkSession, path: str, pattern: str = "*") -> dict[str, DataFrame]:
    """The matching sheets of an .xlsx file as tables of strings; the first row names the columns. For small files."""
    out = {}
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iterfind(".//m:t", _NS)) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _NS)]
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for s in book.iterfind("m:sheets/m:sheet", _NS):
            name = s.get("name")
            if not fnmatch.fnmatch(name, pattern):
                continue
            target = targets[s.get(_REL)].lstrip("/")
            table = []
            for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iterfind("m:sheetData/m:row", _NS):
                cells = {}
                for at, c in enumerate(row.iterfind("m:c", _NS)):
                    letters = re.match(r"[A-Z]+", c.get("r") or "")
                    place = sum((ord(ch) - 64) * 26**k for k, ch in enumerate(reversed(letters[0]))) - 1 if letters else at
                    kind, v = c.get("t"), c.find("m:v", _NS)
                    text = "".join(t.text or "" for t in c.iterfind(".//m:t", _NS)) if kind == "inlineStr" else None if v is None else shared[int(v.text)] if kind == "s" else v.text
                    cells[place] = text
                table.append(cells)
            if table:
                width = max((max(r) + 1 for r in table if r), default=0)
                header = [table[0].get(i) or f"column_{i}" for i in range(width)]
                rows = [tuple(r.get(i) for i in range(width)) for r in table[1:]]
                out[name] = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))
    return out


def parse_s3(uri: str) -> tuple[str, str]:
    m = re.fullmatch(r"s3[an]?://([^/]+)/(.+)", uri)
    if not m:
        raise ValueError(f"not an S3 address: {uri}")
    return m[1], m[2]


def resolve_path(uri: str, cache: str | None = None) -> str:
    """What Spark reads: s3 addresses through s3a, or a file in the cache if it is there; the cache is never left."""
    if not re.match(r"s3[an]?://", uri):
        return uri
    bucket, key = parse_s3(uri)
    if cache:
        local = os.path.realpath(os.path.join(cache, bucket, key))
        if os.path.commonpath([local, os.path.realpath(cache)]) != os.path.realpath(cache):
            raise ValueError(f"outside the cache: {uri}")
        if os.path.exists(local):
            return local
    return f"s3a://{bucket}/{key}"
