"""Byte-level BPE over whole texts, with long texts cut into chunks that are pre-tokenised side by side.

The pattern looks ahead but never back, so two pre-tokenisations that share a boundary agree from there on. A long
text is cut every `chunk_chars` characters; each chunk also sees `overlap_chars` characters of the next one. Chunks
are pre-tokenised in parallel, each from its own first character, and stitched at the first boundary in the overlap
that both neighbours have and that follows a character other than white space (such a cut cannot change how the piece
before it is matched). The pieces between stitches are encoded in parallel and their ids concatenated. A text of
which two chunks share no boundary, such as a run of letters longer than the overlap, is encoded as one piece.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, shuffle_partitions

SLACK = 8  # longer than anything the pattern looks at behind a match


@functools.lru_cache(maxsize=4)
def ranks(vocab_path: str) -> dict[bytes, int]:
    with open(vocab_path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=4)
def encoder(vocab_path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(vocab_path), special_tokens={})


@functools.lru_cache(maxsize=4)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern)


def encode_text(enc, text: str) -> np.ndarray:
    return np.asarray(enc.encode_to_numpy(text, disallowed_special=()), dtype="<u4")


def _encode(vocab_path: str, pattern: str):
    """(uid, doc_id, no, text) to (uid, doc_id, no, ids)."""

    def run(batches):
        enc = encoder(vocab_path, pattern)
        for b in batches:
            ids = [encode_text(enc, t.as_py() or "").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("doc_id"), b.column("no"), pa.array(ids, pa.binary())], names=["uid", "doc_id", "no", "ids"])

    return run


def _cut(chunk: int, overlap: int):
    """Chunks of each text, a batch at a time: no more than a text and 64 chunks are held."""

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))], names=["uid", "doc_id", "no", "last", "text"])

    def run(batches):
        for b in batches:
            rows = []
            for uid, doc, text in zip(b.column("uid").to_pylist(), b.column("doc_id").to_pylist(), b.column("text")):
                text = text.as_py()
                for no, at in enumerate(range(0, len(text), chunk)):
                    rows.append((uid, doc, no, at + chunk >= len(text), text[at : at + chunk + overlap + SLACK]))
                    if len(rows) == 64:
                        yield batch(rows)
                        rows = []
            if rows:
                yield batch(rows)

    return run


def _boundaries(pattern: str, chunk: int, overlap: int):
    """Of each chunk, the safe boundaries in the zones it shares with the chunk before (head) and after (tail), counted from the shared start."""

    def run(batches):
        split = splitter(pattern)
        for b in batches:
            heads, tails = [], []
            for text, last in zip(b.column("text").to_pylist(), b.column("last").to_pylist()):
                trusted = len(text) if last else len(text) - SLACK
                safe = [m.end() for m in split.finditer(text) if m.end() <= trusted and not text[m.end() - 1].isspace()]
                heads.append([e for e in safe if e <= overlap])
                tails.append([e - chunk for e in safe if e >= chunk and e - chunk <= overlap])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("uid"), b.column("no"), pa.array(heads, kind), pa.array(tails, kind)], names=["uid", "no", "head", "tail"])

    return run


def encode_documents(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", *, chunk_chars: int = 32_768, overlap_chars: int = 1_024) -> DataFrame:
    """One row per input row: doc_id, ids (little-endian unsigned 32-bit, concatenated), as one encode of the whole text.

    Null text counts as empty and gives no ids; strings that look like control tokens are ordinary text. Repeated rows
    are encoded each. Other columns are ignored. An empty table gives no rows.
    """
    if chunk_chars <= overlap_chars + SLACK:
        raise ValueError("a chunk must be longer than the overlap")
    n = shuffle_partitions(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"), F.lit(0).alias("no"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    encoded = "uid long, doc_id long, no int, ids binary"
    short = rows.where(F.char_length("text") <= chunk_chars).mapInArrow(_encode(vocab_path, pattern), encoded)

    chunks = rows.where(F.char_length("text") > chunk_chars).mapInArrow(_cut(chunk_chars, overlap_chars), "uid long, doc_id long, no int, last boolean, text string")
    chunks = materialize(chunks.repartition(n, "uid", "no"), "bpe-chunks")
    zones = materialize(chunks.mapInArrow(_boundaries(pattern, chunk_chars, overlap_chars), "uid long, no int, head array<int>, tail array<int>"), "bpe-zones")
    before = zones.select("uid", (F.col("no") + 1).alias("no"), "tail")
    starts = zones.where("no > 0").select("uid", "no", "head").join(before, ["uid", "no"]).select("uid", "no", F.array_min(F.array_intersect("head", "tail")).alias("start"))
    starts = materialize(starts, "bpe-stitches")
    apart = starts.where("start is null").select("uid").distinct()
    pieces = (
        chunks.join(apart, "uid", "left_anti")
        .join(starts, ["uid", "no"], "left")
        .join(starts.select("uid", (F.col("no") - 1).alias("no"), F.col("start").alias("stop")), ["uid", "no"], "left")
        .withColumn("start", F.coalesce("start", F.lit(0)))
    )
    stop = F.when(F.col("last"), F.char_length("text")).otherwise(F.col("stop") + chunk_chars)
    pieces = pieces.select("uid", "doc_id", "no", F.substr("text", F.col("start") + 1, stop - F.col("start")).alias("text"))
    whole = chunks.join(apart, "uid").select("uid", "doc_id", "no", F.when(F.col("last"), F.col("text")).otherwise(F.substr("text", F.lit(1), F.lit(chunk_chars))).alias("text"))

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        return pd.DataFrame({"uid": pdf.uid.iloc[:1], "doc_id": pdf.doc_id.iloc[:1], "no": [0], "text": ["".join(pdf.text)]})

    def gathered(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("no")
        return pd.DataFrame({"doc_id": pdf.doc_id.iloc[:1], "ids": [b"".join(pdf.ids)]})

    parts = pieces.unionByName(whole.groupBy("uid").applyInPandas(joined, "uid long, doc_id long, no int, text string"))
    long = parts.mapInArrow(_encode(vocab_path, pattern), encoded).groupBy("uid").applyInPandas(gathered, "doc_id long, ids binary")
    return short.select("doc_id", "ids").unionByName(long)


def decode_documents(encoded: DataFrame, vocab_path: str) -> DataFrame:
    """encoded (doc_id, ids) with the column decoded: the ids' bytes, concatenated; null or empty ids give no bytes. Repeated rows are decoded each; an empty table gives no rows."""

    def run(batches):
        table = [b""] * (max(ranks(vocab_path).values()) + 1)
        for token, rank in ranks(vocab_path).items():
            table[rank] = token
        for b in batches:
            texts = [b"".join(map(table.__getitem__, np.frombuffer(ids.as_py() or b"", "<u4").tolist())) for ids in b.column("ids")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("ids"), pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
