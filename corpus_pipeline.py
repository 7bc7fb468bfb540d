"""A corpus from raw documents to training sequences, in stages that each keep the documents' columns until the last.

language: documents without a letter, or whose words are of no learned language with some certainty, go.
quality: documents that score below 0.3 go.
lines: lines that many sites share stay in the first document only.
near_duplicates: one document of each group of linked documents stays.
packing: the rest is packed into sequences, a row per piece.
"""

from __future__ import annotations

import public_tokenizers as vocab
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from betaloom.llm.langid_crf import UNDETERMINED, fit_langid, identify_language
from betaloom.llm.line_dedup import dedup_lines
from betaloom.llm.ngram_join import ngram_join
from betaloom.llm.packing import pack_documents
from betaloom.llm.quality_fm import fit_quality, score_quality
from betaloom.llm.store import materialize, release, temporary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
MIN_CERTAINTY, EVIDENCE = 0.6, 10  # a text of n words needs a certainty of MIN_CERTAINTY * n / (n + EVIDENCE): few words prove little
MIN_QUALITY = 0.3
MIN_SITES = 10


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language, or several; null, empty and letterless texts go, repeated rows fare alike."""
    named = identify_language(docs.select(COLUMNS), fit_langid(docs), keep=COLUMNS, certainty=True)
    enough = F.col("certainty") >= F.col("n_words") * MIN_CERTAINTY / (F.col("n_words") + EVIDENCE)
    return named.where((F.col("lang_pred") != UNDETERMINED) & enough).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of sufficient quality, learned from the labels of the documents that are left; null text counts as empty, repeated rows fare alike."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs.select(COLUMNS), model, keep=COLUMNS).where(F.col("score") >= MIN_QUALITY).select(COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without repeats of lines that at least MIN_SITES sources share; n_chars follows the text."""
    clean = dedup_lines(docs.select(COLUMNS), min_sites=MIN_SITES, counts=("__lines", "__removed"))
    return clean.withColumn("n_chars", F.when(F.col("__removed") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))).select(COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id (null last), once if its row is repeated; null and blank texts are in no group and stay."""
    found = materialize(ngram_join(docs), "pipeline-classes")
    kept = found.where("kept").select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t")).distinct()
    rows = docs.select(COLUMNS)
    out = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.xxhash64("text") == F.col("__t")), "left_semi")
    repeated = not found.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    return out.dropDuplicates(["doc_id", "text"]) if repeated else out


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its place in a sequence; a null or empty text is one piece of the end id, repeated rows are packed each."""
    return pack_documents(docs, vocab.path("byte_bpe_50k.json"), ranks_path=vocab.path("byte_bpe_50k.tiktoken"), pattern=vocab.PATTERN)


STAGES = [("language", language), ("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packing)]

#: SQL cannot express the learned stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in sf_dir; each stage's result is written and read again, and its own tables go."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before = docs
        with temporary(spark) as keep:
            docs = keep(stage(spark, before, sf_dir), f"pipeline-{name}")
        release(before)
    return STAGES[-1][1](spark, docs, sf_dir)
