import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from betaloom.llm.store import materialize

SF = "/root/testdata/sf0.001"


def test_stages_on_their_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "quality", "lines", "near_duplicates", "packing"]
    seen = {}
    for name, stage in cp.STAGES:
        before = docs.toPandas()
        docs = materialize(stage(spark, docs, SF), "test")
        after = docs.toPandas()
        seen[name] = (before, after)
        if name != "packing":
            assert list(after.columns) == cp.COLUMNS and set(after.doc_id) <= set(before.doc_id)
    before, after = seen["language"]
    gone = set(before.doc_id) - set(after.doc_id)
    assert all(not any(c.isalpha() for c in t) for i, t in zip(before.doc_id, before.text) if i in gone)
    before, after = seen["quality"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i in before.doc_id if labels.get(i) == 1]
    assert len(set(good) & set(after.doc_id)) >= 0.97 * len(good)
    before, after = seen["lines"]
    from betaloom.llm.queries import OP4_SQL

    documents = before  # noqa: F841  DuckDB reads it by name
    want = dict(duckdb.connect().execute(OP4_SQL).df()[["doc_id", "text"]].itertuples(index=False))
    assert dict(zip(after.doc_id, after.text)) == want and all(n == len(t) for n, t in zip(after.n_chars, after.text))
    before, after = seen["near_duplicates"]
    from betaloom.llm.queries import OP5_SQL

    documents = before
    classes = duckdb.connect().execute(OP5_SQL).df()
    assert set(after.doc_id) == set(classes[classes.kept].doc_id) and len(after) == len(set(after.doc_id))
    before, after = seen["packing"]
    assert set(after.doc_id) == set(before.doc_id)


@pytest.mark.parametrize("known", [["de", "en"], ["de", "en", "fr"], ["de", "en", "es", "fr"]])
def test_unknown_languages_go_and_mixed_texts_stay(spark, known):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(F.col("lang").isin(known))
    words = [max((r.text for r in docs.where(f"lang = '{x}' and n_chars < 3000").collect()), key=len).split()[:60] for x in known]
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(60)) for letters in ("bcdfghjklmnpqrstvwxz", "абвгдежзийклмнопрст", "的一是不了人我在有他这中")]
    texts = [" ".join(w for part in words for w in part), *noise]
    rows = [(-1 - i, t, None, "x", len(t)) for i, t in enumerate(texts)]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").select(*[F.col(c).cast(docs.schema[c].dataType) for c in cp.COLUMNS])
    kept = {r.doc_id for r in cp.language(spark, docs.select(cp.COLUMNS).union(extra), SF).select("doc_id").collect()}
    assert {i for i in kept if i < 0} == {-1}
    gone = [r.text for r in docs.collect() if r.doc_id not in kept]
    assert not any(c.isalpha() for t in gone for c in t or "")


def test_run_and_repeated_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.union(docs.limit(20)).union(spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "a few more words here", "en", None, 21)], docs.schema)).coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    out = cp.run(spark, str(tmp_path)).toPandas()
    whole = out[out.piece == 0]
    assert whole.doc_id.duplicated().sum() == 0 and 9001 not in set(out.doc_id) and 9002 not in set(out.doc_id)
    empty = tmp_path / "none"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(empty / "labels.parquet"))
    assert cp.run(spark, str(empty)).count() == 0
