import itertools
import random
import zlib

import numpy as np
import pyarrow as pa

from betaloom.llm import langid_crf, quality_fm, queries
from betaloom.llm.textvec import LETTER, SPACE, Hasher, shingles, slices, utf8, words

SF = "/root/testdata/sf0.01"


def test_words_and_hashes_of_batches():
    texts = ["a b", "", None, " été  x\n", "a", "b a b a", "\t"]
    col = pa.array(["skip", *texts], pa.string()).slice(1)
    data, offsets = utf8(col)
    starts, ends, before = words(data, offsets, ~SPACE)
    got = [[data[s:e].tobytes().decode() for s, e in zip(starts[a:z], ends[a:z])] for a, z in zip(before, before[1:])]
    assert got == [(t or "").split() for t in texts]
    h = Hasher(data).of(starts, ends)
    flat = [w for g in got for w in g]
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
    sets, off = shingles(h, before, 2)
    assert np.diff(off).tolist() == [1, 0, 0, 1, 1, 2, 0]
    assert list(slices(pa.array(["x" * 10] * 5), 20)) == [(0, 2), (2, 4), (4, 5)] and list(slices(pa.array([], pa.string()))) == []
    assert words(*utf8(pa.array(["ab1é"])), LETTER)[0].tolist() == [0, 3]


def test_linear_time_score_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = quality_fm.Model(0.3, rng.normal(size=quality_fm.SIZE), rng.normal(size=(quality_fm.SIZE, 4)) * 0.3, np.sort(rng.normal(size=(quality_fm.N_STATS, quality_fm.BINS - 1)), axis=1))
    stats = np.column_stack([rng.normal(size=(3, quality_fm.N_STATS)), [2, 3, 4]])
    owner, index, weight = np.array([0, 0, 2, 2, 2]), np.array([5, 9, 5, 7, 11]), rng.random(5)
    got = m.score(owner, index, weight, stats)
    fixed = m.indices(stats)
    for d in range(3):
        i = np.concatenate([index[owner == d], fixed[d]])
        x = np.concatenate([weight[owner == d], np.ones(fixed.shape[1])])
        z = m.bias + (m.w[i] * x).sum() + sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a, b in itertools.combinations(range(len(i)), 2))
        assert np.isclose(got[d], 1 / (1 + np.exp(-z)))


def test_quality_is_learned(spark):
    rows = queries.op2_quality_classifier(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert len(held) > 40 and np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.93
    assert np.mean([r.predicted for r in held if label[r.doc_id] == 1]) > 0.97


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", 0), (3, "... 123 !!", 10), (4, "word " * 20_000, -5), (4, "word " * 20_000, -5), (None, "ä", 1)], "doc_id long, text string, n_chars long")
    for labels in ([], [(1, 1), (2, 0), (3, None), (99, 1), (None, 1)]):
        m = quality_fm.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        got = quality_fm.score_quality(docs, m, keep=["text"]).collect()
        assert len(got) == 6 and all(0 <= r.score <= 1 for r in got) and len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality_fm.score_quality(docs.limit(0), m).collect() == []


def naive(score, start, change):
    """Posteriors by enumerating all label sequences."""
    n, L = score.shape
    out = np.zeros((n, L))
    for y in itertools.product(range(L), repeat=n):
        z = np.exp(start[y[0]] + score[0, y[0]] + sum(change[y[t - 1], y[t]] + score[t, y[t]] for t in range(1, n)))
        for t in range(n):
            out[t, y[t]] += z
    return out / out.sum(axis=1, keepdims=True)


def test_forward_backward_equals_enumeration(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = [1, 6, 0, 4, 7]
    before = np.concatenate([[0], np.cumsum(lengths)])
    score, start, change = rng.normal(size=(18, 3)) * 2, rng.normal(size=3), rng.normal(size=(3, 3)) * 2
    want = np.concatenate([naive(score[a:z], start, change) for a, z in zip(before, before[1:]) if a < z])
    for segment in (2, 3, 64):
        monkeypatch.setattr(langid_crf, "SEGMENT", segment)
        assert np.allclose(langid_crf.forward_backward(score, before, start, change)[0], want)
    assert langid_crf.forward_backward(np.zeros((0, 3)), np.array([0, 0]), start, change)[0].shape == (0, 3)


def test_language_is_learned_and_words_are_tagged(spark):
    rows = queries.op9_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert len(rows) == len(lang) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tagger = langid_crf.fit_langid(docs)
    en, de = (max((r.text for r in docs.where(f"lang = '{x}' and n_chars < 3000").collect()), key=len).split()[:60] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, " ".join([*en, *de]))], "doc_id long, text string")
    tags = sorted(langid_crf.tag_words(mixed, tagger).collect(), key=lambda r: r.word)
    half = next(i for i, r in enumerate(tags) if r.text == "".join(c for c in de[0].lower() if c.isalpha()) and i > 40)
    assert np.mean([r.lang_pred == "en" for r in tags[:half]]) > 0.9 and np.mean([r.lang_pred == "de" for r in tags[half:]]) > 0.9


def test_training_chains_hold_every_word_of_whole_texts():
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    texts = [" ".join(map(word, range(n))) for n in (0, 1, 24, 25, 60_000, 73)] + ["Éa, éa", "x" * 300_000]
    c = langid_crf.chains(texts, list(range(len(texts))), 24)
    assert (c.end - c.begin).max() == 24 and (c.end - c.begin).min() >= 1
    assert c.begin[0] == 0 and (c.begin[1:] == c.end[:-1]).all() and c.end[-1] == len(c.word)
    size = np.bincount(c.gold, c.end - c.begin, len(texts)).astype(int).tolist()
    assert size[:7] == [0, 1, 24, 25, 60_000, 73, 2] and size[7] in (1, 2)
    assert len(set(c.word[c.begin[c.gold == 4][0] :][:60_000].tolist())) == 60_000 and c.word[0] == c.word[1]
    assert len(c.at) == c.word.max() + 2 and (np.diff(c.at) > 3).all()


def test_training_rows_are_bounded_however_often_a_row_repeats(spark):
    rows = [(i, f"text number {i}", ("en", "de", "rare")[0 if i > 40 else i > 5], 10) for i in range(1, 400)]
    docs = spark.createDataFrame([(i, t, lang if i > 5 else "rare", n) for i, t, lang, n in rows] + [(2, "one text of one id", "en", 18)] * 5_000, "doc_id long, text string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400)] + [(2, 1)] * 5_000 + [(2, 0)], "doc_id long, quality int")
    def chosen(module, fit):
        """The rows that are trained on."""
        got, was = [], module.training_sample
        module.training_sample = lambda *a: got.append(was(*a)) or got[0]
        try:
            fit()
        finally:
            module.training_sample = was
        return got[0].collect()

    for bound in (3, 60, 10_000):
        rows = chosen(langid_crf, lambda: langid_crf.fit_langid(docs, max_rows=bound, steps=1))
        assert 0 < len(rows) <= min(bound, 400) and len(rows) == len(set(rows))
        if bound == 60:
            assert sum(r.lang == "rare" for r in rows) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(1, 6))
        rows = chosen(quality_fm, lambda: quality_fm.fit_quality(docs, labels, max_rows=bound, steps=1))
        assert 0 < len(rows) <= min(bound, 402) and len(rows) == len(set(rows))
    rows = chosen(langid_crf, lambda: langid_crf.fit_langid(docs, max_bytes=100, steps=1))
    assert 0 < sum(len(r.text) for r in rows) <= 100


def test_clashing_names_give_way(spark):
    docs = spark.createDataFrame([(1, "the word", "en", 8, 0.5, "x", 7)], "doc_id long, text string, lang string, n_chars long, Score double, Lang_Pred string, N_WORDS int")
    named = langid_crf.identify_language(docs, langid_crf.fit_langid(docs), keep=["Score", "lang", "Lang_Pred", "N_WORDS"], certainty=True)
    assert named.columns == ["doc_id", "lang", "lang_pred", "score", "certainty", "n_words"] and named.head().n_words == 2
    scored = quality_fm.score_quality(docs, quality_fm.fit_quality(docs, docs.selectExpr("doc_id", "1 as quality")), keep=["Score", "lang"])
    assert scored.columns == ["doc_id", "lang", "score"] and scored.count() == 1


def test_language_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "en"), (2, "", "en"), (3, "12 — !? 🙂", "de"), (4, "the word and the", "en"), (5, "der und die das", "de"), (None, "é", None), (4, "the word and the", "en"), (6, "wort " * 30_000, "de")], "doc_id long, text string, lang string")
    for rows in (docs, docs.withColumn("lang", docs.lang.substr(9, 1)), docs.limit(0)):
        tagger = langid_crf.fit_langid(rows)
        got = langid_crf.identify_language(docs, tagger, keep=["text", "lang"]).collect()
        assert len(got) == 8 and all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3))
        assert all(0 <= r.score <= 1 for r in got)
    assert langid_crf.identify_language(docs.limit(0), tagger).collect() == []


def _mixed(seed, n):
    rng = random.Random(seed)
    voice = {x: ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 9))) for _ in range(200)] for x, letters in (("a", "abcdefgh"), ("b", "ghijklmn"), ("c", "nopqrstu"))}
    texts = [(" ".join(rng.choice(voice[x]) for _ in range(60)), x) for x in voice for _ in range(40)]
    now, out = "a", []
    for _ in range(n):
        now = rng.choice("abc") if rng.random() < 0.02 else now
        out.append(rng.choice(voice[now if rng.random() < 0.8 else rng.choice("abc")]))
    return texts, " ".join(out)


def test_stretches_of_a_long_text_are_tagged_as_the_whole(monkeypatch):
    texts, long = _mixed(1, 4000)
    tagger = langid_crf.train(*zip(*texts), steps=60)
    for text in (long, "12 34 " * 100 + long[:3000] + " 1 " * 2000 + long[:300], " 5 ", "", "abc"):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends, _, post = tagger.tag(data, np.array([0, len(data)]))
        for stretch in (64, 257, 1000, 1 << 20):
            monkeypatch.setattr(langid_crf, "STRETCH", stretch)
            got = list(tagger.stretches(data))
            assert [x for g in got for x in g[0].tolist()] == starts.tolist() and [x for g in got for x in g[1].tolist()] == ends.tolist()
            assert np.allclose(np.concatenate([g[2] for g in got]) if got else np.empty((0, 3)), post, atol=1e-12)
    monkeypatch.setattr(langid_crf, "STRETCH", 64)
    assert sum(len(g[0]) for g in tagger.stretches(np.frombuffer(b"x" * 1000, np.uint8))) == 16  # a run of letters beyond a stretch


def test_memory_does_not_grow_with_a_text():
    import tracemalloc

    texts, long = _mixed(2, 40_000)
    tagger = langid_crf.train(*zip(*texts), steps=60)
    data = np.frombuffer((long + " ").encode() * ((24 << 20) // len(long)), np.uint8)
    tracemalloc.start()
    try:
        n = sum(len(g[2]) for g in tagger.stretches(data))
        assert n == 40_000 * ((24 << 20) // len(long)) and tracemalloc.get_traced_memory()[1] < 120 << 20
    finally:
        tracemalloc.stop()


def test_long_and_short_texts_of_a_table_fare_alike(spark, monkeypatch):
    texts, long = _mixed(3, 9000)
    tagger = langid_crf.train(*zip(*texts), steps=60)
    df = spark.createDataFrame([(1, long), (2, "abc"), (3, None), (4, long[:5000])], "doc_id long, text string")
    whole = sorted(map(tuple, langid_crf.identify_language(df, tagger, certainty=True).collect()))
    words = sorted((r.doc_id, r.word, r.text, r.lang_pred) for r in langid_crf.tag_words(df, tagger).collect())
    monkeypatch.setattr(langid_crf, "LONG", 4000)
    monkeypatch.setattr(langid_crf, "STRETCH", 700)
    monkeypatch.setattr(langid_crf, "slices", lambda column: ((i, i + 1) for i in range(len(column))))
    parts = sorted(map(tuple, langid_crf.identify_language(df, tagger, certainty=True).collect()))
    assert [(r[0], r[1], r[4]) for r in parts] == [(r[0], r[1], r[4]) for r in whole]
    assert np.allclose([r[2:4] for r in parts], [r[2:4] for r in whole])
    assert sorted((r.doc_id, r.word, r.text, r.lang_pred) for r in langid_crf.tag_words(df, tagger).collect()) == words
