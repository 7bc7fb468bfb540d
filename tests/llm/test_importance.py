import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from betaloom.llm import importance, queries
from betaloom.llm.importance import importance_resample, ngram_buckets, suffix_runs

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, max_n, buckets):
    words = WORDS.findall((text or "").translate(LOWER))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, x in docs:
        np.add.at(s, features(x, max_n, buckets)[1], 1)
    for x in target:
        np.add.at(t, features(x, max_n, buckets)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    rows = []
    for d, x in docs:
        n, f = features(x, max_n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append((d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    rank = {}
    for k, r in enumerate(able[: len(able) * percent // 100]):
        rank.setdefault(r, []).append(k + 1)
    return sorted(((*r, rank[r].pop(0) if rank.get(r) else None) for r in rows), key=str)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "δέλτα", "naïve", "日本", "x1", "42", "a_b", "tab\tbed", "nul\x00l", "É"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("max_n,buckets,slice_bytes", [(1, 10_000, 4 << 20), (2, 500, 300), (3, 70_000, 64), (5, 97, 40)])
def test_equals_brute_force(spark, monkeypatch, max_n, buckets, slice_bytes):
    monkeypatch.setattr(importance, "SLICE_BYTES", slice_bytes)  # workers of local mode are forked with it
    docs = list(enumerate(texts(max_n, 150))) + [(3, None), (None, "word " * 30), (None, ""), (200, "copy of a text " * 8), (200, "copy of a text " * 8)]
    target = [*texts(9, 20), None, "", "alpha beta"]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, rank string")
    got = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), max_n=max_n, buckets=buckets, percent=30)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, max_n, buckets, 30)


def test_buckets_of_every_occurrence_whatever_the_slices():
    for size in (8, 50, 400, 1 << 20):
        importance.SLICE_BYTES, kept = size, importance.SLICE_BYTES
        try:
            for text in [*texts(5, 20), "w" * 900, "", " ", "one " * 300]:
                words, fresh = zip(*((w, f) for w, f, _ in importance._pieces(text, 4)))
                found = [np.concatenate([importance.slice_buckets([w], [f], 4, 1000)[0] for w, f in zip(words, fresh)])]
                assert sorted(np.concatenate(found).tolist()) == sorted(features(text, 4, 1000)[1])
        finally:
            importance.SLICE_BYTES = kept


def test_suffix_array_and_lcp():
    rng = random.Random(2)
    for depth in (1, 2, 3, 5, 8):
        texts_ = [[rng.randrange(3) for _ in range(rng.randrange(12))] for _ in range(6)]
        ids = np.array([w for t in texts_ for w in t])
        ends = np.repeat(np.cumsum([len(t) for t in texts_]), [len(t) for t in texts_])
        suffixes, lcp = suffix_runs(ids, ends, depth)
        shown = [tuple(ids[i : min(ends[i], i + depth)]) for i in suffixes]
        assert shown == sorted(shown) and sorted(suffixes) == list(range(len(ids)))
        for a, b, n in zip(shown, shown[1:], lcp[1:]):
            assert n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_empty_tables_and_a_text_beyond_one_slice(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c"), (2, "Zebra crossing 7 " * 600_000)], "doc_id long, text string")
    assert importance_resample(empty, some).count() == 0
    rows = {r.doc_id: r for r in importance_resample(some, empty, percent=100).collect()}
    assert rows[2].n_features == 1_800_000 and rows[2].rank == 1 and rows[1].rank is None
    with pytest.raises(ValueError):
        ngram_buckets(some, max_n=0)


def test_query_equals_its_sql(same):
    same(queries.op11_importance_resampling, queries.OP11_SQL)
