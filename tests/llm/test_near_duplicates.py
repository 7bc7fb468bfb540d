import random

import numpy as np
import pytest

from betaloom.llm import queries
from betaloom.llm.embed_dedup import cap_threshold, codes_needed, embedding_near_dedup, list_decode, pairs_at
from betaloom.llm.line_dedup import dedup_lines
from betaloom.llm.ngram_join import least_matches, ngram_join

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_embedding_near_dedup", "op4_line_dedup", "op5_ngram_join"])
def test_query_equals_sql(name, same):
    same(queries.QUERIES[name], queries.ORACLES[name])


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


# embeddings


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((60, 64))
    x = [base[i % 60] + rng.standard_normal(64) * rng.choice([0.05, 0.2, 0.3, 0.45]) for i in range(900)] + [base[0]] * 40
    x = np.array(x, np.float32)
    label = [int(i % 60 % 3) for i in range(900)] + [0] * 40
    rows = [(i, v.tolist(), lab, "x", "y") for i, (v, lab) in enumerate(zip(x, label))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, cid string, component string")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = (u @ u.T >= 0.93) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    comp = components(len(x), zip(*np.nonzero(near)))
    for block in (1024, 16):
        got = {r.vec_id: r for r in embedding_near_dedup(df, block_rows=block).collect()}
        assert len(got) == len(x)
        for i in range(len(x)):
            assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum(), comp[i], comp[i] == i)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], None), (4, None, 0), (5, [0.0, 0.0], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (8, [1.0, 0.0, 0.0], 0), (9, [], 0), (10, [1.0, None], 0), (11, [1.0, 0.0], 1), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (12, [1e30, 1e-30], 0)]
    got = embedding_near_dedup(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert by[1] == [(3, 1, True)] * 2 and by[2] == [(3, 1, False)] and by[12] == [(3, 1, False)] and by[None] == [(0, None, True)]
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert by[i] == [(0, i, True)]
    assert embedding_near_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_filters_of_near_vectors_meet():
    rng = np.random.default_rng(7)
    v = rng.standard_normal((400, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    g = rng.standard_normal((400, 64))
    g -= (g * v).sum(axis=1)[:, None] * v
    w = 0.93 * v + np.sqrt(1 - 0.93**2) * g / np.linalg.norm(g, axis=1)[:, None]
    words = 127  # 1,000 vectors of a label
    met = np.zeros(400, bool)
    for code in range(8):
        a, b = (list_decode(x, words, 2, 2, 2, 11 + code) for x in (v, w))
        met |= np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
        if not code:  # all directions above the threshold, found by looking at each
            from betaloom.llm.embed_dedup import _halves

            first, second = _halves(v[:20], words, 2, 11)
            sums, cap = first[:, :, None] + second[:, None, :], cap_threshold(64, words, 2, 2, 11)
            for i in range(20):
                every = np.flatnonzero(sums[i].ravel() >= cap)
                assert len(every) < 2 or sorted(a[i].tolist()) == every.tolist()
    assert met.mean() > 0.99


@pytest.mark.parametrize("words", [1_000, 3_163])  # 1 and 10 million directions
def test_missed_pairs_stay_bounded(words):
    v, w = pairs_at(0.93, 800, 64, np.random.default_rng(8))
    assert np.allclose((v * w).sum(axis=1), 0.93)
    met, few = np.zeros(800, bool), None
    for code in range(codes_needed(64, words, 2, 2, 2, 0.93, 1e-3, 11)):
        if code == 8:
            few = met.mean()
        a, b = (list_decode(x, words, 2, 2, 2, 11 + code) for x in (v, w))
        met |= np.array([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)])
    assert few < 0.996 < 0.997 <= met.mean()  # eight codes are too few


# n-grams


def shingle_sets(texts, width=5):
    out = []
    for t in texts:
        w = [x for x in (t or "").lower().replace("\t", " ").replace("\n", " ").split(" ") if x]
        out.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute_join(ids, texts):
    s = shingle_sets(texts)
    links = [[j for j in range(len(s)) if i != j and s[i] and s[j] and len(s[i] & s[j]) >= 0.8 * len(s[i] | s[j]) - 1e-12] for i in range(len(s))]
    comp = components(len(s), [(i, j) for i in range(len(s)) for j in links[i]])
    low = {}
    for i, c in enumerate(comp):
        low[c] = min(low.get(c, ids[i]), ids[i])
    return sorted((ids[i], low[comp[i]] if s[i] else ids[i], len(links[i])) for i in range(len(s)))


def test_documents_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(400)
    shared = [word() for _ in range(55)]
    texts = []
    for g in range(25):
        base = [word() for _ in range(rng.choice([3, 5, 8, 60, 150]))]
        for _ in range(rng.choice([1, 2, 6, 30])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                t[rng.randrange(len(t))] = word()
            if rng.random() < 0.2:
                t += shared
            texts.append(rng.choice([" ", "\n", "  "]).join(t).replace("w1 ", "W1 "))
    ids = list(range(1000, 1000 + len(texts)))
    rng.shuffle(ids)
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in zip(ids, texts)], "doc_id long, text string, cid string, m string, row string").repartition(5)
    for options in ({}, {"block_rows": 8, "block_bytes": 2000, "broadcast_rows": 0}):
        got = ngram_join(df, **options).collect()
        assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == brute_join(ids, texts)
        assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_odd_documents(spark):
    same = "one two three four five six seven"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "Hi"), (5, "hi"), (6, same), (6, same), (None, same), (7, same.upper()), (8, "x " * 30_000), (9, "x y " * 4), (None, "lonely text")]
    got = ngram_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.class_id, r.n_links, r.kept))
    for i in (1, 2, 3, 8, 9):
        assert by[i] == [(i, 0, True)]
    assert by[4] == [(4, 1, True)] and by[5] == [(4, 1, False)] and by[7] == [(6, 3, False)]
    assert sorted(by[6]) == [(6, 3, False), (6, 3, True)]
    assert sorted(by[None], key=str) == sorted([(6, 3, False), (None, 0, True)], key=str)
    assert ngram_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_pruning_rule():
    rule = least_matches(0.8, 1e-7)
    assert [n for n, _ in rule] == list(range(16, 129, 16)) and all(b[1] >= a[1] for a, b in zip(rule, rule[1:]))
    rng = np.random.default_rng(9)
    lost = 0
    for _ in range(200):  # pairs of exactly the threshold outlast the rule
        hits = np.cumsum(rng.random((500, 128)) < 0.8, axis=1)
        lost += sum((hits[:, n - 1] < k).sum() for n, k in rule)
    assert lost == 0


# lines


def brute_lines(rows, least):
    sites, first = {}, {}
    for d, s, t in rows:
        for p, line in enumerate((t or "").split("\n") if t is not None else []):
            k = line.strip(" ")
            if k:
                sites.setdefault(k, set()).add(s or "")
                first[k] = min(first.get(k, (d, p)), (d, p))
    out = []
    for d, s, t in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for p, x in enumerate(lines) if not (x.strip(" ") and len(sites[x.strip(" ")]) >= least and first[x.strip(" ")] != (d, p))]
        out.append((d, len(lines), len(lines) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out)


def test_lines_against_brute_force(spark):
    rng = random.Random(10)
    pool = [f"line {i}" for i in range(40)]
    rows = []
    for d in range(500):
        site = "hot" if d % 3 == 0 else f"s{rng.randrange(60)}"
        text = "\n".join(rng.choice([rng.choice(pool[: rng.choice([2, 10, 40])]), f"own {d} {k}", "", "  " + pool[0] + " "]) for k in range(rng.randrange(0, 12)))
        rows.append((d, rng.choice([site, None]) if d % 50 == 0 else site, rng.choice([text, None]) if d % 40 == 0 else text))
    rows.append((900, "a", "\n".join(pool * 400)))
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, source string, text string, n_lines string, first string").repartition(4)
    for least, room in ((2, 64 << 20), (12, 64 << 20), (25, 64 << 20), (60, 64 << 20), (12, 0)):  # no room: joins by shuffle
        got = dedup_lines(df, min_sites=least, broadcast_bytes=room)
        assert got.columns == ["doc_id", "source", "text", "n_lines", "first", "n_removed"]
        assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()) == brute_lines(rows, least)


def test_clashing_count_columns_in_any_case(spark):
    df = spark.createDataFrame([(1, "a", "x\ny", "p", "q"), (2, "b", "x\n" + "z" * 3_000_000, "p", "q"), (3, "", "x", "p", "q"), (4, None, "x", "p", "q")], "doc_id long, source string, text string, N_LINES string, N_Removed string")
    for room in (64 << 20, 0):
        out = dedup_lines(df, min_sites=3, broadcast_bytes=room)
        assert out.columns == ["doc_id", "source", "text", "n_lines", "n_removed"]
        assert sorted((r.doc_id, r.n_lines, r.n_removed, len(r.text)) for r in out.collect()) == [(1, 2, 0, 3), (2, 2, 1, 3_000_000), (3, 1, 1, 0), (4, 1, 1, 0)]


def test_chains_of_clusters_are_verified_cell_by_cell(spark):
    """One candidate component in a chain: each text shares most of its words with the next, few with those farther on."""
    rng = random.Random(12)
    words = ["w%d" % rng.randrange(10**6) for _ in range(1_200)]
    texts = [" ".join(words[i * 9 : i * 9 + 120]) for i in range(110)] + [" ".join(words[i * 9 : i * 9 + 119] + ["end"]) for i in range(0, 110, 3)]
    ids = list(range(len(texts)))
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)
    want = brute_join(ids, texts)
    for options in ({"block_rows": 4}, {"block_rows": 16, "block_bytes": 3_000}, {}):
        assert sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join(df, **options).collect()) == want


def test_odd_lines(spark):
    rows = [(1, "a", "x\nx\n\n y"), (2, "b", "x"), (2, "b", "x"), (None, "c", " x "), (3, "d", None), (4, "e", "")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = dedup_lines(df, min_sites=3).collect()
    text = {(r.doc_id, r.text) for r in got}
    assert len(got) == 6 and (None, " x ") in text and (1, "\n y") in text and (2, "") in text and (3, None) in text and (4, "") in text
    everywhere = dedup_lines(df, min_sites=3, keep_first=False).collect()
    assert {r.text for r in everywhere if r.doc_id in (None, 2)} == {""}
    assert dedup_lines(df.limit(0)).collect() == []
    plan = dedup_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
