import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st

from betaloom.functions import special
from betaloom.operators import compare, enrich, hms
from betaloom.plans.queries import QUERIES


def brute_mwu(u, n, m):
    """The share of rank assignments at least as far from the middle."""
    ranks, hits, total = range(1, n + m + 1), 0, 0
    high = max(u, n * m - u)
    for c in itertools.combinations(ranks, n):
        total += 1
        x = sum(c) - n * (n + 1) / 2
        hits += x >= high
    return min(1.0, 2 * hits / total)


@pytest.mark.parametrize("n,m", [(3, 4), (2, 6), (5, 5)])
def test_mwu_exact_equals_enumeration(n, m):
    for u in range(n * m + 1):
        assert special.mwu_exact_two_sided(u, n, m) == pytest.approx(brute_mwu(u, n, m), abs=1e-12)


@pytest.mark.parametrize("n,m", [(3, 4), (4, 4), (5, 3)])
def test_ks_exact_equals_enumeration(n, m):
    def gap(firsts):
        a = b = best = 0
        for i in range(n + m):
            if i in firsts:
                a += 1
            else:
                b += 1
            best = max(best, abs(a * m - b * n))
        return best

    gaps = [gap(set(c)) for c in itertools.combinations(range(n + m), n)]
    for g in set(gaps):
        assert special.ks_exact_two_sided(g / (n * m), n, m) == pytest.approx(sum(x >= g for x in gaps) / len(gaps), abs=1e-12)


def test_student_closed_forms():
    for t in (0.1, 1.0, 2.5, 40.0):
        assert special.student_two_sided(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), rel=1e-12)
        assert special.student_two_sided(t, 2) == pytest.approx(1 - t / math.sqrt(t * t + 2), rel=1e-9)


def test_erfc_expression(spark):
    xs = [x / 8 for x in range(-40, 200)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", special.erfc("x").alias("y")).collect()
    for x, y in got:
        assert y == pytest.approx(math.erfc(x), rel=1e-13)


def cohort(spark, a, b):
    rows = [("x", f"a{i}", v) for i, v in enumerate(a)] + [("x", f"b{i}", v) for i, v in enumerate(b)]
    m = spark.createDataFrame(rows, "feature string, sample_id string, value double")
    meta = spark.createDataFrame([(f"a{i}", "CRC") for i in range(len(a))] + [(f"b{i}", "Control") for i in range(len(b))], "sample_id string, clinical_category string")
    return m, meta


def test_exact_and_tied_mann_whitney(spark):
    a, b = [1.0, 2.0, 6.0], [3.0, 4.0, 5.0, 7.0]
    row = compare.compare_groups(*cohort(spark, a, b), "CRC", "Control").head()
    u = sum(x > y for x in a for y in b)
    assert row.statistic == u and row.p_value == pytest.approx(brute_mwu(u, 3, 4))
    same = compare.compare_groups(*cohort(spark, [1.0, 1.0], [1.0, 1.0]), "CRC", "Control").head()
    assert same.p_value == 1.0 and same.cohens_d == 0.0
    few = compare.compare_groups(*cohort(spark, [1.0], [1.0, 2.0]), "CRC", "Control").head()
    assert few.p_value is None and few.statistic is None and few.cohens_d == 0.0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=2, max_size=12), st.lists(st.integers(0, 9), min_size=2, max_size=12))
def test_u_counts_pairs(spark, a, b):
    row = compare.compare_groups(*cohort(spark, [float(x) for x in a], [float(x) for x in b]), "CRC", "Control").head()
    assert row.statistic == sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def test_separable_feature_and_missing_values(spark):
    rng = random.Random(1)
    a = [rng.uniform(0.75, 0.95) for _ in range(10)] + [float("nan")]
    b = [rng.uniform(0.10, 0.25) for _ in range(10)]
    m, meta = cohort(spark, a, b)
    for test in compare.TESTS:
        row = compare.run_all_comparisons(m, meta, [("CRC", "Control"), ("polyps", "Control")], test=test).collect()
        assert len(row) == 1 and row[0].significant and row[0].delta_mean > 0.4
    with pytest.raises(ValueError):
        compare.compare_groups(m, meta, "polyps", "Control")
    with pytest.raises(ValueError):
        compare.compare(m, meta, [("CRC", "Control")], test="sign")


def test_fdr(spark):
    def q(ps, method="fdr_bh"):
        rows = [(f"f{i:03}", p) for i, p in enumerate(ps)]
        return {r.feature: (r.q_value, r.significant) for r in compare.adjust(spark.createDataFrame(rows, "feature string, p_value double"), method).collect()}

    got = q([0.01, 0.02, 0.02, 0.5])
    assert [got[f"f{i:03}"][0] for i in range(4)] == pytest.approx([0.08 / 3, 0.08 / 3, 0.08 / 3, 0.5])
    got = q([0.01, float("nan"), 0.04, None])
    assert got["f001"] == (None, False) and got["f003"] == (None, False) and got["f000"][0] == pytest.approx(0.04)
    assert all(x[1] for x in q([1e-9] * 5).values()) and not any(x[1] for x in q([1.0] * 5).values())
    for method in compare.FDR_METHODS:
        got = q([0.01, 0.04, 0.5, 0.8], method)
        for i, p in enumerate([0.01, 0.04, 0.5, 0.8]):
            assert got[f"f{i:03}"][0] >= p


def test_fisher(spark):
    df = lambda *g: spark.createDataFrame([(x,) for x in g], "gene string")
    sets = spark.createDataFrame([("P", g) for g in "ABD"] + [("none", "Z"), ("P", "A")], "pathway string, gene string")
    got = {r.pathway: r for r in enrich.fisher_enrichment(df(*"ABC"), sets, df(*"ABCDEF")).collect()}
    p = got["P"]
    assert (p.n_overlap, p.n_significant, p.n_pathway, p.n_background) == (2, 3, 3, 6)
    assert p.p_value == pytest.approx(0.5) and p.odds_ratio == pytest.approx(4.0) and p.overlap_genes == ["A", "B"]
    assert got["none"].p_value == 1.0 and got["none"].odds_ratio is None


def test_gsea(spark):
    ranked = spark.createDataFrame([(f"g{i:02}", 5.0 - 0.1 * i) for i in range(50)], "gene string, metric double")
    sets = spark.createDataFrame([("top", f"g{i:02}") for i in range(8)] + [("low", f"g{i:02}") for i in range(40, 48)] + [("void", "x")], "pathway string, gene string")
    es = {r.pathway: r.es for r in enrich.running_sum(ranked, sets).collect()}
    assert es["top"] > 0 > es["low"] and es["void"] == 0
    for exact in (False, True):
        got = {r.pathway: r for r in enrich.gsea_preranked(ranked, sets, 50, exact_rng=exact).collect()}
        assert set(got) == {"top", "low"} and got["top"].es == pytest.approx(es["top"]) and got["top"].p_value == pytest.approx(1 / 51)
    again = {r.pathway: r.nes for r in enrich.gsea_preranked(ranked, sets, 50).collect()}
    assert again == {r.pathway: r.nes for r in enrich.gsea_preranked(ranked, sets, 50).collect()}


def test_gsea_query_draws_a_thousand_permutations(spark):
    p = [r.p_value for r in QUERIES["gsea_perm"](spark, "/root/testdata/sf0.001").collect()]
    assert all(x == 1 / 1001 or abs(x * 1000 - round(x * 1000)) < 1e-6 for x in p)
    assert any(round(x * 1000) % 10 for x in p)  # finer than hundredths


def test_hms_extremes(spark):
    rows = [(f"g{g}", f"s{s}", float(g * 7 % 5 + s)) for g in range(5) for s in range(6)]
    f = spark.createDataFrame(rows, "gene string, sample_id string, value double")
    meta = spark.createDataFrame([(f"s{s}", "Control" if s < 3 else "CRC") for s in range(6)], "sample_id string, clinical_category string")
    t = {(r.gene, r.quantile): r.threshold for r in hms.gene_thresholds(f, meta, quantiles=(0.0, 1.0)).collect()}
    for g in range(5):
        own = [v for n, s, v in rows if n == f"g{g}" and s < "s3"]
        assert t[f"g{g}", 0.0] == min(own) and t[f"g{g}", 1.0] == max(own)
    counts = {r.sample_id: r.hms_count for r in hms.score_samples(f, hms.gene_thresholds(f, meta, quantiles=(1.0,))).collect()}
    assert counts == {"s0": 0, "s1": 0, "s2": 0, "s3": 5, "s4": 5, "s5": 5}
    with pytest.raises(ValueError):
        hms.gene_thresholds(f, meta, control="none")


def test_large_fdr_equals_small(spark):
    rng = np.random.default_rng(2)
    rows = [(f"f{i}", float(p) if i % 9 else None) for i, p in enumerate(rng.uniform(size=3000) ** 4)]
    df = spark.createDataFrame(rows, "feature string, p_value double")
    tied = spark.createDataFrame([(f"f{i}", 1.0 if i % 3 else round(float(p), 2), "ab"[i % 2]) for i, p in enumerate(rng.uniform(size=2000) ** 4)], "feature string, p_value double, label string")
    for rows, by in ((df, None), (tied, None), (tied, ["label"])):
        for method in compare.FDR_METHODS:
            a = {r.feature: (r.q_value, r.significant) for r in compare.adjust(rows, method, by=by).collect()}
            b = {r.feature: (r.q_value, r.significant) for r in compare.adjust_large(rows, method, by=by).collect()}
            assert a.keys() == b.keys()
            for k in a:
                assert a[k][1] == b[k][1] and (a[k][0] is None) == (b[k][0] is None) and (a[k][0] is None or a[k][0] == pytest.approx(b[k][0], rel=1e-12))
    assert compare.adjust_large(df.limit(0)).collect() == []


def test_closed_forms_equal_sums(spark):
    import math

    rows = spark.createDataFrame([(n,) for n in (0, 1, 2, 19, 20, 21, 22, 50, 100, 101, 1000, 20_000)], "n long")
    for r in rows.select("n", enrich.log_factorial(F.col("n")).alias("l"), compare.harmonic("n").alias("h")).collect():
        assert r.l == pytest.approx(math.lgamma(r.n + 1), rel=1e-13, abs=1e-13)
        assert r.n == 0 or r.h == pytest.approx(math.fsum(1 / i for i in range(1, r.n + 1)), rel=1e-14)
    # a tail whose first term is far below the smallest double
    big = spark.createDataFrame([(0, 3000, 4000, 8000)], "a long, s long, h long, t long")
    assert big.select(enrich.fisher_tail(*(F.col(c) for c in "asht"))).head()[0] == pytest.approx(1.0, abs=1e-9)


def test_hits_alone_give_the_running_sum():
    rng = np.random.default_rng(4)
    metric = np.sort(rng.normal(size=60))[::-1]
    for _ in range(200):
        hit = rng.random(60) < rng.choice([0.05, 0.3, 0.9])
        if 0 < hit.sum() < 60:
            at = np.flatnonzero(hit)
            assert enrich._score_hits(at[None], np.abs(metric[at])[None], 60)[0] == pytest.approx(enrich._score(metric, hit), abs=1e-12)


def test_weighted_needs_weights(spark):
    from betaloom.operators import rollup

    with pytest.raises(ValueError):
        rollup.rollup_sites(spark.range(1), spark.range(1), "weighted")
    with pytest.raises(ValueError):
        rollup.rollup_sites(spark.range(1), spark.range(1), "mode")


def test_permutation_null_equals_brute_force(spark):
    import hashlib

    from betaloom.operators.enrich import permutation_null

    metric = [3.0, 2.5, 2.5, 1.0, 0.5, 0.0, -0.25, -1.0, -4.0, -4.5, 7.0, 0.125]
    ranked = spark.createDataFrame([(f"g{i:02}", m) for i, m in enumerate(metric)], "gene string, metric double")
    sizes = spark.createDataFrame([(1,), (3,), (3,), (0,), (12,), (11,)], "n_hits long")
    got = {(r.n_hits, r.permutation): r.es for r in permutation_null(ranked, sizes, 40, seed=9).collect()}
    assert set(got) == {(n, p) for n in (1, 3, 11) for p in range(1, 41)}
    weight = [abs(m) for m in sorted(metric, reverse=True)]
    for (n, p), es in got.items():
        order = sorted(range(1, 13), key=lambda at: (hashlib.md5(f"9/{p}/{at}".encode()).hexdigest(), at))
        hits, walk, total = set(order[:n]), [0.0], sum(weight[at - 1] for at in order[:n])
        for at in range(1, 13):
            walk.append(walk[-1] + (weight[at - 1] / (total or 1.0) if at in hits else -1 / (12 - n)))
        top, bottom = max(walk), min(walk)
        assert es == pytest.approx(top if top + 1e-12 >= -bottom else bottom, abs=1e-9)


def test_gsea_plan_collects_no_ranking(spark):
    ranked = spark.range(3000).selectExpr("concat('g', cast(id as string)) gene", "cast((id * 7919) % 3001 as double) - 1500 metric")
    sets = spark.range(300).selectExpr("concat('s', cast(id % 4 as string)) pathway", "concat('g', cast(id * 9 as string)) gene")
    got = {r.pathway: r for r in enrich.gsea_preranked(ranked, sets, 60).collect()}
    assert len(got) == 4 and all(r.n_hits == 75 and 0 < r.p_value <= 1 and r.nes != 0 for r in got.values())
    assert enrich.gsea_preranked(ranked.where("false"), sets, 5).count() == 0


def test_large_adjustment_sees_its_rows_once(spark):
    """p that differ whenever they are computed again, as means summed in another order do."""
    from pyspark.sql import functions as F

    p = F.udf(lambda i: __import__("random").random(), "double").asNondeterministic()
    rows = spark.range(0, 3000, 1, 4).select(F.col("id").cast("string").alias("feature"), p("id").alias("p_value"))
    got = compare.adjust_large(rows).toPandas()
    want = {r.feature: r.q_value for r in compare.adjust(spark.createDataFrame(got[["feature", "p_value"]])).collect()}
    assert len(got) == 3000 and all(abs(q - want[f]) < 1e-12 for f, q in zip(got["feature"], got["q_value"]))


def test_large_adjustment_cuts_its_families_once(spark, monkeypatch):
    """Approximate quantiles that differ whenever they are computed again, as they do with the order in which counts arrive."""
    from pyspark.sql import functions as F

    shift = F.udf(lambda cuts: [c * __import__("random").uniform(0.8, 1.0) for c in cuts], "array<double>").asNondeterministic()
    exact = F.percentile_approx
    monkeypatch.setattr(compare.F, "percentile_approx", lambda *args: shift(exact(*args)))
    rows = spark.range(0, 3000, 1, 4).selectExpr("cast(id as string) feature", "power((id * 7919 % 100003 + 1) / 100004D, 3) p_value")
    want = {r.feature: r.q_value for r in compare.adjust(rows, "fdr_by").collect()}
    got = {r.feature: r.q_value for r in compare.adjust_large(rows, "fdr_by").collect()}
    assert got.keys() == want.keys() and [f for f, q in want.items() if abs(got[f] - q) > 1e-12] == []


def test_md5_of_many_texts_equals_the_library():
    import hashlib

    from betaloom.functions.md5 import md5_heads

    numbers = np.array([0, 7, 10, 99, 100, 12345, 999_999, 1_000_000, 7_200_000, 2**32, 2**62])
    heads = md5_heads(numbers)
    for prefix in ("", "4", "42/", "42/7/", "42/10/", "42/999/", "42/1000/", "-123456789/1000000/"):
        assert heads(prefix).tolist() == [int(hashlib.md5(f"{prefix}{n}".encode()).hexdigest()[:8], 16) for n in numbers]
    assert md5_heads(numbers[:0])("42/1/").tolist() == []
    with pytest.raises(ValueError):
        heads("x" * 40)


def test_places_of_equal_heads_are_drawn_by_the_whole_digest():
    import hashlib

    rng = np.random.default_rng(6)
    at, weight, sizes = np.arange(1, 401), rng.random(400), [1, 2, 57, 130, 131, 399]
    digests = [hashlib.md5(f"42/3/{i}".encode()).digest() for i in at]
    order = sorted(range(400), key=lambda i: digests[i])
    for bits in (1, 4, 32):  # the fewer bits a head has, the more places share it
        head = np.array([int.from_bytes(d[:4], "big") >> (32 - bits) for d in digests], np.uint32)
        for size, es in zip(sizes, enrich._null_scores(at, head, weight, sizes, 400, "42/3/")):
            hits = np.sort(order[:size])
            assert es == enrich._score_hits(hits[None], weight[hits][None], 400)[0]


def test_a_place_is_no_row_of_a_permutation(spark):
    ranked = spark.range(3000).selectExpr("concat('g', cast(id as string)) gene", "cast(id as double) metric")
    null = enrich.permutation_null(ranked, spark.createDataFrame([(2,), (40,)], "n_hits long"), 6)
    assert "explode" not in null._jdf.queryExecution().executedPlan().toString().lower()
    assert null.count() == 12
