import random

import pytest

from betaloom.operators import sampling


def sizes(spark, d):
    return spark.createDataFrame(list(d.items()), "stratum string, size long")


@pytest.mark.parametrize("seed", range(6))
def test_quotas_sum_up_and_keep_the_floors(spark, seed):
    rng = random.Random(seed)
    d = {f"s{k}": rng.choice([1, 2, 5, 40, 1000, 20_000]) for k in range(rng.randrange(1, 9))}
    if seed % 2:
        d[None] = rng.randrange(1, 50)
    total = sum(d.values())
    for n, least in ((1, 1), (7, 3), (total // 3, 1), (total - 1, 2), (total + 5, 4)):
        got = {r.stratum: r.quota for r in sampling.quotas(sizes(spark, d), n, least).collect()}
        assert sum(got.values()) == min(n, total)
        assert all(0 <= q <= d[s] for s, q in got.items())
        floors = {s: min(d[s], least) for s in d if s is not None}
        if sum(floors.values()) <= n:
            assert all(got[s] >= f for s, f in floors.items())


def test_exactly_n_rows_of_a_table_with_a_hot_stratum(spark):
    rows = [(f"k{k}", "hot" if k % 3 else f"s{k % 11}", k) for k in range(4000)]
    df = spark.createDataFrame(rows, "key string, s string, extra int")
    got = sampling.stratified_exact(df, 1000, stratum_col="s", key_col="key", least=5).collect()
    assert len(got) == len({r.key for r in got}) == 1000 and {tuple(r) for r in got} <= set(rows)
    again = sampling.stratified_exact(df.repartition(7), 1000, stratum_col="s", key_col="key", least=5).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))
    other = sampling.stratified_exact(df, 1000, stratum_col="s", key_col="key", least=5, seed=1).collect()
    assert sorted(map(tuple, other)) != sorted(map(tuple, got))


def test_all_rows_none_and_repeats(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), (None, "y")], "key string, s string")
    assert sampling.stratified_exact(df, 9, stratum_col="s", key_col="key").count() == 4
    assert sampling.stratified_exact(df, 3, stratum_col="s", key_col="key").count() == 3
    assert sampling.stratified_exact(df, 0, stratum_col="s", key_col="key").count() == 0
    assert sampling.stratified_exact(df.where("false"), 3, stratum_col="s", key_col="key").count() == 0


def test_samples_without_category_fill_up(spark):
    samples = spark.createDataFrame([(f"S{k}",) for k in range(40)], "sample_id string")
    known = spark.createDataFrame([(f"S{k}", "CRC" if k < 3 else "Control") for k in range(12)] + [("other", "CRC")], "barcode string, clinical_category string")
    got = sampling.select_samples(samples, 20, known, least=2).collect()
    assert len(got) == 20 and sum(r.clinical_category == "CRC" for r in got) == 3 and sum(r.clinical_category == "Control" for r in got) == 9
    got = sampling.select_samples(samples, 6, known, least=2).collect()
    assert sorted(r.clinical_category for r in got) == ["CRC"] * 2 + ["Control"] * 4
    assert sampling.select_sites(spark.createDataFrame([("chr1_1", "chr1"), ("chr2_5", "chr2"), ("chr2_5", "chr2")], "cpg_id string, chrom string"), 5, chromosomes=["chr2"]).count() == 1
