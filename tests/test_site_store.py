import os
import random
from urllib.parse import urlparse

import pytest

from betaloom.operators import rank
from betaloom.sources import beta_csv, site_store

CELLS = "sample_id string, chrom string, pos long, cpg_id string, beta double"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = random.Random(8)
    sites = [(c, p) for c in ("chr1", "chr2", "chr10", "chrX") for p in rng.sample(range(1, 60_000_000), 300)]
    rows = [(f"S{s}", c, p, f"{c}_{p}", rng.random()) for s in range(12) for c, p in sites]
    out = str(tmp_path_factory.mktemp("store") / "cells")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 240)  # small files in place of large ones
    try:
        site_store.write_store(spark.createDataFrame([*rows, ("S0", None, 5, "x", 0.5), ("S0", "chr1", None, "y", 0.5)], CELLS), out, sample_blocks=2, row_group_bytes=1024)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    return out, rows


def test_the_store_holds_every_cell_in_order(spark, store):
    out, rows = store
    assert sorted((r.sample_id, r.chrom, r.pos, r.cpg_id, r.beta) for r in site_store.cells_of(spark, out).collect()) == sorted(rows)
    order = ["chr1", "chr2", "chr10", "chrX"]
    sites = sorted({(c, p) for _, c, p, _, _ in rows}, key=lambda s: (order.index(s[0]), s[1]))
    got = site_store.site_dictionary(spark, out).orderBy("ord").collect()
    assert [(r.ord, r.chrom, r.pos, r.n_cells) for r in got] == [(i + 1, c, p, 12) for i, (c, p) in enumerate(sites)]
    assert site_store.first_sites(spark, out, 5) == [f"{c}_{p}" for c, p in sites[:5]]
    assert {r.chrom: (r.n_sites, r.n_cells) for r in site_store.chromosome_counts(spark, out).collect()} == {c: (300, 3600) for c in order}


def test_few_sites_read_few_files_by_pushed_filters(spark, store):
    out, rows = store
    asked = [rows[0][3], rows[700][3], "chr3_7", "nonsense", rows[0][3]]
    found = site_store.read_sites(spark, out, asked)
    assert sorted((r.sample_id, r.cpg_id, r.beta) for r in found.collect()) == sorted((s, i, b) for s, _, _, i, b in rows if i in asked)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "chrom#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "In(pos" in pushed and "GreaterThanOrEqual(pos" in pushed and "LessThanOrEqual(pos" in pushed
    all_files = site_store.cells_of(spark, out).inputFiles()
    assert len(found.inputFiles()) <= 8 and len(all_files) >= 60  # two sites, in at most two files of each block of samples
    size = {f: os.path.getsize(urlparse(f).path) for f in all_files}
    assert sum(size[f] for f in found.inputFiles()) * 5 < sum(size.values())


def test_many_sites_and_tables_of_sites_are_joined(spark, store, monkeypatch):
    out, rows = store
    asked = sorted({r[3] for r in rows})[::3] + ["chr1_1", "?"]
    want = sorted((s, i) for s, _, _, i, _ in rows if i in set(asked))
    table = spark.createDataFrame([(s,) for s in [*asked, *asked]], "cpg_id string")
    assert sorted((r.sample_id, r.cpg_id) for r in site_store.read_sites(spark, out, table).collect()) == want
    assert sorted((r.sample_id, r.cpg_id) for r in site_store.read_sites(spark, out, asked).collect()) == want
    monkeypatch.setattr(site_store, "LITERALS", 10)
    assert sorted((r.sample_id, r.cpg_id) for r in site_store.read_sites(spark, out, asked).collect()) == want
    assert site_store.read_sites(spark, out, ["?"]).count() == site_store.read_sites(spark, out, ["chr22_5"]).count() == 0


def test_empty_store(spark, tmp_path):
    out = str(tmp_path / "none")
    site_store.write_store(spark.createDataFrame([], CELLS), out)
    assert site_store.site_dictionary(spark, out).count() == 0


def test_conversion_writes_the_dictionary(spark, tmp_path):
    (tmp_path / "m.csv").write_text(",chr2_50,note,chr1_9,chr1_7000001\nA,0.5,x,0.25,\nB,bad,y,0.75,1\n")
    counts, bad = beta_csv.convert(spark, str(tmp_path / "m.csv"), str(tmp_path / "store"))
    assert counts == {"chr1": 2, "chr2": 1} and bad == 1
    assert site_store.first_sites(spark, str(tmp_path / "store"), 2) == ["chr1_9", "chr1_7000001"]
    assert sorted((r.sample_id, r.beta) for r in site_store.read_sites(spark, str(tmp_path / "store"), ["chr2_50"]).collect()) == [("A", 0.5), ("B", None)]
    r = site_store.store_value_stats(spark, str(tmp_path / "store")).head()
    assert (r["mean"], r["median"]) == (0.625, 0.625)


def test_annotations_of_ranked_sites_are_not_shuffled(spark):
    results = spark.createDataFrame([(f"chr1_{k}", k / 100, 0.01) for k in range(1, 50)], "feature string, delta_mean double, q_value double")
    notes = spark.range(1, 100_000).selectExpr("concat('chr1_', cast(id as string)) cpg_id", "id * 2 note")
    got = rank.rank_sites(results, 5, annotations=notes).collect()
    assert sorted((r.cpg_id, r.note) for r in got) == [(f"chr1_{k}", 2 * k) for k in range(45, 50)]
    plan = rank.rank_sites(results, 5, annotations=notes)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_few_sites_of_many_samples_are_written_by_several_tasks(spark, tmp_path):
    out = str(tmp_path / "few")
    cells = spark.range(40_000, numPartitions=4).selectExpr("concat('S', id) sample_id", "'chr1' chrom", "id % 2 * 1000 + 1000 pos", "concat('chr1_', id % 2 * 1000 + 1000) cpg_id", "id / 40000D beta")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        site_store.write_store(cells, out)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(site_store.cells_of(spark, out).inputFiles()) > 1
    assert {r.cpg_id: r.n_cells for r in site_store.site_dictionary(spark, out).collect()} == {"chr1_1000": 20_000, "chr1_2000": 20_000}
    assert site_store.store_value_stats(spark, out).head()["mean"] == pytest.approx(39_999 / 80_000)
