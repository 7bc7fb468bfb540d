import itertools
import random

import pytest
from pyspark.sql import functions as F

from betaloom.operators.order import chunked, numbered, running
from betaloom.plans.queries import QUERIES
from betaloom.sources.beta_csv import row_chunks


def table(spark, n=500, kinds=7, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(kinds)]), k, None if rng.random() < 0.2 else rng.randrange(-50, 50)) for k in range(n)]
    return rows, spark.createDataFrame(rows, "v int, k int, x long").repartition(5)


def low(v):
    return (v is not None, v or 0)


def test_numbers_follow_the_order(spark):
    rows, df = table(spark)
    got = [tuple(r) for r in numbered(df, [F.col("v"), F.col("k")], parts=7).orderBy("n").collect()]
    want = sorted(rows, key=lambda r: (low(r[0]), r[1]))
    assert got == [(*r, i + 1) for i, r in enumerate(want)]


@pytest.mark.parametrize("kinds", [1, 2, 40])
def test_equal_values_share_a_rank_over_partition_bounds(spark, kinds):
    rows, df = table(spark, kinds=kinds, seed=kinds)
    got = {(r.v, r.k): r.rank for r in numbered(df, [F.col("v"), F.col("k")], tie=["v"], name="rank", parts=9).collect()}
    values = sorted((r[0] for r in rows), key=low)
    assert got == {(v, k): values.index(v) + 1 for v, k, _ in rows}


def test_running_totals(spark):
    rows, df = table(spark, seed=4)
    got = [tuple(r) for r in running(df, [F.desc("v"), F.col("k")], {"s": ("x", "sum"), "lo": ("x", "min"), "hi": ("x", "max")}, parts=6).orderBy("n").collect()]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    for i, (g, r) in enumerate(zip(got, want)):
        xs = [x for _, _, x in want[: i + 1] if x is not None]
        assert g == (*r, i + 1, *((sum(xs), min(xs), max(xs)) if xs else (None, None, None)))


def test_a_third_of_all_rows_may_share_a_value(spark):
    rows = [(0 if k % 3 else k, k, 1) for k in range(3000)]
    df = spark.createDataFrame(rows, "v int, k int, x long")
    out = numbered(df, [F.col("v"), F.col("k")], tie=["v"], parts=8)
    assert {r.n for r in out.where("v = 0").collect()} == {1}
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 1500


def test_chunks_and_empty_tables(spark):
    rows, df = table(spark, n=103)
    got = row_chunks(df.select("k"), 10, "k").orderBy("k").collect()
    assert [(r.k, r.chunk) for r in got] == [(k, k // 10) for k in range(103)]
    empty = df.where("false")
    assert numbered(empty, [F.col("k")]).count() == chunked(empty, [F.col("k")], 5).count() == running(empty, [F.col("k")], {"s": ("x", "sum")}).count() == numbered(empty, [F.col("v"), F.col("k")], tie=["v"]).count() == 0


def test_no_step_runs_in_a_single_task(spark):
    _, df = table(spark, n=50)
    for out in (numbered(df, [F.col("v"), F.col("k")], tie=["v"]), running(df, [F.col("k")], {"s": ("x", "sum")}), row_chunks(df, 7, "k")):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    assert list(itertools.islice(row_chunks(df, 7, "k").columns, 4)) == ["v", "k", "x", "chunk"]


def test_no_task_sorts_all_sites(spark):
    df = QUERIES["id_sort"](spark, "/root/testdata/sf0.001")
    assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.ord for r in df.orderBy("ord").collect()] == list(range(1, df.count() + 1))
