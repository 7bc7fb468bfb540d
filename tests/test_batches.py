import json
import os

from pyspark.sql import functions as F

from betaloom.operators import graph
from betaloom.sources.batches import FolderSink, write_batches


def failing(folder):
    """A sink that refuses a batch that holds a certain key, until a file says otherwise."""

    class Failing(FolderSink):
        def write(self, name, rows):
            if (rows["k"] == 57).any() and not os.path.exists(f"{self.folder}/mended"):
                raise ValueError("row 57 is refused")
            FolderSink.write(self, name, rows)

    return lambda: Failing(folder)


def written(folder):
    return {f: [json.loads(line)["k"] for line in open(folder / f, encoding="utf-8")] for f in sorted(os.listdir(folder)) if f.endswith(".jsonl")}


def test_a_failed_batch_stops_no_other_and_a_second_run_adds_only_what_lacks(spark, tmp_path):
    folder = tmp_path / "sink"
    rows = spark.createDataFrame([(k, f"name {k}") for k in range(205)], "k long, name string").repartition(6)
    connect = failing(str(folder))
    outcomes, failed = write_batches(rows, [F.col("k")], connect, table="gene", size=20)
    got = {r.batch: (r.name, r.n_rows, r.status, r.error) for r in outcomes.collect()}
    assert len(got) == 11 and got[10] == ("gene-00000010", 5, "written", None)
    assert got[2] == ("gene-00000002", 20, "failed", "ValueError: row 57 is refused")
    assert sorted(r.k for r in failed.collect()) == list(range(40, 60)) and failed.columns == ["k", "name", "batch"]
    files = written(folder)
    assert files == {f"gene-{b:08d}.jsonl": list(range(20 * b, min(205, 20 * b + 20))) for b in range(11) if b != 2}

    (folder / "mended").touch()
    outcomes, failed = write_batches(rows.repartition(3), [F.col("k")], connect, table="gene", size=20)
    assert {r.batch: r.status for r in outcomes.collect()} == {b: "written" if b == 2 else "present" for b in range(11)}
    assert failed.count() == 0 and written(folder) == files | {"gene-00000002.jsonl": list(range(40, 60))}
    assert not [f for f in os.listdir(folder) if f.endswith(".part")]


def test_an_empty_table_gives_no_batch(spark, tmp_path):
    outcomes, failed = write_batches(spark.createDataFrame([], "k long"), [F.col("k")], lambda: FolderSink(str(tmp_path / "s")), table="t")
    assert outcomes.count() == failed.count() == 0


def test_a_graph_is_sent_part_by_part(spark, tmp_path):
    g = graph.Graph(v_gene=spark.range(25).selectExpr("concat('G', cast(id as string)) gene_id", "id k"), v_pathway=spark.createDataFrame([("P", 1)], "pathway_id string, k long"), e_gene_pathway=spark.range(60).selectExpr("concat('G', cast(id % 25 as string)) gene_id", "'P' pathway_id", "id k"))
    outcomes, failed = g.send(failing(str(tmp_path / "g")), size=10)
    got = {(r.part, r.batch): r.status for r in outcomes.collect()}
    assert len(got) == 3 + 1 + 6 and [k for k, v in got.items() if v == "failed"] == [next(k for k in got if got[k] == "failed")]
    assert set(failed) == {"e_gene_pathway"} and 57 in {r.k for r in failed["e_gene_pathway"].collect()} and failed["e_gene_pathway"].count() == 10
    assert sum(len(v) for k, v in written(tmp_path / "g").items() if k.startswith("e_")) == 50
    (tmp_path / "g" / "mended").touch()
    outcomes, failed = g.send(failing(str(tmp_path / "g")), size=10)
    assert {r.status: r["count"] for r in outcomes.groupBy("status").count().collect()} == {"present": 9, "written": 1} and not failed
    assert sorted(k for f, v in written(tmp_path / "g").items() if f.startswith("e_") for k in v) == list(range(60))
