import random
import zipfile
from xml.sax.saxutils import escape

import pytest

from betaloom.operators import intervals, matrix, rank, sampling
from betaloom.plans import pipeline
from betaloom.sources import annotations, beta_csv, config, tables


def write_workbook(path, sheets):
    """A minimal .xlsx with inline and shared strings."""
    shared = sorted({str(v) for rows in sheets.values() for r in rows for v in r if v is not None})
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="rId{i}" Target="worksheets/s{i}.xml"/>' for i, _ in enumerate(sheets, 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(f'<row r="{j}">' + "".join(f'<c r="{chr(65 + k)}{j}" t="s"><v>{shared.index(str(v))}</v></c>' for k, v in enumerate(r) if v is not None) + "</row>" for j, r in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "data/external").mkdir(parents=True)
    (root / "data/raw").mkdir()
    rng = random.Random(3)
    samples = [f"S{i:02}" for i in range(20)]
    sites = [f"chr1_{1000 + 50 * i}" for i in range(20)] + [f"chr2_{1000 + 50 * i}" for i in range(10)]
    with open(root / "data/raw/beta.csv", "w") as f:
        f.write("," + ",".join([*sites, "bad_column"]) + "\n")
        for i, s in enumerate(samples):
            high = i < 10
            cells = [f"{rng.uniform(0.75, 0.95) if high and j < 20 else rng.uniform(0.1, 0.3):.4f}" for j in range(30)]
            for j in range(20, 25):
                cells[j] = "NA" if i == j - 20 else cells[j]
            for j in range(25, 30):
                cells[j] = ["", "NaN", "NA"][i % 3] if j - 25 <= i < j - 20 else cells[j]
            f.write(",".join([f" {s} ", *cells, "x"]) + "\n")
    write_workbook(root / "data/raw/clinical.xlsx", {
        "CLIN_CRC": [["Barcode", "Diagnosis"], *[[f" s{i:02}", "colorectal cancer"] for i in range(10)]],
        "CLIN_Control": [["sample_id", "group"], *[[f"S{i:02}", "Healthy"] for i in range(10, 20)], [None, "x"], ["S00", "Ctrl"]],
        "summary": [["a"], ["b"]],
    })
    g = lambda c, s, e, i, n: f'{c}\tHAVANA\tgene\t{s}\t{e}\t.\t+\t.\tgene_id "ENSG{i}.2"; gene_name "{n}"; gene_type "protein_coding";\n'
    (root / "data/external/gencode.gtf").write_text("#comment\n" + g("chr1", 900, 2100, 1, "HIGH") + g("chr2", 900, 2100, 2, "FLAT") + g("chr1", 1, 2, 1, "AGAIN") + 'chr1\tx\texon\t1\t2\t.\t+\t.\tgene_id "E";\n')
    gaf = lambda sym, go, taxon: "\t".join(["DB", "id", sym, "involved_in", go, "r", "IEA", "", "P", "", "", "protein", f"taxon:{taxon}", "2020", "DB"]) + "\n"
    (root / "data/external/goa_human.gaf").write_text("!x\n" + gaf("HIGH", "GO:1", 9606) + gaf("FLAT", "GO:2", 9606) + gaf("MOUSE", "GO:3", 10090))
    (root / "data/external/ReactomePathways.txt").write_text("R-1\tPath one\tHomo sapiens\nR-2\tPath two\tHomo sapiens\nM-1\tx\tMus musculus\n")
    (root / "data/external/Ensembl2Reactome.txt").write_text("ENSG1.3\tR-1\tu\tPath one\tTAS\tHomo sapiens\nENSG2.1\tR-2\tu\tPath two\tTAS\tHomo sapiens\n")
    (root / "data/external/cpgIslandExt.txt").write_text("\t".join(["1", "chr1", "1200", "1300", "CpG: 9", "100", "9", "70", "18", "70.5", "0.9"]) + "\n")
    return root


@pytest.fixture(scope="module")
def cfg(project):
    return pipeline.Config(data=f"{project}/data", results=f"{project}/results", beta_csv=f"{project}/data/raw/beta.csv", clinical_xlsx=f"{project}/data/raw/clinical.xlsx")


def test_all_steps(spark, project, cfg):
    assert pipeline.run(spark, cfg, ["clinical", "nonsense"]) == ["clinical"]
    ran = pipeline.run(spark, cfg)
    assert ran == [s for s in pipeline.STEPS if s != "clinical"]
    assert pipeline.run(spark, cfg) == []
    meta = {r.barcode: r for r in spark.read.parquet(cfg.path("clinical")).collect()}
    assert len(meta) == 20 and meta["S12"].clinical_category == "Control" and meta["S00"].source_sheet == "CLIN_CRC" or meta["S00"].source_sheet == "CLIN_Control"
    cov = spark.read.parquet(cfg.path("coverage"))
    assert cov.count() == 30 and cov.where("coverage >= 0.95").count() == 25
    found = {r.feature: r for r in spark.read.parquet(f"{cfg.path('comparisons')}/CRC_vs_Control.parquet").collect()}
    assert found["HIGH"].significant and found["HIGH"].delta_mean > 0.4 and not found["FLAT"].significant
    rep = spark.read.parquet(f"{cfg.path('reports')}/biomarker_report.parquet").collect()
    assert any(r.level == "gene" and r.identifier == "HIGH" and r["rank"] == 1 and "R-1" in r.pathways for r in rep)
    assert {r.identifier for r in rep if r.level == "gene"} == {f for f, r in found.items() if r.significant}
    assert "Comparison CRC_vs_Control" in open(f"{cfg.path('reports')}/report.md").read()
    state = pipeline.State(cfg.path("state"), "production")
    assert state.completed("report") and not pipeline.State(cfg.path("state"), "dev").completed("report")


def test_start_from_and_command_line(spark, project, cfg, capsys):
    assert pipeline.run(spark, cfg, start_from="visualise", force=True) == ["visualise", "stats"]
    with pytest.raises(ValueError):
        pipeline.run(spark, cfg, start_from="nothing")
    pipeline.main(["run-pipeline", "--status", "--data", cfg.data, "--results", cfg.results])
    assert '"completed"' in capsys.readouterr().out
    pipeline.main(["create-dev-subset", "--beta-matrix", cfg.beta_csv, "--clinical-metadata", cfg.path("clinical"), "--output", f"{project}/dev", "--n-cpgs", "9", "--n-samples", "6"])
    sub = spark.read.parquet(f"{project}/dev")
    assert sub.select("cpg_id").distinct().count() == 9 and sub.select("sample_id").distinct().count() == 6
    pipeline.main(["import-graph", "--data", cfg.data, "--results", cfg.results, "--output", f"{project}/graph"])
    assert spark.read.parquet(f"{project}/graph/v_gene").count() == 2
    pipeline.main(["validate-import", "--data", cfg.data, "--results", cfg.results, "--spot-check-gene", "HIGH"])
    assert "samples_match_clinical" in capsys.readouterr().out


def test_csv_reader(spark, cfg, tmp_path):
    cells = beta_csv.read_beta_csv(spark, cfg.beta_csv)
    assert cells.count() == 600 and cells.where("beta is null").count() == 5 + 25
    assert beta_csv.read_beta_csv(spark, cfg.beta_csv, ["chr2"]).select("chrom").distinct().count() == 1
    (tmp_path / "odd.csv").write_text(",chr1_1,chr1_2\na,oops,0.5\nb,0.25\n")
    counts, bad = beta_csv.convert(spark, str(tmp_path / "odd.csv"), str(tmp_path / "out"))
    assert counts == {"chr1": 2} and bad == 1
    assert [r.sample_id for r in beta_csv.sample_ids(spark, cfg.beta_csv).collect()][:2] == ["S00", "S01"]
    wide = spark.read.csv(cfg.beta_csv, header=True).withColumnRenamed("_c0", "sample_id")
    assert [len(c.columns) for c in beta_csv.column_chunks(wide, 20)] == [21, 12]
    assert beta_csv.row_chunks(wide, 8).groupBy("chunk").count().count() == 3
    assert matrix.long_matrix(wide).count() == 600


def test_promoters_and_islands(spark):
    genes = spark.createDataFrame([("A", "A", "chr1", 10000, 20000, "+", ""), ("B", "B", "chr1", 18000, 20000, "-", ""), ("C", "C", "chr2", 100, 900, "+", "")], "gene_id string, gene_symbol string, chrom string, start long, end long, strand string, biotype string")
    pts = spark.createDataFrame([("p", "chr1", 9000), ("q", "chr1", 21500), ("r", "chr1", 21501), ("s", "chr2", 1), ("t", "chr9", 5), ("u", "chr1", 19499)], "cpg_id string, chrom string, pos long")
    for width in (100, 16384):
        got = {(r.cpg_id, r.gene_id): r.overlap_type for r in intervals.gene_overlap(pts, genes, include_intergenic=True, width=width).collect()}
        assert got == {("p", "A"): "promoter", ("q", "B"): "promoter", ("r", ""): "intergenic", ("s", "C"): "promoter", ("t", ""): "intergenic", ("u", "A"): "gene_body", ("u", "B"): "gene_body"}
    isl = spark.createDataFrame([("chr1", 5000, 6000), ("chr1", 7500, 8500), ("chr1", 10000, 11000)], "chrom string, start long, end long")
    pts = spark.createDataFrame([(f"c{p}", "chr1", p) for p in (10501, 9501, 4001, 100001, 7801, 1001, 1000)], "cpg_id string, chrom string, pos long")
    got = {r.position: (r.context, r.island_id) for r in intervals.island_context(pts, isl).collect()}
    assert got[10501][0] == "island" and got[9501] == ("shore", "chr1:10000-11000") and got[100001] == ("open_sea", "") and got[7801] == ("island", "chr1:7500-8500")
    assert got[1001][0] == "shelf" and got[1000][0] == "open_sea"
    with pytest.raises(KeyError):
        intervals.find_overlapping(isl.drop("end"), "chr1", 1)


def test_ranking_scores(spark):
    e = spark.createDataFrame([("a", 5.0, 1e-5, 1e-6), ("b", float("inf"), 1e-9, 1e-9), ("c", 0.0, 0.5, 0.5), ("d", None, 1.0, 1.0), ("f", 2.0, 0.01, 0.01)], "pathway string, odds_ratio double, q_value double, p_value double")
    got = rank.rank_pathways(e).collect()
    assert [r.pathway for r in got][:2] == ["a", "f"] and got[0].score == pytest.approx(11.6096, abs=1e-3) and got[-1].score is None
    assert rank.report().columns == [c.split()[0] for c in rank.REPORT.split(", ")] and rank.report().count() == 0


def test_sampling_is_exact_and_stable(spark):
    header = spark.createDataFrame([(f"chr1_{i}", "chr1") for i in range(70)] + [(f"chr2_{i}", "chr2") for i in range(29)] + [("chrX_1", "chrX")], "cpg_id string, chrom string")
    a = sorted(r.cpg_id for r in sampling.select_sites(header, 10).collect())
    assert a == sorted(r.cpg_id for r in sampling.select_sites(header.repartition(3), 10).collect()) and len(a) == 10 and "chrX_1" in a
    assert sampling.select_samples(spark.createDataFrame([(f"s{i}",) for i in range(9)], "sample_id string"), 4).count() == 4


def test_config_and_paths(tmp_path, monkeypatch):
    monkeypatch.setenv("WHERE", "there")
    (tmp_path / "s.yaml").write_text("a: ${WHERE:-x}\nb: [\"${NOWHERE:-y}\"]\npaths: {data: d}\n")
    s = config.load(str(tmp_path / "s.yaml"))
    assert s["a"] == "there" and s["b"] == ["y"]
    assert str(config.Paths.from_settings(s, str(tmp_path)).data).endswith("/d")
    assert tables.resolve_path("s3://b/k.txt") == "s3a://b/k.txt" and tables.parse_s3("s3://b/k") == ("b", "k")
    with pytest.raises(ValueError):
        tables.resolve_path("s3://b/../../../etc/passwd", str(tmp_path / "cache"))
    with pytest.raises(ValueError):
        annotations.download("file:///etc/passwd", str(tmp_path / "x"))


def test_missing_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_parquet(spark, str(tmp_path / "none.parquet"))


def test_stream_into_store(spark, tmp_path):
    from betaloom import streaming

    cells = spark.createDataFrame([("s1", "chr1", 5, "chr1_5", 0.5), ("s2", "chr1", 5, "chr1_5", 0.7), ("s3", "chr1", 5, "chr1_5", None)], streaming.CELL)
    cells.write.parquet(str(tmp_path / "in"))
    streaming.append_to_store(streaming.read_cells(spark, str(tmp_path / "in")), str(tmp_path / "store"), str(tmp_path / "ck")).awaitTermination(60)
    row = streaming.moments(spark.read.parquet(str(tmp_path / "store"))).head()
    assert row.n_samples == 2 and row.n_total == 3 and row.mean_beta == pytest.approx(0.6) and row.variance == pytest.approx(0.02)


def test_small_readers_and_writers(spark, cfg, tmp_path):
    from pyspark.sql import functions as F

    from betaloom.functions import ids
    from betaloom.operators import clinical

    beta_csv.to_parquet(spark, cfg.beta_csv, str(tmp_path / "wide"))
    assert tables.parquet_shape(spark, str(tmp_path / "wide")) == (20, spark.read.parquet(str(tmp_path / "wide")).columns)
    sites = spark.createDataFrame([("chr1_5",), ("chr2_7",)], "cpg_id string")
    tables.write_ids(sites, str(tmp_path / "ids"))
    assert sorted(r.cpg_id for r in tables.read_ids(spark, str(tmp_path / "ids")).collect()) == ["chr1_5", "chr2_7"]
    tables.write_csv(sites, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    assert tables.sheet_names(cfg.clinical_xlsx, "CLIN_*") == ["CLIN_CRC", "CLIN_Control"]
    (tmp_path / "gone.txt").write_text("# out\n s01 \n\nS02\n")
    assert sorted(r.barcode for r in clinical.read_exclusions(spark, str(tmp_path / "gone.txt")).collect()) == ["S01", "S02"]
    assert clinical.resolve_column([" BARCODE ", "x"], clinical.BARCODE_ALIASES) == " BARCODE " and clinical.resolve_column(["x"], clinical.BARCODE_ALIASES) is None
    got = spark.createDataFrame([('a"b\\c\nd\te\r',)], "t string").select(ids.quoted("t")).head()[0]
    assert got == 'a\\"b\\\\c\\nd\\te\\r'
    with pytest.raises(Exception, match="not a site"):
        spark.createDataFrame([("chr99", 1)], "c string, p long").select(ids.make_site_id("c", "p")).collect()
    assert ids.file_label(0.95) == "0_95"
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "v double").agg(F.avg(ids.present("v"))).head()[0]
    assert nan == 1.0


def test_missing_inputs_of_steps(spark, tmp_path):
    empty = pipeline.Config(data=str(tmp_path / "d"), results=str(tmp_path / "r"), beta_csv="none.csv", clinical_xlsx="none.xlsx")
    with pytest.raises(Exception):
        pipeline.run(spark, empty, ["coverage"])
    assert pipeline.State(empty.path("state"), "production").value["steps"]["coverage"]["status"] == "failed"
    assert pipeline.run(spark, empty, ["annotations"]) == ["annotations"]


def test_events_carry_their_fields():
    import io
    import json
    import logging

    from betaloom.logs import Formatter, get_logger

    for as_json in (True, False):
        out = io.StringIO()
        handler = logging.StreamHandler(out)
        handler.setFormatter(Formatter(as_json))
        log = get_logger("betaloom.test")
        log.logger.addHandler(handler)
        log.logger.setLevel("INFO")
        log.bind(step="a").info("done", rows=3)
        try:
            1 / 0
        except ZeroDivisionError:
            log.exception("failed", step="b")
        log.logger.removeHandler(handler)
        first, rest = out.getvalue().split("\n", 1)
        if as_json:
            got = json.loads(first)
            assert (got["event"], got["level"], got["step"], got["rows"]) == ("done", "info", "a", 3) and "ZeroDivisionError" in json.loads(rest)["exception"]
        else:
            assert first.endswith("betaloom.test done step=a rows=3")
