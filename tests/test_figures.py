import io
import math
import random
import struct
import zipfile
import zlib
from xml.etree import ElementTree

import numpy as np
import pytest

from betaloom.operators import density, report
from betaloom.plans import docx, figures
from betaloom.sources import tables, wide

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def results(spark, n):
    return spark.range(n).selectExpr("concat('f', cast(id as string)) feature", "((id * 7919) % 1009 + 1) / 1010.0D / (1 + id % 50 * id % 50) p_value", "(id % 201 - 100) / 120.0D delta_mean", "((id * 7919) % 1009 + 1) / 1010.0D q_value")


def test_density_integrates_to_one_and_peaks_where_values_are(spark):
    rng = random.Random(4)
    rows = [("a", rng.gauss(10, 2)) for _ in range(4000)] + [("b", 5.0)] * 3 + [(None, 1.0), ("a", None), ("c", float("nan")), ("one", 7.0)]
    got = {}
    for r in density.violin_density(spark.createDataFrame(rows, "g string, v double"), value_col="v", group_col="g").collect():
        got.setdefault(r.group, []).append(r)
    assert set(got) == {"a", "b", "one"} and len(got["a"]) == 64
    a = sorted(got["a"], key=lambda r: r.at)
    area = sum((p.density + q.density) / 2 * (q.x - p.x) for p, q in zip(a, a[1:]))
    assert area == pytest.approx(1, abs=0.02) and max(a, key=lambda r: r.density).x == pytest.approx(10, abs=1)
    values = sorted(v for g, v in rows if g == "a" and v is not None)
    assert a[0].median == pytest.approx(np.quantile(values, 0.5)) and a[0].q3 == pytest.approx(np.quantile(values, 0.75))
    at = a[30]
    exact = sum(math.exp(-(((at.x - v) / at.bandwidth) ** 2) / 2) for v in values) / (len(values) * at.bandwidth * math.sqrt(2 * math.pi))
    assert at.density == pytest.approx(exact, rel=0.01)
    assert [(r.x, r.density, r.bandwidth, r.n) for r in got["b"]] == [(5.0, None, None, 3)]


def test_the_size_of_a_figure_does_not_follow_the_number_of_points(spark):
    sizes = []
    for n in (2_000, 50_000):
        points = report.volcano_points(results(spark, n)).cache()
        svg = figures.volcano(points, report.volcano_labels(points), nx=30, ny=20)
        ElementTree.fromstring(svg)
        assert svg.count("<rect") <= 1 + 3 * 600 and ">f" in svg
        sizes.append(len(svg))
    assert sizes[1] < sizes[0] * 3


def test_figures_are_drawn_from_tables_and_from_empty_ones(spark):
    scores = spark.createDataFrame([(g, float(k % 7)) for g in ("CRC", "Control & <co>") for k in range(30)], "clinical_category string, hms_count double")
    best = spark.createDataFrame([("p1", "Name <1>", 3.0, 5, 2.0), ("p2", "x", 1.0, 2, float("inf")), ("p3", "y", None, 0, None)], "pathway string, display_name string, neg_log10_q double, n_overlap long, odds_ratio double")
    cells = spark.createDataFrame([("CRC" if s < 30 else "Control", f"s{s:03}", f"g{g}", float((s + g) % 5 - 2)) for s in range(100) for g in range(4)], "clinical_category string, sample_id string, gene string, z double")
    bins = density.heatmap_bins(cells, 10)
    got = {(r.column, r.group): r.n_samples for r in bins.collect()}
    assert got == {(k, "CRC"): 10 for k in range(3)} | {(3 + k, "Control"): 10 for k in range(7)}
    dense = density.violin_density(scores)
    for svg in (figures.violins(dense), figures.dots(best), figures.heat(bins), figures.violins(dense.where("false")), figures.dots(best.where("false")), figures.heat(bins.where("false"))):
        ElementTree.fromstring(svg)
    empty = report.volcano_points(results(spark, 0))
    ElementTree.fromstring(figures.volcano(empty, report.volcano_labels(empty)))
    assert figures.ticks(0, 10) == [0, 2, 4, 6, 8, 10] and figures.ticks(-0.13, 0.27) == [-0.1, 0.0, 0.1, 0.2] and figures.ticks(3, 3) == [3]


def pixels(data):
    w, h = struct.unpack(">II", data[16:24])
    at, raw = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(kind + body)
        raw += body if kind == b"IDAT" else b""
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(raw), np.uint8).reshape(h, 1 + 3 * w)
    assert not rows[:, 0].any()
    return rows[:, 1:].reshape(h, w, 3)


def test_png_holds_its_pixels(spark):
    image = np.arange(5 * 7 * 3).reshape(5, 7, 3)
    assert (pixels(figures.png(image)) == image).all()
    assert pixels(figures.volcano_png(report.volcano_points(results(spark, 500)), nx=20, ny=10, scale=2)).shape == (20, 40, 3)


def test_document_opens_with_sections_tables_and_images(spark, tmp_path):
    table = spark.createDataFrame([("a & <b>", 0.123456, None), ("c\x00", 2.0, 7)], "name string, x double, k long")
    long = spark.range(60).coalesce(1)
    data = docx.build("Report", [("First", table), ("Long", long), ("Picture", figures.png(np.zeros((4, 6, 3)))), ("Empty", table.where("false"))])
    tables.write_bytes(spark, str(tmp_path / "deep" / "r.docx"), data)
    with zipfile.ZipFile(io.BytesIO((tmp_path / "deep" / "r.docx").read_bytes())) as z:
        assert z.testzip() is None
        parts = {n: z.read(n) for n in z.namelist()}
    trees = {n: ElementTree.fromstring(b) for n, b in parts.items() if n.endswith((".xml", ".rels"))}
    body = trees["word/document.xml"]
    style = lambda p: next((s.get(f"{W}val") for s in p.iter(f"{W}pStyle")), None)
    heads = [("".join(t.text for t in p.iter(f"{W}t")), style(p)) for p in body.iter(f"{W}p") if style(p)]
    assert heads == [("Report", "Title"), *((n, "Heading1") for n in ("First", "Long", "Picture", "Empty"))]
    shown = [[["".join(t.text or "" for t in c.iter(f"{W}t")) for c in r.iter(f"{W}tc")] for r in t.iter(f"{W}tr")] for t in body.iter(f"{W}tbl")]
    assert shown[0] == [["name", "x", "k"], ["a & <b>", "0.1235", ""], ["c", "2", "7"]] and len(shown[1]) == 51 and shown[2] == [["name", "x", "k"]]
    assert "The first 50 rows; the table has more." in "".join(t.text or "" for t in body.iter(f"{W}t"))
    targets = {r.get("Target") for r in trees["word/_rels/document.xml.rels"]}
    assert targets == {"styles.xml", "media/image1.png"} and pixels(parts["word/media/image1.png"]).shape == (4, 6, 3)


def test_wide_files_are_stitched_by_sample(spark, tmp_path):
    rows = [(f"S{k}", k / 10, None if k == 2 else k / 20, "x") for k in (3, 1, 2, 0)]
    spark.createDataFrame(rows, "sample_id string, chr1_5 double, chr1_9 double, note string").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(s, x) for s, x, _, _ in rows], "sample_id string, chr2_7 double").coalesce(1).write.parquet(str(tmp_path / "b"))
    frames = wide.read_wide(spark, {"chr1": str(tmp_path / "a"), "chr2": str(tmp_path / "b")})
    got = sorted((r.sample_id, r.sample_ord, r.cpg_id, r.beta) for r in wide.stitch(frames).collect())
    assert [g[:3] for g in got] == sorted((f"S{k}", i + 1, c) for i, k in enumerate((3, 1, 2, 0)) for c in ("chr1_5", "chr1_9", "chr2_7"))
    assert next(g[3] for g in got if g[0] == "S2" and g[2] == "chr1_9") is None
    assert wide.stitch(frames, sites=["chr2_7"]).count() == 4
    with pytest.raises(KeyError, match="chr9_1"):
        wide.stitch(frames, sites=["chr2_7", "chr9_1"])
    lacking = frames | {"chr2": frames["chr2"].where("sample_id <> 'S1'")}
    assert {r.chrom: (r.n_samples, r.n_missing, r.n_extra, r.n_moved) for r in wide.order_report(lacking).collect()} == {"chr1": (4, 0, 0, 0), "chr2": (3, 1, 0, 2)}
    with pytest.raises(ValueError, match="chr2"):
        wide.stitch(lacking)
    assert {r.sample_id for r in wide.stitch(lacking, strict=False).collect()} == {"S0", "S2", "S3"}
