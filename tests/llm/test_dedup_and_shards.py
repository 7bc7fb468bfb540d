import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from betaloom.llm import queries
from betaloom.llm.components import connected_components
from betaloom.llm.exact_dedup import exact_dedup, grow_directory
from betaloom.llm.sharding import shard_by_bytes, write_shards

SF = "/root/testdata/sf0.001"


def frame(spark, rows, extra=True):
    """doc_id, text and columns whose names clash with those the operators use."""
    schema = "doc_id long, text string" + (", entry string, shard string, seq string, kept string, n string, row string, t string" if extra else "")
    return spark.createDataFrame([(*r, *(["x"] * 7 if extra else [])) for r in rows], schema)


ODD = [(5, "a b"), (3, "a \t\n b"), (9, None), (8, ""), (7, "x" * 200_000), (2, "x" * 200_000), (None, "a  b"), (4, "é b"), (6, "é b"), (6, "a b"), (1, " a b"), (11, "a\x0b\x0c\rb"), (12, "a b"), (None, "only null ids")]


def brute_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        for i in ids:
            out.append((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("options", [{}, {"key_bits": 3}, {"key_bits": 1, "capacity_rows": 1, "max_depth": 4}, {"flush_bytes": 10, "capacity_bytes": 300}])
def test_exact_dedup_odd_rows(spark, options):
    got = exact_dedup(frame(spark, ODD).repartition(3), **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_dedup(ODD)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_hot_group_and_repeated_rows(spark):
    rows = [(i, "same words" if i % 3 == 0 else f"text {i}") for i in range(600)] + [(0, "same words")] * 3
    got = exact_dedup(frame(spark, rows).repartition(7), flush_bytes=2_000).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == brute_dedup(rows)
    assert sum(r.kept for r in got) == 401


def test_exact_dedup_empty(spark):
    assert exact_dedup(frame(spark, [])).collect() == []


def test_directory_doubles_until_buckets_fit():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, 256)
    counts[17] = 500
    depth, directory, buckets = grow_directory(counts, counts * 10, 10**9, 40)
    assert depth == 8 and len(directory) == 256
    assert [b[0] for b in buckets[1:]] == [b[1] for b in buckets[:-1]] and buckets[0][0] == 0 and buckets[-1][1] == 256
    for lo, hi in buckets:
        assert counts[lo:hi].sum() <= 40 or hi - lo == 1
    for p in range(256):
        lo, hi = buckets[directory[p]]
        assert lo <= p < hi
    assert grow_directory(np.zeros(16, int), np.zeros(16, int), 10, 10)[0] == 0


def test_shards_odd_rows(spark):
    rows = ODD + [(5, "a b")] * 2
    for n in (1, 3, 16, 40):
        got = shard_by_bytes(frame(spark, rows).repartition(3), n).collect()
        assert len(got) == len(rows)
        for r in got:
            assert 0 <= r.shard < n
        for s in range(n):
            assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
        want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
        assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"], r.text_crc32) for r in got) == want
        order = sorted(got, key=lambda r: (r.shard, r.slot))
        assert [(r.doc_id is not None, r.doc_id or 0) for r in order] == sorted((r.doc_id is not None, r.doc_id or 0) for r in got)
    assert shard_by_bytes(frame(spark, [])).collect() == []


def test_shards_are_balanced_and_written(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, "w" * rng.randrange(1, 400)) for i in range(3000)]
    got = shard_by_bytes(frame(spark, rows), 8).collect()
    totals = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(totals) - min(totals) <= 2 * 401
    before = 0
    total = sum(len(t) + 1 for _, t in rows)
    want = {}
    for i, t in rows:
        want[i] = (2 * before + len(t) + 1) * 8 // (2 * total)
        before += len(t) + 1
    assert {r.doc_id: r.shard for r in got} == want
    write_shards(frame(spark, rows, extra=False), str(tmp_path / "out"), 8)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r.doc_id: r.shard for r in back} == want and len(back) == 3000


def test_shard_query_covers_the_table(spark):
    got = queries.op8_sharding(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = got.collect()
    assert len(rows) == len(docs) and all(zlib.crc32(docs[r.doc_id].encode()) == r.text_crc32 and r.law == "bytes" for r in rows)


def test_dedup_query_equals_sql(same):
    same(queries.QUERIES["op7_exact_dedup"], queries.ORACLES["op7_exact_dedup"])


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)] + [(400 + i, 401 + i) for i in range(60)] + [(500, i) for i in range(501, 560)] + [(7, 7), (8, 8)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_shard_query_equals_sql(same):
    same(queries.QUERIES["op8_sharding"], queries.ORACLES["op8_sharding"])


def test_a_hot_text_moves_once_a_salt_and_ids_flush(spark, monkeypatch):
    import pyarrow as pa

    from betaloom.llm import exact_dedup as ed

    batches = [pa.RecordBatch.from_arrays([pa.array(range(lo, lo + 10_000)), pa.array([""] * 10_000)], names=["doc_id", "text"]) for lo in range(0, 1_000_000, 10_000)]
    monkeypatch.setattr(ed.TaskContext, "get", staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)})))
    sizes = [n for b in ed._fold(64, 4 << 20)(batches) for n in b.column("n").to_pylist()]
    assert sum(sizes) == 1_000_000 and len(sizes) > 3
    monkeypatch.undo()
    # one text in every task: its entries meet by salt, and the owner gets one of each salt
    moved = []
    was = ed.run_groups

    def seen(rows, key, n, work, schema):
        out = was(rows, key, n, work, schema)
        moved.append(out)
        return out

    monkeypatch.setattr(ed, "run_groups", seen)
    rows = [(i, "one hot text " * 50 if i % 2 else f"text {i}") for i in range(3_000)]
    got = exact_dedup(frame(spark, rows).repartition(40), fold_over=8, flush_bytes=20_000)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got.collect()), key=str) == brute_dedup(rows)
    folded = moved[0].collect()
    assert len(folded) > 30 and 0 < sum(r.text is not None for r in folded) <= len(folded) ** 0.5 + 1


@pytest.mark.parametrize("options", [{}, {"key_bits": 2, "capacity_rows": 1, "max_depth": 3}, {"broadcast_keys": 0, "fold_over": 1}])
def test_other_tables_are_looked_up_in_the_index(spark, tmp_path, options):
    from betaloom.llm.exact_dedup import lookup

    path = str(tmp_path / "index")
    first = exact_dedup(frame(spark, ODD).repartition(3), index_path=path, **options).collect()
    keep = {r.text_sha256: r.keep_id for r in first}
    later = [(100, "a  b"), (101, None), (102, "new"), (103, "x" * 200_000), (103, "x" * 200_000), (None, "é b"), (104, "only null ids")]
    got = lookup(frame(spark, later), path).collect()
    assert len(got) == len(later)
    for r in got:
        assert r.known == (r.text_sha256 in keep) and r.keep_id == keep.get(r.text_sha256)
    assert {r.doc_id for r in got if not r.known} == {102}
    assert lookup(frame(spark, []), path).collect() == []


def test_tables_go_at_the_end_of_a_block(spark):
    from betaloom.llm.store import _target, materialize, temporary

    with temporary(spark) as keep:
        a = materialize(spark.range(3), "gone")
        b = keep(a.selectExpr("id + 1 as id"), "kept")
    there = lambda df: _target(spark, df._betaloom_path)[1].exists(_target(spark, df._betaloom_path)[0])
    assert not there(a) and there(b) and b.count() == 3
