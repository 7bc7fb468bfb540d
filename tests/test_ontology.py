import random

from betaloom.operators import ontology
from betaloom.plans.queries import QUERIES
from betaloom.sources import annotations


def above(edges, start):
    """Ancestors of a term with the fewest steps, by breadth."""
    found, level, n = {}, {start}, 0
    while level:
        n += 1
        level = {p for c, p in edges if c in level} - set(found)
        found |= dict.fromkeys(level, n)
    return found


def test_closure_equals_breadth_first_search(spark):
    rng = random.Random(5)
    for cyclic in (False, True):
        edges = {(f"t{a}", f"t{b}") for a in range(1, 40) for b in rng.sample(range(a), min(a, 2))}
        edges |= {("chain0", "t3")} | {(f"chain{k + 1}", f"chain{k}") for k in range(25)}
        if cyclic:
            edges |= {("t0", "t9"), ("self", "self")}
        rows = [*edges, *list(edges)[:9], (None, "t1"), ("t1", None)]
        closed = ontology.closure(spark.createDataFrame(rows, "child string, parent string"))
        got = {(r.term, r.ancestor): r.distance for r in closed.collect()}
        assert got == {(t, a): d for t in {c for c, _ in edges} for a, d in above(edges, t).items()}
        loops = {r.term: r.distance for r in ontology.cycles(closed).collect()}
        assert bool(loops) == cyclic and loops == {t: d for (t, a), d in got.items() if t == a}


def test_members_of_descendants_count(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "a")], "child string, parent string")
    notes = spark.createDataFrame([("g1", "c"), ("g1", "c"), ("g1", "b"), ("g2", "d"), ("g3", "elsewhere")], "gene string, term string")
    got = {r.term: (r.n_direct, r.n_members) for r in ontology.term_sizes(notes, ontology.closure(edges)).collect()}
    assert got == {"a": (0, 2), "b": (1, 1), "c": (1, 1), "d": (1, 1), "elsewhere": (1, 1)}
    empty = edges.where("false")
    assert ontology.closure(empty).count() == 0
    assert ontology.with_ancestors(notes, ontology.closure(empty)).count() == 4


def test_obo_file(spark, tmp_path):
    (tmp_path / "go.obo").write_text(
        "format-version: 1.2\n\n[Term]\nid: GO:1\nname: root ! not a comment? yes\n\n[Term]\nid: GO:2\nname: kid\nnamespace: cellular_component\nis_a: GO:1 ! root\nrelationship: part_of GO:3 ! x\nrelationship: regulates GO:1\nsynonym: \"is_a: GO:9\" EXACT []\n\n"
        "[Term]\nid: GO:3\nis_obsolete: true\n\n[Term]\nname: no id\n\n[Typedef]\nid: part_of\n"
    )
    stanzas = annotations.obo_stanzas(spark, str(tmp_path / "go.obo"))
    terms = {r.term_id: r for r in annotations.obo_terms(stanzas).collect()}
    assert set(terms) == {"GO:1", "GO:2"} and terms["GO:2"].namespace == "cellular_component" and terms["GO:1"].name == "root"
    assert {r.term_id for r in annotations.obo_terms(stanzas, keep_obsolete=True).collect()} == {"GO:1", "GO:2", "GO:3"}
    edges = annotations.obo_edges(annotations.obo_terms(stanzas)).collect()
    assert sorted((r.child, r.parent, r.relation) for r in edges) == [("GO:2", "GO:1", "is_a"), ("GO:2", "GO:3", "part_of")]
    assert annotations.obo_edges(annotations.obo_terms(stanzas), ("regulates",)).count() == 1


def test_closure_joins_no_known_distance_again(spark, monkeypatch):
    """A chain of 31 steps takes five rounds after its edges; none only confirms that nothing changed."""
    written = []
    monkeypatch.setattr(ontology, "materialize", lambda df, tag, keep=ontology.materialize: written.append(tag) or keep(df, tag))
    edges = spark.range(31).selectExpr("concat('t', id + 1) child", "concat('t', id) parent")
    assert ontology.closure(edges).count() == 31 * 32 // 2
    assert len(written) == 6


def test_member_counts_equal_those_of_the_closure(spark, monkeypatch):
    """On hierarchies and on cycles, with more members than a word has bits; the query needs no closure."""
    rng = random.Random(8)
    for cyclic in (False, True):
        edges = {(f"t{a}", f"t{b}") for a in range(1, 30) for b in rng.sample(range(a), min(a, 2))} | {(f"c{k + 1}", f"c{k}") for k in range(20)} | {("c0", "t4")}
        if cyclic:
            edges |= {("t0", "t7"), ("self", "self")}
        names = sorted({t for e in edges for t in e}) + ["elsewhere"]
        notes = [(f"g{rng.randrange(150)}", rng.choice(names)) for _ in range(300)]
        notes = spark.createDataFrame(notes + notes[:9], "gene string, term string")
        edges = spark.createDataFrame([*edges, (None, "t1"), ("t1", None)], "child string, parent string")
        want = {r.term: (r.n_direct, r.n_members) for r in ontology.term_sizes(notes, ontology.closure(edges)).collect()}
        assert {r.term: (r.n_direct, r.n_members) for r in ontology.member_counts(notes, edges).collect()} == want
    blank = spark.createDataFrame([(None, "t1"), ("g1", "t2")], "gene string, term string")
    got = {r.term: (r.n_direct, r.n_members) for r in ontology.member_counts(blank, edges.where("child in ('t1', 't2')")).collect()}
    assert got["t1"][0] == 0 and got["t2"][0] == 1 and got["t0"] == (0, 1)
    monkeypatch.setattr(ontology, "closure", None)
    assert QUERIES["go_term_sizes"](spark, "/root/testdata/sf0.001").count() > 0
