import random
from collections import defaultdict

import pytest

from betaloom.llm import queries
from betaloom.llm.repair import damage_turns, repair_conversations

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def brute(turns):
    """A conversation's row by all edits in breadth, states kept by what was written."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    seen, faults = set(), []
    for _, role, text in turns:
        body = text.strip(WHITE)
        faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
        cut = 0 if body and body[-1] in ".!?" else 1
        faults[-1] = (faults[-1], cut)
        seen.add((role, text))

    def follows(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def inserts(ways):
        for _ in range(3):
            for state, (cost, audit, out) in list(ways.items()):
                for role in ("user", "assistant"):
                    to = follows(state, role[0])
                    if to and (to not in ways or (cost + 2, audit + "I") < ways[to][:2]):
                        ways[to] = (cost + 2, audit + "I", [*out, (role, "")])
        return ways

    ways = inserts({"": (0, "", [])})
    for (_, role, text), (fault, cut) in zip(turns, faults):
        new = {}

        def put(state, way):
            if state is not None and (state not in new or way[:2] < new[state][:2]):
                new[state] = way

        for state, (cost, audit, out) in ways.items():
            put(state, (cost + 3, audit + "D", out))
            if fault not in (1, 2):
                put(follows(state, role[:1]), (cost + cut, audit + "K", [*out, (role, text)]))
                for other in ("user", "assistant"):
                    put(follows(state, other[0]), (cost + 2 + cut, audit + "R", [*out, (other, text)]))
        ways = inserts(new)
    cost, audit, out = min(ways[s] for s in ("", "a") if s in ways)
    numbers = [t[0] for t in turns if t[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    return (gaps, *(sum(f == k for f, _ in faults) for k in (1, 2, 3)), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, out)


def conversations(seed, n, most):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for k in range(rng.randint(1, most)):
            turn = None if rng.random() < 0.05 else rng.randrange(most) if rng.random() < 0.3 else k
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "unit"])
            text = rng.choice(["", " \n", "Yes.", "No!", "what?", "a cut", "x. \t", f"{rng.random()}.", f"{rng.random()}", "é", "\x1f"])
            rows.append((None if c == 0 else c, turn, role, text))
    return rows


@pytest.mark.parametrize("block,most", [(256, 9), (1, 6), (2, 14), (4, 40)])
def test_repair_equals_brute_force(spark, block, most):
    rows = conversations(block, 40, most)
    by = defaultdict(list)
    for c, *t in rows:
        by[c].append(t)
    got = repair_conversations(spark.createDataFrame(rows, SCHEMA).repartition(3), block=block).collect()
    assert len(got) == len(by)
    for r in got:
        mine = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, [(t.role, t.text) for t in r.repaired])
        assert mine == brute(by[r.conv_id]), r.conv_id


def test_one_conversation_of_a_third_of_all_rows(spark):
    rng = random.Random(3)
    hot = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["same.", "cut", f"{t}.", ""])) for t in range(1500)]
    rows = hot + [(100 + k // 3, k % 3, ["system", "user", "assistant"][k % 3], f"text {k}.") for k in range(3000)]
    got = {r.conv_id: r for r in repair_conversations(spark.createDataFrame(rows, SCHEMA), block=64).collect()}
    assert len(got) == 1001
    r = got[7]
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, [(t.role, t.text) for t in r.repaired]) == brute([t[1:] for t in hot])
    assert all((got[c].cost, got[c].audit) == (0, "KKK") for c in got if c != 7)


def test_nulls_empty_tables_clashing_names_and_long_texts(spark):
    rows = [(1, None, None, None, "a"), (1, 2, "user", "x" * 3_000_000 + ".", "b"), (2, None, "user", "Hi.", "c"), (2, None, "user", "Hi.", "c")]
    df = spark.createDataFrame(rows, SCHEMA + ", conv string")
    got = {r.conv_id: r for r in repair_conversations(df).collect()}
    assert (got[1].blank, got[1].audit, got[1].cost, got[1].gaps) == (1, "DKI", 5, 0) and len(got[1].repaired[0].text) == 3_000_001
    assert (got[2].duplicate, got[2].audit, got[2].cost, got[2].gaps) == (1, "KDI", 5, 0)
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_conversations(empty).count() == 0 and damage_turns(empty).count() == 0


def test_damage_follows_the_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", f"a.b!c? {c}") for c in range(30) for t in range(4)] + [(None, None, None, None)]
    got = damage_turns(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for c, t, role, text in rows:
        role, text = role or " ", text or " "
        f = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if f:
            text = "" if f == 1 else text.translate(str.maketrans("", "", ".!?")) if f == 2 else text
            want += [(c, t, "user" if f == 4 else role, text)] * (2 if f == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_query_equals_its_sql(same):
    same(queries.op12_conversation_repair, queries.OP12_SQL)
