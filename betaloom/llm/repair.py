"""Repair of conversation structure by the cheapest edits, as a fold of native higher-order functions.

A conversation should read as an optional system turn and then pairs of user and assistant turns. Four states describe
what has been written so far: nothing (0), a system turn (1), a user turn that waits for its answer (2), a whole pair
(3). The fold carries for each state the cheapest (cost, audit) that leads to it, as four structs compared by least():
of equal costs the ASCII-least audit wins. That is exact step by step: of two cheapest audits for one state neither can
begin the other, as what follows the shorter would be inserts alone, which cost.

Faults of a turn are found by windows, turns are collected in order, and aggregate() folds them. A block of at most
`block` turns is folded in one value. Turns are range-partitioned by (conversation, turn), and a block is a cut of a
partition, so a conversation that holds a third of all rows spreads over tasks and blocks. Where a conversation has
several blocks, each is folded from all four states; a second fold over the blocks' results chooses the path, and the
blocks write their repaired turns side by side. Turns met before in an earlier block come from one aggregated minimum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, shuffle_partitions

WHITE = " \t\n\x0b\x0c\r"  # fixed values: white space
FAR = 1 << 40  # the cost of what cannot be
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2  # costs of edits
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3

_KEY = ["conv", "blk"]
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "turns_met"]
_PATH = "struct<cost:bigint,audit:string>"


def damage_turns(turns: DataFrame) -> DataFrame:
    """turns (conv_id, turn, role, text) with faults put in by crc32("conv_id:turn") % 20: 0 drops a row, 1 empties its
    text, 2 takes its [.!?] away, 3 repeats it, 4 makes it the user's. Nulls of role, text and in the crc32 are one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat(shown[0], F.lit(":"), shown[1])) % 20
    rows = turns.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def _path(cost: Column, audit: Column) -> Column:
    return F.struct(cost.cast("long").alias("cost"), audit.alias("audit"))


def _edit(path: Column, cost: Column | int, letter: Column | str) -> Column:
    return _path(path["cost"] + cost, F.concat(path["audit"], F.lit(letter) if isinstance(letter, str) else letter))


def _states(*paths: Column) -> Column:
    """Four states, with all inserts that help."""
    s0, s1, s2, s3 = paths
    two = F.least(s2, _edit(F.least(s0, s1, s3), INSERT, "I"))
    return F.struct(s0.alias("s0"), s1.alias("s1"), two.alias("s2"), F.least(s3, _edit(two, INSERT, "I")).alias("s3"))


def _step(acc: Column, t: Column) -> Column:
    """One turn more: deleted, kept or given the role that the state asks for."""
    s0, s1, s2, s3 = (acc[f"s{k}"] for k in range(4))
    gone = [_edit(s, DELETE, "D") for s in (s0, s1, s2, s3)]
    return _states(
        gone[0],
        F.least(gone[1], _edit(s0, t["s_cost"], "K")),
        F.least(gone[2], _edit(F.least(s0, s1, s3), t["u_cost"], t["u_edit"])),
        F.least(gone[3], _edit(s2, t["a_cost"], t["a_edit"])),
    )


def fold_from(turns: Column, start: Column) -> Column:
    """The four states after an array of turns, begun in state `start` (0 to 3)."""
    far = [_path(F.when(start == k, 0).otherwise(FAR), F.lit("")) for k in range(4)]
    kind = f"struct<s0:{_PATH},s1:{_PATH},s2:{_PATH},s3:{_PATH}>"
    return F.aggregate(turns, _states(*far).cast(kind), lambda acc, t: _step(acc, t).cast(kind))


def rewritten(turns: Column, audit: Column, start: Column) -> Column:
    """The turns, as an array of (role, text), that an audit makes of an array of turns, begun in state `start`."""
    kind = "struct<i:int,q:int,out:array<struct<role:string,text:string>>>"
    begin = F.struct(F.lit(0).alias("i"), start.cast("int").alias("q"), F.array().alias("out")).cast(kind)

    def one(acc: Column, j: Column) -> Column:
        c, q = F.substr(audit, j, F.lit(1)), acc["q"]
        t = F.get(turns, acc["i"])
        role = F.when(c == "K", t["role"]).when(q == 2, "assistant").otherwise("user")
        text = F.when(c == "I", "").otherwise(t["text"])
        then = F.when(c == "D", q).when(q == 2, 3).when((c == "K") & (t["initial"] == "s"), 1).otherwise(2)
        out = F.when(c == "D", acc["out"]).otherwise(F.concat(acc["out"], F.array(F.struct(role.alias("role"), text.alias("text")))))
        return F.struct((acc["i"] + F.when(c == "I", 0).otherwise(1)).alias("i"), then.alias("q"), out.alias("out")).cast(kind)

    places = F.when(F.length(audit) > 0, F.sequence(F.lit(1), F.length(audit))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, begin, one)["out"]


def _blocks(rows: DataFrame, later: DataFrame | None) -> DataFrame:
    """A row per block: its turns in order, with what each edit of them costs, and its counts.

    later: for blocks with turns that an earlier block has already, the ord of these."""
    local = Window.partitionBy(*_KEY).orderBy("ord")
    initial, before = F.substring("role", 1, 1), F.lag(F.substring("role", 1, 1)).over(local)
    seen = F.row_number().over(Window.partitionBy(*_KEY, "role", "text").orderBy("ord")) > 1
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    met = F.col("turn").isNotNull() & F.coalesce(F.lag("turn").over(local) != F.col("turn"), F.lit(True))
    marked = rows.select(
        *_KEY, "conv_id", "ord", "turn", "role", "text", initial.alias("initial"), seen.alias("seen"),
        (F.trim(F.col("text"), F.lit(WHITE)) == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
        F.coalesce(~F.concat(before, initial).isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        met.alias("met"),
    )
    ordered = F.array_sort(F.collect_list(F.struct("ord", "role", "text", "initial", "seen", "blank", "cut")))
    blocks = marked.groupBy(*_KEY).agg(
        F.first("conv_id").alias("conv_id"), ordered.alias("turns"), F.count_if("illegal").alias("illegal"), F.count_if("met").alias("turns_met"),
        F.min("turn").alias("turn_min"), F.max("turn").alias("turn_max"),
        F.min_by("turn", "ord").alias("turn_first"), F.max_by("turn", "ord").alias("turn_last"), F.min_by("initial", "ord").alias("head"), F.max_by("initial", "ord").alias("tail"),
    )
    blocks = blocks.join(later, _KEY, "left") if later is not None else blocks.withColumn("later", F.lit(None).cast("array<bigint>"))

    def priced(t: Column) -> Column:
        dup = t["seen"] | F.coalesce(F.array_contains("later", t["ord"]), F.lit(False))
        fault = F.when(t["blank"], BLANK).when(dup, DUPLICATE).when(t["cut"], TRUNCATED).otherwise(0)
        must, extra = t["blank"] | dup, F.when(t["cut"], 1).otherwise(0)

        def as_(initial: str) -> Column:
            return F.when(must, FAR).when(t["initial"] == initial, extra + KEEP).otherwise(extra + REROLE if initial != "s" else FAR).cast("long")

        letters = {i: F.when(t["initial"] == i, "K").otherwise("R") for i in "ua"}
        return F.struct(t["role"].alias("role"), t["text"].alias("text"), t["initial"].alias("initial"), fault.alias("fault"), as_("s").alias("s_cost"), as_("u").alias("u_cost"), letters["u"].alias("u_edit"), as_("a").alias("a_cost"), letters["a"].alias("a_edit"))

    blocks = blocks.withColumn("turns", F.transform("turns", priced))

    def count(fault: int, name: str) -> Column:
        return F.size(F.filter("turns", lambda t: t["fault"] == fault)).cast("long").alias(name)

    return blocks.select("*", count(BLANK, "blank"), count(DUPLICATE, "duplicate"), count(TRUNCATED, "truncated"))


def _gaps(low: str, high: str, met: str) -> Column:
    return F.coalesce(F.col(high) - F.col(low) + 1 - F.col(met), F.lit(0)).cast("long").alias("gaps")


def repair_conversations(turns: DataFrame, *, block: int = 256) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired.

    turns: conv_id, turn, role, text. Null role or text counts as empty, a null conv_id is a conversation, null turns
    come first, rows of equal turn are ordered by role and text, repeated rows are turns of their own. gaps is how many
    turn numbers between the least and the largest are missing. A turn's first fault counts: blank (white space alone),
    duplicate (role and text stood earlier), truncated (its last character that is no white space is none of .!?).
    illegal counts neighbours whose role initials are not su, ua or au. audit has a letter for each edit in order: Keep
    (no cost), Rerole to user or assistant (2), Delete (3; blank and duplicate turns must go), Insert of an empty user
    or assistant turn (2); truncated turns that stay cost 1. It is the cheapest, of equal ones the ASCII-least, after
    which the role initials read as an optional s and pairs ua. repaired is an array of (role, text).

    Other columns are ignored; an empty table gives no rows. The audit and the repaired turns of a conversation are one
    value each, so these (2 GB at most) bound a conversation; all else is done by blocks.
    """
    spark = turns.sparkSession
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv"), "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    order = ["conv", "turn", "role", "text", "uid"]  # the last spreads repeated rows
    rows = rows.withColumn("uid", F.monotonically_increasing_id()).repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order).drop("uid")
    rows = materialize(rows.withColumn("ord", F.monotonically_increasing_id()), "repair-turns").withColumn("blk", F.expr(f"ord div {int(block)}"))

    # the blocks of conversations that have several, numbered
    several = rows.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n"))
    per = Window.partitionBy("conv")
    several = several.select(*_KEY, F.count(F.lit(1)).over(per).alias("n_blocks"), F.row_number().over(per.orderBy("blk")).alias("no")).where("n_blocks > 1")
    several = materialize(several, "repair-blocks")

    whole = _blocks(rows.join(several, _KEY, "left_anti"), None).withColumn("states", fold_from(F.col("turns"), F.lit(0)))
    whole = whole.withColumn("best", F.least("states.s0", "states.s3"))
    whole = whole.select("conv_id", _gaps("turn_min", "turn_max", "turns_met"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), rewritten(F.col("turns"), F.col("best.audit"), F.lit(0)).alias("repaired"))

    # turns of later blocks that an earlier block of the conversation has
    parts = rows.join(several, _KEY, "left_semi")
    first = parts.select(*_KEY, "ord", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest")).groupBy(*_KEY, "digest").agg(F.min("ord").alias("ord"))
    again = first.select("conv", "blk", "ord", (F.row_number().over(Window.partitionBy("conv", "digest").orderBy("ord")) > 1).alias("again")).where("again")
    later = again.groupBy(*_KEY).agg(F.collect_list("ord").alias("later"))
    starts = F.array(*(F.lit(k) for k in range(4)))
    parts = _blocks(parts, later).withColumn("from", F.transform(starts, lambda q: fold_from(F.col("turns"), q)))
    parts = materialize(parts.join(several.select(*_KEY, "no"), _KEY), "repair-parts")

    # a fold over blocks chooses the path through their states
    span = per.orderBy("no")
    joint = parts.select("conv", "no", "conv_id", *_COUNTS, "turn_min", "turn_max", "from",
        F.coalesce(~F.concat(F.lag("tail").over(span), "head").isin("su", "ua", "au"), F.lit(False)).alias("clash"),
        F.coalesce(F.lag("turn_last").over(span) == F.col("turn_first"), F.lit(False)).alias("same"),
    )
    joint = joint.groupBy("conv").agg(
        F.first("conv_id").alias("conv_id"), F.min("turn_min").alias("turn_min"), F.max("turn_max").alias("turn_max"),
        (F.sum("turns_met") - F.count_if("same")).alias("turns_met"), (F.sum("illegal") + F.count_if("clash")).alias("illegal"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")), F.array_sort(F.collect_list(F.struct("no", "from"))).alias("blocks"),
    )
    path = "struct<cost:bigint,audit:string,via:string>"
    kind = f"struct<s0:{path},s1:{path},s2:{path},s3:{path}>"

    def via(cost: Column, audit: Column, states: Column) -> Column:
        return F.struct(cost.alias("cost"), audit.alias("audit"), states.alias("via"))

    def along(acc: Column, b: Column) -> Column:
        def to(k: int) -> Column:
            return F.least(*(via(acc[f"s{q}"]["cost"] + b["from"][q][f"s{k}"]["cost"], F.concat(acc[f"s{q}"]["audit"], b["from"][q][f"s{k}"]["audit"]), F.concat(acc[f"s{q}"]["via"], F.lit(str(q)))) for q in range(4)))

        return F.struct(*(to(k).alias(f"s{k}") for k in range(4))).cast(kind)

    begin = F.struct(*(via(F.lit(0 if k == 0 else FAR).cast("long"), F.lit(""), F.lit("")).alias(f"s{k}") for k in range(4))).cast(kind)
    joint = joint.withColumn("end", F.aggregate("blocks", begin, along)).drop("blocks")
    joint = joint.withColumn("last", F.when(F.least("end.s0", "end.s3")["audit"] == F.col("end.s0.audit"), "0").otherwise("3")).withColumn("best", F.least("end.s0", "end.s3"))
    joint = materialize(joint.select("conv", "conv_id", _gaps("turn_min", "turn_max", "turns_met"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), F.concat("best.via", "last").alias("via")), "repair-joint")

    # each block writes its turns along the path
    steps = joint.select("conv", F.posexplode(F.split(F.expr("left(via, length(via) - 1)"), "")).alias("at", "start"), "via").where("start <> ''")
    steps = steps.select("conv", (F.col("at") + 1).alias("no"), F.col("start").cast("int").alias("start"), F.substr("via", F.col("at") + 2, F.lit(1)).cast("int").alias("stop"))
    chosen = parts.select("conv", "no", "turns", "from").join(steps, ["conv", "no"])
    ends = F.get(F.col("from"), F.col("start"))
    audit = F.get(F.array(*(ends[f"s{k}"]["audit"] for k in range(4))), F.col("stop"))
    texts = chosen.select("conv", "no", rewritten(F.col("turns"), audit, F.col("start")).alias("turns"))
    texts = texts.groupBy("conv").agg(F.flatten(F.array_sort(F.collect_list(F.struct("no", "turns")))["turns"]).alias("repaired"))
    return whole.unionByName(joint.join(texts, "conv").select(whole.columns))
