"""Chat formatting in budgeted windows, with DataFrame functions only.

Turns are range-partitioned by (conversation, turn), so a conversation that holds a third of all rows spreads over
many partitions. What follows works on turn numbers and token counts alone; texts are joined once, when each window's
turns are known. Prefix sums of turn tokens are taken inside each (conversation, partition) and shifted by the totals
of the partitions before, a few rows per conversation. They choose the spans:

* A turn over half the room is a span of its own; other turns between two such turns share a span as long as their
  prefix sum stays in one cell of width (room - longest such turn), so a span never exceeds the room.
* The room is the budget less the system turn and the history allowance.
* Each window repeats the system turn and up to `history_turns` turns before its span within `history_tokens`.
  Repeated turns carry no loss: every assistant text is a target in exactly one window.

No tokenizer runs here. A turn counts as its formatted UTF-8 bytes, which no byte-level vocabulary can exceed, so the
budget holds in tokens of any of them; bytes_per_token over 1 fills windows better where a vocabulary is known.

Template: <|im_start|>role\\ntext<|im_end|>\\n per turn. Inside texts and roles each "<", any backslashes, "|" gets one
backslash more, so control strings never occur there; taking one away restores the text. Roles also write a backslash
as \\s and a line feed as \\n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import materialize, release, shuffle_partitions

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("\\n"), F.lit("\n")), F.lit("\\s"), F.lit("\\"))


def token_bound(role: Column, text: Column, bytes_per_token: float = 1.0) -> Column:
    """At least the tokens of the formatted turn: its UTF-8 bytes, for bytes_per_token 1."""
    size = F.octet_length(escape(text)) + F.octet_length(escape_role(role)) + len(START + "\n" + END + "\n")
    return (size if bytes_per_token == 1 else F.ceil(size / bytes_per_token)).cast("long")


def format_chats(turns: DataFrame, *, budget: int = 8192, history_turns: int = 2, history_tokens: int = 1024, bytes_per_token: float = 1.0) -> DataFrame:
    """One row per window: conv_id, start (number of its first new turn), n_repeated, n_new, tokens (at most: see
    token_bound), over_budget, body (the formatted text) and loss (array of begin, end in code points of body: the
    assistant texts to learn).

    turns: conv_id, turn, role, text; null role or text counts as empty, a null conv_id is a conversation, null turns
    come first, rows of equal turn are ordered by role and text, repeated rows are turns of their own. A turn longer
    than the budget stays whole in a window with over_budget true. The first turn is the system turn if its role is
    "system". Other columns are ignored; an empty table gives no rows.
    """
    spark = turns.sparkSession
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.repartitionByRange(shuffle_partitions(spark), "conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    rows = rows.select("conv", "conv_id", "role", "text", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().alias("ord"), token_bound(F.col("role"), F.col("text"), bytes_per_token).alias("tokens"))
    rows = materialize(rows, "chat-turns")

    # the number of each turn, and the room that its conversation's system turn leaves
    meta = rows.select("conv", "pid", "ord", "tokens", (F.col("role") == "system").alias("sys"))
    part = Window.partitionBy("conv").orderBy("pid")
    before = part.rowsBetween(Window.unboundedPreceding, -1)
    parts = meta.groupBy("conv", "pid").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "sys", "tokens")).alias("head"))
    first = F.first("head").over(part.rowsBetween(Window.unboundedPreceding, 0))
    parts = parts.select("conv", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"), first.alias("first"))
    room = F.greatest(F.lit(budget - history_tokens) - F.when(F.col("first.sys"), F.col("first.tokens")).otherwise(0), F.lit(max(1, budget // 4)))
    parts = parts.select("conv", "pid", "rows_before", room.alias("room"), F.when(F.col("first.sys"), F.col("first.ord")).alias("sys_ord"))
    local = Window.partitionBy("conv", "pid").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    large = F.col("tokens") * 2 > F.col("room")
    small = F.when(~large, F.col("tokens")).otherwise(0)
    numbered = meta.join(parts, ["conv", "pid"]).select(
        "conv", "pid", "ord", "tokens", "room", "sys_ord",
        (F.row_number().over(local) + F.col("rows_before") - 1).cast("long").alias("idx"),
        F.sum(small).over(local).alias("small_run"),
        F.sum(large.cast("long")).over(local).alias("large_run"),
    )
    numbered = materialize(numbered, "chat-numbers")

    # prefix sums of tokens choose the spans
    sums = numbered.groupBy("conv", "pid").agg(F.max("small_run").alias("s"), F.max("large_run").alias("l"), F.max(small).alias("longest"))
    sums = sums.select("conv", "pid", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s0"), F.coalesce(F.sum("l").over(before), F.lit(0)).alias("l0"), F.max("longest").over(Window.partitionBy("conv")).alias("longest"))
    placed = numbered.join(sums, ["conv", "pid"]).select(
        "conv", "idx", "ord", "tokens", "sys_ord",
        ((F.col("large_run") + F.col("l0")) * 2 - large.cast("int")).alias("run"),
        F.when(large, F.lit(0)).otherwise(F.expr("(small_run + s0 - tokens) div (room - longest)")).cast("long").alias("cell"),
    )
    placed = materialize(placed, "chat-places")
    release(numbered)
    spans = placed.groupBy("conv", "run", "cell").agg(F.min("idx").alias("start"), F.first("sys_ord").alias("sys_ord")).where("start > 0")

    # what windows repeat
    back = spans.withColumn("back", F.explode(F.sequence(F.lit(1), F.lit(history_turns)))) if history_turns else spans.where("false").withColumn("back", F.lit(1))
    history = back.select("conv", "run", "cell", "sys_ord", (F.col("start") - F.col("back")).alias("idx")).where("idx >= 0").join(placed.select("conv", "idx", "ord", "tokens"), ["conv", "idx"]).where("sys_ord is null or ord <> sys_ord")
    near = Window.partitionBy("conv", "run", "cell").orderBy(F.desc("idx")).rowsBetween(Window.unboundedPreceding, 0)
    history = history.withColumn("so_far", F.sum("tokens").over(near)).where(F.col("so_far") <= history_tokens)
    system = spans.where("sys_ord is not null").select("conv", "run", "cell", F.lit(0).cast("long").alias("idx"), F.col("sys_ord").alias("ord"))
    key = ["conv", "run", "cell"]
    members = placed.select(*key, "idx", "ord", F.lit(True).alias("new")).unionByName(history.select(*key, "idx", "ord", F.lit(False).alias("new"))).unionByName(system.withColumn("new", F.lit(False)))
    members = members.join(rows.select("ord", "conv_id", "role", "text", "tokens"), "ord")

    # the windows, each bounded by the budget
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    shown = members.select("conv", "conv_id", "run", "cell", "idx", "tokens", "new", (F.col("role") == "assistant").alias("target"), head.alias("head"), escape(F.col("text")).alias("shown"))
    shown = shown.select(*key, "conv_id", "idx", "tokens", "new", "target", F.char_length("head").alias("skip"), F.char_length("shown").alias("size"), F.concat("head", "shown", F.lit(END + "\n")).alias("turn"))
    order = Window.partitionBy(*key).orderBy("idx")
    begin = F.coalesce(F.sum(F.char_length("turn")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("skip")
    shown = shown.withColumn("begin", begin.cast("int")).select("*", (F.col("begin") + F.col("size")).cast("int").alias("end"))
    windows = shown.groupBy(*key).agg(
        F.first("conv_id").alias("conv_id"),
        F.min(F.when(F.col("new"), F.col("idx"))).alias("start"),
        F.count_if(~F.col("new")).alias("n_repeated"),
        F.count_if(F.col("new")).alias("n_new"),
        F.sum("tokens").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("idx", "turn"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("new") & F.col("target"), F.struct("begin", "end")))).alias("loss"),
    )
    return windows.select("conv_id", "start", "n_repeated", "n_new", "tokens", (F.col("tokens") > budget).alias("over_budget"), F.array_join("turns.turn", "").alias("body"), "loss")


def read_back(windows: DataFrame) -> DataFrame:
    """Per window, from body and loss alone: conv_id, start, n_new, chars (of body), turns (its new turns as role, LF,
    text, LF) and learned (the unescaped text under the loss).

    A window without loss has an empty learned; empty roles and texts come back empty. No windows give no rows.
    """
    marked = F.slice(F.split("body", r"<\|im_end\|>\n", -1), F.col("n_repeated").cast("int") + 1, F.col("n_new").cast("int"))

    def one(turn: Column) -> Column:
        inside = F.substr(turn, F.lit(len(START) + 1))
        cut = F.call_function("locate", F.lit("\n"), inside)
        return F.concat(unescape_role(F.substr(inside, F.lit(1), cut - 1)), F.lit("\n"), unescape(F.substr(inside, cut + 1)), F.lit("\n"))

    under = F.transform("loss", lambda s: unescape(F.substr(F.col("body"), s["begin"] + 1, s["end"] - s["begin"])))
    return windows.select("conv_id", "start", "n_new", F.char_length("body").alias("chars"), F.array_join(F.transform(marked, one), "").alias("turns"), F.array_join(under, "").alias("learned"))


def chat_digests(windows: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all read back from windows.

    Windows of null conv_id are one conversation; one without an assistant has loss_chars 0 and the digest of no text.
    No windows give no rows. A conversation's new turns meet in one task, as its digest needs.
    """
    per = read_back(windows).groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list(F.struct("start", "turns", "learned"))).alias("w"),
    )
    learned = F.array_join("w.learned", "")
    return per.select("conv_id", "n_turns", F.sha2(F.array_join("w.turns", ""), 256).alias("turns_sha256"), F.char_length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"), "formatted_chars")
