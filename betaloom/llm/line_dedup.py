"""Removal of lines that many sites share, with DataFrame functions only.

Lines are hashed to 128 bits. One HyperLogLog sketch of the sites per line hash, merged by aggregation, estimates how
many distinct sites show the line. Lines whose estimate is near the threshold get an exact distinct count; the others
are decided by the estimate. Removed lines leave every document but the first that has them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .buckets import spread_join
from .store import materialize

NEAR = 0.25  # estimates within this share of the threshold are counted exactly: over ten standard errors at lg_k 12


def _showing(lines: DataFrame, keys: DataFrame, broadcast_bytes: int) -> DataFrame:
    """lines of the hashes in keys (h1, h2, n: how often they occur). The keys are broadcast where their number, which is
    measured, allows; beyond that the lines of very frequent hashes are dealt to salts."""
    return lines.join(F.broadcast(keys.drop("n")), ["h1", "h2"]) if keys.count() * 192 <= broadcast_bytes else spread_join(lines, keys, ["h1", "h2"], "n").drop("n")


def dedup_lines(docs: DataFrame, *, site_col: str = "source", id_col: str = "doc_id", text_col: str = "text", min_sites: int = 10, lg_k: int = 12, keep_first: bool = True, counts: tuple[str, str] | None = ("n_lines", "n_removed"), broadcast_bytes: int = 64 << 20) -> DataFrame:
    """docs with text_col freed of lines that at least min_sites distinct sites show, and how many lines it had and lost.

    Lines end at LF and are compared without leading and trailing spaces; blank lines stay. With keep_first, the
    occurrence with the smallest id (null ids first), then the smallest line number, stays, so no content leaves the corpus. Null
    and empty sites together count as one site. Null text stays null, with 0 lines; a text that loses all lines becomes
    empty. Rows with equal id and text are treated alike. Other columns pass unchanged; of names that clash, in any
    case, the count columns win. An empty table gives no rows. Which lines go from which text is broadcast up to
    broadcast_bytes, so no text is shuffled; beyond that the join shuffles.
    """
    digest = F.xxhash64(F.col(text_col))
    line = F.trim(F.col("line"))
    lines = docs.select(F.col(id_col).alias("d"), digest.alias("t"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
    lines = lines.where(line != "").select("d", "t", "site", "pos", F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("second"), line, F.char_length(line)).alias("h2"))
    lines = materialize(lines, "line-hashes")

    # by a hash of the site: a sketch passes empty strings over
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg(F.xxhash64("site"), F.lit(lg_k)).alias("sketch"), F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "pos")).alias("first"))
    spread = spread.where(F.col("n") >= min_sites).withColumn("sites", F.hll_sketch_estimate("sketch")).where(F.col("sites") >= min_sites * (1 - NEAR))
    spread = materialize(spread.select("h1", "h2", "sites", "n", "first"), "line-spread")
    near = spread.where(F.col("sites") <= min_sites * (1 + NEAR))
    exact = _showing(lines, near.select("h1", "h2", "n"), broadcast_bytes).select("h1", "h2", "site").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("exact")).where(F.col("exact") >= min_sites)
    boilerplate = spread.where(F.col("sites") > min_sites * (1 + NEAR)).select("h1", "h2", "n", "first").unionByName(near.join(exact.select("h1", "h2"), ["h1", "h2"]).select("h1", "h2", "n", "first"))
    boilerplate = materialize(boilerplate, "line-boilerplate")

    hits = _showing(lines, boilerplate, broadcast_bytes)
    if keep_first:
        hits = hits.where(~(F.struct("d", "t", "pos").eqNullSafe(F.col("first"))))
    gone = hits.groupBy(F.col("d").alias("__line_d"), F.col("t").alias("__line_t")).agg(F.array_sort(F.collect_set("pos")).alias("__line_gone"))
    gone = materialize(gone, "line-gone")
    size = gone.agg(F.sum(F.size("__line_gone") * 8 + 256)).head()[0] or 0  # as a hashed relation
    if size <= broadcast_bytes:
        gone = F.broadcast(gone)

    # kept lines are the stretches between removed ones
    parts = F.split(F.col(text_col), "\n", -1)
    cuts = F.concat(F.array(F.lit(-1)), F.col("__line_gone"), F.array(F.size(parts)))
    joined = docs.join(gone, F.col(id_col).eqNullSafe(F.col("__line_d")) & (digest == F.col("__line_t")), "left").withColumn("__line_parts", parts).withColumn("__line_cuts", cuts)
    stretches = F.transform(F.sequence(F.lit(1), F.size("__line_gone") + 1), lambda j: F.slice(F.col("__line_parts"), F.get("__line_cuts", j - 1) + 2, F.get("__line_cuts", j) - F.get("__line_cuts", j - 1) - 1))
    text = F.when(F.col("__line_gone").isNull(), F.col(text_col)).otherwise(F.array_join(F.flatten(stretches), "\n"))
    number = {}
    if counts:
        number = {counts[0]: F.coalesce(F.size("__line_parts"), F.lit(0)), counts[1]: F.coalesce(F.size("__line_gone"), F.lit(0))}
    taken = {c.lower(): c for c in number}
    out = {taken.get(c.lower(), c): F.col(c) for c in docs.columns} | {text_col: text} | number
    return joined.select(*(v.alias(k) for k, v in out.items()))
