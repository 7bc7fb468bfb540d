"""Set enrichment: Fisher's exact test by one join, and the preranked running-sum test with permutations."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import present
from betaloom.functions.md5 import md5_heads
from betaloom.operators.compare import adjust
from betaloom.operators.order import numbered
from betaloom.sources.scratch import materialize, shuffle_partitions

DIGITS = 10  # of scores that are compared with those of permutations
TIE = 1e-12  # extremes that differ by no more, as sums in another order may, count as equal
EXACT_GENES = 200_000
SLICE = 8192  # places that are hashed at once
AT_ONCE = 50  # permutations whose places leave a task together


def signed_rank(effect: Column | str, p: Column | str, *, zero_p_is_one: bool = False) -> Column:
    """copysign(-log10 p, effect): p is clamped at 1e-300, a null p counts as 1 and a null effect as positive.

    zero_p_is_one treats p = 0 as 1, as an older tool did; by default it is the strongest result.
    """
    p = F.coalesce(present(p), F.lit(1.0))
    p = F.when(p == 0, F.lit(1.0)).otherwise(p) if zero_p_is_one else p
    size = -F.log10(F.greatest(p, F.lit(1e-300)))
    return F.when(present(effect) < 0, -size).otherwise(size)


def log_factorial(n: Column) -> Column:
    """ln n!, exact to double precision: from n! up to 20, by Stirling's series beyond."""
    x = n.cast("double")
    series = (x + 0.5) * F.ln(x) - x + 0.91893853320467274 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5.0))) - 1 / (1680 * F.pow(x, F.lit(7.0)))
    return F.when(n <= 20, F.ln(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def fisher_tail(a: Column, set_size: Column, hits: Column, total: Column) -> Column:
    """P(overlap >= a) when `hits` of `total` are drawn and `set_size` are marked; each term follows from the one before, in logs."""
    lf, rest = log_factorial, total - set_size - hits
    first = lf(set_size) + lf(total - set_size) + lf(hits) + lf(total - hits) - lf(total) - lf(a) - lf(set_size - a) - lf(hits - a) - lf(rest + a)

    def add(state: Column, k: Column) -> Column:
        ratio = ((set_size - k) * (hits - k)).cast("double") / ((k + 1) * (rest + k + 1))
        return F.struct((state["l"] + F.ln(ratio)).alias("l"), (state["s"] + F.exp(state["l"])).alias("s"))

    start = F.struct(first.alias("l"), F.lit(0.0).alias("s"))
    return F.least(F.lit(1.0), F.aggregate(F.sequence(a, F.least(hits, set_size)), start, add)["s"])


def fisher_enrichment(significant: DataFrame, membership: DataFrame, background: DataFrame, *, set_col: str = "pathway", gene_col: str = "gene") -> DataFrame:
    """Per set: odds_ratio, p_value (one-sided), n_overlap, n_significant, n_pathway, n_background, overlap_genes.

    Everything is restricted to the background. An empty margin gives p 1 and a null odds ratio; a zero in the
    denominator gives an infinite one. Sets without any background gene are tested too.
    """
    bg = background.select(gene_col).distinct().join(significant.select(gene_col).distinct().withColumn("sig", F.lit(True)), gene_col, "left")
    totals = bg.agg(F.count(F.lit(1)).alias("n_background"), F.count("sig").alias("n_significant"))
    members = membership.select(set_col, gene_col).distinct().join(bg.withColumn("bg", F.lit(True)), gene_col, "left")
    sets = members.groupBy(set_col).agg(F.count("bg").alias("n_pathway"), F.count("sig").alias("n_overlap"), F.array_sort(F.collect_list(F.when(F.col("sig"), F.col(gene_col)))).alias("overlap_genes"))
    one = sets.withColumn("k", F.lit(1)).join(F.broadcast(totals.withColumn("k", F.lit(1))), "k").drop("k")  # totals: one row
    a, b = F.col("n_overlap"), F.col("n_significant") - F.col("n_overlap")
    c, d = F.col("n_pathway") - F.col("n_overlap"), F.col("n_background") - F.col("n_significant") - F.col("n_pathway") + F.col("n_overlap")
    empty = (a + b == 0) | (c + d == 0) | (a + c == 0) | (b + d == 0)
    odds = F.when(empty, F.lit(None).cast("double")).when(b * c == 0, F.lit(float("inf"))).otherwise(F.try_divide((a * d).cast("double"), b * c))
    p = F.when(empty, F.lit(1.0)).otherwise(fisher_tail(a, F.col("n_pathway"), F.col("n_significant"), F.col("n_background")))
    return one.select(set_col, odds.alias("odds_ratio"), p.alias("p_value"), "n_overlap", "n_significant", "n_pathway", "n_background", "overlap_genes")


def running_sum(ranked: DataFrame, membership: DataFrame, *, set_col: str = "pathway", gene_col: str = "gene", metric_col: str = "metric") -> DataFrame:
    """Per set: es (the signed extreme of the running sum, ties to the maximum), n_genes and n_hits.

    Only hits are visited: between two hits the sum falls evenly, so its extremes lie just at or before a hit, or, where
    all hits have metric 0, at the end (-1).
    Genes are ranked by metric descending, then name; a repeated gene counts with its last metric in that order.
    """
    ranked = ranked.select(gene_col, F.col(metric_col).cast("double").alias(metric_col))
    places = numbered(ranked, [F.desc(metric_col), F.col(gene_col)], name="at")
    places = places.groupBy(gene_col).agg(F.max(F.struct("at", metric_col)).alias("last")).select(gene_col, F.col("last.at").alias("at"), F.col(f"last.{metric_col}").alias("metric"))
    n = ranked.agg(F.count(F.lit(1)).alias("n"))
    members = membership.select(set_col, gene_col).distinct()
    hits = members.join(places, gene_col, "left")
    w = Window.partitionBy(set_col)
    size = F.count(F.lit(1)).over(w)
    hits = hits.withColumn("n_genes", size).withColumn("n_hits", F.count("at").over(w)).withColumn("norm", F.sum(F.abs("metric")).over(w))
    hits = hits.withColumn("k", F.lit(1)).join(F.broadcast(n.withColumn("k", F.lit(1))), "k").drop("k")  # one row
    up = w.orderBy(F.col("at").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    gain = F.sum(F.abs("metric")).over(up) / F.when(F.coalesce(F.col("norm"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("norm"))
    misses = F.try_divide(F.col("at") - F.row_number().over(up.rowsBetween(Window.unboundedPreceding, 0)), F.col("n") - F.col("n_hits"))
    prior = F.abs("metric") / F.when(F.coalesce(F.col("norm"), F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("norm"))
    steps = hits.withColumn("high", F.when(F.col("at").isNotNull(), gain - misses)).withColumn("low", F.when(F.col("at").isNotNull(), gain - prior - misses))
    agg = steps.groupBy(set_col).agg(F.max("n_genes").alias("n_genes"), F.max("n_hits").alias("n_hits"), F.max("n").alias("n"), F.greatest(F.max("high"), F.lit(0.0)).alias("top"), F.least(F.min("low"), F.when(F.max("norm") == 0, F.lit(-1.0)).otherwise(F.lit(0.0))).alias("bottom"))
    blank = (F.col("n_hits") == 0) | (F.col("n_hits") == F.col("n"))
    es = F.when(blank, F.lit(0.0)).when(F.col("top") + TIE >= -F.col("bottom"), F.col("top")).otherwise(F.col("bottom"))
    return agg.select(set_col, es.alias("es"), "n_genes", "n_hits")


def _score(metric: np.ndarray, hit: np.ndarray) -> float:
    """The signed extreme of one running sum."""
    n = int(hit.sum())
    if n == 0 or n == len(hit):
        return 0.0
    gain = np.where(hit, np.abs(metric), 0.0)
    walk = np.cumsum(gain / (gain.sum() or 1.0) - ~hit / (len(hit) - n))
    top, bottom = float(walk.max()), float(walk.min())
    return top if abs(top) >= abs(bottom) else bottom


def _score_hits(at: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The signed extremes of running sums, one per row: at holds the hits' places in ascending order, weight their |metric|."""
    k = at.shape[1]
    up = np.cumsum(weight, axis=1)
    total = np.where(up[:, -1:] > 0, up[:, -1:], 1.0)
    misses = (at - np.arange(k)) / (n - k)
    top = np.maximum((up / total - misses).max(axis=1), 0.0)
    bottom = np.minimum(((up - weight) / total - misses).min(axis=1), np.where(up[:, -1] > 0, 0.0, -1.0))  # without any gain the walk ends at -1
    return np.where(top + TIE >= -bottom, top, bottom)


def _null_scores(at: np.ndarray, head: np.ndarray, weight: np.ndarray, sizes: list[int], n: int, prefix: str) -> list[float]:
    """The score of the first `size` places by md5(prefix + place), for each of the ascending sizes; at ascends from 1, head has the first 32 bits."""
    found, low = [], np.sort(head)
    for size in reversed(sizes):
        low, seen = low[:size], low
        keep = head <= low[-1]
        over = int(np.searchsorted(seen, low[-1], "right")) - size
        if over:  # of places with the same head the whole digest decides
            tied = sorted(np.flatnonzero(head == low[-1]), key=lambda i: (hashlib.md5(f"{prefix}{at[i]}".encode()).digest(), at[i]))
            keep[tied[-over:]] = False
        at, head, weight = at[keep], head[keep], weight[keep]
        found.append(float(_score_hits((at - 1)[None], weight[None], n)[0]))
    return found[::-1]


def permutation_null(ranked: DataFrame, sizes: DataFrame, n_permutations: int = 1000, *, seed: int = 42, gene_col: str = "gene", metric_col: str = "metric") -> DataFrame:
    """(n_hits, permutation, es): the score of a random set of each size in `sizes` (n_hits), for each permutation from 1.

    Permutation p puts the places of the ranking in the order of md5("seed/p/place"); a random set of n hits is the
    first n of them. So a size is drawn once for all sets that have it, every engine draws the same, and the ranking
    meets a permutation only in the few places that can be among the first: those whose hash is below a bound that the
    largest size exceeds by ten standard deviations. Places are hashed in slices of the ranking, and what a slice has for
    a permutation travels as one row of packed arrays. A task scores a permutation; its rows grow with the largest set.
    """
    spark = ranked.sparkSession
    wanted = sorted(r[0] for r in sizes.select(F.col("n_hits").cast("long")).distinct().collect())  # distinct sizes of sets
    places = materialize(numbered(ranked.select(gene_col, F.col(metric_col).cast("double").alias("m")), [F.desc("m"), F.col(gene_col)], name="at").select("at", F.abs("m").alias("w")), "ranking")
    total = places.count()
    wanted = [n for n in wanted if 0 < n < total]
    schema = "n_hits long, permutation int, es double"
    if not wanted or n_permutations < 1:
        return spark.createDataFrame([], schema)
    most = wanted[-1]
    share = min(1.0, (most + 10 * most**0.5 + 50) / total)
    bound = np.uint32(min(0xFFFFFFFF, int(share * 2**32)))

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for here in np.array_split(np.arange(len(pdf)), max(1, -(-len(pdf) // (2 * SLICE)))):
                at, w = (pdf[c].to_numpy()[here] for c in ("at", "w"))
                heads, rows = md5_heads(at), []
                for p in range(1, n_permutations + 1):
                    head = heads(f"{seed}/{p}/")
                    low = np.flatnonzero(head <= bound)
                    if len(low):
                        rows.append((p, int(at[0]), (at[low] - at[0]).astype(np.uint32).tobytes(), head[low].tobytes(), w[low].tobytes()))
                    if len(rows) == AT_ONCE or rows and p == n_permutations:
                        yield pd.DataFrame(rows, columns=["p", "first", "at", "head", "w"])
                        rows = []

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, p = pdf.sort_values("first"), int(pdf.p.iloc[0])
        at = np.concatenate([first + np.frombuffer(x, np.uint32) for first, x in zip(pdf["first"], pdf["at"])])
        head, w = (np.frombuffer(b"".join(pdf[c]), kind) for c, kind in (("head", np.uint32), ("w", np.float64)))
        if len(at) < most:
            raise ValueError(f"permutation {p} has {len(at)} places below the bound, fewer than {most}")
        return pd.DataFrame({"n_hits": wanted, "permutation": p, "es": _null_scores(at, head, w, wanted, total, f"{seed}/{p}/")})

    slices = places.repartitionByRange(min(shuffle_partitions(spark) * 8, -(-total // SLICE)), "at").sortWithinPartitions("at")
    drawn = slices.mapInPandas(draw, "p int, first long, at binary, head binary, w binary")
    # as many tasks as a shuffle has, however few bytes there are: scoring costs more than moving
    return drawn.repartition(shuffle_partitions(spark), "p").groupBy("p").applyInPandas(score, schema)


def gsea_preranked(ranked: DataFrame, membership: DataFrame, n_permutations: int = 1000, *, seed: int = 42, exact_rng: bool = False, set_col: str = "pathway", gene_col: str = "gene", metric_col: str = "metric") -> DataFrame:
    """Per set with some but not all genes hit: es, nes, p_value, n_genes, n_hits.

    es comes from running_sum, its null from permutation_null, both held to ten digits: nes is es over the null's mean
    size, p_value the share of the null at least as extreme on es's side, never below 1 / (n_permutations + 1). Nothing
    but set sizes and counts reaches the driver. exact_rng shuffles whole rankings for all sets in name order from one
    generator instead, in a single task, for rankings of at most EXACT_GENES genes.
    """
    if exact_rng:
        return _gsea_one_generator(ranked, membership, n_permutations, seed, set_col, gene_col, metric_col)
    members = membership.select(F.col(set_col).cast("string").alias(set_col), gene_col).distinct()
    genes = ranked.count()
    found = running_sum(ranked, members, set_col=set_col, gene_col=gene_col, metric_col=metric_col).where((F.col("n_hits") > 0) & (F.col("n_hits") < genes))
    found = materialize(found.withColumn("es", F.round("es", DIGITS)), "gsea-scores")
    null = permutation_null(ranked, found, n_permutations, seed=seed, gene_col=gene_col, metric_col=metric_col).select("n_hits", F.round("es", DIGITS).alias("null"))
    both = found.join(null, "n_hits", "left").groupBy(set_col, "es", "n_genes", "n_hits").agg(
        F.avg(F.abs("null")).alias("size"),
        F.count_if(F.when(F.col("es") >= 0, F.col("null") >= F.col("es")).otherwise(F.col("null") <= F.col("es"))).alias("beyond"),
    )
    nes = F.when(F.col("size") > 0, F.col("es") / F.col("size")).otherwise(F.lit(0.0))
    p = F.greatest(F.col("beyond") / F.lit(float(max(1, n_permutations))), F.lit(1 / (n_permutations + 1)))
    return both.select(set_col, "es", nes.alias("nes"), p.alias("p_value"), "n_genes", "n_hits")


def _gsea_one_generator(ranked: DataFrame, membership: DataFrame, n_permutations: int, seed: int, set_col: str, gene_col: str, metric_col: str) -> DataFrame:
    rows = ranked.select(gene_col, F.col(metric_col).cast("double").alias("m")).orderBy(F.desc("m"), gene_col).limit(EXACT_GENES + 1).collect()
    if len(rows) > EXACT_GENES:
        raise ValueError(f"exact_rng takes rankings of at most {EXACT_GENES} genes")
    metric, place = np.array([r[1] for r in rows], float), {r[0]: i for i, r in enumerate(rows)}

    def all_sets(pdf: pd.DataFrame) -> pd.DataFrame:
        rng, got = np.random.default_rng(seed), []
        for name, g in pdf.groupby(set_col, sort=True):
            at = [place[x] for x in set(g[gene_col]) if x in place]
            if not 0 < len(at) < len(metric):
                continue
            mask = np.zeros(len(metric), bool)
            mask[at] = True
            es, null = _score(metric, mask), np.empty(n_permutations)
            for i in range(n_permutations):
                rng.shuffle(mask)
                null[i] = _score(metric, mask)
            mean = float(np.abs(null).mean()) if n_permutations else 0.0
            p = float((null >= es).mean() if es >= 0 else (null <= es).mean()) if n_permutations else 0.0
            got.append((name, es, es / mean if mean else 0.0, p or 1 / (n_permutations + 1), g[gene_col].nunique(), len(at)))
        return pd.DataFrame(got, columns=[set_col, "es", "nes", "p_value", "n_genes", "n_hits"])

    members = membership.select(F.col(set_col).cast("string").alias(set_col), gene_col).distinct()
    return members.groupBy().applyInPandas(all_sets, f"{set_col} string, es double, nes double, p_value double, n_genes long, n_hits long")


def run_enrichment(results: DataFrame, membership: DataFrame, *, method: str = "fisher", q_threshold: float = 0.05, n_permutations: int = 1000, seed: int = 42, fdr_method: str = "fdr_bh", alpha: float = 0.05, set_col: str = "pathway", gene_col: str = "gene", feature_col: str = "feature", effect_col: str = "cohens_d") -> DataFrame:
    """Fisher (features with q below the threshold against all) or GSEA (signed rank of p), adjusted, sorted by p."""
    genes = results.withColumnRenamed(feature_col, gene_col)
    if method == "fisher":
        out = fisher_enrichment(genes.where(present("q_value") < q_threshold), membership, genes, set_col=set_col, gene_col=gene_col)
    elif method == "gsea":
        ranked = genes.where(present("p_value").isNotNull()).select(gene_col, signed_rank(effect_col, "p_value").alias("metric"))
        out = gsea_preranked(ranked, membership, n_permutations, seed=seed, set_col=set_col, gene_col=gene_col)
    else:
        raise ValueError(f"unknown method {method!r}: fisher or gsea")
    return adjust(out, fdr_method, alpha, tie=set_col).orderBy(F.col("p_value").asc_nulls_last(), set_col)
