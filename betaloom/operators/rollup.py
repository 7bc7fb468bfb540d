"""Roll-ups of site values to genes, and of genes to pathways and terms, over long relations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.functions.ids import present

# Aggregation methods by name: value and weight columns to an aggregate. Add to it to extend the engine.
METHODS: dict[str, Callable[[Column, Column], Column]] = {
    "mean": lambda v, w: F.avg(v),
    "median": lambda v, w: F.median(v),
    "weighted": lambda v, w: F.try_divide(F.sum(w * v), F.sum(F.when(v.isNotNull(), w))),
}


def _method(name: str) -> Callable[[Column, Column], Column]:
    if name not in METHODS:
        raise ValueError(f"unknown method {name!r}: one of {sorted(METHODS)}")
    return METHODS[name]


BROADCAST_ROWS = 2_000_000  # of a mapping: some 100 MB as a hashed relation


def _mapped(beta: DataFrame, edges: DataFrame, site_col: str) -> DataFrame:
    """beta joined to edges. Up to BROADCAST_ROWS of these, which are counted, are broadcast: then no cell is shuffled
    before its task has added it up; larger mappings are joined by shuffle."""
    few = edges.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return beta.join(F.broadcast(edges) if few else edges, site_col)


def rollup_sites(beta: DataFrame, mapping: DataFrame, method: str = "mean", *, weights: DataFrame | None = None, feature_col: str = "gene", site_col: str = "cpg_id", sample_col: str = "sample_id", value_col: str = "beta") -> DataFrame:
    """(feature, sample, value, n_cpgs): the method over the feature's distinct sites that have a value.

    Features without any site in beta are absent; a cell with missing values only is null. weights: (site, weight),
    for the method "weighted", renormalised over the sites with a value. Means are added up in each task before the
    shuffle; a median needs the values of a feature and sample in one place, which suits genes of some hundred sites.
    """
    agg = _method(method)
    if method == "weighted" and weights is None:
        raise ValueError("the method weighted needs weights")
    edges = mapping.select(feature_col, site_col).distinct()
    if weights is not None:
        edges = edges.join(weights.select(site_col, F.col("weight").cast("double").alias("weight")), site_col)
    else:
        edges = edges.withColumn("weight", F.lit(1.0))
    v = present(value_col)
    return _mapped(beta, edges, site_col).groupBy(feature_col, sample_col).agg(agg(v, F.col("weight")).alias("value"), F.count(v).alias("n_cpgs"))


def rollup_by_chromosome(beta: DataFrame, mapping: DataFrame, method: str = "mean", *, min_sites: int = 1, feature_col: str = "gene", site_col: str = "cpg_id", chrom_col: str = "chrom", sample_col: str = "sample_id", value_col: str = "beta") -> DataFrame:
    """(feature, sample, value): the method within each chromosome, then the plain mean of the chromosomes' values.

    A feature stays when at least min_sites of its sites are in beta on their chromosomes, missing values counted.
    """
    if method == "weighted":
        raise ValueError("weighted is not defined chromosome by chromosome")
    agg = _method(method)
    edges = mapping.select(feature_col, site_col).distinct()
    v = present(value_col)
    cells = _mapped(beta, edges, site_col)
    per = cells.groupBy(feature_col, sample_col, chrom_col).agg(agg(v, F.lit(1.0)).alias("value"))
    out = per.groupBy(feature_col, sample_col).agg(F.avg("value").alias("value"))
    if min_sites > 1:  # rows may be short, so the sites that are there are read from all samples: one column, folded in each task
        enough = beta.select(site_col).distinct().join(edges, site_col).groupBy(feature_col).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
        out = out.join(enough.select(feature_col), feature_col, "left_semi")
    return out


def rollup_sets(features: DataFrame, membership: DataFrame, method: str = "mean", *, set_col: str = "pathway", member_col: str = "gene", sample_col: str = "sample_id", value_col: str = "value") -> DataFrame:
    """(set, sample, value, n_members): the method over the set's distinct members that are present."""
    agg = _method(method)
    v = present(value_col)
    return features.join(membership.select(set_col, member_col).distinct(), member_col).groupBy(set_col, sample_col).agg(agg(v, F.lit(1.0)).alias("value"), F.count(v).alias("n_members"))
