"""Point-in-interval joins: sites to genes and promoters, to islands with shores and shelves, and to regions.

Intervals are exploded into fixed bins and joined on (chrom, bin), then checked exactly: an equi-join at any size,
without broadcasting either side: a plan's estimate does not know how many bins an interval fills, so the join asks for a
merge. A point lies in one bin, so no match is made twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from betaloom.functions.ids import col

PROMOTER_UPSTREAM, PROMOTER_DOWNSTREAM = 1500, 500
SHORE, SHELF = 2000, 2000
BIN = 16_384


def promoter_bounds(start: Column | str = "start", end: Column | str = "end", strand: Column | str = "strand") -> tuple[Column, Column]:
    """Closed 1-based promoter: 1500 before to 500 behind the first base; of a minus gene seen from its end."""
    start, end, minus = col(start), col(end), F.coalesce(col(strand) == "-", F.lit(False))
    lo = F.when(minus, end - PROMOTER_DOWNSTREAM).otherwise(start - PROMOTER_UPSTREAM)
    hi = F.when(minus, end + PROMOTER_UPSTREAM).otherwise(start + PROMOTER_DOWNSTREAM)
    return F.greatest(lo, F.lit(1)), hi


def bin_join(points: DataFrame, intervals: DataFrame, *, chrom: str = "chrom", pos: Column | str = "pos", lo: str = "__lo", hi: str = "__hi", how: str = "inner", width: int = BIN) -> DataFrame:
    """points joined to intervals of the same chrom with lo <= pos <= hi; both keep all their columns.

    The intervals' chromosome column is dropped. how: inner or left. Null positions match nothing.
    """
    pos = col(pos)
    right = intervals.withColumnRenamed(chrom, "__chrom").withColumn("__bin", F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.col(hi) / width))))
    left = points.withColumn("__pos", pos).withColumn("__at", F.floor(F.col("__pos") / width))
    match = (F.col(chrom) == F.col("__chrom")) & (F.col("__at") == F.col("__bin")) & (F.col("__pos") >= F.col(lo)) & (F.col("__pos") <= F.col(hi))
    return left.join(right.hint("merge"), match, how).drop("__chrom", "__bin", "__at", "__pos")


def gene_overlap(sites: DataFrame, genes: DataFrame, *, include_intergenic: bool = False, width: int = BIN) -> DataFrame:
    """Site to gene rows (cpg_id, chromosome, position, gene_id, gene_symbol, overlap_type), one per pair.

    sites: cpg_id, chrom, pos; genes: gene_id, gene_symbol, chrom, start, end, strand (closed, 1-based). A site in the
    promoter is "promoter" even inside the gene, else "gene_body". With include_intergenic, sites without a gene come
    once with blank gene and "intergenic".
    """
    plo, phi = promoter_bounds()
    spans = genes.where("chrom is not null").select("gene_id", "gene_symbol", "chrom", F.col("start").alias("gs"), F.col("end").alias("ge"), plo.alias("ps"), phi.alias("pe"))
    spans = spans.withColumn("__lo", F.least("gs", "ps")).withColumn("__hi", F.greatest("ge", "pe"))
    points = sites.select("cpg_id", "chrom", "pos")
    got = bin_join(points, spans, how="left" if include_intergenic else "inner", width=width)
    promoter, body = F.expr("pos between ps and pe"), F.expr("pos between gs and ge")
    kind = F.when(promoter, "promoter").when(body, "gene_body")
    if not include_intergenic:
        got = got.where(kind.isNotNull())
        return got.select("cpg_id", F.col("chrom").alias("chromosome"), F.col("pos").alias("position"), "gene_id", "gene_symbol", kind.alias("overlap_type"))
    # a gene may reach a site's bin and span without holding it: such rows only stay where nothing else does
    hit = kind.isNotNull()
    some = F.max(hit).over(Window.partitionBy("cpg_id", "chrom", "pos"))
    first = F.row_number().over(Window.partitionBy("cpg_id", "chrom", "pos").orderBy(hit.desc()))
    got = got.withColumn("some", some).withColumn("first", first).where(hit | (~F.coalesce(F.col("some"), F.lit(False)) & (F.col("first") == 1)))
    blank = lambda c: F.when(hit, F.col(c)).otherwise("")
    return got.select("cpg_id", F.col("chrom").alias("chromosome"), F.col("pos").alias("position"), blank("gene_id").alias("gene_id"), blank("gene_symbol").alias("gene_symbol"), F.coalesce(kind, F.lit("intergenic")).alias("overlap_type"))


def island_context(sites: DataFrame, islands: DataFrame, *, width: int = BIN) -> DataFrame:
    """One row per distinct site: cpg_id, chromosome, position, context, island_id.

    islands: chrom, start, end (half-open, 0-based). island beats shore (2 kb around) beats shelf (2 kb further);
    sites without any are open_sea with a blank island. Of islands of equal class the one with the largest start wins.
    """
    reach = islands.select("chrom", F.col("start").alias("is"), F.col("end").alias("ie"))
    reach = reach.withColumn("__lo", F.greatest(F.col("is") - SHORE - SHELF, F.lit(0)) + 1).withColumn("__hi", F.col("ie") + SHORE + SHELF)
    got = bin_join(sites.select("cpg_id", "chrom", "pos").distinct(), reach, how="left", width=width)
    at = F.col("pos") - 1
    rank = F.when((at >= F.col("is")) & (at < F.col("ie")), 3).when((at >= F.col("is") - SHORE) & (at < F.col("ie") + SHORE), 2).when(F.col("is").isNotNull(), 1).otherwise(0)
    best = got.groupBy("cpg_id", "chrom", "pos").agg(F.max(F.struct(rank.alias("rank"), "is", "ie")).alias("best"))
    rank = F.col("best.rank")
    name = F.when(rank == 3, "island").when(rank == 2, "shore").when(rank == 1, "shelf").otherwise("open_sea")
    island = F.when(rank > 0, F.format_string("%s:%d-%d", "chrom", "best.is", "best.ie")).otherwise("")
    return best.select("cpg_id", F.col("chrom").alias("chromosome"), F.col("pos").alias("position"), name.alias("context"), island.alias("island_id"))


def region_overlap(sites: DataFrame, regions: DataFrame, *, one_based: bool = False, width: int = BIN) -> DataFrame:
    """(cpg_id, region_id): the region with the smallest start that holds the site, sites without one left out.

    Regions are half-open and 0-based. one_based compares the 1-based position as it is, as older graph imports did.
    """
    spans = regions.select("region_id", "chrom", F.col("start").alias("rs"), F.col("end").alias("re")).withColumn("__lo", F.col("rs")).withColumn("__hi", F.col("re") - 1).where("rs < re")
    got = bin_join(sites.select("cpg_id", "chrom", "pos"), spans, pos=F.col("pos") if one_based else F.col("pos") - 1, width=width)
    return got.groupBy("cpg_id").agg(F.min(F.struct("rs", "region_id")).alias("first")).select("cpg_id", F.col("first.region_id").alias("region_id"))


def find_overlapping(genes: DataFrame, chrom: str, pos: int, chrom_col: str = "chrom", start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Genes whose half-open interval holds the point; KeyError for a missing column."""
    missing = {chrom_col, start_col, end_col} - set(genes.columns)
    if missing:
        raise KeyError(f"missing columns: {sorted(missing)}")
    return genes.where((F.col(chrom_col) == chrom) & (F.col(start_col) < pos + 1) & (F.col(end_col) > pos))
