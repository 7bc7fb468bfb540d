import pytest

from betaloom.operators import intervals
from betaloom.plans import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_intervals_and_points_are_never_broadcast(spark):
    points = spark.sql("select * from values ('chr1_5', 'chr1', 5L), ('chr1_900', 'chr1', 900L) as (cpg_id, chrom, pos)")  # of known, small size
    genes = spark.sql("select * from values ('G1', 'S1', 'chr1', 1L, 40000L, '+') as (gene_id, gene_symbol, chrom, start, end, strand)")
    spans = genes.select("chrom", "start", "end")
    regions = spans.selectExpr("'r' region_id", "*")
    found = [
        intervals.gene_overlap(points, genes),
        intervals.gene_overlap(points, genes, include_intergenic=True),
        intervals.island_context(points, spans),
        intervals.region_overlap(points, regions),
        intervals.region_overlap(points, regions, one_based=True),
    ]
    for df in found:
        assert "Broadcast" not in plan(df)
        assert df.count() in (1, 2)


SF = "/root/testdata/sf0.001"


def broadcasts(df):
    """What the plan, before anything ran, would collect and send to all executors: the text below each exchange of that kind."""
    lines, out = plan(df).splitlines(), []
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = next((k for k in range(i + 1, len(lines)) if depth(lines[k]) <= depth(line)), len(lines))
            out.append("\n".join(lines[i:below]))
    return out


def test_import_broadcasts_no_genes_sites_or_regions(spark):
    """Only the names of pathways and terms may be."""
    g = queries._imported(spark, SF)
    assert broadcasts(g.e_cpg_gene) == broadcasts(g.e_cpg_region) == []
    for edges, name in ((g.e_gene_pathway, "p_brand"), (g.e_gene_term, "p_size")):
        assert all(name in x and "p_partkey" not in x for x in broadcasts(edges))


@pytest.mark.parametrize("name", ["island_digest", "overlap_freq", "overlap_shares", "region_overlap"])
def test_query_broadcasts_no_intervals_or_sites(spark, name):
    assert broadcasts(queries.QUERIES[name](spark, SF)) == []
