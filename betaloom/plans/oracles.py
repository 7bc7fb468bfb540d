"""DuckDB SQL for the queries, written against the raw tables and independent of the operators."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

CTES = {
    "cells": """cells AS (SELECT vec_id AS sample_id, d, 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id,
        CASE WHEN (vec_id * 31 + d) % 11 <> 0 THEN v::DOUBLE END AS beta FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS d FROM embeddings))""",
    "meta": "meta AS (SELECT vec_id AS sample_id, label::VARCHAR AS clinical_category FROM embeddings)",
    "dims": "dims AS (SELECT unnest(range(64)) AS id)",
    "site_genes": """site_genes AS (SELECT DISTINCT * FROM (SELECT 'g' || (id // 4) AS gene, 'chr' || (id % 4 + 1) || '_' || ((id + 1) * 1000) AS cpg_id FROM dims
        UNION ALL SELECT 'g' || ((id * 7) % 16), 'chr' || (id % 4 + 1) || '_' || ((id + 1) * 1000) FROM dims))""",
    "gene_sets": "gene_sets AS (SELECT DISTINCT * FROM (SELECT 'p' || (id % 5) AS s, 'g' || id AS gene FROM dims WHERE id < 16 UNION ALL SELECT 'p' || ((id * 3) % 5), 'g' || id FROM dims WHERE id < 16))",
    "gf": "gf AS (SELECT gene, sample_id, avg(beta) AS value, count(beta) AS n_cpgs FROM cells JOIN site_genes USING (cpg_id) GROUP BY ALL)",
    "cov": "cov AS (SELECT cpg_id, count(beta) AS n_present, count(*) AS n_total, count(beta) / count(*) AS coverage FROM cells GROUP BY cpg_id)",
    "stats": """stats AS (SELECT cpg_id, any_value(chrom) AS chromosome, any_value(pos) AS position, avg(beta) AS mean_beta, var_samp(beta) AS variance, 1 - count(beta) / count(*) AS missingness, count(beta) AS n_samples FROM cells GROUP BY cpg_id)""",
    "points": "points AS (SELECT 'chr' || (o_orderkey % 3 + 1) AS chrom, (o_orderkey * 2500 + 1)::BIGINT AS pos, 'chr' || (o_orderkey % 3 + 1) || '_' || (o_orderkey * 2500 + 1) AS cpg_id FROM orders)",
    "genes": """genes AS (SELECT *, CASE WHEN strand = '-' THEN e - 500 ELSE greatest(s - 1500, 1) END AS ps, CASE WHEN strand = '-' THEN e + 1500 ELSE s + 500 END AS pe FROM (
        SELECT 'ENSG' || p_partkey AS gene_id, 'S' || p_partkey AS gene_symbol, 'chr' || (p_partkey % 3 + 1) AS chrom, (p_partkey * 20000 + 200)::BIGINT AS s, (p_partkey * 20000 + 200 + p_size * 4000)::BIGINT AS e,
        CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM part))""",
    "islands": "islands AS (SELECT 'chr' || (p_partkey // 2 % 3 + 1) AS chrom, (p_partkey * 3000)::BIGINT AS s, (p_partkey * 3000 + p_size * 60)::BIGINT AS e FROM part)",
    "hits": """hits AS (SELECT cpg_id, p.chrom AS chromosome, pos AS position, gene_id, gene_symbol, CASE WHEN pos BETWEEN ps AND pe THEN 'promoter' ELSE 'gene_body' END AS overlap_type
        FROM points p JOIN genes g ON p.chrom = g.chrom AND (pos BETWEEN ps AND pe OR pos BETWEEN s AND e))""",
    "mapped": """mapped AS (SELECT * FROM hits UNION ALL SELECT cpg_id, chrom, pos, '', '', 'intergenic' FROM points WHERE cpg_id NOT IN (SELECT cpg_id FROM hits))""",
    "ctx": """ctx AS (SELECT cpg_id, chrom AS chromosome, pos AS position, CASE k WHEN 3 THEN 'island' WHEN 2 THEN 'shore' WHEN 1 THEN 'shelf' ELSE 'open_sea' END AS context, CASE WHEN k > 0 THEN chrom || ':' || s || '-' || e ELSE '' END AS island_id FROM (
        SELECT p.*, i.s, i.e, CASE WHEN pos - 1 >= s AND pos - 1 < e THEN 3 WHEN pos - 1 >= s - 2000 AND pos - 1 < e + 2000 THEN 2 WHEN s IS NOT NULL THEN 1 ELSE 0 END AS k,
        row_number() OVER (PARTITION BY p.cpg_id ORDER BY CASE WHEN pos - 1 >= s AND pos - 1 < e THEN 3 WHEN pos - 1 >= s - 2000 AND pos - 1 < e + 2000 THEN 2 WHEN s IS NOT NULL THEN 1 ELSE 0 END DESC, s DESC NULLS LAST) AS n
        FROM points p LEFT JOIN islands i ON p.chrom = i.chrom AND pos - 1 >= greatest(s - 4000, 0) AND pos - 1 < e + 4000) WHERE n = 1)""",
    "q": "q AS (SELECT unnest([0.95, 0.99, 0.999])::DOUBLE AS quantile)",
    "thr": "thr AS (SELECT gene, quantile, CASE quantile WHEN 0.95 THEN a WHEN 0.99 THEN b ELSE c END AS threshold FROM (SELECT gene, quantile_cont(value, 0.95) AS a, quantile_cont(value, 0.99) AS b, quantile_cont(value, 0.999) AS c FROM gf JOIN meta USING (sample_id) WHERE clinical_category = '0' GROUP BY gene), q)",
    "hms": "hms AS (SELECT quantile, sample_id, count(*) FILTER (value > threshold) AS hms_count, any_value(clinical_category) AS clinical_category FROM gf JOIN thr USING (gene) LEFT JOIN meta USING (sample_id) GROUP BY quantile, sample_id)",
    "lab": """lab AS (SELECT label, cpg_id AS feature, clinical_category = a AS first, beta AS value FROM cells JOIN meta USING (sample_id)
        JOIN (VALUES ('0_vs_1', '0', '1'), ('0_vs_2', '0', '2'), ('1_vs_2', '1', '2')) c(label, a, b) ON clinical_category IN (a, b) WHERE beta IS NOT NULL)""",
    "eff": """eff AS (SELECT *, mean_group1 - mean_group2 AS delta_mean, CASE WHEN n1 < 2 OR n2 < 2 THEN 0 ELSE (mean_group1 - mean_group2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)) END AS cohens_d FROM (
        SELECT label, feature, count(*) FILTER (first) AS n1, count(*) FILTER (NOT first) AS n2, avg(value) FILTER (first) AS mean_group1, avg(value) FILTER (NOT first) AS mean_group2, var_samp(value) FILTER (first) AS v1, var_samp(value) FILTER (NOT first) AS v2 FROM lab GROUP BY ALL))""",
    "res": """res AS (SELECT 'f' || p_partkey AS feature, CASE WHEN p_partkey % 50 <> 0 THEN power(((p_partkey * 7919) % 100003 + 1) / 100004.0::DOUBLE, 3) END AS p_value, (p_size - 25) / 10.0::DOUBLE AS cohens_d, (p_size - 25) / 50.0::DOUBLE AS delta_mean FROM part)""",
    "ranked": "ranked AS (SELECT *, coalesce(p_value, 1) AS p, count(*) OVER () AS n, row_number() OVER (ORDER BY coalesce(p_value, 1), feature) AS k FROM res)",
    "adj": """adj AS (SELECT feature, p_value, cohens_d, delta_mean, CASE WHEN p_value IS NOT NULL THEN least(1, min(p * n / k) OVER (ORDER BY k DESC)) END AS q_value FROM ranked)""",
    "fsets": "fsets AS (SELECT DISTINCT * FROM (SELECT p_brand AS pathway, 'f' || p_partkey AS gene FROM part UNION ALL SELECT p_type, 'f' || p_partkey FROM part))",
    "fis0": """fis0 AS (SELECT pathway, count(*) AS n_pathway, count(*) FILTER (q_value < 0.2) AS n_overlap, (SELECT count(*) FROM adj WHERE q_value < 0.2) AS n_significant, (SELECT count(*) FROM adj) AS n_background,
        list_sort(coalesce(list(gene) FILTER (q_value < 0.2), [])) AS overlap_genes FROM fsets JOIN adj ON gene = feature GROUP BY pathway)""",
    "fis": """fis AS (SELECT *, (n_overlap * (n_background - n_significant - n_pathway + n_overlap))::DOUBLE / ((n_significant - n_overlap) * (n_pathway - n_overlap)) AS odds_ratio,
        list_sum(list_transform(range(n_overlap, least(n_significant, n_pathway) + 1), lambda k: CASE WHEN n_background - n_pathway - n_significant + k >= 0 THEN exp(
          lgamma(n_pathway + 1) - lgamma(k + 1) - lgamma(n_pathway - k + 1) + lgamma(n_background - n_pathway + 1) - lgamma(n_significant - k + 1) - lgamma(n_background - n_pathway - n_significant + k + 1)
          - lgamma(n_background + 1) + lgamma(n_significant + 1) + lgamma(n_background - n_significant + 1)) ELSE 0 END)) AS p_value FROM fis0)""",
    "enr": """enr AS (SELECT * EXCLUDE p_value, round(p_value, 10) + 0.0 AS p_value, round(least(1, min(p_value * m / k) OVER (ORDER BY k DESC)), 10) + 0.0 AS q_value FROM (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p_value, pathway) AS k FROM fis))""",
    "metric": "metric AS (SELECT feature AS gene, CASE WHEN cohens_d < 0 THEN log10(p_value) ELSE -log10(p_value) END AS metric FROM res WHERE p_value IS NOT NULL)",
    "bonus": "bonus AS (SELECT gene, sum(-log10(q_value)) AS enrichment_bonus FROM (SELECT unnest(overlap_genes) AS gene, q_value FROM enr) GROUP BY gene)",
    "rc": "rc AS (SELECT feature AS cpg_id, delta_mean AS effect_size, q_value, abs(delta_mean) * -log10(coalesce(q_value, 1e-300)) AS score FROM adj ORDER BY score DESC, cpg_id LIMIT 100)",
    "rg": """rg AS (SELECT feature AS gene, cohens_d AS effect_size, q_value, delta_mean, coalesce(q_value <= 0.05, false) AS significant, abs(cohens_d) * -log10(coalesce(q_value, 1e-300)) AS diff_score, coalesce(enrichment_bonus, 0) AS enrichment_bonus,
        abs(cohens_d) * -log10(coalesce(q_value, 1e-300)) + 0.5 * coalesce(enrichment_bonus, 0) AS score FROM adj LEFT JOIN bonus ON gene = feature ORDER BY score DESC, 1 LIMIT 50)""",
    "rp": "rp AS (SELECT pathway, q_value, p_value, odds_ratio, n_overlap, CASE WHEN odds_ratio > 0 AND isfinite(odds_ratio) THEN abs(log2(odds_ratio)) * -log10(q_value) END AS score FROM enr ORDER BY score DESC NULLS LAST, pathway LIMIT 20)",
    "names": "names AS (SELECT DISTINCT p_brand AS pathway_id, 'Name of ' || p_brand AS pathway_name FROM part WHERE p_brand LIKE '%1')",
    "raw": """raw AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'chr' || (o_orderkey % 30) || '_' || o_orderkey WHEN 1 THEN 'chrX_' || o_orderkey WHEN 2 THEN 'cg' || o_orderkey WHEN 3 THEN 'chr1_x9' ELSE 'chr2_' || o_orderkey END AS site FROM orders)""",
    "ok": r"""ok AS (SELECT *, regexp_matches(site, '^(chr([1-9]|1[0-9]|2[0-2]|X|Y|M))_([0-9]+)$') AS valid FROM raw)""",
    "sheets": """sheets AS (SELECT upper(trim(code)) AS barcode, CASE lower(trim(kind)) WHEN 'crc' THEN 'CRC' WHEN 'polyp' THEN 'polyps' WHEN 'healthy' THEN 'Control' ELSE trim(kind) END AS clinical_category, source_sheet FROM (
        SELECT 'bc-' || c_custkey AS code, CASE c_custkey % 4 WHEN 0 THEN 'CRC' WHEN 1 THEN 'Polyp' WHEN 2 THEN 'healthy' ELSE c_mktsegment END AS kind, 'CLIN_A' AS source_sheet FROM customer WHERE c_custkey % 2 = 0
        UNION ALL SELECT 'BC-' || c_custkey, upper(CASE c_custkey % 4 WHEN 0 THEN 'CRC' WHEN 1 THEN 'Polyp' WHEN 2 THEN 'healthy' ELSE c_mktsegment END), 'CLIN_B' FROM customer WHERE (c_custkey % 2 = 1 OR c_custkey % 3 = 0) AND c_custkey % 15 <> 0))""",
    "merged": "merged AS (SELECT barcode, clinical_category, source_sheet FROM (SELECT *, row_number() OVER (PARTITION BY barcode ORDER BY source_sheet) AS n FROM sheets) WHERE n = 1)",
}

# what each needs before it
NEEDS = {
    "site_genes": ["dims"], "gene_sets": ["dims"], "gf": ["cells", "site_genes"], "cov": ["cells"], "stats": ["cells"], "hits": ["points", "genes"], "mapped": ["hits"], "ctx": ["points", "islands"],
    "thr": ["gf", "meta", "q"], "hms": ["thr"], "lab": ["cells", "meta"], "eff": ["lab"], "ranked": ["res"], "adj": ["ranked"], "fis0": ["fsets", "adj"], "fis": ["fis0"], "enr": ["fis"], "metric": ["res"],
    "bonus": ["enr"], "rc": ["adj"], "rg": ["bonus"], "rp": ["enr"], "ok": ["raw"], "merged": ["sheets"],
}


def sql(name: str, body: str, *ctes: str) -> None:
    order: list[str] = []

    def need(c: str) -> None:
        for x in NEEDS.get(c, []):
            need(x)
        if c not in order:
            order.append(c)

    for c in ctes:
        need(c)
    ORACLES[name] = ("WITH " + ",\n".join(CTES[c] for c in order) + "\n" if order else "") + body


def r(expr: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expr}, {digits}) + 0.0 AS {name or expr}"


def rs(names: str, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names.split())


sql("long_matrix", f"SELECT sample_id::VARCHAR AS sample_id, chrom, pos, cpg_id, {r('v', 'beta')} FROM (SELECT vec_id AS sample_id, 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id, v::DOUBLE AS v FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS d FROM embeddings))")
sql("wide_matrix", "SELECT gene, " + ", ".join(r(f"avg(value) FILTER (clinical_category = '{i}')", f"c{i}") for i in range(10)) + " FROM gf JOIN meta USING (sample_id) GROUP BY gene", "gf", "meta")
sql("id_parse", r"""SELECT o_orderkey, site, valid, CASE WHEN valid THEN split_part(site, '_', 1) END AS chrom, CASE WHEN valid THEN split_part(site, '_', 2)::BIGINT END AS pos,
  CASE WHEN site LIKE '%\_%' ESCAPE '\' THEN split_part(site, '_', 1) ELSE '' END AS fast_chrom, try_cast(split_part(site, '_', -1) AS BIGINT) AS fast_pos,
  CASE WHEN NOT valid THEN 99 WHEN site LIKE 'chrX%' THEN 22 ELSE try_cast(substr(split_part(site, '_', 1), 4) AS INTEGER) - 1 END::INTEGER AS chrom_idx FROM ok""", "ok")
sql("id_make", "SELECT cpg_id AS made, pos - 10 < 5000 AND 1000 < pos + 10 AS near FROM points", "points")
sql("id_sort", r"""SELECT site, row_number() OVER (ORDER BY NOT valid, CASE WHEN NOT valid THEN 99 WHEN site LIKE 'chrX%' THEN 22 ELSE try_cast(substr(split_part(site, '_', 1), 4) AS INTEGER) - 1 END, CASE WHEN valid THEN split_part(site, '_', 2)::BIGINT END, site)::INTEGER AS ord
  FROM (SELECT DISTINCT site, valid FROM ok)""", "ok")
sql("chrom_histogram", "SELECT split_part(site, '_', 1) AS chrom, count(DISTINCT site) AS n_sites FROM ok WHERE valid GROUP BY 1", "ok")
sql("coverage", f"SELECT cpg_id, n_present, n_total, {r('coverage')} FROM cov", "cov")
sql("coverage_filter", f"SELECT cpg_id, {r('coverage')}, coverage >= 0.909 AS kept FROM cov", "cov")
sql("coverage_kept_cells", f"SELECT chrom, count(*) AS n, {r('sum(beta)', 'total', 4)} FROM cells WHERE cpg_id IN (SELECT cpg_id FROM cov WHERE coverage >= 0.909) GROUP BY chrom", "cov")
sql("cpg_stats", f"SELECT cpg_id, chromosome, position, {rs('mean_beta variance missingness')}, n_samples FROM stats", "stats")
sql("variance_filter", f"SELECT cpg_id, chromosome, position, {rs('mean_beta variance missingness')}, n_samples FROM stats WHERE variance >= 0.0155 AND missingness <= 1 - 0.909", "stats")
sql("dataset_stats", "SELECT count(*) AS n_sites, sum(n_total - n_present)::BIGINT AS total_nulls, " + r("sum(n_total - n_present) / sum(n_total)", "null_fraction") + ", " + ", ".join(f"count(*) FILTER (coverage >= {c / 100}) AS n_cov_{c}" for c in (95, 90, 80, 50)) + ", (SELECT count(DISTINCT sample_id) FROM cells) AS n_samples FROM cov", "cov")
sql("value_stats", f"SELECT {r('avg(beta)', 'mean')}, {r('median(beta)', 'median')}, {r('stddev_pop(beta)', 'std')} FROM cells WHERE cpg_id IN (SELECT DISTINCT cpg_id FROM cells QUALIFY dense_rank() OVER (ORDER BY chrom, pos) <= 100)", "cells")
sql("site_select", "SELECT cpg_id, count(beta) AS n FROM cells WHERE cpg_id IN ('chr1_1000', 'chr2_2000', 'chr4_64000') GROUP BY cpg_id", "cells")
sql("store_sites", f"SELECT chrom, pos, cpg_id, count(beta) AS n, {r('sum(beta)', 'total', 4)} FROM cells WHERE cpg_id IN ('chr1_1000', 'chr2_2000', 'chr4_64000') GROUP BY ALL", "cells")
sql("store_sites_joined", f"SELECT cpg_id, count(beta) AS n, {r('sum(beta)', 'total', 4)} FROM cells WHERE cpg_id IN (SELECT cpg_id FROM site_genes WHERE gene IN ('g1', 'g5')) GROUP BY cpg_id", "cells", "site_genes")
sql("store_value_stats", f"SELECT {r('avg(beta)', 'mean')}, {r('median(beta)', 'median')}, {r('stddev_pop(beta)', 'std')} FROM cells WHERE cpg_id IN (SELECT cpg_id FROM cov ORDER BY split_part(cpg_id, '_', 1), split_part(cpg_id, '_', 2)::INTEGER LIMIT 20)", "cells", "cov")
sql("store_dictionary", "SELECT row_number() OVER (ORDER BY chrom, pos) AS ord, cpg_id, chrom, pos, count(*) AS n_cells FROM cells GROUP BY cpg_id, chrom, pos", "cells")
sql("store_counts", "SELECT chrom, count(DISTINCT pos) AS n_sites, count(*) AS n_cells FROM cells GROUP BY chrom", "cells")
sql("row_chunks", "SELECT (n - 1) // 100 AS chunk, count(*) AS n, min(o_orderkey) AS first, max(o_orderkey) AS last FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY ALL")
sql("running_totals", """SELECT o_orderkey, row_number() OVER w AS n, (sum(price) OVER w)::DOUBLE AS total, min(o_custkey) OVER w AS least_customer FROM (SELECT *, o_totalprice::DECIMAL(18, 2) AS price FROM orders)
  WINDOW w AS (ORDER BY price DESC, o_orderkey ROWS UNBOUNDED PRECEDING)""")
sql("tied_ranks", "SELECT l_orderkey, l_linenumber, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank FROM lineitem")
sql("gene_overlap", "SELECT * FROM hits", "hits")
sql("gene_overlap_intergenic", "SELECT * FROM mapped", "mapped")
sql("island_context", "SELECT * FROM ctx", "ctx")
sql("region_overlap", "SELECT cpg_id, arg_min(g.chrom || ':' || s || '-' || e, (s, g.chrom || ':' || s || '-' || e)) AS region_id FROM points p JOIN genes g ON p.chrom = g.chrom AND pos - 1 >= s AND pos - 1 < e GROUP BY cpg_id", "points", "genes")
sql("region_overlap_one_based", "SELECT cpg_id, arg_min(g.chrom || ':' || s || '-' || e, (s, g.chrom || ':' || s || '-' || e)) AS region_id FROM points p JOIN genes g ON p.chrom = g.chrom AND pos >= s AND pos < e GROUP BY cpg_id", "points", "genes")
CELL = "(vec_id * 31 + d) % 11"
sql("csv_header", "SELECT (d + 2)::INTEGER AS idx, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id, 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos FROM (SELECT unnest(range(64)) AS d)")
sql("csv_parse", f"""SELECT 's' || vec_id AS sample_id, (vec_id + 1)::BIGINT AS sample_ord, 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id,
  CASE {CELL} WHEN 0 THEN '' WHEN 1 THEN 'NA' WHEN 2 THEN 'NaN' WHEN 3 THEN 'x' || d WHEN 4 THEN ' 12 ' ELSE round(v * 1000)::INTEGER::VARCHAR END AS raw,
  CASE WHEN {CELL} = 4 THEN 12 WHEN {CELL} > 4 THEN round(v * 1000) + 0.0 END::DOUBLE AS beta FROM (SELECT vec_id, d, embedding[d + 1]::DOUBLE AS v FROM (SELECT vec_id, embedding, unnest(range(CASE WHEN vec_id % 7 = 0 THEN 60 ELSE 64 END)) AS d FROM embeddings))""")
sql("csv_convert", f"""SELECT *, count(*) OVER (PARTITION BY chrom) AS chrom_sites, (sum(n_bad) OVER ())::BIGINT AS all_bad FROM (
  SELECT 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id, count(*) AS n_cells, count(*) FILTER ({CELL} >= 4) AS n_present, count(*) FILTER ({CELL} = 3) AS n_bad,
    sum(CASE WHEN {CELL} = 4 THEN 12 WHEN {CELL} > 4 THEN round(embedding[d + 1]::DOUBLE * 1000) END)::DOUBLE AS total, 's' || min(vec_id) AS first_sample
  FROM (SELECT vec_id, embedding, unnest(range(CASE WHEN vec_id % 7 = 0 THEN 60 ELSE 64 END)) AS d FROM embeddings) WHERE d % 4 <> 2 GROUP BY d)""")
sql("sorted_p", "SELECT feature, row_number() OVER (ORDER BY CASE WHEN substr(feature, 2)::INTEGER % 77 = 0 THEN 'nan'::DOUBLE ELSE round(p_value, 4) END NULLS LAST, feature) AS place FROM res", "res")
sql("point_lookup", "SELECT gene_id, s AS start, e AS \"end\" FROM genes WHERE chrom = 'chr2' AND s < 800501 AND e > 800500", "genes")
sql("rollup_mean", f"SELECT gene, sample_id, {r('value')}, n_cpgs FROM gf", "gf")
sql("rollup_median", f"SELECT gene, sample_id, {r('median(beta)', 'value')}, count(beta) AS n_cpgs FROM cells JOIN site_genes USING (cpg_id) GROUP BY ALL", "gf")
sql("rollup_weighted", f"SELECT gene, sample_id, {r('sum(beta * (d + 1)) / sum(CASE WHEN beta IS NOT NULL THEN d + 1 END)', 'value')}, count(beta) AS n_cpgs FROM cells JOIN site_genes USING (cpg_id) GROUP BY gene, sample_id", "gf")
sql("rollup_by_chrom", f"""SELECT gene, sample_id, {r('avg(v)', 'value')} FROM (SELECT gene, sample_id, chrom, avg(beta) AS v FROM cells JOIN sg USING (cpg_id) GROUP BY ALL) WHERE gene IN (SELECT gene FROM sg GROUP BY gene HAVING count(*) >= 3) GROUP BY ALL""".replace("sg", "(SELECT * FROM site_genes WHERE gene <> 'g3' OR cpg_id LIKE 'chr1%')"), "gf")
sql("pathway_rollup", f"SELECT s AS pathway, sample_id, {r('avg(value)', 'value')}, count(value) AS n_members FROM gf JOIN gene_sets USING (gene) GROUP BY ALL", "gf", "gene_sets")
sql("term_rollup", f"SELECT s AS term, sample_id, {r('median(value)', 'value')}, count(value) AS n_members FROM gf JOIN gene_sets USING (gene) GROUP BY ALL", "gf", "gene_sets")
sql("hms_threshold", f"SELECT gene, quantile, {r('threshold')} FROM thr", "thr")
sql("hms_score", "SELECT * FROM hms", "hms")
sql("hms_summary", f"SELECT quantile, clinical_category, count(*) AS n, {r('avg(hms_count)', 'mean')}, {r('median(hms_count)', 'median')}, max(hms_count) AS max FROM hms GROUP BY ALL", "hms")
sql("hms_digest", "SELECT quantile, string_agg(clinical_category || '=' || printf('%.1f', m), '; ' ORDER BY clinical_category) AS hms_summary FROM (SELECT quantile, clinical_category, avg(hms_count) AS m FROM hms GROUP BY ALL) GROUP BY quantile", "hms")
sql("effect_size", f"SELECT label, feature, n1, n2, {rs('mean_group1 mean_group2 delta_mean cohens_d')} FROM eff", "eff")

MWU = """SELECT label, feature, n1, n2, r1 - n1 * (n1 + 1) / 2 AS u, n1 * n2 AS nn, sqrt(n1 * n2 / 12 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS s FROM (
  SELECT label, feature, count(*) FILTER (first) AS n1, count(*) FILTER (NOT first) AS n2, sum(rk) FILTER (first) AS r1, sum(t * t - 1)::DOUBLE AS ties FROM (
    SELECT *, rank() OVER (PARTITION BY label, feature ORDER BY value) + (count(*) OVER (PARTITION BY label, feature, value) - 1) / 2 AS rk, count(*) OVER (PARTITION BY label, feature, value) AS t FROM LAB) GROUP BY ALL)"""
Z = r("(greatest(u, nn - u) - nn / 2 - 0.5) / s", "z")
sql("mwu_stat", f"SELECT label, feature, n1, n2, {r('u', 'statistic')}, {Z} FROM ({MWU.replace('LAB', 'lab')})", "lab")
sql("mwu_ties", f"SELECT label, feature, {r('u', 'statistic')}, {Z} FROM ({MWU.replace('LAB', '(SELECT label, feature, first, round(value, 1) AS value FROM lab)')})", "lab")
sql("welch_stat", f"SELECT label, feature, {r('delta_mean / sqrt(v1 / n1 + v2 / n2)', 'statistic', 5)}, {r('power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1))', 'df', 5)} FROM eff", "eff")
sql("ks_stat", f"""SELECT label, feature, {r('max(abs(a / n1 - b / n2))', 'statistic')} FROM (SELECT label, feature, count(*) FILTER (first) OVER w AS a, count(*) FILTER (NOT first) OVER w AS b, count(*) FILTER (first) OVER t AS n1, count(*) FILTER (NOT first) OVER t AS n2
  FROM lab WINDOW w AS (PARTITION BY label, feature ORDER BY value RANGE UNBOUNDED PRECEDING), t AS (PARTITION BY label, feature)) GROUP BY ALL""", "lab")
SIMPSON = "list_sum(list_transform(range(4001), lambda k: (CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * {f}))"
NORMAL_P = "least(1, 1 - 2 * z / 12000 * " + SIMPSON.format(f="exp(-power(k * z / 4000, 2) / 2)") + " / sqrt(2 * pi()))"
STUDENT_P = "1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * th / 12000 * " + SIMPSON.format(f="power(cos(k * th / 4000), df - 1)")
TESTED = """SELECT label, feature, {cols}, {p}, {q}, coalesce(q <= 0.05, false) AS significant FROM (
  SELECT *, least(1, min(p * n / k) OVER (PARTITION BY label ORDER BY k DESC)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY p, feature) AS k FROM ({found})))"""


def tested(found: str) -> str:
    return TESTED.format(cols=rs("mean_group1 mean_group2 delta_mean cohens_d statistic"), p=r("p", "p_value", 8), q=r("q", "q_value", 8), found=found)


sql("all_contrasts", tested(f"SELECT *, {NORMAL_P} AS p FROM (SELECT *, u AS statistic, (greatest(u, nn - u) - nn / 2 - 0.5) / s AS z FROM eff JOIN ({MWU.replace('LAB', 'lab')}) USING (label, feature))"), "eff")
sql("compare_pvalues", tested(f"SELECT *, {STUDENT_P} AS p FROM (SELECT *, atan(abs(statistic) / sqrt(df)) AS th FROM (SELECT *, delta_mean / sqrt(v1 / n1 + v2 / n2) AS statistic, power(v1 / n1 + v2 / n2, 2) / (power(v1 / n1, 2) / (n1 - 1) + power(v2 / n2, 2) / (n2 - 1)) AS df FROM eff))"), "eff")
EXACT = """SELECT feature, n1, n2, {stat}, {p} FROM (
  SELECT feature, o.n1, o.n2, any_value(o.x) AS x, count(*) FILTER (w.x >= o.least) / count(*) AS share FROM ({observed}) o JOIN (
    SELECT n1, n2, {of_mask} AS x FROM (SELECT n1, n2, unnest(range(1 << (n1 + n2)::INTEGER)) AS m FROM (SELECT DISTINCT n1, n2 FROM ({observed})))  WHERE bit_count(m) = n1
  ) w ON o.n1 = w.n1 AND o.n2 = w.n2 GROUP BY ALL)"""
SMALL = "(SELECT cpg_id AS feature, sample_id < 7 AS first, beta AS value FROM cells WHERE sample_id < 16 AND beta IS NOT NULL)"
U = f"SELECT *, greatest(x, n1 * n2 - x) AS least FROM (SELECT feature, count(*) FILTER (first) AS n1, count(*) FILTER (NOT first) AS n2, sum(rk) FILTER (first) - n1 * (n1 + 1) / 2 AS x FROM (SELECT *, rank() OVER (PARTITION BY feature ORDER BY value) AS rk FROM {SMALL}) GROUP BY feature)"
sql("mwu_exact", EXACT.format(stat=r("x", "statistic", 8), p=r("least(1, 2 * share)", "p_value", 8), observed=U, of_mask="list_sum(list_transform(range(n1 + n2), lambda i: ((m >> i::INTEGER) & 1) * (i + 1))) - n1 * (n1 + 1) / 2"), "cells")
D = f"""SELECT feature, any_value(n1) AS n1, any_value(n2) AS n2, max(abs(a * n2 - b * n1)) / any_value(n1 * n2) AS x, max(abs(a * n2 - b * n1)) AS least FROM (SELECT feature, count(*) FILTER (first) OVER w AS a, count(*) FILTER (NOT first) OVER w AS b, count(*) FILTER (first) OVER t AS n1, count(*) FILTER (NOT first) OVER t AS n2
  FROM {SMALL} WINDOW w AS (PARTITION BY feature ORDER BY value RANGE UNBOUNDED PRECEDING), t AS (PARTITION BY feature)) GROUP BY feature"""
sql("ks_exact", EXACT.format(stat=r("x", "statistic", 8), p=r("share", "p_value", 8), observed=D, of_mask="list_max(list_transform(range(1, n1 + n2 + 1), lambda i: abs(bit_count(m & ((1 << i::INTEGER) - 1)) * n2 - (i - bit_count(m & ((1 << i::INTEGER) - 1))) * n1)))"), "cells")

FDR = {
    "fdr_bh": "min(p * n / k) OVER (ORDER BY k DESC)",
    "fdr_by": "min(p * n * (SELECT sum(1 / i) FROM (SELECT unnest(range(1, (SELECT count(*) FROM res) + 1)) AS i)) / k) OVER (ORDER BY k DESC)",
    "fdr_bonferroni": "p * n",
    "fdr_holm": "max(p * (n - k + 1)) OVER (ORDER BY k)",
}
for _name, _q in FDR.items():
    sql(_name, f"SELECT feature, {rs('p_value cohens_d delta_mean q_value', 8)}, coalesce(q_value <= 0.05, false) AS significant FROM (SELECT *, CASE WHEN p_value IS NOT NULL THEN least(1, {_q}) END AS q_value FROM ranked)", "ranked")
for _m in ("by", "holm", "bonferroni"):
    ORACLES[f"fdr_large_{_m}"] = ORACLES[f"fdr_{_m}"]
sql("fdr_large", f"SELECT feature, {rs('q_value', 8)}, coalesce(q_value <= 0.05, false) AS significant FROM adj", "adj")
sql("fisher_enrich", f"SELECT pathway, {rs('odds_ratio p_value')}, n_overlap, n_significant, n_pathway, n_background FROM fis", "fis")
sql("rank_metric", f"SELECT gene, {r('metric')} FROM metric", "metric")
sql("gsea_es", f"""SELECT pathway, {r('CASE WHEN n_hits IN (0, n) THEN 0 WHEN abs(hi) + 1e-12 >= abs(lo) THEN hi ELSE lo END', 'es')}, n_genes, n_hits FROM (SELECT pathway, max(es) AS hi, min(es) AS lo, any_value(n_genes) AS n_genes, any_value(n_hits) AS n_hits, any_value(n) AS n FROM (
  SELECT pathway, n_genes, n_hits, n, sum(CASE WHEN hit THEN abs(metric) / norm ELSE -1.0::DOUBLE / (n - n_hits) END) OVER (PARTITION BY pathway ORDER BY metric DESC, gene ROWS UNBOUNDED PRECEDING) AS es FROM (
    SELECT s.pathway, m.gene, m.metric, f.gene IS NOT NULL AS hit, s.n_genes, sum(CASE WHEN f.gene IS NOT NULL THEN abs(m.metric) END) OVER p AS norm, count(f.gene) OVER p AS n_hits, count(*) OVER p AS n
    FROM (SELECT pathway, count(*) AS n_genes FROM fsets GROUP BY pathway) s CROSS JOIN metric m LEFT JOIN fsets f ON f.pathway = s.pathway AND f.gene = m.gene WINDOW p AS (PARTITION BY s.pathway))) GROUP BY pathway)""", "metric", "fsets")


def gsea(permutations: int, seed: int) -> str:
    """CTEs that end in gsea (pathway, es, nes, p_value, n_genes, n_hits): random sets are the first places by md5 of seed, permutation and place."""
    return f"""places AS (SELECT gene, abs(metric) AS w, row_number() OVER (ORDER BY metric DESC, gene) AS place, count(*) OVER () AS n FROM metric),
hit AS (SELECT pathway, place, w, n, count(*) OVER s AS n_genes, count(place) OVER s AS n_hits, sum(w) OVER s AS norm FROM fsets LEFT JOIN places USING (gene) WINDOW s AS (PARTITION BY pathway)),
observed AS (SELECT pathway, n_genes, n_hits, round(CASE WHEN greatest(max(up), 0) + 1e-12 >= -least(min(up - step), CASE WHEN sum(step) = 0 THEN -1 ELSE 0 END) THEN greatest(max(up), 0) ELSE least(min(up - step), CASE WHEN sum(step) = 0 THEN -1 ELSE 0 END) END, 10) AS es FROM (
  SELECT pathway, n_genes, n_hits, w / coalesce(nullif(norm, 0), 1) AS step, sum(w) OVER r / coalesce(nullif(norm, 0), 1) - (place - row_number() OVER r) / (n - n_hits)::DOUBLE AS up
  FROM hit WHERE place IS NOT NULL AND n_hits < n WINDOW r AS (PARTITION BY pathway ORDER BY place ROWS UNBOUNDED PRECEDING)) GROUP BY ALL),
sizes AS (SELECT DISTINCT n_hits FROM observed),
drawn AS (SELECT p, place, w, n, row_number() OVER (PARTITION BY p ORDER BY h, place) AS k FROM (SELECT p, place, w, n, md5('{seed}/' || p || '/' || place) AS h FROM places, (SELECT unnest(range(1, {permutations} + 1)) AS p))),
walk AS (SELECT n_hits, p, w / coalesce(nullif(sum(w) OVER (PARTITION BY n_hits, p), 0), 1) AS step,
  sum(w) OVER r / coalesce(nullif(sum(w) OVER (PARTITION BY n_hits, p), 0), 1) - (place - row_number() OVER r) / (n - n_hits)::DOUBLE AS up
  FROM drawn JOIN sizes ON k <= n_hits WINDOW r AS (PARTITION BY n_hits, p ORDER BY place ROWS UNBOUNDED PRECEDING)),
nulls AS (SELECT n_hits, p, round(CASE WHEN greatest(max(up), 0) + 1e-12 >= -least(min(up - step), CASE WHEN sum(step) = 0 THEN -1 ELSE 0 END) THEN greatest(max(up), 0) ELSE least(min(up - step), CASE WHEN sum(step) = 0 THEN -1 ELSE 0 END) END, 10) AS v FROM walk GROUP BY n_hits, p),
gsea AS (SELECT pathway, es, n_genes, n_hits, coalesce(es / nullif(avg(abs(v)), 0), 0) AS nes, greatest(count(*) FILTER (CASE WHEN es >= 0 THEN v >= es ELSE v <= es END) / {permutations}::DOUBLE, 1 / ({permutations} + 1)::DOUBLE) AS p_value
  FROM observed JOIN nulls USING (n_hits) GROUP BY pathway, es, n_genes, n_hits)"""


CTES["gsea1000"], CTES["gsea200"] = gsea(1000, 42), gsea(200, 7)
CTES["gadj"] = """gadj AS (SELECT pathway, round(es, 8) + 0.0 AS es, round(nes, 8) + 0.0 AS nes, round(p_value, 8) + 0.0 AS p_value, n_genes, n_hits, round(q, 8) + 0.0 AS q_value, q <= 0.05 AS significant FROM (
  SELECT *, least(1, min(p_value * m / k) OVER (ORDER BY k DESC)) AS q FROM (SELECT *, count(*) OVER () AS m, row_number() OVER (ORDER BY p_value, pathway) AS k FROM gsea)))"""
NEEDS |= {"gsea1000": ["metric", "fsets"], "gsea200": ["metric", "fsets"], "gadj": ["gsea200"]}
sql("gsea_perm", f"SELECT pathway, n_genes, n_hits, p_value, {rs('es nes')} FROM gsea", "gsea1000")
sql("gsea_enrichment", "SELECT * FROM gadj", "gadj")
sql("rank_pathway_nes", f"SELECT pathway, n_hits, {rs('q_value p_value nes es score', 5)} FROM (SELECT *, abs(nes) * -log10(greatest(q_value, 1e-300)) AS score FROM gadj ORDER BY score DESC, pathway LIMIT 20)", "gadj")
sql("rank_cpg", f"SELECT cpg_id, {rs('effect_size q_value score')}, length(cpg_id)::INTEGER AS width FROM rc", "rc")
sql("rank_gene", f"SELECT gene, {rs('effect_size q_value delta_mean diff_score')}, significant, 0.0::DOUBLE AS enrichment_bonus, {r('diff_score', 'score')} FROM (SELECT feature AS gene, cohens_d AS effect_size, q_value, delta_mean, coalesce(q_value <= 0.05, false) AS significant, abs(cohens_d) * -log10(coalesce(q_value, 1e-300)) AS diff_score FROM adj ORDER BY 6 DESC, 1 LIMIT 50)", "adj")
sql("rank_gene_bonus", f"SELECT gene, significant, {rs('effect_size q_value delta_mean diff_score enrichment_bonus score', 5)} FROM rg", "rg")
sql("rank_pathway", f"SELECT pathway, n_overlap, {rs('q_value p_value odds_ratio score', 5)} FROM rp", "rp")
sql("report_union", f"""SELECT level, identifier, {rs('score effect_size q_value', 5)}, rank, pathways, '' AS cpg_island_context, '' AS hms_summary FROM (
  SELECT 'cpg' AS level, cpg_id AS identifier, score, effect_size, q_value, row_number() OVER (ORDER BY score DESC, cpg_id) AS rank, '' AS pathways FROM rc
  UNION ALL SELECT 'gene', gene, score, effect_size, q_value, row_number() OVER (ORDER BY score DESC, gene), coalesce((SELECT string_agg(pathway, '; ' ORDER BY p_value, pathway) FROM enr WHERE list_contains(overlap_genes, rg.gene)), '') FROM rg
  UNION ALL SELECT 'pathway', pathway, score, odds_ratio, q_value, row_number() OVER (ORDER BY score DESC NULLS LAST, pathway), '' FROM rp)""", "rc", "rg", "rp")
sql("gene_island_context", "SELECT gene_symbol, context AS cpg_island_status FROM mapped JOIN ctx USING (cpg_id) WHERE gene_symbol <> ''", "mapped", "ctx")
sql("island_digest", "SELECT gene_symbol AS gene, string_agg(context || ':' || n || '/' || t, '; ' ORDER BY n DESC, context) AS cpg_island_context FROM (SELECT *, sum(n) OVER (PARTITION BY gene_symbol) AS t FROM (SELECT gene_symbol, context, count(*) AS n FROM mapped JOIN ctx USING (cpg_id) WHERE gene_symbol <> '' GROUP BY ALL)) GROUP BY gene_symbol", "mapped", "ctx")
sql("pathway_list", "SELECT gene, string_agg(pathway, '; ' ORDER BY round(p_value, 6), pathway) AS pathways FROM (SELECT unnest(overlap_genes) AS gene, pathway, p_value FROM enr) GROUP BY gene", "enr")
sql("biomarker_flags", "SELECT feature AS cpg_id, feature IN (SELECT cpg_id FROM rc ORDER BY score DESC, cpg_id LIMIT 10) AS is_biomarker_candidate FROM res", "rc")
sql("overlap_freq", "SELECT overlap_type, count(*) AS n FROM mapped GROUP BY 1", "mapped")
sql("overlap_shares", "SELECT overlap_type, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM mapped), 1) AS pct FROM mapped GROUP BY 1", "mapped")
sql("distinct_counts", "SELECT count(*) AS n_rows, count(DISTINCT cpg_id) AS n_sites, count(DISTINCT gene_symbol) FILTER (gene_symbol <> '') AS n_genes FROM mapped", "mapped")
sql("comparison_summary", "SELECT count(*) AS n_genes, count(*) FILTER (p_value < 0.05) AS n_nominal, count(*) FILTER (q_value <= 0.05) AS n_significant FROM adj", "adj")
sql("top_significant", f"SELECT feature, {rs('p_value', 9)} FROM adj WHERE q_value <= 0.05 ORDER BY adj.p_value, feature LIMIT 15", "adj")
sql("enrichment_named", "SELECT pathway, n_overlap, left(coalesce(pathway_name, pathway), 12) AS display_name FROM fis LEFT JOIN names ON pathway = pathway_id", "fis", "names")
sql("volcano_class", f"SELECT feature, {r('delta_mean')}, {r('-log10(p_value)', 'neg_log10_p')}, CASE WHEN q_value < 0.05 AND abs(adj.delta_mean) >= 0.3 THEN 'blue' WHEN q_value < 0.05 THEN 'red' ELSE 'grey' END AS point_class FROM adj WHERE p_value IS NOT NULL", "adj")
sql("volcano_labels", f"SELECT feature, {r('w', 'weight')} FROM (SELECT feature, -log10(p_value) * abs(delta_mean) AS w FROM adj WHERE p_value IS NOT NULL ORDER BY w DESC, feature LIMIT 10)", "adj")
sql("dotplot_data", f"SELECT pathway, coalesce(pathway_name, pathway) AS display_name, {r('-log10(q_value)', 'neg_log10_q', 5)}, n_overlap, {rs('odds_ratio', 5)} FROM (SELECT * FROM enr ORDER BY round(p_value, 8), pathway LIMIT 20) LEFT JOIN names ON pathway = pathway_id", "enr", "names")
sql("violin_data", "SELECT * FROM hms WHERE clinical_category NOT IN ('8', '9')", "hms")
sql("topk_variance", f"SELECT gene, {r('v', 'variance')} FROM (SELECT gene, var_pop(value) AS v FROM gf GROUP BY gene ORDER BY v DESC, gene LIMIT 5)", "gf")
CTES["hm"] = """hm AS (SELECT clinical_category AS g, sample_id, gene, greatest(-3, least(3, coalesce((value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0), 0))) AS z FROM gf JOIN meta USING (sample_id) WHERE gene IN (SELECT gene FROM gf GROUP BY gene ORDER BY var_pop(value) DESC, gene LIMIT 5) WINDOW g AS (PARTITION BY gene))"""
CTES["hcols"] = """hcols AS (SELECT g, sample_id, first + i * cols // size AS col FROM (SELECT g, sample_id, row_number() OVER (PARTITION BY g ORDER BY sample_id) - 1 AS i FROM (SELECT DISTINCT g, sample_id FROM hm))
  JOIN (SELECT *, coalesce(sum(cols) OVER (ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS first FROM (SELECT g, count(*) AS size, greatest(1, least(count(*), round(count(*) * 30 / sum(count(*)) OVER ())))::BIGINT AS cols FROM (SELECT DISTINCT g, sample_id FROM hm) GROUP BY g)) USING (g))"""
CTES["vals"] = "vals AS (SELECT clinical_category AS g, hms_count::DOUBLE AS v FROM hms WHERE quantile = 0.95 AND clinical_category <> 'excluded')"
NEEDS |= {"vals": ["hms"], "hm": ["gf", "meta"], "hcols": ["hm"]}
sql("violin_density", f"""SELECT "group", n, at_ AS "at", {rs('q1 median q3 bandwidth x density')} FROM (
  SELECT g AS "group", at_, any_value(n) AS n, any_value(q1) AS q1, any_value(med) AS median, any_value(q3) AS q3, any_value(bw) AS bandwidth, any_value(x) AS x, sum(c * exp(-0.5 * pow((x - (lo + (b + 0.5) * step)) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS density FROM (
    SELECT *, CASE WHEN bw IS NULL THEN lo ELSE lo - 2 * bw + (hi - lo + 4 * bw) * at_ / 31 END AS x FROM (
      SELECT *, unnest(range(CASE WHEN bw IS NULL THEN 1 ELSE 32 END))::INTEGER AS at_ FROM (SELECT g, b, count(*) AS c, n, q1, med, q3, bw, lo, hi, step FROM (
        SELECT *, CASE WHEN step > 0 THEN least(floor((v - lo) / step), 99) ELSE 0 END AS b FROM (
          SELECT v.g, v.v, s.n, s.q1, s.med, s.q3, s.lo, s.hi, (s.hi - s.lo) / 100 AS step, CASE WHEN s.sd > 0 THEN s.sd * n ** -0.2 END AS bw FROM vals v
          JOIN (SELECT g, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) AS sd, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM vals GROUP BY g) s USING (g)))
      GROUP BY ALL))) GROUP BY g, at_)""", "vals")
sql("volcano_grid", """SELECT kind, ix, iy, count(*) AS n FROM (SELECT CASE WHEN q_value < 0.05 AND abs(adj.delta_mean) >= 0.3 THEN 'blue' WHEN q_value < 0.05 THEN 'red' ELSE 'grey' END AS kind,
  greatest(0, least(39, floor((round(adj.delta_mean, 6) + 1e-7 + 0.5) / 1.0 * 40)))::INTEGER AS ix, greatest(0, least(24, floor(-log10(p_value) / 12.0 * 25)))::INTEGER AS iy FROM adj WHERE p_value IS NOT NULL) GROUP BY ALL""", "adj")
sql("heatmap_columns", f"""SELECT gene AS feature, col AS "column", hm.g AS "group", count(DISTINCT hm.sample_id) AS n_samples, {r('avg(z)', 'value')} FROM hm JOIN hcols ON hm.sample_id = hcols.sample_id GROUP BY ALL""", "hcols")
sql("stitched", f"""SELECT vec_id::VARCHAR AS sample_id, row_number() OVER (PARTITION BY d ORDER BY vec_id DESC) AS sample_ord, 'chr' || (d % 4 + 1) AS chrom, ((d + 1) * 1000)::BIGINT AS pos, 'chr' || (d % 4 + 1) || '_' || ((d + 1) * 1000) AS cpg_id, {r('v::DOUBLE', 'beta')}
  FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(len(embedding))) AS d FROM embeddings) WHERE d % 4 < 3 AND d < 64""")
sql("stitched_order", """SELECT 'chr1' AS chrom, count(*) AS n_samples, 0::BIGINT AS n_missing, 0::BIGINT AS n_extra, 0::BIGINT AS n_moved FROM embeddings
UNION ALL SELECT 'chr2', count(b), count(*) - count(b), 0, count(*) FILTER (a <> b) FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id DESC) AS a FROM embeddings) LEFT JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id DESC) AS b FROM embeddings WHERE vec_id % 7 <> 0) USING (vec_id)
UNION ALL SELECT 'chr3', count(*), 0, 0, count(*) FILTER (a <> b) FROM (SELECT row_number() OVER (ORDER BY vec_id DESC) AS a, row_number() OVER (ORDER BY vec_id % 5 = 0, vec_id DESC) AS b FROM embeddings)""")
sql("zscore_heatmap", f"SELECT clinical_category, sample_id, gene, {r('greatest(-3, least(3, coalesce((value - avg(value) OVER g) / nullif(stddev_pop(value) OVER g, 0), 0)))', 'z')} FROM gf JOIN meta USING (sample_id) WHERE gene IN (SELECT gene FROM gf GROUP BY gene ORDER BY var_pop(value) DESC, gene LIMIT 5) WINDOW g AS (PARTITION BY gene)", "gf", "meta")
sql("barcode_norm", "SELECT c_custkey, upper(c_name) || CASE WHEN c_custkey % 7 = 0 THEN '!' ELSE '' END AS barcode, false AS valid FROM customer")
sql("category_norm", "SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'CRC' WHEN 1 THEN 'polyps' WHEN 2 THEN 'Control' WHEN 3 THEN 'excluded' WHEN 4 THEN 'HGD' ELSE c_mktsegment END AS category FROM customer")
sql("clinical_merge", "SELECT * FROM merged", "merged")
sql("keep_first", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1")
sql("exclusion_anti", "SELECT * FROM merged WHERE split_part(barcode, '-', 2)::INTEGER % 10 <> 0", "merged")
sql("symbol_map", "SELECT DISTINCT 'S' || (p_partkey % 100) AS gene_symbol, p_brand AS pathway_id FROM part WHERE p_partkey % 5 <> 0")
sql("gtf_parse", "SELECT 'E' || (p_partkey % 700) AS gene_id, p_name AS gene_symbol, 'chr' || (p_partkey % 3 + 1) AS chrom, p_partkey::BIGINT AS start, (p_partkey + p_size)::BIGINT AS \"end\", '+' AS strand, p_type AS biotype FROM part WHERE p_partkey % 4 <> 0 QUALIFY row_number() OVER (PARTITION BY p_partkey % 700 ORDER BY p_partkey) = 1")
CTES["terms"] = "terms AS (SELECT *, 'GO:' || lpad(p_partkey::VARCHAR, 7, '0') AS id, 'GO:' || lpad((p_partkey // 2)::VARCHAR, 7, '0') AS a, 'GO:' || lpad((p_partkey // 3)::VARCHAR, 7, '0') AS b FROM part WHERE p_partkey % 50 <> 0 AND p_partkey % 10 <> 7)"
CTES["tedges"] = "tedges AS (SELECT id AS c, a AS p FROM terms WHERE p_partkey >= 2 UNION SELECT id, b FROM terms WHERE p_partkey >= 3)"
CTES["up"] = "up(term, ancestor, distance) AS (SELECT c, p, 1 FROM tedges UNION SELECT up.term, e.p, up.distance + 1 FROM up JOIN tedges e ON up.ancestor = e.c)"
CTES["closed"] = "closed AS (SELECT term, ancestor, min(distance)::INTEGER AS distance FROM up GROUP BY ALL)"
NEEDS |= {"tedges": ["terms"], "up": ["tedges"], "closed": ["up"]}
sql("obo_parse", "SELECT id AS term_id, p_name AS name, 'biological_process' AS namespace, concat_ws('; ', CASE WHEN p_partkey >= 2 THEN 'is_a ' || a END, CASE WHEN p_partkey >= 3 THEN 'part_of ' || b END, 'regulates GO:0000001') AS parents FROM terms", "terms")
sql("go_closure", "SELECT * FROM closed", "closed")
sql("go_cycles", "SELECT term, min(distance)::INTEGER AS distance FROM around WHERE term = ancestor GROUP BY term", "tedges")
ORACLES["go_cycles"] = "WITH RECURSIVE " + ORACLES["go_cycles"].removeprefix("WITH ").replace("\nSELECT term, min", """,
loop AS (SELECT c, p FROM tedges UNION SELECT 'GO:0000001', 'GO:0000012'),
around(term, ancestor, distance) AS (SELECT c, p, 1 FROM loop WHERE c IN (SELECT 'GO:' || lpad(x::VARCHAR, 7, '0') FROM range(1, 13) r(x)) UNION SELECT a.term, e.p, a.distance + 1 FROM around a JOIN loop e ON a.ancestor = e.c WHERE a.distance < 12)
SELECT term, min""")
sql("go_term_sizes", """SELECT term, count(DISTINCT gene) FILTER (own) AS n_direct, count(DISTINCT gene) AS n_members FROM (SELECT gene, term, true AS own FROM notes UNION ALL SELECT gene, ancestor, false FROM notes JOIN closed USING (term)) GROUP BY term""", "closed")
ORACLES["go_term_sizes"] = ORACLES["go_term_sizes"].replace("\nSELECT term, count", ",\nnotes AS (SELECT DISTINCT 'S' || (l_orderkey % 500) AS gene, 'GO:' || lpad(l_partkey::VARCHAR, 7, '0') AS term FROM lineitem)\nSELECT term, count")
sql("go_ancestor_rollup", f"SELECT term, sample_id, {r('avg(value)', 'value')}, count(value) AS n_members FROM gf JOIN (SELECT 'g' || id AS gene, 'GO:' || lpad((id + 16)::VARCHAR, 7, '0') AS term FROM dims WHERE id < 16 UNION SELECT 'g' || id, ancestor FROM dims JOIN closed ON closed.term = 'GO:' || lpad((id + 16)::VARCHAR, 7, '0') WHERE id < 16) USING (gene) GROUP BY term, sample_id", "gf", "closed", "dims")
for _name in ("go_closure", "go_term_sizes", "go_ancestor_rollup"):
    ORACLES[_name] = "WITH RECURSIVE " + ORACLES[_name].removeprefix("WITH ")
CTES["numbers"] = "numbers AS (SELECT gene_id, gene_symbol, (row_number() OVER (ORDER BY gene_id) - 1) // 100 AS batch FROM genes)"
CTES["sent"] = "sent AS (SELECT batch, 'gene-' || lpad(batch::VARCHAR, 8, '0') AS name, count(*) AS n_rows, CASE WHEN batch % 10 = 3 THEN 'present' WHEN bool_or(gene_id LIKE '%777') THEN 'failed' ELSE 'written' END AS status FROM numbers GROUP BY batch)"
NEEDS |= {"numbers": ["genes"], "sent": ["numbers"]}
sql("sink_outcomes", "SELECT *, CASE WHEN status = 'failed' THEN 'ValueError: 777' END AS error FROM sent", "sent")
sql("sink_failed_rows", "SELECT gene_id, gene_symbol, batch FROM numbers WHERE batch IN (SELECT batch FROM sent WHERE status = 'failed')", "sent")
sql("gaf_parse", "SELECT DISTINCT p_brand AS gene_symbol, 'GO:' || p_size AS go_id, 'IEA' AS evidence_code, CASE p_partkey % 4 WHEN 0 THEN 'molecular_function' WHEN 1 THEN 'biological_process' WHEN 2 THEN 'cellular_component' ELSE 'Z' END AS aspect, 'involved_in' AS qualifier FROM part WHERE p_partkey % 5 <> 0")
sql("reactome_parse", "SELECT DISTINCT 'ENSG' || p_partkey AS gene_id, 'R-' || p_brand AS pathway_id, 'TAS' AS evidence_code FROM part WHERE p_partkey % 3 <> 0")
sql("reactome_pathway_parse", "SELECT 'R-' || p_partkey AS pathway_id, p_name AS pathway_name, 'Reactome' AS pathway_source FROM part WHERE p_partkey % 3 <> 0")
sql("island_parse", "SELECT 'CpG: ' || p_size AS region_id, 'chr2' AS chrom, p_partkey::BIGINT AS start, (p_partkey + p_size)::BIGINT AS \"end\", p_size::BIGINT AS cpg_count, CASE WHEN p_partkey % 6 = 0 THEN 0 ELSE p_size / 100 END::DOUBLE AS gc_fraction, 0.5::DOUBLE AS obs_exp_ratio FROM part")
sql("gmt_parse", "SELECT DISTINCT p_brand AS set_id, 'about' AS description, p_name AS gene FROM part")
sql("g_genes_in_pathway", "SELECT DISTINCT p_partkey::VARCHAR AS gene_id, p_name AS gene_symbol FROM part JOIN lineitem ON p_partkey = l_partkey WHERE l_suppkey = 3")
FLAG = "o_orderkey::VARCHAR AS cpg_id, o_orderkey % 97 = 0 AS is_biomarker_candidate FROM orders"
sql("g_cpgs_for_gene", f"SELECT {FLAG} WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_partkey = 5)")
sql("g_cpgs_in_pathway", f"SELECT {FLAG} WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_suppkey = 3))")
sql("g_pathways_for_gene", "SELECT s_suppkey::VARCHAR AS pathway_id, s_name AS pathway_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_partkey = 5)")
sql("g_go_terms_for_gene", "SELECT n_nationkey::VARCHAR AS term_id, n_name AS term_name FROM nation WHERE n_nationkey IN (SELECT p_size % 25 FROM part WHERE p_partkey = 5)")
sql("g_genes_with_term", "SELECT p_partkey::VARCHAR AS gene_id, p_name AS gene_symbol FROM part WHERE p_size % 25 = 4")
sql("g_samples_in_category", "SELECT c_custkey::VARCHAR AS barcode, c_mktsegment AS clinical_category FROM customer WHERE c_mktsegment = 'BUILDING'")
sql("g_cpgs_in_region_type", f"SELECT {FLAG} WHERE o_orderkey % 5 IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')")
sql("g_significant_genes", f"SELECT feature AS gene_id, {rs('q_value')} FROM adj WHERE adj.q_value <= 0.2", "adj")
sql("g_significant_pathways", f"SELECT pathway AS pathway_id, {rs('q_value')} FROM enr WHERE enr.q_value <= 0.9999", "enr")
sql("g_biomarker_cpgs", f"SELECT {FLAG} WHERE o_orderkey % 97 = 0")
sql("g_gene_methylation_for_sample", f"SELECT gene AS gene_id, {r('value')} FROM gf WHERE sample_id = 3", "gf")
sql("graph_import", """SELECT 'v_gene' AS part, count(*) AS n FROM part UNION ALL SELECT 'v_pathway', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'v_term', count(DISTINCT p_size) FROM part UNION ALL SELECT 'v_region', count(*) FROM islands
  UNION ALL SELECT 'e_gene_pathway', count(*) FROM part WHERE p_partkey * 3 IN (SELECT p_partkey FROM part) UNION ALL SELECT 'e_gene_term', count(*) FROM part WHERE p_partkey * 2 IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'v_sample', count(*) FROM embeddings UNION ALL SELECT 'v_cpg', count(*) FROM points WHERE pos % 3 <> 0 UNION ALL SELECT 'e_cpg_gene', count(*) FROM hits WHERE position % 3 <> 0
  UNION ALL SELECT 'e_cpg_region', count(DISTINCT cpg_id) FROM points p JOIN islands i ON p.chrom = i.chrom AND pos - 1 >= s AND pos - 1 < e WHERE pos % 3 <> 0""", "hits", "islands")
sql("graph_contents", """SELECT 'v_gene' AS part, concat_ws('|', p_type, chrom, e, gene_id, gene_symbol, s, strand) AS row FROM genes JOIN part ON gene_id = 'ENSG' || p_partkey
  UNION ALL SELECT DISTINCT 'v_pathway', concat_ws('|', p_brand, p_brand, 'Reactome') FROM part
  UNION ALL SELECT DISTINCT 'v_term', concat_ws('|', 'biological_process', 'GO:' || p_size, 'GO:' || p_size) FROM part
  UNION ALL SELECT 'v_region', concat_ws('|', chrom, e, chrom || ':' || s || '-' || e, 'cpg_island', s) FROM islands
  UNION ALL SELECT 'e_gene_pathway', concat_ws('|', 'ENSG' || (p_partkey * 3), p_brand) FROM part WHERE p_partkey * 3 IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'e_gene_term', concat_ws('|', 'IEA', 'ENSG' || (p_partkey * 2), 'GO:' || p_size) FROM part WHERE p_partkey * 2 IN (SELECT p_partkey FROM part)
  UNION ALL SELECT 'v_sample', concat_ws('|', vec_id, coalesce(label::VARCHAR, '-')) FROM embeddings
  UNION ALL SELECT 'v_cpg', concat_ws('|', chrom, cpg_id, 'false', '0.5', '0.125', '9', pos, '0.25') FROM points WHERE pos % 3 <> 0
  UNION ALL SELECT 'e_cpg_gene', concat_ws('|', cpg_id, gene_id, overlap_type) FROM hits WHERE position % 3 <> 0
  UNION ALL SELECT 'e_cpg_region', concat_ws('|', cpg_id, arg_min(i.chrom || ':' || s || '-' || e, (s, i.chrom || ':' || s || '-' || e))) FROM points p JOIN islands i ON p.chrom = i.chrom AND pos - 1 >= s AND pos - 1 < e WHERE pos % 3 <> 0 GROUP BY cpg_id""", "hits", "islands")
OWN = "(SELECT p_partkey FROM part WHERE p_name = (SELECT p_name FROM part WHERE p_partkey = 5))"
sql("graph_spot_check", " UNION ALL ".join(f"SELECT 'spot_{a}' AS name, count(*) > 0 AS passed, '> 0' AS expected, count(*)::VARCHAR AS actual, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'unexpected count' END AS message FROM {b} IN {OWN}" for a, b in (("e_gene_pathway", "lineitem WHERE l_partkey"), ("e_gene_term", "part WHERE p_partkey"), ("e_cpg_gene", "lineitem WHERE l_partkey"))))
VALID = [("v_sample", "customer"), ("v_cpg", "orders"), ("v_gene", "part"), ("v_pathway", "supplier"), ("v_term", "nation"), ("v_region", "region"), ("e_cpg_gene", "lineitem"), ("e_gene_pathway", "lineitem"), ("e_gene_term", "part"), ("e_cpg_region", "orders")]
sql("graph_validation", " UNION ALL ".join(f"SELECT '{a}' AS name, count(*) > 0 AS passed, '> 0' AS expected, count(*)::VARCHAR AS actual, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'unexpected count' END AS message FROM {b}" for a, b in VALID) + " UNION ALL SELECT 'samples_match_clinical', true, count(*)::VARCHAR, count(*)::VARCHAR, 'ok' FROM customer" + "".join(f" UNION ALL SELECT 'spot_{x}', false, '> 0', '0', 'unexpected count'" for x in ("e_gene_pathway", "e_gene_term", "e_cpg_gene")))
STRATA = """SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {s} ORDER BY md5({k} || ':42'), {k0}) AS n, count(*) OVER (PARTITION BY {s}) AS size, count(*) OVER () AS total FROM {t}) WHERE n <= least(size, greatest({least}, round_even(size * {want}.0::DOUBLE / total, 0)))"""
sql("stratified_sites", STRATA.format(cols="chrom, cpg_id", s="chrom", k="cpg_id", k0="cpg_id", t="points", least=1, want=1000), "points")
sql("stratified_samples", STRATA.format(cols="clinical_category, sample_id", s="clinical_category", k="sample_id::VARCHAR", k0="sample_id", t="meta", least=3, want=50), "meta")


def quota(source: str, n: int, least: int) -> str:
    """(stratum, size, quota) over source (s): shares of n, given back or filled by largest remainders."""
    ks = (1, 2, 3)
    whole = ", ".join(f"(sum(w{k}) OVER ())::BIGINT AS t{k}" for k in ks)
    down = ", ".join(f"CASE WHEN t{k} > 0 THEN a{k} * w{k} // t{k} ELSE 0 END AS d{k}, CASE WHEN t{k} > 0 THEN a{k} * w{k} % t{k} ELSE 0 END AS r{k}" for k in ks)
    up = ", ".join(f"d{k} + (row_number() OVER (ORDER BY r{k} DESC, stratum NULLS LAST) <= a{k} - sum(d{k}) OVER ())::BIGINT AS x{k}" for k in ks)
    return f"""WITH q0 AS (SELECT s AS stratum, count(*) AS size FROM {source} GROUP BY s),
q1 AS (SELECT *, least({n}, sum(size) OVER ())::BIGINT AS want, (sum(size) FILTER (stratum IS NOT NULL) OVER ())::BIGINT AS named, CASE WHEN stratum IS NULL THEN 0 ELSE least({least}, size) END AS low FROM q0),
q2 AS (SELECT *, CASE WHEN stratum IS NULL THEN 0 ELSE least(size, greatest(low, round_even(size * want::DOUBLE / named, 0)::BIGINT)) END AS base FROM q1),
q3 AS (SELECT *, (sum(base) OVER ())::BIGINT - want AS over_, (sum(base - low) OVER ())::BIGINT AS above FROM q2),
q4 AS (SELECT *, least(greatest(over_, 0), above) AS a1, base - low AS w1, greatest(over_ - above, 0) AS a2, low AS w2, greatest(-over_, 0) AS a3, size - base AS w3 FROM q3),
q5 AS (SELECT *, {whole} FROM q4), q6 AS (SELECT *, {down} FROM q5), q7 AS (SELECT *, {up} FROM q6)
SELECT stratum, size, (base - x1 - x2 + x3)::BIGINT AS quota FROM q7"""


CTES["cust"] = "cust AS (SELECT 'C' || c_custkey AS k, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 40 = 1 THEN 'rare' ELSE c_mktsegment END AS s FROM customer)"
EXACT = "SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY md5(k || ':42'), k) AS n FROM {t}) d JOIN ({q}) q ON d.s IS NOT DISTINCT FROM q.stratum WHERE n <= quota"
sql("exact_sites", EXACT.format(cols="k AS cpg_id, s AS chrom", t="(SELECT cpg_id AS k, chrom AS s FROM points)", q=quota("(SELECT chrom AS s FROM points)", 1001, 1)), "points")
sql("exact_samples", EXACT.format(cols="k AS sample_id, s AS clinical_category", t="cust", q=quota("cust", 101, 19)), "cust")
sql("quota_table", " UNION ALL ".join(f"SELECT *, {n}::INTEGER AS n FROM ({quota('cust', n, least)})" for n, least in ((3, 2), (40, 9), (97, 1), (10**9, 5))), "cust")
sql("subset_extract", f"SELECT sample_id, cpg_id, {r('beta')} FROM cells JOIN meta USING (sample_id) WHERE clinical_category = '1' AND cpg_id IN ('chr1_1000', 'chr2_2000', 'chr3_7000')", "cells", "meta")
