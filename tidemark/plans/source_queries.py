"""Sheet, grid, listing, capture and stream queries."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Window as W, functions as F, types as T

from tidemark import fixed_values as V
from tidemark.operators import checks, grids, industry, ingest, listings, registry, reporting
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.plans.industry_queries import _intra
from tidemark.plans.registry_queries import ARRIVALS
from tidemark.session import work_folder
from tidemark.sources import tables, testbed, testbed_grids as G
from tidemark.sources.testbed import pick, table
from tidemark.streaming import publications, refresh

# --- canonical sheets ----------------------------------------------------------------------

SHEET = f"""
sheet AS (
  SELECT CAST({O.qend('o_orderdate')} AS DATE) AS period, {G.CATEGORIES!r}[CAST(substr(o_orderpriority, 1, 1) AS INT)] AS category,
    round(count(*) FILTER (WHERE o_orderstatus = 'P') / count(*) / 2, 6) AS dpd,
    CASE WHEN count(*) FILTER (WHERE o_custkey % 97 = 0) > 0 THEN round(count(*) FILTER (WHERE o_custkey % 97 = 0) / count(*), 6) END AS npl
  FROM orders GROUP BY ALL),
pts AS (
  SELECT '90DPD_Rate' AS metric_column, 'APRA_' || upper(category) || '_90DPD' AS source_name, dpd AS raw_value, period AS value_date, category AS asset_class_raw, 0.20 AS hi FROM sheet
  UNION ALL SELECT 'NPL_Rate', 'APRA_' || upper(category) || '_NPL', npl, period, category, 0.30 FROM sheet WHERE npl IS NOT NULL)"""
SOURCE = "apra_adi_performance"


def _points(spark, sf):
    return ingest.sheet_points(G.canonical_sheet(spark, sf), SOURCE, tables.sheet_metrics(spark))


@query("canonical_sheet_unpivot", O.with_(SHEET, body="SELECT metric_column, source_name, raw_value, value_date, asset_class_raw FROM pts"))
def canonical_sheet_unpivot(spark, sf):
    return _points(spark, sf).select("metric_column", "source_name", "raw_value", "value_date", "asset_class_raw")


@query("plausibility_apra", O.with_(SHEET, body="SELECT source_name, value_date, raw_value, raw_value BETWEEN 0 AND hi AS plausible FROM pts"))
def plausibility_apra(spark, sf):
    return checks.plausible_sheet_points(_points(spark, sf), tables.sheet_metrics(spark)).select("source_name", "value_date", "raw_value", "plausible")


@query("points_to_entries", O.with_(SHEET, body="""
SELECT 'APRA_' || upper(cls) || '_' || upper(metric_column) || '_IMPAIRED_RATIO_' || year(value_date) || 'Q' || quarter(value_date) AS source_id, 'APRA' AS publisher,
  'apra_adi' AS source_type, 'impaired_ratio' AS data_type, cls AS asset_class, 'coverage=all_adis' AS notes, raw_value AS value, value_date, value_date + 60 AS retrieval_date, '' AS errors
FROM (SELECT *, CASE asset_class_raw WHEN 'Residential' THEN 'residential_mortgage' WHEN 'Commercial' THEN 'commercial_property_investment' WHEN 'Corporate' THEN 'corporate_sme'
  WHEN 'Hotel Lending' THEN 'hotel_lending' ELSE 'retail_sme' END AS cls FROM pts)"""))
def points_to_entries(spark, sf):
    out = ingest.points_to_entries(_points(spark, sf), V.SHEET_LABEL_OVERRIDES[SOURCE])
    return out.select("source_id", "publisher", "source_type", "data_type", "asset_class", "notes", "value", "value_date", "retrieval_date",
                      F.array_join("errors", ",").alias("errors"))


IRB = """
irb AS (
  SELECT c_custkey AS doc_id, ['Residential Mortgage','CRE Investment','Corporate SME','Sovereign'][(c_custkey % 4 + 1)::INT] AS label,
    round((c_custkey % 97) / 1000, 6) AS pd, CASE WHEN c_custkey % 5 <> 0 THEN round((c_custkey % 89) / 100, 6) END AS lgd,
    ['STRONG','GOOD','SATISFACTORY','WEAK'][(c_custkey % 4 + 1)::INT] AS grade, round((c_custkey % 101) / 1000, 6) AS gpd FROM customer),
irbp AS (
  SELECT doc_id, label AS asset_class_raw, 'PD' AS metric, 'pd' AS data_type_hint, pd AS raw_value FROM irb
  UNION ALL SELECT doc_id, label, 'LGD', 'lgd', lgd FROM irb WHERE lgd IS NOT NULL
  UNION ALL SELECT doc_id, 'Specialised Lending', 'SLOTTING_' || grade || '_PD', 'pd', gpd FROM irb)"""


@query("irb_unpivot", O.with_(IRB, body="SELECT * FROM irbp"))
def irb_unpivot(spark, sf):
    return tables.portfolio_points(*G.portfolio_sheet(spark, sf))


@query("parsed_tables_explode", O.with_(IRB, body="""
SELECT 'b' || doc_id AS bank, asset_class_raw, 'B' || doc_id || '_' || upper(replace(asset_class_raw, ' ', '_')) || '_' || metric AS source_name, data_type_hint, raw_value FROM irbp"""))
def parsed_tables_explode(spark, sf):
    return tables.parsed_table_points(G.parsed_documents(spark, sf)).drop("reporting_date")


@query("plausibility_pillar3", O.with_(IRB, body="""
SELECT doc_id, metric, raw_value, CASE WHEN metric LIKE 'SLOTTING_STRONG%' THEN raw_value BETWEEN 0.001 AND 0.010 WHEN metric LIKE 'SLOTTING_GOOD%' THEN raw_value BETWEEN 0.003 AND 0.020
  WHEN metric LIKE 'SLOTTING_SATIS%' THEN raw_value BETWEEN 0.010 AND 0.060 WHEN metric LIKE 'SLOTTING_WEAK%' THEN raw_value BETWEEN 0.030 AND 0.200
  WHEN metric = 'LGD' THEN raw_value BETWEEN 0 AND 1 WHEN asset_class_raw = 'Residential Mortgage' THEN raw_value BETWEEN 0.003 AND 0.025
  WHEN asset_class_raw = 'CRE Investment' THEN raw_value BETWEEN 0.01 AND 0.08 WHEN asset_class_raw = 'Corporate SME' THEN raw_value BETWEEN 0.01 AND 0.10
  ELSE raw_value BETWEEN 0 AND 1 END AS plausible FROM irbp"""))
def plausibility_pillar3(spark, sf):
    points = tables.portfolio_points(*G.portfolio_sheet(spark, sf)).withColumn("source_name", F.concat(F.lit("CBA_"), "metric"))
    return checks.plausible_pillar3(points).select("doc_id", "metric", "raw_value", "plausible")


@query("plausibility_metric", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, m AS metric_name, round(l_discount + l_tax, 4) * 6 AS value, round(l_discount + l_tax, 4) * 6 <= hi AS plausible
FROM lineitem, LATERAL (SELECT ['npl_ratio','ninety_dpd_rate','pd','lgd','risk_weight','other'][(l_suppkey % 6 + 1)::INT] AS m, [0.10, 0.15, 1.01, 1.0, 3.0, 1.0][(l_suppkey % 6 + 1)::INT] AS hi)""")
def plausibility_metric(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", pick(F.col("l_suppkey") % 6, ["npl_ratio", "ninety_dpd_rate", "pd", "lgd", "risk_weight", "other"]).alias("metric_name"),
        (F.round(F.col("l_discount") + F.col("l_tax"), 4) * 6).alias("value"))
    return checks.plausible_metric(rows).drop("range_lo", "range_hi")


@query("route_documents", """
SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'pdf_tables' WHEN 1 THEN 'property_exposures' WHEN 2 THEN 'performance' WHEN 3 THEN 'canonical_sheet' WHEN 4 THEN 'none' ELSE 'quarterly_workbook' END AS route FROM documents""")
def route_documents(spark, sf):
    k = F.col("doc_id") % 6
    docs = table(spark, sf, "documents").select(
        "doc_id", pick(k, ["a.PDF", "b.xlsx", "c.xlsx", "d.xlsx", "e.docx", "f.xlsx"]).alias("file_name"),
        pick(k, ["CBA_PILLAR3", "APRA_QPEX", "apra_adi_performance", "APRA_QPEX", "x", "CBA_PILLAR3"]).alias("source_name"))
    cells = table(spark, sf, "documents").where(k == 3).select("doc_id", F.lit("Asset Quality").alias("sheet"))
    return ingest.route_documents(docs, cells).select("doc_id", "route")


# --- grids ------------------------------------------------------------------------------------

LQ = f"""
lq AS (SELECT *, CAST({O.qend('CAST(l_shipdate AS DATE) + INTERVAL 24 YEAR')} AS DATE) AS as_of, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem),
qx AS (
  SELECT ['Tab 1a','Tab 1b','Tab 2a','Tab 2b','Tab 4a','Tab 4b'][((l_suppkey % 3) * 2 + l_linenumber % 2 + 1)::INT] AS sheet, as_of,
    CAST(sum(price) AS DOUBLE) AS den, CAST(sum(price) FILTER (WHERE l_quantity <= 3) AS DOUBLE) AS num FROM lq GROUP BY ALL),
qr AS (
  SELECT CASE substr(sheet, 1, 5) WHEN 'Tab 1' THEN 'all_adis' WHEN 'Tab 2' THEN 'banks' ELSE 'major_banks' END AS institution_sector,
    CASE WHEN sheet LIKE '%a' THEN 'commercial_property_investment' ELSE 'residential_mortgage' END AS asset_class, year(as_of) || 'Q' || quarter(as_of) AS period,
    num / den AS value, as_of AS as_of_date, num AS numerator_value, den AS denominator_value, sheet AS source_sheet
  FROM qx WHERE num IS NOT NULL AND num / den BETWEEN 0 AND 0.10),
pf AS (
  SELECT ['Tab 1d','Tab 2d','Tab 4d'][(l_suppkey % 3 + 1)::INT] AS sheet, ['all_adis','banks','major_banks'][(l_suppkey % 3 + 1)::INT] AS institution_sector, as_of AS as_of_date,
    round(count(*) FILTER (WHERE l_quantity <= 3) / count(*), 6) AS share FROM lq GROUP BY ALL),
pr AS (
  SELECT institution_sector, metric_name, CASE metric_name WHEN 'npl_ratio' THEN share ELSE round(share * 2, 6) END AS value, as_of_date, sheet AS source_sheet,
    year(as_of_date) || 'Q' || quarter(as_of_date) AS period FROM pf CROSS JOIN (VALUES ('npl_ratio'), ('ninety_dpd_rate')) AS t(metric_name)
  WHERE as_of_date >= DATE '2022-03-31' AND CASE metric_name WHEN 'npl_ratio' THEN share <= 0.10 ELSE round(share * 2, 6) <= 0.15 END)"""


@query("qpex_npl_ratio", O.with_(LQ, body="SELECT * REPLACE (round(value, 8) AS value), 'npl_ratio' AS metric_name FROM qr"))
def qpex_npl_ratio(spark, sf):
    return grids.exposure_ratios(G.exposure_cells(spark, sf)).drop("doc_id", "numerator_row", "denominator_row").withColumn("value", F.round("value", 8))


@query("exposure_workbooks", O.with_(LQ, body="""
SELECT 'qpex-' || l_suppkey AS doc_id, ['Tab 1a', 'Tab 1b', 'Tab 2a', 'Tab 2b', 'Tab 4a', 'Tab 4b'][((l_suppkey % 3) * 2 + l_linenumber % 2 + 1)::INT] AS source_sheet,
  as_of AS as_of_date, CAST(sum(price) FILTER (WHERE l_quantity <= 3) AS DOUBLE) AS numerator_value, CAST(sum(price) AS DOUBLE) AS denominator_value,
  CASE WHEN count(*) FILTER (WHERE l_quantity <= 3) = 0 THEN 'no_numerator'
    WHEN CAST(sum(price) FILTER (WHERE l_quantity <= 3) AS DOUBLE) / CAST(sum(price) AS DOUBLE) > 0.10 THEN 'out_of_range' END AS dropped
FROM lq GROUP BY l_suppkey, (l_suppkey % 3) * 2 + l_linenumber % 2, as_of"""))
def exposure_workbooks(spark, sf):
    """A workbook for each supplier: every quarter with its two sides, and why it gives no ratio."""
    rows = grids.exposure_verdicts(G.exposure_cells(spark, sf, by_supplier=True))
    return rows.select("doc_id", "source_sheet", "as_of_date", "numerator_value", "denominator_value", "dropped")


@query("perf_ratio_grid", O.with_(LQ, body="SELECT *, 'adi_sector_total' AS asset_class FROM pr"))
def perf_ratio_grid(spark, sf):
    return grids.performance_ratios(G.performance_cells(spark, sf)).drop("doc_id", "source_row")


@query("find_date_row", O.with_(LQ, body="SELECT DISTINCT sheet, 5 AS header_row, (year(as_of_date) - 2018) * 4 + quarter(as_of_date) AS col_idx, as_of_date FROM pf"))
def find_date_row(spark, sf):
    return grids.date_header(G.performance_cells(spark, sf)).drop("doc_id").withColumn("col_idx", F.col("col_idx").cast("long"))


@query("label_row_lookup", O.with_(LQ, body="""
SELECT DISTINCT sheet, CASE WHEN sheet LIKE '%a' THEN 'commercial' ELSE 'residential' END AS book, role, row_idx FROM qx
CROSS JOIN (VALUES ('denominator', 11), ('numerator', 20)) AS t(role, row_idx)"""))
def label_row_lookup(spark, sf):
    book = F.when(F.col("sheet").endswith("a"), F.lit("commercial")).otherwise(F.lit("residential"))
    return grids.label_rows(G.exposure_cells(spark, sf).withColumn("book", book)).drop("doc_id")


@query("quarterly_npl_ratio", O.with_(LQ, body="""
SELECT 'cba-' || as_of AS doc_id, ['corporate_aggregate','retail_sme','residential_mortgage','retail_qrr','retail_other','specialised_lending','financial_institution','sovereign'][(k + 1)::INT] AS asset_class,
  num AS numerator_value, den AS denominator_value, round(num / den, 8) AS value, 'npl_ratio' AS metric_name
FROM (SELECT as_of, l_suppkey % 9 AS k, CAST(sum(price) AS DOUBLE) AS den, CAST(sum(price) FILTER (WHERE l_quantity <= 4) AS DOUBLE) AS num FROM lq GROUP BY ALL)
WHERE k < 8 AND num IS NOT NULL AND num / den <= 0.10"""))
def quarterly_npl_ratio(spark, sf):
    return grids.quarterly_ratios(G.quarterly_cells(spark, sf)).withColumn("value", F.round("value", 8))


@query("point_provenance", O.with_(LQ, body="""
SELECT 'APRA_QPEX_' || upper(asset_class) || '_' || upper(institution_sector) || '_NPL_RATIO' AS source_name, round(value, 8) AS raw_value, as_of_date AS value_date,
  source_sheet, 20 AS numerator_row, numerator_value, 'qpex_' || institution_sector || '_npl_ratio' AS metric_column, period AS period_code FROM qr"""))
def point_provenance(spark, sf):
    points = grids.exposure_points(grids.exposure_ratios(G.exposure_cells(spark, sf)))
    q, m = F.col("quality_indicators"), F.col("metadata")
    return points.select("source_name", F.round("raw_value", 8).alias("raw_value"), "value_date", q["source_sheet"].alias("source_sheet"),
                         q["numerator_row"].cast("int").alias("numerator_row"), q["numerator_value"].cast("double").alias("numerator_value"),
                         m["metric_column"].alias("metric_column"), m["period_code"].alias("period_code"))


@query("series_to_observations", O.with_(LQ, body="""
SELECT * FROM (
  SELECT 'APRA_PERF_' || upper(institution_sector) || '_ADI_SECTOR_TOTAL_' || upper(metric_name) AS source_id, 'apra_performance' AS source_type, 'adi_sector_total' AS segment,
    CASE metric_name WHEN 'npl_ratio' THEN 'npl' ELSE 'arrears' END AS parameter, CASE metric_name WHEN 'npl_ratio' THEN 'npl_ratio' ELSE 'arrears_90_plus_days' END AS data_definition_class,
    round(value, 8) AS value, as_of_date, 'APRA quarterly ADI performance time series' AS reporting_basis, 'APRA PERF ' || institution_sector || ' ' || metric_name || ' ' || source_sheet AS methodology_note,
    as_of_date AS period_end, source_sheet AS page_or_table_ref FROM pr
  UNION ALL SELECT 'APRA_QPEX_' || upper(institution_sector) || '_' || CASE WHEN asset_class LIKE 'comm%' THEN 'COMMERCIAL_PROPERTY' ELSE 'RESIDENTIAL_MORTGAGE' END || '_NPL_RATIO', 'apra_qpex',
    CASE WHEN asset_class LIKE 'comm%' THEN 'commercial_property' ELSE 'residential_mortgage' END, 'npl', 'npl_ratio', round(value, 8), as_of_date,
    'APRA quarterly property exposures time series', 'APRA QPEX ' || institution_sector || ' npl_ratio ' || source_sheet, as_of_date, source_sheet FROM qr)
WHERE NOT (parameter = 'arrears' AND quarter(as_of_date) = 1)"""))
def series_to_observations(spark, sf):
    rows = grids.series_observations(grids.performance_ratios(G.performance_cells(spark, sf)), grids.exposure_ratios(G.exposure_cells(spark, sf)))
    held = rows.where((F.col("parameter") == "arrears") & (F.quarter("as_of_date") == 1))
    return registry.not_yet_present(rows, held, F.col("value")).withColumn("value", F.round("value", 8))


# --- manifests, sidecars, files --------------------------------------------------------------------


@query("manifest_scan", """
SELECT 'apra_insight' AS source_key, 'Issue ' || n || ' of ' || page_id AS title, url || '#' || n AS url, CAST(DATE '2024-01-01' + CAST(page_id % 300 + n AS INT) AS VARCHAR) AS published_date, sha256(url) AS sha256
FROM pages CROSS JOIN (VALUES (1), (2)) AS t(n)""")
def manifest_scan(spark, sf):
    return tables.manifest_items(G.manifests(spark, sf)).drop("fetched_at", "local_path")


@query("source_documents", """
SELECT list_position(['rba_fsr','rba_smp','rba_chart_pack'], k) - 1 AS ord, k AS source_key, CASE WHEN page_id % 2 = 0 THEN 'Reserve Bank' ELSE 'Reserve Bank of Australia' END AS publisher,
  'Review' AS source, url, '' AS local_cached_file, 'Q1 ' || (2000 + page_id % 20) AS period, '2025-02-01' AS retrieval_date
FROM (SELECT *, ['rba_smp','rba_fsr','rba_chart_pack','other','rba_fsr'][(page_id % 5 + 1)::INT] AS k FROM pages) WHERE k <> 'other' AND page_id % 7 <> 0""")
def source_documents(spark, sf):
    return tables.source_documents(G.sidecars(spark, sf))


@query("raw_file_inventory")
def raw_file_inventory(spark, sf):
    return tables.raw_file_inventory(spark, sf)


# --- listings -------------------------------------------------------------------------------------------

LINKS = """
lk0 AS (SELECT page_id, regexp_extract_all(html, '<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hs, regexp_extract_all(html, '<a\\s+href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS ts FROM pages),
lk AS (
  SELECT page_id, pos, trim(hs[pos]) AS href, trim(regexp_replace(replace(replace(replace(replace(replace(ts[pos], '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS title
  FROM (SELECT page_id, hs, ts, unnest(generate_series(1, len(hs))) AS pos FROM lk0))"""
SITE = listings.Listing("site", "https://site.example/news/index", "/", ("index", "The"))


def _pages(spark, sf):
    return table(spark, sf, "pages").select("page_id", "html")


@query("dated_listing_entries", """
SELECT 'apra_insight' AS source_key, CASE kind WHEN 'inside' THEN 'inside ' || page_id || ' of ' || strftime(d, '%-d %B %Y') ELSE kind || ' ' || page_id END AS title,
  'https://www.apra.gov.au/news-and-publications/' || kind || '-' || page_id AS url, CASE WHEN kind <> 'headed' THEN d END AS published_date
FROM (SELECT page_id, kind, DATE '2024-01-01' + CAST(page_id % 600 + off AS INT) AS d
      FROM pages CROSS JOIN (VALUES ('sibling', 0), ('before', 1), ('block', 2), ('inside', 3), ('parent', 4), ('grand', 5), ('shared', 6), ('second', 6), ('headed', 7)) AS t(kind, off))""")
def dated_listing_entries(spark, sf):
    """Given pages followed by a dated listing: dates in the link, its parent and its grandparent, before and after it; a date in the page header belongs to no link."""
    k, at = F.col("page_id").cast("string"), "/news-and-publications/"

    def page(*parts):
        """Text with links (kind) and dates (days after the first)."""
        out = []
        for part in parts:
            if isinstance(part, int):
                out.append(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 600 + part).cast("int")), "d MMMM yyyy"))
            else:
                out += [k if bit == "#" else F.lit(bit) for bit in re.split("(#)", part)]
        return F.concat(*out)

    listing = page(
        "<div><p>Page updated ", 9, f"</p><section><div><a href='{at}sibling-#'>sibling #</a><p>15 (16) ", 0, "</p></div>",
        "<ul><li><span>", 1, f"</span><div><a href={at}before-#>before #</a></div></li><li><a href=\"{at}block-#\"><div>block #</div></a> ", 2,
        f"</li><li>", 8, f"<b><a href='{at}inside-#'>inside # of ", 3, "</a></b></li></ul>",
        f"<p><a href='{at}parent-#'>parent #</a> ", 4, f"</p><article><h3><a href='{at}grand-#'>grand #</a></h3><br><p>", 5, "</p></article>",
        f"<p><a href='{at}shared-#'>shared #</a> ", 6, f" <a href='{at}second-#'>second #</a> ", 7, "</p>",
        f"<div><div><h3><a href='{at}headed-#'>headed #</a></h3></div></div><a href='mailto:a@b.c'>mail</a></section></div>")
    return listings.listing_entries(_pages(spark, sf).withColumn("html", F.concat("html", listing)), listings.APRA_INSIGHT)


@query("html_listing_entries", O.with_(LINKS, body="""
SELECT 'site' AS source_key, arg_min(title, page_id * 100000 + pos) AS title, 'https://site.example' || href AS url, CAST(NULL AS DATE) AS published_date
FROM lk WHERE href LIKE '/%' AND title <> '' AND href NOT IN ('/', '/The', '/index') GROUP BY href"""))
def html_listing_entries(spark, sf):
    return listings.listing_entries(_pages(spark, sf), SITE)


@query("new_publications", O.with_(LINKS, body="""
SELECT DISTINCT href AS url FROM lk WHERE title <> '' AND href NOT IN (SELECT href FROM lk WHERE page_id % 2 = 0)"""))
def new_publications(spark, sf):
    links = listings.anchors(_pages(spark, sf)).where(F.col("title") != "").select("page_id", F.col("href").alias("url"), "title")
    return listings.new_publications(links.drop("page_id"), links.where(F.col("page_id") % 2 == 0)).select("url")


RULES = (listings.LinkRule("glob_er", "*er", ("the",), ""), listings.LinkRule("keyword_on", "zzz*", ("on",), "", ("tion",)))


@query("tiered_link_match", O.with_(LINKS, body="""
SELECT page_id, target, regexp_extract(any_value(url), '^[a-z]+://[^/]+') || arg_min(href, tier * 100000 + pos) AS link, CASE min(tier) WHEN 1 THEN 'primary-glob' ELSE 'fallback-keywords' END AS matched_by FROM (
  SELECT page_id, pos, href, 'glob_er' AS target, CASE WHEN lower(href) LIKE '%er' OR lower(title) LIKE '%er' THEN 1 WHEN contains(lower(title || ' ' || href), 'the') THEN 2 END AS tier FROM lk
  UNION ALL SELECT page_id, pos, href, 'keyword_on', CASE WHEN contains(lower(title || ' ' || href), 'tion') THEN NULL WHEN lower(href) LIKE '/zzz%' OR lower(title) LIKE 'zzz%' THEN 1
    WHEN contains(lower(title || ' ' || href), 'on') THEN 2 END FROM lk) JOIN pages USING (page_id) WHERE tier IS NOT NULL GROUP BY page_id, target"""))
def tiered_link_match(spark, sf):
    links = listings.anchors(table(spark, sf, "pages").select("page_id", "url", "html"))
    return listings.tiered_link_match(links, RULES, ["page_id"], F.col("url"))


@query("download_pdf_links", O.with_(LINKS, body="""
SELECT page_id, arg_min(href || '.pdf', pos) AS href FROM lk WHERE length(title) % 2 = 0 GROUP BY page_id"""))
def download_pdf_links(spark, sf):
    links = listings.anchors(_pages(spark, sf))
    even = F.length("title") % 2 == 0
    made = links.withColumns({"href": F.when(even, F.concat("href", F.lit(".pdf"))).otherwise(F.col("href")),
                              "title": F.concat(F.lit("Download PDF "), "title")})
    return listings.download_pdf_links(made, ["page_id"])


@query("newest_publications", O.with_(LINKS, body="""
SELECT * FROM (SELECT 'src' || page_id % 3 AS source_key, title, href AS url, DATE '2020-01-01' + CAST(page_id % 50 AS INT) AS published_date,
  row_number() OVER (PARTITION BY page_id % 3 ORDER BY page_id % 50 DESC, title DESC, href DESC) AS rank FROM lk) WHERE rank <= 3"""))
def newest_publications(spark, sf):
    links = listings.anchors(_pages(spark, sf)).select(
        F.concat(F.lit("src"), (F.col("page_id") % 3).cast("string")).alias("source_key"), "title", F.col("href").alias("url"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("page_id") % 50).cast("int")).alias("published_date"))
    return reporting.newest_publications(links)


@query("latest_issue", """
SELECT source_key, arg_max(href, y * 100 + m) AS href, strftime(make_date(max(y * 100 + m) // 100, max(y * 100 + m) % 100, 1), '%B %Y') AS period FROM (
  SELECT CASE page_id % 2 WHEN 0 THEN 'fsr' ELSE 'smp' END AS source_key, 2000 + page_id % 23 AS y, page_id % 12 + 1 AS m,
    '/publications/' || CASE page_id % 2 WHEN 0 THEN 'fsr' ELSE 'smp' END || '/' || (2000 + page_id % 23) || '/' || ['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'][(page_id % 12 + 1)::INT] || '/' AS href
  FROM pages) GROUP BY source_key""")
def latest_issue(spark, sf):
    k = F.col("page_id")
    key = F.when(k % 2 == 0, F.lit("fsr")).otherwise(F.lit("smp"))
    href = F.concat(F.lit("/publications/"), key, F.lit("/"), (F.lit(2000) + k % 23).cast("string"), F.lit("/"),
                    pick(k % 12, ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]), F.lit("/"))
    return listings.latest_issue(table(spark, sf, "pages").select(key.alias("source_key"), href.alias("href")), r"^/publications/[a-z]+/(\d{4})/([a-z]{3})/?$")


CAPTURED = """
cap AS (
  SELECT source AS source_key, upper(source) || ' publisher' AS publisher, 'Doc ' || doc_id AS title, 'https://site.example/docs/list?p=1' AS landing_url,
    'https://site.example/docs/' || doc_id || '.html' AS url, d AS published_date, source || '/' || doc_id || '.html' AS local_path,
    'Q' || quarter(d) || ' ' || year(d) AS period, DATE '2025-01-01' AS retrieval_date, sha256(text) AS sha256, doc_id
  FROM (SELECT *, DATE '2024-01-01' + CAST(doc_id % 400 AS INT) AS d FROM documents))"""


def _captures(spark, sf):
    d = table(spark, sf, "documents").select(
        F.col("source").alias("source_key"), F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
        F.lit("https://site.example/docs/list?p=1").alias("landing_url"), F.concat(F.col("doc_id").cast("string"), F.lit(".html")).alias("href"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 400).cast("int")).alias("published_date"), F.col("text").alias("content"))
    publishers = {r.source: f"{r.source.upper()} publisher" for r in table(spark, sf, "documents").select("source").distinct().limit(1000).collect()}
    return listings.capture_records(d, F.lit("2025-01-01").cast("date"), publishers)


@query("capture_record", O.with_(CAPTURED, body="SELECT * EXCLUDE (doc_id) FROM cap"))
def capture_record(spark, sf):
    return _captures(spark, sf)


@query("capture_audit", O.with_(CAPTURED, body="""
SELECT 'read_source_document' AS operation, source_key AS entity_id, url, '2025-01-01' AS retrieved_at, sha256 AS file_hash, local_path AS local_cached_file, period,
  'captured' AS result_summary, 'system' AS actor FROM cap"""))
def capture_audit(spark, sf):
    rows = listings.capture_audit(_captures(spark, sf))
    fields = ("url", "retrieved_at", "file_hash", "local_cached_file", "period")
    return rows.select("operation", "entity_id", *(F.get_json_object("params_json", f"$.{f}").alias(f) for f in fields), "result_summary", "actor")


@query("manifest_append", O.with_(CAPTURED, body="""
SELECT source_key, url, published_date, title, CAST(row_number() OVER (PARTITION BY source_key ORDER BY published_date DESC, title DESC, url DESC) AS INT) AS place,
  CASE WHEN doc_id % 3 = 2 THEN 1 ELSE doc_id % 3 END AS batch FROM cap"""))
def manifest_append(spark, sf):
    """Three batches, the second also with captures of the first under another title, the third the second again; newest first."""
    base = f"{work_folder(spark, 'manifest')}/items"
    rows = _captures(spark, sf).withColumn("k", F.regexp_extract("url", r"(\d+)\.html$", 1).cast("long"))
    part = lambda cond: rows.where(cond).drop("k")
    listings.manifest_append(part(F.col("k") % 3 == 0), base, 0)
    second = part(F.col("k") % 3 != 0).unionByName(part(F.col("k") % 3 == 0).withColumn("title", F.lit("seen again")))
    listings.manifest_append(second, base, 1)
    listings.manifest_append(second, base, 1)
    schema = T.StructType([*second.schema.fields, T.StructField("batch_id", T.LongType())])
    items = listings.manifest_items(spark, base, schema)
    order = [F.col("published_date").desc(), F.col("title").desc(), F.col("url").desc()]
    return items.select("source_key", "url", "published_date", "title", F.row_number().over(W.partitionBy("source_key").orderBy(*order)).alias("place"),
                        F.col("batch_id").alias("batch"))


# --- writes, refusals, streams -------------------------------------------------------------------------------


@query("append_observations", O.with_(O.OBS, body="SELECT parameter, year(as_of_date) AS as_of_year, count(*) AS n FROM obs GROUP BY ALL"))
def append_observations(spark, sf):
    accepted, _ = checks.split(checks.check_observations(testbed.observations(spark, sf)))
    path = work_folder(spark, "observations")
    registry.append_observations(accepted, path)
    stored = spark.read.parquet(path)
    return stored.groupBy("parameter", F.col("as_of_year").cast("long").alias("as_of_year")).agg(F.count(F.lit(1)).alias("n"))


@query("audit_append", O.with_(O.OBS, body=f"""
SELECT 'query_observations' AS operation, p AS entity_id, p AS parameter, CAST((SELECT count(*) FROM obs WHERE parameter = p) AS VARCHAR) AS result_summary
FROM (VALUES {', '.join(f"('{p}')" for p in V.PARAMETERS)}) AS t(p)"""))
def audit_append(spark, sf):
    """Rows written once, counted per parameter while they are written."""
    base = work_folder(spark, "audit")
    counts = {p: F.col("parameter") == p for p in V.PARAMETERS}
    registry.audited_write(testbed.observations(spark, sf), f"{base}/rows", f"{base}/log", "query_observations", counts, dt.datetime(2025, 1, 1))
    return spark.read.parquet(f"{base}/log").select("operation", "entity_id", F.get_json_object("params_json", "$.entity").alias("parameter"), "result_summary")


@query("refusal_log", """
SELECT * FROM (VALUES ('CrossBankAggregation', 'inter_bank_aggregate(''pd_value'')'), ('IncompatiblePeriodLength', 'write_offs(period=None)'),
  ('CrossBankAggregation', 'provisions_same_basis(''aps220_specific'')'), ('MissingProvenance', 'intra_bank_totals')) AS t(refusal_type, requested_aggregation)
WHERE (SELECT count(DISTINCT r_name) FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE o_orderkey % 4 = 2 AND r_name <> 'MIDDLE EAST') > 1""")
def refusal_log(spark, sf):
    """Refusals raised by data and by request, kept as rows."""
    totals, labels = _intra(spark, sf), tables.industry_labels(spark)
    attempts = (
        lambda: industry.inter_bank_aggregate(totals, "pd_value", labels),
        lambda: industry.inter_bank_aggregate(totals, "write_offs_aud_m", labels),
        lambda: industry.provisions_same_basis(totals, "aps220_specific", labels),
        lambda: industry.intra_bank_totals(testbed.industry_rows(spark, sf).drop("source_table_ref")),
    )
    refused = []
    for attempt in attempts:
        try:
            attempt()
        except checks.RefusedError as error:
            refused.append(error)
    return industry.refusal_log(spark, refused).select("refusal_type", "requested_aggregation")


STREAMED = """
st AS (
  SELECT *, max(value_date) OVER (PARTITION BY source_id ORDER BY arrived, source_id, value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bdate,
    lag(value) OVER (PARTITION BY source_id, value_date ORDER BY arrived, value) AS pvalue FROM arr)"""


#: Files per trigger so many that all files waiting are one batch: a batch cut short would change the order of arrival.
ONE_BATCH = 2**31 - 1


@query("refresh_stream", O.with_(ARRIVALS, STREAMED, """
ac AS (
  SELECT *, CASE WHEN bdate IS NULL THEN 'add' WHEN bdate > value_date THEN 'skip_newer_in_registry'
    WHEN bdate = value_date AND value = pvalue THEN 'skip_unchanged' ELSE 'supersede' END AS action FROM st)""", body="""
SELECT source_id, value, value_date, action, CAST(NULL AS INT) AS version FROM ac
UNION ALL SELECT source_id, value, value_date, 'stored', CAST(row_number() OVER (PARTITION BY source_id ORDER BY arrived, value) AS INT)
FROM ac WHERE action IN ('add', 'supersede')"""))
def refresh_stream(spark, sf):
    """Six days of entries arrive, in files of even size, then the stream runs on: what each entry did, and the registry that is left."""
    base = work_folder(spark, "refresh")
    entries = testbed.benchmark_arrivals(spark, sf).withColumn("inserted_at", F.timestamp_micros("arrived")).withColumns(
        {"version": F.lit(1), "superseded_by": F.lit(None).cast("string")})
    part = F.least(F.greatest(F.floor(F.datediff("value_date", F.lit("2024-01-01").cast("date")) / 6), F.lit(0)), F.lit(4))
    for i in range(5):
        days = entries.where(part == i).select(*refresh.ENTRY_SCHEMA.fieldNames())
        days.hint("rebalance", "inserted_at").write.mode("append").parquet(f"{base}/entries")
        refresh.refresh_stream(
            spark, f"{base}/entries", f"{base}/registry", f"{base}/actions", f"{base}/state", max_files=ONE_BATCH).awaitTermination()
    actions, stored = spark.read.parquet(f"{base}/actions"), spark.read.parquet(f"{base}/registry")
    return actions.select("source_id", "value", "value_date", "action", F.lit(None).cast("int").alias("version")).unionByName(
        stored.select("source_id", "value", "value_date", F.lit("stored").alias("action"), "version"))


@query("publication_stream", O.with_(LINKS, body="""
SELECT DISTINCT regexp_extract(url, '^[a-z]+://[^/]+') || href AS url FROM lk JOIN pages USING (page_id) WHERE href LIKE '/%' AND title <> ''"""))
def publication_stream(spark, sf):
    base = work_folder(spark, "publications")
    publications.publication_stream(spark, f"{sf}/pages*.parquet", f"{base}/links", f"{base}/state").awaitTermination()
    return spark.read.schema("url string, title string").parquet(f"{base}/links").select("url")
