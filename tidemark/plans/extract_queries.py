"""Extraction queries: pages rendered from rows are parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.labels import first_match
from tidemark.operators import bands, checks, disclosures, industry_tables as tables_ops
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.sources import testbed_pages as P

DOC = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE)) AS doc_id"
L0 = f"""
li AS (SELECT *, {DOC}, round(l_discount + l_tax, 4) AS pd, round(l_discount, 4) AS lgd, CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS d FROM lineitem)"""


def _r8(df, column="value"):
    return df.withColumn(column, F.round(column, 8))


# --- PD bands -------------------------------------------------------------------------------

CR6 = """
SELECT doc_id, 'residential_mortgage' AS asset_class, 'pd' AS metric_name, pd AS value, '0.00 to <0.15' AS pd_band FROM li WHERE k = 0
UNION ALL SELECT doc_id, 'residential_mortgage', 'lgd', lgd, '0.00 to <0.15' FROM li WHERE k = 0
UNION ALL SELECT doc_id, 'residential_mortgage', 'pd', 1.0, '100.00 (Default)' FROM li WHERE k = 0
UNION ALL SELECT doc_id, 'residential_mortgage', 'lgd', lgd, '100.00 (Default)' FROM li WHERE k = 0
UNION ALL SELECT doc_id, 'retail_sme', 'pd', pd, '0.15 to <0.25' FROM li WHERE k = 1
UNION ALL SELECT doc_id, 'retail_sme', 'lgd', lgd, '0.15 to <0.25' FROM li WHERE k = 1
UNION ALL SELECT doc_id, 'rbnz_non_retail', 'pd', pd, '0.00 to <0.15' FROM li WHERE k = 2
UNION ALL SELECT doc_id, 'corporate_sme', 'pd', pd, '0.00 to <0.15' FROM li WHERE k = 3
UNION ALL SELECT doc_id, 'corporate_sme', 'lgd', lgd, '0.00 to <0.15' FROM li WHERE k = 3
UNION ALL SELECT doc_id, 'corporate_sme', 'pd', pd, '0.15 to <0.25' FROM li WHERE k = 3"""


CR6_ROWS = "WITH" + L0.replace("li AS (SELECT *", "li AS (SELECT *, CASE WHEN l_linenumber = 7 THEN -1 ELSE l_orderkey % 5 END AS k", 1) + CR6


@query("cr6_rows", CR6_ROWS)
def cr6_rows(spark, sf):
    return _r8(bands.band_rows(P.band_pages(spark, sf))).drop("page_no")


@query("cr6_rows_dirty", CR6_ROWS)
def cr6_rows_dirty(spark, sf):
    """The same pages with non-breaking spaces, form feeds, zero-width and control characters give the same rows."""
    dirt = F.concat(F.lit("\u0001\ufeff"), F.replace(F.replace("text", F.lit(" "), F.lit("\u00a0")), F.lit("\n"), F.lit("\u0002\f\n\u200b")))
    return _r8(bands.band_rows(P.band_pages(spark, sf).withColumn("text", dirt))).drop("page_no")


SPLIT = """
sp AS (
  SELECT doc_id, 'pd' AS metric_name, pd AS value, l_quantity AS ead_mn, '0.00 to <0.15' AS pd_band FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT doc_id, 'lgd', lgd, l_quantity, '0.00 to <0.15' FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT doc_id, 'pd', 0.02, 500, '0.15 to <0.25' FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT doc_id, 'lgd', 0.2, 500, '0.15 to <0.25' FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT doc_id, 'pd', 1.0, 7, '100.00 (Non-Performing)' FROM li WHERE l_linenumber % 2 = 1
  UNION ALL SELECT doc_id, 'lgd', 0.3, 7, '100.00 (Non-Performing)' FROM li WHERE l_linenumber % 2 = 1)"""


@query("cr6_rows_split_percent", O.with_(L0, SPLIT, body="SELECT *, 'residential_mortgage' AS asset_class FROM sp"))
def cr6_rows_split_percent(spark, sf):
    return _r8(bands.split_percent_rows(P.split_percent_pages(spark, sf), P.MACQUARIE_TARGET)).drop("page_no")


@query("ead_weighted_portfolio", O.with_(L0, SPLIT, body="""
SELECT doc_id, 'residential_mortgage' AS asset_class, metric_name, 'aggregate' AS pd_band,
  CAST(round(CAST(CAST(sum(CAST(value AS DECIMAL(12,6)) * CAST(ead_mn AS DECIMAL(12,4))) AS DOUBLE) / CAST(sum(CAST(ead_mn AS DECIMAL(12,4))) AS DOUBLE) AS DECIMAL(28,14)), 8) AS DOUBLE) AS value
FROM sp WHERE pd_band <> '100.00 (Non-Performing)' GROUP BY doc_id, metric_name"""))
def ead_weighted_portfolio(spark, sf):
    rows = bands.split_percent_rows(P.split_percent_pages(spark, sf), P.MACQUARIE_TARGET)
    return bands.ead_weighted_portfolio(rows)


@query("slotting_weights", O.with_(L0, body="""
SELECT doc_id, 'development_strong' AS asset_class, 'risk_weight' AS metric_name, 0.70::DOUBLE AS value, 'all' AS pd_band FROM li
UNION ALL SELECT doc_id, 'development_weak', 'risk_weight', 2.50, 'all' FROM li WHERE l_returnflag = 'R'
UNION ALL SELECT doc_id, 'development_satisfactory', 'risk_weight', 1.15, 'all' FROM li WHERE l_linestatus = 'O'"""))
def slotting_weights(spark, sf):
    return bands.slotting_weights(P.slotting_pages(spark, sf)).drop("page_no")


@query("judo_style_pd_bands", O.with_(L0, body="""
SELECT doc_id, ['commercial_property', 'development'][(l_orderkey % 3 + 1)::INT] AS segment, ['commercial real estate', 'construction'][(l_orderkey % 3 + 1)::INT] AS published_label,
  '0.00 to < 0.15' AS pd_band, pd AS value FROM li WHERE l_orderkey % 3 < 2
UNION ALL SELECT doc_id, 'sme_corporate', 'sme lending', '100.00 (Default)', 1.0 FROM li"""))
def judo_style_pd_bands(spark, sf):
    return _r8(bands.alias_band_rows(P.alias_band_pages(spark, sf))).drop("page_no")


# --- narrative disclosures ----------------------------------------------------------------------

INDEX_ROWS = """
idx AS (
  SELECT doc_id, 'sp_spin_prime' AS source_id, 'residential_mortgage' AS segment, pd AS value, last_day(d) AS as_of_date FROM li WHERE l_linenumber <> 7
  UNION ALL SELECT doc_id, 'sp_spin_non_conforming', 'residential_mortgage_specialist', lgd, last_day(d) FROM li WHERE l_linenumber <> 7 AND l_orderkey % 2 = 0)"""


@query("index_headline", O.with_(L0, INDEX_ROWS, body="SELECT *, 'arrears' AS parameter, 'arrears_30_plus_days' AS data_definition_class FROM idx"))
def index_headline(spark, sf):
    return _r8(disclosures.index_headline(P.index_pages(spark, sf))).drop("page_no")


@query("section_blocks", O.with_(L0, body="""
SELECT doc_id, 1 AS block_no, 'residential_mortgage' AS segment FROM li UNION ALL SELECT doc_id, 2, 'consumer_secured' FROM li"""))
def section_blocks(spark, sf):
    return disclosures.section_blocks(P.results_pages(spark, sf)).select("doc_id", "block_no", "segment")


RESULTS = """
res AS (
  SELECT doc_id, 'residential_mortgage' AS segment, 'loss_rate' AS parameter, 'loss_expense_rate' AS data_definition_class, pd AS value FROM li
  UNION ALL SELECT doc_id, 'residential_mortgage', 'arrears', 'arrears_90_plus_days', round(l_quantity / 10000, 8) FROM li
  UNION ALL SELECT doc_id, 'consumer_secured', 'loss_rate', 'loss_expense_rate', lgd FROM li
  UNION ALL SELECT doc_id, 'consumer_secured', 'arrears', 'arrears_30_plus_days', lgd FROM li)"""


@query("segment_metric_regex", O.with_(L0, RESULTS, body="""
SELECT r.*, make_date(year(d) - 1, 12, 31) AS as_of_date FROM res r JOIN li USING (doc_id)"""))
def segment_metric_regex(spark, sf):
    return _r8(disclosures.results_pack(P.results_pages(spark, sf), F.lit(None).cast("date"))).drop("page_no", "snippet")


@query("first_occurrence_dedupe", O.with_(L0, body="SELECT doc_id, 'Loan loss expense of ' || printf('%.2f', pd * 100) || '%' AS snippet FROM li"))
def first_occurrence_dedupe(spark, sf):
    rows = disclosures.results_pack(P.results_pages(spark, sf), F.lit(None).cast("date"))
    return rows.where((F.col("segment") == "residential_mortgage") & (F.col("parameter") == "loss_rate")).select("doc_id", "snippet")


UPDATES = """
upd AS (
  SELECT doc_id, 'consumer_unsecured' AS segment, 'loss_rate' AS parameter, 'loss_expense_rate' AS data_definition_class, round(l_quantity / 10000, 8) AS value FROM li
  UNION ALL SELECT doc_id, 'consumer_secured', 'arrears', 'arrears_90_plus_days', pd FROM li
  UNION ALL SELECT doc_id, 'consumer_secured', 'loss_rate', 'loss_expense_rate', 0.0043 FROM li
  UNION SELECT doc_id, 'consumer_secured', 'arrears', 'arrears_90_plus_days', lgd FROM li)"""


@query("line_metric_regex", O.with_(L0, UPDATES, body="""
SELECT u.*, d AS as_of_date, CAST(round(l_quantity * 100) AS INT) AS sample_size_n FROM upd u JOIN li USING (doc_id)"""))
def line_metric_regex(spark, sf):
    return _r8(disclosures.trading_update(P.update_pages(spark, sf), F.lit(None).cast("date"))).drop("page_no", "snippet")


@query("section_carry_forward", O.with_(L0, body="SELECT 'consumer_secured' AS label, 2 * count(*) AS n FROM li UNION ALL SELECT NULL, 3 * count(*) FROM li"))
def section_carry_forward(spark, sf):
    def label(line, i, lines):
        return first_match([(line.rlike(f"(?i){p}"), F.lit(s)) for s, p in disclosures.UPDATE_SECTIONS])

    rows = bands.carried_lines(P.update_pages(spark, sf), bands.trimmed_lines(F.col("text")), label)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("peer_lookaround", "WITH" + L0 + """
SELECT k, label, count(*) AS n FROM (
  SELECT l_orderkey % 5 AS k, unnest(CASE l_orderkey % 5 WHEN 0 THEN ['residential_mortgage', 'residential_mortgage'] WHEN 1 THEN ['retail_sme'] WHEN 2 THEN ['rbnz_non_retail']
    WHEN 3 THEN ['corporate_sme', 'corporate_sme'] ELSE [NULL] END) AS label FROM li) GROUP BY ALL""")
def peer_lookaround(spark, sf):
    from tidemark.fixed_values import BAND_TABLE_PORTFOLIOS

    pages = P.band_pages(spark, sf).withColumn("k", F.split_part("doc_id", F.lit("-"), F.lit(1)).cast("long") % 5).withColumn(
        "text", F.regexp_replace("text", bands.NEXT_TABLE, ""))
    rows = bands.carried_lines(pages, bands.trimmed_lines(F.col("text")), bands.portfolio_label(BAND_TABLE_PORTFOLIOS))
    return rows.where(F.col("line").rlike(bands.BAND)).groupBy("k", "label").agg(F.count(F.lit(1)).alias("n"))


NOTES = """
note AS (
  SELECT doc_id, 'residential_mortgage' AS segment, pd AS value, 'Residential mortgages' AS published_label FROM li
  UNION ALL SELECT doc_id, 'commercial_property', round(l_quantity / 12540, 8), 'Commercial property loans' FROM li
  UNION ALL SELECT doc_id, 'sme_corporate', 0.0345, 'SME loans' FROM li)"""


@query("impaired_table", O.with_(L0, NOTES, body="""
SELECT n.*, 'impaired' AS parameter, 'impaired_loans_ratio' AS data_definition_class, d AS as_of_date FROM note n JOIN li USING (doc_id)"""))
def impaired_table(spark, sf):
    return _r8(disclosures.impaired_table(P.note_pages(spark, sf), F.lit(None).cast("date"))).drop("page_no")


@query("disclosure_rows", O.with_(L0, NOTES, body="""
SELECT 'liberty' AS source_id, 'non_bank_listed' AS source_type, segment, 'impaired' AS parameter, 'impaired_loans_ratio' AS data_definition_class, value, d AS as_of_date,
  'Annual report credit risk note' AS reporting_basis, 'Impaired loans / total exposure for segment ''' || published_label || '''' AS methodology_note, d AS period_end,
  'https://disclosure.example/annual' AS source_url, 'credit risk note' AS page_or_table_ref FROM note n JOIN li USING (doc_id)"""))
def disclosure_rows(spark, sf):
    rows = disclosures.impaired_table(P.note_pages(spark, sf), F.lit(None).cast("date"))
    note = F.concat(F.lit("Impaired loans / total exposure for segment '"), F.col("published_label"), F.lit("'"))
    out = disclosures.disclosure_observations(rows, "liberty", "Annual report credit risk note", "https://disclosure.example/annual", note, "credit risk note")
    return _r8(out).drop("product", "sample_size_n", "period_start")


# --- what parsers drop ------------------------------------------------------------------------------

DROPPED = """
SELECT 'cr6' AS parser, doc_id, metric AS metric_name, v AS value, why AS dropped FROM (
  SELECT doc_id, 'lgd' AS metric, 1.5 AS v, 'out_of_range' AS why FROM li WHERE l_linenumber <> 7 AND l_orderkey % 5 = 3
  UNION ALL SELECT doc_id, 'lgd', NULL, 'no_value' FROM li WHERE l_linenumber <> 7 AND l_orderkey % 5 = 2
  UNION ALL SELECT doc_id, 'pd', pd, 'no_portfolio' FROM li WHERE l_linenumber <> 7 AND l_orderkey % 5 = 4
  UNION ALL SELECT doc_id, 'lgd', lgd, 'no_portfolio' FROM li WHERE l_linenumber <> 7 AND l_orderkey % 5 = 4)
UNION ALL SELECT 'alias', doc_id, 'pd', pd, 'no_portfolio' FROM li WHERE l_orderkey % 3 = 2
UNION ALL SELECT 'alias', doc_id, 'pd', NULL, 'no_value' FROM li
UNION ALL SELECT 'note', doc_id, 'impaired', 0.03, 'no_segment' FROM li
UNION ALL SELECT 'update', doc_id, 'loss_rate', round(l_quantity * 3 / 100, 8), 'out_of_range' FROM li WHERE l_quantity * 3 > 100
UNION ALL SELECT 'results', doc_id, 'arrears', round(l_quantity * 2.5 / 100, 8), 'out_of_range' FROM li WHERE l_quantity * 2.5 > 100"""


def _more(pages, *parts):
    return pages.withColumn("text", F.concat("text", F.lit("\n"), *parts))


def _verdicts(spark, sf):
    """Rows of five parsers with their verdicts; results and updates end in a rate that may exceed the whole."""
    none = F.lit(None).cast("date")

    def with_rate(pages, before, times):
        return _more(pages, F.lit(before), P.num(F.col("l_quantity") * times, 2), F.lit("%")).drop("l_quantity")

    shape = lambda name, rows, metric: rows.select(F.lit(name).alias("parser"), "doc_id", F.col(metric).alias("metric_name"), F.round("value", 8).alias("value"), "dropped")
    return (
        shape("cr6", bands.band_verdicts(P.band_pages(spark, sf)), "metric_name")
        .unionByName(shape("alias", bands.alias_band_verdicts(P.alias_band_pages(spark, sf)).withColumn("metric_name", F.lit("pd")), "metric_name"))
        .unionByName(shape("note", disclosures.impaired_verdicts(P.note_pages(spark, sf), none), "parameter"))
        .unionByName(shape("update", disclosures.update_verdicts(with_rate(P.update_pages(spark, sf, "l_quantity"), "Annualised net losses of ", 3), none), "parameter"))
        .unionByName(shape("results", disclosures.results_verdicts(with_rate(P.results_pages(spark, sf, "l_quantity"), "90+ days arrears of ", 2.5), none), "parameter")))


@query("dropped_rows", O.with_(L0, body=DROPPED))
def dropped_rows(spark, sf):
    return checks.quarantined(_verdicts(spark, sf))


# --- industry tables --------------------------------------------------------------------------------

O0 = """
po AS (SELECT CAST(o_orderkey AS VARCHAR) AS doc_id, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d, CAST(round(o_totalprice) AS DOUBLE) AS n FROM orders)"""


def _vals(rows):
    return "(VALUES " + ", ".join(rows) + ") AS v(bank, industry, metric, geography, component, fixed, is_n)"


_W, _N = "'wbc'", "NULL"
_PEEL = [
    "('wbc_exposure', 'Manufacturing', 'exposure_aud_m', 'Australia', NULL, NULL, TRUE)", "('wbc_exposure', 'Mining', 'exposure_aud_m', 'Australia', NULL, NULL, FALSE)",
    "('wbc_exposure', 'Property services and business services', 'exposure_aud_m', 'New Zealand', NULL, NULL, TRUE)",
    "('nab', 'Manufacturing', 'exposure_aud_m', 'Total', NULL, NULL, TRUE)", "('nab', 'Manufacturing', 'npe_aud_m', 'Total', NULL, 6, FALSE)",
    "('nab', 'Manufacturing', 'individually_assessed_provision_aud_m', 'Total', NULL, NULL, TRUE)", "('nab', 'Utilities', 'exposure_aud_m', 'Total', NULL, 1, FALSE)",
    "('nab', 'Utilities', 'npe_aud_m', 'Total', NULL, NULL, FALSE)", "('nab', 'Utilities', 'individually_assessed_provision_aud_m', 'Total', NULL, NULL, TRUE)",
    "('anz', 'Construction', 'exposure_aud_m', 'Total', 'loans', NULL, TRUE)", "('anz', 'Construction', 'exposure_aud_m', 'Total', 'off_balance_sheet', 20, FALSE)",
    "('anz', 'Construction', 'exposure_aud_m', 'Total', 'other', 30, FALSE)", "('anz', 'Construction', 'npe_aud_m', 'Total', NULL, 40, FALSE)",
    "('anz', 'Construction', 'individually_assessed_provision_aud_m', 'Total', NULL, NULL, TRUE)",
    "('anz', 'Government & Official Institutions', 'exposure_aud_m', 'Total', 'loans', 0, FALSE)", "('anz', 'Government & Official Institutions', 'exposure_aud_m', 'Total', 'off_balance_sheet', 3, FALSE)",
    "('anz', 'Government & Official Institutions', 'exposure_aud_m', 'Total', 'other', 4, FALSE)", "('anz', 'Government & Official Institutions', 'npe_aud_m', 'Total', NULL, 0, FALSE)",
    "('anz', 'Government & Official Institutions', 'individually_assessed_provision_aud_m', 'Total', NULL, 0, FALSE)",
    "('cba_npe', 'Manufacturing', 'npe_aud_m', 'Total', NULL, NULL, TRUE)", "('cba_npe', 'Manufacturing', 'individually_assessed_provision_aud_m', 'Total', NULL, NULL, FALSE)",
    "('cba_npe', 'Manufacturing', 'write_offs_aud_m', 'Total', NULL, NULL, TRUE)", "('cba_npe', 'Wholesale & Retail Trade', 'npe_aud_m', 'Total', NULL, 1, FALSE)",
    "('cba_npe', 'Wholesale & Retail Trade', 'individually_assessed_provision_aud_m', 'Total', NULL, NULL, TRUE)", "('cba_npe', 'Wholesale & Retail Trade', 'write_offs_aud_m', 'Total', NULL, 3, FALSE)",
]
for _i, _g in enumerate(("Australia", "New Zealand", "Other Overseas", "Total")):
    _PEEL.append(f"('wbc_npe', 'Manufacturing', 'npe_aud_m', '{_g}', NULL, {'NULL, TRUE' if _i == 0 else f'{_i + 1}, FALSE'})")
    _PEEL.append(f"('wbc_npe', 'Manufacturing', 'individually_assessed_provision_aud_m', '{_g}', NULL, {'NULL, TRUE' if _i == 3 else f'{_i + 5}, FALSE'})")
    for _m in ("npe_aud_m", "individually_assessed_provision_aud_m"):
        _PEEL.append(f"('wbc_npe', 'Government, administration and defence', '{_m}', '{_g}', NULL, 0, FALSE)")
_PEEL += ["('wbc_npe', 'Manufacturing', 'write_offs_aud_m', 'Total', NULL, NULL, TRUE)",
          "('wbc_npe', 'Government, administration and defence', 'write_offs_aud_m', 'Total', NULL, 0, FALSE)"]


@query("industry_table_right_peel", O.with_(O0, body=f"""
SELECT doc_id, split_part(bank, '_', 1) AS bank_code, industry AS industry_published, metric, geography, component AS gross_carrying_component,
  CASE bank WHEN 'anz' THEN make_date(year(d), 9, 30) WHEN 'cba_npe' THEN make_date(year(d), 6, 30) ELSE d END AS as_of_date,
  CASE WHEN is_n THEN n ELSE fixed::DOUBLE END AS value_aud_m, CASE WHEN NOT is_n AND fixed IS NULL THEN 'published_as_dash' END AS redaction_reason,
  CASE WHEN metric = 'write_offs_aud_m' THEN 12 END AS period_length_months,
  CASE WHEN metric = 'individually_assessed_provision_aud_m' THEN CASE WHEN bank = 'cba_npe' THEN 'aps220_specific' ELSE 'aasb9_stage3_ecl' END END AS provision_basis
FROM po CROSS JOIN (SELECT * FROM {_vals(_PEEL)})"""))
def industry_table_right_peel(spark, sf):
    cols = ["doc_id", "bank_code", "industry_published", "metric", "geography", "gross_carrying_component", "as_of_date", "value_aud_m",
            "redaction_reason", "period_length_months", "provision_basis"]
    return tables_ops.dispatched_rows(P.industry_pages(spark, sf)).select(*cols)


def _matrix_cells():
    cells = []
    for i, p in enumerate(tables_ops.MATRIX_PORTFOLIOS):
        for base, names in ((0, tables_ops.MATRIX_LEFT), (1000, tables_ops.MATRIX_RIGHT)):
            for j, ind in enumerate(names):
                cells.append((p, ind, None if (i, j) == (0, 0) else base + 10 * i + j))
    return cells


@query("industry_matrix", O.with_("cells AS " + O.values(_matrix_cells(), "portfolio_type, industry_published, off"), body="""
SELECT portfolio_type, industry_published, DATE '2025-06-30' AS as_of_date, count(*) AS n_pages,
  CAST(sum(CASE WHEN off IS NULL THEN 0 ELSE c_custkey + off END) AS DOUBLE) AS total FROM customer CROSS JOIN cells GROUP BY ALL"""))
def industry_matrix(spark, sf):
    return tables_ops.matrix_rows(P.matrix_pages(spark, sf)).groupBy("portfolio_type", "industry_published", "as_of_date").agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("value_aud_m").alias("total"))


@query("refused_matrix_pages", """
SELECT CAST(c_custkey AS VARCHAR) AS doc_id, DATE '2025-06-30' AS as_of_date,
  CASE WHEN c_custkey % 4 = 1 THEN '11 data rows in a matrix half, 10 are known' ELSE '3 matrix halves, at most 2 are known' END AS reason
FROM customer WHERE c_custkey % 4 IN (1, 3)""")
def refused_matrix_pages(spark, sf):
    more = first_match([
        (F.col("doc_id").cast("long") % 4 == 1, F.regexp_replace("text", r"(?m)^Industry Sector$", "Industry Sector\nPortfolio X 1 1 1 1 1 1 1 1")),
        (F.col("doc_id").cast("long") % 4 == 3, F.concat("text", F.lit("\nIndustry Sector (continued)\nPortfolio A 1 1 1 1 1 1 1 1")))], F.col("text"))
    pages = P.matrix_pages(spark, sf).withColumn("text", more)
    return tables_ops.refused_matrix_pages(pages).select("doc_id", "as_of_date", "reason")


@query("bank_industry_rows", """
WITH c AS (SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CAST(c_custkey + 1000 AS DOUBLE) AS n FROM customer)
SELECT doc_id, bank_code, metric, sum(CASE WHEN v < 0 THEN n ELSE v END) AS total, count(*) AS n_rows, max(m) AS months FROM c CROSS JOIN (VALUES
  ('wbc', 'exposure_aud_m', -1, NULL), ('wbc', 'npe_aud_m', 1, NULL), ('wbc', 'npe_aud_m', 2, NULL), ('wbc', 'npe_aud_m', 3, NULL), ('wbc', 'npe_aud_m', -1, NULL),
  ('wbc', 'individually_assessed_provision_aud_m', 5, NULL), ('wbc', 'individually_assessed_provision_aud_m', 6, NULL), ('wbc', 'individually_assessed_provision_aud_m', 7, NULL),
  ('wbc', 'individually_assessed_provision_aud_m', 8, NULL), ('wbc', 'write_offs_aud_m', -1, 12),
  ('nab', 'exposure_aud_m', -1, NULL), ('nab', 'npe_aud_m', 3, NULL), ('nab', 'individually_assessed_provision_aud_m', 5, NULL),
  ('anz', 'exposure_aud_m', -1, NULL), ('anz', 'exposure_aud_m', 2, NULL), ('anz', 'exposure_aud_m', 3, NULL), ('anz', 'npe_aud_m', 4, NULL), ('anz', 'individually_assessed_provision_aud_m', 7, NULL),
  ('cba', 'npe_aud_m', 1, NULL), ('cba', 'individually_assessed_provision_aud_m', 2, NULL), ('cba', 'write_offs_aud_m', -1, 12),
  ('cba', 'npe_aud_m', 1, NULL), ('cba', 'individually_assessed_provision_aud_m', 2, NULL), ('cba', 'write_offs_aud_m', -1, 6)) AS t(bank_code, metric, v, m)
GROUP BY doc_id, bank_code, metric""")
def bank_industry_rows(spark, sf):
    return tables_ops.bank_industry_rows(P.bank_document_pages(spark, sf)).groupBy("doc_id", "bank_code", "metric").agg(
        F.sum("value_aud_m").alias("total"), F.count(F.lit(1)).alias("n_rows"), F.max("period_length_months").alias("months"))
