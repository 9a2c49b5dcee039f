"""Industry aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators import checks, industry, latest as latest_ops
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.sources import tables, testbed

_IND = {f"{b}|{seg}": label for b, m in testbed.INDUSTRY_NAMES.items() for seg, label in m.items()}
METRIC_LIST = "['exposure_aud_m','npe_aud_m','individually_assessed_provision_aud_m','write_offs_aud_m']"
ROWS = f"""
ir0 AS (
  SELECT *, {O.case('r_name', testbed.BANK_OF_REGION)} AS bank_code, {METRIC_LIST}[(o_orderkey % 4 + 1)::INT] AS metric
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
ir AS (
  SELECT bank_code || '_pillar3_industry' AS data_source, 'single_bank' AS aggregation_level, bank_code,
    CAST({O.qend('o_orderdate')} AS DATE) AS as_of_date,
    CASE WHEN metric <> 'write_offs_aud_m' THEN NULL WHEN o_custkey % 2 = 0 THEN 12 ELSE 6 END AS period_length_months,
    CASE WHEN bank_code = 'wbc' THEN ['Australia','New Zealand','Other overseas'][n_nationkey % 3 + 1] ELSE 'Total' END AS geography,
    {O.case("bank_code || '|' || c_mktsegment", _IND)} AS industry_published, metric,
    CASE WHEN o_orderkey % 997 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS value_aud_m,
    CASE WHEN o_orderkey % 997 = 0 THEN 'published_as_dash' END AS redaction_reason,
    upper(bank_code) || ' Pillar 3' AS source_publication, 'CRB(e)' AS source_table_ref, CAST(o_orderkey % 60 + 1 AS INT) AS source_page,
    CASE WHEN metric = 'individually_assessed_provision_aud_m' THEN CASE WHEN bank_code = 'cba' THEN 'aps220_specific' ELSE 'aasb9_stage3_ecl' END END AS provision_basis,
    CASE WHEN bank_code = 'cba' THEN regexp_replace(lower(o_orderpriority), '[^a-z0-9]+', '_', 'g') END AS portfolio_type,
    CASE WHEN bank_code = 'anz' THEN CASE o_orderstatus WHEN 'F' THEN 'loans' WHEN 'O' THEN 'off_balance_sheet' ELSE 'other' END END AS gross_carrying_component,
    o_orderkey AS row_seq
  FROM ir0 WHERE bank_code IS NOT NULL)"""
INTRA = """
intra AS (
  SELECT bank_code, industry_published, metric, as_of_date, geography, period_length_months,
    CASE WHEN count(value_aud_m) = count(*) THEN sum(value_aud_m) END AS value_aud_m,
    CASE WHEN count(value_aud_m) < count(*) THEN arg_min(redaction_reason, row_seq) FILTER (WHERE redaction_reason IS NOT NULL) END AS redaction_reason,
    count(*) > 1 AS derived, CASE WHEN count(value_aud_m) < count(*) THEN 'partial_redaction_in_subrows' END AS null_reason,
    arg_min(provision_basis, row_seq) AS provision_basis, arg_min(source_page, row_seq) AS source_page
  FROM ir GROUP BY ALL)"""
LABELS = "labels_map AS " + O.values(
    [(b, " ".join(k.split()).lower(), v) for b, m in V.BANK_INDUSTRY_LABELS.items() for k, v in m.items()],
    "bank_code, label_norm, canonical_bucket")
HARM = """
harm AS (SELECT i.*, canonical_bucket FROM intra i JOIN labels_map l ON l.bank_code = i.bank_code AND l.label_norm = lower(industry_published))"""


def _bucket_sql(metric: str, where: str = "TRUE", months: str = "NULL", recent: bool = True, consumers: str | None = None) -> str:
    keep = f"canonical_bucket NOT IN {O.in_list(V.CONSUMER_BUCKETS)}" if consumers is None else f"canonical_bucket = '{consumers}'"
    latest = "WHERE as_of_date = newest" if recent else ""
    return f"""
picked AS (SELECT * FROM (SELECT *, max(as_of_date) OVER (PARTITION BY bank_code, canonical_bucket) AS newest
  FROM harm WHERE metric = '{metric}' AND {keep} AND {where}) {latest}),
agg AS (
  SELECT canonical_bucket, '{metric}' AS metric, CAST(CASE WHEN count(value_aud_m) = count(*) THEN sum(value_aud_m) END AS DOUBLE) AS value_aud_m,
    array_to_string(list_sort(list_distinct(list(bank_code))), ',') AS contributing_banks,
    (SELECT string_agg(bank_code || '=' || d, ',' ORDER BY bank_code) FROM (SELECT bank_code, max(as_of_date) AS d FROM picked p WHERE p.canonical_bucket = q.canonical_bucket GROUP BY 1)) AS bank_as_of_dates,
    'most_recent_per_bank' AS aggregate_as_of_date_strategy, max(as_of_date) AS as_of_date, CAST({months} AS INT) AS aggregate_period_length_months,
    bool_or(derived) AS derived_from_intra_bank_sum, CASE WHEN count(value_aud_m) < count(*) THEN 'contributing_bank_null' END AS null_reason,
    CAST(NULL AS VARCHAR) AS coverage_ratio_caveat, CAST(NULL AS BOOLEAN) AS low_coverage_flag
  FROM picked q GROUP BY canonical_bucket)"""


def _flat(df):
    dates = F.transform(F.map_entries("bank_as_of_dates"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return df.withColumn("contributing_banks", F.array_join("contributing_banks", ",")).withColumn(
        "bank_as_of_dates", F.array_join(F.array_sort(dates), ","))


def _rows(spark, sf):
    return testbed.industry_rows(spark, sf)


def _intra(spark, sf):
    return industry.intra_bank_totals(_rows(spark, sf))


@query("industry_row_checks", O.with_(ROWS, body="""
SELECT row_seq, array_to_string(list_filter([
    CASE WHEN value_aud_m IS NULL AND rr IS NULL THEN 'null_without_reason' END,
    CASE WHEN value_aud_m IS NOT NULL AND rr IS NOT NULL THEN 'value_and_reason' END,
    CASE WHEN rr NOT IN ('not_disclosed_in_published_table', 'published_as_dash') THEN 'unknown_reason' END,
    CASE WHEN metric <> 'write_offs_aud_m' AND m IS NOT NULL THEN 'stock_with_period' END,
    CASE WHEN metric = 'write_offs_aud_m' AND (m IS NULL OR m NOT IN (6, 12)) THEN 'flow_period' END], lambda e: e IS NOT NULL), ',') AS errors
FROM (SELECT *, CASE WHEN row_seq % 1994 = 0 THEN NULL WHEN row_seq % 101 = 0 THEN 'smudged' ELSE redaction_reason END AS rr,
  CASE WHEN row_seq % 103 = 0 THEN 9 ELSE period_length_months END AS m FROM ir)"""))
def industry_row_checks(spark, sf):
    k = F.col("row_seq")
    broken = _rows(spark, sf).withColumns({
        "redaction_reason": F.when(k % 1994 == 0, F.lit(None).cast("string")).when(k % 101 == 0, F.lit("smudged")).otherwise(F.col("redaction_reason")),
        "period_length_months": F.when(k % 103 == 0, F.lit(9)).otherwise(F.col("period_length_months"))})
    return checks.check_industry_rows(broken).select("row_seq", F.array_join("errors", ",").alias("errors"))


@query("provenance_check", O.with_(ROWS, body="SELECT bank_code, count(*) AS n, count(value_aud_m) AS n_values FROM ir GROUP BY bank_code"))
def provenance_check(spark, sf):
    rows = checks.require_columns(_rows(spark, sf), checks.PROVENANCE_COLUMNS, "provenance_check")
    return rows.groupBy("bank_code").agg(F.count(F.lit(1)).alias("n"), F.count("value_aud_m").alias("n_values"))


@query("harmonise_industry", O.with_(ROWS, LABELS, body="""
SELECT row_seq, i.bank_code, industry_published, canonical_bucket FROM ir i JOIN labels_map l ON l.bank_code = i.bank_code AND l.label_norm = lower(industry_published)"""))
def harmonise_industry(spark, sf):
    messy = _rows(spark, sf).withColumn("shown", F.col("industry_published")).withColumn(
        "industry_published", F.concat(F.lit("  "), F.upper(F.replace("industry_published", F.lit(" "), F.lit("  ")))))
    return industry.harmonise(messy, tables.industry_labels(spark)).select(
        "row_seq", "bank_code", F.col("shown").alias("industry_published"), "canonical_bucket")


@query("union_bank_frames", O.with_(ROWS, body="""
SELECT bank_code, row_seq, CASE WHEN bank_code = 'cba' THEN portfolio_type END AS portfolio_type,
  CASE WHEN bank_code = 'anz' THEN gross_carrying_component END AS gross_carrying_component FROM ir"""))
def union_bank_frames(spark, sf):
    rows = _rows(spark, sf).select("bank_code", "row_seq", "portfolio_type", "gross_carrying_component")
    drop = {"cba": ["gross_carrying_component"], "nab": ["portfolio_type", "gross_carrying_component"],
            "wbc": ["portfolio_type", "gross_carrying_component"], "anz": ["portfolio_type"]}
    return industry.union_bank_frames([rows.where(F.col("bank_code") == b).drop(*cols) for b, cols in drop.items()])


@query("intra_bank_totals", O.with_(ROWS, INTRA, body="""
SELECT bank_code, industry_published, metric, as_of_date, geography, period_length_months, CAST(value_aud_m AS DOUBLE) AS value_aud_m,
  redaction_reason, derived AS derived_from_intra_bank_sum, null_reason, provision_basis, source_page FROM intra"""))
def intra_bank_totals(spark, sf):
    return _intra(spark, sf).select(
        *industry.INTRA_KEYS, F.col("value_aud_m").cast("double").alias("value_aud_m"), "redaction_reason",
        "derived_from_intra_bank_sum", "null_reason", "provision_basis", "source_page")


BASE = (ROWS, INTRA, LABELS, HARM)


@query("inter_bank_exposure", O.with_(*BASE, _bucket_sql("exposure_aud_m"), body="SELECT * FROM agg"))
def inter_bank_exposure(spark, sf):
    return _flat(industry.inter_bank_aggregate(_intra(spark, sf), "exposure_aud_m", tables.industry_labels(spark)))


# some industries also publish a total, which is not the sum of its parts
TOTALS = """
tot AS (
  SELECT bank_code, industry_published, metric, as_of_date, 'Total' AS geography, period_length_months, CAST(sum(value_aud_m) + 1 AS DECIMAL(38,2)) AS value_aud_m,
    CAST(NULL AS VARCHAR) AS redaction_reason, FALSE AS derived, CAST(NULL AS VARCHAR) AS null_reason, CAST(NULL AS VARCHAR) AS provision_basis, min(source_page) AS source_page
  FROM intra WHERE length(industry_published) % 2 = 0 GROUP BY bank_code, industry_published, metric, as_of_date, period_length_months),
both_ AS (SELECT * FROM intra UNION ALL SELECT * FROM tot)"""
HARM_ALL = HARM.replace("FROM intra i", "FROM both_ i")
HARM_TOTAL = HARM.replace("FROM intra i", """FROM (SELECT * FROM (
  SELECT *, bool_or(lower(geography) = 'total') OVER (PARTITION BY bank_code, industry_published, as_of_date, metric) AS has_total FROM both_)
  WHERE NOT has_total OR lower(geography) = 'total') i""")


def _with_totals(spark, sf):
    rows = _intra(spark, sf)
    keys = ["bank_code", "industry_published", "metric", "as_of_date", "period_length_months"]
    totals = rows.where(F.length("industry_published") % 2 == 0).groupBy(*keys).agg((F.sum("value_aud_m") + 1).alias("value_aud_m")).withColumns(
        {"geography": F.lit("Total"), "derived_from_intra_bank_sum": F.lit(False)})
    return rows.unionByName(totals, allowMissingColumns=True)


@query("inter_bank_prefer_total", O.with_(ROWS, INTRA, TOTALS, LABELS, HARM_TOTAL, _bucket_sql("exposure_aud_m"), body="SELECT * FROM agg"))
def inter_bank_prefer_total(spark, sf):
    """Totals beside their parts: a published total counts once, in place of its parts."""
    return _flat(industry.inter_bank_aggregate(_with_totals(spark, sf), "exposure_aud_m", tables.industry_labels(spark)))


@query("inter_bank_sum_all", O.with_(ROWS, INTRA, TOTALS, LABELS, HARM_ALL, _bucket_sql("exposure_aud_m"), body="SELECT * FROM agg"))
def inter_bank_sum_all(spark, sf):
    """Totals beside their parts: every published geography counts, totals included."""
    return _flat(industry.inter_bank_aggregate(_with_totals(spark, sf), "exposure_aud_m", tables.industry_labels(spark), geography="sum_all"))


@query("mixed_groups", O.with_(ROWS, body="""
SELECT bank_code, as_of_date, metric, 'IncompatiblePeriodLength' AS refusal_type, string_agg(CAST(m AS VARCHAR), ', ' ORDER BY m) AS found
FROM (SELECT DISTINCT bank_code, as_of_date, metric, period_length_months AS m FROM ir WHERE metric = 'write_offs_aud_m' AND period_length_months IS NOT NULL)
GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT bank_code, as_of_date, metric, 'CrossBankAggregation', string_agg(b, ', ' ORDER BY b)
FROM (SELECT DISTINCT bank_code, as_of_date, metric, CASE WHEN row_seq % 7 = 0 THEN 'aps220_specific' ELSE provision_basis END AS b FROM ir
      WHERE metric = 'individually_assessed_provision_aud_m') WHERE b IS NOT NULL GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT bank_code, as_of_date, metric, 'MissingProvenance', CAST(count(*) AS VARCHAR) FROM ir WHERE row_seq % 997 = 0 GROUP BY ALL"""))
def mixed_groups(spark, sf):
    """Refusals as rows, from published rows some of which change their basis or lose their table reference."""
    k = F.col("row_seq")
    rows = _rows(spark, sf).withColumns({
        "provision_basis": F.when((F.col("metric") == "individually_assessed_provision_aud_m") & (k % 7 == 0), F.lit("aps220_specific")).otherwise(F.col("provision_basis")),
        "source_table_ref": F.when(k % 997 != 0, F.col("source_table_ref"))})
    return industry.mixed_groups(rows)


@query("inter_bank_npe", O.with_(*BASE, _bucket_sql("npe_aud_m"), body="SELECT * FROM agg"))
def inter_bank_npe(spark, sf):
    return _flat(industry.inter_bank_aggregate(_intra(spark, sf), "npe_aud_m", tables.industry_labels(spark)))


@query("inter_bank_writeoffs", O.with_(*BASE, _bucket_sql("write_offs_aud_m", "period_length_months = 12", "12", recent=False), body="SELECT * FROM agg"))
def inter_bank_writeoffs(spark, sf):
    return _flat(industry.inter_bank_aggregate(_intra(spark, sf), "write_offs_aud_m", tables.industry_labels(spark), months=12))


@query("consumer_view", O.with_(*BASE, _bucket_sql("exposure_aud_m", consumers="consumer_combined"), body="SELECT * FROM agg"))
def consumer_view(spark, sf):
    return _flat(industry.inter_bank_aggregate(_intra(spark, sf), "exposure_aud_m", tables.industry_labels(spark), view="combined"))


@query("writeoff_period", O.with_(ROWS, INTRA, body="""
SELECT bank_code, industry_published, as_of_date, CAST(value_aud_m AS DOUBLE) AS value_aud_m FROM intra WHERE period_length_months = 6"""))
def writeoff_period(spark, sf):
    return industry.writeoff_period(_intra(spark, sf), 6).select(
        "bank_code", "industry_published", "as_of_date", F.col("value_aud_m").cast("double").alias("value_aud_m"))


@query("most_recent_per_bank", O.with_(*BASE, body="""
SELECT bank_code, canonical_bucket, metric, geography, as_of_date, period_length_months FROM (
  SELECT *, max(as_of_date) OVER (PARTITION BY bank_code, canonical_bucket) AS newest FROM harm) WHERE as_of_date = newest"""))
def most_recent_per_bank(spark, sf):
    rows = industry.harmonise(_intra(spark, sf), tables.industry_labels(spark))
    return latest_ops.most_recent_per_bank(rows).select(
        "bank_code", "canonical_bucket", "metric", "geography", "as_of_date", "period_length_months")


@query("provisions_same_basis", O.with_(*BASE, _bucket_sql("individually_assessed_provision_aud_m", "provision_basis = 'aasb9_stage3_ecl'"),
                                        body="SELECT *, 'aasb9_stage3_ecl' AS provision_basis FROM agg"))
def provisions_same_basis(spark, sf):
    one_basis = _intra(spark, sf).where(F.col("bank_code") != "cba")
    return _flat(industry.provisions_same_basis(one_basis, "aasb9_stage3_ecl", tables.industry_labels(spark)))


@query("aps120_caveat", O.with_(*BASE, _bucket_sql("npe_aud_m"), body="""
SELECT * REPLACE (CASE WHEN contains(contributing_banks, 'cba') THEN 'cba_aps120_scope_mismatch' END AS coverage_ratio_caveat) FROM agg"""))
def aps120_caveat(spark, sf):
    return _flat(industry.aps120_caveat(
        industry.inter_bank_aggregate(_intra(spark, sf), "npe_aud_m", tables.industry_labels(spark))))


STOCK = f"""
stock0 AS (
  SELECT {O.case('p_type', testbed.STOCK_LABEL_OF_TYPE)} AS industry_published,
    CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS business_size,
    CASE WHEN CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS INT) % 2 = 1 THEN '2019' ELSE '2022' END AS series_break_flag,
    CAST({O.qend('l_shipdate')} AS DATE) AS as_of_date, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem JOIN part ON p_partkey = l_partkey),
stock AS (SELECT industry_published, business_size, series_break_flag, as_of_date, sum(price) AS value_aud_m, as_of_date + 45 AS pub FROM stock0 GROUP BY ALL),
kept AS (SELECT * FROM stock WHERE industry_published NOT IN ('Other construction', 'Total, excluding selected financial businesses')),
buckets AS (
  SELECT CASE industry_published WHEN 'Manufacturing' THEN 'manufacturing' WHEN 'Construction (total)' THEN 'construction'
      WHEN 'Transport, postal and warehousing' THEN 'transport_storage' ELSE 'business_property_services' END AS canonical_bucket,
    CAST(sum(value_aud_m) AS DOUBLE) AS outstanding_aud_m, min(pub) AS publication_date,
    list_transform(list_sort(list_distinct(list(series_break_flag))), lambda f: 'd14_1_series_break_' || f) AS caveats
  FROM kept WHERE as_of_date = (SELECT max(as_of_date) FROM kept) GROUP BY 1)"""


def _stock(spark, sf):
    return industry.system_stock_by_bucket(testbed.system_stock(spark, sf), tables.system_labels(spark))


@query("system_stock_by_bucket", O.with_(STOCK, body="""
SELECT canonical_bucket, outstanding_aud_m, publication_date, array_to_string(caveats, '; ') AS caveats FROM buckets"""))
def system_stock_by_bucket(spark, sf):
    return _stock(spark, sf).withColumn("caveats", F.array_join("caveats", "; "))


@query("coverage_ratios", O.with_(*BASE, _bucket_sql("exposure_aud_m"), STOCK, body="""
SELECT a.canonical_bucket, a.as_of_date AS as_of_date_big4, publication_date AS as_of_date_d14_1, value_aud_m AS big4_ead_aud_m,
  outstanding_aud_m AS d14_1_outstanding_aud_m, CASE WHEN outstanding_aud_m <> 0 THEN round(value_aud_m / outstanding_aud_m, 8) END AS coverage_ratio,
  'ead_vs_outstanding_soft_proxy; d14_1_lender_scope_banks_and_rfcs_only; ' || COALESCE(array_to_string(caveats, '; '), 'd14_1_no_matching_bucket')
    || CASE WHEN outstanding_aud_m IS NULL THEN '; d14_1_suppressed' ELSE '' END AS coverage_ratio_caveat,
  COALESCE(value_aud_m / outstanding_aud_m < 0.60, FALSE) AS low_coverage_flag, contributing_banks, bank_as_of_dates
FROM agg a LEFT JOIN buckets b ON b.canonical_bucket = a.canonical_bucket"""))
def coverage_ratios(spark, sf):
    aggregates = industry.inter_bank_aggregate(_intra(spark, sf), "exposure_aud_m", tables.industry_labels(spark))
    return _flat(industry.coverage_ratios(aggregates, _stock(spark, sf)))


WIDE = """
wide0 AS (SELECT * FROM (SELECT *, max(as_of_date) OVER (PARTITION BY bank_code) AS newest FROM intra) WHERE as_of_date = newest),
wide1 AS (
  SELECT bank_code, industry_published, metric, max(as_of_date) AS as_of_date,
    CASE WHEN bool_or(lower(geography) = 'total') THEN CASE WHEN count(*) FILTER (WHERE lower(geography) = 'total' AND value_aud_m IS NULL) = 0
        THEN sum(value_aud_m) FILTER (WHERE lower(geography) = 'total') END
      WHEN count(value_aud_m) = count(*) THEN sum(value_aud_m) END AS v
  FROM wide0 GROUP BY 1, 2, 3),
wide AS (
  SELECT bank_code, upper(bank_code) AS bank, industry_published AS industry,
    CAST(max(CASE WHEN metric = 'exposure_aud_m' THEN v END) AS DOUBLE) AS exposure_aud_m, CAST(max(CASE WHEN metric = 'npe_aud_m' THEN v END) AS DOUBLE) AS npe_aud_m,
    CAST(max(CASE WHEN metric = 'individually_assessed_provision_aud_m' THEN v END) AS DOUBLE) AS provision_aud_m,
    CAST(max(CASE WHEN metric = 'write_offs_aud_m' THEN v END) AS DOUBLE) AS write_offs_aud_m, max(as_of_date) AS as_of_date
  FROM wide1 WHERE v IS NOT NULL GROUP BY 1, 2, 3)"""


@query("bank_industry_wide", O.with_(ROWS, INTRA, WIDE, body="""
SELECT *, CASE WHEN exposure_aud_m > 0 THEN round(npe_aud_m / exposure_aud_m, 6) END AS npe_rate_decimal,
  CASE WHEN exposure_aud_m > 0 THEN round(write_offs_aud_m / exposure_aud_m, 6) END AS write_off_rate_decimal FROM wide"""))
def bank_industry_wide(spark, sf):
    return industry.in_bank_order(industry.bank_industry_wide(_intra(spark, sf)))
