"""Label, unit, date and identifier expressions run over whole tables.

Each query builds its labels from row keys, so the oracle states the expected
code per key and never repeats the expression under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L, text as X
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.sources import tables, testbed
from tidemark.sources.testbed import pick, table


def _pick_sql(index: str, values) -> str:
    return "[" + ", ".join(O._q(v) if v is not None else "NULL" for v in values) + f"][({index} + 1)::INT]"


def _obs(spark, sf):
    return testbed.observations(spark, sf)


# --- units and publisher maps ------------------------------------------------------------

UNITS = ["ratio", " Decimal ", "percent", "Percentage", "basis_points", "BPS", "months", "dollars", "furlongs"]


@query("normalize_value", "SELECT event_id, round(abs(value) / d, 10) AS value FROM (SELECT *, "
       "CAST([1.0, 1.0, 100.0, 100.0, 10000.0, 10000.0, 1.0, 1.0, NULL] AS DOUBLE[])[(event_id % 9 + 1)::INT] AS d FROM events)")
def normalize_value(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.round(L.normalize_value(F.abs("value"), pick(F.col("event_id") % 9, UNITS)), 10).alias("value"))


PUBLISHERS = ["APRA", "CBA", "Commonwealth Bank of Australia", "NAB Group", "Macquarie Bank (Aust)", "illion Australia", "S&P",
              "S&P Capital IQ", "Moody's Analytics", "CoreLogic NZ", "RBA Bulletin", "La Trobe Financial", "Unknown Co"]
PUBLISHER_TYPES = ["apra_adi", "pillar3", "pillar3", "pillar3", "pillar3", "bureau", "rating_agency", "rating_agency", "rating_agency",
                   "industry_body", "rba", "listed_peer", None]


@query("map_source_type", f"SELECT c_custkey, {_pick_sql('c_custkey % 13', PUBLISHER_TYPES)} AS source_type FROM customer")
def map_source_type(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", L.map_source_type(pick(F.col("c_custkey") % 13, PUBLISHERS)).alias("source_type"))


ASSET_LABELS = ["Residential", " residential mortgages - investor ", "CRE", "Corporate", "SME Retail", "Hotel Lending", "Specialised Lending", "Trade Finance"]
ASSET_CLASSES = ["residential_mortgage", "residential_mortgage", "commercial_property_investment", "corporate_general", "retail_sme",
                 "hotel_lending", "specialised_lending", "trade_finance"]


@query("map_asset_class", f"SELECT c_custkey, {_pick_sql('c_custkey % 8', ASSET_CLASSES)} AS asset_class FROM customer")
def map_asset_class(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", L.map_asset_class(
        pick(F.col("c_custkey") % 8, ASSET_LABELS), V.SHEET_LABEL_OVERRIDES["mqg_pillar3"]).alias("asset_class"))


HINTS = ["PD", " loss_given_default", "90dpd", "NPL", "recovery", "failure", "regulatory_floor", "mystery"]
HINT_TYPES = ["pd", "lgd", "impaired_ratio", "impaired_ratio", "recovery_rate", "failure_rate", "supervisory_value", None]


@query("infer_data_type", f"SELECT c_custkey, {_pick_sql('c_custkey % 8', HINT_TYPES)} AS data_type FROM customer")
def infer_data_type(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", L.infer_data_type(pick(F.col("c_custkey") % 8, HINTS)).alias("data_type"))


@query("generate_source_id", """
SELECT o_orderkey, 'S_AND_P_' || CASE o_orderkey % 2 WHEN 0 THEN 'SME' ELSE 'CRE' END || CASE WHEN o_orderkey % 3 = 0 THEN '_NPL_RATE' ELSE '' END
  || '_PD_' || CASE WHEN o_orderkey % 5 = 0 THEN 'FY2025' ELSE year(o_orderdate) || 'Q' || quarter(o_orderdate) END AS source_id FROM orders""")
def generate_source_id(spark, sf):
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select("o_orderkey", L.generate_source_id(
        F.lit("S & P"), pick(k % 2, ["sme", "cre"]), F.lit("pd"), F.col("o_orderdate").cast("date"),
        F.when(k % 3 == 0, F.lit("NPL Rate")).otherwise(F.lit("")), F.when(k % 5 == 0, F.lit("FY2025"))).alias("source_id"))


@query("period_slug", "SELECT o_orderkey, year(o_orderdate) || 'Q' || quarter(o_orderdate) AS period FROM orders")
def period_slug(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", L.period_slug(F.col("o_orderdate").cast("date")).alias("period"))


# --- observation labels --------------------------------------------------------------------

@query("canonical_segment", O.with_(O.OBS, O.READ, body="SELECT source_id, obs_seq, stored_segment, segment FROM rd"))
def canonical_segment(spark, sf):
    return _obs(spark, sf).select("source_id", "obs_seq", F.col("segment").alias("stored_segment"),
                                  L.canonical_segment(F.col("segment")).alias("segment"))


@query("cohort_for", O.with_(O.OBS, body="""
SELECT source_id, obs_seq, CASE split_part(source_id, '_', 1) WHEN 'CBA' THEN 'peer_big4' WHEN 'NAB' THEN 'peer_big4' WHEN 'WBC' THEN 'peer_big4'
  WHEN 'ANZ' THEN 'peer_big4' WHEN 'MACQUARIE' THEN 'peer_other_major_bank' WHEN 'JUDO' THEN 'peer_non_bank'
  WHEN 'APRA' THEN 'regulator_aggregate' ELSE 'regulatory_floor' END AS cohort FROM obs"""))
def cohort_for(spark, sf):
    return _obs(spark, sf).select("source_id", "obs_seq", L.cohort_for(F.col("source_type"), F.col("source_id")).alias("cohort"))


@query("is_big4", "SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey, l_suppkey % 8 < 4 AS is_big4 FROM lineitem")
def is_big4(spark, sf):
    sid = F.concat(pick(F.col("l_suppkey") % 8, ["CBA", "nab-", "wbc_x", "Anz", "MQG", "judo", "cbaX", "xcba"]),
                   F.when(F.col("l_suppkey") % 8 != 6, F.lit("_1")).otherwise(F.lit("")))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey", L.is_big4(sid).alias("is_big4"))


@query("direct_lgd", O.with_(O.OBS, body=f"SELECT source_id, obs_seq, {O.DIRECT_LGD} AS direct FROM obs"))
def direct_lgd(spark, sf):
    return _obs(spark, sf).select("source_id", "obs_seq", L.is_direct_lgd(
        F.col("parameter"), F.col("data_definition_class"), F.col("source_id")).alias("direct"))


@query("product_for", O.with_(O.OBS, O.READ, body="SELECT segment, stored_product, product, count(*) AS n FROM rd GROUP BY ALL"))
def product_for(spark, sf):
    seg = L.canonical_segment(F.col("segment"))
    return _obs(spark, sf).select(seg.alias("segment"), F.col("product").alias("stored_product"),
                                  L.product_for(F.col("product"), seg).alias("product")).groupBy(
        "segment", "stored_product", "product").agg(F.count(F.lit(1)).alias("n"))


SEG_NAMES = ["residential_mortgage", "corporate_sme", "adi_sector_total", "sme_lgd_book"]
SEG_LABELS = ["Residential Mortgage", "Corporate SME", "ADI Sector Total", "SME LGD Book"]


@query("segment_label", f"SELECT c_custkey, {_pick_sql('c_custkey % 4', SEG_LABELS)} AS label FROM customer")
def segment_label(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", L.segment_label(pick(F.col("c_custkey") % 4, SEG_NAMES)).alias("label"))


SOURCE_IDS = {
    "sp_spin_prime": "S&P SPIN (prime RMBS, 30+ DPD)", "CBA_PILLAR3_RES_2024H2": "Commonwealth Bank (residential PD)",
    "WBC_PILLAR3_CRE_PD_2024H2": "Westpac (commercial property PD)", "NAB_PILLAR3_RES_LGD_2024": "NAB (residential LGD)",
    "ANZ_PILLAR3_CORP_SME_2024": "ANZ (corporate SME PD)", "MACQUARIE_BANK_PILLAR3_SME_UNSECURED": "Macquarie (SME unsecured LGD)",
    "mqg": "Macquarie", "APS113_SLOTTING_GOOD_PD": "APS 113 slotting (Strong / Good / Satisfactory / Weak): Good PD",
    "APS113_SLOTTING_OTHER": "APS 113 slotting", "APS113_RES_LGD_FLOOR": "APS 113 LGD floor (residential)",
    "APRA_QPEX_ALL_ADIS_RESIDENTIAL_MORTGAGE_NPL_RATIO": "APRA QPEX (all ADIs, NPL)",
    "APRA_PERF_MAJOR_BANKS_X_NINETY_DPD_RATE": "APRA performance (major banks, 90+ DPD)",
    "RBA_FSR_HH_ARREARS_2024": "RBA FSR (household 90+ arrears)", "RBA_FSR_OTHER": "RBA FSR", "AFIA_INVOICE_LOSS": "AFIA (invoice finance loss rate)",
    "X_LATROBE_1": "La Trobe Financial (bridging realised loss)", "pepper": "Pepper Money", "zip_2024": "Zip Co", "nobody_7": "nobody_7",
    "METRICS_COMMENTARY": "Metrics Credit (commentary)",
}


@query("friendly_name", f"SELECT c_custkey, {_pick_sql('c_custkey % 20', SOURCE_IDS.values())} AS friendly_name FROM customer")
def friendly_name(spark, sf):
    sid = pick(F.col("c_custkey") % 20, list(SOURCE_IDS))
    return table(spark, sf, "customer").select("c_custkey", L.friendly_name(sid).alias("friendly_name"))


# --- bridge labels ------------------------------------------------------------------------------

BRIDGE = [
    ("QUALITAS_COMMENTARY_1", "pd", "qualitative_commentary", "commentary"),
    ("APS113_X_LGD", "pd", "regulatory_floor_lgd", "lgd"), ("APS113_SLOTTING_GOOD_PD", "pd", "regulatory_floor_pd", "pd"),
    ("APRA_QPEX_1", "impaired_ratio", "impaired_loans_ratio", "impaired"), ("APRA_PERF_1", "impaired_ratio", "npl_ratio", "npl"),
    ("RBA_FSR_30PLUS", "default_rate", "arrears_30_plus_days", "arrears"), ("RBA_FSR_X", "default_rate", "arrears_90_plus_days", "arrears"),
    ("SP_SPIN_2024", "impaired_ratio", "arrears_30_plus_days", "arrears"),
    ("LATROBE_REALISED_LOSS", "default_rate", "realised_loss_rate", "loss_rate"), ("CBA_PILLAR3_X", "pd", "basel_pd_one_year", "pd"),
    ("CBA_PILLAR3_L", "lgd", "realised_loss_rate", "lgd"), ("OTHER_1", "default_rate", "arrears_90_plus_days", "arrears"),
    ("OTHER_2", "recovery_rate", None, None),
]


@query("infer_definition_class", f"""SELECT c_custkey, {_pick_sql('c_custkey % 13', [b[2] for b in BRIDGE])} AS data_definition_class FROM customer""")
def infer_definition_class(spark, sf):
    k = F.col("c_custkey") % 13
    return table(spark, sf, "customer").select("c_custkey", L.definition_class(
        pick(k, [b[0] for b in BRIDGE]), pick(k, [b[1] for b in BRIDGE])).alias("data_definition_class"))


@query("infer_parameter", f"""SELECT c_custkey, {_pick_sql('c_custkey % 13', [b[3] for b in BRIDGE])} AS parameter FROM customer""")
def infer_parameter(spark, sf):
    k = F.col("c_custkey") % 13
    kind = pick(k, [b[1] for b in BRIDGE])
    return table(spark, sf, "customer").select("c_custkey", L.parameter_of(
        L.definition_class(pick(k, [b[0] for b in BRIDGE]), kind), kind).alias("parameter"))


BASIS = [
    ("pillar3", "CBA_PILLAR3_2024H2", "", "Pillar 3 disclosure, 2024H2"), ("pillar3", "CBA-FY2025-X", "", "Pillar 3 disclosure, FY2025"),
    ("pillar3", "CBA_X", "Basis: own words", "own words"), ("apra_adi", "A_2024Q4", "", "APRA quarterly statistics"),
    ("rating_agency", "S", "basis:", "Source disclosure"), ("rba", "R", "", "RBA FSR / SMP aggregate"),
    ("listed_peer", "L_2024Q4", "n", "Listed-peer disclosure, 2024Q4"), ("regulatory", "R", "", "APS 113 supervisory floor"),
    ("bureau", "B", "", "Bureau aggregate"), ("insolvency", "I", "", "insolvency disclosure"),
]


@query("reporting_basis", f"SELECT c_custkey, {_pick_sql('c_custkey % 10', [b[3] for b in BASIS])} AS reporting_basis FROM customer")
def reporting_basis(spark, sf):
    k = F.col("c_custkey") % 10
    return table(spark, sf, "customer").select("c_custkey", L.reporting_basis(
        *[pick(k, [b[i] for b in BASIS]) for i in range(3)]).alias("reporting_basis"))


# --- dates and periods -------------------------------------------------------------------------------

@query("fiscal_period_code", """
SELECT o_orderkey, CASE month(d) WHEN 6 THEN 'FY' || year(d) WHEN 12 THEN 'H1FY' || (year(d) + 1) ELSE year(d) || 'Q' || quarter(d) END AS june_code,
  CASE month(d) WHEN 3 THEN 'FY' || year(d) WHEN 9 THEN 'H1FY' || (year(d) + 1)
    ELSE 'Q' || ((month(d) + 8) % 12 // 3 + 1) || 'FY' || (CASE WHEN month(d) <= 3 THEN year(d) ELSE year(d) + 1 END) END AS march_code,
  CASE WHEN month(d) = 6 AND day(d) = 30 THEN 'FY' || year(d) WHEN month(d) = 12 AND day(d) = 31 THEN 'H1FY' || (year(d) + 1)
    ELSE 'FY' || (CASE WHEN month(d) <= 6 THEN year(d) ELSE year(d) + 1 END) || '_M' || lpad(month(d)::VARCHAR, 2, '0') END AS exact_code
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def fiscal_period_code(spark, sf):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf, "orders").select("o_orderkey", X.fiscal_period_code(d).alias("june_code"),
                                             X.fiscal_period_code(d, 3).alias("march_code"), X.exact_period_code(d).alias("exact_code"))


@query("quarter_end", f"SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN CAST({O.qend('o_orderdate')} AS DATE) END AS quarter_end FROM orders")
def quarter_end(spark, sf):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    cell = F.when(k == 0, d.cast("string")).when(k == 1, F.date_format(d, "MMM yyyy")).when(
        k == 2, F.date_format(d, "MMMM yyyy")).otherwise(F.lit("Total assets"))
    return table(spark, sf, "orders").select("o_orderkey", X.quarter_end(cell).alias("quarter_end"))


@query("parse_mixed_date", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) END AS published FROM orders""")
def parse_mixed_date(spark, sf):
    d, k = F.add_months(F.col("o_orderdate").cast("date"), 240), F.col("o_orderkey") % 5
    text = F.when(k == 0, F.concat(F.lit("Issue 7 of "), d.cast("string"), F.lit(" (final)"))).when(
        k == 1, F.concat(F.lit("Released "), F.date_format(d, "d MMMM yyyy"))).when(
        k == 2, F.concat(F.lit("on "), F.date_format(d, "d MMM yyyy"), F.lit(", Sydney"))).when(
        k == 3, F.date_format(d, "d/M/yyyy")).otherwise(F.lit("undated 31 Foo 2024"))
    return table(spark, sf, "orders").select("o_orderkey", X.parse_mixed_date(text).alias("published"))


@query("reporting_period_end", """
SELECT o_orderkey, last_day(d) AS index_month, d AS quarter_ended,
  CASE o_orderkey % 3 WHEN 0 THEN make_date(year(d) - 1, 12, 31) ELSE make_date(year(d), 6, 30) END AS half_year_end,
  CASE WHEN o_orderkey % 2 = 0 THEN d ELSE make_date(year(d), 6, 30) END AS annual_end, d AS cover_date
FROM (SELECT o_orderkey, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d FROM orders)""")
def reporting_period_end(spark, sf):
    d, k = F.add_months(F.col("o_orderdate").cast("date"), 240), F.col("o_orderkey")
    long, never = F.date_format(d, "d MMMM yyyy"), F.lit(None).cast("date")
    index = F.when(k % 2 == 0, F.concat(F.lit("Arrears as of "), F.date_format(d, "MMMM d, yyyy"))).otherwise(
        F.concat(F.lit("Index for "), F.date_format(d, "MMMM yyyy")))
    quarter = F.concat(pick(k % 2, ["Results for the quarter ended ", "Book as at "]), long)
    half = F.concat(pick(k % 3, ["1H FY", "2H FY", "FY"]), F.when(k % 2 == 0, F.date_format(d, "yy")).otherwise(F.date_format(d, "yyyy")), F.lit(" results"))
    annual = F.when(k % 2 == 0, F.concat(F.lit("for the year ended "), long)).otherwise(F.concat(F.lit("Report FY"), F.date_format(d, "yy")))
    return table(spark, sf, "orders").select(
        "o_orderkey", X.month_end_in_text(index).alias("index_month"), X.quarter_ended(quarter, never).alias("quarter_ended"),
        X.half_year_end(half, never).alias("half_year_end"), X.annual_period_end(annual, never).alias("annual_end"),
        X.cover_date(F.concat(F.lit("Disclosure for the half-year ended "), long)).alias("cover_date"))


@query("page_as_of_date", """
SELECT o_orderkey, d AS wbc, d AS nab, make_date(year(d), 9, 30) AS anz, CASE WHEN month(d) IN (6, 12) THEN d END AS cba
FROM (SELECT o_orderkey, CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) AS d FROM orders)""")
def page_as_of_date(spark, sf):
    d, k = F.add_months(F.col("o_orderdate").cast("date"), 240), F.col("o_orderkey")
    long, short = F.date_format(d, "d MMMM yyyy"), F.date_format(d, "d MMM yy")

    def page(line):
        return F.concat(F.lit("Table 4\nprose as at some time\n"), line, F.lit("\nManufacturing 1 2 3"))

    return table(spark, sf, "orders").select(
        "o_orderkey", X.page_as_of_date(page(F.concat(F.lit("As at "), long)), "wbc").alias("wbc"),
        X.page_as_of_date(page(F.concat(F.lit("  As at "), F.when(k % 2 == 0, short).otherwise(long))), "nab").alias("nab"),
        X.page_as_of_date(page(F.concat(F.lit("Sep "), F.date_format(d, "yy"))), "anz").alias("anz"),
        X.page_as_of_date(page(long), "cba").alias("cba"))


# --- table cells and labels --------------------------------------------------------------------------------

@query("coerce_metric_cell", """
SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1) THEN CAST(round(o_totalprice) AS BIGINT)::DOUBLE WHEN o_orderkey % 6 IN (3, 4) THEN 0.0 END AS value,
  CASE WHEN o_orderkey % 6 IN (2, 5) THEN 'published_as_dash' END AS redaction FROM orders""")
def coerce_metric_cell(spark, sf):
    k = F.col("o_orderkey") % 6
    n = F.format_number(F.round("o_totalprice"), 0)
    token = F.when(k == 0, n).when(k == 1, F.concat(F.lit("("), n, F.lit(")"))).when(k == 5, F.concat(F.lit("("), n)).otherwise(F.lit("-"))
    bank = pick(k, ["cba", "nab", "wbc", "nab", "cba", "anz"])
    industry = F.when(k == 3, F.lit("Government and public authorities")).otherwise(F.lit("Manufacturing"))
    ref = F.when(k == 4, F.lit("CRB(e)(ii)")).otherwise(F.lit("CRB(f)"))
    return table(spark, sf, "orders").select("o_orderkey", X.coerce_metric_cell(bank, industry, token, ref).alias("c")).select("o_orderkey", "c.*")


PORTFOLIO_LABELS = ["Residential housing loans", "Commercial Property", "SME business", "Specialised lending", "Trade - other", "CRE corporate"]
PORTFOLIO_CLASSES = ["residential_mortgage", "commercial_property_investment", "corporate_sme", "development", "trade___other", "commercial_property_investment"]
BAND_LABELS = ["Corporate (incl. SME corporate)", "Corporate", "RBNZ regulated entities Retail", "SME Retail", "Sovereign", "Leases"]
BAND_CLASSES = ["corporate_sme", "corporate_general", "rbnz_retail", "retail_sme", "sovereign", None]


@query("asset_label_contains", f"""SELECT c_custkey, {_pick_sql('c_custkey % 6', PORTFOLIO_CLASSES)} AS table_class,
  {_pick_sql('c_custkey % 6', BAND_CLASSES)} AS band_class FROM customer""")
def asset_label_contains(spark, sf):
    k = F.col("c_custkey") % 6
    return table(spark, sf, "customer").select(
        "c_custkey", X.label_class(pick(k, PORTFOLIO_LABELS)).alias("table_class"),
        X.contains_class(pick(k, BAND_LABELS), V.BAND_TABLE_PORTFOLIOS).alias("band_class"))


ALIAS_TEXT = ["CRE lending in NSW", "construction", "Small and medium business", "sme", "Leasing"]
ALIAS_SEGMENT = ["commercial_property", "development", "sme_corporate", "sme_corporate", None]


@query("map_segment", f"SELECT c_custkey, {_pick_sql('c_custkey % 5', ALIAS_SEGMENT)} AS segment FROM customer")
def map_segment(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.map_segment("judo", pick(F.col("c_custkey") % 5, ALIAS_TEXT)).alias("segment"))


@query("band_slug", "SELECT c_custkey, ['0P00_TO_LT0P15', '100P00_DEFAULT', ''][(c_custkey % 3 + 1)::INT] AS slug FROM customer")
def band_slug(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", X.band_slug(pick(F.col("c_custkey") % 3, ["0.00 to <0.15", "100.00 (Default)", "Aggregate"])).alias("slug"))


@query("url_slug", """
SELECT page_id, 'report-' || page_id || '-q4' AS slug, '.pdf' AS suffix, 'report-' || page_id || '-q4.pdf' AS filename FROM pages""")
def url_slug(spark, sf):
    url = F.concat(F.lit("https://www.site.example/a/b/Report "), F.col("page_id").cast("string"), F.lit("__Q4.PDF?x=1#top"))
    return table(spark, sf, "pages").select("page_id", X.url_slug(url).alias("slug"), X.url_suffix(url).alias("suffix"),
                                            X.publication_filename(url, F.lit("t")).alias("filename"))


@query("long_url_slug", """
SELECT page_id, side, repeat('quarterly-report-', 6)[:80] || '-' || sha256('https://www.site.example/a/' || repeat('Quarterly_Report_', 6) || page_id || '_' || side || '.pdf')[:12] AS slug
FROM pages CROSS JOIN (VALUES ('a'), ('b')) AS t(side)""")
def long_url_slug(spark, sf):
    """Two addresses per page that agree on more characters than a file name keeps."""
    side = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side")
    url = F.concat(F.lit("https://www.site.example/a/" + "Quarterly_Report_" * 6), F.col("page_id").cast("string"), F.lit("_"), F.col("side"), F.lit(".pdf"))
    return table(spark, sf, "pages").select("page_id", side).select("page_id", "side", X.url_slug(url).alias("slug"))


@query("portfolio_size", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey % 90 + 1 AS INT) WHEN 1 THEN CAST((o_custkey % 90 + 1) * 100 AS INT) END AS size_m FROM orders""")
def portfolio_size(spark, sf):
    n, k = F.col("o_custkey") % 90 + 1, F.col("o_orderkey") % 3
    text = F.when(k == 0, F.concat(F.lit("Loan portfolio of $"), n.cast("string"), F.lit("M"))).when(
        k == 1, F.concat(F.lit("the loan  portfolio grew to $ "), F.format_string("%.1f", n / 10), F.lit(" billion"))).otherwise(F.lit("portfolio up"))
    return table(spark, sf, "orders").select("o_orderkey", X.portfolio_size(text).alias("size_m"))


@query("business_lending", f"""
SELECT c_custkey, {_pick_sql('c_custkey % 15', V.INDUSTRY_BUCKETS)} AS canonical_bucket,
  {_pick_sql('c_custkey % 15', V.INDUSTRY_BUCKETS)} NOT IN {O.in_list(V.CONSUMER_BUCKETS)} AS business_lending FROM customer""")
def business_lending(spark, sf):
    from tidemark.operators.industry import with_business_lending

    rows = table(spark, sf, "customer").select("c_custkey", pick(F.col("c_custkey") % 15, list(V.INDUSTRY_BUCKETS)).alias("canonical_bucket"))
    return with_business_lending(rows, tables.industry_buckets(spark))
