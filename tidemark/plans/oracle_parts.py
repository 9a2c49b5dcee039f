"""DuckDB text for the projections of ``sources.testbed`` and shared clauses."""

from __future__ import annotations

from collections.abc import Mapping


def case(key: str, table: Mapping[str, str], default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in table.items())
    return f"CASE {key} {whens} ELSE {default} END"


def _q(text: str) -> str:
    return "'" + str(text).replace("'", "''") + "'"


def values(rows, names: str) -> str:
    def lit(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "TRUE" if x else "FALSE"
        if isinstance(x, (int,)):
            return str(x)
        if isinstance(x, float):
            return f"{x!r}::DOUBLE"
        return _q(x)

    body = ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {body}) AS t({names}))"


def in_list(items) -> str:
    return "(" + ", ".join(_q(i) for i in items) + ")"


QEND = "last_day(date_trunc('quarter', {d}) + INTERVAL 2 MONTH)"


def qend(date: str) -> str:
    return QEND.format(d=date)


OBS = f"""
obs0 AS (
  SELECT *, list_value('CBA','NAB','WBC','ANZ','MACQUARIE','JUDO','APRA','APS113')[(l_suppkey % 8 + 1)::INT] AS head,
         list_value('pd','lgd','arrears','npl','impaired','loss_rate','commentary')[l_linenumber] AS parameter,
         CAST(l_shipdate AS DATE) AS ship
  FROM lineitem JOIN part ON p_partkey = l_partkey),
obs AS (
  SELECT head || '_' || l_suppkey || CASE WHEN parameter <> 'lgd' THEN '' WHEN l_returnflag = 'R' THEN '_ECL_LGD' ELSE '_LGD' END AS source_id,
    CASE head WHEN 'JUDO' THEN 'non_bank_listed' WHEN 'APRA' THEN 'apra_qpex' WHEN 'APS113' THEN 'apra_performance' ELSE 'bank_pillar3' END AS source_type,
    CASE p_type WHEN 'ECONOMY' THEN 'residential_mortgage' WHEN 'LARGE' THEN 'commercial_property_investment' WHEN 'MEDIUM' THEN 'corporate_sme'
      WHEN 'PROMO' THEN 'development' WHEN 'SMALL' THEN 'invoice_finance' WHEN 'STANDARD' THEN 'working_capital_unsecured' END AS stored_segment,
    CASE WHEN p_size % 10 = 0 THEN 'special' END AS stored_product,
    parameter,
    CASE WHEN parameter = 'pd' AND head = 'APS113' THEN 'regulatory_floor_pd' WHEN parameter = 'pd' THEN 'basel_pd_one_year'
      WHEN parameter = 'lgd' AND head = 'APS113' THEN 'regulatory_floor_lgd' WHEN parameter = 'lgd' THEN 'realised_loss_rate'
      WHEN parameter = 'arrears' AND l_returnflag = 'A' THEN 'arrears_90_plus_days' WHEN parameter = 'arrears' THEN 'arrears_30_plus_days'
      WHEN parameter = 'npl' THEN 'npl_ratio' WHEN parameter = 'impaired' THEN 'impaired_loans_ratio'
      WHEN parameter = 'loss_rate' AND l_returnflag = 'A' THEN 'realised_loss_rate' WHEN parameter = 'loss_rate' THEN 'loss_expense_rate'
      ELSE 'qualitative_commentary' END AS data_definition_class,
    CASE WHEN parameter <> 'commentary' THEN round(l_discount + l_tax, 4) END AS value,
    CAST({qend('ship')} AS DATE) AS as_of_date,
    'Disclosure ' || year(ship) || 'Q' || quarter(ship) AS reporting_basis,
    'Published by ' || head AS methodology_note,
    CAST(l_quantity AS INT) AS sample_size_n,
    CAST(date_trunc('quarter', ship) AS DATE) AS period_start,
    CAST({qend('ship')} AS DATE) AS period_end,
    'https://disclosure.example/' || lower(head) AS source_url,
    'row ' || l_linenumber AS page_or_table_ref,
    (l_orderkey * 8 + l_linenumber) * 1048576 + l_partkey % 1048576 AS obs_seq
  FROM obs0)"""

PRODUCT = """CASE {s} WHEN 'bridging_residential' THEN 'bridging' WHEN 'corporate_sme' THEN 'term_loan'
  WHEN 'sme_corporate' THEN 'term_loan' WHEN 'working_capital_unsecured' THEN 'line_of_credit' ELSE {s} END"""

# read side: alias applied, product defaulted
READ = f"""
rd AS (
  SELECT *, COALESCE(NULLIF(stored_product, ''), {PRODUCT.format(s='segment')}) AS product FROM (
    SELECT *, CASE WHEN stored_segment = 'commercial_property_investment' THEN 'commercial_property' ELSE stored_segment END AS segment FROM obs))"""

NEWEST = "ORDER BY as_of_date DESC, stored_segment, obs_seq, value"

LATEST = f"""
latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY segment, product, parameter, source_id {NEWEST}) AS rn
    FROM rd WHERE value IS NOT NULL) WHERE rn = 1)"""

DIRECT_LGD = """(parameter = 'lgd' AND (data_definition_class = 'regulatory_floor_lgd'
  OR (contains(upper(source_id), 'LGD') AND NOT regexp_matches(upper(source_id), 'ECL|IMPAIR|LOSS_RATE|REALISED_LOSS'))))"""

MODEL = f"""
model AS (
  SELECT *, CASE WHEN parameter = 'lgd' AND NOT {DIRECT_LGD} THEN 'loss_rate' ELSE parameter END AS model_parameter
  FROM latest)"""

SUMMARY = """
summary AS (
  SELECT segment, product, model_parameter, median(value) AS med, min(value) AS lo, max(value) AS hi,
         count(*) AS n, max(as_of_date) AS as_of_date
  FROM model GROUP BY ALL)"""

COHORT = """CASE WHEN contains(upper(source_id), 'APS113') THEN 'regulatory_floor'
  WHEN source_type IN ('bank_pillar3', 'pillar3') THEN CASE
    WHEN split_part(replace(lower(source_id), '-', '_'), '_', 1) IN ('cba','nab','wbc','anz') THEN 'peer_big4'
    WHEN split_part(replace(lower(source_id), '-', '_'), '_', 1) IN ('mqg','macquarie') THEN 'peer_other_major_bank'
    ELSE 'peer_non_bank' END
  WHEN source_type IN ('apra_performance','apra_qpex','apra_adi','apra_non_adi','rba_aggregate','rba') THEN 'regulator_aggregate'
  WHEN source_type IN ('rating_agency_index','rating_agency') THEN 'rating_agency'
  WHEN source_type = 'regulatory' THEN 'regulatory_floor'
  WHEN source_type IN ('non_bank_listed','listed_peer') THEN 'peer_non_bank'
  ELSE 'industry_body' END"""

BIG4 = "split_part(replace(lower(source_id), '-', '_'), '_', 1) IN ('cba','nab','wbc','anz')"


def title(expr: str) -> str:
    return ("array_to_string(list_transform(string_split(replace(" + expr + ", '_', ' '), ' '), "
            "lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')")


def segment_label(expr: str = "segment") -> str:
    return f"replace(replace(replace({title(expr)}, 'Sme', 'SME'), 'Adi', 'ADI'), 'Lgd', 'LGD')"


def head(expr: str = "source_id") -> str:
    return f"split_part(replace(lower({expr}), '-', '_'), '_', 1)"


def dec6(expr: str) -> str:
    """Half-up rounding to six places on the decimal reading of a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28, 12)), 6) AS DOUBLE)"


def with_(*parts: str, body: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + body
