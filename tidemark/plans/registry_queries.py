"""Observation reads, flags, registry, refresh and governance queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators import checks, flags, governance, latest as latest_ops, registry
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.session import staged
from tidemark.sources import tables, testbed

AS_OF = dt.date(2001, 12, 31)
REVIEW_DATE = dt.date(2024, 12, 31)
RULES = flags.FlagRules(as_of=AS_OF)

DAYS = {k: str(v) for k, v in V.REFRESH_DAYS.items()}
STALE_LIMIT = f"""CAST(COALESCE({O.case('source_type', DAYS)}, {O.case(O.case('source_type', V.REFRESH_FAMILY), DAYS)}, '210') AS INT)"""

COH = f"coh AS (SELECT *, {O.COHORT} AS cohort FROM rd)"
OBS3 = (O.OBS, O.READ, COH)
PEER = "parameter = 'pd' AND value IS NOT NULL AND cohort IN ('peer_big4', 'peer_non_bank')"
BIG = "parameter = 'pd' AND value IS NOT NULL AND cohort = 'peer_big4'"
NON = "parameter = 'pd' AND value IS NOT NULL AND cohort = 'peer_non_bank'"

SEGMED = f"""
segmed AS (
  SELECT segment, count(*) AS n_sources, count(DISTINCT source_id) AS n_distinct_sources,
    median(value) FILTER (WHERE {PEER}) AS pm, max(value) FILTER (WHERE {PEER}) AS pmax, min(value) FILTER (WHERE {PEER}) AS pmin,
    median(value) FILTER (WHERE {BIG}) AS bm, max(value) FILTER (WHERE {BIG}) AS bmax, min(value) FILTER (WHERE {BIG}) AS bmin,
    count(*) FILTER (WHERE {BIG}) AS bn, median(value) FILTER (WHERE {NON}) AS nm
  FROM coh GROUP BY segment)"""
FLAGSRC = f"""
flagsrc AS (
  SELECT DISTINCT segment, 'outlier' AS flag_type, source_id FROM coh JOIN segmed USING (segment)
  WHERE {PEER} AND pm > 0 AND (value > 2.0 * pm OR value < pm / 2.0)
  UNION ALL
  SELECT DISTINCT segment, 'stale', source_id FROM coh WHERE date_diff('day', as_of_date, DATE '2001-12-31') > {STALE_LIMIT})"""
FLAGS = """
flags AS (
  SELECT segment, n_sources, n_distinct_sources,
    round(CASE WHEN pm > 0 THEN (pmax - pmin) / pm END, 8) AS spread_decimal,
    round(CASE WHEN bn >= 2 AND bm > 0 THEN (bmax - bmin) / bm END, 8) AS big4_spread_decimal,
    round(CASE WHEN bm > 0 THEN nm / bm END, 8) AS peer_big4_vs_non_bank_ratio,
    (SELECT count(*) FROM flagsrc f WHERE f.segment = s.segment AND flag_type = 'outlier') AS n_outlier_sources,
    (SELECT count(*) FROM flagsrc f WHERE f.segment = s.segment AND flag_type = 'stale') AS n_stale_sources,
    CAST(NULL AS VARCHAR) AS frozen_dataset_banner
  FROM segmed s)"""

RAW_COLUMNS = ["source_id", "source_type", "segment", "product", "parameter", "data_definition_class", "value", "as_of_date",
               "reporting_basis", "methodology_note", "sample_size_n", "period_start", "period_end", "source_url",
               "page_or_table_ref", "obs_seq"]
_RAW = "source_id, source_type, {seg}, stored_product AS product, parameter, data_definition_class, value, as_of_date, reporting_basis, methodology_note, sample_size_n, period_start, period_end, source_url, page_or_table_ref, obs_seq"
RAW = _RAW.format(seg="stored_segment AS segment")
CANON = _RAW.format(seg="segment")


def _obs(spark, sf):
    return testbed.observations(spark, sf).select(*RAW_COLUMNS)


# --- observation reads -------------------------------------------------------------------

@query("scan_observations", O.with_(O.OBS, body=f"SELECT {RAW} FROM obs"))
def scan_observations(spark, sf):
    return _obs(spark, sf)


@query("query_observations", O.with_(O.OBS, O.READ, body=f"""
SELECT {CANON} FROM rd WHERE segment = 'commercial_property' AND source_type = 'bank_pillar3' AND parameter = 'arrears'
  AND as_of_date >= DATE '1998-01-01' AND data_definition_class = 'arrears_90_plus_days'"""))
def query_observations(spark, sf):
    return registry.query_observations(
        _obs(spark, sf), segment="commercial_property", source_type="bank_pillar3", parameter="arrears",
        since=dt.date(1998, 1, 1), definition_classes=["arrears_90_plus_days"])


@query("for_segment", O.with_(*OBS3, SEGMED, FLAGSRC, FLAGS, body="""
SELECT segment, source_id, value, as_of_date, spread_decimal, n_sources FROM rd JOIN flags USING (segment)
WHERE segment = 'development' AND parameter = 'pd'"""))
def for_segment(spark, sf):
    obs = _obs(spark, sf)
    rows = registry.for_segment(obs, "development")
    marks = flags.validation_flags(registry.for_segment(obs, "development", only_pd=False), RULES)
    return rows.join(marks.select("segment", "spread_decimal", "n_sources"), "segment").select(
        "segment", "source_id", "value", "as_of_date", "spread_decimal", "n_sources")


@query("by_source_type", O.with_(O.OBS, O.READ, body=f"""
SELECT 'big4' AS side, source_id, segment, parameter, value, as_of_date FROM rd WHERE {O.BIG4} AND parameter = 'npl'
UNION ALL SELECT 'other', source_id, segment, parameter, value, as_of_date FROM rd WHERE NOT {O.BIG4} AND parameter = 'npl'"""))
def by_source_type(spark, sf):
    rows = registry.query_observations(_obs(spark, sf), parameter="npl").select(
        "source_id", "segment", "parameter", "value", "as_of_date")
    return registry.with_side(rows)


@query("list_segments", O.with_(O.OBS, O.READ, body="SELECT DISTINCT segment FROM rd"))
def list_segments(spark, sf):
    return registry.list_segments(_obs(spark, sf))


@query("latest_per_source", O.with_(O.OBS, O.READ, body=f"""
SELECT source_id, segment, parameter, value, as_of_date FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY as_of_date DESC, stored_segment, obs_seq, value NULLS FIRST) AS rn FROM rd) WHERE rn = 1"""))
def latest_per_source(spark, sf):
    return latest_ops.latest_per_source(_obs(spark, sf)).select("source_id", "segment", "parameter", "value", "as_of_date")


@query("raw_observation_export", O.with_(*OBS3, body=f"""
SELECT source_id, source_type, cohort, {O.BIG4} AS is_big4, segment, COALESCE(stored_product, '') AS product, parameter,
  data_definition_class, CASE WHEN value IS NULL THEN '' ELSE printf('%.6f', value) END AS value, CAST(as_of_date AS VARCHAR) AS as_of_date,
  reporting_basis, methodology_note, CAST(sample_size_n AS VARCHAR) AS sample_size_n, CAST(period_start AS VARCHAR) AS period_start,
  CAST(period_end AS VARCHAR) AS period_end, source_url, page_or_table_ref FROM coh"""))
def raw_observation_export(spark, sf):
    return registry.raw_observation_export(_obs(spark, sf))


@query("sink_order", O.with_(O.OBS, O.READ, body="""
SELECT segment, source_id, as_of_date, parameter, value FROM rd ORDER BY segment, source_id, as_of_date DESC"""))
def sink_order(spark, sf):
    return registry.query_observations(_obs(spark, sf)).select(
        "segment", "source_id", "as_of_date", "parameter", "value").orderBy("segment", "source_id", F.desc("as_of_date"))


@query("observation_set_json", O.with_(*OBS3, SEGMED, FLAGSRC, FLAGS, body="""
SELECT segment, 'observation' AS kind, source_id AS json_source_id, value AS json_value, CAST(NULL AS BIGINT) AS json_n_sources FROM rd
UNION ALL SELECT segment, 'flags', NULL, NULL, n_sources FROM flags"""))
def observation_set_json(spark, sf):
    obs = registry.query_observations(_obs(spark, sf))
    lines = registry.observation_set_json(obs, flags.validation_flags(_obs(spark, sf), RULES))
    return lines.select(
        "segment", "kind", F.get_json_object("json", "$.source_id").alias("json_source_id"),
        F.get_json_object("json", "$.value").cast("double").alias("json_value"),
        F.get_json_object("json", "$.n_sources").cast("long").alias("json_n_sources"))


# --- flags and trend --------------------------------------------------------------------------

@query("validation_flags", O.with_(*OBS3, SEGMED, FLAGSRC, FLAGS, body="SELECT * FROM flags"))
def validation_flags(spark, sf):
    return flags.validation_flags(_obs(spark, sf), RULES)


@query("validation_flag_sources", O.with_(*OBS3, SEGMED, FLAGSRC, body="SELECT * FROM flagsrc"))
def validation_flag_sources(spark, sf):
    return flags.validation_flag_sources(_obs(spark, sf), RULES)


@query("reference_anchors", O.with_(*OBS3, body=f"""
SELECT segment, source_id, cohort, value, as_of_date,
  CAST(list_position(['peer_other_major_bank','regulator_aggregate','rating_agency','regulatory_floor','industry_body'], cohort) - 1 AS INT) AS cohort_rank
FROM (SELECT *, row_number() OVER (PARTITION BY segment, source_id, cohort ORDER BY stored_segment, as_of_date DESC, obs_seq, value) AS rn
  FROM coh WHERE value IS NOT NULL AND cohort IN {O.in_list(V.REFERENCE_COHORTS)}) WHERE rn = 1"""))
def reference_anchors(spark, sf):
    return flags.reference_anchors(_obs(spark, sf))


@query("observation_staleness", O.with_(O.OBS, body=f"""
SELECT source_id, source_type, max(as_of_date) AS as_of_date, CAST(date_diff('day', max(as_of_date), DATE '2001-12-31') AS INT) AS days_old,
  {STALE_LIMIT} AS threshold_days, date_diff('day', max(as_of_date), DATE '2001-12-31') > {STALE_LIMIT} AS stale
FROM obs GROUP BY source_id, source_type"""))
def observation_staleness(spark, sf):
    return flags.observation_staleness(_obs(spark, sf), AS_OF)


TREND = """
perdate AS (
  SELECT segment, parameter, source_id, as_of_date, arg_min(value, obs_seq) AS value
  FROM rd WHERE value IS NOT NULL GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER w AS rn, lead(value) OVER w AS pv, lead(as_of_date) OVER w AS pd
  FROM perdate WINDOW w AS (PARTITION BY segment, parameter, source_id ORDER BY as_of_date DESC))"""


@query("segment_trend", O.with_(O.OBS, O.READ, TREND, body="""
SELECT segment, parameter, source_id, value AS current_value, as_of_date AS current_as_of, pv AS prior_value, pd AS prior_as_of,
  round(value - pv, 8) AS delta, CASE WHEN pv <> 0 THEN round((value - pv) / pv, 8) END AS pct_change
FROM ranked WHERE rn = 1 AND pd IS NOT NULL"""))
def segment_trend(spark, sf):
    return latest_ops.segment_trend(_obs(spark, sf))


# --- row validation -------------------------------------------------------------------------------

@query("validate_observations", O.with_(O.OBS, body="""
SELECT source_id, parameter, obs_seq, array_to_string(list_filter([
    CASE WHEN period_start > pe THEN 'period_order' END,
    CASE WHEN parameter <> 'commentary' AND v IS NULL THEN 'value_missing' END,
    CASE WHEN parameter <> 'commentary' AND NOT (v BETWEEN 0 AND 1) THEN 'value_out_of_range' END,
    CASE WHEN parameter = 'pd' AND data_definition_class = 'npl_ratio' THEN 'definition_not_legal' END,
    CASE WHEN lower(note) LIKE 'migrated from%' THEN 'placeholder_note' END], lambda e: e IS NOT NULL), ',') AS errors
FROM (SELECT *, CASE WHEN sample_size_n = 1 THEN period_start - 1 ELSE period_end END AS pe,
    CASE WHEN sample_size_n = 2 THEN NULL WHEN sample_size_n = 3 AND value IS NOT NULL THEN value + 1.5 ELSE value END AS v,
    CASE WHEN sample_size_n = 5 THEN 'Migrated from v1' ELSE methodology_note END AS note
  FROM (SELECT * REPLACE (CASE WHEN sample_size_n = 4 AND parameter = 'pd' THEN 'npl_ratio' ELSE data_definition_class END AS data_definition_class) FROM obs))"""))
def validate_observations(spark, sf):
    n = F.col("sample_size_n")
    broken = _obs(spark, sf).withColumns({
        "period_end": F.when(n == 1, F.date_sub("period_start", 1)).otherwise(F.col("period_end")),
        "value": F.when(n == 2, F.lit(None).cast("double")).when(n == 3, F.col("value") + 1.5).otherwise(F.col("value")),
        "data_definition_class": F.when((n == 4) & (F.col("parameter") == "pd"), F.lit("npl_ratio")).otherwise(F.col("data_definition_class")),
        "methodology_note": F.when(n == 5, F.lit("Migrated from v1")).otherwise(F.col("methodology_note")),
    })
    return checks.check_observations(broken).select("source_id", "parameter", "obs_seq", F.array_join("errors", ",").alias("errors"))


# --- registry ------------------------------------------------------------------------------------------

ARRIVALS = f"""
arr AS (
  SELECT event_type || '_' || user_id AS source_id,
    {O.case('event_type', testbed.EVENT_PUBLISHERS)} AS publisher, {O.case('event_type', testbed.EVENT_SOURCE_TYPES)} AS source_type,
    CASE WHEN user_id % 3 = 0 THEN 'lgd' ELSE 'pd' END AS data_type, event_type AS asset_class, 'AU' AS geography,
    'https://disclosure.example/' || event_type AS url, props AS notes, round(abs(value) / 1000, 6) AS value,
    CAST(ts AS DATE) AS value_date, 1 AS period_years,
    CASE WHEN user_id % 5 = 0 THEN 'downturn' WHEN user_id % 5 = 1 THEN 'normal' END AS condition,
    CASE WHEN user_id % 3 = 0 AND user_id % 2 = 0 THEN 'haircut' END AS component,
    CAST(ts AS DATE) + 1 AS retrieval_date, ['HIGH','MEDIUM','LOW'][(user_id % 3 + 1)::INT] AS quality_score,
    ts AS arrived, event_id
  FROM events)"""
BENCH = """
bench AS (
  SELECT *, CASE WHEN version < max(version) OVER (PARTITION BY source_id) THEN source_id END AS superseded_by FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY source_id ORDER BY arrived, event_id) AS INT) AS version
    FROM arr WHERE value_date < DATE '2024-01-24')),
live AS (SELECT * FROM bench WHERE superseded_by IS NULL)"""
# a refresh meets the registry as it stood on the split date; all other reads see every arrival
REG_SPLIT = (ARRIVALS, BENCH)
REG = (ARRIVALS, BENCH.replace(f"WHERE value_date < DATE '{testbed.SPLIT_DATE}'", ""))
BCOLS = ("source_id, version, publisher, source_type, data_type, asset_class, geography, url, notes, value, value_date, period_years, "
         "condition, component, retrieval_date, quality_score, superseded_by")
BLIST = [c.strip() for c in BCOLS.split(",")]


def _bench(spark, sf, before=None):
    return testbed.benchmarks(spark, sf, before).select(*BLIST)


@query("scan_benchmarks_latest", O.with_(*REG, body=f"SELECT {BCOLS} FROM live"))
def scan_benchmarks_latest(spark, sf):
    return tables.live_versions(_bench(spark, sf))


@query("assign_versions", O.with_(*REG, body="SELECT source_id, version, value, value_date, superseded_by FROM bench"))
def assign_versions(spark, sf):
    return _bench(spark, sf).select("source_id", "version", "value", "value_date", "superseded_by")


@query("get_by_segment", O.with_(*REG, body=f"""
SELECT {BCOLS} FROM live WHERE asset_class = 'view' AND data_type = 'lgd' AND component = 'haircut'"""))
def get_by_segment(spark, sf):
    return registry.get_by_segment(_bench(spark, sf), "view", "lgd", component="haircut")


@query("get_by_source_type", O.with_(*REG, body=f"SELECT {BCOLS} FROM live WHERE source_type = 'pillar3'"))
def get_by_source_type(spark, sf):
    return registry.get_by_source_type(_bench(spark, sf), "pillar3")


@query("version_history", O.with_(*REG, body=f"SELECT {BCOLS} FROM bench WHERE source_id = 'view_5' ORDER BY version"))
def version_history(spark, sf):
    return registry.version_history(_bench(spark, sf), "view_5").orderBy("version")


@query("list_benchmarks", O.with_(*REG, body=f"SELECT {BCOLS} FROM live WHERE source_type = 'rba' ORDER BY source_id, version"))
def list_benchmarks(spark, sf):
    return registry.list_benchmarks(_bench(spark, sf), source_type="rba")


@query("registry_export", O.with_(*REG, body="""
SELECT source_id, version, source_id AS json_id, value AS json_value, publisher AS json_publisher FROM bench"""))
def registry_export(spark, sf):
    out = registry.registry_export(_bench(spark, sf), latest_only=False)
    return out.select("source_id", "version", F.get_json_object("record", "$.source_id").alias("json_id"),
                      F.get_json_object("record", "$.value").cast("double").alias("json_value"),
                      F.get_json_object("record", "$.publisher").alias("json_publisher"))


@query("validate_benchmarks", O.with_(ARRIVALS, body="""
SELECT source_id, event_id, array_to_string(list_filter([
    CASE WHEN value_date > rd THEN 'value_after_retrieval' END,
    CASE WHEN comp IS NOT NULL AND data_type <> 'lgd' THEN 'component_not_allowed' END,
    CASE WHEN comp IS NULL AND NOT (v BETWEEN 0 AND 1) THEN 'value_out_of_range' END,
    CASE WHEN comp = 'haircut' AND NOT (v BETWEEN 0 AND 1) THEN 'component_out_of_range' END,
    CASE WHEN comp = 'discount_rate' AND NOT v > 0 THEN 'component_not_positive' END], lambda e: e IS NOT NULL), ',') AS errors
FROM (SELECT *, CASE WHEN event_id % 13 = 0 THEN value_date - 1 ELSE retrieval_date END AS rd,
  CASE WHEN event_id % 17 = 0 THEN 'discount_rate' ELSE component END AS comp,
  CASE WHEN event_id % 19 = 0 THEN -value WHEN event_id % 23 = 0 THEN value + 1 ELSE value END AS v FROM arr)"""))
def validate_benchmarks(spark, sf):
    e = F.col("event_id")
    broken = testbed.benchmark_arrivals(spark, sf).withColumns({
        "retrieval_date": F.when(e % 13 == 0, F.date_sub("value_date", 1)).otherwise(F.col("retrieval_date")),
        "component": F.when(e % 17 == 0, F.lit("discount_rate")).otherwise(F.col("component")),
        "value": F.when(e % 19 == 0, -F.col("value")).when(e % 23 == 0, F.col("value") + 1).otherwise(F.col("value")),
        "version": F.lit(1),
    })
    return checks.check_benchmarks(broken).select("source_id", "event_id", F.array_join("errors", ",").alias("errors"))


# --- refresh -------------------------------------------------------------------------------------------------

INCOMING = """
inc AS (
  SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN source_id || '_new' ELSE source_id END AS source_id,
      CASE WHEN event_id % 3 = 0 THEN 0.05 ELSE value END AS value),
    CASE WHEN event_id % 11 = 0 THEN value_date - 10 ELSE value_date END AS vd FROM arr WHERE value_date >= DATE '2024-01-24'),
reg AS (SELECT source_id, arg_max(value_date, version) AS rdate, arg_max(value, version) AS rvalue FROM bench GROUP BY source_id),
seq AS (
  SELECT i.*, rdate, rvalue,
    max(vd) OVER (PARTITION BY source_id ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bdate,
    lag(value) OVER (PARTITION BY source_id, vd ORDER BY arrived, event_id) AS pvalue
  FROM inc i LEFT JOIN reg USING (source_id)),
acts AS (
  SELECT source_id, event_id, value, vd AS value_date,
    CASE WHEN rdate IS NULL AND bdate IS NULL THEN 'add'
      WHEN greatest(rdate, bdate) > vd THEN 'skip_newer_in_registry'
      WHEN greatest(rdate, bdate) = vd AND value = COALESCE(pvalue, rvalue) THEN 'skip_unchanged'
      ELSE 'supersede' END AS action,
    CASE WHEN rdate IS NULL AND bdate IS NULL THEN 'new source_id'
      WHEN greatest(rdate, bdate) > vd THEN 'a later value_date than ' || vd || ' is already held'
      WHEN greatest(rdate, bdate) = vd AND value = COALESCE(pvalue, rvalue) THEN 'identical value_date and value already in registry'
      WHEN greatest(rdate, bdate) = vd THEN 'value correction (same date, new value)'
      ELSE 'newer data (' || greatest(rdate, bdate) || ' -> ' || vd || ')' END AS reason
  FROM seq)"""


def _actions(spark, sf):
    hour = F.floor(F.col("arrived") / 3600000000)
    return registry.refresh_actions(testbed.incoming(spark, sf), _bench(spark, sf, testbed.SPLIT_DATE), testbed.arrival_order(), hour)


@query("refresh_actions", O.with_(*REG_SPLIT, INCOMING, body="SELECT * FROM acts"))
def refresh_actions(spark, sf):
    return _actions(spark, sf).select("source_id", "event_id", "value", "value_date", "action", "reason")


@query("refresh_counts", O.with_(*REG_SPLIT, INCOMING, body="SELECT action, count(*) AS n FROM acts GROUP BY action"))
def refresh_counts(spark, sf):
    return registry.refresh_counts(_actions(spark, sf))


@query("supersede_refusals", O.with_(*REG_SPLIT, INCOMING, body="""
SELECT source_id, count(*) AS n, min(value_date) AS first_date FROM acts WHERE source_id NOT IN (SELECT source_id FROM bench) GROUP BY source_id"""))
def supersede_refusals(spark, sf):
    """Sources of which there is nothing live to replace, among entries meant to replace one."""
    rows = registry.supersede_verdicts(_bench(spark, sf, testbed.SPLIT_DATE), testbed.incoming(spark, sf))
    return checks.quarantined(rows).groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.min("value_date").alias("first_date"))


@query("ingest_status", O.with_(*REG, body="SELECT source_type, max(retrieval_date) AS last_retrieval FROM bench GROUP BY source_type"))
def ingest_status(spark, sf):
    return registry.ingest_status(_bench(spark, sf))


@query("duplicate_versions", O.with_(*REG_SPLIT, INCOMING, body="""
SELECT source_id, version, 'batch' AS found_in FROM (SELECT source_id, user_version AS version FROM (
  SELECT source_id, 1 AS user_version FROM inc)) GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT DISTINCT source_id, 1, 'stored' FROM inc a WHERE EXISTS (SELECT 1 FROM bench b WHERE b.source_id = a.source_id AND b.version = 1)"""))
def duplicate_versions(spark, sf):
    return registry.duplicate_versions(testbed.incoming(spark, sf).withColumn("version", F.lit(1)), _bench(spark, sf, testbed.SPLIT_DATE))


BRIDGED = """
bridged AS (
  SELECT source_id, CASE source_type WHEN 'apra_adi' THEN 'apra_performance' WHEN 'pillar3' THEN 'non_bank_listed' WHEN 'rba' THEN 'rba_aggregate'
      WHEN 'listed_peer' THEN 'non_bank_listed' END AS source_type, asset_class AS segment, data_type AS parameter,
    CASE data_type WHEN 'pd' THEN 'basel_pd_one_year' ELSE 'realised_loss_rate' END AS data_definition_class, value, value_date AS as_of_date,
    CASE source_type WHEN 'apra_adi' THEN 'APRA quarterly statistics' WHEN 'pillar3' THEN 'Pillar 3 disclosure'
      WHEN 'rba' THEN 'RBA FSR / SMP aggregate' WHEN 'listed_peer' THEN 'Listed-peer disclosure' END AS reporting_basis,
    notes AS methodology_note, value_date AS period_end, url AS source_url
  FROM live)"""


@query("bridge_to_observations", O.with_(*REG, BRIDGED, body="""
SELECT * FROM bridged b WHERE NOT EXISTS (SELECT 1 FROM bench o WHERE o.source_id = b.source_id AND o.value_date = b.as_of_date AND o.version % 2 = 1)"""))
def bridge_to_observations(spark, sf):
    bench = _bench(spark, sf)
    held = bench.where(F.col("version") % 2 == 1).select(
        "source_id", F.col("asset_class").alias("segment"), F.col("data_type").alias("parameter"), F.col("value_date").alias("as_of_date"))
    return registry.bridge_to_observations(bench, held).drop(
        "product", "sample_size_n", "period_start", "page_or_table_ref")


# --- governance ------------------------------------------------------------------------------------------------

GOV_LIMIT = f"CAST(COALESCE({O.case('source_type', DAYS)}, '365') AS INT)"
GOV_STALE = f"""
gstale AS (
  SELECT source_id, source_type, retrieval_date, CAST(date_diff('day', retrieval_date, DATE '2024-12-31') AS INT) AS days_old,
    {GOV_LIMIT} AS threshold_days, date_diff('day', retrieval_date, DATE '2024-12-31') > {GOV_LIMIT} AS stale FROM live)"""
MATRIX = "matrix AS " + O.values([(k, *v) for k, v in V.QUALITY_MATRIX.items()], "source_type, " + ", ".join(V.QUALITY_DIMENSIONS))
_LOW = ", ".join(f"CASE WHEN {d} = 'LOW' THEN '{d}' END" for d in V.QUALITY_DIMENSIONS)
GOV_QUALITY = f"""
gqual AS (
  SELECT source_id, source_type, quality_score AS analyst_quality, {', '.join(V.QUALITY_DIMENSIONS)},
    array_to_string(list_filter([{_LOW}], lambda e: e IS NOT NULL), ',') AS low_dimensions
  FROM live LEFT JOIN matrix USING (source_type))"""
SEGS = """
segs AS (SELECT DISTINCT event_type AS segment FROM events UNION ALL SELECT 'never_published'),
own AS (SELECT event_type AS segment, round(avg(abs(value)) / 900, 6) AS value FROM events WHERE event_type <> 'view' GROUP BY 1)"""
GOV_PEER = """
gpeer0 AS (
  SELECT s.segment, o.value AS own, m.med, m.n FROM segs s LEFT JOIN own o USING (segment)
  LEFT JOIN (SELECT asset_class AS segment, median(value) AS med, count(*) AS n FROM live WHERE data_type = 'pd' GROUP BY 1) m USING (segment)),
gpeer AS (
  SELECT segment, CASE WHEN n IS NULL THEN 'no_peer_data' WHEN own IS NULL THEN 'no_own_estimate' ELSE 'compared' END AS status,
    CASE WHEN n IS NOT NULL THEN own END AS own, CASE WHEN own IS NOT NULL THEN round(med, 8) END AS peer_median, n AS peer_count,
    round(CASE WHEN med = 0 THEN 0 ELSE abs(own - med) / med END, 8) AS divergence,
    CASE WHEN med = 0 THEN 0 ELSE abs(own - med) / med END > 0.30 AS breached
  FROM gpeer0)"""
GOV_COVER = """
gcover AS (
  SELECT s.segment, count(DISTINCT source_id) AS source_count, count(DISTINCT source_id) >= 2 AS meets_threshold, 2 AS min_sources
  FROM segs s LEFT JOIN (SELECT * FROM live WHERE data_type = 'pd') l ON l.asset_class = s.segment GROUP BY s.segment)"""
GOV_DIV = """
gmed AS (SELECT asset_class AS segment, data_type, value_date, median(value) AS med, count(*) AS cohort_size FROM live WHERE source_type = 'pillar3' GROUP BY ALL),
gdiv0 AS (
  SELECT l.asset_class AS segment, l.data_type, l.value_date, 'compared' AS status, publisher, source_id, value, med, cohort_size,
    CASE WHEN med <= 0 OR value < 0 THEN NULL WHEN value = 0 THEN 'Infinity'::DOUBLE ELSE greatest(value / med, med / value) END AS ratio
  FROM live l JOIN gmed g ON g.segment = l.asset_class AND g.data_type = l.data_type AND g.value_date = l.value_date
  WHERE source_type = 'pillar3' AND cohort_size >= 3),
gdiv AS (
  SELECT segment, data_type, value_date, status, publisher, source_id, value, round(med, 8) AS peer_median, cohort_size,
    round(ratio, 8) AS divergence_ratio, COALESCE(ratio > 3.0, FALSE) AS breached FROM gdiv0
  UNION ALL SELECT segment, data_type, value_date, 'skipped_incomplete_cohort', NULL, NULL, NULL, NULL, cohort_size, NULL, NULL FROM gmed WHERE cohort_size < 3)"""


def _segments(spark, sf):
    events = testbed.table(spark, sf, "events")
    return events.select(F.col("event_type").alias("segment")).distinct().unionByName(
        tables.dimension(spark, [("never_published",)], "segment string"))


def _own(spark, sf):
    events = testbed.table(spark, sf, "events").where(F.col("event_type") != "view")
    return events.groupBy(F.col("event_type").alias("segment")).agg(
        F.round(F.avg(F.abs("value")) / 900, 6).alias("value"))


@query("staleness", O.with_(*REG, GOV_STALE, body="SELECT * FROM gstale"))
def staleness(spark, sf):
    return governance.stale_benchmarks(_bench(spark, sf), REVIEW_DATE)


@query("quality_assessment", O.with_(*REG, MATRIX, GOV_QUALITY, body="SELECT * FROM gqual"))
def quality_assessment(spark, sf):
    return governance.quality_assessment(_bench(spark, sf), tables.quality_matrix(spark))


@query("peer_comparison", O.with_(*REG, SEGS, GOV_PEER, body="""
SELECT segment, status, CASE WHEN status = 'compared' THEN own END AS own, CASE WHEN status = 'compared' THEN peer_median END AS peer_median,
  peer_count, CASE WHEN status = 'compared' THEN divergence END AS divergence, CASE WHEN status = 'compared' THEN breached END AS breached FROM gpeer"""))
def peer_comparison(spark, sf):
    return governance.peer_comparison(_bench(spark, sf), _segments(spark, sf), _own(spark, sf))


@query("coverage_report", O.with_(*REG, SEGS, GOV_COVER, body="SELECT * FROM gcover"))
def coverage_report(spark, sf):
    return governance.coverage_report(_bench(spark, sf), _segments(spark, sf))


@query("pillar3_divergence", O.with_(*REG, GOV_DIV, body="SELECT * FROM gdiv"))
def pillar3_divergence(spark, sf):
    return governance.pillar3_divergence(_bench(spark, sf))


@query("version_drift", O.with_(*REG, body="""
SELECT source_id, n_versions, first_value, last_value, CASE WHEN n_versions >= 2 AND first_value <> 0 THEN round(abs(last_value - first_value) / abs(first_value), 8) END AS drift,
  COALESCE(n_versions >= 2 AND first_value <> 0 AND abs(last_value - first_value) / abs(first_value) > 0.30, FALSE) AS flagged
FROM (SELECT source_id, count(*) AS n_versions, arg_min(value, version) AS first_value, arg_max(value, version) AS last_value FROM bench GROUP BY source_id)"""))
def version_drift(spark, sf):
    return governance.version_drift(_bench(spark, sf))


@query("annual_review", O.with_(*REG, SEGS, MATRIX, GOV_STALE, GOV_QUALITY, GOV_COVER, GOV_PEER, GOV_DIV, body="""
SELECT 'header' AS section, 'committee' AS kind, 'MRC (bank)' AS detail, count(*) AS n FROM segs
UNION ALL SELECT 'stale', 'findings', NULL, count(*) FROM gstale
UNION ALL SELECT 'quality', 'findings', NULL, count(*) FROM gqual
UNION ALL SELECT 'coverage', 'findings', NULL, count(*) FROM gcover
UNION ALL SELECT 'peer_comparison', 'findings', NULL, count(*) FROM gpeer
UNION ALL SELECT 'pillar3_peer_divergence', 'findings', NULL, count(*) FROM gdiv
UNION ALL SELECT 'stale', 'flag', 'stale:' || source_id, 1 FROM gstale WHERE stale
UNION ALL SELECT 'quality', 'flag', 'low_quality:' || source_id || ':' || low_dimensions, 1 FROM gqual WHERE low_dimensions <> ''
UNION ALL SELECT 'coverage', 'flag', 'low_coverage:' || segment || ':' || source_count, 1 FROM gcover WHERE NOT meets_threshold
UNION ALL SELECT 'peer_comparison', 'flag', 'divergence:' || segment || ':' || printf('%.2f', round(divergence * 100, 2)) || '%', 1 FROM gpeer WHERE status = 'compared' AND breached
UNION ALL SELECT 'pillar3_peer_divergence', 'flag', 'pillar3_divergence:' || source_id || ':' || CAST(CAST(round(CAST(value AS DECIMAL(28, 10)), 4) AS DECIMAL(18, 4)) AS VARCHAR)
  || '_vs_median_' || CAST(CAST(round(CAST(peer_median AS DECIMAL(28, 10)), 4) AS DECIMAL(18, 4)) AS VARCHAR), 1 FROM gdiv WHERE breached"""))
def annual_review(spark, sf):
    # the registry is a stored table; here it is staged once for the five sections
    return governance.annual_review(
        staged(_bench(spark, sf), "registry"), _segments(spark, sf), tables.quality_matrix(spark), REVIEW_DATE, own=_own(spark, sf))


@query("review_findings", O.with_(*REG, SEGS, MATRIX, GOV_STALE, GOV_QUALITY, GOV_COVER, GOV_PEER, GOV_DIV, body="""
SELECT 'stale' AS section, source_id AS subject, CAST(stale AS VARCHAR) AS outcome FROM gstale
UNION ALL SELECT 'quality', source_id, low_dimensions FROM gqual
UNION ALL SELECT 'coverage', segment, CAST(meets_threshold AS VARCHAR) FROM gcover
UNION ALL SELECT 'peer_comparison', segment, status FROM gpeer
UNION ALL SELECT 'pillar3_peer_divergence', concat_ws(':', segment, source_id), status FROM gdiv"""))
def review_findings(spark, sf):
    rows = governance.review_findings(
        staged(_bench(spark, sf), "registry"), _segments(spark, sf), tables.quality_matrix(spark), REVIEW_DATE, own=_own(spark, sf))
    fields = {"stale": "stale", "quality": "low_dimensions", "coverage": "meets_threshold", "peer_comparison": "status", "pillar3_peer_divergence": "status"}
    outcome = F.coalesce(*[F.when(F.col("section") == s, F.get_json_object("finding", f"$.{f}")) for s, f in fields.items()])
    return rows.select("section", "subject", outcome.alias("outcome"))
