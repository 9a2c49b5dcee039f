"""Report-table queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators import industry, inputs, latest as latest_ops, reporting
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.plans.industry_queries import INTRA, ROWS, WIDE
from tidemark.plans.model_queries import BASE as MODEL_BASE
from tidemark.plans.registry_queries import COH, FLAGS, FLAGSRC, RULES, SEGMED
from tidemark.sources import tables, testbed

OBS3 = (O.OBS, O.READ, COH)


def _obs(spark, sf):
    return testbed.observations(spark, sf)


PER_SOURCE = """
ps0 AS (SELECT *, row_number() OVER (PARTITION BY parameter, segment, source_id ORDER BY as_of_date DESC, stored_segment, obs_seq) AS rn FROM coh),
ps AS (
  SELECT parameter, segment, source_id, source_type, cohort, value AS latest_value, as_of_date AS latest_as_of, m.n AS n_vintages, round(m.med, 8) AS median_value
  FROM ps0 JOIN (SELECT parameter, segment, source_id, count(*) AS n, median(value) AS med FROM coh GROUP BY ALL) m USING (parameter, segment, source_id) WHERE rn = 1)"""
RANKS = f"""CAST(list_position({list(V.COHORT_ORDER)!r}, cohort) - 1 AS INT) AS cohort_rank, CAST(list_position({list(V.PARAMETERS)!r}, parameter) - 1 AS INT) AS parameter_rank"""


@query("per_source_observations", O.with_(*OBS3, PER_SOURCE, body=f"""
SELECT parameter, segment, source_id, source_type, cohort, {O.case('cohort', V.COHORT_LABELS)} AS cohort_label, latest_value, latest_as_of, n_vintages, median_value, {RANKS} FROM ps"""))
def per_source_observations(spark, sf):
    return reporting.per_source_observations(_obs(spark, sf), shown=()).select(
        "parameter", "segment", "source_id", "source_type", "cohort", "cohort_label", "latest_value", "latest_as_of", "n_vintages",
        F.round("median_value", 8).alias("median_value"), "cohort_rank", "parameter_rank")


@query("cohort_medians", O.with_(*OBS3, PER_SOURCE, body=f"""
SELECT parameter, segment, cohort, {O.case('cohort', V.COHORT_LABELS)} AS cohort_label, round(median(latest_value), 8) AS median, count(*) AS n
FROM ps WHERE latest_value IS NOT NULL GROUP BY ALL"""))
def cohort_medians(spark, sf):
    return reporting.cohort_medians(reporting.per_source_observations(_obs(spark, sf), shown=())).withColumn("median", F.round("median", 8))


@query("segments_missing_metric", O.with_(O.OBS, O.READ, body=f"""
SELECT s.segment, p.parameter, {O.segment_label('s.segment')} AS segment_label
FROM (SELECT DISTINCT segment FROM rd WHERE NOT (segment IN ('development', 'invoice_finance') AND parameter IN ('npl', 'lgd'))) s
CROSS JOIN (SELECT unnest({list(V.PARAMETERS)!r}) AS parameter) p
WHERE NOT EXISTS (SELECT 1 FROM rd r WHERE r.segment = s.segment AND r.parameter = p.parameter AND NOT (r.segment IN ('development', 'invoice_finance') AND r.parameter IN ('npl', 'lgd')))"""))
def segments_missing_metric(spark, sf):
    thinned = _obs(spark, sf).where(~(F.col("segment").isin("development", "invoice_finance") & F.col("parameter").isin("npl", "lgd")))
    return reporting.segments_missing_metric(thinned)


@query("pd_overview", O.with_(*OBS3, body=f"""
SELECT segment, {O.segment_label()} AS segment_label,
  round(median(value) FILTER (WHERE parameter = 'pd' AND cohort = 'peer_big4'), 8) AS big4_median_pd, count(value) FILTER (WHERE parameter = 'pd' AND cohort = 'peer_big4') AS big4_count,
  round(median(value) FILTER (WHERE parameter = 'pd' AND cohort = 'peer_non_bank'), 8) AS nonbank_median_pd, count(value) FILTER (WHERE parameter = 'pd' AND cohort = 'peer_non_bank') AS nonbank_count,
  array_to_string(list_transform(list_sort(list_distinct(list(parameter) FILTER (WHERE parameter <> 'pd'))), lambda p: {O.case('p', V.PARAMETER_LABELS)}), '; ') AS other_metrics
FROM coh GROUP BY segment"""))
def pd_overview(spark, sf):
    return reporting.pd_overview(_obs(spark, sf)).withColumn("other_metrics", F.array_join("other_metrics", "; "))


@query("big4_vs_nonbank", O.with_(*OBS3, body="""
SELECT segment, round(bm, 8) AS big4_median, round(nm, 8) AS nonbank_median, CASE WHEN bm > 0 THEN round(nm / bm, 8) END AS ratio, bc AS big4_count, nc AS nonbank_count FROM (
  SELECT segment, median(value) FILTER (WHERE cohort = 'peer_big4') AS bm, median(value) FILTER (WHERE cohort = 'peer_non_bank') AS nm,
    count(value) FILTER (WHERE cohort = 'peer_big4') AS bc, count(value) FILTER (WHERE cohort = 'peer_non_bank') AS nc FROM coh GROUP BY segment)"""))
def big4_vs_nonbank(spark, sf):
    return reporting.big4_vs_nonbank(_obs(spark, sf))


@query("peer_table", O.with_(*OBS3, body="""
SELECT segment, CASE WHEN bm IS NULL THEN '-' ELSE printf('%.4f%%', bm * 100) END AS big4, CASE WHEN nm IS NULL THEN '-' ELSE printf('%.4f%%', nm * 100) END AS non_bank,
  CASE WHEN r IS NULL THEN '-' ELSE printf('%.2fx', r) END AS ratio,
  CASE WHEN nm - bm IS NULL THEN '-' ELSE CASE WHEN nm - bm > 0 THEN '+' ELSE '' END || printf('%.2f%%', (nm - bm) * 100) END AS gap,
  CASE WHEN nm - bm IS NULL THEN '-' ELSE CAST(CAST(round_even((nm - bm) * 10000, 0) AS BIGINT) AS VARCHAR) || ' bps' END AS gap_bps
FROM (SELECT segment, bm, nm, CASE WHEN bm > 0 THEN round(nm / bm, 8) END AS r FROM (
  SELECT segment, round(median(value) FILTER (WHERE cohort = 'peer_big4'), 8) AS bm, round(median(value) FILTER (WHERE cohort = 'peer_non_bank'), 8) AS nm FROM coh GROUP BY segment))"""))
def peer_table(spark, sf):
    return reporting.peer_table(_obs(spark, sf))


META = """
meta AS (SELECT count(*) AS n_observations, count(DISTINCT segment) AS n_segments, count(DISTINCT source_id) AS n_sources,
  min(as_of_date) AS data_as_of_min, max(as_of_date) AS data_as_of_max FROM rd)"""


@query("report_meta", O.with_(O.OBS, O.READ, META, body="SELECT * FROM meta"))
def report_meta(spark, sf):
    return reporting.report_meta(_obs(spark, sf))


@query("data_window", O.with_(O.OBS, O.READ, META, body="SELECT CAST(data_as_of_min AS VARCHAR) || '–' || CAST(data_as_of_max AS VARCHAR) AS data_as_of FROM meta"))
def data_window(spark, sf):
    return reporting.data_window(reporting.report_meta(_obs(spark, sf)))


@query("report_headline", O.with_(O.OBS, O.READ, META, ROWS, INTRA, WIDE, body="""
SELECT meta.*, (SELECT string_agg(bank, ', ' ORDER BY bank) FROM (SELECT DISTINCT bank FROM wide)) AS banks, (SELECT count(*) FROM wide) AS n_industry_rows FROM meta"""))
def report_headline(spark, sf):
    wide = industry.bank_industry_wide(industry.intra_bank_totals(testbed.industry_rows(spark, sf)))
    return reporting.report_headline(reporting.report_meta(_obs(spark, sf)), wide)


@query("executive_counts", O.with_(*OBS3, body="""
SELECT CASE cohort WHEN 'peer_big4' THEN 'big4' WHEN 'peer_non_bank' THEN 'non_bank' WHEN 'peer_other_major_bank' THEN 'other_major' ELSE 'reference' END AS cohort_group,
  count(DISTINCT source_id) AS n_sources FROM coh GROUP BY 1"""))
def executive_counts(spark, sf):
    return reporting.executive_counts(_obs(spark, sf))


@query("headline_segment", O.with_(*OBS3, SEGMED, FLAGSRC, FLAGS, body=f"""
SELECT 'commercial_property' AS segment, min(value) AS big4_low, max(value) AS big4_high, round(median(value), 8) AS big4_median, count(*) AS n_disclosures,
  '' AS thin_segments, 0::BIGINT AS n_thin, (SELECT count(*) FROM flagsrc WHERE flag_type = 'outlier' AND segment = (SELECT min(segment) FROM flagsrc WHERE flag_type = 'outlier')) AS n_outliers,
  (SELECT min(segment) FROM flagsrc WHERE flag_type = 'outlier') AS outlier_segment,
  (SELECT string_agg(source_id, ', ' ORDER BY source_id) FROM (SELECT source_id FROM flagsrc WHERE flag_type = 'outlier'
     AND segment = (SELECT min(segment) FROM flagsrc WHERE flag_type = 'outlier') ORDER BY source_id LIMIT 3)) AS first_outliers
FROM coh WHERE segment = 'commercial_property' AND {O.BIG4} AND value IS NOT NULL"""))
def headline_segment(spark, sf):
    return reporting.headline_segment(_obs(spark, sf), RULES)


@query("provenance", O.with_(O.OBS, O.READ, body="""
SELECT source_id, source_type, reporting_basis, source_url FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY segment, stored_segment, as_of_date DESC, obs_seq) AS rn FROM rd) WHERE rn = 1"""))
def provenance(spark, sf):
    return reporting.provenance(_obs(spark, sf))


@query("validation_summary", O.with_(*OBS3, SEGMED, FLAGSRC, FLAGS, body=f"""
SELECT segment, {O.segment_label()} AS segment_label, n_sources, spread_decimal, big4_spread_decimal, peer_big4_vs_non_bank_ratio, n_outlier_sources, n_stale_sources FROM flags"""))
def validation_summary(spark, sf):
    from tidemark.functions.labels import segment_label
    from tidemark.operators.flags import validation_flags

    return validation_flags(_obs(spark, sf), RULES).drop("n_distinct_sources", "frozen_dataset_banner").withColumn(
        "segment_label", segment_label(F.col("segment")))


@query("bank_avg_pd_lgd", O.with_(*OBS3, body="""
SELECT segment, round(CAST(avg(CAST(value AS DECIMAL(18,8))) FILTER (WHERE parameter = 'pd') AS DOUBLE), 8) AS pd,
  round(CAST(avg(CAST(value AS DECIMAL(18,8))) FILTER (WHERE parameter = 'lgd') AS DOUBLE), 8) AS lgd
FROM coh WHERE cohort IN ('peer_big4', 'peer_other_major_bank') AND parameter IN ('pd', 'lgd') GROUP BY segment"""))
def bank_avg_pd_lgd(spark, sf):
    return reporting.bank_avg_pd_lgd(_obs(spark, sf))


@query("nonbank_latest_rates", O.with_(*OBS3, body="""
SELECT lender, segment, data_definition_class, value, as_of_date FROM (
  SELECT *, split_part(source_id, '_', 1) AS lender, row_number() OVER (PARTITION BY split_part(source_id, '_', 1), segment, data_definition_class
    ORDER BY as_of_date DESC, stored_segment, obs_seq) AS rn FROM coh WHERE cohort = 'peer_non_bank' AND value IS NOT NULL AND parameter IN ('arrears', 'impaired', 'lgd')) WHERE rn = 1"""))
def nonbank_latest_rates(spark, sf):
    return reporting.nonbank_latest_rates(_obs(spark, sf))


@query("anchor_view", O.with_(*MODEL_BASE, body=f"""
SELECT segment, source_id, CASE WHEN source_type = 'apra_performance' THEN 'APRA floor' WHEN split_part(source_id, '_', 1) = 'MACQUARIE' THEN 'MQG' ELSE split_part(source_id, '_', 1) END AS label,
  {O.dec6('value')} AS pd_decimal, round(med, 8) AS segment_median, source_type = 'apra_performance' AS is_floor
FROM model JOIN (SELECT segment, median(value) AS med, count(*) AS n FROM model WHERE model_parameter = 'pd' GROUP BY segment) USING (segment)
WHERE model_parameter = 'pd' AND n >= 2"""))
def anchor_view(spark, sf):
    return reporting.anchor_view(inputs.parameter_inputs(latest_ops.latest_numeric(_obs(spark, sf)), "pd"), "pd_decimal")


@query("segment_glossary", O.with_(O.OBS, O.READ, body=f"SELECT DISTINCT segment, {O.case('segment', V.SEGMENT_GLOSSARY)} AS definition FROM rd"))
def segment_glossary(spark, sf):
    return reporting.segment_glossary(_obs(spark, sf), tables.segment_glossary(spark))


_REFS = sorted({(p, s) for p, (_, _, up, low) in V.REALITY_CHECK_BANDS.items() for s in (*up, *low)} | set(V.BAND_REFERENCE_SOURCES.items()))
_HELD = "CASE WHEN source_id = 'CBA_16' THEN 'sp_spin_prime' WHEN source_id = 'APRA_6' THEN 'APS113_SLOTTING_GOOD_PD' ELSE source_id END"


@query("band_source_check", O.with_(O.OBS, "refs AS " + O.values(_REFS, "used_by, source_id"), body=f"""
SELECT used_by, r.source_id FROM refs r WHERE r.source_id NOT IN (SELECT {_HELD} FROM obs)"""))
def band_source_check(spark, sf):
    held = _obs(spark, sf).withColumn("source_id", F.expr(_HELD))
    return reporting.band_source_check(reporting.band_references(spark), held)


_BANDS = [(p, up_pd, low_pd, "|".join(up), "|".join(low), ",".join(dict.fromkeys((*up, *low)))) for p, (low_pd, up_pd, up, low) in V.REALITY_CHECK_BANDS.items()]


@query("reality_check_bands", O.with_(O.OBS, "b AS " + O.values(_BANDS, "product, upper_band_pd, lower_band_pd, upper_sources, lower_sources, every"), body=f"""
SELECT product, printf('%.6f', lower_band_pd) AS lower_band_pd, printf('%.6f', upper_band_pd) AS upper_band_pd, lower_sources, upper_sources,
  'Range of ' || product || '\\nin two lines' AS rationale, '2026-01-31' AS last_review_date, '2027-01-31' AS next_review_due,
  (SELECT count(*) FROM (SELECT unnest(string_split(every, ',')) AS s) WHERE s NOT IN (SELECT {_HELD} FROM obs)) AS n_missing_sources FROM b"""))
def reality_check_bands(spark, sf):
    held = _obs(spark, sf).withColumn("source_id", F.expr(_HELD))
    bands = tables.reality_check_bands(spark).withColumns({
        "rationale": F.concat(F.lit("  Range of "), "product", F.lit("\nin two lines\n")), "last_review_date": F.lit("2026-01-31"), "next_review_due": F.lit("2027-01-31")})
    return reporting.bands_with_gaps(bands, held)
