"""Model-input queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators import inputs, latest as latest_ops
from tidemark.plans import oracle_parts as O
from tidemark.plans.catalog import query
from tidemark.sources import tables, testbed


def _latest(spark, sf):
    return latest_ops.latest_numeric(testbed.observations(spark, sf))


def _summary(spark, sf):
    return inputs.rate_summary(_latest(spark, sf))


def _el(spark, sf):
    return inputs.expected_loss(_summary(spark, sf))


BASE = (O.OBS, O.READ, O.LATEST, O.MODEL)
LABEL = O.segment_label()

EL = f"""
el AS (
  SELECT p.segment, {O.segment_label('p.segment')} AS segment_label, p.product,
    {O.dec6('p.med')} AS pd_decimal, {O.dec6('l.med')} AS lgd_decimal, {O.dec6('p.med * l.med')} AS expected_loss_rate_decimal,
    CAST(round(CAST(p.med * l.med * 10000 AS DECIMAL(28, 8))) AS BIGINT) AS expected_loss_rate_bps,
    p.n AS pd_source_count, l.n AS lgd_source_count, greatest(p.as_of_date, l.as_of_date) AS as_of_date
  FROM summary p JOIN summary l ON p.segment = l.segment AND p.product = l.product
    AND p.model_parameter = 'pd' AND l.model_parameter = 'lgd')"""

BANDS = "bands AS " + O.values([(p, lo, hi) for p, (lo, hi, *_rest) in V.REALITY_CHECK_BANDS.items()], "product, lower_band_pd, upper_band_pd")
SCENARIOS = "scenarios AS " + O.values(V.STRESS_SCENARIOS, "ord, scenario, scenario_label, pd_x, lgd_x, ccf_x, floored, macro_path")

STRESS = f"""
stressed AS (
  SELECT *, CASE WHEN floored THEN greatest(pd_decimal * pd_x, COALESCE(upper_band_pd, 0)) ELSE pd_decimal * pd_x END AS spd,
         least(1.0, lgd_decimal * lgd_x) AS slgd
  FROM el LEFT JOIN bands USING (product) CROSS JOIN scenarios)"""

STRESS_SELECT = f"""SELECT segment, segment_label, product, scenario, scenario_label, pd_decimal AS base_pd_decimal,
  lgd_decimal AS base_lgd_decimal, {O.dec6('pd_decimal * lgd_decimal')} AS base_expected_loss_rate_decimal,
  pd_x AS pd_stress_multiplier, lgd_x AS lgd_stress_multiplier, ccf_x AS ccf_stress_multiplier,
  upper_band_pd AS pd_upper_band_decimal, {O.dec6('spd')} AS stressed_pd_decimal, {O.dec6('slgd')} AS stressed_lgd_decimal,
  {O.dec6('spd * slgd')} AS stressed_expected_loss_rate_decimal,
  {O.dec6('spd * slgd * ccf_x')} AS stressed_el_rate_incl_ead_decimal, macro_path, as_of_date FROM stressed"""


@query("latest_numeric", O.with_(O.OBS, O.READ, O.LATEST, body="""
SELECT segment, product, parameter, source_id, source_type, data_definition_class, value, as_of_date FROM latest"""))
def latest_numeric(spark, sf):
    return _latest(spark, sf)


@query("rate_summary", O.with_(*BASE, O.SUMMARY, body="""
SELECT segment, product, model_parameter, round(med, 8) AS median_decimal, lo AS min_decimal, hi AS max_decimal,
  n AS source_count, as_of_date FROM summary"""))
def rate_summary(spark, sf):
    return _summary(spark, sf).withColumn("median_decimal", F.round("median_decimal", 8))


for _p in ("pd", "lgd"):
    @query(f"{_p}_inputs", O.with_(*BASE, body=f"""
SELECT segment, {LABEL} AS segment_label, product, source_id, source_type, {O.dec6('value')} AS {_p}_decimal, as_of_date
FROM model WHERE model_parameter = '{_p}'"""))
    def parameter_inputs(spark, sf, _p=_p):
        return inputs.parameter_inputs(_latest(spark, sf), _p)


@query("expected_loss_inputs", O.with_(*BASE, O.SUMMARY, EL, body="SELECT * FROM el"))
def expected_loss_inputs(spark, sf):
    return _el(spark, sf)


@query("expected_loss_bps", O.with_(*BASE, O.SUMMARY, EL, body="SELECT segment, product, expected_loss_rate_decimal, expected_loss_rate_bps FROM el"))
def expected_loss_bps(spark, sf):
    return _el(spark, sf).select("segment", "product", "expected_loss_rate_decimal", "expected_loss_rate_bps")


@query("stress_testing_inputs", O.with_(*BASE, O.SUMMARY, EL, BANDS, SCENARIOS, STRESS, body=STRESS_SELECT))
def stress_testing_inputs(spark, sf):
    return inputs.stress_testing(_el(spark, sf), tables.stress_scenarios(), tables.reality_check_bands(spark))


REVERSE = """
reverse_rows AS (
  SELECT segment, segment_label, product, pd_decimal AS base_pd_decimal, upper_band_pd AS reality_check_upper_band_decimal,
    CAST(round(CAST(upper_band_pd / pd_decimal AS DECIMAL(28, 10)), 2) AS DOUBLE) AS breach_pd_multiplier, as_of_date
  FROM el JOIN bands USING (product) WHERE pd_decimal > 0)"""


@query("reverse_stress", O.with_(*BASE, O.SUMMARY, EL, BANDS, REVERSE, body="SELECT * FROM reverse_rows"))
def reverse_stress(spark, sf):
    return inputs.reverse_stress(_el(spark, sf), tables.reality_check_bands(spark))


@query("stress_supplement", O.with_(*BASE, O.SUMMARY, EL, BANDS, SCENARIOS, REVERSE, body="""
SELECT 'scenario' AS section, ord, scenario AS name, macro_path AS detail, pd_x AS multiplier FROM scenarios
UNION ALL SELECT 'reverse_stress', NULL, segment || '/' || product, segment_label, breach_pd_multiplier FROM reverse_rows"""))
def stress_supplement(spark, sf):
    return inputs.stress_supplement(_el(spark, sf), tables.stress_scenarios(), tables.reality_check_bands(spark))


_MONITOR = ", ".join(
    f"{O.dec6(f'max(CASE WHEN model_parameter = {chr(39)}{p}{chr(39)} THEN med END)')} AS {p}_decimal, "
    f"COALESCE(max(CASE WHEN model_parameter = '{p}' THEN n END), 0) AS {p}_source_count" for p in V.MONITOR_PARAMETERS)


@query("portfolio_monitor_inputs", O.with_(*BASE, O.SUMMARY, body=f"""
SELECT segment, {LABEL} AS segment_label, product, {_MONITOR}, CAST(sum(n) AS BIGINT) AS monitor_source_count, max(as_of_date) AS as_of_date
FROM summary WHERE model_parameter IN {O.in_list(V.MONITOR_PARAMETERS)} GROUP BY segment, product"""))
def portfolio_monitor_inputs(spark, sf):
    return inputs.portfolio_monitor(_summary(spark, sf))


@query("loss_rate_with_proxies", O.with_(*BASE, body="""
SELECT segment, product, parameter, source_id, value, as_of_date FROM model WHERE model_parameter = 'loss_rate'"""))
def loss_rate_with_proxies(spark, sf):
    return inputs.model_observations(_latest(spark, sf)).where(F.col("model_parameter") == "loss_rate").select(
        "segment", "product", "parameter", "source_id", "value", "as_of_date")


@query("model_input_bundle", O.with_(*BASE, O.SUMMARY, EL, BANDS, SCENARIOS, STRESS, body=f"""
SELECT 'pd_inputs' AS table_name, segment, product, source_id AS item, {O.dec6('value')} AS rate, as_of_date FROM model WHERE model_parameter = 'pd'
UNION ALL SELECT 'lgd_inputs', segment, product, source_id, {O.dec6('value')}, as_of_date FROM model WHERE model_parameter = 'lgd'
UNION ALL SELECT 'expected_loss_inputs', segment, product, NULL, expected_loss_rate_decimal, as_of_date FROM el
UNION ALL SELECT 'stress_testing_inputs', segment, product, scenario, {O.dec6('spd * slgd * ccf_x')}, as_of_date FROM stressed
UNION ALL SELECT 'portfolio_monitor_inputs', segment, product, NULL, {O.dec6("max(CASE WHEN model_parameter = 'arrears' THEN med END)")}, max(as_of_date)
  FROM summary WHERE model_parameter IN {O.in_list(V.MONITOR_PARAMETERS)} GROUP BY segment, product"""))
def model_input_bundle(spark, sf):
    """All five tables in long form; the file export is ``plans.exports``."""
    b = inputs.model_input_bundle(
        testbed.observations(spark, sf), tables.stress_scenarios(), tables.reality_check_bands(spark))
    none = F.lit(None).cast("string")
    shape = {
        "pd_inputs": (F.col("source_id"), "pd_decimal"), "lgd_inputs": (F.col("source_id"), "lgd_decimal"),
        "expected_loss_inputs": (none, "expected_loss_rate_decimal"),
        "stress_testing_inputs": (F.col("scenario"), "stressed_el_rate_incl_ead_decimal"),
        "portfolio_monitor_inputs": (none, "arrears_decimal"),
    }
    long = [
        b[name].select(F.lit(name).alias("table_name"), "segment", "product", item.alias("item"),
                       F.col(rate).alias("rate"), "as_of_date")
        for name, (item, rate) in shape.items()
    ]
    out = long[0]
    for more in long[1:]:
        out = out.unionByName(more)
    return out
