"""Model-input tables: PD, LGD, expected loss, stress, portfolio monitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L
from tidemark.functions.stats import exact_median
from tidemark.operators.latest import latest_numeric
from tidemark.session import staged
from tidemark.sources.tables import Scenario, scenario_frame


def rate6(value: Column) -> Column:
    """Six-place rate, half-up on the decimal reading of the double."""
    return F.round(F.round(value, 12), 6)


def model_observations(latest: DataFrame) -> DataFrame:
    """Tag each latest row with the model parameter it feeds.

    LGD keeps direct rows only; the other LGD rows serve as loss-rate proxies
    beside published loss rates. The published parameter stays in the row, so a
    source with both counts twice.
    """
    proxy = (F.col("parameter") == "lgd") & ~L.is_direct_lgd(
        F.col("parameter"), F.col("data_definition_class"), F.col("source_id"))
    return latest.withColumn("model_parameter", F.when(proxy, F.lit("loss_rate")).otherwise(F.col("parameter")))


def rate_summary(latest: DataFrame) -> DataFrame:
    """Median, range, count and newest date per (segment, product, model parameter)."""
    keys = ["segment", "product", "model_parameter"]
    return exact_median(model_observations(latest), keys, "value", "median_decimal", newest="as_of_date").select(
        *keys, "median_decimal", F.col("min").alias("min_decimal"), F.col("max").alias("max_decimal"),
        F.col("n").alias("source_count"), "as_of_date")


def parameter_inputs(latest: DataFrame, parameter: str) -> DataFrame:
    """Newest value per source for one model parameter, in export column order."""
    return (
        model_observations(latest)
        .where(F.col("model_parameter") == parameter)
        .select(
            "segment", L.segment_label(F.col("segment")).alias("segment_label"), "product", "source_id",
            "source_type", rate6(F.col("value")).alias(f"{parameter}_decimal"), "as_of_date",
        )
    )


def expected_loss(summary: DataFrame) -> DataFrame:
    """PD summary joined with LGD summary per (segment, product).

    The summary is already one row per group, so a conditional aggregate pairs
    the two parameters without reading anything twice.
    """
    def part(parameter: str, column: str) -> Column:
        return F.max(F.when(F.col("model_parameter") == parameter, F.col(column)))

    paired = summary.where(F.col("model_parameter").isin("pd", "lgd")).groupBy("segment", "product").agg(
        part("pd", "median_decimal").alias("pd"), part("lgd", "median_decimal").alias("lgd"),
        part("pd", "source_count").alias("pd_source_count"), part("lgd", "source_count").alias("lgd_source_count"),
        F.max("as_of_date").alias("as_of_date"),
    )
    loss = F.col("pd") * F.col("lgd")
    return paired.where(F.col("pd").isNotNull() & F.col("lgd").isNotNull()).select(
        "segment", L.segment_label(F.col("segment")).alias("segment_label"), "product",
        rate6(F.col("pd")).alias("pd_decimal"), rate6(F.col("lgd")).alias("lgd_decimal"),
        rate6(loss).alias("expected_loss_rate_decimal"),
        F.round(F.round(loss * 10000, 8)).cast("long").alias("expected_loss_rate_bps"),
        "pd_source_count", "lgd_source_count", "as_of_date",
    )


def stress_testing(el: DataFrame, scenarios: Sequence[Scenario], bands: DataFrame) -> DataFrame:
    """Every expected-loss row under every scenario, floored at the product band.

    Scenarios are configuration and enter as literals; bands are a ten-row dimension.
    """
    upper = bands.select("product", F.col("upper_band_pd").alias("pd_upper"))
    plan = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(Scenario._fields, s)]) for s in scenarios])
    rows = el.join(F.broadcast(upper), "product", "left").withColumn("s", F.explode(plan))
    pd_x = F.col("pd_decimal") * F.col("s.pd_x")
    stressed_pd = F.when(F.col("s.floored"), F.greatest(pd_x, F.col("pd_upper"))).otherwise(pd_x)
    stressed_lgd = F.least(F.lit(1.0), F.col("lgd_decimal") * F.col("s.lgd_x"))
    stressed_el = stressed_pd * stressed_lgd
    return rows.select(
        "segment", "segment_label", "product", F.col("s.scenario").alias("scenario"),
        F.col("s.scenario_label").alias("scenario_label"),
        F.col("pd_decimal").alias("base_pd_decimal"), F.col("lgd_decimal").alias("base_lgd_decimal"),
        rate6(F.col("pd_decimal") * F.col("lgd_decimal")).alias("base_expected_loss_rate_decimal"),
        F.col("s.pd_x").alias("pd_stress_multiplier"), F.col("s.lgd_x").alias("lgd_stress_multiplier"),
        F.col("s.ccf_x").alias("ccf_stress_multiplier"), rate6(F.col("pd_upper")).alias("pd_upper_band_decimal"),
        rate6(stressed_pd).alias("stressed_pd_decimal"), rate6(stressed_lgd).alias("stressed_lgd_decimal"),
        rate6(stressed_el).alias("stressed_expected_loss_rate_decimal"),
        rate6(stressed_el * F.col("s.ccf_x")).alias("stressed_el_rate_incl_ead_decimal"),
        F.col("s.macro_path").alias("macro_path"), "as_of_date",
    )


def reverse_stress(el: DataFrame, bands: DataFrame) -> DataFrame:
    """PD multiplier at which a segment reaches its reality-check band."""
    upper = bands.select("product", F.col("upper_band_pd").alias("pd_upper"))
    return el.where(F.col("pd_decimal") > 0).join(F.broadcast(upper), "product").select(
        "segment", "segment_label", "product", F.col("pd_decimal").alias("base_pd_decimal"),
        rate6(F.col("pd_upper")).alias("reality_check_upper_band_decimal"),
        F.round(F.round(F.col("pd_upper") / F.col("pd_decimal"), 10), 2).alias("breach_pd_multiplier"), "as_of_date",
    )


def portfolio_monitor(summary: DataFrame) -> DataFrame:
    """Arrears, NPL, impaired and loss rate side by side per (segment, product)."""
    measures = []
    for p in V.MONITOR_PARAMETERS:
        here = F.col("model_parameter") == p
        measures.append(rate6(F.max(F.when(here, F.col("median_decimal")))).alias(f"{p}_decimal"))
        measures.append(F.coalesce(F.max(F.when(here, F.col("source_count"))), F.lit(0)).alias(f"{p}_source_count"))
    return (
        summary.where(F.col("model_parameter").isin(*V.MONITOR_PARAMETERS))
        .groupBy("segment", "product")
        .agg(*measures, F.sum("source_count").alias("monitor_source_count"), F.max("as_of_date").alias("as_of_date"))
        .select("segment", L.segment_label(F.col("segment")).alias("segment_label"), "product",
                *[c for p in V.MONITOR_PARAMETERS for c in (f"{p}_decimal", f"{p}_source_count")],
                "monitor_source_count", "as_of_date")
    )


def stress_supplement(el: DataFrame, scenarios: Sequence[Scenario], bands: DataFrame) -> DataFrame:
    """Scenario definitions in order, then reverse-stress rows, as one table."""
    head = scenario_frame(el.sparkSession, scenarios).selectExpr(
        "'scenario' AS section", "ord", "scenario AS name", "macro_path AS detail", "pd_x AS multiplier")
    tail = reverse_stress(el, bands).selectExpr(
        "'reverse_stress' AS section", "CAST(NULL AS INT) AS ord", "concat(segment, '/', product) AS name",
        "segment_label AS detail", "breach_pd_multiplier AS multiplier")
    return head.unionByName(tail)


def model_input_bundle(observations: DataFrame, scenarios: Sequence[Scenario], bands: DataFrame) -> dict[str, DataFrame]:
    """The five export tables from one shared reduction of the observations.

    The newest row per source and its summary are staged as tables, so the
    observations are scanned once for all five.
    """
    latest = staged(latest_numeric(observations), "latest")
    summary = staged(rate_summary(latest), "summary")
    el = expected_loss(summary)
    return {
        "pd_inputs": parameter_inputs(latest, "pd"),
        "lgd_inputs": parameter_inputs(latest, "lgd"),
        "expected_loss_inputs": el,
        "stress_testing_inputs": stress_testing(el, scenarios, bands),
        "portfolio_monitor_inputs": portfolio_monitor(summary),
    }
