"""File exports. Parquet is the contract; CSV is for spreadsheets.

Segment-level tables are a few rows and land in one file. Row-level tables keep
their partitions: many writers, many files, ordered within each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import text as X
from tidemark.operators import flags, inputs, latest, registry, reporting
from tidemark.sources.tables import Scenario, live_versions

SMALL_TABLES = ("expected_loss_inputs", "stress_testing_inputs", "portfolio_monitor_inputs")
INPUT_ORDER = {
    "pd_inputs": ("segment", "source_id", "as_of_date"), "lgd_inputs": ("segment", "source_id", "as_of_date"),
    "expected_loss_inputs": ("segment", "product"), "stress_testing_inputs": ("segment", "product", "scenario"),
    "portfolio_monitor_inputs": ("segment", "product"),
}


def write_csv(df: DataFrame, path: str, order: Sequence[str], small: bool = False) -> None:
    """CSV with a header; null is written as an empty cell."""
    rows = df.coalesce(1) if small else df
    (rows.sortWithinPartitions(*order).write.mode("overwrite").option("header", True).option("emptyValue", "")
     .option("nullValue", "").csv(path))


def write_verdicts(rows: DataFrame, path: str) -> None:
    """A parser's rows in one pass: ``verdict=accepted`` and ``verdict=quarantine`` as two partitions of one table."""
    verdict = F.when(F.col("dropped").isNull(), F.lit("accepted")).otherwise(F.lit("quarantine"))
    rows.withColumn("verdict", verdict).write.mode("overwrite").partitionBy("verdict").parquet(path)


def export_model_inputs(observations: DataFrame, scenarios: Sequence[Scenario], bands: DataFrame, out: str) -> None:
    """The five model-input tables as Parquet and CSV, columns in published order."""
    for name, table in inputs.model_input_bundle(observations, scenarios, bands).items():
        table.write.mode("overwrite").parquet(f"{out}/{name}.parquet")
        write_csv(observations.sparkSession.read.parquet(f"{out}/{name}.parquet"), f"{out}/{name}.csv", INPUT_ORDER[name], name in SMALL_TABLES)


def export_raw_observations(observations: DataFrame, out: str) -> None:
    write_csv(registry.raw_observation_export(observations), f"{out}/raw_observations.csv", ("segment", "source_id", "as_of_date"))


def export_validation_flags(observations: DataFrame, rules: flags.FlagRules, out: str) -> None:
    """Flags per segment, and their sources in long form.

    ``spread_decimal`` and ``big4_spread_decimal`` are decimals (0.21 is 21%);
    the peer ratio is the non-bank median over the Big-4 median, both over the
    rule's parameter, with Macquarie and reference sources in neither.
    """
    table = flags.validation_flags(observations, rules)
    shown = table.select("segment", "n_sources", *[X.four_places(F.col(c)).alias(c) for c in (
        "spread_decimal", "big4_spread_decimal", "peer_big4_vs_non_bank_ratio")], "n_outlier_sources", "n_stale_sources",
        F.coalesce("frozen_dataset_banner", F.lit("")).alias("frozen_dataset_banner"))
    write_csv(shown, f"{out}/validation_flags.csv", ("segment",), small=True)
    write_csv(flags.validation_flag_sources(observations, rules), f"{out}/validation_flag_sources.csv", ("segment", "flag_type", "source_id"))


def export_segment_trend(observations: DataFrame, out: str) -> None:
    rows = latest.segment_trend(observations)
    numbers = ("current_value", "prior_value", "delta", "pct_change")
    shown = rows.select(*[F.coalesce(F.format_string("%.6f", c), F.lit("")).alias(c) if c in numbers else F.col(c) for c in rows.columns])
    write_csv(shown, f"{out}/segment_trend.csv", ("segment", "parameter", "source_id"))


def export_bands(bands: DataFrame, out: str) -> None:
    write_csv(reporting.bands_export(bands), f"{out}/reality_check_bands.csv", ("product",), small=True)


def export_registry(benchmarks: DataFrame, out: str, *, latest_only: bool = True) -> None:
    """Registry rows as JSON lines and CSV."""
    rows = live_versions(benchmarks) if latest_only else benchmarks
    rows.write.mode("overwrite").json(f"{out}/benchmarks.json")
    write_csv(rows, f"{out}/benchmarks.csv", ("source_id", "version"))


def export_inventory(inventory: DataFrame, out: str) -> None:
    write_csv(inventory, f"{out}/raw_data_inventory.csv", ("relative_path",))
