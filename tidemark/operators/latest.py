"""Newest-row selection and version assignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.functions import labels as L
from tidemark.functions.stats import number_rows

SOURCE_KEYS = ("segment", "product", "parameter", "source_id")


def newest_first() -> Column:
    """Ordering for min_by: latest date, then store order, then lowest value."""
    return F.struct(-F.unix_date(F.col("as_of_date")), F.col("stored_segment"), F.col("obs_seq"), F.col("value"))


def read_side(observations: DataFrame) -> DataFrame:
    """Apply the read-side aliases and the product default; keep the stored name."""
    canonical = L.canonical_segment(F.col("segment"))
    return observations.withColumns({
        "stored_segment": F.col("segment"), "segment": canonical,
        "product": L.product_for(F.col("product"), canonical),
    })


def latest_numeric(observations: DataFrame) -> DataFrame:
    """Newest non-null row per (segment, product, parameter, source).

    A plain aggregate with map-side combine, so a source with most of the rows
    costs one partial row per task.
    """
    return (
        read_side(observations)
        .where(F.col("value").isNotNull())
        .groupBy(*SOURCE_KEYS)
        .agg(
            F.min_by(F.struct("source_type", "data_definition_class", "value"), newest_first()).alias("row"),
            F.max("as_of_date").alias("as_of_date"),
        )
        .select(*SOURCE_KEYS, "row.*", "as_of_date")
    )


def latest_per_source(observations: DataFrame, keys: Sequence[str] = ("source_id",)) -> DataFrame:
    """Newest row per source of a set, nulls included."""
    rows = read_side(observations)
    rest = [c for c in rows.columns if c not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), newest_first()).alias("row"))
        .select(*keys, "row.*")
    )


def most_recent_per_bank(rows: DataFrame, keys: Sequence[str] = ("bank_code", "canonical_bucket")) -> DataFrame:
    """All rows on the newest date of each key group.

    The newest dates are a tiny aggregate joined back (AQE broadcasts it once
    its measured size allows), so no group is windowed in one task.
    """
    newest = rows.groupBy(*keys).agg(F.max("as_of_date").alias("_newest"))
    return rows.join(newest, list(keys)).where(F.col("as_of_date") == F.col("_newest")).drop("_newest")


def assign_versions(arrivals: DataFrame, order: Sequence[Column], coarse: Column,
                    prior: DataFrame | None = None) -> DataFrame:
    """Version numbers by arrival, continuing from ``prior``; older rows point on.

    ``superseded_by`` carries the row's own id, and is null on the live version.
    """
    numbered = number_rows(arrivals, ["source_id"], order, coarse, "version", "_last")
    if prior is not None:
        base = prior.groupBy("source_id").agg(F.max("version").alias("_base"))
        numbered = (
            numbered.join(base, "source_id", "left")
            .withColumns({c: (F.col(c) + F.coalesce(F.col("_base"), F.lit(0))).cast("int") for c in ("version", "_last")})
            .drop("_base")
        )
    return numbered.withColumn("superseded_by", F.when(F.col("version") < F.col("_last"), F.col("source_id"))).drop("_last")


def segment_trend(observations: DataFrame) -> DataFrame:
    """Newest against previous vintage per (segment, parameter, source).

    Rows are first reduced to one per date, so the window sees at most one row
    per calendar date of a source.
    """
    keys = ["segment", "parameter", "source_id"]
    per_date = (
        read_side(observations)
        .where(F.col("value").isNotNull())
        .groupBy(*keys, "as_of_date")
        .agg(F.min_by("value", F.struct("stored_segment", "obs_seq", "value")).alias("value"))
    )
    newest = W.partitionBy(*keys).orderBy(F.desc("as_of_date"))
    paired = per_date.select(
        *keys,
        F.col("value").alias("current_value"), F.col("as_of_date").alias("current_as_of"),
        F.lead("value").over(newest).alias("prior_value"),
        F.lead("as_of_date").over(newest).alias("prior_as_of"),
        F.row_number().over(newest).alias("_rn"),
    )
    delta = F.col("current_value") - F.col("prior_value")
    return (
        paired.where((F.col("_rn") == 1) & F.col("prior_as_of").isNotNull())
        .withColumn("delta", F.round(delta, 8))
        .withColumn("pct_change", F.when(F.col("prior_value") != 0, F.round(F.try_divide(delta, F.col("prior_value")), 8)))
        .drop("_rn")
    )
