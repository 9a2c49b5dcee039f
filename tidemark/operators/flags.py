"""Cross-source validation flags. Values are flagged, never changed or blended.

Rows are reduced to one per (segment, source) with map-side combine before any
segment-level step, because segments are few and one may hold most rows.
Source lists come as long rows (segment, flag_type, source_id): a list column
would gather an unbounded group into one value.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L
from tidemark.functions.stats import median_of_counts, value_counts
from tidemark.operators.latest import read_side

QUIET_BANNER = ("Refresh pipeline has not fetched recently; per-row staleness column suppressed "
                "(data is current as of last cycle).")


@dataclass(frozen=True)
class FlagRules:
    """Thresholds of one flag run; ``as_of`` is always explicit."""

    as_of: dt.date
    parameter: str = "pd"
    outlier_multiple: float = V.OUTLIER_MULTIPLE
    staleness_days: int | None = None
    pipeline_quiet: bool = False


def stale_after(source_type: Column, default: int = V.DEFAULT_STALE_DAYS,
                schedules: dict[str, int] | None = None) -> Column:
    """Allowed age in days: the type's own cadence, its family's, else the default."""
    days = {k: str(v) for k, v in (schedules or V.REFRESH_DAYS).items()}
    own = L.lookup(source_type, days)
    family = L.lookup(L.lookup(source_type, V.REFRESH_FAMILY), days)
    return F.coalesce(own, family, F.lit(str(default))).cast("int")


def with_cohort(observations: DataFrame) -> DataFrame:
    return read_side(observations).withColumn("cohort", L.cohort_for(F.col("source_type"), F.col("source_id")))


def source_counts(observations: DataFrame, rules: FlagRules) -> DataFrame:
    """The one pass over the observations: rows and staleness per (segment, source, cohort, value).

    Flags, their sources, medians of any cohort and the headline are all read from this table.
    """
    limit = (stale_after(F.col("source_type")) if rules.staleness_days is None else F.lit(rules.staleness_days))
    age = F.datediff(F.lit(rules.as_of), F.col("as_of_date"))
    stale = F.lit(False) if rules.pipeline_quiet else age > limit
    used = F.coalesce((F.col("parameter") == rules.parameter) & F.col("value").isNotNull(), F.lit(False))
    rows = with_cohort(observations).withColumns({"used": used, "_stale": stale})
    return value_counts(rows, ["segment", "source_id", "cohort", "used"], "value", F.bool_or("_stale").alias("stale"))


def per_source(counts: DataFrame) -> DataFrame:
    """One row per (segment, source) with everything the segment step needs."""
    def only(cond: Column) -> Column:
        return F.when(F.col("used") & cond, F.col("value"))

    peer, big4 = only(F.col("cohort").isin(*V.PEER_COHORTS)), only(F.col("cohort") == "peer_big4")
    return counts.groupBy("segment", "source_id").agg(
        F.sum("_c").alias("n_rows"), F.bool_or("stale").alias("stale"),
        F.min(peer).alias("peer_min"), F.max(peer).alias("peer_max"), F.min(big4).alias("big4_min"), F.max(big4).alias("big4_max"),
    )


def segment_medians(counts: DataFrame) -> DataFrame:
    """Peer, Big-4 and non-bank medians of each segment; a row of the table counts in each of its groups."""
    groups = F.array_compact(F.array(
        F.when(F.col("cohort").isin(*V.PEER_COHORTS), F.lit("peer")),
        F.when(F.col("cohort") == "peer_big4", F.lit("big4")),
        F.when(F.col("cohort") == "peer_non_bank", F.lit("non_bank"))))
    long = counts.where("used").select("segment", F.explode(groups).alias("grp"), "value", "_c")
    med = median_of_counts(long.groupBy("segment", "grp", "value").agg(F.sum("_c").alias("_c")), ["segment", "grp"], "value")

    def part(grp: str, column: str) -> Column:
        return F.max(F.when(F.col("grp") == grp, F.col(column)))

    return med.groupBy("segment").agg(
        part("peer", "median").alias("peer_median"), part("big4", "median").alias("big4_median"),
        part("non_bank", "median").alias("non_bank_median"), part("big4", "n").alias("big4_n"),
        part("non_bank", "n").alias("non_bank_n"),
    )


def _outlier(rules: FlagRules) -> Column:
    k = F.lit(rules.outlier_multiple)
    return F.coalesce(
        (F.col("peer_median") > 0)
        & ((F.col("peer_max") > k * F.col("peer_median")) | (F.col("peer_min") < F.col("peer_median") / k)),
        F.lit(False))


def flagged_sources(counts: DataFrame, rules: FlagRules) -> DataFrame:
    """Per (segment, source) of ``source_counts``: outlier and stale marks beside the segment medians."""
    return per_source(counts).join(segment_medians(counts), "segment", "left").withColumn("outlier", _outlier(rules))


def validation_flags(observations: DataFrame, rules: FlagRules) -> DataFrame:
    """One row of flags per canonical segment."""
    return segment_flags(flagged_sources(source_counts(observations, rules), rules), rules)


def segment_flags(sources: DataFrame, rules: FlagRules) -> DataFrame:
    """Flags per segment from its flagged sources.

    ``n_sources`` counts rows, as published; distinct sources sit beside it.
    """
    ratio = F.when(F.first("big4_median", True) > 0, F.try_divide(F.first("non_bank_median", True), F.first("big4_median", True)))
    spread = F.when(F.first("peer_median", True) > 0,
                    F.try_divide(F.max("peer_max") - F.min("peer_min"), F.first("peer_median", True)))
    big4 = F.when((F.first("big4_n", True) >= 2) & (F.first("big4_median", True) > 0),
                  F.try_divide(F.max("big4_max") - F.min("big4_min"), F.first("big4_median", True)))
    banner = F.lit(QUIET_BANNER) if rules.pipeline_quiet else F.lit(None).cast("string")
    return sources.groupBy("segment").agg(
        F.sum("n_rows").alias("n_sources"), F.count(F.lit(1)).alias("n_distinct_sources"),
        F.round(spread, 8).alias("spread_decimal"), F.round(big4, 8).alias("big4_spread_decimal"),
        F.round(ratio, 8).alias("peer_big4_vs_non_bank_ratio"),
        F.count_if(F.col("outlier")).alias("n_outlier_sources"), F.count_if(F.col("stale")).alias("n_stale_sources"),
    ).withColumn("frozen_dataset_banner", banner)


def validation_flag_sources(observations: DataFrame, rules: FlagRules) -> DataFrame:
    """Long form: one row per (segment, flag_type, source_id)."""
    kinds = F.array_compact(F.array(
        F.when(F.col("outlier"), F.lit("outlier")), F.when(F.col("stale"), F.lit("stale"))))
    return flagged_sources(source_counts(observations, rules), rules).select("segment", F.explode(kinds).alias("flag_type"), "source_id")


def reference_anchors(observations: DataFrame) -> DataFrame:
    """First non-peer numeric row per (segment, source, cohort), with display rank."""
    first = F.struct(F.col("stored_segment"), -F.unix_date("as_of_date"), F.col("obs_seq"), F.col("value"))
    return (
        with_cohort(observations)
        .where(F.col("value").isNotNull() & F.col("cohort").isin(*V.REFERENCE_COHORTS))
        .groupBy("segment", "source_id", "cohort")
        .agg(F.min_by(F.struct("value", "as_of_date"), first).alias("row"))
        .select("segment", "source_id", "cohort", "row.*",
                L.rank_in(F.col("cohort"), V.REFERENCE_COHORTS).alias("cohort_rank"))
    )


def observation_staleness(observations: DataFrame, as_of: dt.date) -> DataFrame:
    """Newest date per (source, type) against its allowed age."""
    newest = observations.groupBy("source_id", "source_type").agg(F.max("as_of_date").alias("as_of_date"))
    age = F.datediff(F.lit(as_of), F.col("as_of_date"))
    return newest.select(
        "source_id", "source_type", "as_of_date", age.alias("days_old"),
        stale_after(F.col("source_type")).alias("threshold_days"),
    ).withColumn("stale", F.col("days_old") > F.col("threshold_days"))
