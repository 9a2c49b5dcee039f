"""Governance findings over the live registry: one DataFrame per report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L
from tidemark.functions.stats import exact_median
from tidemark.sources.tables import live_versions


def percent(value, digits: int = 2):
    return F.concat(F.format_string(f"%.{digits}f", F.round(value * 100, digits)), F.lit("%"))


def stale_benchmarks(benchmarks: DataFrame, as_of: dt.date, schedules: dict[str, int] | None = None) -> DataFrame:
    """Age of every live entry against its source type's cadence (default 365 days)."""
    days = {k: str(v) for k, v in (schedules or V.REFRESH_DAYS).items()}
    limit = F.coalesce(L.lookup(F.col("source_type"), days), F.lit(str(V.DEFAULT_GOVERNANCE_STALE_DAYS))).cast("int")
    return live_versions(benchmarks).select(
        "source_id", "source_type", "retrieval_date",
        F.datediff(F.lit(as_of), F.col("retrieval_date")).alias("days_old"), limit.alias("threshold_days"),
    ).withColumn("stale", F.col("days_old") > F.col("threshold_days"))


def quality_assessment(benchmarks: DataFrame, matrix: DataFrame) -> DataFrame:
    """Five fixed dimensions per source type; low ones listed by name."""
    dims = V.QUALITY_DIMENSIONS
    low = F.array_join(F.array_compact(F.array(*[F.when(F.col(d) == "LOW", F.lit(d)) for d in dims])), ",")
    return (
        live_versions(benchmarks).join(F.broadcast(matrix), "source_type", "left")
        .select("source_id", "source_type", F.col("quality_score").alias("analyst_quality"), *dims, low.alias("low_dimensions"))
    )


def _by_segment(benchmarks: DataFrame, data_type: str) -> DataFrame:
    return live_versions(benchmarks).where(F.col("data_type") == data_type).select(
        F.col("asset_class").alias("segment"), "source_id", "value")


def peer_comparison(benchmarks: DataFrame, segments: DataFrame, own: DataFrame, data_type: str = "pd",
                    threshold: float = V.OWN_VS_PEER_DIVERGENCE) -> DataFrame:
    """Own estimate against the peer median of each requested segment."""
    peers = exact_median(_by_segment(benchmarks, data_type), ["segment"], "value", "peer_median").select(
        "segment", "peer_median", F.col("n").alias("peer_count"))
    rows = segments.select("segment").join(peers, "segment", "left").join(own.select("segment", F.col("value").alias("own")), "segment", "left")
    gap = F.when(F.col("peer_median") == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.abs(F.col("own") - F.col("peer_median")), F.col("peer_median")))
    status = F.when(F.col("peer_count").isNull(), "no_peer_data").when(F.col("own").isNull(), "no_own_estimate").otherwise("compared")
    compared = F.col("status") == "compared"
    return rows.withColumn("status", status).select(
        "segment", "status", F.when(compared, F.col("own")).alias("own"),
        F.when(compared, F.round("peer_median", 8)).alias("peer_median"), "peer_count",
        F.when(compared, F.round(gap, 8)).alias("divergence"), F.when(compared, gap > threshold).alias("breached"),
    )


def coverage_report(benchmarks: DataFrame, segments: DataFrame, data_type: str = "pd",
                    min_sources: int = V.COVERAGE_MIN_SOURCES) -> DataFrame:
    """Distinct sources per requested segment, zero where there is none.

    Distinct first, then count, so a hot segment still spreads by source.
    """
    counted = _by_segment(benchmarks, data_type).select("segment", "source_id").distinct().groupBy("segment").agg(
        F.count(F.lit(1)).alias("source_count"))
    return segments.select("segment").join(counted, "segment", "left").select(
        "segment", F.coalesce("source_count", F.lit(0)).alias("source_count"),
    ).withColumn("meets_threshold", F.col("source_count") >= min_sources).withColumn("min_sources", F.lit(min_sources))


def pillar3_divergence(benchmarks: DataFrame, multiple: float = V.PILLAR3_DIVERGENCE_MULTIPLE,
                       min_cohort: int = V.PILLAR3_MIN_COHORT) -> DataFrame:
    """Each Pillar 3 entry against its (segment, type, date) median; small cohorts are listed as skipped."""
    keys = ["segment", "data_type", "value_date"]
    rows = live_versions(benchmarks).where(F.col("source_type") == "pillar3").withColumnRenamed("asset_class", "segment")
    medians = exact_median(rows, keys, "value", "peer_median").select(*keys, "peer_median", F.col("n").alias("cohort_size"))
    enough = F.col("cohort_size") >= min_cohort
    value, med = F.col("value"), F.col("peer_median")
    ratio = F.when((med <= 0) | (value < 0), F.lit(None).cast("double")).when(
        value == 0, F.lit(float("inf"))).otherwise(F.greatest(F.try_divide(value, med), F.try_divide(med, value)))
    compared = rows.join(medians.where(enough), keys).select(
        *keys, F.lit("compared").alias("status"), "publisher", "source_id", "value", F.round(med, 8).alias("peer_median"),
        "cohort_size", F.round(ratio, 8).alias("divergence_ratio"), F.coalesce(ratio > multiple, F.lit(False)).alias("breached"))
    skipped = medians.where(~enough).select(*keys, F.lit("skipped_incomplete_cohort").alias("status"), "cohort_size")
    return compared.unionByName(skipped, allowMissingColumns=True)


def version_drift(benchmarks: DataFrame) -> DataFrame:
    """First against last version of every id; drift above 30% is flagged."""
    out = benchmarks.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("n_versions"), F.min_by("value", "version").alias("first_value"),
        F.max_by("value", "version").alias("last_value"))
    share = F.when(F.col("first_value") != 0, F.try_divide(F.abs(F.col("last_value") - F.col("first_value")), F.abs("first_value")))
    flagged = (F.col("n_versions") >= 2) & (share > V.DRIFT_SHARE)
    return out.withColumn("drift", F.when(F.col("n_versions") >= 2, F.round(share, 8))).withColumn(
        "flagged", F.coalesce(flagged, F.lit(False)))


def report_flags(stale: DataFrame, quality: DataFrame, coverage: DataFrame, peers: DataFrame | None,
                 divergence: DataFrame) -> DataFrame:
    """(section, flag) rows in the published flag wording."""
    parts = [
        stale.where("stale").select(F.lit("stale").alias("section"), F.concat(F.lit("stale:"), "source_id").alias("flag")),
        quality.where("low_dimensions <> ''").select(
            F.lit("quality").alias("section"), F.concat(F.lit("low_quality:"), "source_id", F.lit(":"), "low_dimensions").alias("flag")),
        coverage.where(~F.col("meets_threshold")).select(
            F.lit("coverage").alias("section"),
            F.concat(F.lit("low_coverage:"), "segment", F.lit(":"), F.col("source_count").cast("string")).alias("flag")),
        divergence.where("breached").select(
            F.lit("pillar3_peer_divergence").alias("section"),
            F.concat(F.lit("pillar3_divergence:"), "source_id", F.lit(":"), F.format_string("%.4f", "value"),
                     F.lit("_vs_median_"), F.format_string("%.4f", "peer_median")).alias("flag")),
    ]
    if peers is not None:
        parts.append(peers.where("breached").select(
            F.lit("peer_comparison").alias("section"),
            F.concat(F.lit("divergence:"), "segment", F.lit(":"), percent(F.col("divergence"))).alias("flag")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def annual_review(benchmarks: DataFrame, segments: DataFrame, matrix: DataFrame, as_of: dt.date,
                  own: DataFrame | None = None, institution: str = "bank") -> DataFrame:
    """All report sections stacked: a header, the number of findings of each section, and every flag."""
    sections = _review_sections(benchmarks, segments, matrix, as_of, own)
    committee = "MRC" if institution == "bank" else "Credit Committee"
    out = segments.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("header").alias("section"), F.lit("committee").alias("kind"),
        F.lit(f"{committee} ({institution})").alias("detail"), "n")
    for name, findings in sections.items():
        out = out.unionByName(findings.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("section"), F.lit("findings").alias("kind"), F.lit(None).cast("string").alias("detail"), "n"))
    order = ("stale", "quality", "coverage", "peer_comparison", "pillar3_peer_divergence")
    flags = report_flags(*(sections.get(name) for name in order)).select(
        "section", F.lit("flag").alias("kind"), F.col("flag").alias("detail"), F.lit(1).cast("long").alias("n"))
    return out.unionByName(flags)


def review_findings(benchmarks: DataFrame, segments: DataFrame, matrix: DataFrame, as_of: dt.date, own: DataFrame | None = None) -> DataFrame:
    """Every finding of every section as a row: section, what it is about, and all its fields as JSON."""
    out = None
    for name, findings in _review_sections(benchmarks, segments, matrix, as_of, own).items():
        about = [c for c in ("segment", "source_id") if c in findings.columns]
        rows = findings.select(F.lit(name).alias("section"), F.concat_ws(":", *about).alias("subject"), F.to_json(F.struct("*")).alias("finding"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _review_sections(benchmarks: DataFrame, segments: DataFrame, matrix: DataFrame, as_of: dt.date, own: DataFrame | None) -> dict[str, DataFrame]:
    stale = stale_benchmarks(benchmarks, as_of)
    quality = quality_assessment(benchmarks, matrix)
    coverage = coverage_report(benchmarks, segments)
    sections = {"stale": stale, "quality": quality, "coverage": coverage, "pillar3_peer_divergence": pillar3_divergence(benchmarks)}
    return sections if own is None else sections | {"peer_comparison": peer_comparison(benchmarks, segments, own)}
