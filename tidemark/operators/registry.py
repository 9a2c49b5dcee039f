"""Filtered reads, refresh policy, bridge to observations, appends and audit."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark import schemas
from tidemark.functions import labels as L
from tidemark.functions.stats import state_before
from tidemark.operators.latest import assign_versions
from tidemark.sources.tables import live_versions


# --- filtered reads: plain predicates, all pushed to the scan ---------------------------

def query_observations(observations: DataFrame, *, segment: str | None = None, product: str | None = None,
                       source_type: str | None = None, parameter: str | None = None,
                       since: dt.date | None = None, definition_classes: Sequence[str] | None = None) -> DataFrame:
    out = observations
    if segment is not None:
        out = out.where(F.col("segment").isin(*L.segment_spellings(segment)))
    for column, wanted in (("product", product), ("source_type", source_type), ("parameter", parameter)):
        if wanted is not None:
            out = out.where(F.col(column) == wanted)
    if since is not None:
        out = out.where(F.col("as_of_date") >= F.lit(since))
    if definition_classes is not None:
        out = out.where(F.col("data_definition_class").isin(*definition_classes))
    return out.withColumn("segment", L.canonical_segment(F.col("segment")))


def for_segment(observations: DataFrame, segment: str, *, product: str | None = None, source_type: str | None = None,
                only_pd: bool = True, definition_classes: Sequence[str] | None = None) -> DataFrame:
    """Rows of one segment; PD only unless asked otherwise."""
    return query_observations(
        observations, segment=segment, product=product, source_type=source_type,
        parameter="pd" if only_pd else None, definition_classes=definition_classes)


def by_source_type(observations: DataFrame, *, big4_only: bool = False, non_big4_only: bool = False) -> DataFrame:
    if big4_only and non_big4_only:
        raise ValueError("choose big4_only or non_big4_only, not both")
    big4 = L.is_big4(F.col("source_id"))
    return observations.where(big4) if big4_only else observations.where(~big4) if non_big4_only else observations


def with_side(observations: DataFrame) -> DataFrame:
    """Both sides in one read: the four major banks, and all others."""
    return observations.withColumn("side", F.when(L.is_big4(F.col("source_id")), F.lit("big4")).otherwise(F.lit("other")))


def list_segments(observations: DataFrame) -> DataFrame:
    return observations.select(L.canonical_segment(F.col("segment")).alias("segment")).distinct()


def get_by_segment(benchmarks: DataFrame, asset_class: str, data_type: str, *, condition: str | None = None,
                   component: str | None = None) -> DataFrame:
    out = live_versions(benchmarks).where((F.col("asset_class") == asset_class) & (F.col("data_type") == data_type))
    if condition is not None:
        out = out.where(F.col("condition") == condition)
    return out if component is None else out.where(F.col("component") == component)


def get_by_source_type(benchmarks: DataFrame, source_type: str) -> DataFrame:
    return live_versions(benchmarks).where(F.col("source_type") == source_type)


def version_history(benchmarks: DataFrame, source_id: str) -> DataFrame:
    return benchmarks.where(F.col("source_id") == source_id)


def list_benchmarks(benchmarks: DataFrame, *, latest_only: bool = True, source_type: str | None = None) -> DataFrame:
    out = live_versions(benchmarks) if latest_only else benchmarks
    out = out if source_type is None else out.where(F.col("source_type") == source_type)
    return out.orderBy("source_id", "version")


def registry_export(benchmarks: DataFrame, *, latest_only: bool = True) -> DataFrame:
    """One JSON record per registry row."""
    rows = live_versions(benchmarks) if latest_only else benchmarks
    return rows.select("source_id", "version", F.to_json(F.struct(*rows.columns)).alias("record"))


def duplicate_versions(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """(source_id, version) pairs that would break uniqueness on append."""
    keys = ["source_id", "version"]
    inside = batch.groupBy(*keys).count().where(F.col("count") > 1).select(*keys, F.lit("batch").alias("found_in"))
    against = batch.select(*keys).distinct().join(stored.select(*keys), keys, "left_semi").withColumn("found_in", F.lit("stored"))
    return inside.unionByName(against)


# --- refresh policy -------------------------------------------------------------------------

def refresh_actions(incoming: DataFrame, registry: DataFrame, order: Sequence[Column], coarse: Column) -> DataFrame:
    """Action for each incoming entry, applied in arrival order.

    An entry is compared with the state left by the registry and the entries before it: the latest date and
    the value last seen for it. The state is a fold in which a later date wins, and of one date the later
    arrival, so it is the greatest (date, arrival, value) so far. ``incoming`` is read once.
    """
    latest = registry.groupBy("source_id").agg(
        F.max_by(F.struct("value_date", "value"), F.col("version")).alias("_r")
    ).select("source_id", F.col("_r.value_date").alias("_reg_date"), F.col("_r.value").alias("_reg_value"))
    entry = F.struct(F.col("value_date").alias("date"), F.struct(*order).alias("rank"), F.col("value").alias("value"))
    rows = state_before(incoming, ["source_id"], order, coarse, entry, "_state").join(latest, "source_id", "left")
    stored = F.col("_state").isNull() | F.coalesce(F.col("_reg_date") > F.col("_state.date"), F.lit(False))
    held_date = F.when(stored, F.col("_reg_date")).otherwise(F.col("_state.date"))
    held_value = F.when(stored, F.col("_reg_value")).otherwise(F.col("_state.value"))
    known, same_date = held_date.isNotNull(), held_date == F.col("value_date")
    too_old, unchanged = held_date > F.col("value_date"), same_date & (held_value == F.col("value"))
    action = L.first_match(
        [
            (~known, F.lit("add")),
            (too_old, F.lit("skip_newer_in_registry")),
            (unchanged, F.lit("skip_unchanged")),
        ],
        F.lit("supersede"),
    )
    reason = L.first_match(
        [
            (~known, F.lit("new source_id")),
            (too_old, F.concat(F.lit("a later value_date than "), F.col("value_date").cast("string"), F.lit(" is already held"))),
            (unchanged, F.lit("identical value_date and value already in registry")),
            (same_date, F.lit("value correction (same date, new value)")),
        ],
        F.concat(F.lit("newer data ("), held_date.cast("string"), F.lit(" -> "), F.col("value_date").cast("string"), F.lit(")")),
    )
    return rows.select(*incoming.columns, action.alias("action"), reason.alias("reason"))


def supersede_verdicts(benchmarks: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries meant to replace a live version, with its ``prior_version``; ``dropped`` where there is none to replace."""
    live = benchmarks.groupBy("source_id").agg(F.max("version").alias("prior_version"))
    rows = entries.join(live, "source_id", "left")
    return rows.withColumn("dropped", F.when(F.col("prior_version").isNull(), F.lit("nothing_to_supersede")))


def supersede(benchmarks: DataFrame, entries: DataFrame, order: Sequence[Column], coarse: Column) -> DataFrame:
    """New versions of sources that have a live one, numbered on; the job fails on the first entry that has none."""
    rows = supersede_verdicts(benchmarks, entries)
    guard = F.when(F.col("dropped").isNotNull(), F.raise_error(F.concat(F.lit("no live benchmark to supersede: "), F.col("source_id"))))
    held = rows.where(F.coalesce(guard.cast("boolean"), F.lit(True))).drop("dropped", "prior_version", "version", "superseded_by")
    return assign_versions(held, order, coarse, prior=benchmarks)


def refresh_counts(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def ingest_status(benchmarks: DataFrame) -> DataFrame:
    return benchmarks.groupBy("source_type").agg(F.max("retrieval_date").alias("last_retrieval"))


# --- benchmark -> observation bridge ------------------------------------------------------------

OBS_KEY = ["source_id", "segment", "parameter", "as_of_date"]


def benchmark_observations(benchmarks: DataFrame) -> DataFrame:
    """Live benchmarks rendered as observation rows; rows outside the contract drop."""
    klass = L.definition_class(F.col("source_id"), F.col("data_type"))
    rows = live_versions(benchmarks).withColumn("data_definition_class", klass).where(F.col("data_definition_class").isNotNull())
    rows = rows.withColumn("parameter", L.parameter_of(F.col("data_definition_class"), F.col("data_type")))
    note = F.coalesce(F.nullif(F.col("notes"), F.lit("")), F.concat(F.col("publisher"), F.lit(" disclosure note unavailable")))
    return rows.select(
        "source_id", L.bridged_source_type(F.col("source_type"), F.col("source_id")).alias("source_type"),
        F.col("asset_class").alias("segment"), F.lit(None).cast("string").alias("product"), "parameter",
        "data_definition_class", F.when(F.col("parameter") != "commentary", F.col("value")).alias("value"),
        F.col("value_date").alias("as_of_date"),
        L.reporting_basis(F.col("source_type"), F.col("source_id"), F.col("notes")).alias("reporting_basis"),
        note.alias("methodology_note"), F.lit(None).cast("int").alias("sample_size_n"),
        F.lit(None).cast("date").alias("period_start"), F.col("value_date").alias("period_end"),
        F.col("url").alias("source_url"), F.lit(None).cast("string").alias("page_or_table_ref"),
    )


def not_yet_present(rows: DataFrame, observations: DataFrame, order: Column) -> DataFrame:
    """First row per observation key that the store does not hold (stored segment)."""
    rest = [c for c in rows.columns if c not in OBS_KEY]
    first = rows.groupBy(*OBS_KEY).agg(F.min_by(F.struct(*rest), order).alias("row")).select(*OBS_KEY, "row.*")
    return first.join(observations.select(*OBS_KEY), OBS_KEY, "left_anti")


def bridge_to_observations(benchmarks: DataFrame, observations: DataFrame) -> DataFrame:
    return not_yet_present(benchmark_observations(benchmarks), observations, F.col("value"))


# --- writes -----------------------------------------------------------------------------------------

def append_observations(accepted: DataFrame, path: str) -> None:
    """Append-only write, clustered by parameter and year of the as-of date.

    The rebalance hint lets adaptive execution split a parameter-year that holds
    most rows over many writers and join the small ones.
    """
    rows = accepted.withColumn("as_of_year", F.year("as_of_date"))
    rows.hint("rebalance", "parameter", "as_of_year").write.mode("append").partitionBy("parameter", "as_of_year").parquet(path)


def audit_append(spark: SparkSession, path: str, rows: Sequence[tuple[str, str | None, Mapping, str]], at: dt.datetime, actor: str = "system") -> None:
    """One audit row per operation (operation, entity, parameters, result), reads included."""
    log = [(operation, entity, json.dumps(dict(params), sort_keys=True, default=str), result, actor, at) for operation, entity, params, result in rows]
    spark.createDataFrame(log, schemas.AUDIT_LOG).coalesce(1).write.mode("append").parquet(path)


def audited_write(rows: DataFrame, out: str, audit_path: str, operation: str, counts: Mapping[str, Column], at: dt.datetime, actor: str = "system") -> None:
    """Write rows and log how many met each condition, counted by observation while they are written.

    ``counts`` names what is logged: an audit row per name, with the rows for which its condition held.
    """
    seen = Observation(operation)
    named = {f"c{i}": (name, condition) for i, (name, condition) in enumerate(counts.items())}
    watched = rows.observe(seen, *(F.count_if(condition).alias(c) for c, (_, condition) in named.items()))
    watched.write.mode("overwrite").parquet(out)
    found = seen.get
    audit_append(rows.sparkSession, audit_path, [(operation, name, {"entity": name}, str(found[c])) for c, (name, _) in named.items()], at, actor)


def observation_set_json(observations: DataFrame, flags: DataFrame) -> DataFrame:
    """JSON lines per segment: one flags record, then one record per row."""
    rows = observations.select("segment", F.lit("observation").alias("kind"), F.to_json(F.struct(*observations.columns)).alias("json"))
    head = flags.select("segment", F.lit("flags").alias("kind"), F.to_json(F.struct(*flags.columns)).alias("json"))
    return head.unionByName(rows)


def raw_observation_export(observations: DataFrame) -> DataFrame:
    """Audit projection: blank for null, six-place values, cohort and Big-4 marks."""
    def text(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)

    sid, st = F.col("source_id"), F.col("source_type")
    return observations.select(
        "source_id", "source_type", L.cohort_for(st, sid).alias("cohort"), L.is_big4(sid).alias("is_big4"),
        L.canonical_segment(F.col("segment")).alias("segment"), text("product"), "parameter", "data_definition_class",
        F.when(F.col("value").isNull(), F.lit("")).otherwise(F.format_string("%.6f", F.col("value"))).alias("value"),
        text("as_of_date"), "reporting_basis", "methodology_note", text("sample_size_n"), text("period_start"),
        text("period_end"), text("source_url"), text("page_or_table_ref"),
    )
