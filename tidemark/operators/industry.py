"""Cross-bank industry aggregates with null-safe sums and explicit refusals.

Groups end at (bucket, bank): fifteen buckets and the banks of the label map.
Sums run in two levels with map-side combine, so a bank or bucket with most of
the rows costs one partial row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L
from tidemark.functions.stats import poisoned_sum, safe_ratio
from tidemark.operators.checks import PROVENANCE_COLUMNS, RefusedError, require_columns
from tidemark.operators.latest import most_recent_per_bank
from tidemark.sources.tables import collapse

SUBROW_COLUMNS = ("gross_carrying_component", "portfolio_type")
INTRA_KEYS = ("bank_code", "industry_published", "metric", "as_of_date", "geography", "period_length_months")


def label_norm(label: Column) -> Column:
    return F.lower(collapse(label))


def strict_bucket(rows: DataFrame, labels: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Attach the canonical bucket; an unmapped label fails the job."""
    joined = rows.join(F.broadcast(labels), keys, "left")
    miss = F.raise_error(F.concat(F.lit(f"no {what} entry for label "), F.col("industry_published"))).cast("string")
    return joined.withColumn("canonical_bucket", F.coalesce("canonical_bucket", miss)).drop("label_norm")


def harmonise(rows: DataFrame, labels: DataFrame, strict: bool = True) -> DataFrame:
    """(bank, label) -> canonical bucket; ``labels`` is the fixed label map."""
    keyed = rows.withColumn("label_norm", label_norm(F.col("industry_published")))
    if strict:
        return strict_bucket(keyed, labels, ["bank_code", "label_norm"], "harmonisation")
    return keyed.join(F.broadcast(labels), ["bank_code", "label_norm"], "left").drop("label_norm")


def unmatched_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Published labels without a bucket, with their row counts."""
    return harmonise(rows, labels, strict=False).where(F.col("canonical_bucket").isNull()).groupBy(
        "bank_code", "industry_published").agg(F.count(F.lit(1)).alias("n"))


def with_business_lending(rows: DataFrame, buckets: DataFrame) -> DataFrame:
    """Business-lending mark of each bucket; an unknown bucket fails the job."""
    joined = rows.join(F.broadcast(buckets), "canonical_bucket", "left")
    miss = F.raise_error(F.concat(F.lit("unknown bucket "), F.col("canonical_bucket"))).cast("boolean")
    return joined.withColumn("business_lending", F.coalesce("business_lending", miss))


def union_bank_frames(frames: list[DataFrame]) -> DataFrame:
    """Per-bank frames with differing optional columns as one."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def intra_bank_totals(rows: DataFrame, order: str = "row_seq") -> DataFrame:
    """Collapse sub-row dimensions to (bank, industry, metric, period) level.

    One null sub-row makes the total null: a partial sum would read too low.
    """
    require_columns(rows, PROVENANCE_COLUMNS, "intra_bank_totals")
    if not any(c in rows.columns for c in SUBROW_COLUMNS):
        return rows.withColumn("derived_from_intra_bank_sum", F.lit(False)).withColumn(
            "null_reason", F.when(F.col("value_aud_m").isNull(), F.col("redaction_reason")))
    meta = [c for c in rows.columns if c not in (*INTRA_KEYS, *SUBROW_COLUMNS, "value_aud_m", "redaction_reason", order)]
    value = poisoned_sum(F.col("value_aud_m"))
    reason = F.min_by("redaction_reason", F.when(F.col("redaction_reason").isNotNull(), F.col(order)))
    out = rows.groupBy(*INTRA_KEYS).agg(
        value.alias("value_aud_m"), reason.alias("redaction_reason"),
        (F.count(F.lit(1)) > 1).alias("derived_from_intra_bank_sum"),
        F.min_by(F.struct(*meta), F.col(order)).alias("_meta"), F.min(order).alias(order),
    )
    null = F.col("value_aud_m").isNull()
    return out.select(
        *INTRA_KEYS, "value_aud_m", F.when(null, F.col("redaction_reason")).alias("redaction_reason"),
        "derived_from_intra_bank_sum", F.when(null, F.lit("partial_redaction_in_subrows")).alias("null_reason"),
        "_meta.*", order)


def consumer_view(rows: DataFrame, view: str | None) -> DataFrame:
    """Business buckets only, or exactly one consumer bucket; never all three."""
    if view is None:
        return rows.where(~F.col("canonical_bucket").isin(*V.CONSUMER_BUCKETS))
    if view not in V.CONSUMER_VIEWS:
        raise ValueError(f"consumer_view must be one of {sorted(V.CONSUMER_VIEWS)}; got {view!r}")
    return rows.where(F.col("canonical_bucket") == V.CONSUMER_VIEWS[view])


def writeoff_period(rows: DataFrame, months: int | None) -> DataFrame:
    """Rows of one period length; half-years are never summed onto full years."""
    if months not in (6, 12):
        raise RefusedError("IncompatiblePeriodLength", f"write_offs(period={months!r})",
                           "write-off aggregation needs period_length_months of 6 or 12")
    return rows.where(F.col("period_length_months") == months)


def _bank_sums(rows: DataFrame, *, newest: bool, prefer_total: bool) -> DataFrame:
    """Sum and date per (bucket, bank), in one chain of aggregates over one read of the rows.

    Each (bank, industry, date) carries the sums of its published totals and of all its geographies, and
    one of the two is chosen; sums of a date follow, and of the dates either the newest is picked with
    its sums or all are added.
    """
    total = F.coalesce(F.lower("geography") == "total", F.lit(False))
    value, derived = F.col("value_aud_m"), F.col("derived_from_intra_bank_sum")
    parts = {"all": F.lit(True), "total": total}
    cells = rows.groupBy("canonical_bucket", "bank_code", "as_of_date", "industry_published").agg(
        *(F.struct(F.sum(F.when(c, value)).alias("sum"), F.count(F.when(c, value)).alias("known"), F.count_if(c).alias("rows"),
                   F.bool_or(F.when(c, derived)).alias("derived")).alias(n) for n, c in parts.items()))
    chosen = F.when(F.col("total.rows") > 0, F.col("total")).otherwise(F.col("all")) if prefer_total else F.col("all")
    dates = cells.withColumn("c", chosen).groupBy("canonical_bucket", "bank_code", "as_of_date").agg(
        F.struct(F.sum("c.sum").alias("sum"), F.sum("c.known").alias("known"), F.sum("c.rows").alias("rows"), F.bool_or("c.derived").alias("derived")).alias("d"))
    banks = dates.groupBy("canonical_bucket", "bank_code")
    if newest:
        return banks.agg(F.max_by("d", "as_of_date").alias("d"), F.max("as_of_date").alias("date")).select("canonical_bucket", "bank_code", "d.*", "date")
    return banks.agg(F.sum("d.sum").alias("sum"), F.sum("d.known").alias("known"), F.sum("d.rows").alias("rows"), F.bool_or("d.derived").alias("derived"),
                     F.max("as_of_date").alias("date"))


def _by_bucket(per_bank: DataFrame, metric: str, months: int | None = None) -> DataFrame:
    whole = F.sum("known") == F.sum("rows")
    # at most one row per bank of the label map reaches these lists
    dated = F.sort_array(F.collect_list(F.struct("bank_code", "date")))
    return per_bank.groupBy("canonical_bucket").agg(
        F.when(whole, F.sum("sum")).cast("double").alias("value_aud_m"),
        F.sort_array(F.collect_set("bank_code")).alias("contributing_banks"),
        F.map_from_entries(dated).alias("bank_as_of_dates"), F.max("date").alias("as_of_date"),
        F.bool_or("derived").alias("derived_from_intra_bank_sum"),
        F.when(~whole, F.lit("contributing_bank_null")).alias("null_reason"),
    ).select(
        "canonical_bucket", F.lit(metric).alias("metric"), "value_aud_m", "contributing_banks", "bank_as_of_dates",
        F.lit("most_recent_per_bank").alias("aggregate_as_of_date_strategy"), "as_of_date",
        F.lit(months).cast("int").alias("aggregate_period_length_months"), "derived_from_intra_bank_sum", "null_reason",
        F.lit(None).cast("string").alias("coverage_ratio_caveat"), F.lit(None).cast("boolean").alias("low_coverage_flag"))


def inter_bank_aggregate(totals: DataFrame, metric: str, labels: DataFrame, *, view: str | None = None,
                         months: int | None = None, geography: str = "prefer_total") -> DataFrame:
    """Bank totals -> one row per canonical bucket.

    ``geography='sum_all'`` keeps every published geography, total rows
    included; the default counts a total once.
    """
    if metric not in V.SUMMABLE_METRICS:
        raise RefusedError("CrossBankAggregation", f"inter_bank_aggregate({metric!r})",
                           "only exposure, non-performing exposure and write-offs are summable across banks")
    rows = consumer_view(harmonise(totals.where(F.col("metric") == metric), labels), view)
    # the period comes first: a total of another period says nothing about these parts
    flow = metric == "write_offs_aud_m"
    rows = writeoff_period(rows, months) if flow else rows
    per_bank = _bank_sums(rows, newest=not flow, prefer_total=geography == "prefer_total")
    return _by_bucket(per_bank, metric, months if flow else None)


def provisions_same_basis(totals: DataFrame, basis: str, labels: DataFrame, *, view: str | None = None) -> DataFrame:
    """Provisions of banks on one accounting basis; mixed input is refused."""
    asked = f"provisions_same_basis({basis!r})"
    if basis not in V.PROVISION_BASES:
        raise RefusedError("CrossBankAggregation", asked, f"provision_basis must be one of {list(V.PROVISION_BASES)}")
    rows = totals.where(F.col("metric") == "individually_assessed_provision_aud_m")
    # a bounded probe: two distinct values already decide
    found = [r[0] for r in rows.select("provision_basis").where(F.col("provision_basis").isNotNull()).distinct().limit(2).collect()]
    if len(found) > 1:
        raise RefusedError("CrossBankAggregation", asked, f"input mixes provision bases {sorted(found)}")
    if found and basis not in found:
        raise RefusedError("CrossBankAggregation", asked, f"requested basis is not in the input, which carries {found}")
    kept = consumer_view(harmonise(rows.where(F.col("provision_basis") == basis), labels), view)
    per_bank = _bank_sums(kept, newest=True, prefer_total=False)
    return _by_bucket(per_bank, "individually_assessed_provision_aud_m").withColumn("provision_basis", F.lit(basis))


def mixed_groups(rows: DataFrame) -> DataFrame:
    """Refusals as rows: groups of one bank, date and metric that no sum may cover, with the rule they break.

    Provisions on more than one accounting basis, and write-offs over periods of more than one length.
    """
    keys = ["bank_code", "as_of_date", "metric"]
    # both lists are of a handful of published values
    groups = rows.groupBy(*keys).agg(
        F.array_sort(F.collect_set("provision_basis")).alias("bases"), F.array_sort(F.collect_set("period_length_months")).alias("lengths"),
        F.count_if(F.col("source_table_ref").isNull()).alias("unsourced"))
    found = F.array_compact(F.array(
        F.when((F.col("metric") == "individually_assessed_provision_aud_m") & (F.size("bases") > 1),
               F.struct(F.lit("CrossBankAggregation").alias("refusal_type"), F.array_join("bases", ", ").alias("found"))),
        F.when((F.col("metric") == "write_offs_aud_m") & (F.size("lengths") > 1),
               F.struct(F.lit("IncompatiblePeriodLength").alias("refusal_type"), F.array_join(F.transform("lengths", lambda m: m.cast("string")), ", ").alias("found"))),
        F.when(F.col("unsourced") > 0, F.struct(F.lit("MissingProvenance").alias("refusal_type"), F.col("unsourced").cast("string").alias("found")))))
    return groups.select(*keys, F.explode(found).alias("r")).select(*keys, "r.*")


def refusal_log(spark: SparkSession, refusals: list[RefusedError]) -> DataFrame:
    """Refusals as rows, returned beside results instead of kept in a process."""
    from tidemark.sources.tables import dimension

    return dimension(spark, [r.refusal for r in refusals], "refusal_type string, requested_aggregation string, rule_violated string")


# --- system stock and coverage -----------------------------------------------------------

def system_stock_by_bucket(stock: DataFrame, labels: DataFrame) -> DataFrame:
    """System lending of the newest date per bucket; unmapped labels are left out."""
    used = stock.where(~F.col("industry_published").isin(*V.SYSTEM_CONSTRUCTION_PARTS, V.SYSTEM_UNIVERSE_LABEL))
    keyed = used.withColumn("label_norm", label_norm(F.col("industry_published"))).join(F.broadcast(labels), "label_norm", "left")
    dates = keyed.groupBy("canonical_bucket", "as_of_date").agg(F.struct(
        poisoned_sum(F.col("value_aud_m")).cast("double").alias("sum"), F.min("source_publication_date").alias("published"),
        F.sort_array(F.collect_set("series_break_flag")).alias("flags")).alias("d"))
    # one row per bucket: its newest date with the sums of that date; buckets without the newest of all have none
    buckets = dates.groupBy("canonical_bucket").agg(F.max_by("d", "as_of_date").alias("d"), F.max("as_of_date").alias("date"))
    newest = buckets.withColumn("newest", F.max("date").over(W.partitionBy(F.lit(0))))
    return newest.where((F.col("date") == F.col("newest")) & F.col("canonical_bucket").isNotNull()).select(
        "canonical_bucket", F.col("d.sum").alias("outstanding_aud_m"), F.col("d.published").alias("publication_date"),
        F.transform("d.flags", lambda f: F.concat(F.lit("d14_1_series_break_"), f)).alias("caveats"))


def coverage_ratios(aggregates: DataFrame, stock_by_bucket: DataFrame) -> DataFrame:
    """Big-4 exposure over system stock per bucket, with its caveats."""
    joined = aggregates.select(
        "canonical_bucket", F.col("as_of_date").alias("as_of_date_big4"), F.col("value_aud_m").alias("big4_ead_aud_m"),
        "contributing_banks", "bank_as_of_dates").join(stock_by_bucket, "canonical_bucket", "left")
    ead, stock = F.col("big4_ead_aud_m"), F.col("outstanding_aud_m")
    ratio = F.when(stock != 0, F.try_divide(ead, stock))
    caveats = F.concat(
        F.array(F.lit("ead_vs_outstanding_soft_proxy"), F.lit("d14_1_lender_scope_banks_and_rfcs_only")),
        F.coalesce("caveats", F.array(F.lit("d14_1_no_matching_bucket"))),
        F.when(stock.isNull(), F.array(F.lit("d14_1_suppressed"))).otherwise(F.array().cast("array<string>")))
    return joined.select(
        "canonical_bucket", "as_of_date_big4", F.col("publication_date").alias("as_of_date_d14_1"), "big4_ead_aud_m",
        stock.alias("d14_1_outstanding_aud_m"), F.round(ratio, 8).alias("coverage_ratio"),
        F.array_join(caveats, "; ").alias("coverage_ratio_caveat"),
        F.coalesce(ratio < V.LOW_COVERAGE, F.lit(False)).alias("low_coverage_flag"), "contributing_banks", "bank_as_of_dates")


def aps120_caveat(aggregates: DataFrame) -> DataFrame:
    """Scope caveat on non-performing rows that CBA contributes to."""
    hit = (F.col("metric") == "npe_aud_m") & F.array_contains("contributing_banks", "cba")
    old = F.nullif(F.col("coverage_ratio_caveat"), F.lit(""))
    return aggregates.withColumn(
        "coverage_ratio_caveat",
        F.when(hit, F.concat_ws("; ", old, F.lit("cba_aps120_scope_mismatch"))).otherwise(F.col("coverage_ratio_caveat")))


# --- wide per-bank view ---------------------------------------------------------------------

WIDE_COLUMNS = {
    "exposure_aud_m": "exposure_aud_m", "npe_aud_m": "npe_aud_m",
    "individually_assessed_provision_aud_m": "provision_aud_m", "write_offs_aud_m": "write_offs_aud_m",
}


def bank_industry_wide(totals: DataFrame) -> DataFrame:
    """Newest date per bank: four metrics and two ratios per (bank, industry)."""
    latest = most_recent_per_bank(totals, ("bank_code",))
    total = F.lower("geography") == "total"
    cells = latest.groupBy("bank_code", "industry_published", "metric", "as_of_date").agg(
        F.bool_or(total).alias("_t"),
        F.sum(F.when(total, F.col("value_aud_m"))).alias("_ts"), F.count(F.when(total, F.col("value_aud_m"))).alias("_tk"),
        F.count_if(total).alias("_tn"), F.sum("value_aud_m").alias("_s"), F.count("value_aud_m").alias("_k"),
        F.count(F.lit(1)).alias("_n"))
    value = F.when(F.col("_t"), F.when(F.col("_tk") == F.col("_tn"), F.col("_ts"))).otherwise(
        F.when(F.col("_k") == F.col("_n"), F.col("_s")))
    known = cells.withColumn("v", value.cast("double")).where(F.col("v").isNotNull())
    wide = known.groupBy("bank_code", "industry_published").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("v"))).alias(c) for m, c in WIDE_COLUMNS.items()],
        F.max("as_of_date").alias("as_of_date"))
    return wide.select(
        "bank_code", F.upper("bank_code").alias("bank"), F.col("industry_published").alias("industry"), *WIDE_COLUMNS.values(),
        safe_ratio(F.col("npe_aud_m"), F.col("exposure_aud_m")).alias("npe_rate_decimal"),
        safe_ratio(F.col("write_offs_aud_m"), F.col("exposure_aud_m")).alias("write_off_rate_decimal"), "as_of_date")


def in_bank_order(wide: DataFrame) -> DataFrame:
    return wide.orderBy(L.rank_in(F.col("bank_code"), V.BIG4), F.lower("industry"))
