"""Row validation: every rule names its failure; rows split into accepted and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark import fixed_values as V
from tidemark.functions import labels as L


class RefusedError(ValueError):
    """A request that a documented rule forbids; carries its refusal row."""

    def __init__(self, refusal_type: str, requested: str, rule: str):
        super().__init__(f"{refusal_type}: {rule}")
        self.refusal = (refusal_type, requested, rule)


def failures(*rules: tuple[Column, str]) -> Column:
    """Codes of the rules whose condition holds."""
    return F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(code)) for cond, code in rules]))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine) by the ``errors`` array."""
    clean = F.size("errors") == 0
    return checked.where(clean).drop("errors"), checked.where(~clean)


def strict(checked: DataFrame) -> DataFrame:
    """Fail the job on the first bad row."""
    guard = F.when(F.size("errors") > 0, F.raise_error(F.concat(F.lit("invalid row: "), F.array_join("errors", ", "))))
    return checked.where(F.coalesce(guard.cast("boolean"), F.lit(True))).drop("errors")


def check_observations(rows: DataFrame) -> DataFrame:
    par, value, klass = F.col("parameter"), F.col("value"), F.col("data_definition_class")
    commentary = par == "commentary"
    legal = L.first_match([((par == p) & klass.isin(*c), F.lit(True)) for p, c in V.LEGAL_CLASSES.items()], F.lit(False))
    return rows.withColumn("errors", failures(
        (F.col("period_start") > F.col("period_end"), "period_order"),
        (~par.isin(*V.PARAMETERS), "unknown_parameter"),
        (~F.col("source_type").isin(*V.SOURCE_TYPES), "unknown_source_type"),
        (commentary & value.isNotNull(), "commentary_has_value"),
        (~commentary & value.isNull(), "value_missing"),
        (~commentary & ~value.between(0.0, 1.0), "value_out_of_range"),
        (par.isin(*V.PARAMETERS) & ~legal, "definition_not_legal"),
        (F.col("sample_size_n") < 0, "negative_sample_size"),
        (F.col("reporting_basis") == "legacy BenchmarkEntry v1", "placeholder_basis"),
        (F.lower("methodology_note").startswith("migrated from"), "placeholder_note"),
    ))


def check_benchmarks(rows: DataFrame) -> DataFrame:
    kind, comp, value = F.col("data_type"), F.col("component"), F.col("value")
    outside = ~value.between(0.0, 1.0)
    return rows.withColumn("errors", failures(
        (F.col("value_date") > F.col("retrieval_date"), "value_after_retrieval"),
        (F.col("period_years") < 1, "period_years"), (F.col("version") < 1, "version"),
        (~F.col("source_type").isin(*V.SOURCE_TYPES), "unknown_source_type"),
        (~kind.isin(*V.DATA_TYPES), "unknown_data_type"),
        (~F.col("quality_score").isin(*V.QUALITY_SCORES), "unknown_quality"),
        (comp.isNotNull() & ~kind.isin(*V.COMPONENT_DATA_TYPES), "component_not_allowed"),
        (comp.isNull() & kind.isin(*V.BOUNDED_DATA_TYPES) & outside, "value_out_of_range"),
        (comp.isin("haircut", "workout_costs") & outside, "component_out_of_range"),
        (comp.isin("time_to_recovery", "discount_rate") & ~(value > 0), "component_not_positive"),
    ))


def check_industry_rows(rows: DataFrame) -> DataFrame:
    metric, value, why = F.col("metric"), F.col("value_aud_m"), F.col("redaction_reason")
    months = F.col("period_length_months")
    flow = metric == "write_offs_aud_m"
    rules = [
        (F.col("aggregation_level") != "single_bank", "aggregation_level"),
        (~metric.isin(*V.INDUSTRY_METRICS), "unknown_metric"),
        (value.isNull() & why.isNull(), "null_without_reason"),
        (value.isNotNull() & why.isNotNull(), "value_and_reason"),
        (~why.isin(*V.REDACTION_REASONS), "unknown_reason"),
        (metric.isin(*V.STOCK_METRICS) & months.isNotNull(), "stock_with_period"),
        (flow & (months.isNull() | ~months.isin(6, 12)), "flow_period"),
        (~F.col("provision_basis").isin(*V.PROVISION_BASES), "unknown_basis"),
    ]
    if "contributing_banks" in rows.columns:
        rules.append((F.lit(True), "contributing_banks_present"))
    return rows.withColumn("errors", failures(*rules))


# --- two verdicts: a parser marks what it would drop, the sink splits ------------------------

def verdict(*rules: tuple[Column, str]) -> Column:
    """Reason of the first rule whose condition holds; null for a row that is accepted."""
    return L.first_match([(F.coalesce(cond, F.lit(False)), F.lit(reason)) for cond, reason in rules], F.lit(None).cast("string"))


def range_rules(value: Column, high: Column | float, low: float = 0.0) -> tuple[tuple[Column, str], ...]:
    """A cell without a number, and a number outside its range."""
    return (value.isNull(), "no_value"), (~value.between(low, high), "out_of_range")


def accepted(rows: DataFrame) -> DataFrame:
    """The rows a parser keeps."""
    return rows.where("dropped IS NULL").drop("dropped")


def quarantined(rows: DataFrame) -> DataFrame:
    """The rows a parser would drop, each with its reason in ``dropped``."""
    return rows.where("dropped IS NOT NULL")


def conform(rows: DataFrame, contract: T.StructType, adapter: str) -> DataFrame:
    """Rows with the columns of an adapter's output contract, in its order and types; a missing column is refused before any work."""
    require_columns(rows, tuple(contract.fieldNames()), adapter)
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields))


def observation_verdicts(rows: DataFrame, contract: T.StructType, adapter: str) -> DataFrame:
    """Parser rows through the observation rules: rows dropped while parsing keep that reason, others get the rules they break."""
    parsed = rows if "dropped" in rows.columns else rows.withColumn("dropped", F.lit(None).cast("string"))
    shaped = conform(parsed, T.StructType([*contract.fields, T.StructField("dropped", T.StringType())]), adapter)
    errors = check_observations(shaped)
    broken = F.when(F.size("errors") > 0, F.array_join("errors", ", "))
    return errors.withColumn("dropped", F.coalesce("dropped", broken)).drop("errors")


# --- plausibility: keep in-range rows, drop the rest with a reason --------------------------

def within(rows: DataFrame, value: str, low: Column, high: Column) -> DataFrame:
    keep = F.col(value).between(low, high)
    return rows.withColumns({"range_lo": low, "range_hi": high, "plausible": keep})


def plausible_sheet_points(points: DataFrame, metrics: DataFrame) -> DataFrame:
    """Range of the full metric from the ingest configuration, default [0, 1]."""
    ranges = metrics.select("source", "metric_column", "lo", "hi")
    joined = points.join(F.broadcast(ranges), ["source", "metric_column"], "left")
    return within(joined, "raw_value", F.coalesce("lo", F.lit(0.0)), F.coalesce("hi", F.lit(1.0))).drop("lo", "hi")


def pillar3_range(source_name: Column, hint: Column, label: Column) -> Column:
    """(lo, hi) by slotting grade, LGD hint, then asset class; permissive otherwise."""
    name, text = F.lower(source_name), F.lower(label)

    def span(key: str) -> Column:
        lo, hi = V.PILLAR3_RANGES[key]
        return F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))

    grades = [(name.contains(g), span(g)) for g in V.PILLAR3_RANGES if g.startswith("slotting_")]
    return L.first_match(
        grades
        + [
            (F.lower(hint) == "lgd", span("lgd")),
            (text.contains("residential"), span("residential")),
            (text.contains("commercial") | text.contains("cre"), span("commercial")),
            (text.contains("corporate") | text.contains("sme"), span("corporate")),
        ],
        span("lgd"),
    )


def plausible_pillar3(points: DataFrame) -> DataFrame:
    """Portfolio ranges apply to aggregate-grain points only; band rows pass through."""
    span = pillar3_range(F.col("source_name"), F.col("data_type_hint"), F.col("asset_class_raw"))
    rows = points.withColumn("_span", span)
    out = within(rows, "raw_value", F.col("_span.lo"), F.col("_span.hi")).drop("_span")
    if "grain" in points.columns:
        out = out.withColumn("plausible", F.col("plausible") | (F.col("grain") != "aggregate"))
    return out


def metric_ceiling(metric: Column) -> Column:
    return F.coalesce(L.lookup(metric, {k: str(v) for k, v in V.METRIC_CEILINGS.items()}).cast("double"), F.lit(1.0))


def plausible_metric(rows: DataFrame) -> DataFrame:
    return within(rows, "value", F.lit(0.0), metric_ceiling(F.col("metric_name")))


# --- table contracts ---------------------------------------------------------------------------

PROVENANCE_COLUMNS = (
    "data_source", "bank_code", "as_of_date", "industry_published", "metric",
    "value_aud_m", "source_publication", "source_table_ref",
)


def require_columns(df: DataFrame, required: tuple[str, ...], requested: str) -> DataFrame:
    """Refuse before planning when a required column is absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise RefusedError("MissingProvenance", requested, f"input lacks required columns: {missing}")
    return df
