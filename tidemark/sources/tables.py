"""Stored tables, file sources and small dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from pathlib import Path
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark import fixed_values as V, schemas
from tidemark.functions import text as X
from tidemark.functions.labels import default_note, lookup
from tidemark.sources import seeds


# --- stored tables ------------------------------------------------------------------

def scan_observations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_OBSERVATIONS).parquet(path)


def scan_benchmarks(spark: SparkSession, path: str, latest_only: bool = True) -> DataFrame:
    table = spark.read.schema(schemas.BENCHMARKS).parquet(path)
    return live_versions(table) if latest_only else with_pointers(table)


def live_versions(benchmarks: DataFrame) -> DataFrame:
    """Highest version per source: the one meaning of "live" in every read.

    Stored rows are never rewritten, so pointers are derived on reading: the
    live row points nowhere, whatever it said when it was stored.
    """
    rest = [c for c in benchmarks.columns if c not in ("source_id", "superseded_by")]
    newest = benchmarks.groupBy("source_id").agg(F.max_by(F.struct(*rest), F.col("version")).alias("row")).select("source_id", "row.*")
    pointer = F.lit(None).cast(benchmarks.schema["superseded_by"].dataType).alias("superseded_by")
    return newest.select(*(pointer if c == "superseded_by" else F.col(c) for c in benchmarks.columns))


def with_pointers(benchmarks: DataFrame) -> DataFrame:
    """Every stored version, older ones pointing to their own id as the published registry does."""
    last = benchmarks.groupBy(F.col("source_id").alias("_id")).agg(F.max("version").alias("_last"))
    joined = benchmarks.join(last, F.col("source_id") == F.col("_id")).withColumn("superseded_by", F.when(F.col("version") < F.col("_last"), F.col("source_id")))
    return joined.select(*benchmarks.columns)


# --- small dimensions: rows fixed by configuration, never by data volume ---------------

def dimension(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A local relation with exact size statistics, so joins broadcast it safely."""
    struct = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    names = struct.fieldNames()
    table = pa.Table.from_pylist([dict(zip(names, r)) for r in rows], schema=to_arrow_schema(struct))
    return spark.createDataFrame(table)


def _yaml(path: str | Path) -> dict:
    import yaml

    return yaml.safe_load(Path(path).read_text(encoding="utf-8"))


class Scenario(NamedTuple):
    ord: int
    scenario: str
    scenario_label: str
    pd_x: float
    lgd_x: float
    ccf_x: float
    floored: bool
    macro_path: str


def stress_scenarios(path: str | None = None) -> list[Scenario]:
    """Ordered scenarios, from a YAML file or the standing set; text is collapsed."""
    if path is None:
        return [Scenario(*row) for row in V.STRESS_SCENARIOS]
    return [
        Scenario(i, name, " ".join(s["label"].split()), float(s["pd_multiplier"]), float(s["lgd_multiplier"]),
                 float(s["ccf_multiplier"]), bool(s.get("apply_reality_check_floor", False)), " ".join(s["macro_path"].split()))
        for i, (name, s) in enumerate(_yaml(path)["scenarios"].items())
    ]


def scenario_frame(spark: SparkSession, scenarios: Iterable[Scenario]) -> DataFrame:
    return dimension(spark, scenarios, "ord int, scenario string, scenario_label string, pd_x double, "
                                       "lgd_x double, ccf_x double, floored boolean, macro_path string")


def reality_check_bands(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Bands per product; the rationale and the review dates of the library are those of the configuration file, null without one."""
    if path is None:
        rows = [(p, lo, hi, up, down, None, None, None) for p, (lo, hi, up, down) in V.REALITY_CHECK_BANDS.items()]
    else:
        library = _yaml(path)
        reviewed = [None if library.get(k) is None else str(library[k]) for k in ("last_review_date", "next_review_due")]
        rows = [
            (p, float(b["lower_band_pd"]), float(b["upper_band_pd"]), b["upper_sources"], b["lower_sources"], b.get("rationale"), *reviewed)
            for p, b in library["products"].items()
        ]
    return dimension(spark, rows, "product string, lower_band_pd double, upper_band_pd double, upper_sources array<string>, lower_sources array<string>, "
                                  "rationale string, last_review_date string, next_review_due string")


def refresh_schedules(spark: SparkSession, path: str | None = None) -> DataFrame:
    days = V.REFRESH_DAYS if path is None else _yaml(path)["refresh_schedules"]
    return dimension(spark, days.items(), "source_type string, max_days int")


def industry_labels(spark: SparkSession) -> DataFrame:
    """(bank_code, label_norm) -> canonical_bucket, exploded from the nested map."""
    rows = [(bank, _norm(label), bucket) for bank, m in V.BANK_INDUSTRY_LABELS.items() for label, bucket in m.items()]
    return dimension(spark, rows, "bank_code string, label_norm string, canonical_bucket string")


def system_labels(spark: SparkSession) -> DataFrame:
    rows = [(_norm(label), bucket) for label, bucket in V.SYSTEM_INDUSTRY_LABELS.items()]
    return dimension(spark, rows, "label_norm string, canonical_bucket string")


def industry_buckets(spark: SparkSession) -> DataFrame:
    rows = [(b, b not in V.CONSUMER_BUCKETS) for b in V.INDUSTRY_BUCKETS]
    return dimension(spark, rows, "canonical_bucket string, business_lending boolean")


def segment_aliases(spark: SparkSession) -> DataFrame:
    """Segment, source and alias in listed order."""
    rows = [
        (i, seg, src, alias)
        for i, (seg, src, alias) in enumerate(
            (seg, src, a) for seg, m in V.SEGMENT_ALIAS_MAP.items() for src, al in m.items() for a in al)
    ]
    return dimension(spark, rows, "ord int, segment string, source string, alias string")


def sheet_metrics(spark: SparkSession) -> DataFrame:
    return dimension(spark, V.SHEET_METRICS, "source string, metric_column string, metric string, "
                                             "data_type string, raw_unit string, lo double, hi double")


def quality_matrix(spark: SparkSession) -> DataFrame:
    fields = ", ".join(f"{d} string" for d in V.QUALITY_DIMENSIONS)
    rows = [(k, *v) for k, v in V.QUALITY_MATRIX.items()]
    return dimension(spark, rows, f"source_type string, {fields}")


def segment_glossary(spark: SparkSession) -> DataFrame:
    return dimension(spark, V.SEGMENT_GLOSSARY.items(), "segment string, definition string")


def _norm(label: str) -> str:
    return " ".join(label.split()).lower()


def collapse(text: Column) -> Column:
    """Trim and collapse runs of white space of any kind, non-breaking spaces included."""
    return F.trim(F.regexp_replace(X.plain_text(text), r"\s+", " "))


# --- sheet, table and document sources ----------------------------------------------------

def unpivot_sheet(sheet: DataFrame, metric_columns: list[str], ids: list[str]) -> DataFrame:
    """Wide metric columns -> one row per non-null metric."""
    return sheet.unpivot(ids, metric_columns, "metric_column", "raw_value").where(F.col("raw_value").isNotNull())


def portfolio_points(portfolios: DataFrame, grades: DataFrame | None = None) -> DataFrame:
    """Portfolio (PD, LGD) and slotting-grade sheets -> (label, metric, raw_value)."""
    keep = [c for c in portfolios.columns if c not in ("portfolio", "PD", "LGD")]
    irb = unpivot_sheet(portfolios, ["PD", "LGD"], [*keep, "portfolio"]).select(
        *keep, F.col("portfolio").alias("asset_class_raw"), F.col("metric_column").alias("metric"),
        F.lower("metric_column").alias("data_type_hint"), "raw_value")
    if grades is None:
        return irb
    slotting = grades.select(
        *keep, F.lit("Specialised Lending").alias("asset_class_raw"),
        F.concat(F.lit("SLOTTING_"), F.upper("grade"), F.lit("_PD")).alias("metric"),
        F.lit("pd").alias("data_type_hint"), F.col("PD").alias("raw_value"))
    return irb.unionByName(slotting.where(F.col("raw_value").isNotNull()))


def read_parsed_tables(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PARSED_TABLES).option("multiLine", True).json(path)


def parsed_table_points(documents: DataFrame) -> DataFrame:
    """Parsed-table documents -> PD, LGD and slotting points by table name."""
    rows = documents.select(
        "bank", "reporting_date", F.explode("tables").alias("t")
    ).select("bank", "reporting_date", F.col("t.name").alias("table_name"), F.explode("t.rows").alias("r"))
    label = F.upper(F.replace(F.col("r.asset_class_raw"), F.lit(" "), F.lit("_")))
    irb = rows.where(F.col("table_name") == "IRB Credit Risk").select(
        "bank", "reporting_date", F.col("r.asset_class_raw").alias("asset_class_raw"), label.alias("label"),
        F.col("r.pd").alias("PD"), F.col("r.lgd").alias("LGD"),
    )
    irb = unpivot_sheet(irb, ["PD", "LGD"], ["bank", "reporting_date", "asset_class_raw", "label"]).select(
        "bank", "reporting_date", "asset_class_raw",
        F.concat_ws("_", F.upper("bank"), "label", "metric_column").alias("source_name"),
        F.lower("metric_column").alias("data_type_hint"), "raw_value")
    slotting = rows.where(F.col("table_name") == "Specialised Lending").select(
        "bank", "reporting_date", F.lit("Specialised Lending").alias("asset_class_raw"),
        F.concat(F.upper("bank"), F.lit("_SPECIALISED_LENDING_SLOTTING_"), F.upper("r.grade"), F.lit("_PD")).alias("source_name"),
        F.lit("pd").alias("data_type_hint"), F.col("r.pd").alias("raw_value"))
    return irb.unionByName(slotting)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return manifest_items(spark.read.schema(schemas.MANIFEST).option("multiLine", True).json(path))


def manifest_items(manifests: DataFrame) -> DataFrame:
    return manifests.select(F.explode("items").alias("i")).select("i.*")


SIDECAR_KEYS = ("rba_fsr", "rba_smp", "rba_chart_pack")


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """Publication sidecars; unreadable files are skipped."""
    return source_documents(
        spark.read.schema(schemas.PUBLICATION_SIDECAR).option("multiLine", True)
        .option("mode", "PERMISSIVE").option("pathGlobFilter", "*.metadata.json").json(path)
    )


def source_documents(sidecars: DataFrame) -> DataFrame:
    """Keep the three report publications, in their fixed order column."""
    rank = F.array_position(F.array(*[F.lit(k) for k in SIDECAR_KEYS]), F.col("source_key")).cast("int") - 1
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("source", "url", "local_cached_file", "period", "retrieval_date")]
    return (
        sidecars.where(F.col("source_key").isin(*SIDECAR_KEYS) & F.col("_corrupt_record").isNull())
        .select(rank.alias("ord"), "source_key",
                F.coalesce("publisher", F.lit("Reserve Bank of Australia")).alias("publisher"), *blank)
    )


# --- fixed values: file kinds by suffix, and files that are not data ------------------
FILE_KINDS = {
    "pdf": "pdf", "xlsx": "xlsx", "xls": "xls", "csv": "csv", "html": "html_snapshot",
    "md": "manual_note", "txt": "text", "zip": "archive",
}
NOISE_FILES = (".gitkeep", ".DS_Store", "Thumbs.db")


def raw_file_inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row per raw file; only file metadata is read, never the content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length", "modificationTime")
    )
    base = root.rstrip("/") + "/"
    relative = F.substring_index("path", base, -1)
    parts = F.split(relative, "/")
    name = F.element_at(parts, -1)
    suffix = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    manual = name.endswith("_MANUAL.md") | name.contains("GATE.md")
    noise = name.isin(*NOISE_FILES) | name.startswith(".") | F.array_contains(parts, "__pycache__")
    return files.where(~noise).select(
        parts[0].alias("source_family"), F.when(F.size(parts) > 2, parts[1]).otherwise("").alias("subfamily"),
        name.alias("filename"), relative.alias("relative_path"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_utc"),
        F.when(manual, F.lit("manual_note")).otherwise(F.coalesce(lookup(suffix, FILE_KINDS), F.lit("other"))).alias("kind"),
    )


def seed_benchmarks(spark: SparkSession) -> DataFrame:
    """The starting registry: one version per entry, a standing note where none is given."""
    rows = []
    for source_id, publisher, source_type, data_type, segment, value, value_date, years, quality, retrieved, url, note in seeds.ENTRIES:
        rows.append((source_id, 1, publisher, source_type, data_type, segment, "AU", url, note, value, value_date, years, None, None, retrieved, quality, None, None))
    note = default_note(*[F.col(c) for c in ("source_type", "publisher", "asset_class", "data_type", "value_date", "url", "source_id")])
    return dimension(spark, rows, schemas.BENCHMARKS).withColumn("notes", F.coalesce("notes", note))
