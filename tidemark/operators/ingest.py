"""Scraped points -> benchmark entries, and document routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import labels as L
from tidemark.operators.checks import failures


def sheet_points(sheet: DataFrame, source: str, metrics: DataFrame) -> DataFrame:
    """Canonical sheet rows (period, category, metric columns) as scraped points."""
    columns = [c for _, c, *_ in V.SHEET_METRICS if c in sheet.columns]
    long = sheet.unpivot(["period", "category"], columns, "metric_column", "raw_value").where(F.col("raw_value").isNotNull())
    spec = metrics.where(F.col("source") == source).select("metric_column", "metric", "data_type", "raw_unit")
    return long.join(F.broadcast(spec), "metric_column").select(
        F.lit(source).alias("source"), "metric_column",
        F.concat_ws("_", F.lit("APRA"), F.upper("category"), F.upper("metric")).alias("source_name"), F.lit("APRA").alias("publisher"),
        "raw_value", "raw_unit", F.col("period").alias("value_date"), F.lit(1).alias("period_years"),
        F.col("category").alias("asset_class_raw"), F.lit("AU").alias("geography"), F.lit("https://disclosure.example/apra").alias("url"),
        F.date_add("period", 60).alias("retrieval_date"), F.create_map(F.lit("coverage"), F.lit("all_adis")).alias("quality_indicators"),
        F.create_map(F.lit("data_type_hint"), F.col("metric"), F.lit("metric_column"), F.col("metric_column")).alias("metadata"))


def points_to_entries(points: DataFrame, override: dict[str, str] | None = None, quality: str = "HIGH") -> DataFrame:
    """Benchmark entries of scraped points; ``errors`` names what could not be mapped."""
    meta = F.col("metadata")

    def hint(key: str):
        return F.nullif(F.try_element_at(meta, F.lit(key)), F.lit(""))

    source_type = L.map_source_type(F.col("publisher"))
    data_type = L.infer_data_type(F.coalesce(hint("data_type_hint"), F.col("source_name")))
    asset_class = L.map_asset_class(F.col("asset_class_raw"), override)
    value = L.normalize_value(F.col("raw_value"), F.col("raw_unit"))
    mapped = points.withColumns({"source_type": source_type, "data_type": data_type, "asset_class": asset_class, "value": value})
    source_id = F.coalesce(hint("source_id_override"), L.generate_source_id(
        F.col("publisher"), F.col("asset_class"), F.col("data_type"), F.col("value_date"), F.coalesce(hint("metric_column"), F.lit("")), hint("period_code")))
    return mapped.select(
        source_id.alias("source_id"), F.lit(1).alias("version"), "publisher", "source_type", "data_type", "asset_class", "geography", "url",
        L.quality_notes(F.col("quality_indicators")).alias("notes"), "value", "value_date", "period_years",
        L.one_of(hint("condition"), V.CONDITIONS).alias("condition"), L.one_of(hint("component"), V.COMPONENTS).alias("component"),
        "retrieval_date", F.lit(quality).alias("quality_score"), F.lit(None).cast("string").alias("superseded_by"),
        failures((F.col("source_type").isNull(), "unknown_publisher"), (F.col("data_type").isNull(), "unknown_metric"),
                 (F.col("value").isNull(), "unknown_unit")).alias("errors"))


def route_documents(documents: DataFrame, cells: DataFrame) -> DataFrame:
    """Extraction branch of each document: canonical sheet, source name, then suffix.

    ``documents`` carries (doc_id, file_name, source_name).
    """
    canonical = ("Asset Quality", "Property Exposures", "IRB Credit Risk")
    has = cells.where(F.col("sheet").isin(*canonical)).select("doc_id").distinct().withColumn("_canonical", F.lit(True))
    name, file = F.lower("source_name"), F.lower("file_name")
    return documents.join(has, "doc_id", "left").withColumn("route", L.first_match([
        (F.col("_canonical"), F.lit("canonical_sheet")),
        (file.endswith(".pdf"), F.lit("pdf_tables")),
        (~file.rlike(r"\.xlsx?$"), F.lit("none")),
        (name.rlike("qpex|property"), F.lit("property_exposures")),
        (name.rlike("performance"), F.lit("performance")),
        (name.contains("pillar3"), F.lit("quarterly_workbook")),
    ], F.lit("none"))).drop("_canonical")
