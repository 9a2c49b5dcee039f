"""Table schemas. Explicit everywhere: nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _I, _L, _DT, _TS, _B = (
    T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.DateType(),
    T.TimestampType(), T.BooleanType(),
)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


RAW_OBSERVATIONS = _struct(
    ("source_id", _S, False), ("source_type", _S, False), ("segment", _S, False),
    ("product", _S), ("parameter", _S, False), ("data_definition_class", _S, False),
    ("value", _D), ("as_of_date", _DT, False), ("reporting_basis", _S, False),
    ("methodology_note", _S, False), ("sample_size_n", _I), ("period_start", _DT),
    ("period_end", _DT), ("source_url", _S), ("page_or_table_ref", _S),
    ("obs_seq", _L, False),
)

#: What an adapter hands on: an observation before the store numbers it. Rules, not the schema, refuse nulls.
PARSED_OBSERVATION = T.StructType([T.StructField(f.name, f.dataType) for f in RAW_OBSERVATIONS.fields if f.name != "obs_seq"])

BENCHMARKS = _struct(
    ("source_id", _S, False), ("version", _I, False), ("publisher", _S, False),
    ("source_type", _S, False), ("data_type", _S, False), ("asset_class", _S, False),
    ("geography", _S, False), ("url", _S, False), ("notes", _S), ("value", _D, False),
    ("value_date", _DT, False), ("period_years", _I, False), ("condition", _S),
    ("component", _S), ("retrieval_date", _DT, False), ("quality_score", _S, False),
    ("superseded_by", _S), ("inserted_at", _TS),
)

AUDIT_LOG = _struct(
    ("operation", _S, False), ("entity_id", _S), ("params_json", _S),
    ("result_summary", _S), ("actor", _S, False), ("timestamp", _TS, False),
)

SCRAPED_POINTS = _struct(
    ("source_name", _S, False), ("publisher", _S, False), ("raw_value", _D, False),
    ("raw_unit", _S, False), ("value_date", _DT, False), ("period_years", _I, False),
    ("asset_class_raw", _S, False), ("geography", _S, False), ("url", _S),
    ("retrieval_date", _DT, False),
    ("quality_indicators", T.MapType(_S, _S)), ("metadata", T.MapType(_S, _S)),
)

INDUSTRY_ROWS = _struct(
    ("data_source", _S), ("aggregation_level", _S), ("bank_code", _S), ("as_of_date", _DT),
    ("period_length_months", _I), ("geography", _S), ("industry_published", _S),
    ("metric", _S), ("value_aud_m", T.DecimalType(18, 2)), ("redaction_reason", _S),
    ("source_publication", _S), ("source_table_ref", _S), ("source_page", _I),
    ("provision_basis", _S), ("portfolio_type", _S), ("gross_carrying_component", _S),
)

SYSTEM_STOCK = _struct(
    ("data_source", _S), ("metric", _S), ("as_of_date", _DT), ("business_size", _S),
    ("industry_published", _S), ("value_aud_m", T.DecimalType(18, 2)), ("series_id", _S),
    ("series_break_flag", _S), ("redaction_reason", _S), ("synthesised", _B),
    ("source_publication_date", _DT),
)

CELLS = _struct(
    ("doc_id", _S), ("sheet", _S), ("row_idx", _I), ("col_idx", _I), ("text", _S), ("num", _D),
)
PAGE_TEXT = _struct(("doc_id", _S), ("page_no", _I), ("text", _S))
LISTING_HTML = _struct(("page_url", _S), ("html", _S))
LINKS = _struct(
    ("source_key", _S), ("title", _S), ("url", _S), ("published_date", _S),
    ("fetched_at", _S), ("local_path", _S), ("sha256", _S),
)
MANIFEST = T.StructType([
    T.StructField("source_key", _S),
    T.StructField("items", T.ArrayType(LINKS)),
])
PARSED_TABLES = T.StructType([
    T.StructField("bank", _S),
    T.StructField("reporting_date", _S),
    T.StructField("notes", _S),
    T.StructField("tables", T.ArrayType(T.StructType([
        T.StructField("name", _S),
        T.StructField("rows", T.ArrayType(_struct(
            ("asset_class_raw", _S), ("pd", _D), ("lgd", _D),
            ("exposure_ead_mn", _D), ("grade", _S),
        ))),
    ]))),
])
PUBLICATION_SIDECAR = _struct(
    ("source_key", _S), ("source", _S), ("publisher", _S), ("url", _S),
    ("local_cached_file", _S), ("period", _S), ("retrieval_date", _S),
    ("_corrupt_record", _S),
)
