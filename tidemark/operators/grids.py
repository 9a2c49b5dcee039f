"""Workbook grids: cells (doc, sheet, row, column) -> ratio rows.

A sheet is one row with its filled cells in order, so header rows, label rows and
figures are found inside the row: one exchange brings the cells together, and
thousands of workbooks are thousands of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import labels as L, text as X
from tidemark.operators.checks import accepted, metric_ceiling, range_rules, verdict

SHEET = ["doc_id", "sheet"]

# --- fixed values: sheets, rows and labels of the published workbooks ------------------

FIRST_QUARTER = "2022-03-31"
PERFORMANCE_SHEETS = {"Tab 1d": "all_adis", "Tab 2d": "banks", "Tab 4d": "major_banks"}
PERFORMANCE_ROWS = {53: "npl_ratio", 54: "ninety_dpd_rate"}
EXPOSURE_SHEETS = {
    "Tab 1a": ("all_adis", "commercial"), "Tab 1b": ("all_adis", "residential"),
    "Tab 2a": ("banks", "commercial"), "Tab 2b": ("banks", "residential"),
    "Tab 4a": ("major_banks", "commercial"), "Tab 4b": ("major_banks", "residential"),
}
EXPOSURE_CLASSES = {"commercial": "commercial_property_investment", "residential": "residential_mortgage"}


@dataclass(frozen=True)
class RowMatcher:
    """A label row: every required text, none of the forbidden ones."""

    book: str
    role: str
    required: tuple[str, ...]
    forbidden: tuple[str, ...] = ()


EXPOSURE_MATCHERS = (
    RowMatcher("commercial", "denominator", ("total commercial property exposures",), ("limits", "of which")),
    RowMatcher("commercial", "numerator", ("non-performing commercial property exposures",), ("of which", "provisions")),
    RowMatcher("residential", "denominator", ("total credit o",), ("limits", "by purpose", "term loans")),
    RowMatcher("residential", "numerator", ("non-performing loans",), ("term loans", "selected", "during the quarter", "of which", "by lvr")),
)
QUARTERLY_NPE_SHEET, QUARTERLY_EAD_SHEET = "CRB(f)(ii)", "EAD & CRWA"
QUARTERLY_PORTFOLIOS = (
    ("corporate_aggregate", "corporate (incl."), ("retail_sme", "sme retail"), ("residential_mortgage", "residential mortgage"),
    ("retail_qrr", "qualifying revolving retail"), ("retail_other", "other retail"), ("specialised_lending", "specialised lending"),
    ("financial_institution", "financial institution"), ("sovereign", "sovereign"),
)


# --- a sheet as one row --------------------------------------------------------------------

def sheets(cells: DataFrame, keys: Sequence[str] = SHEET) -> DataFrame:
    """One row per sheet (or workbook) with its filled cells in order of row and column; one exchange, the only one of a grid job.

    A sheet is bounded by the format it comes from, a corpus of workbooks is not.
    """
    inside = [c for c in ("sheet", "row_idx", "col_idx", "text", "num") if c not in keys]
    filled = cells.where(F.col("text").isNotNull() | F.col("num").isNotNull())
    return filled.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*inside))).alias("cells"))


def _number(cell: Column) -> Column:
    return F.coalesce(cell["num"], X.number_token(cell["text"]))


def _label(cell: Column) -> Column:
    return F.lower(F.trim(cell["text"]))


def _header(preferred: int = 3, scan: int = 10, min_cells: int = 10) -> Column:
    """Cells (row_idx, col_idx, as_of_date) of a sheet's date row.

    The preferred row wins when it holds enough dates, else the first of the
    top rows that does. Column 0 carries labels and is never a date.
    """
    rows = sorted({*range(scan), preferred})
    top = F.filter("cells", lambda c: c["row_idx"].isin(rows) & (c["col_idx"] > 0))
    dated = F.filter(F.transform(top, lambda c: F.struct(c["row_idx"], c["col_idx"], X.quarter_end(c["text"]).alias("as_of_date"))), lambda d: d["as_of_date"].isNotNull())

    def chosen(found: Column) -> Column:
        enough = F.filter(F.array(*map(F.lit, rows)), lambda r: F.size(F.filter(found, lambda d: d["row_idx"] == r)) >= min_cells)
        row = F.when(F.array_contains(enough, preferred), preferred).otherwise(F.array_min(enough))
        return X.let(row, lambda r: F.filter(found, lambda d: d["row_idx"] == r))

    return X.let(dated, chosen)


def date_header(cells: DataFrame) -> DataFrame:
    """Header row of each sheet and its (col_idx, as_of_date) cells."""
    return sheets(cells).select(*SHEET, F.inline(_header())).withColumnRenamed("row_idx", "header_row")


def _matches(label: Column, m: RowMatcher) -> Column:
    yes = reduce(lambda a, b: a & b, [label.contains(r) for r in m.required])
    no = reduce(lambda a, b: a & b, [~label.contains(f) for f in m.forbidden], F.lit(True))
    return yes & no


def _role_row(role: str, matchers: Sequence[RowMatcher]) -> Column:
    """First row of a sheet whose label fits a role; the sheet's book picks the matcher."""
    labels = F.filter("cells", lambda c: (c["col_idx"] == 0) & c["text"].isNotNull())
    return L.first_match([
        (F.col("book") == m.book, F.array_min(F.transform(F.filter(labels, lambda c: _matches(_label(c), m)), lambda c: c["row_idx"])))
        for m in matchers if m.role == role], F.lit(None).cast("int"))


def label_rows(cells: DataFrame, matchers: Sequence[RowMatcher] = EXPOSURE_MATCHERS) -> DataFrame:
    """First row per (sheet, role) whose label fits."""
    roles = list(dict.fromkeys(m.role for m in matchers))
    found = F.array(*[F.struct(F.lit(r).alias("role"), _role_row(r, matchers).alias("row_idx")) for r in roles])
    return sheets(cells, [*SHEET, "book"]).select(*SHEET, "book", F.inline(found)).where(F.col("row_idx").isNotNull())


def _at(cells: Column, row: Column, col: Column) -> Column:
    """Number in a cell of a sheet."""
    return F.array_max(F.transform(F.filter(cells, lambda c: (c["row_idx"] == row) & (c["col_idx"] == col)), _number))


def exposure_verdicts(cells: DataFrame) -> DataFrame:
    """Non-performing over total exposure per sheet and quarter, with both sides kept and what is dropped and why."""
    sector = L.lookup(F.col("sheet"), {s: a for s, (a, _) in EXPOSURE_SHEETS.items()})
    book = L.lookup(F.col("sheet"), {s: b for s, (_, b) in EXPOSURE_SHEETS.items()})
    held = sheets(cells.where(F.col("sheet").isin(*EXPOSURE_SHEETS))).withColumn("book", book)
    # only the two rows that are read stay beside the header
    roles = held.withColumns({f"{r}_row": _role_row(r, EXPOSURE_MATCHERS) for r in ("numerator", "denominator")})
    rows = roles.select(*SHEET, "book", "numerator_row", "denominator_row", F.filter("cells", lambda c: c["row_idx"].isin(
        F.col("numerator_row"), F.col("denominator_row"))).alias("used"), F.inline(_header()))
    both = rows.withColumns({f"{r}_value": _at(F.col("used"), F.col(f"{r}_row"), F.col("col_idx")) for r in ("numerator", "denominator")})
    ratio = F.try_divide(F.col("numerator_value"), F.col("denominator_value"))
    reason = verdict((F.col("numerator_value").isNull(), "no_numerator"), (F.coalesce(F.col("denominator_value"), F.lit(0.0)) == 0, "no_denominator"),
                     *range_rules(F.col("value"), metric_ceiling(F.lit("npl_ratio"))))
    return both.withColumn("value", ratio).select(
        "doc_id", sector.alias("institution_sector"), L.lookup(F.col("book"), EXPOSURE_CLASSES).alias("asset_class"),
        L.period_slug(F.col("as_of_date")).alias("period"), F.lit("npl_ratio").alias("metric_name"), "value", "as_of_date",
        "numerator_value", "denominator_value", F.col("sheet").alias("source_sheet"), "numerator_row", "denominator_row", reason.alias("dropped"))


def exposure_ratios(cells: DataFrame) -> DataFrame:
    """The accepted rows of ``exposure_verdicts``."""
    return accepted(exposure_verdicts(cells))


def performance_verdicts(cells: DataFrame) -> DataFrame:
    """Fixed ratio rows of the sector sheets, with what is dropped and why; quarters before the first comparable one are."""
    held = sheets(cells.where(F.col("sheet").isin(*PERFORMANCE_SHEETS)))
    used = F.filter("cells", lambda c: c["row_idx"].isin(*PERFORMANCE_ROWS) & (c["col_idx"] > 0))
    rows = held.select(*SHEET, used.alias("used"), F.inline(_header()))
    metrics = F.array(*[F.struct(F.lit(m).alias("metric_name"), F.lit(r).alias("source_row"), _at(F.col("used"), F.lit(r), F.col("col_idx")).alias("value"))
                        for r, m in PERFORMANCE_ROWS.items()])
    reason = verdict((F.col("as_of_date") < F.lit(FIRST_QUARTER).cast("date"), "before_first_quarter"),
                     *range_rules(F.col("value"), metric_ceiling(F.col("metric_name"))))
    return rows.select(*SHEET, "as_of_date", F.inline(metrics)).select(
        "doc_id", L.lookup(F.col("sheet"), PERFORMANCE_SHEETS).alias("institution_sector"), F.lit("adi_sector_total").alias("asset_class"),
        L.period_slug(F.col("as_of_date")).alias("period"), "metric_name", "value", "as_of_date",
        F.col("sheet").alias("source_sheet"), "source_row", reason.alias("dropped"))


def performance_ratios(cells: DataFrame) -> DataFrame:
    """The accepted rows of ``performance_verdicts``."""
    return accepted(performance_verdicts(cells))


def quarterly_verdicts(cells: DataFrame) -> DataFrame:
    """Non-performing sheet over exposure sheet per portfolio, first matching row of each, with what is dropped and why."""
    held = sheets(cells.where(F.col("sheet").isin(QUARTERLY_NPE_SHEET, QUARTERLY_EAD_SHEET)), ["doc_id"])

    def first_number(sheet: str, phrase: str) -> Column:
        """First number right of the first label that has one."""
        own = F.filter("cells", lambda c: c["sheet"] == sheet)
        labels = F.filter(own, lambda c: (c["col_idx"] == 0) & _label(c).contains(phrase))
        right = F.flatten(F.transform(labels, lambda x: F.filter(own, lambda c: (c["row_idx"] == x["row_idx"]) & (c["col_idx"] > 0) & _number(c).isNotNull())))
        return F.get(F.transform(F.slice(right, 1, 1), _number), F.lit(0))

    sides = F.array(*[F.struct(F.lit(c).alias("asset_class"), first_number(QUARTERLY_NPE_SHEET, p).alias("numerator_value"),
                               first_number(QUARTERLY_EAD_SHEET, p).alias("denominator_value")) for c, p in QUARTERLY_PORTFOLIOS])
    both = held.select("doc_id", F.inline(sides)).where(F.col("numerator_value").isNotNull() | F.col("denominator_value").isNotNull())
    reason = verdict((F.col("numerator_value").isNull(), "no_numerator"), (F.coalesce(F.col("denominator_value"), F.lit(0.0)) == 0, "no_denominator"),
                     *range_rules(F.col("value"), metric_ceiling(F.lit("npl_ratio"))))
    return both.withColumn("value", F.try_divide("numerator_value", "denominator_value")).withColumns(
        {"metric_name": F.lit("npl_ratio"), "dropped": reason})


def quarterly_ratios(cells: DataFrame) -> DataFrame:
    """The accepted rows of ``quarterly_verdicts``."""
    return accepted(quarterly_verdicts(cells))


def detected_tables(cells: DataFrame, pattern: str, columns: dict[str, int]) -> DataFrame:
    """First detected table per document whose first three rows mention ``pattern``; named columns."""
    heads = cells.where((F.col("row_idx") < 3) & F.lower("text").contains(pattern.lower()))
    chosen = heads.groupBy("doc_id").agg(F.min("sheet").alias("sheet"))
    picked = cells.join(chosen, SHEET)
    return picked.groupBy(*SHEET, "row_idx").agg(*[F.max(F.when(F.col("col_idx") == i, F.col("text"))).alias(n) for n, i in columns.items()])


def irb_table_points(tables: DataFrame) -> DataFrame:
    """PD and LGD of a detected portfolio table; heading rows have no numbers and drop."""
    def rate(column: str) -> Column:
        n = X.number_token(F.col(column))
        return F.when(F.col(column).contains("%"), n / 100).otherwise(n)

    cells = F.array(F.struct(F.lit("pd").alias("metric_name"), rate("pd").alias("value")),
                    F.struct(F.lit("lgd").alias("metric_name"), rate("lgd").alias("value")))
    return tables.select("doc_id", X.label_class(F.col("asset_class")).alias("asset_class"), F.explode(cells).alias("c")).select(
        "doc_id", "asset_class", "c.*").where(F.col("value").isNotNull())


# --- points and observations from grid rows ------------------------------------------------


def exposure_points(ratios: DataFrame) -> DataFrame:
    """Ratio rows as scraped points whose quality map keeps the arithmetic's inputs."""
    text = {c: F.col(c).cast("string") for c in ("numerator_row", "denominator_row", "numerator_value", "denominator_value")}
    quality = {"coverage": F.lit("apra_qpex_asset_class"), "sector": F.col("institution_sector"), "source_sheet": F.col("source_sheet"), **text,
               "arithmetic": F.lit("npl_ratio = non_performing_dollars / total_exposure_dollars")}
    meta = {"data_type_hint": F.lit("npl"), "metric_column": F.concat(F.lit("qpex_"), "institution_sector", F.lit("_"), "metric_name"), "period_code": F.col("period")}

    def as_map(d: dict[str, Column]) -> Column:
        return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v)])

    return ratios.select(
        F.concat_ws("_", F.lit("APRA_QPEX"), F.upper("asset_class"), F.upper("institution_sector"), F.upper("metric_name")).alias("source_name"),
        F.lit("APRA").alias("publisher"), F.col("value").alias("raw_value"), F.lit("ratio").alias("raw_unit"), F.col("as_of_date").alias("value_date"),
        F.lit(1).alias("period_years"), F.col("asset_class").alias("asset_class_raw"), F.lit("AU").alias("geography"),
        as_map(quality).alias("quality_indicators"), as_map(meta).alias("metadata"))


def series_observations(performance: DataFrame, exposures: DataFrame) -> DataFrame:
    """Grid series as observation rows with ids from sector, segment and metric."""
    def shape(rows: DataFrame, prefix: str, source_type: str, basis: str, parameter: Column, klass: Column) -> DataFrame:
        segment = L.canonical_segment(F.col("asset_class"))
        return rows.select(
            F.concat_ws("_", F.lit(prefix), F.upper("institution_sector"), F.upper(segment), F.upper("metric_name")).alias("source_id"),
            F.lit(source_type).alias("source_type"), segment.alias("segment"), parameter.alias("parameter"),
            klass.alias("data_definition_class"), "value", "as_of_date", F.lit(basis).alias("reporting_basis"),
            F.concat_ws(" ", F.lit(prefix.replace("_", " ")), F.col("institution_sector"), F.col("metric_name"), F.col("source_sheet")).alias("methodology_note"),
            F.col("as_of_date").alias("period_end"), F.col("source_sheet").alias("page_or_table_ref"))

    npl = F.col("metric_name") == "npl_ratio"
    perf = shape(performance, "APRA_PERF", "apra_performance", "APRA quarterly ADI performance time series",
                 F.when(npl, "npl").otherwise("arrears"), F.when(npl, "npl_ratio").otherwise("arrears_90_plus_days"))
    qpex = shape(exposures, "APRA_QPEX", "apra_qpex", "APRA quarterly property exposures time series", F.lit("npl"), F.lit("npl_ratio"))
    return perf.unionByName(qpex)


