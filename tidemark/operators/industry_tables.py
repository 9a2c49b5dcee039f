"""Per-bank industry tables: page text -> industry rows.

Right-edge numeric tokens are peeled by one pattern per table; sections and
halves are cut out of the page text. Everything stays inside the page's row.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import text as X
from tidemark.functions.labels import first_match, lookup
from tidemark.operators.bands import plain_lines
from tidemark.session import staged

NUMBER = r"(?:\(\d[\d,]*\)|\d[\d,]*|[-–—])"
#: Where a letter or a space stands no figure begins. Each is named by itself: such a class is one table, while the figure's own signs are several tests.
_NO_FIGURE = "(?![" + string.ascii_letters + " ])"
_CUT = "\u0001"

# --- fixed values: published table layouts ------------------------------------------------

MATRIX_PORTFOLIOS = (
    "corporate", "sovereign", "financial_institution", "sme_retail", "residential_mortgage",
    "qualifying_revolving_retail", "other_retail", "specialised_lending", "other_assets", "rbnz_regulated_entities",
)
MATRIX_LEFT = (
    "Consumer", "Finance & Insurance", "Business Services", "Agriculture & Forestry", "Construction",
    "Mining, Oil & Gas", "Wholesale & Retail Trade", "Transport & Storage",
)
MATRIX_RIGHT = (
    "Manufacturing", "Commercial Property", "Government Administration & Defence", "Health & Community Services",
    "Entertainment, Leisure & Tourism", "Electricity, Gas & Water", "Other",
)


@dataclass(frozen=True)
class TableLayout:
    """One bank table: where rows start and end, and what each column means.

    ``columns`` lists (token index, metric, geography, gross component).
    """

    bank: str
    table_ref: str
    tokens: int
    columns: tuple[tuple[int, str, str, str | None], ...]
    start: str = ""
    end: str = r"(?smi)^\s*Total\s.*"
    row_index: bool = False
    footnotes: bool = False
    basis: str | None = "aasb9_stage3_ecl"
    period_months: int | None = None
    sections: tuple[str, ...] = field(default=())


_NPE, _PROV, _WO, _EXP = "npe_aud_m", "individually_assessed_provision_aud_m", "write_offs_aud_m", "exposure_aud_m"
_WBC_GEO = ("Australia", "New Zealand", "Other Overseas", "Total")
LAYOUTS = {
    "wbc_exposure": TableLayout(
        "wbc", "CRB(e)", 5, ((4, _EXP, "*", None),), end="", sections=("Australia", "New Zealand", "Other overseas")),
    "wbc_npe": TableLayout(
        "wbc", "CRB(f)", 9,
        tuple((i, _NPE, g, None) for i, g in enumerate(_WBC_GEO))
        + tuple((i + 4, _PROV, g, None) for i, g in enumerate(_WBC_GEO)) + ((8, _WO, "Total", None),),
        start=r"(?s)^.*?(?m:^\s*As at\s+\d{1,2}\s+\w+\s+\d{4}\s*$)", end=r"(?sm)^\s*(?:Total |[a-z]\.\s).*", period_months=12),
    "nab": TableLayout(
        "nab", "industry", 5, ((0, _EXP, "Total", None), (2, _NPE, "Total", None), (4, _PROV, "Total", None)),
        start=r"(?s)^.*?(?m:^\s*As at\s+\d{1,2}\s+\w+\s+\d{2,4}\s*$)", end=r"(?sm)^\s*Total[ \t].*", footnotes=True),
    "anz": TableLayout(
        "anz", "industry", 8,
        ((1, _EXP, "Total", "loans"), (2, _EXP, "Total", "off_balance_sheet"), (3, _EXP, "Total", "other"),
         (4, _NPE, "Total", None), (7, _PROV, "Total", None)),
        end=r"(?smi)^\s*\d{1,2}\s+total.*", row_index=True),
    "cba_npe": TableLayout(
        "cba", "CRB(f)(i)", 3, ((0, _NPE, "Total", None), (1, _PROV, "Total", None), (2, _WO, "Total", None)),
        start=r"(?s)^.*?(?m:^\s*\d{1,2}\s+(?:June|December|Jun|Dec)\s+\d{4}\s*$)", end=r"(?smi)^\s*total .*",
        basis="aps220_specific", period_months=12),
}


def _peel(n: int) -> str:
    return rf"^(.*?)\s*{_NO_FIGURE}(?<![\d,])({NUMBER}(?:\s+{NUMBER}){{{n - 1}}})$"


def _known(bank: str, label: Column) -> Column:
    """Published spelling of a label, matched without case."""
    return lookup(F.lower(F.trim(label)), {k.lower(): k for k in V.BANK_INDUSTRY_LABELS[bank]})


def _dated(pages: DataFrame, bank: str) -> DataFrame:
    """Pages with their printed date; a page without one is never given one."""
    plain = X.once(pages, text=X.plain_text(F.col("text")))
    return X.once(plain, as_of_date=X.page_as_of_date(F.col("text"), bank))


def undated_pages(pages: DataFrame, bank: str) -> DataFrame:
    """Quarantine: pages that print no date."""
    return _dated(pages, bank).where(F.col("as_of_date").isNull()).drop("text", "as_of_date").withColumn(
        "reason", F.lit("no_as_of_date"))


def _by_layout(layouts: dict[str, TableLayout], value: Callable[[TableLayout], Column]) -> Column:
    """The value of the row's own layout; the others are not evaluated."""
    return first_match([(F.col("layout") == name, value(layout)) for name, layout in layouts.items()])


def _sections(layout: TableLayout) -> Column:
    """The table's part of a page as (geography, text) stretches, one of no geography where the table has no sections."""
    body = F.col("text")
    for cut in (layout.start, layout.end):
        body = F.regexp_replace(body, cut, "") if cut else body
    if not layout.sections:
        return F.array(F.struct(F.lit(None).cast("string").alias("geography"), body.alias("body")))
    heads = "|".join(layout.sections)
    parts = F.split(F.regexp_replace(body, rf"(?m)^\s*({heads})\s*$", _CUT + "$1"), _CUT)
    named = F.transform(parts, lambda p: F.struct(F.regexp_extract(p, rf"^({heads})\s*(?:\n|$)", 1).alias("geography"),
                                                  F.regexp_replace(p, r"(?smi)^\s*Total\s.*", "").alias("body")))
    return F.filter(named, lambda p: p["geography"] != "")


def _cut_line(layout: TableLayout) -> Column:
    """A line with a mark between its label and the figures at its right edge; one that is no row has no mark."""
    line = F.col("line")
    if layout.row_index:
        line = F.when(line.rlike(r"^\d{1,2}\s+"), F.regexp_replace(line, r"^\d{1,2}\s+", ""))
    return F.regexp_replace(line, _peel(layout.tokens), f"$1{_CUT}$2")


def _label(layout: TableLayout) -> Column:
    """The label of a cut line."""
    label = F.substring_index("_cut", _CUT, 1)
    return F.trim(F.regexp_replace(label, r"\(\d+\)\s*$", "") if layout.footnotes else label)


def dispatched_rows(pages: DataFrame, layouts: dict[str, TableLayout] | None = None, *, strict: bool = True, period_months: Column | None = None) -> DataFrame:
    """Industry rows of pages that each name their ``layout``, all layouts in one pass over the pages.

    An unmatched industry label fails the job when strict; otherwise its row
    carries a null label and ``error`` for the quarantine.
    """
    layouts = layouts or LAYOUTS
    pages = pages.where(F.col("layout").isin(*layouts))
    keys = [c for c in pages.columns if c not in ("text", "layout")]
    fact = lambda value: _by_layout(layouts, lambda x: F.lit(value(x)))
    plain = X.once(pages, text=X.plain_text(F.col("text")))
    dated = X.once(plain, as_of_date=_by_layout(layouts, lambda x: X.page_as_of_date(F.col("text"), x.bank))).where(F.col("as_of_date").isNotNull())
    parts = dated.select(*keys, "layout", "as_of_date", F.inline(_by_layout(layouts, _sections)))
    lines = parts.select(*keys, "layout", "as_of_date", "geography", F.explode(plain_lines(F.col("body"))).alias("line"))
    # the right edge must hold figures before the full pattern is tried
    likely = lines.where(F.right("line", F.lit(1)).rlike(r"[\d)–—-]"))
    cut = X.once(likely, _cut=_by_layout(layouts, _cut_line)).where(F.col("_cut").contains(_CUT))
    rows = X.once(cut, label=_by_layout(layouts, _label), tokens=F.split(F.substring_index("_cut", _CUT, -1), r"\s+")).drop("line", "_cut")
    # column headings that end in figures are not rows of the table
    heading = F.lower("label").contains("$m") | F.lower("label").contains("industry sector")
    rows = rows.where(F.col("label").rlike("[A-Za-z]") & ~heading).withColumns(
        {"bank_code": fact(lambda x: x.bank), "source_table_ref": fact(lambda x: x.table_ref)})
    known = _by_layout(layouts, lambda x: _known(x.bank, F.col("label")))
    miss = F.raise_error(F.concat(F.col("bank_code"), F.lit(" "), F.col("source_table_ref"), F.lit(": unmatched industry label "), F.col("label"))).cast("string")
    rows = rows.withColumn("industry_published", F.coalesce(known, miss) if strict else known)
    columns = lambda x: F.array(*[
        F.struct(F.get("tokens", F.lit(i)).alias("token"), F.lit(m).alias("metric"), F.lit(g).alias("geo"), F.lit(c).cast("string").alias("component"))
        for i, m, g, c in x.columns])
    long = rows.withColumn("c", F.explode(_by_layout(layouts, columns)))
    token = F.when(F.col("c.token").isin(*X.DASHES), F.lit("-")).otherwise(F.col("c.token"))
    cell = X.coerce_metric_cell(F.col("bank_code"), F.col("industry_published"), token, F.col("source_table_ref"))
    months = period_months if period_months is not None else fact(lambda x: x.period_months)
    note = F.when(F.col("bank_code") == "cba", F.lit(" (APS 120 securitisation excluded)")).otherwise(F.lit(""))
    metric = F.col("c.metric")
    return long.withColumn("cell", cell).select(
        *keys, F.concat(F.lit("pillar3_"), "bank_code").alias("data_source"), F.lit("single_bank").alias("aggregation_level"),
        "bank_code", "as_of_date",
        F.when(metric == _WO, months.cast("int")).alias("period_length_months"), F.coalesce("geography", "c.geo").alias("geography"), "industry_published",
        metric.alias("metric"), F.col("cell.value").alias("value_aud_m"), F.col("cell.redaction").alias("redaction_reason"),
        F.concat(F.upper("bank_code"), F.lit(" Pillar 3"), F.when(metric == _NPE, note).otherwise(F.lit(""))).alias("source_publication"),
        "source_table_ref",
        F.when(metric == _PROV, fact(lambda x: x.basis)).alias("provision_basis"), F.col("c.component").alias("gross_carrying_component"),
        F.when(F.col("industry_published").isNull(), F.concat(F.lit("unmatched label: "), F.col("label"))).alias("error"))


def table_rows(pages: DataFrame, layout: TableLayout, *, strict: bool = True, period_months: Column | int | None = None) -> DataFrame:
    """Industry rows of one published table."""
    months = F.lit(period_months) if isinstance(period_months, int) else period_months
    return dispatched_rows(pages.withColumn("layout", F.lit("only")), {"only": layout}, strict=strict, period_months=months)


def _matrix_halves(pages: DataFrame) -> DataFrame:
    """Dated pages with the data lines of each half of their matrix."""
    keys = [c for c in pages.columns if c != "text"]
    dated = _dated(pages, "cba").where(F.col("as_of_date").isNotNull())
    parts = F.split(F.regexp_replace("text", r"(?mi)^\s*industry sector \(continued\)\s*$", _CUT), _CUT)
    pattern = _peel(8)

    def data(part: Column) -> Column:
        return F.filter(plain_lines(F.regexp_replace(part, r"(?smi)^\s*total credit exposures.*", "")), lambda x: x.rlike(pattern))

    return X.once(dated, halves=F.transform(parts, data)).select(*keys, "as_of_date", "halves")


def _matrix_fault() -> Column:
    known = len(MATRIX_PORTFOLIOS)
    odd = F.filter("halves", lambda lines: F.size(lines) != known)
    return (F.when(F.size("halves") > 2, F.concat(F.size("halves").cast("string"), F.lit(" matrix halves, at most 2 are known")))
            .when(F.size(odd) > 0, F.concat(F.size(odd[0]).cast("string"), F.lit(f" data rows in a matrix half, {known} are known"))))


def refused_matrix_pages(pages: DataFrame) -> DataFrame:
    """Quarantine: dated matrix pages whose rows cannot be named by their place."""
    keys = [c for c in pages.columns if c != "text"]
    return _matrix_halves(pages).select(*keys, "as_of_date", _matrix_fault().alias("reason")).where("reason is not null")


def matrix_rows(pages: DataFrame) -> DataFrame:
    """Two-half portfolio by industry matrix; the total column is not read.

    A row's place names its portfolio, so a page is read only if each of at most
    two halves has exactly the known rows; others are in ``refused_matrix_pages``.
    """
    keys = [c for c in pages.columns if c != "text"]
    pattern = _peel(8)
    whole = _matrix_halves(pages).where(_matrix_fault().isNull())
    parts = whole.select(*keys, "as_of_date", F.posexplode("halves").alias("half", "data"))
    rows = parts.select(*keys, "as_of_date", "half", F.posexplode("data").alias("row", "line"))
    names = F.when(F.col("half") == 0, F.array(*[F.lit(i) for i in MATRIX_LEFT])).otherwise(F.array(*[F.lit(i) for i in MATRIX_RIGHT]))
    cells = rows.withColumns({
        "portfolio_type": F.get(F.array(*[F.lit(p) for p in MATRIX_PORTFOLIOS]), F.col("row")), "names": names,
        "tokens": F.split(F.regexp_extract("line", pattern, 2), r"\s+")}).select(
        *keys, "as_of_date", "portfolio_type", F.posexplode("names").alias("col", "industry_published"), "tokens")
    token = F.get("tokens", F.col("col"))
    cell = X.coerce_metric_cell(F.lit("cba"), F.lit("<matrix-cell>"), F.when(token.isin(*X.DASHES), F.lit("-")).otherwise(token), F.lit("CRB(e)(ii)"))
    return cells.withColumn("cell", cell).select(
        *keys, F.lit("pillar3_cba").alias("data_source"), F.lit("single_bank").alias("aggregation_level"), F.lit("cba").alias("bank_code"),
        "as_of_date", F.lit(None).cast("int").alias("period_length_months"), F.lit("Total").alias("geography"), "industry_published",
        F.lit(_EXP).alias("metric"), F.col("cell.value").alias("value_aud_m"), F.col("cell.redaction").alias("redaction_reason"),
        F.lit("CBA Pillar 3").alias("source_publication"), F.lit("CRB(e)(ii)").alias("source_table_ref"), "portfolio_type")


# --- fixed values: pages of the published documents (bank, layout, page, months) ------------

PAGE_MAP = (
    ("wbc", "wbc_exposure", 37, None), ("wbc", "wbc_npe", 38, 12), ("nab", "nab", 37, None), ("anz", "anz", 43, None),
    ("cba", "matrix", 36, None), ("cba", "matrix", 37, None), ("cba", "cba_npe", 39, 12), ("cba", "cba_npe", 40, 6),
)


def bank_industry_rows(pages: DataFrame, page_map=PAGE_MAP, *, strict: bool = True) -> DataFrame:
    """All industry rows of the annual documents: a page's bank and number name its layout, and each page is read once.

    The pages that hold a table are written first, as the matrix is read by another rule than the tables.
    """
    at = F.concat_ws(" ", "bank", "page_no")
    layout = lookup(at, {f"{b} {p}": name for b, name, p, _ in page_map})
    held = staged(pages.withColumn("layout", layout).where(F.col("layout").isNotNull()), "industry-pages")
    months = lookup(F.concat_ws(" ", "bank_code", "page_no"), {f"{b} {p}": str(m) for b, _, p, m in page_map if m is not None} or {"": ""}).cast("int")
    tables = dispatched_rows(held.where("layout <> 'matrix'").drop("bank"), strict=strict, period_months=months)
    if "matrix" not in {name for _, name, _, _ in page_map}:
        return tables
    return tables.unionByName(matrix_rows(held.where("layout = 'matrix'").drop("bank", "layout")), allowMissingColumns=True)
