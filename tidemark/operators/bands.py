"""PD-band disclosure tables: page text -> PD and LGD rows.

A page is one row, so everything positional happens inside that row: lines are
labelled in place, the page is cut at its label lines, and each piece carries
its label to its own band lines. No shuffle, no window, any page length.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions import text as X
from tidemark.operators import checks
from tidemark.session import staged

BAND = r"(?=\d)(\d+\.\d+ to <\d+\.\d+|100\.00 \(Default\))\s+(.*)$"
MACQUARIE_BAND = r"(?=\d)(\d+\.\d+ to <\d+\.\d+|100\.00 \(Non-Performing\))\s+(.*)$"
LOOSE_BAND = r"(?=\d)(\d+\.\d+\s*to\s*<\s*\d+\.\d+|100\.00\s*\(Default\))\s+(.*)$"
TABLE_HEADER = r"(?mi)^\s*CR6\s*:\s*IRB"
NEXT_TABLE = r"(?smi)^\s*CR(?:7|8|9|10)\s*:.*"
MACQUARIE_HEADER = r"(?i)Table\s+7\s*:\s*CR6\s*-\s*IRB"
MACQUARIE_DATE = r"(?i)(?=3)\b((?:30|31)\s+(?:March|September)\s+\d{4})\b"
# a line of the table, its default band perhaps broken in two
ANY_BAND = r"(?=\d)(?:\d+\.\d+ to <\d+\.\d+|100\.00 \(Non-)"
NON_PERFORMING = "100.00 (Non-Performing)"

_CUT, _END = "\u0001", "\u0002"


def plain_lines(text: Column) -> Column:
    """Trimmed lines of a text that has been normalised."""
    return F.transform(F.split(text, "\n"), lambda x: F.trim(x))


def trimmed_lines(text: Column) -> Column:
    return plain_lines(X.plain_text(text))


def _marked_pieces(lines: Column, label: Callable[[Column, Column, Column], Column]) -> Column:
    """The page cut before its labelled lines; a piece opens with its label and the end mark, if it has one."""
    marked = F.transform(
        lines, lambda x, i: F.concat(F.coalesce(F.concat(F.lit(_CUT), label(x, i, lines), F.lit(_END)), F.lit("")), x))
    return F.split(F.array_join(marked, "\n"), "\n?" + _CUT)


def _piece_label(piece: Column) -> Column:
    return F.when(piece.contains(_END), F.substring_index(piece, _END, 1))


def _piece_lines(piece: Column) -> Column:
    return F.split(F.substring_index(piece, _END, -1), "\n")


def carried_lines(df: DataFrame, lines: Column, label: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Explode lines with the label of the last labelled line at or above them, and their number.

    ``label(line, index, all_lines)`` is null on lines that do not relabel.
    """
    held = df.withColumn("_lines", lines)
    kept = [c for c in held.columns if c != "_lines"]
    pieces = held.select(*kept, F.posexplode(_marked_pieces(F.col("_lines"), label)).alias("_at", "_piece"))
    lines = pieces.select(*kept, "_at", _piece_label(F.col("_piece")).alias("label"), F.posexplode(_piece_lines(F.col("_piece"))).alias("_in", "line"))
    # pieces are in page order, and so are the lines of a piece
    return lines.select(*kept, F.struct("_at", "_in").alias("line_no"), "label", "line")


def _prefix(line: Column, index_prefix: str | None, band: str = BAND) -> Column:
    """Text before the PD band; the whole line when it has no band."""
    head = F.trim(F.regexp_replace(line, band, ""))
    if index_prefix is None:
        return head
    return F.when(line.rlike(band), F.trim(F.regexp_replace(head, index_prefix, ""))).otherwise(head)


def portfolio_label(patterns: Sequence[tuple[str, str]], index_prefix: str | None = None):
    """Portfolio of a line, reading split headers from its neighbours.

    A following "(...)" continuation is preferred, then the line above joined
    with this prefix, then the prefix alone.
    """

    def known(text: Column) -> Column:
        return X.let(text, lambda t: X.contains_class(t, patterns))

    def label(line: Column, i: Column, lines: Column) -> Column:
        above = F.coalesce(F.get(lines, i - 1), F.lit(""))
        one, two = F.coalesce(F.get(lines, i + 1), F.lit("")), F.coalesce(F.get(lines, i + 2), F.lit(""))
        # the look-ahead keeps a row index: it only matters as a "(...)" start
        below = _prefix(F.when(one != "", one).otherwise(two), None)

        def banded(prefix: Column) -> Column:
            return F.when(prefix != "", F.coalesce(
                X.let(below, lambda nxt: F.when(nxt.startswith("("), known(F.concat_ws(" ", prefix, nxt)))),
                X.let(_prefix(above, index_prefix), lambda old: F.when(old != "", known(F.concat_ws(" ", old, prefix)))),
                known(prefix)))

        return F.when(line == "", F.lit(None).cast("string")).when(
            line.rlike(BAND), X.let(_prefix(line, index_prefix), banded)).otherwise(known(line))

    return label


def _band_cells(lines: DataFrame, keys: Sequence[str], band: str, columns: dict[str, int],
                tidy: Callable[[Column], Column] = lambda rest: rest) -> DataFrame:
    """Band lines as (keys, label, pd_band, named token values), also those under no label; each line is split once."""
    rest = tidy(F.regexp_extract("line", band, 2))
    cells = X.let(F.split(F.trim(rest), r"\s+"), lambda tok: F.struct(
        *[X.number_token(F.get(tok, F.lit(i))).alias(n) for n, i in columns.items()]))
    return lines.where(F.col("line").rlike(band)).select(
        *keys, "label", F.regexp_extract("line", band, 1).alias("pd_band"), F.inline(F.array(cells)))


def _metric_rows(rows: DataFrame, keys: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """PD and LGD cells as rows, each with its verdict."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric_name"), (F.col(m) / 100).alias("value"), F.lit(hi).alias("hi"))
                      for m, hi in (("pd", V.METRIC_CEILINGS["pd"]), ("lgd", V.METRIC_CEILINGS["lgd"]))])
    long = rows.withColumn("c", F.explode(cells))
    reason = checks.verdict((F.col("label").isNull(), "no_portfolio"), *checks.range_rules(F.col("c.value"), F.col("c.hi")))
    return long.select(
        *keys, F.col("label").alias("asset_class"), F.col("c.metric_name").alias("metric_name"), F.col("c.value").alias("value"),
        "pd_band", *extra, reason.alias("dropped"))


def bank_patterns(bank: str) -> tuple[tuple[str, str], ...]:
    return (*V.BANK_BAND_PORTFOLIOS[bank], *V.BAND_TABLE_PORTFOLIOS)


def band_rows(pages: DataFrame, patterns: Sequence[tuple[str, str]] = V.BAND_TABLE_PORTFOLIOS,
              index_prefix: str | None = None) -> DataFrame:
    """The accepted rows of ``band_verdicts``."""
    return checks.accepted(band_verdicts(pages, patterns, index_prefix))


def band_verdicts(pages: DataFrame, patterns: Sequence[tuple[str, str]] = V.BAND_TABLE_PORTFOLIOS,
                  index_prefix: str | None = None) -> DataFrame:
    """PD-band table rows of every page that carries the table header, with what is dropped and why.

    Text after the next table header on the page is not read. The fifth token
    after the band is the PD, the seventh the LGD, both in percent.
    """
    keys = [c for c in pages.columns if c != "text"]
    plain = X.once(pages, text=X.plain_text(F.col("text")))
    bodies = plain.where(F.col("text").rlike(TABLE_HEADER)).withColumn("text", F.regexp_replace("text", NEXT_TABLE, ""))
    lines = carried_lines(bodies, plain_lines(F.col("text")), portfolio_label(patterns, index_prefix))
    return _metric_rows(_band_cells(lines, keys, BAND, {"pd": 4, "lgd": 6}), keys)


def target_pages(pages: DataFrame, target: str) -> DataFrame:
    """Pages of the banded table for one report date, continuation pages included.

    A header page decides by its dates; a later page of another date ends the
    run; other pages follow the page before. Pages that decide for themselves are
    read where they are. The undecided pages with a band line are written first, which is
    one cheap pass over the pages; only where there are some, (document, page, state) of
    their documents is sorted, sliced by page number so one huge document is not one
    sort, and their text joins what is kept.
    """
    pages = X.once(pages, text=X.plain_text(F.col("text")))
    dates = F.regexp_extract_all("text", F.lit(MACQUARIE_DATE), F.lit(1))
    hit = F.exists(dates, lambda d: F.lower(F.regexp_replace(d, r"\s+", " ")) == target.lower())
    header, other = F.col("text").rlike(MACQUARIE_HEADER), (F.size(dates) > 0) & ~hit
    banded = F.col("text").rlike(ANY_BAND)
    own = pages.where(F.when(header, banded & hit))
    open_ = staged(pages.where(F.when(header, F.lit(False)).otherwise(banded & ~F.coalesce(other, F.lit(False)))), "open-pages")
    if open_.isEmpty():
        return own
    marked = X.once(pages, _state=F.when(header, hit).when(other, F.lit(False))).select(
        "doc_id", "page_no", "_state", F.floor(F.col("page_no") / 1000).alias("_slice")).join(open_.select("doc_id").distinct(), "doc_id", "left_semi")
    local = W.partitionBy("doc_id", "_slice").orderBy("page_no").rowsBetween(W.unboundedPreceding, 0)
    lasts = marked.groupBy("doc_id", "_slice").agg(
        F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("page_no"))).alias("_end"))
    before = W.partitionBy("doc_id").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = lasts.withColumn("_carry", F.last("_end", True).over(before)).drop("_end")
    kept = (marked.withColumn("_here", F.last("_state", True).over(local)).join(carried, ["doc_id", "_slice"])
            .where(F.coalesce("_here", "_carry", F.lit(False))).select("doc_id", "page_no").distinct())
    return own.unionByName(open_.join(kept, ["doc_id", "page_no"]))


def split_percent_rows(pages: DataFrame, target: str,
                       patterns: Sequence[tuple[str, str]] = V.MACQUARIE_PORTFOLIOS) -> DataFrame:
    """The accepted rows of ``split_percent_verdicts``."""
    return checks.accepted(split_percent_verdicts(pages, target, patterns))


def split_percent_verdicts(pages: DataFrame, target: str,
                           patterns: Sequence[tuple[str, str]] = V.MACQUARIE_PORTFOLIOS) -> DataFrame:
    """Variant with detached percent signs and a default band broken over two lines; keeps the exposure."""
    keys = [c for c in pages.columns if c != "text"]
    joined = F.regexp_replace("text", r"(?m)^\s*100\.00 \(Non-\s*\n\s*Performing\)", "100.00 (Non-Performing)")
    bodies = target_pages(pages, target).withColumn("text", joined)

    def label(line: Column, i: Column, lines: Column) -> Column:
        return F.when(~line.rlike(MACQUARIE_BAND), X.contains_class(line, patterns))

    lines = carried_lines(bodies, plain_lines(F.col("text")), label)
    rows = _band_cells(lines, keys, MACQUARIE_BAND, {"pd": 4, "lgd": 6, "ead_mn": 3},
                       lambda rest: F.regexp_replace(rest, r"(\S+) %(?=\s|$)", "$1%"))
    return _metric_rows(rows, keys, ["ead_mn"])


def ead_weighted_portfolio(bands: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Exposure-weighted mean over performing bands; the plain mean where no band has exposure.

    Decimal sums keep the result independent of row order.
    """
    value, ead = F.col("value").cast("decimal(20,10)"), F.col("ead_mn").cast("decimal(18,4)")
    weighted = F.col("ead_mn") > 0
    out = bands.where(F.col("pd_band") != NON_PERFORMING).groupBy(*keys, "asset_class", "metric_name").agg(
        F.sum(F.when(weighted, (value * ead).cast("decimal(38,14)"))).alias("_num"), F.sum(F.when(weighted, ead)).alias("_den"),
        F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    mean = F.coalesce(F.try_divide(F.col("_num").cast("double"), F.col("_den").cast("double")), F.col("_sum").cast("double") / F.col("_n"))
    return out.select(*keys, "asset_class", "metric_name", F.round(mean, 8).alias("value"), F.lit("aggregate").alias("pd_band"))


def slotting_weights(pages: DataFrame, header: str = "CR10") -> DataFrame:
    """Prescribed risk weight of every slotting grade a page mentions."""
    keys = [c for c in pages.columns if c != "text"]
    pages = pages.withColumn("text", X.plain_text(F.col("text")))
    low = F.lower("text")
    grades = F.array_compact(F.array(*[
        F.when(low.contains(g.lower()), F.struct(F.lit(c).alias("asset_class"), F.lit(w).alias("value")))
        for g, c, w in V.SLOTTING_RISK_WEIGHTS]))
    return pages.where(F.col("text").contains(header)).select(*keys, F.explode(grades).alias("g")).select(
        *keys, "g.asset_class", F.lit("risk_weight").alias("metric_name"), "g.value", F.lit("all").alias("pd_band"))


def alias_band_rows(pages: DataFrame, source: str = "judo") -> DataFrame:
    """The accepted rows of ``alias_band_verdicts``."""
    return checks.accepted(alias_band_verdicts(pages, source))


def alias_band_verdicts(pages: DataFrame, source: str = "judo") -> DataFrame:
    """Banded PDs whose labels go through the alias map; PD capped at one."""
    keys = [c for c in pages.columns if c != "text"]

    def segment(textual: Column) -> Column:
        needle = X.let(F.lower(textual), lambda low: F.coalesce(*[
            F.when(low.contains(n), X.let(X.map_segment(source, F.lit(n)), lambda known: F.when(known.isNotNull(), F.concat_ws("|", known, F.lit(n)))))
            for n in V.JUDO_NEEDLES]))
        whole = X.let(X.map_segment(source, textual), lambda known: F.when(known.isNotNull(), F.concat_ws("|", known, textual)))
        return F.coalesce(needle, whole)

    def label(line: Column, i: Column, lines: Column) -> Column:
        return X.let(_prefix(line, None, LOOSE_BAND), lambda prefix: F.when(prefix != "", segment(prefix)))

    lines = carried_lines(pages, trimmed_lines(F.col("text")), label)
    rows = _band_cells(lines, keys, LOOSE_BAND, {"pd": 4}).select(
        *keys, F.split_part("label", F.lit("|"), F.lit(1)).alias("segment"), F.substring_index("label", "|", -1).alias("published_label"),
        F.regexp_replace("pd_band", r"\s+", " ").alias("pd_band"), (F.col("pd") / 100).alias("value"))
    reason = checks.verdict((F.col("segment").isNull(), "no_portfolio"), *checks.range_rules(F.col("value"), V.METRIC_CEILINGS["pd"]))
    return rows.withColumn("dropped", reason).withColumn("value", F.when(F.col("dropped").isNull(), F.least("value", F.lit(1.0))).otherwise(F.col("value")))
