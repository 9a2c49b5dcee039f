"""Text parsing expressions: numbers, units, dates, slugs, table tokens.

All are built-in functions, so they run inside generated code on the executors.
Unparseable text gives null, never an error.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.labels import first_match, lookup

DASHES = ("-", "–", "—")
NULL_TOKENS = (*DASHES, "n/a", "na", "")


# --- patterns from plain phrases -------------------------------------------------------------

def words(phrase: str) -> str:
    """Pattern of a phrase with any white space between its words."""
    return r"\s+".join(re.escape(w) for w in phrase.split())


def led(pattern: str, *phrases: str) -> str:
    """``pattern``, tried only where one of the first letters of ``phrases`` stands, which each of its matches begins with.

    One look at a character is cheaper than an alternation that fails branch by branch.
    """
    return "(?=[" + "".join(re.escape(c) for c in sorted({p[0] for p in phrases})) + f"]){pattern}"


def any_of(*phrases: str) -> str:
    """Pattern of one of several phrases, longest first."""
    return "(?:" + led("(?:" + "|".join(words(p) for p in sorted(phrases, key=len, reverse=True)) + ")", *phrases) + ")"


# --- white space -------------------------------------------------------------------------------

_SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t\f\v\r"
_BREAKS = "\u0085\u2028\u2029"
_NOTHING = "".join(map(chr, range(1, 9))) + "\u000e\u000f\u200b\u2060\ufeff"


#: ASCII but for its printable characters and the line feed. Each is named by itself: a class of single characters below
#: 256 is one table, a range is a test of its own on every letter.
_CONTROLS = "[" + "".join(rf"\x{c:02x}" for c in (*range(10), *range(11, 32), 127)) + "]"


def plain_text(text: Column) -> Column:
    """Published text with one kind of space and of line end, and without control and zero-width characters.

    Text of printable ASCII and line feeds, which cheap scans tell, is that already; other text goes through one
    map of characters.
    """
    plain = F.translate(text, _SPACES + _BREAKS + _NOTHING, " " * len(_SPACES) + "\n" * len(_BREAKS))
    return F.when((F.length(text) != F.octet_length(text)) | text.rlike(_CONTROLS), plain).otherwise(text)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    For costly text expressions under long rule chains only: it leaves
    generated code, so plain columns should be used directly.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Costly columns, added or replaced: each is evaluated once a row, where it stands.

    They come out of a generator. A filter on a plain column would be moved below the projection, and below a
    shuffle under it, and the column's text be made a second time there, by as few tasks as read the files.
    """
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(F.struct(*[v.alias(n) for n, v in columns.items()]))))


def in_match(text: Column, pattern: str, body: Callable[[Column], Column]) -> Column:
    """Scan ``text`` once for ``pattern`` and work on the short match; null without one."""
    return let(F.regexp_extract(text, pattern, 0), lambda m: F.when(m != "", body(m)))


def number_token(token: Column) -> Column:
    """Number of a table cell: thousands commas and a trailing % are dropped."""
    t = F.replace(F.trim(token), F.lit(","), F.lit(""))
    return F.when(~F.lower(t).isin(*NULL_TOKENS), F.regexp_replace(t, "%+$", "").try_cast("double"))


def unit_decimal(number: Column, unit: Column) -> Column:
    """Number with a published unit -> decimal rate."""
    return let(F.lower(unit), lambda u: F.when(u.contains("bps") | u.contains("basis"), number / F.lit(10000.0))
               .when(u.contains("%"), number / F.lit(100.0)))


def coerce_metric_cell(bank: Column, industry: Column, token: Column, table_ref: Column | None = None) -> Column:
    """struct(value, redaction) of one industry-table cell.

    A dash is an honest zero only on the bank's government row or in a listed
    table; parentheses are dropped only as a pair.
    """
    government = F.coalesce(lookup(bank, V.GOVERNMENT_LABELS) == industry, F.lit(False))
    zero = government
    if table_ref is not None:
        for b, t in V.HONEST_ZERO_TABLES:
            zero = zero | ((bank == b) & F.coalesce(table_ref == t, F.lit(False)))
    plain = F.replace(token, F.lit(","), F.lit(""))
    inner = F.when(plain.startswith("(") & plain.endswith(")"), F.substring(plain, F.lit(2), F.length(plain) - 2)).otherwise(plain)
    value = F.when(token == "-", F.when(zero, F.lit(0.0))).otherwise(inner.try_cast("double"))
    return F.struct(value.alias("value"), F.when(value.isNull(), F.lit("published_as_dash")).alias("redaction"))


def label_class(label: Column) -> Column:
    """Portfolio label -> class by contained words; unknown labels become a slug."""
    s = F.lower(F.trim(label))

    def has(words: Sequence[str]) -> Column:
        cond = s.contains(words[0])
        for w in words[1:]:
            cond = cond | s.contains(w)
        return cond

    return first_match([(has(words), F.lit(klass)) for words, klass in V.TABLE_LABEL_CLASSES],
                       F.translate(s, " -", "__"))


def contains_class(label: Column, patterns: Sequence[tuple[str, str]]) -> Column:
    """First contained pattern wins; null when none is contained."""
    return let(F.lower(F.trim(label)), lambda s: first_match([(s.contains(p), F.lit(c)) for p, c in patterns]))


def map_segment(source: str, label: Column) -> Column:
    """Segment whose alias for ``source`` contains, or is contained in, the label."""
    aliases = [(alias.lower(), segment) for segment, sources in V.SEGMENT_ALIAS_MAP.items() for alias in sources.get(source, [])]
    if not aliases:
        return F.lit(None).cast("string")
    return let(F.lower(F.trim(label)), lambda s: F.when(s != "", first_match([
        (F.lit(alias).contains(s) | s.contains(alias), F.lit(segment)) for alias, segment in aliases])))


def band_slug(band: Column) -> Column:
    """PD band -> id slug; aggregate bands carry none."""
    s = F.translate(F.replace(F.replace(band, F.lit(" "), F.lit("_")), F.lit("<"), F.lit("lt")), "()", "")
    return F.when(F.lower(band) == "aggregate", F.lit("")).otherwise(F.upper(F.replace(s, F.lit("."), F.lit("p"))))


# --- dates ------------------------------------------------------------------------------

MONTH_NUMBERS = {name: f"{i:02d}" for i, name in enumerate(V.MONTHS, 1)}
SHORT_MONTH_NUMBERS = {**MONTH_NUMBERS, **{name[:3]: f"{i:02d}" for i, name in enumerate(V.MONTHS, 1)}, "sept": "09"}


def month_number(name: Column, short: bool = True) -> Column:
    return lookup(F.lower(name), SHORT_MONTH_NUMBERS if short else MONTH_NUMBERS)


def date_of(year: Column, month: Column, day: Column) -> Column:
    """Date from text parts, null when a part is missing or out of range."""
    y = F.when(F.length(year) == 2, F.concat(F.lit("20"), year)).otherwise(year)
    text = F.concat_ws("-", y, F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    parts = (F.length(y) == 4) & month.isNotNull() & (F.length(day) > 0)
    return F.when(parts, text.try_cast("date"))


def quarter_end_of(date: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(date, "quarter"), 2))


def quarter_end(text: Column) -> Column:
    """Date-like cell ("2004-06-15", "Jun 2004", "December 2025") -> its quarter end."""
    s = F.trim(text)
    iso = F.try_to_date(F.regexp_extract(s, r"^(\d{4}-\d{2}-\d{2})", 1), "yyyy-MM-dd")
    month_year = r"^([A-Za-z]{3,9})[ -](\d{4})$"
    named = date_of(F.regexp_extract(s, month_year, 2), month_number(F.regexp_extract(s, month_year, 1)), F.lit("01"))
    return quarter_end_of(F.coalesce(iso, named))


def fiscal_period_code(date: Column, year_end_month: int = 6) -> Column:
    """Fiscal code of a reporting date for a June or March year end.

    June: FY, H1FY, otherwise the calendar quarter. March: FY, H1FY, otherwise
    the fiscal quarter.
    """
    m, y = F.month(date), F.year(date)

    def code(prefix: str, year: Column) -> Column:
        return F.concat(F.lit(prefix), year.cast("string"))

    half = (year_end_month + 6 - 1) % 12 + 1
    if year_end_month == 6:
        other = F.concat(y.cast("string"), F.lit("Q"), F.quarter(date).cast("string"))
    else:
        fiscal_year = F.when(m <= year_end_month, y).otherwise(y + 1)
        quarter = F.floor(F.pmod(m - year_end_month - 1, F.lit(12)) / 3) + 1
        other = F.concat(F.lit("Q"), quarter.cast("string"), code("FY", fiscal_year))
    return F.when(m == year_end_month, code("FY", y)).when(m == half, code("H1FY", y + 1)).otherwise(other)


def exact_period_code(date: Column) -> Column:
    """June-year code that needs the exact half-year end, else year and month."""
    m, y, d = F.month(date), F.year(date), F.dayofmonth(date)
    fy = F.when(m <= 6, y).otherwise(y + 1).cast("string")
    return (
        F.when((m == 6) & (d == 30), F.concat(F.lit("FY"), y.cast("string")))
        .when((m == 12) & (d == 31), F.concat(F.lit("H1FY"), (y + 1).cast("string")))
        .otherwise(F.concat(F.lit("FY"), fy, F.lit("_M"), F.lpad(m.cast("string"), 2, "0")))
    )


# month names, and their usual three- and four-letter forms
_SHORT = [m[:3] for m in V.MONTHS] + ["sept"]
_MONTH = "|".join(sorted({*V.MONTHS, *_SHORT}, key=len, reverse=True))
_LONG = rf"(?i)\b(\d{{1,2}})\s+({_MONTH})\s+(20\d{{2}})\b"
_ISO = r"\b(20\d{2})-(\d{2})-(\d{2})\b"
_SLASH = r"\b(\d{1,2})/(\d{1,2})/(20\d{2})\b"

#: The shapes of a printed date, the first that is found counts before the next.
DATE_SHAPES = (_ISO, _LONG, _SLASH)


def parse_mixed_date(text: Column) -> Column:
    """First date in text: ISO, then day month year, then d/m/y."""
    def g(hit: Column, pattern: str, i: int) -> Column:
        return F.regexp_extract(hit, pattern, i)

    return F.coalesce(
        in_match(text, _ISO, lambda m: date_of(g(m, _ISO, 1), g(m, _ISO, 2), g(m, _ISO, 3))),
        in_match(text, _LONG, lambda m: date_of(g(m, _LONG, 3), month_number(g(m, _LONG, 2)), g(m, _LONG, 1))),
        in_match(text, _SLASH, lambda m: date_of(g(m, _SLASH, 3), g(m, _SLASH, 2), g(m, _SLASH, 1))),
    )


_NAMES = "|".join(V.MONTHS)


def month_end_in_text(text: Column) -> Column:
    """Index release month: "as of June 30, 2025", else "for June 2025"; month end."""
    dated = rf"(?i)(?:as\s+of|at)\s+({_NAMES})\s+\d{{1,2}},\s+(\d{{4}})"
    plain = rf"(?i)(?:in\s+|for\s+|[-–—]\s*)({_NAMES})\s+(\d{{4}})"

    def read(p: str) -> Column:
        return in_match(text, p, lambda m: date_of(
            F.regexp_extract(m, p, 2), month_number(F.regexp_extract(m, p, 1), False), F.lit("01")))

    return F.last_day(F.coalesce(read(dated), read(plain)))


_DMY = r"\s+(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})"


def _stated(text: Column, pattern: str) -> Column:
    """The date that a match ends in; no digit stands before it."""
    end = _DMY.removeprefix(r"\s+") + "$"
    return in_match(text, pattern, lambda m: date_of(
        F.regexp_extract(m, end, 3), month_number(F.regexp_extract(m, end, 2), False), F.regexp_extract(m, end, 1)))


def quarter_ended(text: Column, default: Column) -> Column:
    """Trading-update date: "quarter ended", then "as at"."""
    day = _DMY.removeprefix(r"\s+")
    leads = (words("quarter ended") + r"\s+", words("as at") + r"\s+|" + words("end of the quarter") + r"\s+\(\s*")
    return F.coalesce(*(_stated(text, f"(?i)(?:{lead}){day}") for lead in leads), default)


def half_year_end(text: Column, default: Column) -> Column:
    """June-year heading: 1H is the December before, 2H and FY end in June."""
    p = r"(?i)(1H|2H|FY)\s*(?:FY)?\s*(\d{2,4})"

    def end(m: Column) -> Column:
        raw = F.regexp_extract(m, p, 2).try_cast("int")
        year = F.when(raw < 100, raw + 2000).otherwise(raw)
        return F.when(F.upper(m).startswith("1H"), F.make_date(year - 1, F.lit(12), F.lit(31))).otherwise(
            F.make_date(year, F.lit(6), F.lit(30)))

    return F.coalesce(in_match(text, p, end), default)


def annual_period_end(text: Column, default: Column) -> Column:
    """Annual-report date: a stated day, else the June end of "FY25"."""
    stated = _stated(text, "(?i)" + any_of("as at", "year ended", "period ended", "reporting date") + _DMY)
    fy = r"(?i)\bFY\s*(\d{2,4})\b"

    def june(m: Column) -> Column:
        raw = F.regexp_extract(m, fy, 1).try_cast("int")
        return F.make_date(F.when(raw < 100, raw + 2000).otherwise(raw), F.lit(6), F.lit(30))

    return F.coalesce(stated, in_match(text, fy, june), default)


def cover_date(text: Column) -> Column:
    """Cover-page date of a banded disclosure."""
    return _stated(text, r"(?i)(?:as at|for the (?:quarter|half[- ]year|year) ended|reporting date|period ended)" + _DMY)


def page_as_of_date(text: Column, bank: str) -> Column:
    """Date printed on a bank's industry page; null where none is printed."""
    patterns = {
        "wbc": r"(?m)^\s*As at\s+(\d{1,2})\s+(\w+)\s+(\d{4})\s*$",
        "nab": r"(?m)^\s*As at\s+(\d{1,2})\s+(\w+)\s+(\d{2,4})\s*$",
        "cba": r"(?m)^\s*(\d{1,2})\s+(June|December|Jun|Dec)\s+(\d{4})\s*$",
    }
    if bank == "anz":
        p = r"(?m)^\s*Sep\s+(\d{2})\s*$"
        return in_match(text, p, lambda m: date_of(F.regexp_extract(m, p, 1), F.lit("09"), F.lit("30")))
    p = patterns[bank]
    return in_match(text, p, lambda m: date_of(
        F.regexp_extract(m, p, 3), month_number(F.regexp_extract(m, p, 2)), F.regexp_extract(m, p, 1)))


def year_quarter(period: Column) -> Column:
    """Publication period text ("March 2025") -> struct(year, quarter)."""
    p = rf"(?i)\b({_NAMES}|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec)\s+(\d{{4}})\b"
    month = month_number(F.regexp_extract(period, p, 1)).cast("int")
    return F.struct(F.regexp_extract(period, p, 2).try_cast("int").alias("year"),
                    F.ceil(month / 3).cast("int").alias("quarter"))


def quarter_label(date: Column) -> Column:
    """Report period label such as "Q2 2026"."""
    return F.format_string("Q%d %d", F.quarter(date), F.year(date))


def portfolio_size(text: Column) -> Column:
    """"loan portfolio of $2.4B" -> integer millions."""
    p = rf"(?i){words('loan portfolio')}\s+(?:{any_of('of', 'increased to', 'grew to')}\s+)?\$\s*(\d+(?:\.\d+)?)\s*(billion|million|B|M)"

    def millions(m: Column) -> Column:
        amount = F.regexp_extract(m, p, 1).try_cast("double")
        scale = F.when(F.lower(F.regexp_extract(m, p, 2)).startswith("b"), F.lit(1000.0)).otherwise(F.lit(1.0))
        return F.round(amount * scale).cast("int")

    return in_match(text, p, millions)


# --- URLs and titles -----------------------------------------------------------------------

#: Readable part of a file name; a longer text goes on with a digest of all of it.
SLUG_CHARS = 80


def safe_slug(text: Column, whole: Column | None = None) -> Column:
    """File-name form of a text. Where it has to be cut, 12 digits of the SHA-256 of ``whole`` (the text itself by default) keep names apart."""
    dashed = F.lower(F.regexp_replace(F.regexp_replace(text, "[^A-Za-z0-9]+", "-"), "^-+|-+$", ""))
    digest = F.substring(F.sha2(text if whole is None else whole, 256), 1, 12)
    return F.when(F.length(dashed) <= SLUG_CHARS, dashed).otherwise(F.concat_ws("-", F.substring(dashed, 1, SLUG_CHARS), digest))


def url_path(url: Column) -> Column:
    """Path of an absolute or rooted URL, without query or fragment."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")


def url_slug(url: Column) -> Column:
    """Slug of the last path part, without its extension."""
    tail = F.element_at(F.split(F.regexp_replace(url_path(url), "/+$", ""), "/"), -1)
    return safe_slug(F.regexp_replace(tail, r"\.[^.]*$", ""), url)


def url_suffix(url: Column) -> Column:
    return F.regexp_extract(F.lower(url_path(url)), r"(\.pdf|\.html|\.htm)$", 1)


def publication_filename(url: Column, title: Column) -> Column:
    slug = F.coalesce(F.nullif(url_slug(url), F.lit("")), F.nullif(safe_slug(title), F.lit("")), F.lit("item"))
    return F.concat(slug, F.coalesce(F.nullif(url_suffix(url), F.lit("")), F.lit(".pdf")))


def absolute_url(base: str | Column, href: Column) -> Column:
    """Join a link to the address of its page; null for mail, script and other links that are no pages."""
    page = F.lit(base) if isinstance(base, str) else base
    bare = F.regexp_replace(page, "[?#].*$", "")
    root = F.regexp_extract(page, "^[^:/?#]+://[^/?#]*", 0)
    path = F.regexp_replace(F.substr(bare, F.length(root) + 1), "[^/]*$", "")
    return (
        F.when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), href)
        .when(href.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(href.startswith("//"), F.concat(F.substring_index(page, "//", 1), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(page, "#.*$", ""), href))
        .otherwise(F.concat(root, F.when(path == "", "/").otherwise(path), href))
    )


# --- display -----------------------------------------------------------------------------------

def four_places(value: Column) -> Column:
    return F.coalesce(F.when(value.isNotNull(), F.format_string("%.4f", value)), F.lit(""))


def shown(value: Column, body: Column, blank: str = "-") -> Column:
    """A formatted value, or the mark that stands for none."""
    return F.when(value.isNull(), F.lit(blank)).otherwise(body)


def percent_places(value: Column, digits: int = 4, *, signed: bool = False) -> Column:
    """0.025 -> "2.5000%"; with ``signed`` a gain shows its plus."""
    plus = F.when(value > 0, F.lit("+")).otherwise(F.lit("")) if signed else F.lit("")
    return shown(value, F.concat(plus, F.format_string(f"%.{digits}f%%", value * 100)))


def basis_points(value: Column) -> Column:
    """Small rates in whole hundredths of a percent: 0.0014 -> "14 bps"."""
    return shown(value, F.concat(F.bround(value * 10_000).cast("long").cast("string"), F.lit(" bps")))


def times(value: Column) -> Column:
    """1.5 -> "1.50x"."""
    return shown(value, F.format_string("%.2fx", value))


def date_window(low: Column, high: Column) -> Column:
    """One date, or the first and the last; a window open at one end shows that end empty."""
    lo, hi = F.coalesce(low.cast("string"), F.lit("")), F.coalesce(high.cast("string"), F.lit(""))
    return F.when((lo == "") & (hi == ""), F.lit("-")).when(lo == hi, lo).otherwise(F.concat(lo, F.lit("–"), hi))
