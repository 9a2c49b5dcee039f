"""Listing pages: anchors, publication entries, link choice, capture records."""

from __future__ import annotations

import bisect
import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark import fixed_values as V
from tidemark.functions import text as X
from tidemark.functions.labels import first_match, lookup
from tidemark.session import stored

# comments, scripts and styles hold no text; then tags, text, and a stray "<"
_EVENT = re.compile(r"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>|<[!?][^>]*>|[^<]+|<")
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_HREF = re.compile(r"(?is)(?:^|[\s\"'])href" + _VALUE)
_DATETIME = re.compile(r"(?is)(?:^|[\s\"'])datetime" + _VALUE)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DATES = [re.compile(p) for p in X.DATE_SHAPES]


def _attribute(pattern: re.Pattern, tag: str) -> str | None:
    hit = pattern.search(tag)
    return None if hit is None else html.unescape(next(g for g in hit.groups() if g is not None)).strip()


def links_of(page: str) -> list[tuple[str, str, str, str]]:
    """Address, text, and the dates printed in the parent and in the grandparent of every link of a page.

    One fold over the page's tags with a stack of open elements. An end tag closes the
    nearest element of its name and all inside; without one it counts for nothing. A
    ``datetime`` counts as text of its ``<time>``. Elements are stretches of the page's
    text, so the dates inside one are found by bisection: of each shape the first.
    """
    parts: list[str] = []
    size = 0
    begin, end, parent = [], [], []  # of each element, its stretch of text and the element around it
    stack: list[tuple[str, int]] = []
    open_names: Counter = Counter()
    found: list[tuple[str, int]] = []

    def say(text: str) -> None:
        nonlocal size
        text = " ".join(html.unescape(text).split())
        if text:
            parts.append(text)
            size += len(text) + 1

    def close(name: str) -> None:
        while open_names[name]:
            top, element = stack.pop()
            open_names[top] -= 1
            end[element] = size
            if top == name:
                return

    for event in _EVENT.finditer(page):
        name = (event[3] or "").lower()
        if not name:
            if event[0] == "<" or not event[0].startswith("<"):
                say(event[0])
        elif event[2]:
            close(name)
        elif name not in _VOID:
            if name == "a":  # a link ends where the next begins
                close("a")
            element = len(begin)
            begin.append(size), end.append(size), parent.append(stack[-1][1] if stack else -1)
            stack.append((name, element))
            open_names[name] += 1
            if name == "a" and (href := _attribute(_HREF, event[4])) is not None:
                found.append((href, element))
            if name == "time":
                say(_attribute(_DATETIME, event[4]) or "")
            if event[4].endswith("/"):
                close(name)
    for _, element in stack:
        end[element] = size
    text = " ".join(parts)
    places = [[m.span() for m in shape.finditer(text)] for shape in _DATES] if found else []

    def dates(element: int) -> str:
        hits = []
        for spans in places if element >= 0 else []:
            at = bisect.bisect_left(spans, (begin[element], 0))
            if at < len(spans) and spans[at][1] <= end[element]:
                hits.append(text[slice(*spans[at])])
        return " | ".join(hits)

    return [(href, text[begin[e]:end[e]].strip(), dates(parent[e]), dates(parent[parent[e]] if parent[e] >= 0 else -1)) for href, e in found]


def anchors(pages: DataFrame) -> DataFrame:
    """Every link of every page: ``pos`` in the page, address, text, and the dates ``beside`` (its parent) and ``around`` (its grandparent)."""
    keys = [c for c in pages.columns if c != "html"]
    schema = T.StructType([*(pages.schema[c] for c in keys), *T._parse_datatype_string(
        "pos struct<link_no int>, href string, title string, beside string, around string").fields])
    names = schema.fieldNames()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, links = [], []
            for i, page in enumerate(batch.column("html").to_pylist()):
                own = links_of(page) if page else []
                rows.extend([i] * len(own))
                links.extend((n, *link) for n, link in enumerate(own))
            take = pa.array(rows, pa.int64())
            n, *columns = zip(*links) if links else [()] * 5
            pos = pa.StructArray.from_arrays([pa.array(n, pa.int32())], ["link_no"])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in keys), pos, *(pa.array(c, pa.string()) for c in columns)], names)

    return pages.select(*keys, X.plain_text(F.col("html")).alias("html")).mapInArrow(scan, schema)


@dataclass(frozen=True)
class Listing:
    """A publication listing: its page, its path prefix and the links to leave out."""

    source_key: str
    landing_url: str
    path_prefix: str
    landing_tails: tuple[str, ...] = ()


# --- fixed values: the two publication listings ---------------------------------------------

APRA_INSIGHT = Listing("apra_insight", "https://www.apra.gov.au/news-and-publications/apra-insight", "/news-and-publications/",
                       ("apra-insight", "news-and-publications"))
CFR_PUBLICATIONS = Listing("cfr_publications", "https://www.cfr.gov.au/publications/", "/publications/", ("publications",))


def listing_entries(pages: DataFrame, listing: Listing) -> DataFrame:
    """Publication entries: absolute URL, title, nearest date; first link of a URL wins.

    The date is the first inside the link, else in the element around it, else in the one around that.
    """
    site = "/".join(listing.landing_url.split("/")[:3])
    url = X.absolute_url(listing.landing_url, F.col("href"))
    rows = anchors(pages).withColumn("url", url).withColumn("path", X.url_path(F.col("url")))
    tail = F.element_at(F.split(F.regexp_replace("path", "/+$", ""), "/"), -1)
    keep = (
        F.col("url").startswith(site) & F.col("path").startswith(listing.path_prefix) & (F.col("title") != "")
        & (tail != "") & ~tail.isin(*listing.landing_tails)
        & (F.regexp_replace("url", "/+$", "") != listing.landing_url.rstrip("/")))
    dated = rows.where(keep).withColumn("published_date", F.coalesce(*(X.parse_mixed_date(F.col(c)) for c in ("title", "beside", "around"))))
    order = F.struct(*[c for c in pages.columns if c != "html"], "pos")
    return dated.groupBy("url").agg(
        F.min_by(F.struct("title", "published_date"), order).alias("first")).select(
        F.lit(listing.source_key).alias("source_key"), "first.title", "url", "first.published_date")


def new_publications(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries whose URL has not been captured, one per URL."""
    fresh = entries.join(manifest.select("url"), "url", "left_anti")
    rest = [c for c in fresh.columns if c != "url"]
    return fresh.groupBy("url").agg(F.min(F.struct(*rest)).alias("row")).select("url", "row.*")


def latest_issue(links: DataFrame, issue_pattern: str) -> DataFrame:
    """Newest issue per source: the pattern's two groups are year and month name."""
    year = F.regexp_extract("href", issue_pattern, 1).try_cast("int")
    month = X.month_number(F.regexp_extract("href", issue_pattern, 2)).cast("int")
    rows = links.where(F.col("href").rlike(issue_pattern)).withColumns({"year": year, "month": month}).where(F.col("month").isNotNull())
    best = F.struct("year", "month", "href")
    names = F.array(*[F.lit(m.capitalize()) for m in V.MONTHS])
    return rows.groupBy("source_key").agg(F.max(best).alias("b")).select(
        "source_key", "b.href", F.concat_ws(" ", F.get(names, F.col("b.month") - 1), F.col("b.year").cast("string")).alias("period"))


def download_pdf_links(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First PDF link per page whose text offers a download or chart pack."""
    text = F.lower("title")
    hit = F.lower("href").endswith(".pdf") & (text.contains("download pdf") | text.contains("chart pack"))
    return links.where(hit).groupBy(*keys).agg(F.min_by("href", "pos").alias("href"))


def glob_regex(glob: str) -> str:
    """A shell glob as an anchored regular expression, built once on the driver."""
    special = set(".^$+{}()[]|\\")
    body = "".join(".*" if c == "*" else "." if c == "?" else ("\\" + c if c in special else c) for c in glob.lower())
    return f"(?s)^{body}$"


@dataclass(frozen=True)
class LinkRule:
    """Tiered link choice of one target: glob first, then keyword and extension."""

    target: str
    glob: str
    keywords: tuple[str, ...]
    extension: str
    vetoes: tuple[str, ...] = ()


def tiered_link_match(links: DataFrame, rules: Sequence[LinkRule], keys: Sequence[str], page_url: Column) -> DataFrame:
    """First link per (page, target) in the best tier, joined to the page's address; vetoed links and links to no page never match.

    The rules are configuration and compile into one expression per link.
    """
    href, text = F.lower("href"), F.lower("title")
    tail = F.substring_index(F.element_at(F.split(href, "/"), -1), "?", 1)
    both, path = F.concat_ws(" ", text, href), X.url_path(href)

    def any_of(column: Column, words: Sequence[str]) -> Column:
        out = F.lit(False)
        for w in words:
            out = out | column.contains(w.lower())
        return out

    def tier(r: LinkRule) -> Column:
        pattern = glob_regex(r.glob)
        return first_match([
            (any_of(both, r.vetoes), F.lit(None).cast("int")),
            (tail.rlike(pattern) | text.rlike(pattern), F.lit(1)),
            (path.endswith(r.extension.lower()) & any_of(F.concat_ws(" ", text, path), r.keywords), F.lit(2))])

    hits = F.array(*[F.struct(F.lit(r.target).alias("target"), tier(r).alias("tier")) for r in rules])
    link = X.absolute_url(page_url, F.col("href"))
    return links.select(*keys, "pos", link.alias("link"), F.explode(hits).alias("h")).where(F.col("h.tier").isNotNull() & F.col("link").isNotNull()).groupBy(
        *keys, F.col("h.target").alias("target")).agg(
        F.min_by(F.struct("link", F.col("h.tier").alias("tier")), F.struct("h.tier", "pos")).alias("b")).select(
        *keys, "target", "b.link", F.when(F.col("b.tier") == 1, "primary-glob").otherwise("fallback-keywords").alias("matched_by"))


def capture_records(documents: DataFrame, retrieval_date: Column, publishers: dict[str, str]) -> DataFrame:
    """Captured-document records: publisher, landing page and resolved address, file name, content hash and period.

    ``documents`` has source_key, title, landing_url, href, published_date and content.
    """
    url = X.absolute_url(F.col("landing_url"), F.col("href"))
    return documents.withColumn("url", url).select(
        "source_key", lookup(F.col("source_key"), publishers).alias("publisher"), "title", F.col("landing_url"), "url", "published_date",
        F.concat(F.col("source_key"), F.lit("/"), X.publication_filename(F.col("url"), F.col("title"))).alias("local_path"),
        X.quarter_label(F.col("published_date")).alias("period"), retrieval_date.alias("retrieval_date"),
        F.sha2(F.col("content"), 256).alias("sha256"))


def capture_audit(records: DataFrame, actor: str = "system") -> DataFrame:
    """One audit row per captured document."""
    return records.select(
        F.lit("read_source_document").alias("operation"), F.col("source_key").alias("entity_id"),
        F.to_json(F.struct("url", F.col("retrieval_date").alias("retrieved_at"), F.col("sha256").alias("file_hash"),
                           F.col("local_path").alias("local_cached_file"), "period")).alias("params_json"),
        F.lit("captured").alias("result_summary"), F.lit(actor).alias("actor"), F.col("retrieval_date").cast("timestamp").alias("timestamp"))


# --- manifest of captures ----------------------------------------------------------------------

#: Folders that a manifest is spread over by a hash of the URL.
MANIFEST_BUCKETS = 64


def _url_bucket() -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(MANIFEST_BUCKETS)).cast("int")


def manifest_append(records: DataFrame, path: str, batch_id: int) -> None:
    """Merge captures into a manifest by URL: the first capture of a URL stays, whatever comes later.

    Stored by batch and hash of the URL: a batch reads only the buckets of its own URLs, and overwrites only
    its own folder, so a batch that is tried again leaves what one try would have left.
    """
    spark = records.sparkSession
    schema = T.StructType([*records.schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("bucket", T.IntegerType())])
    mine = records.where("url IS NOT NULL").withColumn("bucket", _url_bucket())
    buckets = [r.bucket for r in mine.select("bucket").distinct().collect()]  # MANIFEST_BUCKETS numbers at most
    held = stored(spark, path, schema).where(F.col("bucket").isin(*buckets) & (F.col("batch_id") != batch_id)).select("bucket", "url")
    rest = [c for c in records.columns if c != "url"]
    first = mine.groupBy("bucket", "url").agg(F.min(F.struct(*rest)).alias("row"))
    fresh = first.join(held, ["bucket", "url"], "left_anti").select(*(F.col("url") if c == "url" else F.col(f"row.{c}") for c in records.columns), "bucket")
    fresh.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch_id={batch_id}")


def manifest_items(spark: SparkSession, path: str, schema: T.StructType, source_key: str | None = None) -> DataFrame:
    """The captures of a manifest, newest publication first, then by title from the end; undated ones last."""
    items = stored(spark, path, schema)
    items = items if source_key is None else items.where(F.col("source_key") == source_key)
    return items.orderBy(F.col("published_date").desc_nulls_last(), F.col("title").desc_nulls_last(), F.col("url").desc())
