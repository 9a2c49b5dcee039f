"""Main text of web pages: the maximum-scoring stretch of words and tags.

A page is read once into runs of text and tags, with the open elements kept as a
stack. Words score positive and tags negative; one linear scan finds the contiguous
stretch with the highest sum. The weights come from labelled pages, those that mark
their content with <article> or <main>: how often words under an element, and tags
themselves, lie inside and outside that mark. Text of elements that never hold
content (scripts, menus, forms, notices, adverts, comments and so on, by name, role,
class or learned weight) is left out wherever it lies. Inside <article> and <main>
a block element goes if one whole name of its class or id is that of a known block
(sidebar, comment-thread, site_footer), or its role is; names that only hold such a word
(related-work) and ambiguous ones (search, social) count for nothing. Elsewhere a key
that labelled pages mostly have inside their mark overrules its words. A form or fieldset
that holds <article>, <main> or most of the words of the page is a wrapper. Marks of content within content,
or one after the other, are no border.

Weights are learned from at most SAMPLE pages, the first by a hash of page_id;
all pages are then extracted whole, in one pass.

Defined cases: a null or empty page, or one without words, has an empty text; broken
or cut markup is read as far as it goes, a tag that is cut off is no text; character
references are decoded once; repeated rows give repeated rows; other columns are
not read; without labelled pages the default weights hold.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that are read to learn weights, at most.
SAMPLE = 5_000
#: Score of a tag that marks content within or beside content.
WITHIN = -0.4
#: Element keys whose weights are kept, most frequent first.
KEYS = 5_000

RAW = "script style noscript template textarea iframe svg math select object canvas audio video"
_RAW = frozenset(RAW.split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup
    time tt u var wbr""".split())
_NEVER = frozenset("nav footer aside form button dialog head title menu option fieldset".split()) | _RAW
_CONTENT = frozenset(("article", "main"))
#: Words of class, id or role values that mark what is not content.
_HINTS = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert
    popup modal overlay sidebar nav navbar navigation menu breadcrumb breadcrumbs footer header masthead comment comments discussion disqus respond reply replies
    share sharing social related recommended newsletter subscribe subscription signup login search toolbar pagination pager widget copyright
    contentinfo complementary hidden""".split())
#: Whole class names of blocks that are no content even inside <article> or <main>, and whole roles.
_BLOCKS = frozenset("""ad ads ad-slot ad-banner ad-container ad-unit ad-wrapper adsbygoogle advert adverts advertisement cookie-notice cookie-banner
    cookie-consent share-buttons share-bar social-share sharedaddy related-posts related-articles newsletter-signup newsletter-form breadcrumb breadcrumbs
    pagination comment comments comment-body comment-list comments-area disqus navbar""".split())
_ROLES = frozenset("navigation search dialog alertdialog complementary contentinfo".split())
#: Words that name such a block by themselves or in one name with words of the next set and of _HINTS: "comment-thread", "site_footer".
_SURE = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr sidebar nav navbar menu breadcrumb breadcrumbs
    footer comment comments disqus newsletter pagination pager""".split())
_FILL = frozenset("""area bar block body bottom box button buttons container count entry form group holder inner item items left link links list module outer page panel
    post primary right row secondary section site slot strip thread threads title top unit wrap wrapper zone""".split())
#: Elements whose class or id names such a block inside content; headings and inline elements never do.
_PLACES = frozenset("div section aside ul ol li dl table p center details figure".split())
_PHRASES = frozenset("span code em strong b i a td th h1 h2 h3 h4 h5 h6".split())
#: Words that, without one of the above, mark content inside a wrapper that was taken for something else.
_LIKELY = frozenset("content article post entry story main maincontent body text".split())
_CLOSES_P = frozenset("""address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(?P<cut>/?[A-Za-z][^>]*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PARTS = re.compile(r"[a-z]+|\d+")


class Element:
    """An open element: its name, its key for weights, and whether its text is left out."""

    __slots__ = ("name", "key", "out", "content", "inner", "apart")

    def __init__(self, name: str, key: str, out: int, parent: Element | None):
        # out: 0 no, 1 by a mark that content inside may lift, 2 by its name
        self.name, self.key, self.out = name, key, out
        # inner: within content; apart: within what is left out
        self.inner, self.apart = bool(parent and parent.content), bool(parent and parent.out)
        self.content = name in _CONTENT or self.inner


class Outline:
    """Words before each token of a page, ends of its forms and starts of its content marks."""

    def __init__(self, html: str):
        self.places, self.words, self.marks = [0], [0], []
        self.ends: dict[str, list[int]] = {"form": [], "fieldset": []}
        at, end = 0, len(html)
        while at < end:
            found = _TOKEN.search(html, at)
            stop = found.start() if found else end
            self.places.append(stop)
            self.words.append(self.words[-1] + len(html[at:stop].split()))
            if not found:
                break
            at, name = found.end(), (found["name"] or "").lower()
            if found["close"]:
                if name in self.ends:
                    self.ends[name].append(found.start())
            elif name in _CONTENT:
                self.marks.append(found.start())
            elif name in _RAW:
                at = _raw_end(html, name, at)

    def is_wrapper(self, name: str, at: int) -> bool:
        """Whether the form or fieldset that opens at a place holds a content mark or most of the words."""
        ends = self.ends[name]
        i = bisect_left(ends, at)
        end = ends[i] if i < len(ends) else self.places[-1]
        if bisect_left(self.marks, at) < bisect_left(self.marks, end):
            return True
        before, upto = (self.words[bisect_right(self.places, x) - 1] for x in (at, end))
        return 2 * (upto - before) > self.words[-1]


def _raw_end(html: str, name: str, at: int) -> int:
    closing = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(html, at)
    return closing.end() if closing else len(html)


def _names_block(name: str) -> bool:
    """Whether a whole class or id name is that of a known block."""
    parts = [w for w in _PARTS.findall(name) if not w.isdigit()]
    return not _SURE.isdisjoint(parts) and all(w in _SURE or w in _FILL or w in _HINTS for w in parts)


def _marks(attrs: str) -> tuple[list[str], bool, bool, bool]:
    """Class, id and role words of a tag in order, whether it is hidden, whether it is a known block by an exact class name or role, and by any whole name."""
    if not attrs or "=" not in attrs and "hidden" not in attrs.lower():
        return [], False, False, False
    words, hidden, block, named = [], False, False, False
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name == "hidden" or name == "aria-hidden":
            hidden |= name == "hidden" or value == "true"
        else:
            words += _PARTS.findall(value)
            if name != "id":
                block |= not (_BLOCKS if name == "class" else _ROLES).isdisjoint(value.split())
            if name != "role":
                named |= any(map(_names_block, value.split()))
    return list(dict.fromkeys(w for w in words if not w.isdigit())), hidden, block, named


def _left_out(name: str, marks: list[str], hidden: bool, block: bool, named: bool, parent: Element | None, wrapper: bool, lifted: bool) -> int:
    """Whether text of a new element is left out, as Element.out has it."""
    above = parent.out if parent else 0
    if above == 2 or hidden or name in _NEVER and not wrapper:
        return 2
    if parent and parent.content:
        known = block and name not in _PHRASES or named and name in _PLACES
        return 1 if known else 0 if name in _CONTENT else above
    if name in _CONTENT:
        return 1 if block else 0
    if name == "header":
        return 2
    if not lifted and _HINTS.intersection(marks) and name not in ("html", "body"):
        return 0 if wrapper else 1
    return 0 if lifted or not _LIKELY.isdisjoint(marks) else above


def units(html: str, lifted: frozenset[str] = frozenset()) -> Iterator[tuple[str, str, Element | None, str]]:
    """(kind, value, element, key) in page order: kind "text" with its parent, or "tag", "inline" with the tag's element and key.

    Text of raw elements is not given at all.
    """
    stack: list[Element] = []
    outline = None
    at, end = 0, len(html)
    while at < end:
        found = _TOKEN.search(html, at)
        if not found:
            yield "text", html[at:], stack[-1] if stack else None, ""
            return
        if found.start() > at:
            yield "text", html[at:found.start()], stack[-1] if stack else None, ""
        at = found.end()
        name = found["name"]
        if name is None:
            continue
        name = name.lower()
        if found["close"]:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == name:
                    closed = stack[depth]
                    del stack[depth:]
                    yield "inline" if name in _INLINE else "tag", name, closed, "/" + closed.key
                    break
            else:
                yield "inline" if name in _INLINE else "tag", name, None, "/" + name
            continue
        marks, hidden, block, named = _marks(found["attrs"])
        key = ".".join([name, *marks])
        if name in _CLOSES_P:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].name == "p":
                    del stack[depth:]
                    break
                if stack[depth].name not in _INLINE:
                    break
        parent = stack[-1] if stack else None
        wrapper = False
        if name == "form" or name == "fieldset":
            outline = outline or Outline(html)
            wrapper = outline.is_wrapper(name, found.start())
        element = Element(name, key, _left_out(name, marks, hidden, block, named, parent, wrapper, key in lifted), parent)
        yield "inline" if name in _INLINE else "tag", name, element, key
        if name in _RAW:
            at = _raw_end(html, name, at)
        elif name not in _VOID and not found["attrs"].rstrip().endswith("/"):
            stack.append(element)


class Weights:
    """Score of a word under an element, and of a tag, by key; keys that are content whatever their words."""

    def __init__(self, words: dict[str, float], tags: dict[str, float], lifted: frozenset[str] = frozenset()):
        self.words, self.tags, self.lifted = words, tags, lifted

    def word(self, key: str) -> float:
        return self.words.get(key, self.words.get(key.split(".")[0], 1.0))

    def tag(self, key: str) -> float:
        return self.tags.get(key, self.tags.get(key.split(".")[0], -0.1 if key.lstrip("/").split(".")[0] in _INLINE else -0.4))


def main_text(html: str | None, weights: Weights) -> str:
    """Whole text of the best stretch, blocks joined by one space."""
    if not html:
        return ""
    scores, texts, plain, left = [], [], False, None
    for kind, value, element, key in units(html, weights.lifted):
        if kind == "text":
            if element is not None and element.out:
                continue
            text = unescape(value) if "&" in value else value
            n = len(text.split())
            score = n * weights.word(element.key if element else "")
            scores.append(score)
            texts.append(text)
            plain |= score > 0
        else:
            scores.append(-0.1 if element is not None and element.out else weights.tag(key))
            if value in _CONTENT and element is not None and not element.out:
                if element.inner:
                    scores[-1] = WITHIN
                elif not element.apart:  # from one mark to the next there is no border
                    if key.startswith("/"):
                        left = len(scores) - 1
                    elif left is not None:
                        scores[left] = scores[-1] = WITHIN
            texts.append("" if kind == "inline" else " ")
    if not plain:
        return ""
    best, first, last, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, first, last = total, start, i + 1
    return " ".join("".join(texts[first:last]).split())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and tags by key, inside and outside the content mark of labelled pages."""
    sums: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    for batch in batches:
        for html in batch.column("html").to_pylist():
            if not html or "<article" not in html and "<main" not in html:
                continue
            inside = False
            for kind, value, element, key in units(html):
                if kind == "text":
                    n = len(value.split())
                    if n and element is not None and not element.out:
                        sums[element.key][0 if element.content else 1] += n
                else:
                    if value in _CONTENT:
                        inside = not key.startswith("/") or bool(element and element.inner)
                        continue
                    if element is not None and element.out and (element.out == 2 or _HINTS.isdisjoint(element.key.split(".")[1:])):
                        continue
                    sums[key][2 if inside else 3] += 1
    keys = list(sums)
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([sums[k][i] for k in keys], pa.int64()) for i in range(4))],
                                     ["key", "words_in", "words_out", "tags_in", "tags_out"])


def learn(pages: DataFrame) -> Weights:
    """Weights from a bounded sample of pages: log odds of lying inside, words at most 1 and tags at most -0.1."""
    chosen = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(SAMPLE)
    sample = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").select("html")
    found = sample.mapInArrow(_counts, "key string, words_in long, words_out long, tags_in long, tags_out long").groupBy("key").agg(
        *(F.sum(c).alias(c) for c in ("words_in", "words_out", "tags_in", "tags_out")))
    rows = found.orderBy(F.desc(F.col("words_in") + F.col("words_out") + F.col("tags_in") + F.col("tags_out")), "key").limit(KEYS).collect()
    words, tags, lifted = {"": 0.2, "body": 0.2}, {}, set()
    for r in rows:
        if r.words_in + r.words_out >= 20:
            words[r.key] = max(-2.0, min(1.0, math.log((r.words_in + 1) / (r.words_out + 1))))
        if r.tags_in + r.tags_out >= 20:
            tags[r.key] = -max(0.1, min(5.0, math.log((r.tags_out + 1) / (r.tags_in + 1))))
            if r.tags_in > r.tags_out and not _HINTS.isdisjoint(r.key.split(".")[1:]):
                lifted.add(r.key)
    for mark in _CONTENT:
        tags[mark] = tags["/" + mark] = -20.0
    return Weights(words, tags, frozenset(lifted))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    weights = learn(pages)
    schema = T.StructType([pages.schema["page_id"], pages.schema["url"], T.StructField("text", T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, weights) for html in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    return pages.select("page_id", "url", "html").mapInArrow(scan, schema).withColumn("n_chars", F.length("text").cast("long"))
