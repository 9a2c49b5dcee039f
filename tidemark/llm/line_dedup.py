"""Deduplication of repeated runs of lines and of words, by winnowing over their hashes.

A line is a stretch between line feeds; it is compared without its outer white
space, and lines without a word are not compared at all. A run of lines counts
when it has at least MIN_WORDS words. A later copy of a run loses those lines.

1. A window is a shortest stretch of consecutive lines with MIN_WORDS words. The
   line with the smallest hash in each window is an anchor. Any repeated run holds
   a whole window, so its copies are guaranteed to share an anchor.
2. Anchors are counted over the corpus. Those found once (most) are done.
3. Around each repeated anchor the match is extended both ways, to the windows
   that hold the anchor, shortest from the left and from the right; windows of
   equal content are joined on their hash with the first place of that content.
   Longer runs are unions of such windows.
4. Every window that is not the first of its content marks its lines; a document
   drops its marked lines and keeps the rest, byte for byte.

5. Runs of RUN_WORDS words are found wherever they lie, inside a line or across line
   ends, by the same means over words: each window of RUN_WORDS words has one anchor,
   its smallest hash of GRAM words. Bare anchors are counted first; only those found
   twice or more are looked up again in the texts, with the windows they anchor. These
   follow each other, and their union is one content, of which the first place stays.
   Where the unions of an anchor differ, as at the ends of a run, each window of their
   first places is compared by itself, so a run is known to the word. Every later window
   marks its words; of places in one text that overlap, the first stays whole. A
   line all of whose words are marked goes like a marked line, others lose the marked
   words. Steps 1 to 4 run for runs of lines with fewer words than that (``min_words``
   below ``run_words``); any other run of lines is a run of words.

Places are ordered by doc_id, then line or word. Nothing is paired within a group: each
place meets only the first one, so a passage in a third of all texts is a grouped
minimum and a join with one row on its other side.

Words are compared without the white space between them.

Defined cases: a null text stays null, an empty one empty; a text all of whose
lines are marked becomes empty and its row stays; rows that repeat doc_id and text
are treated as one document and stay alike; a null doc_id comes after all others;
other columns pass through unchanged; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.llm.joins import BROADCAST_ROWS
from tidemark.session import discard, staged

#: Fewest words of a run that counts as a repeated passage.
MIN_WORDS = 20
#: Words of a window that counts as repeated wherever it lies, and of the stretch that anchors it.
RUN_WORDS = 20
GRAM = 5

_NOT_FEED = np.arange(256) != 10


def windows_from(words: np.ndarray, need: int) -> np.ndarray:
    """End (exclusive) of the shortest stretch from each line with ``need`` words, or -1."""
    totals = np.r_[0, np.cumsum(words)]
    ends = np.searchsorted(totals, totals[:-1] + need)
    return np.where(ends > len(words), -1, ends)


def anchors_of(hashes: np.ndarray, words: np.ndarray, need: int) -> list[int]:
    """Positions of the smallest hash of each window, last of equals.

    One pass with a queue of rising hashes, as window ends never go back.
    """
    ends = windows_from(words, need)
    chosen, queue, head, upto = [], [], 0, 0
    for start, end in enumerate(ends.tolist()):
        if end < 0:
            break
        while upto < end:
            while len(queue) > head and hashes[queue[-1]] >= hashes[upto]:
                queue.pop()
            queue.append(upto)
            upto += 1
        while queue[head] < start:
            head += 1
        if not chosen or chosen[-1] != queue[head]:
            chosen.append(queue[head])
    return chosen


def _line_table(documents: DataFrame, need: int) -> DataFrame:
    """Per text its comparable lines: place among all lines, hash, words, and which are anchors."""
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = T.StructType([keyed.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_lines", T.LongType()),
                           T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("hashes", T.ArrayType(T.LongType())),
                           T.StructField("words", T.ArrayType(T.IntegerType())), T.StructField("anchors", T.ArrayType(T.IntegerType()))])
    names = schema.fieldNames()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text")):
                n = p.last - p.first
                starts, ends, rows = B.spans(p.data, p.offsets, _NOT_FEED)
                feeds = np.r_[0, np.cumsum(p.data == 10)]
                word_starts, word_ends, _ = B.spans(p.data, p.offsets, B.SPACED)
                low, high = np.searchsorted(word_starts, starts), np.searchsorted(word_starts, ends)
                real = high > low
                low, high, rows, starts = low[real], high[real], rows[real], starts[real]
                # from the first word to the last: outer white space does not count
                hashes = B.span_hashes(p.data, word_starts[low], word_ends[high - 1]) if len(low) else np.zeros(0, np.uint64)
                words = (high - low).astype(np.int32)
                places = (feeds[starts] - feeds[p.offsets[:-1]][rows]).astype(np.int32)
                bounds = B.row_bounds(rows, n)
                marks, sizes = [], [0]
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = anchors_of(hashes[a:b], words[a:b], need) if b > a else []
                    marks.extend(own)
                    sizes.append(len(marks))
                n_lines = np.diff(feeds[p.offsets]) + (np.diff(p.offsets) > 0)
                part = batch.slice(p.first, n)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(n_lines.astype(np.int64)), B.list_array(places, bounds),
                     B.list_array(hashes.view(np.int64), bounds), B.list_array(words, bounds),
                     B.list_array(np.array(marks, np.int32), np.array(sizes))], names)

    return keyed.mapInArrow(scan, schema)


def _around(batches: Iterator[pa.RecordBatch], need: int) -> Iterator[pa.RecordBatch]:
    """Windows that hold a repeated anchor: content hash, first and last line place."""
    for batch in batches:
        out: dict[str, list] = {"row": [], "content": [], "start": [], "end": []}
        for i in range(batch.num_rows):
            words = np.array(batch.column("words")[i].as_py(), np.int64)
            hashes = np.array(batch.column("hashes")[i].as_py(), np.int64).view(np.uint64)
            hit = np.zeros(len(words) + 1, np.int64)
            hit[np.array(batch.column("hit")[i].as_py()) + 1] = 1
            hits = np.cumsum(hit)
            ahead = windows_from(words, need)
            behind = windows_from(words[::-1], need)[::-1]
            starts = np.r_[np.flatnonzero(ahead >= 0), len(words) - behind[behind >= 0]]
            ends = np.r_[ahead[ahead >= 0], np.flatnonzero(behind >= 0) + 1]
            both = np.unique(np.stack([starts, ends], 1), axis=0)
            both = both[hits[both[:, 1]] > hits[both[:, 0]]]
            for a, b in both.tolist():
                turn = B.mix(hashes[a:b] + np.arange(b - a, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                out["row"].append(i)
                out["content"].append(turn.sum(dtype=np.uint64))
                out["start"].append(a)
                out["end"].append(b)
        take = pa.array(out["row"], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(take), batch.column("text_key").take(take), pa.array(np.array(out["content"], np.uint64).view(np.int64)),
             pa.array(out["start"], pa.int32()), pa.array(out["end"], pa.int32())], ["doc_id", "text_key", "content", "start", "end"])


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, n_lines, removed): places of the lines that repeat an earlier run, for every text that has some."""
    lines = staged(_line_table(documents, min_words), "lines")
    anchors = lines.where(F.size("anchors") > 0).select("doc_id", "text_key", "hashes", F.explode("anchors").alias("at")).select(
        "doc_id", "text_key", "at", F.element_at("hashes", F.col("at") + 1).alias("anchor"))
    known = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    hits = anchors.join(known, "anchor", "left_semi").groupBy("doc_id", "text_key").agg(F.collect_set("at").alias("hit")).alias("h")
    near = lines.alias("l").join(hits, _same("l", "h")).select("l.doc_id", "l.text_key", "words", "hashes", "hit")
    schema = T.StructType([documents.schema["doc_id"], *T._parse_datatype_string("text_key long, content long, start int, end int").fields])
    found = staged(near.mapInArrow(lambda batches: _around(batches, min_words), schema), "windows")
    place = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "text_key", "start")
    first = found.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("content", "first")
    later = found.join(first, "content").where(place != F.col("first")).select("doc_id", "text_key", F.explode(F.sequence("start", F.col("end") - 1)).alias("i"))
    marked = later.groupBy("doc_id", "text_key").agg(F.collect_set("i").alias("marked")).alias("m")
    marked_lines = lines.alias("l").join(marked, _same("l", "m")).select(
        "l.doc_id", "l.text_key", F.array_sort(F.transform("marked", lambda i: F.element_at("places", i + 1))).alias("removed"))
    return marked_lines.dropDuplicates(["doc_id", "text_key"])  # rows that repeat doc_id and text have one entry


def anchor_places(words: np.ndarray, bounds: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of every anchor, and the first and last word of the windows it anchors.

    Rows are stretches of ``words``; all places count from the first word of all. A window's
    anchor is its smallest hash of ``GRAM`` words by the upper half, the last of equals. The
    lower half of what is compared holds the place, so minima of twice the length are made
    of two minima until the window is covered.
    """
    gram = min(GRAM, run)
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    n = len(words) - run + 1
    starts = np.flatnonzero(rows[:n] == rows[run - 1:]) if n > 0 else np.zeros(0, np.int64)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for i in range(gram):
        grams += words[i:i + len(grams)] * B._ROLL[i]
    grams = B.mix(grams)
    least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(0xFFFFFFFF, 0xFFFFFFFF - len(grams), -1, dtype=np.uint64)
    width, size = run - gram + 1, 1
    while size < width:
        step = min(size, width - size)
        least = np.minimum(least[:-step], least[step:])
        size += step
    at = 0xFFFFFFFF - (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (rows[starts[1:]] != rows[starts[:-1]])
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(starts)] - 1
    return grams[at[first]], at[first], starts[first], starts[last]


def _content(words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words from ``begin`` to before ``end``, before it is mixed."""
    powers, inverses = B._power_tables(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[:len(words)], out=sums[1:])
    return (sums[end] - sums[begin]) * inverses[begin]


def _words_of(piece: B.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and word bounds of the rows."""
    starts, ends, rows = B.spans(piece.data, piece.offsets, B.SPACED)
    return B.span_hashes(piece.data, starts, ends), starts, ends, B.row_bounds(rows, piece.last - piece.first)


def _anchor_counts(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Anchors of each piece of a batch, and how often they stand there."""
    for batch in batches:
        for p in B.pieces(batch.column("text")):
            words, _, _, bounds = _words_of(p)
            anchors, counts = np.unique(anchor_places(words, bounds, run)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors.view(np.int64)), pa.array(counts)], ["anchor", "n"])


def _anchored(documents: DataFrame, run: int, probe: np.ndarray | None) -> DataFrame:
    """One row per anchor, of those in the sorted ``probe`` if one is given: first and last window start, hash of the union of the windows."""
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = T.StructType([keyed.schema["doc_id"], *T._parse_datatype_string("text_key long, anchor long, start int, last int, union long").fields])
    held = documents.sparkSession.sparkContext.broadcast(probe)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for p in B.pieces(batch.column("text")):
                words, _, _, bounds = _words_of(p)
                found = anchor_places(words, bounds, run)
                if known is not None:
                    wanted = known[np.minimum(np.searchsorted(known, found[0]), len(known) - 1)] == found[0] if len(known) else np.zeros(len(found[0]), bool)
                    found = tuple(c[wanted] for c in found)
                anchors, at, begin, last = found
                size = (last + run - begin).astype(np.uint64)
                # where the anchor lies within the union counts as well, as offsets of the windows are compared by it
                place = (at - begin).astype(np.uint64)
                union = B.mix(_content(words, begin, last + run) + size * np.uint64(0x9E3779B97F4A7C15) + B.mix(place + np.uint64(1)))
                row = np.searchsorted(bounds, begin, "right") - 1
                part, take = batch.slice(p.first, p.last - p.first), pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(take), part.column("text_key").take(take), pa.array(anchors.view(np.int64)),
                     pa.array((begin - bounds[row]).astype(np.int32)), pa.array((last - bounds[row]).astype(np.int32)), pa.array(union.view(np.int64))],
                    schema.fieldNames())

    return keyed.mapInArrow(scan, schema)


def _single_windows(batches: Iterator[pa.RecordBatch], run: int) -> Iterator[pa.RecordBatch]:
    """Each window of the anchors whose first windows are given: content hash and start."""
    for batch in batches:
        for p in B.pieces(batch.column("text")):
            words, _, _, bounds = _words_of(p)
            _, _, first, last = anchor_places(words, bounds, run)
            row = np.searchsorted(bounds, first, "right") - 1
            first, last = first - bounds[row], last - bounds[row]
            part = batch.slice(p.first, p.last - p.first)
            wanted = part.column("wanted")
            asked = np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
            take = np.isin((row << 32) + first, (asked << 32) + wanted.flatten().to_numpy())
            row, first, last = row[take], first[take], last[take]
            each = last - first + 1
            row = np.repeat(row, each)
            start = np.repeat(first, each) + np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            at = bounds[row] + start
            content = B.mix(_content(words, at, at + run)) if len(at) else np.zeros(0, np.uint64)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(rows), part.column("text_key").take(rows), pa.array(content.view(np.int64)),
                                              pa.array(start.astype(np.int32))], ["doc_id", "text_key", "content", "start"])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's stretches with those that meet made one, in order."""
    for batch in batches:
        spans = batch.column("spans")
        row = np.repeat(np.arange(len(spans)), spans.value_lengths().to_numpy())
        begin, end = (spans.flatten().field(n).to_numpy().astype(np.int64) for n in ("from", "to"))
        some = end > begin
        row, begin, end = row[some], begin[some], end[some]
        order = np.lexsort((begin, row))
        row, begin, end = row[order], begin[order], end[order]
        reach = np.maximum.accumulate((row << 32) + end)
        opens = np.ones(len(row), bool)
        opens[1:] = (row << 32)[1:] + begin[1:] > reach[:-1]
        first = np.flatnonzero(opens)
        stop = (reach & 0xFFFFFFFF)[np.r_[first[1:], len(row)] - 1] if len(first) else end
        flat = pa.StructArray.from_arrays([pa.array(begin[first].astype(np.int32)), pa.array(stop.astype(np.int32))], ["from", "to"])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), B.list_array(flat, B.row_bounds(row[first], len(spans)))],
                                         ["doc_id", "text_key", "spans"])


def _small(table: DataFrame, array: str, rows: int) -> DataFrame:
    """``table`` with a broadcast hint if the arrays it holds have few entries in all."""
    return F.broadcast(table) if (table.agg(F.sum(F.size(array) + 1)).first()[0] or 0) <= rows else table


def repeated_words(documents: DataFrame, run: int = RUN_WORDS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_key, spans): stretches of words (from, to) that repeat an earlier run, for every text that has some.

    At most ``broadcast_rows`` repeated anchors, or stretches, are sent to all tasks; more are joined by a shuffle.
    """
    counts = documents.select("text").mapInArrow(lambda batches: _anchor_counts(batches, run), "anchor long, n long")
    known = staged(counts.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "known")
    if known.limit(broadcast_rows + 1).count() <= broadcast_rows:
        hits = _anchored(documents, run, np.sort(known.toArrow()["anchor"].to_numpy().view(np.uint64)))
    else:
        hits = _anchored(documents, run, None).join(known, "anchor", "left_semi")
    hits = staged(hits, "hits")
    place = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "text_key", "start")
    # rows that repeat doc_id and text have the same places and so count once
    groups = staged(hits.groupBy("anchor", "union").agg(F.min(place).alias("first"), F.max(place).alias("end")), "groups")
    apart = groups.groupBy("anchor").agg(F.min("union").alias("low"), F.max("union").alias("high")).where("low <> high").select("anchor")

    def later(found: DataFrame, end: Column) -> DataFrame:
        """Words of places behind the first; in the first place's own text only what lies behind its first window."""
        own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
        start = F.when(own, F.greatest("start", F.col("first.start") + run)).otherwise(F.col("start"))
        return found.where(place != F.col("first")).select("doc_id", "text_key", F.struct(start.alias("from"), end.alias("to")).alias("span"))

    alike = later(hits.join(groups.where("first <> end").select("anchor", "union", "first"), ["anchor", "union"]), F.col("last") + run)
    mixed = staged(groups.join(apart, "anchor", "left_semi").groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.text_key").alias("text_key")).agg(
        F.collect_set("first.start").alias("wanted")), "mixed")
    near = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text").alias("d").join(
        _small(mixed, "wanted", broadcast_rows).alias("w"), _same("d", "w")).select("d.doc_id", "d.text_key", "text", "wanted")
    schema = T.StructType([documents.schema["doc_id"], *T._parse_datatype_string("text_key long, content long, start int").fields])
    single = staged(near.mapInArrow(lambda batches: _single_windows(batches, run), schema), "single")
    first = staged(single.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("end")).where("first <> end").select("content", "first"), "first")
    spans = alike.unionByName(later(single.join(first, "content"), F.col("start") + run)).groupBy("doc_id", "text_key").agg(F.collect_set("span").alias("spans"))
    marked = staged(spans.mapInArrow(_merged, spans.schema), "marked")
    discard(known, hits, groups, mixed, single, first)
    return _small(marked, "spans", broadcast_rows)


def _without(text: str, removed: list[int], spans: list[dict]) -> tuple[str, int]:
    """The text less the lines at the given places and the words in the given stretches, and how many lines went."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    starts, ends, _ = B.spans(raw, np.array([0, len(raw)]), B.SPACED)
    change = np.zeros(len(starts) + 1, np.int64)
    for span in spans:
        if span["to"] > span["from"]:
            change[span["from"]] += 1
            change[span["to"]] -= 1
    marked = np.cumsum(change[:-1]) > 0
    feeds = np.flatnonzero(raw == 10)
    first, last = np.r_[0, feeds + 1], np.r_[feeds, len(raw)]
    low, high = np.searchsorted(starts, first), np.searchsorted(starts, last)
    totals = np.r_[0, np.cumsum(marked)]
    n_marked = totals[high] - totals[low]
    gone = (n_marked > 0) & (n_marked == high - low)
    gone[removed] = True
    kept = []
    data = raw.tobytes()
    for i in np.flatnonzero(~gone).tolist():
        if not n_marked[i]:
            kept.append(data[first[i]:last[i]])
            continue
        own = marked[low[i]:high[i]].tolist()
        s, e = starts[low[i]:high[i]].tolist(), ends[low[i]:high[i]].tolist()
        parts, at = [], int(first[i])
        for j, out in enumerate(own):
            if out and not (j and own[j - 1]):
                stop = j
                while stop < len(own) and own[stop]:
                    stop += 1
                # a cut takes the white space behind it, at the end of the line that before it
                parts.append(data[at:s[j] if stop < len(own) else e[j - 1]])
                at = s[stop] if stop < len(own) else e[-1]
        parts.append(data[at:last[i]])
        kept.append(b"".join(parts))
    return b"\n".join(kept).decode("utf-8"), int(gone.sum())


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row, new text and number of lines that went; texts without marks pass as they are."""
    for batch in batches:
        texts, removed, spans = (batch.column(c) for c in ("text", "removed", "spans"))
        marked = pa.compute.or_(removed.is_valid(), spans.is_valid())
        counts = np.zeros(batch.num_rows, np.int64)
        fresh = []
        for i in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
            text, counts[i] = _without(texts[i].as_py(), removed[i].as_py() or [], spans[i].as_py() or [])
            fresh.append(text)
        cut = pa.compute.replace_with_mask(texts, marked, pa.array(fresh, texts.type)) if fresh else texts
        yield pa.RecordBatch.from_arrays([batch.column("row"), cut, pa.array(counts), batch.column("n_lines")],
                                         ["row", "text", "n_lines_removed", "n_lines"])


def _cleaned(documents: DataFrame, min_words: int, run_words: int) -> DataFrame:
    """(row, text, n_lines_removed, n_lines): the other columns of each input row as a struct, its new text, and its lines before."""
    texts = documents.select("doc_id", "text")
    words = repeated_words(texts, run_words)
    if min_words < run_words:
        lines, words = repeated_lines(texts, min_words).alias("m"), words.alias("n")
        own = F.col("m.text_key").isNotNull()
        marks = lines.join(words, _same("m", "n"), "full").select(
            F.when(own, F.col("m.doc_id")).otherwise(F.col("n.doc_id")).alias("doc_id"), F.coalesce("m.text_key", "n.text_key").alias("text_key"), "removed", "spans")
    else:  # a repeated run of lines is one of words
        marks = words.withColumn("removed", F.lit(None).cast("array<int>"))
    marks = marks.alias("m")
    rest = F.struct(*(F.col(f"`{c}`") for c in documents.columns if c != "text"))
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(feeds + 1).cast("long")
    rows = documents.select(rest.alias("row"), F.xxhash64("text").alias("text_key"), "doc_id", "text", n_lines.alias("n_lines")).alias("d")
    joined = rows.join(marks, _same("d", "m"), "left").select("row", "text", "removed", "spans", "n_lines")
    schema = T.StructType([joined.schema["row"], T.StructField("text", T.StringType()), T.StructField("n_lines_removed", T.LongType()), joined.schema["n_lines"]])
    return joined.mapInArrow(_cut, schema)


def drop_repeated_lines(documents: DataFrame, min_words: int = MIN_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """``documents`` with later copies of runs deleted from ``text`` and, where present, ``n_chars`` brought up to date."""
    cleaned = _cleaned(documents, min_words, run_words)
    length = F.coalesce(F.length("text"), F.lit(0))
    return cleaned.select(*(F.col("text") if c == "text" else length.cast(documents.schema[c].dataType).alias(c) if c == "n_chars"
                            else F.col(f"row.`{c}`").alias(c) for c in documents.columns))


def report(documents: DataFrame, min_words: int = MIN_WORDS, run_words: int = RUN_WORDS) -> DataFrame:
    """Per row: doc_id, n_lines before, n_lines_removed, and the new text."""
    return _cleaned(documents.select("doc_id", "text"), min_words, run_words).select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_lines_removed", "text")
