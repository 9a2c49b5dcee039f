"""Quality classifier: interpolated modified Kneser-Ney n-gram models of trusted text.

Three surprises are judged, each against limits of its own: that of the words and
that of their order (``word_model``: counts of bigrams of known words and
marks), and that of the symbols words are written with, which tells how plausible
an unknown word is. A text is accepted if none is above trusted text of its language.

Symbols are classes of UTF-8 bytes, 64 in all (letters, capitals, digits, marks,
parts of characters beyond ASCII), and a word that repeats the one before it is one
symbol of its own. So a model of order 4 has at most 64**4 n-grams whatever the
corpus: counts are gathered over every trusted text, and yet the finished tables
are small enough to be broadcast.

1. Each task counts the n-grams of its trusted texts; the counts are summed in
   shards by n-gram.
2. Continuation counts of the lower orders, totals and count classes of contexts
   are grouped from them, and joined back on the context, shard by shard. That
   gives each n-gram its discounted part and each context its interpolation weight.
3. Every whole text is scored in one pass: mean surprise per symbol, and perplexity.
4. Trusted texts that were held back from training set, per language and surprise, the
   quantile of surprise above which a text is rejected. Short texts vary more, so the limit
   widens with the standard error of the mean.

Defined cases: a null or empty text has no perplexity and is rejected; a text
without tokens (white space) is judged by its symbols alone; a language
with fewer than LEAST held-back texts, or a null one, uses the limit of all
languages; without any held-back trusted text nothing but empty texts is rejected;
repeated rows are scored alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.llm.joins import small_side
from tidemark.llm.word_model import WordModel, word_scores
from tidemark.session import staged

ORDER = 4
SYMBOL_BITS = 6
SYMBOLS = 1 << SYMBOL_BITS
#: Quantile of the surprise of held-back trusted texts above which a text is rejected.
QUANTILE = 0.99
#: Held-back texts a language needs for a limit of its own.
LEAST = 50
#: Standard errors of the mean added to the limit.
MARGIN = 2.0

REPEATED = 42
#: What a repeated word looks like as context: an ordinary letter, so that one repeat does not excuse the next.
REPEATED_AS_CONTEXT = 7


def _symbol_table() -> np.ndarray:
    table = np.full(256, 40, np.uint8)
    table[:32] = 41
    table[127] = 41
    table[9:14] = 2
    table[32] = 1
    table[97:123] = np.arange(3, 29)
    table[65:91] = 29
    table[48:58] = 30
    for symbol, marks in ((31, "."), (32, ","), (33, ";:"), (34, "!?"), (35, "\"'`"), (36, "-_"), (37, "()[]{}"), (38, "|/\\"), (39, "#*$%&<>@^~+=")):
        table[[ord(c) for c in marks]] = symbol
    table[0xC0:0xC4], table[0xC4:0xE0], table[0xE0:0xF0], table[0xF0:] = 43, 44, 45, 46
    table[0x80:0xC0] = 47 + np.arange(64) % 16
    return table


_SYMBOL = _symbol_table()


def symbol_grams(piece: B.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams that end at each symbol, and row bounds; a row starts with blank context."""
    n = piece.last - piece.first
    symbols = _SYMBOL[piece.data].astype(np.int32)
    starts, ends, rows = B.spans(piece.data, piece.offsets, B.SPACED)
    words = B.span_hashes(piece.data, starts, ends)
    again = np.flatnonzero((words[1:] == words[:-1]) & (rows[1:] == rows[:-1])) + 1
    keep = np.ones(len(symbols) + 1, np.int32)
    if len(again):
        symbols[starts[again]] = REPEATED
        change = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(change, starts[again] + 1, 1)
        np.add.at(change, ends[again], -1)
        keep = 1 - np.cumsum(change)
    kept = keep[:-1] > 0
    bounds = np.r_[0, np.cumsum(kept)][piece.offsets]
    symbols = symbols[kept]
    grams = symbols.copy()
    seen = np.where(symbols == REPEATED, REPEATED_AS_CONTEXT, symbols)
    place = np.arange(len(symbols)) - np.repeat(bounds[:-1], np.diff(bounds))
    for back in range(1, ORDER):
        earlier = np.zeros_like(seen)
        earlier[back:] = seen[:-back]
        earlier[place < back] = 0
        grams |= earlier << (SYMBOL_BITS * back)
    return grams, bounds


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """N-gram counts of a whole task, one row for each n-gram."""
    totals = np.zeros(SYMBOLS ** ORDER, np.int32)
    for batch in batches:
        for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
            grams, counts = np.unique(symbol_grams(p)[0], return_counts=True)
            totals[grams] += counts.astype(np.int32)
    found = np.flatnonzero(totals)
    for at in range(0, len(found), 1 << 16):
        part = found[at:at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(totals[part].astype(np.int64))], ["gram", "n"])


def _level(counts: DataFrame, order: int) -> DataFrame:
    """(order, gram, part, context, weight): discounted part of each n-gram, interpolation weight of its context.

    Modified Kneser-Ney discounts come from the counts of counts; where those are
    too thin for an estimate the discount is a half.
    """
    n1, n2, n3, n4 = (x or 0 for x in counts.agg(*(F.sum((F.col("n") == i).cast("long")) for i in range(1, 5))).first())
    discounts = [0.5] * 3
    if n1 and n2 and n3:
        y = n1 / (n1 + 2 * n2)
        discounts = [min(max(i - (i + 1) * y * more / less, 0.05), float(i)) for i, (less, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    d = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
    rows = counts.select("gram", "n", d.alias("d"), F.shiftright("gram", SYMBOL_BITS).alias("context"))
    totals = rows.groupBy("context").agg(F.sum("n").alias("total"), (F.sum("d") / F.sum("n")).alias("weight"))
    return rows.join(totals, "context").select(F.lit(order).alias("order"), "gram", ((F.col("n") - F.col("d")) / F.col("total")).alias("part"), "context", "weight")


def train(trusted: DataFrame) -> dict[str, np.ndarray]:
    """Model tables of the texts in ``trusted``: one row per n-gram of every order, at most 64**4 in all."""
    counts = staged(trusted.select("text").mapInArrow(_gram_counts, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")), "counts")
    levels = [_level(counts, ORDER)]
    for order in range(ORDER - 1, 0, -1):
        # continuation count: in how many different places one symbol to the left the shorter n-gram is found
        counts = counts.groupBy(F.col("gram").bitwiseAND((1 << (SYMBOL_BITS * order)) - 1).alias("gram")).agg(F.count("*").alias("n"))
        levels.append(_level(counts, order))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = table.toArrow()
    return {name: table[name].to_numpy() for name in ("order", "gram", "part", "context", "weight")}


def dense(model: dict[str, np.ndarray]) -> np.ndarray:
    """Natural log of the probability of every n-gram of the highest order, seen or not."""
    lower = np.full(1, 1.0 / SYMBOLS)
    for order in range(1, ORDER + 1):
        at = model["order"] == order
        weight = np.ones(SYMBOLS ** (order - 1))
        weight[model["context"][at]] = model["weight"][at]
        values = np.zeros(SYMBOLS ** order, np.float32)
        values[model["gram"][at]] = model["part"][at]
        # grams with one first symbol are a block whose suffixes are all grams of the order below
        blocks = values.reshape(-1, len(lower)) if order > 1 else values.reshape(1, -1)
        for first, block in enumerate(blocks):
            contexts = weight.reshape(len(blocks), -1)[first]
            block += np.repeat(contexts, SYMBOLS) * lower
        lower = values
    np.maximum(lower, 1e-12, out=lower)
    return np.log(lower, out=lower)


def scores(documents: DataFrame, held: Broadcast) -> DataFrame:
    """doc_id, lang, text_key, n_symbols, surprise (mean, in nats) and spread (standard deviation) of every whole text, by tables sent to all tasks."""
    keyed = documents.select("doc_id", "lang", F.xxhash64("text").alias("text_key"), "text")
    schema = T.StructType([keyed.schema["doc_id"], keyed.schema["lang"],
                           *T._parse_datatype_string("text_key long, n_symbols long, surprise double, spread double").fields])
    names = schema.fieldNames()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            if table is None:
                table = dense(held.value)
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                grams, bounds = symbol_grams(p)
                logs = table[grams].astype(np.float64)
                sums, squares = np.r_[0, np.cumsum(logs)], np.r_[0, np.cumsum(logs * logs)]
                n = np.diff(bounds)
                none = n == 0
                size = np.maximum(n, 1)
                mean = -(sums[bounds[1:]] - sums[bounds[:-1]]) / size
                spread = np.sqrt(np.maximum((squares[bounds[1:]] - squares[bounds[:-1]]) / size - mean * mean, 0))
                part = batch.slice(p.first, p.last - p.first)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), part.column("text_key"), pa.array(n.astype(np.int64)),
                                                  pa.array(mean, mask=none), pa.array(spread, mask=none)], names)

    return keyed.mapInArrow(scan, schema)


def held_back(doc_id: Column) -> Column:
    """Trusted texts that set limits instead of training: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, text_key, n_symbols, perplexity (per symbol), surprise, limit, n_tokens, word_perplexity (per token), then surprise,
    spread and limit of words and of their order, accepted; one row per row of ``documents``."""
    documents = documents.select("doc_id", "lang", "text")
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("trusted_id")).distinct()
    training = documents.join(small_side(trusted.where(~held_back(F.col("trusted_id")))), documents["doc_id"] == F.col("trusted_id"), "left_semi")
    held, model = documents.sparkSession.sparkContext.broadcast(train(training)), WordModel(training)
    symbols = scores(documents, held).withColumn("key", F.xxhash64("doc_id", "text_key"))
    words = word_scores(documents.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("key"), "text"), model)
    scored = staged(symbols.join(words, "key", "left").drop("key"), "scores")
    held.destroy()
    model.release()  # later stages have the memory
    calibration = scored.join(small_side(trusted.where(held_back(F.col("trusted_id")))), scored["doc_id"] == F.col("trusted_id"), "left_semi")
    levels = {"surprise": ("spread", "n_symbols"), "word_surprise": ("word_spread", "n_tokens"), "order_surprise": ("order_spread", "n_tokens")}
    known = calibration.where("surprise is not null").select("lang", *levels)
    limits = [F.percentile_approx(c, QUANTILE, 10_000).alias(f"{c}_limit") for c in levels]
    by_lang = known.groupBy(F.col("lang").alias("limit_lang")).agg(*limits, F.count("*").alias("n")).where((F.col("n") >= LEAST) & F.col("limit_lang").isNotNull())
    overall = known.agg(*limits).first()
    judged = scored.join(small_side(by_lang), scored["lang"] == F.col("limit_lang"), "left")
    accepted = F.col("surprise").isNotNull()
    for level, (spread, n) in levels.items():
        judged = judged.withColumn(f"{level}_limit", F.coalesce(f"{level}_limit", F.lit(overall[f"{level}_limit"]).cast("double")))
        accepted &= F.coalesce(F.col(level) <= F.col(f"{level}_limit") + MARGIN * F.col(spread) / F.sqrt(n), F.lit(True))
    return judged.select("doc_id", "lang", "text_key", "n_symbols", F.exp("surprise").alias("perplexity"), "surprise", F.col("surprise_limit").alias("limit"),
                         F.coalesce("n_tokens", F.lit(0).cast("long")).alias("n_tokens"), F.exp("word_surprise").alias("word_perplexity"), "word_surprise", "word_spread",
                         F.col("word_surprise_limit").alias("word_limit"), "order_surprise", "order_spread", F.col("order_surprise_limit").alias("order_limit"), accepted.alias("accepted"))


def keep_accepted(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` that the classifier accepts, all columns kept."""
    bad = classify(documents.select("doc_id", "lang", "text"), labels).where(~F.col("accepted")).select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key"), F.col("lang").alias("bad_lang")).distinct()
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(documents["text"]) == bad["bad_key"])
                          & documents["lang"].eqNullSafe(bad["bad_lang"]), "left_anti")
