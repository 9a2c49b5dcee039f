"""Word model of the quality classifier: modified Kneser-Ney bigrams of words and marks, counts looked up in shards.

Tokens are runs of letters, digits and characters beyond ASCII, case kept, and
every other visible character by itself, so that the end of a sentence and the
capital behind it are seen. A word is known if at least one in ``KNOWN_ONE_IN``
tokens of trusted text (and LEAST_SEEN of them) is that word: by this rule there
are at most ``KNOWN_ONE_IN`` known words, however large the corpus. Other words
stand as their shape (small, capitalised, capitals, digits, beyond ASCII); how they
are spelled is left to the model over symbols in ``language_model``.

1. Tasks count the words of the trusted texts, summed in shards by Spark; then the
   bigrams, dealt out by their hash to as many shards as the count of the words asks for
   (SHARD_TOKENS). A shard's bigrams lie in it in order, packed (``_pack``).
2. Totals of contexts and continuation counts are grouped from them. Both are bounded by
   the known words and sent to all tasks, so that what a bigram gains over what its context
   and its word alone would give follows from its count: only counts are stored and sent.
3. One scan of whole texts sums what contexts and words give, and adds the gain of the
   bigrams that are at least one in ``FREQUENT_ONE_IN`` of trusted text (at most so
   many: a bound), so that no frequent bigram meets one task. Of the others those are
   looked up that a bitmap of hashed bigrams, FILTER_BITS at most, does not show to be
   missing from trusted text: the distinct bigrams of each text of a piece, with their
   counts, packed into one row for each shard. A shard reads its part of the model first
   and then these rows one by one, and gives the sums of each text, which are summed for
   each document. A bitmap too small for the model lets more bigrams through and changes
   no result.
4. Besides the surprise of a text there is that of its order: surprise less what the
   same tokens give in any order. Rare words raise the one and leave the other.

Defined cases: a null or empty text has no tokens and no surprise; without trusted
text every token is its shape and all are alike; repeated rows share one result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import textbytes as B
from tidemark.session import discard, staged

KNOWN_ONE_IN = 1 << 20
LEAST_SEEN = 3
FREQUENT_ONE_IN = 1 << 20
#: Logarithm of the most bits of the bitmap: 32 MB. It is sized at 16 to 32 bits for each token of trusted text below that.
FILTER_BITS = 28
#: Tokens of trusted text for each shard, at most, so that its bigrams fit a task; and the least number of shards.
SHARD_TOKENS = 1 << 22
LEAST_SHARDS_LOG = 3
#: Bigrams in one packed row of the model, and bigrams a task gathers before it adds them up.
ROW = 1 << 18
GATHERED = 1 << 20
#: Bits of a token number in a packed bigram; numbers below SHAPES stand for shapes, 0 for the start of a text.
BITS = 21
SHAPES = 8
MASK = (1 << BITS) - 1

_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_WORD = _UPPER | _DIGIT | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)


def tokens(piece: B.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, shape number and row of every token of a piece, in order."""
    data = piece.data
    starts, ends, _ = B.spans(data, piece.offsets, _WORD)
    marks = np.flatnonzero(~_WORD[data] & B.SPACED[data])
    starts, ends = np.r_[starts, marks], np.r_[ends, marks + 1]
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], ends[order]
    first, last = data[starts], data[ends - 1]
    shape = np.where(_UPPER[first], np.where(_UPPER[last] & (ends - starts > 1), 3, 2),
                     np.where(_DIGIT[first], 4, np.where(first >= 128, 5, np.where(_WORD[first], 1, 6))))
    return B.span_hashes(data, starts, ends), shape, np.searchsorted(piece.offsets, starts, "right") - 1


def _numbers(hashes: np.ndarray, shape: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Token numbers: place among the known words, else the shape."""
    if not len(known):
        return shape.astype(np.int64)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, at + SHAPES, shape).astype(np.int64)


def _bigrams(piece: B.Piece, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed bigram that ends at each token, and its row; the first token of a text follows number 0."""
    hashes, shape, rows = tokens(piece)
    numbers = _numbers(hashes, shape, known)
    before = np.zeros_like(numbers)
    before[1:] = np.where(rows[1:] == rows[:-1], numbers[:-1], 0)
    return before << BITS | numbers, rows


def _counted(texts: DataFrame, what, name: str) -> DataFrame:
    """(name, n): occurrences of the numbers ``what`` gives for a piece, summed by task and then in shards."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                values, counts = np.unique(what(p), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts.astype(np.int64))], [name, "n"])

    return texts.select("text").mapInArrow(scan, f"{name} long, n long").groupBy(name).agg(F.sum("n").alias("n"))


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers in few bytes: places of equal value side by side, compressed. Small numbers and small steps cost little."""
    raw = np.ascontiguousarray(values.astype(np.int64, copy=False).view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    raw = pa.Codec("zstd").decompress(memoryview(packed)[8:], n * 8, asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.int64).ravel()


def _hashed(gram: np.ndarray) -> np.ndarray:
    return B.mix(gram.view(np.uint64))


def _shard(hashed: np.ndarray, log: int) -> np.ndarray:
    """Shard of hashed bigrams: their first bits, so that a shard owns a stretch of the bitmap."""
    return (hashed >> np.uint64(64 - log)).astype(np.int64)


def _added(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bigrams in order, with the sums of their counts."""
    gram, n = np.concatenate(grams), np.concatenate(counts)
    sort = np.argsort(gram, kind="stable")
    gram, n = gram[sort], n[sort]
    begin = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]]) if len(gram) else np.zeros(0, np.int64)
    return gram[begin], np.add.reduceat(n, begin) if len(begin) else n


def _counted_bigrams(texts: DataFrame, known, log: int, bits: int, least: float) -> DataFrame:
    """(shard, place, grams, counts, bits): packed rows of each shard in order, and its stretch of the bitmap of bigrams below ``least``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            gram, n = _added(grams, counts)
            shard = _shard(_hashed(gram), log)
            sort = np.argsort(shard, kind="stable")
            cuts = np.searchsorted(shard[sort], np.arange(1, 1 << log))
            parts = [(s, gram[at], n[at]) for s, at in enumerate(np.split(sort, cuts)) if len(at)]
            grams.clear(), counts.clear()
            return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in parts], pa.int32()), pa.array([_pack(np.diff(g, prepend=0)) for _, g, _ in parts], pa.binary()),
                                               pa.array([_pack(n) for _, _, n in parts], pa.binary())], ["shard", "grams", "counts"])

        grams, counts = [], []
        for batch in batches:
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                gram, n = np.unique(_bigrams(p, known.value)[0], return_counts=True)
                grams.append(gram), counts.append(n)
                if sum(map(len, grams)) > GATHERED:
                    yield out()
        if grams:
            yield out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {}
        for batch in batches:
            for shard, gram, n in zip(batch.column("shard").to_pylist(), batch.column("grams"), batch.column("counts")):
                grams, counts = shards.setdefault(shard, ([], []))
                grams.append(np.cumsum(_unpack(gram.as_buffer()))), counts.append(_unpack(n.as_buffer()))
                if len(grams) > 1 and sum(map(len, grams[1:])) > max(GATHERED, len(grams[0])):  # as much again as was added up before
                    grams[:], counts[:] = ([x] for x in _added(grams, counts))
        for shard in list(shards):
            gram, n = _added(*shards.pop(shard))
            word, bit = _places(_hashed(gram[n < least]), bits)
            words = np.zeros(1 << (bits - 6 - log), np.uint64)
            np.bitwise_or.at(words, word - (shard << (bits - 6 - log)), bit)
            for at in range(0, len(gram), ROW):
                yield _model_row(shard, at // ROW, _pack(np.diff(gram[at:at + ROW], prepend=0)), _pack(n[at:at + ROW]), None)
            yield _model_row(shard, -1, None, None, _pack(words.view(np.int64)))

    rows = texts.select("text").mapInArrow(scan, "shard int, grams binary, counts binary").repartitionById(1 << log, F.col("shard"))
    return rows.mapInArrow(merge, "shard int, place int, grams binary, counts binary, bits binary")


def _model_row(shard: int, place: int, *packed: bytes | None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([place], pa.int32()), *(pa.array([x], pa.binary()) for x in packed)],
                                      ["shard", "place", "grams", "counts", "bits"])


def _bigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(context, token, n) of packed rows."""
    for batch in batches:
        for gram, n in zip(batch.column("grams"), batch.column("counts")):
            gram = np.cumsum(_unpack(gram.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array((gram >> BITS).astype(np.int32)), pa.array((gram & MASK).astype(np.int32)), pa.array(_unpack(n.as_buffer()))],
                                             ["context", "token", "n"])


def _discounts(classes: np.ndarray) -> np.ndarray:
    """Discounts of counts 0 (none), 1, 2 and of 3 and more, from how many counts are 1, 2, 3 and 4; a half where those are too few."""
    n1, n2, n3, n4 = (int(x) for x in classes)
    if not (n1 and n2 and n3):
        return np.array([0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([0] + [min(max(i - (i + 1) * y * more / less, 0.05), float(i)) for i, (less, more) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)])


class Gains:
    """What a bigram of trusted text gives beyond its context and its word, from its count."""

    def __init__(self, weight: np.ndarray, alone: np.ndarray, total: np.ndarray, discounts: np.ndarray):
        self.weight, self.alone, self.total, self.discounts = weight, alone, total, discounts

    def of(self, gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gain in logarithm, in its square, and in the square of the order's."""
        context = gram >> BITS
        weight = self.weight[context]
        lower = weight + self.alone[gram & MASK]
        gain = np.log((n - self.discounts[np.minimum(n, 3)]) / self.total[context] + np.exp(lower)) - lower
        return gain, gain * (gain + 2 * lower), gain * (gain + 2 * weight)


class WordModel:
    """Bounded tables in arrays (known words, what words and contexts give, frequent bigrams, the bitmap) and the packed table of counts."""

    def __init__(self, training: DataFrame):
        spread = training.sparkSession.sparkContext.broadcast
        words = staged(_counted(training, lambda p: tokens(p)[0].view(np.int64), "word"), "words")
        total = words.agg(F.sum("n")).first()[0] or 0
        seen = words.where((F.col("n") >= LEAST_SEEN) & (F.col("n") * KNOWN_ONE_IN >= F.lit(total)))
        known = np.sort(seen.select("word").toArrow()["word"].to_numpy().view(np.uint64))
        discard(words)
        self.known = spread(known)
        self.shards_log = max(LEAST_SHARDS_LOG, int(total // SHARD_TOKENS).bit_length())
        bits = max(min(FILTER_BITS, int(total * 16).bit_length()), self.shards_log + 10)
        self.table = staged(_counted_bigrams(training, self.known, self.shards_log, bits, total / FREQUENT_ONE_IN), "bigrams")
        counts = self.table.where("grams is not null").select("grams", "counts").mapInArrow(_bigram_rows, "context int, token int, n long")
        size = len(known) + SHAPES
        # continuation counts: after how many different tokens a token is found
        after = counts.groupBy("token").agg(F.count("*").alias("n")).toArrow()
        token, n = after["token"].to_numpy(), after["n"].to_numpy()
        less = _discounts([(n == i).sum() for i in range(1, 5)])[np.minimum(n, 3)]
        alone = np.full(size, 1.0 / size)
        if len(n):
            alone *= less.sum() / n.sum()
            alone[token] += (n - less) / n.sum()
        classes = [F.count_if(F.col("n") == i).alias(f"n{i}") for i in range(1, 5)]
        left = counts.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("all"), *classes).toArrow()
        context = left["context"].to_numpy()
        classes = np.stack([left[f"n{i}"].to_numpy() for i in range(1, 5)])
        discounts = _discounts(classes.sum(axis=1))
        weight, totals = np.ones(size), np.ones(size)
        totals[context] = left["total"].to_numpy()
        weight[context] = (classes[0] * discounts[1] + classes[1] * discounts[2] + (left["all"].to_numpy() - classes[0] - classes[1]) * discounts[3]) / totals[context]
        gains = Gains(np.log(weight), np.log(alone), totals, discounts)
        self.gains = spread(gains)
        often = counts.where(F.col("n") * FREQUENT_ONE_IN >= F.lit(total)).toArrow()
        gram, n = _added([often["context"].to_numpy().astype(np.int64) << BITS | often["token"].to_numpy()], [often["n"].to_numpy()])
        self.frequent = spread((gram, *gains.of(gram, n)))
        bitmap = np.zeros(1 << (bits - 6), np.uint64)
        for shard, packed in self.table.where("bits is not null").select("shard", "bits").collect():
            own = _unpack(bytes(packed)).view(np.uint64)
            bitmap[shard * len(own):(shard + 1) * len(own)] = own
        self.bitmap = spread((bits, bitmap))

    def release(self) -> None:
        """Take the tables from all tasks and from the disk, once nothing is left to score."""
        for held in (self.known, self.gains, self.frequent, self.bitmap):
            held.destroy()
        discard(self.table)


def _places(hashed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Word of the bitmap and bit within it for each hashed bigram."""
    place = hashed >> np.uint64(64 - bits)
    return (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))


SUMS = ("logs", "squares", "order_logs", "order_squares")


def word_scores(keyed: DataFrame, model: WordModel) -> DataFrame:
    """key, n_tokens, word_surprise and order_surprise (means, in nats) and their spreads, of every text of (key, text); one row for each key."""
    known, held, frequent, bitmap, log = model.known, model.gains, model.frequent, model.bitmap, model.shards_log
    names = ["shard", "place", "grams", "counts", "keys", "rows", "sums"]
    schema = "shard int, place int, grams binary, counts binary, keys binary, rows binary, sums binary"

    def asked(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(column, t) for column, t in zip(zip(*rows), types)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = held.value
        grams, gain, more, more_order = frequent.value
        bits, words = bitmap.value
        last = np.iinfo(np.int32).max
        for batch in batches:
            keys = batch.column("key").to_numpy()
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                gram, rows = _bigrams(p, known.value)
                order = gains.weight[gram >> BITS]
                logs = order + gains.alone[gram & MASK]
                squares, order_squares = logs * logs, order * order
                rest = np.ones(len(gram), bool)
                if len(grams):
                    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
                    hit = grams[at] == gram
                    at = at[hit]
                    logs[hit] += gain[at]
                    order[hit] += gain[at]
                    squares[hit] += more[at]
                    order_squares[hit] += more_order[at]
                    rest = ~hit
                n = p.last - p.first
                own = keys[p.first:p.last]
                # what is known here: one row, for any shard to pass on
                sums = np.stack([np.bincount(rows, v, n) for v in (logs, squares, order, order_squares)]).astype(np.float64)  # of no tokens: whole zeros
                out = [(int(own[0]) & ((1 << log) - 1), last, None, _pack(np.bincount(rows, minlength=n)), _pack(own), None, sums.tobytes())]
                hashed = _hashed(gram)
                word, bit = _places(hashed, bits)
                rest &= (words[word] & bit) != 0
                # the other bigrams: one entry for each in a text, with its count, in order within their shard
                gram, rows, shard = gram[rest], rows[rest], _shard(hashed[rest], log)
                sort = np.lexsort((rows, gram, shard))
                gram, rows, shard = gram[sort], rows[sort], shard[sort]
                begin = np.flatnonzero(np.r_[True, (gram[1:] != gram[:-1]) | (rows[1:] != rows[:-1])]) if len(gram) else np.zeros(0, np.int64)
                n = np.diff(np.r_[begin, len(gram)])
                gram, rows, shard = gram[begin], rows[begin], shard[begin]
                cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else []
                for a, b in zip(cuts[:-1], cuts[1:]):
                    texts, at = np.unique(rows[a:b], return_inverse=True)
                    out.append((int(shard[a]), last, _pack(np.diff(gram[a:b], prepend=0)), _pack(n[a:b]), _pack(own[texts]), _pack(at), None))
                yield asked(out)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = held.value
        now, parts, grams, counts = None, [], None, None
        for batch in batches:
            columns = [batch.column(name) for name in names]
            for i in range(len(batch)):
                shard, place, gram, n, keys, rows, sums = (c[i] for c in columns)
                if shard.as_py() != now:
                    now, parts, grams, counts = shard.as_py(), [], np.zeros(0, np.int64), np.zeros(0, np.int64)
                if not keys.is_valid:
                    parts.append((np.cumsum(_unpack(gram.as_buffer())), _unpack(n.as_buffer()).astype(np.int32)))
                    continue
                if parts:
                    grams, counts = (np.concatenate(x) for x in zip(*parts))
                    parts = []
                keys, n = _unpack(keys.as_buffer()), _unpack(n.as_buffer())
                if sums.is_valid:
                    found, total = np.frombuffer(sums.as_buffer(), np.float64).reshape(4, -1), pa.array(n)
                elif not len(grams):
                    continue
                else:
                    gram, rows = np.cumsum(_unpack(gram.as_buffer())), _unpack(rows.as_buffer())
                    at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
                    hit = grams[at] == gram
                    rows, n = rows[hit], n[hit]
                    gain, more, more_order = (n * v for v in gains.of(gram[hit], counts[at[hit]]))
                    found = [np.bincount(rows, v, len(keys)).astype(np.float64) for v in (gain, more, gain, more_order)]
                    total = pa.nulls(len(keys), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(keys), total, *map(pa.array, found)], ["key", "n", *SUMS])

    table = model.table.where("grams is not null").select("shard", "place", "grams", "counts", *(F.lit(None).cast("binary").alias(c) for c in names[4:]))
    rows = table.unionByName(keyed.mapInArrow(scan, schema)).repartitionById(1 << log, F.col("shard")).sortWithinPartitions("shard", "place")
    sums = rows.mapInArrow(look, "key long, n long, " + ", ".join(f"{c} double" for c in SUMS)).groupBy("key").agg(
        F.sum("n").alias("total"), F.count("n").alias("copies"), *(F.sum(c).alias(c) for c in SUMS)).where("total > 0")
    mean = lambda c: F.col(c) / F.col("total")
    spread = lambda c, squares: F.sqrt(F.greatest(mean(squares) - mean(c) * mean(c), F.lit(0.0)))
    return sums.select("key", F.expr("total div copies").alias("n_tokens"), (-mean("logs")).alias("word_surprise"), spread("logs", "squares").alias("word_spread"),
                       (-mean("order_logs")).alias("order_surprise"), spread("order_logs", "order_squares").alias("order_spread"))
