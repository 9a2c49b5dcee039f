"""Ranked lexical search over a block-compressed index, by Block-Max MaxScore.

Terms are words of digits, letters and characters beyond ASCII, A-Z lowered, known by
a 64-bit hash. A document's score sums, over the terms of a query, weight by impact in
whole numbers (``impacts``), so that every order of adding gives the same result.

1. Index: documents are taken in shards, bounded by documents and by postings. A shard
   is one row: the lengths of its documents and, per term, its postings in blocks of
   BLOCK, each packed as differences of document numbers and as frequencies in the
   least width, with the block's highest frequency and shortest document beside it.
2. Corpus counts (documents, terms, documents of a query's terms) are sums over the
   shards of the index. Queries are taken in blocks of about QUERY_TERMS terms.
3. Search, shard by shard: the highest frequency and shortest document of a list bound
   what its term can add to any document. Lists are opened in falling order of their
   bounds until all bounds left together stay below the score of the k-th best document
   so far; these lists are essential. Documents seen in none of them cannot enter.
4. For the others, the maximum of the block that would hold a document bounds each
   list that is left. Documents whose bounds fall short are dropped before a block is
   unpacked; the rest are looked up list by list and dropped as soon as they fall short.
5. A task keeps a heap of k per query over all its shards, which is the threshold of its
   next shard. The heaps of all tasks are merged in two steps.

Nothing is skipped on a tie, since a document with an equal score may have a lower id.

Defined cases: a null or empty text has no term and is no document of the corpus;
items that share an item_id are one query, null included; an item without terms, or
whose terms no document holds, has no row; rows that repeat a doc_id are ranked each on
its own; a null doc_id comes behind others of its score; extra columns are ignored;
empty tables give no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.llm.joins import small_side
from tidemark.session import staged

TOP = 50
BLOCK = 128
#: Blocks whose bytes are placed in the payload at one time.
PACK_BLOCKS = 2_048
#: A shard ends at this many documents or postings, whichever comes first.
SHARD_DOCS, SHARD_POSTINGS = 16_384, 2_000_000
#: Terms of the queries that are searched in one pass over the index, 16 bytes each in every task.
QUERY_TERMS = 1_000_000
#: Parts that each query's heaps are first merged in.
PARTS = 64

#: A shard is megabytes long, so a row group of the written index is closed after few of them, as the reader holds a whole one.
_SHARD_GROUPS = {"parquet.block.size": str(16 << 20), "parquet.page.size.row.check.min": "1"}

_SHARD = [("doc_ids", None), ("sizes", "array<bigint>"), ("terms", "array<bigint>"), ("counts", "array<int>"), ("first", "array<int>"), ("last", "array<int>"),
          ("at", "array<int>"), ("doc_width", "array<tinyint>"), ("tf_width", "array<tinyint>"), ("top_tf", "array<bigint>"), ("low_size", "array<bigint>"),
          ("payload", "binary")]


def term_counts(piece: B.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and frequency of every distinct term of every row, and the number of terms of each row."""
    data = B.LOWER[piece.data]
    starts, ends, rows = B.spans(data, piece.offsets, B.ALNUM)
    terms = B.span_hashes(data, starts, ends)
    order = np.lexsort((terms, rows))
    terms, owner = terms[order], rows[order]
    fresh = np.ones(len(terms), bool)
    fresh[1:] = (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(fresh)
    return owner[at], terms[at], np.diff(np.r_[at, len(terms)]), np.bincount(rows, minlength=piece.last - piece.first)


def _width(top: np.ndarray) -> np.ndarray:
    return np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, 4)).astype(np.int8)


def pack(terms: np.ndarray, docs: np.ndarray, tfs: np.ndarray, sizes: np.ndarray) -> dict[str, np.ndarray]:
    """A shard's lists, from its postings in order of documents.

    Numbers of postings and documents take 32 bits, and the bytes of the payload are placed some blocks at a time.
    """
    order = np.argsort(terms, kind="stable")
    terms, docs, tfs = terms[order], docs[order], tfs[order]
    del order
    heads = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[heads, len(terms)])
    names = terms[heads].view(np.int64)
    total = len(terms)
    del terms
    # a list's blocks begin at every BLOCK-th posting from its head
    blocks = -(-counts // BLOCK)
    own = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = np.repeat(heads, blocks) + own * BLOCK
    length = np.diff(np.r_[begin, total])
    steps = np.diff(docs, prepend=docs[:1])
    steps[begin] = 0
    top_tf = np.maximum.reduceat(tfs, begin) if len(begin) else tfs
    widths = {"doc_width": _width(np.maximum.reduceat(steps, begin) if len(begin) else steps), "tf_width": _width(top_tf)}
    at = np.r_[0, np.cumsum(length * (widths["doc_width"].astype(np.int64) + widths["tf_width"]))]
    payload = np.zeros(at[-1], np.uint8)
    for low in range(0, len(begin), PACK_BLOCKS):
        some = slice(low, low + PACK_BLOCKS)
        first, n = begin[low], length[some]
        block = np.repeat(np.arange(len(n)), n)
        inside = np.arange(len(block)) - (begin[some] - first)[block]
        for name, values, ahead in (("doc_width", steps, 0), ("tf_width", tfs, n * widths["doc_width"][some])):
            wide = widths[name][some][block]
            start = (at[:-1][some] + ahead)[block] + inside * wide
            for width in (1, 2, 4):
                own = np.flatnonzero(wide == width)
                payload[start[own, None] + np.arange(width)] = values[first + own].astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    low_size = np.minimum.reduceat(sizes[docs], begin) if len(begin) else sizes[:0]
    return {"sizes": sizes, "terms": names, "counts": counts, "first": docs[begin], "last": docs[begin + length - 1], "at": at[:-1],
            **widths, "top_tf": top_tf.astype(np.int64), "low_size": low_size, "payload": payload}


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    """The arrays as one; the list gives them up."""
    whole = np.concatenate(arrays)
    arrays.clear()
    return whole


def build_index(documents: DataFrame, shard_docs: int = SHARD_DOCS, shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """The index of every document that has a term: one row per shard."""
    texts = documents.select("doc_id", "text")
    id_type = T.ArrayType(texts.schema["doc_id"].dataType)
    schema = T.StructType([T.StructField(n, id_type if t is None else T._parse_datatype_string(t)) for n, t in _SHARD])

    def shard(ids: list, parts: tuple[list, ...], sizes: list) -> pa.RecordBatch:
        made = pack(*map(_joined, parts), np.concatenate(sizes).astype(np.int64))
        columns = [pa.concat_arrays(ids) if name == "doc_ids" else made[name] for name, _ in _SHARD]
        kinds = {"counts": np.int32, "first": np.int32, "last": np.int32, "at": np.int32}
        rows = [pa.array([c.tobytes()], pa.binary()) if name == "payload" else
                B.list_array(c if isinstance(c, pa.Array) else c.astype(kinds.get(name, c.dtype)), np.array([0, len(c)]))
                for (name, _), c in zip(_SHARD, columns)]
        return pa.RecordBatch.from_arrays(rows, [n for n, _ in _SHARD])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, sizes, n_docs, n_postings = [], ([], [], []), [], 0, 0
        for batch in batches:
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                rows, terms, tfs, n = term_counts(p)
                some = n > 0
                place = np.cumsum(some) - 1
                if some.any():
                    ids.append(batch.column("doc_id").slice(p.first, p.last - p.first).filter(pa.array(some)))
                    for held, column in zip(parts, (terms, (place[rows] + n_docs).astype(np.int32), tfs.astype(np.int32))):
                        held.append(column)
                    sizes.append(n[some])
                    n_docs, n_postings = n_docs + int(some.sum()), n_postings + len(rows)
                if n_docs >= shard_docs or n_postings >= shard_postings:
                    yield shard(ids, parts, sizes)
                    ids, parts, sizes, n_docs, n_postings = [], ([], [], []), [], 0, 0
        if n_docs:
            yield shard(ids, parts, sizes)

    return texts.mapInArrow(scan, schema)


def query_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term) of the items."""
    texts = items.select("item_id", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text")):
                rows, terms, _, _ = term_counts(p)
                yield pa.RecordBatch.from_arrays([batch.column("item_id").slice(p.first, p.last - p.first).take(pa.array(rows)), pa.array(terms.view(np.int64))],
                                                 ["item_id", "term"])

    return texts.mapInArrow(scan, T.StructType([texts.schema["item_id"], T.StructField("term", T.LongType())])).distinct()


def impacts(tf: np.ndarray, size: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What one unit of weight adds for a term's frequency in a document of so many terms."""
    length = 50 + (50 * size * n_docs) // n_terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * length)


class Shard:
    """One shard's lists, with bounds from the block maxima; blocks are unpacked when first asked for."""

    def __init__(self, row: dict[str, np.ndarray], n_docs: int, n_terms: int):
        self.__dict__.update(row)
        self.totals = n_docs, n_terms
        blocks = -(-self.counts // BLOCK)
        self.first_block = np.r_[0, np.cumsum(blocks)]
        self.block_bound = impacts(self.top_tf, self.low_size, n_docs, n_terms)
        self.list_bound = np.maximum.reduceat(self.block_bound, self.first_block[:-1])
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term's list, or -1; lists are in order of their terms as unsigned numbers."""
        at = np.minimum(np.searchsorted(self.terms.view(np.uint64), terms.view(np.uint64)), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def unpack(self, place: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of one block of a list."""
        if block not in self.opened:
            length = int(min(BLOCK, self.counts[place] - BLOCK * (block - self.first_block[place])))
            start, wide, tall = int(self.at[block]), int(self.doc_width[block]), int(self.tf_width[block])
            docs = int(self.first[block]) + np.cumsum(np.frombuffer(self.payload, f"<u{wide}", length, start), dtype=np.int64)
            tfs = np.frombuffer(self.payload, f"<u{tall}", length, start + wide * length).astype(np.int64)
            self.opened[block] = docs, impacts(tfs, self.sizes[docs], *self.totals)
        return self.opened[block]

    def unpack_all(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        if place not in self.whole:
            parts = [self.unpack(place, b) for b in range(self.first_block[place], self.first_block[place + 1])]
            self.whole[place] = parts[0] if len(parts) == 1 else tuple(np.concatenate(c) for c in zip(*parts))
        return self.whole[place]

    def look_up(self, place: int, docs: np.ndarray, blocks: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Impact of the list's term in each document, given the block that may hold it."""
        found = np.zeros(len(docs), np.int64)
        for block in np.unique(blocks[known]).tolist():
            own = np.flatnonzero(known & (blocks == block))
            held, values = self.unpack(place, block)
            at = np.minimum(np.searchsorted(held, docs[own]), len(held) - 1)
            found[own] = np.where(held[at] == docs[own], values[at], 0)
        return found

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, threshold: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents whose score is at least ``threshold``, above 0 and not below the shard's k-th best, with their scores."""
        places = self.find(terms)
        here = (places >= 0) & (weights > 0)
        places, weights = places[here], weights[here]
        bounds = weights * self.list_bound[places]
        order = np.argsort(-bounds, kind="stable")
        places, weights, bounds = places[order], weights[order], bounds[order]
        left = np.r_[np.cumsum(bounds[::-1])[::-1], 0]
        scores = np.zeros(len(self.sizes), np.int64)
        upto = 0
        while upto < len(places) and left[upto] >= max(threshold, 1):  # an essential list
            docs, values = self.unpack_all(int(places[upto]))
            scores[docs] += weights[upto] * values
            upto += 1
            # the k-th best of what is known so far is a threshold as well
            if upto < len(places) and len(scores) >= k and scores.max() > left[upto]:
                threshold = max(threshold, int(np.partition(scores, len(scores) - k)[-k]))
        docs = np.flatnonzero(scores)
        scores = scores[docs]
        rest = []
        for i in range(upto, len(places)):
            low, high = self.first_block[places[i]], self.first_block[places[i] + 1]
            blocks = np.minimum(low + np.searchsorted(self.last[low:high], docs), high - 1)
            known = (self.first[blocks] <= docs) & (docs <= self.last[blocks])
            rest.append([blocks, known, np.where(known, weights[i] * self.block_bound[blocks], 0)])
        bound = scores + sum(r[2] for r in rest) if rest else scores
        for i, (_, _, _) in enumerate(rest):
            alive = bound >= threshold
            if not alive.all():  # before their blocks are unpacked
                docs, scores, bound = docs[alive], scores[alive], bound[alive]
                rest = [r if j < i else [c[alive] for c in r] for j, r in enumerate(rest)]
            blocks, known, most = rest[i]
            added = weights[upto + i] * self.look_up(int(places[upto + i]), docs, blocks, known)
            scores, bound = scores + added, bound - most + added
        if len(docs) > k:
            threshold = max(threshold, int(np.partition(scores, len(scores) - k)[-k]))
        good = scores >= max(threshold, 1)
        return docs[good], scores[good]


def _rank(entry: tuple) -> tuple:
    score, doc_id = entry
    return -score, doc_id is None, 0 if doc_id is None else doc_id


def _search(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], k: int, n_docs: int, n_terms: int) -> DataFrame:
    """(query, doc_id, score): each task's k best documents of every query."""
    doc_id = T.StructField("doc_id", index.schema["doc_ids"].dataType.elementType)
    held = index.sparkSession.sparkContext.broadcast(queries)
    id_type = T.StructType([doc_id])
    schema = T.StructType([T.StructField("query", T.LongType()), *id_type.fields, T.StructField("score", T.LongType())])
    numbers = [n for n, _ in _SHARD if n not in ("doc_ids", "payload")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: list[list[tuple]] = [[] for _ in held.value]
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].values.to_numpy() for n in numbers} | {"payload": batch.column("payload")[i].as_buffer()}
                shard, ids = Shard(row, n_docs, n_terms), batch.column("doc_ids")[i].values
                for q, (terms, weights) in enumerate(held.value):
                    heap = heaps[q]
                    docs, scores = shard.best(terms, weights, k, heap[-1][0] if len(heap) == k else 0)
                    if len(docs):
                        heaps[q] = sorted(heap + list(zip(scores.tolist(), ids.take(pa.array(docs)).to_pylist())), key=_rank)[:k]
        rows = [(q, d, s) for q, heap in enumerate(heaps) for s, d in heap]
        if rows:
            q, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(d, kind), pa.array(s, pa.int64())], ["query", "doc_id", "score"])

    return index.mapInArrow(scan, schema)


def _cut(found: DataFrame, keys: list[Column], k: int) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return found.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)


def search(index: DataFrame, items: DataFrame, k: int = TOP, query_block: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's k best documents; ``index`` is a written table of ``build_index``."""
    total = index.agg(F.sum(F.size("doc_ids")).alias("docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n)).alias("terms")).first()
    asked = staged(query_terms(items), "asked")
    wanted = asked.select("term").distinct()
    lists = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("l")).select(F.col("l.terms").alias("term"), F.col("l.counts").alias("n"))
    held = lists.join(small_side(wanted), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    weight = F.floor(1000 * F.ln((F.lit(2.0) * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = staged(asked.join(held, "term").select("item_id", "term", weight.alias("weight")), "weighed")
    n_blocks = max(1, -(-weighed.count() // query_block))
    found = []
    for block in range(n_blocks):
        mine = weighed.where(F.pmod(F.xxhash64("item_id"), F.lit(n_blocks)) == block).sort("item_id", "term").toArrow()
        if not mine.num_rows:
            continue
        ids = mine["item_id"].to_pylist()
        cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        terms, weights = mine["term"].to_numpy(), mine["weight"].to_numpy()
        names = index.sparkSession.createDataFrame([(q, ids[a]) for q, a in enumerate(cuts[:-1])],
                                                   T.StructType([T.StructField("query", T.LongType()), weighed.schema["item_id"]]))
        hits = _search(index, [(terms[a:b], weights[a:b]) for a, b in zip(cuts, cuts[1:])], k, n_docs, n_terms)
        part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
        merged = _cut(_cut(hits.withColumn("part", part), ["query", "part"], k), ["query"], k)
        found.append(merged.join(F.broadcast(names), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not found:
        return index.sparkSession.createDataFrame([], T.StructType([weighed.schema["item_id"], T.StructField("rank", T.IntegerType()), T.StructField(
            "doc_id", index.schema["doc_ids"].dataType.elementType), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionByName, found)


def rank_documents(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The k best documents of each item."""
    return search(staged(build_index(documents), "index", **_SHARD_GROUPS), items, k)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM total) + 2.0::DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY term),
m AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM size CROSS JOIN total),
s AS (
  SELECT item_id, doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 20 * m.m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 50
"""
