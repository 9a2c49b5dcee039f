"""Benchmark decontamination by a prefix-filtered set join.

A window is ten consecutive words of a benchmark item (an item with fewer words
is one window). A text contains a window exactly when it contains, in place, all
of the window's word shingles; so, with shingles ordered by how rare they are in
the corpus, the rarest one alone is the necessary prefix. The steps:

1. one pass over the corpus keeps, per text, the stretches of words made of
   benchmark shingles (a sorted array of shingle hashes, a bounded block of the
   benchmark at a time, is broadcast for that);
2. shingles are counted over the whole corpus, and each window's rarest one is
   its prefix token; a window with an absent shingle cannot occur and goes;
3. prefix tokens join the stretches; offset and length bounds fix the one place
   where the window can lie, and the words there are compared exactly.

Defined cases: a null or empty text, or one without words, has no words and no
hits; a null or empty item has no windows; repeated items or rows count each on
its own; extra columns are ignored; empty tables give empty or clean results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.session import staged

WINDOW = 10
SHINGLE = 5
#: Benchmark words whose shingle hashes are broadcast at once: at most 8 bytes each, 16 MB.
BLOCK_WORDS = 2_000_000

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_words(text: Column) -> Column:
    """Words of a benchmark text, A-Z lowered."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORD), F.lit(0))


def _grams(words: Column, k: Column) -> Column:
    """Every k consecutive words, joined by a space, in order."""
    starts = F.when(F.size(words) >= k, F.sequence(F.lit(1), F.size(words) - k + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", F.slice(words, i, k)))


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct (item_id, window, n) of a benchmark; ``window`` is its words joined by a space."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), item_words(F.col("text")).alias("words"))
    n = F.least(F.size("words"), F.lit(WINDOW))
    return (words.where(F.size("words") > 0).select("item_id", n.alias("n"), F.explode(_grams(F.col("words"), n)).alias("window")).distinct())


def _hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for p in B.pieces(batch.column("gram")):
            starts, ends, rows = B.spans(p.data, p.offsets, B.ALNUM)
            sizes = np.bincount(rows, minlength=p.last - p.first)
            words = B.span_hashes(p.data, starts, ends)
            for k in np.unique(sizes):
                some = sizes[rows] == k
                found, _ = B.shingles(words[some], rows[some], int(k))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int32)), pa.array(found.view(np.int64))], ["k", "h"])


def _probe(windows: DataFrame) -> dict[int, np.ndarray]:
    """Sorted shingle hashes by shingle length, of one block of windows."""
    k = F.least(F.col("n"), F.lit(SHINGLE))
    grams = windows.select(F.explode(_grams(F.split("window", " "), k)).alias("gram")).distinct()
    table = grams.mapInArrow(_hashes_of, "k int, h long").distinct().toArrow()
    ks, hs = table["k"].to_numpy(), table["h"].to_numpy().view(np.uint64)
    return {int(k): np.sort(hs[ks == k]) for k in np.unique(ks)}


RUNS = pa.list_(pa.struct([("k", pa.int32()), ("start", pa.int32()), ("text", pa.string())]))


def _stretches(batch: pa.RecordBatch, probe: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, list]]:
    for p in B.pieces(batch.column("text")):
        n = p.last - p.first
        data = B.LOWER[p.data]
        starts, ends, rows = B.spans(data, p.offsets, B.ALNUM)
        words = B.span_hashes(data, starts, ends)
        bounds = B.row_bounds(rows, n)
        runs: list[list[dict]] = [[] for _ in range(n)]
        for k, hashes in probe.items():
            found, at = B.shingles(words, rows, k)
            if not len(found):
                continue
            at = at[hashes[np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)] == found]
            if not len(at):
                continue
            cut = np.flatnonzero((np.diff(at) != 1) | (rows[at[1:]] != rows[at[:-1]])) + 1
            for first, last in zip(at[np.r_[0, cut]], at[np.r_[cut - 1, len(at) - 1]]):
                row = int(rows[first])
                text = b" ".join(data[starts[i]:ends[i]].tobytes() for i in range(first, last + k)).decode()
                runs[row].append({"k": k, "start": int(first - bounds[row]), "text": text})
        yield p.first, np.diff(bounds), runs


def _scan(documents: DataFrame, probe: dict[int, np.ndarray]) -> DataFrame:
    """One row per text: key, number of words, stretches of benchmark shingles."""
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = T.StructType([keyed.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("start", T.IntegerType()),
                                                                           T.StructField("text", T.StringType())])))])
    held = documents.sparkSession.sparkContext.broadcast(probe)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n_words, runs in _stretches(batch, held.value):
                part = batch.slice(first, len(runs))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_key"), pa.array(n_words.astype(np.int64)), pa.array(runs, RUNS)],
                    ["doc_id", "text_key", "n_words", "runs"])

    return keyed.mapInArrow(scan, schema)


def _hit_windows(scanned: DataFrame, windows: DataFrame) -> DataFrame:
    """Exact places of windows: (doc_id, text_key, window, start, n)."""
    runs = (scanned.where(F.size("runs") > 0).select("doc_id", "text_key", F.explode("runs").alias("run"))
            .select("doc_id", "text_key", "run.k", "run.start", F.split("run.text", " ").alias("words")))
    tokens = runs.select("*", F.posexplode(_grams(F.col("words"), F.col("k"))).alias("at", "token"))
    rarity = tokens.groupBy("token").agg(F.count("*").alias("df"))
    k = F.least(F.col("n"), F.lit(SHINGLE))
    parts = windows.select("window", "n", k.alias("k"), F.posexplode(_grams(F.split("window", " "), k)).alias("offset", "token"))
    prefix = (parts.join(rarity, "token").groupBy("window", "n", "k")
              .agg(F.count("*").alias("present"), F.min(F.struct("df", "token", "offset")).alias("rarest"))
              .where(F.col("present") == F.col("n") - F.col("k") + 1)
              .select("window", "n", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset")))
    first = F.col("at") - F.col("offset")
    in_bounds = (first >= 0) & (first + F.col("n") <= F.size("words"))
    same = F.concat_ws(" ", F.slice("words", first + 1, F.col("n"))) == F.col("window")
    return (tokens.join(prefix, "token").where(F.when(in_bounds, same).otherwise(False))
            .select("doc_id", "text_key", "window", (F.col("start") + first).alias("start"), "n"))


def _covered(spans: Column) -> Column:
    """Number of words in the union of sorted (start, n) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(seen, s):
        end = (s["start"] + s["n"]).cast("long")
        fresh = F.greatest(F.lit(0), end - F.greatest(s["start"].cast("long"), seen["end"]))
        return F.struct(F.greatest(seen["end"], end).alias("end"), (seen["total"] + fresh).alias("total"))

    return F.aggregate(spans, zero, add, lambda s: s["total"])


def contamination(documents: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Hits of every text, one row per row of ``documents``.

    Columns: doc_id, text_key (hash of the text), n_words, n_hit (words inside
    window occurrences), n_items, item_ids (sorted), contaminated.
    """
    windows = staged(item_windows(benchmark), "windows")
    total = windows.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    scans, hits = [], []
    for block in range(blocks):
        mine = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        distinct = mine.select("window", "n").distinct()
        scanned = staged(_scan(documents, _probe(distinct)), "stretches")
        scans.append(scanned)
        hits.append(_hit_windows(scanned, distinct))
    hit = reduce(DataFrame.unionByName, hits)
    places = hit.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("places"))
    items = (hit.select("doc_id", "text_key", "window").distinct().join(windows.select("window", "item_id"), "window")
             .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")))
    # a hit text has both; keys are compared null-safe since doc_id may be null
    found = places.alias("p").join(items.alias("i"), F.col("p.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("p.text_key") == F.col("i.text_key"))).select(
        F.col("p.doc_id").alias("hit_id"), F.col("p.text_key").alias("hit_key"), _covered(F.col("places")).alias("hit_words"), "item_ids")
    base = scans[0].select("doc_id", "text_key", "n_words")
    joined = base.join(found, base["doc_id"].eqNullSafe(found["hit_id"]) & (base["text_key"] == found["hit_key"]), "left")
    n_hit = F.coalesce("hit_words", F.lit(0).cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                         (n_hit > 0).alias("contaminated"))


def digest(result: DataFrame) -> DataFrame:
    """The registered query's columns."""
    return result.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``documents`` without any benchmark window, all columns kept."""
    bad = contamination(documents.select("doc_id", "text"), benchmark).where("contaminated").select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return documents.join(bad, documents["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(documents["text"]) == bad["bad_key"]), "left_anti")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS seq
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
cand AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS seq
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, c.n, seq, item_id FROM cand c JOIN win USING (seq)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
