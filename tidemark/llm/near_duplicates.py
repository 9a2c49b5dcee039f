"""Near-duplicate groups by b-bit MinHash.

1. Every text becomes its set of distinct word shingles. Texts with equal sets
   are one class, found by a 128-bit digest of the set; the rest works on classes.
2. Minima of HASHES random hashes give BANDS band keys and a signature of the low
   BITS bits of each minimum, packed into 64-bit words.
3. Within a band bucket every class is paired with HUBS members of the bucket only,
   drawn by hash, which is linear in the bucket. The packed signatures give the
   similarity, corrected for chance agreement of low bits, by counting bits; pairs
   well below the threshold go, the rest are confirmed on their full sets.
4. Components of the confirmed links follow. Buckets that now lie in one component
   are done, as no further link could change the answer. In the others, classes with
   a likely partner in another component are compared on full sets, inside a join
   that only emits confirmed links. So no link that matters is skipped, and a large
   group of copies costs its size, not its square.

A pair at the threshold shares no band with probability (1 - 0.8**ROWS)**BANDS,
3e-6; the signature bound lies 4.5 standard deviations below the threshold.

Defined cases: a text with fewer words than a shingle is one shingle, its whole
sequence; a null or empty text or one without words has an empty set and is linked
with nothing; rows that repeat a doc_id keep a row each; a null doc_id joins its
group but never names it; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.llm.components import connected_components
from tidemark.session import staged

BANDS, ROWS, BITS = 32, 5, 2
HASHES = BANDS * ROWS
WORDS = HASHES * BITS // 64
PERCENT = 80
#: Members of a bucket that all others are paired with.
HUBS = 3

_rng = np.random.default_rng(7)
_MULTIPLIERS = (_rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * 2 + 1).astype(np.uint32)
_OFFSETS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_BAND_MIX = _rng.integers(1, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(piece: B.Piece, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, and row bounds."""
    n = piece.last - piece.first
    data = B.LOWER[piece.data]
    starts, ends, rows = B.spans(data, piece.offsets, B.SPACED)
    words = B.span_hashes(data, starts, ends)
    found, at = B.shingles(words, rows, k)
    owner = rows[at]
    sizes = np.bincount(rows, minlength=n)
    for short in range(1, k):
        some = sizes[rows] == short
        if some.any():
            extra, where = B.shingles(words[some], rows[some], short)
            found, owner = np.r_[found, extra], np.r_[owner, rows[some][where]]
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    found, owner = found[fresh], owner[fresh]
    return found, B.row_bounds(owner, n)


def sketch(found: np.ndarray, bounds: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
    """Set digests, packed low bits of the minima, and band keys, of non-empty rows."""
    first = bounds[:-1][bounds[1:] > bounds[:-1]]
    sums = [np.add.reduceat(B.mix(found * np.uint64(odd)), first) for odd in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)]
    digests = [a.tobytes() + b.tobytes() for a, b in zip(*sums)]
    low = (found >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((len(first), HASHES), np.uint32)
    scratch = np.empty(len(low), np.uint32)
    for i in range(HASHES):
        np.multiply(low, _MULTIPLIERS[i], out=scratch)
        np.add(scratch, _OFFSETS[i], out=scratch)
        minima[:, i] = np.minimum.reduceat(scratch, first)
    wide = minima.astype(np.uint64).reshape(len(first), BANDS, ROWS)
    keys = B.mix((wide * _BAND_MIX).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    bits = (B.mix(minima.astype(np.uint64)) & np.uint64((1 << BITS) - 1)).reshape(len(first), WORDS, 64 // BITS)
    packed = (bits << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)
    return digests, packed.view(np.int64), keys.view(np.int64)


def _sketches(documents: DataFrame, k: int) -> DataFrame:
    keyed = documents.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = T.StructType([keyed.schema["doc_id"], T.StructField("text_key", T.LongType()), T.StructField("n_shingles", T.LongType()),
                           T.StructField("node", T.BinaryType()), *(T.StructField(f"s{i}", T.LongType()) for i in range(WORDS)),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    names = schema.fieldNames()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                part = batch.slice(p.first, p.last - p.first)
                found, bounds = shingle_sets(p, k)
                sizes = np.diff(bounds)
                full = sizes > 0
                place = np.where(full, np.cumsum(full) - 1, 0)
                if full.any():
                    digests, packed, keys = sketch(found, bounds)
                else:
                    digests, packed, keys = [b""], np.zeros((1, WORDS), np.int64), np.zeros((1, BANDS), np.int64)
                gone = ~full
                nodes = pa.array(digests, pa.binary()).take(pa.array(np.ma.MaskedArray(place, gone).filled(0), mask=gone))
                signature = [pa.array(packed[place, i], mask=gone) for i in range(WORDS)]
                bands = B.list_array(keys.reshape(-1)[:BANDS * int(full.sum())], np.r_[0, np.cumsum(full)] * BANDS)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(sizes.astype(np.int64)), nodes, *signature, bands],
                                                 names)

    return keyed.mapInArrow(scan, schema)


def _full_sets(texts: DataFrame, k: int) -> DataFrame:
    """(node, grams): the whole sorted shingle set of each class's first text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text"), B.SMALL_PIECE):
                found, bounds = shingle_sets(p, k)
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(p.first, p.last - p.first), B.list_array(found.view(np.int64), bounds)],
                                                 ["node", "grams"])

    return texts.select("node", "text").mapInArrow(scan, "node binary, grams array<bigint>")


def _estimate(a: str, b: str) -> Column:
    """Similarity from packed signatures: agreeing groups of low bits, less those that agree by chance."""
    differing = F.lit(0)
    for i in range(WORDS):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        differing = differing + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555)))
    chance = 1.0 / (1 << BITS)
    return ((HASHES - differing) / HASHES - chance) / (1 - chance)


def _lowest(percent: int) -> float:
    """Estimate that a pair at the threshold falls short of once in 300,000 times."""
    chance = 1.0 / (1 << BITS)
    agree = chance + (1 - chance) * percent / 100
    return percent / 100 - 4.5 * (agree * (1 - agree) / HASHES) ** 0.5 / (1 - chance)


def _may_link(a: str, b: str, percent: int) -> Column:
    sizes = [F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")]
    return (100 * F.least(*sizes) >= percent * F.greatest(*sizes)) & (_estimate(a, b) >= _lowest(percent))


def _sets_of(nodes: DataFrame, classes: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """(node, grams) of the given classes, as a table."""
    wanted = classes.join(nodes, "node", "left_semi").select("node", F.col("first.doc_id").alias("at_id"), F.col("first.text_key").alias("at_key"))
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("key")).alias("d").join(
        wanted.alias("w"), F.col("d.doc_id").eqNullSafe(F.col("w.at_id")) & (F.col("d.key") == F.col("w.at_key"))).select("node", "text")
    return staged(_full_sets(texts, k).dropDuplicates(["node"]), "sets")


def _enough(a: str, b: str, percent: int) -> Column:
    common = F.size(F.array_intersect(a, b))
    return 100 * common >= percent * (F.size(a) + F.size(b) - common)


def _confirmed(pairs: DataFrame, classes: DataFrame, documents: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose full sets meet the threshold."""
    pairs = staged(pairs, "pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = _sets_of(nodes, classes, documents, k)
    left, right = sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), sets.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    return pairs.join(left, "a").join(right, "b").where(_enough("ga", "gb", percent)).select("a", "b")


def near_duplicate_components(documents: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``documents``: doc_id, text_key, n_shingles, component_id, kept."""
    rows = staged(_sketches(documents, k), "sketches")
    sketched = [*(f"s{i}" for i in range(WORDS)), "n_shingles"]
    classes = staged(rows.where("n_shingles > 0").groupBy("node").agg(
        F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "text_key")).alias("first"), F.min("doc_id").alias("lowest"), *(F.min(c).alias(c) for c in sketched),
        F.min("bands").alias("bands")), "classes")
    light = classes.select("node", *sketched)
    members = classes.select("node", F.explode("bands").alias("bucket"))
    draws = [F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("draw"), "node"))["node"] for turn in range(HUBS)]
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.array_distinct(F.array(*draws)).alias("hubs")).where(
        "low <> high").select("bucket", "hubs")
    placed = staged(members.join(shared, "bucket"), "placed")
    stars = placed.select("node", F.explode("hubs").alias("hub")).where("node <> hub").select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()

    def likely(pairs: DataFrame) -> DataFrame:
        return (pairs.join(light.alias("x"), F.col("a") == F.col("x.node")).join(light.alias("y"), F.col("b") == F.col("y.node"))
                .where(_may_link("x", "y", percent)).select("a", "b"))

    parts = staged(connected_components(_confirmed(likely(stars), classes, documents, k, percent)), "parts")

    def loose(parts: DataFrame) -> DataFrame:
        """Members of buckets that lie in more than one component."""
        members = placed.select("bucket", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
        mixed = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("bucket")
        return staged(members.join(mixed, "bucket", "left_semi"), "loose")

    def joined_by(links: DataFrame, parts: DataFrame) -> DataFrame:
        known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        return staged(connected_components(known.unionByName(links.select("a", "b"))), "parts")

    left_over = loose(parts).join(light, "node")
    x, y = left_over.alias("x"), left_over.alias("y")
    other = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") != F.col("y.component")) & _may_link("x", "y", percent)
    hopeful = staged(x.join(y, other, "left_semi"), "hopeful")
    sets = _sets_of(hopeful.select("node").distinct(), classes, documents, k)
    full = hopeful.join(sets, "node")
    x, y = full.alias("x"), full.alias("y")
    across = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") < F.col("y.component")) & _may_link("x", "y", percent)
                    & _enough("x.grams", "y.grams", percent))
    parts = joined_by(across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), parts)

    grouped = classes.select("node", "lowest", "first").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = staged(grouped.groupBy("component").agg(F.min("lowest").alias("component_id"), F.min("first").alias("keeper")), "names")
    named = grouped.select("node", "component").join(names, "component").select("node", "component_id", "keeper")
    own = rows.select("doc_id", "text_key", "n_shingles", "node").join(named, "node", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    stays = F.isnull("keeper") | (F.col("doc_id").eqNullSafe(F.col("keeper.doc_id")) & (F.col("text_key") == F.col("keeper.text_key")))
    return own.select("doc_id", "text_key", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
                      stays.alias("representative"))


def keep_first(documents: DataFrame, k: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row of each group, all columns kept; rows that repeat doc_id and text stay once."""
    found = near_duplicate_components(documents.select("doc_id", "text"), k, percent).where(~F.col("representative"))
    gone = found.select(F.xxhash64("doc_id", "text_key").alias("row_key"), F.col("doc_id").alias("gone_id")).distinct().alias("g")
    keyed = documents.select(F.struct("*").alias("row"), F.xxhash64("doc_id", F.xxhash64("text")).alias("row_key")).alias("d")
    rest = keyed.join(gone, (F.col("d.row_key") == F.col("g.row_key")) & F.col("d.row.doc_id").eqNullSafe(F.col("g.gone_id")), "left_anti")
    return rest.withColumn("own_id", F.col("row.doc_id")).dropDuplicates(["row_key", "own_id"]).select("row.*")


ORACLE_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [1] ELSE range(1, len(w)) END) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
-- classes of equal sets, then links between classes
k AS (SELECT doc_id, md5(string_agg(g, chr(10) ORDER BY g)) AS set_key FROM s GROUP BY doc_id),
c AS (SELECT set_key, min(doc_id) AS rep FROM k GROUP BY set_key),
cs AS (SELECT doc_id, g, n FROM s JOIN n USING (doc_id) WHERE doc_id IN (SELECT rep FROM c)),
e AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM cs a JOIN cs b ON a.g = b.g AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r AS (SELECT rep AS x, rep AS y FROM c UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
l AS (SELECT x AS rep, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN c USING (set_key) LEFT JOIN l USING (rep)
"""
