"""Near-duplicate groups by SimHash, candidates filtered by the pigeonring principle.

1. Every text becomes a 64-bit fingerprint: a bit is set when it is set in over half
   of the XXH64 hashes of the text's word shingles, repeats counted. Texts with equal
   fingerprints are one node; the rest works on distinct fingerprints.
2. The 64 bits are cut into SEGMENTS consecutive segments, read as a ring. If two
   fingerprints differ in at most RADIUS bits, then some segment starts a chain in
   which the first l segments differ in at most l * RADIUS / SEGMENTS bits, for every
   l at once. With five segments and four bits the budgets are 0, 1, 2, 3 and 4.
3. The first CHAIN segments of every chain are met by a join: one side lays down its
   own bits, the other also each change that the budgets allow there. Longer chains,
   and in the end the whole ring, are compared by counting bits.
4. In a bucket of such a join each fingerprint is compared with a few hubs, which is
   linear in the bucket. Components of the links follow. Buckets whose members lie in
   one component, or of which all but one are hubs, are done. Members of the others
   are compared through the bit patterns half way between two fingerprints: two of
   them are linked exactly when some pattern is at most RADIUS / 2 bits from both, and
   all that share one are linked with each other. So each is linked with the least of
   its pattern; no group is ever paired with itself.

Defined cases: a text with fewer words than a shingle is one shingle, its whole
sequence; a null or empty text or one without words has fingerprint zero and is
linked like any other; rows that repeat a doc_id keep a row each; a null doc_id joins
its group but never names it, alone its component is null; extra columns are ignored;
an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import textbytes as B
from tidemark.llm.components import connected_components
from tidemark.llm.joins import small_side
from tidemark.session import staged

WORDS = 4
SEED = 42
RADIUS = 4
SEGMENTS = 5
#: Segments of a chain that the join itself meets. 3 gives keys of 39 bits, for more than some 10**8 fingerprints.
CHAIN = 2
#: Members of a bucket that all others are compared with, besides the least and the greatest.
DRAWS = 2

#: The five primes of XXH64, fixed values.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
#: Spans from this many bytes on are hashed one by one.
_LONG = 256


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _turn(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * P2, 31) * P1


def xxh64_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each byte span, span lengths side by side."""
    out = np.zeros(len(starts), np.uint64)
    sizes = ends - starts
    for i in np.flatnonzero(sizes >= _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]].tobytes(), seed)
    short = np.flatnonzero(sizes < _LONG)
    if not len(short):
        return out
    # every 8 and 4 bytes from any place, read in place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    four = np.ndarray((len(data) + 1,), "<u4", padded, strides=(1,))
    at, left = starts[short].copy(), sizes[short].copy()
    acc = np.full(len(short), (seed + int(P5)) % (1 << 64), np.uint64)
    wide = np.flatnonzero(left >= 32)
    if len(wide):
        lanes = [np.full(len(wide), v % (1 << 64), np.uint64) for v in (seed + int(P1) + int(P2), seed + int(P2), seed, seed - int(P1))]
        where, stripes = at[wide], left[wide] // 32
        for step in range(int(stripes.max())):
            on = stripes > step
            for i in range(4):
                fresh = _turn(lanes[i], eight[np.where(on, where + 32 * step + 8 * i, 0)])
                lanes[i] = np.where(on, fresh, lanes[i])
        mixed = _rotl(lanes[0], 1) + _rotl(lanes[1], 7) + _rotl(lanes[2], 12) + _rotl(lanes[3], 18)
        for lane in lanes:
            mixed = (mixed ^ _turn(np.zeros_like(lane), lane)) * P1 + P4
        acc[wide] = mixed
        at[wide] += 32 * stripes
        left[wide] -= 32 * stripes
    acc += sizes[short].astype(np.uint64)
    for _ in range(3):
        on = np.flatnonzero(left >= 8)
        acc[on] = _rotl(acc[on] ^ _turn(np.zeros(len(on), np.uint64), eight[at[on]]), 27) * P1 + P4
        at[on] += 8
        left[on] -= 8
    on = np.flatnonzero(left >= 4)
    acc[on] = _rotl(acc[on] ^ (four[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
    at[on] += 4
    left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(left > 0)
        acc[on] = _rotl(acc[on] ^ (padded[at[on]].astype(np.uint64) * P5), 11) * P1
        at[on] += 1
        left[on] -= 1
    acc = (acc ^ (acc >> np.uint64(33))) * P2
    acc = (acc ^ (acc >> np.uint64(29))) * P3
    out[short] = acc ^ (acc >> np.uint64(32))
    return out


def majority(hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row the bits set in over half of its hashes. Eight bits are counted at once, up to 255 hashes in a byte each."""
    votes = np.zeros((n_rows, 64), np.int64)
    if len(hashes):
        first = B.row_bounds(rows, n_rows)
        place = np.arange(len(hashes)) - first[rows]
        cuts = np.flatnonzero(place % 255 == 0)
        owner = rows[cuts]
        fresh = np.r_[True, owner[1:] != owner[:-1]]
        for bit in range(8):
            lanes = (hashes >> np.uint64(bit)) & np.uint64(0x0101010101010101)
            counts = np.add.reduceat(lanes, cuts).astype("<u8").view(np.uint8).reshape(-1, 8)
            votes[owner[fresh], bit::8] = np.add.reduceat(counts, np.flatnonzero(fresh), axis=0, dtype=np.int64)
        total = np.diff(first)
        won = 2 * votes > total[:, None]
    else:
        won = votes > 0
    return (won.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def fingerprints_of(piece: B.Piece, k: int = WORDS) -> np.ndarray:
    """Fingerprint of every text of a piece."""
    n = piece.last - piece.first
    data = B.LOWER[piece.data]
    starts, ends, rows = B.spans(data, piece.offsets, B.SPACED)
    if not len(starts):
        return np.zeros(n, np.uint64)
    # words side by side, one space behind each
    sizes = ends - starts
    moved = np.r_[0, np.cumsum(sizes + 1)]
    joined = np.full(moved[-1], 32, np.uint8)
    joined[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = data[B.SPACED[data]]
    bounds = B.row_bounds(rows, n)
    last = np.minimum(np.arange(len(starts)) + k, bounds[rows + 1]) - 1
    full = (last - np.arange(len(starts)) == k - 1) | (np.arange(len(starts)) == bounds[rows])
    begin = np.flatnonzero(full)
    return majority(xxh64_spans(joined, moved[begin], moved[last[begin]] + sizes[last[begin]]), rows[begin], n)


def fingerprints(documents: DataFrame, k: int = WORDS) -> DataFrame:
    """(doc_id, bits): the fingerprint of every row as a signed number."""
    texts = documents.select("doc_id", "text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in B.pieces(batch.column("text")):
                ids = batch.column("doc_id").slice(p.first, p.last - p.first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(fingerprints_of(p, k).view(np.int64))], ["doc_id", "bits"])

    return texts.mapInArrow(scan, T.StructType([texts.schema["doc_id"], T.StructField("bits", T.LongType())]))


def ring(segments: int = SEGMENTS) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def chain_mask(start: int, length: int, segments: int = SEGMENTS) -> int:
    """Bits of ``length`` consecutive segments of the ring."""
    return sum(((1 << width) - 1) << at for at, width in (ring(segments)[(start + i) % segments] for i in range(length)))


def allowed_changes(start: int, length: int = CHAIN, segments: int = SEGMENTS, radius: int = RADIUS) -> list[int]:
    """Every change of a chain's bits that keeps all its budgets, the empty one first."""
    found = [(0, 0)]
    for i in range(length):
        at, width = ring(segments)[(start + i) % segments]
        budget = (i + 1) * radius // segments
        found = [(mask | sum(1 << (at + b) for b in bits), used + n) for mask, used in found for n in range(budget - used + 1)
                 for bits in combinations(range(width), n)]
    return sorted(mask for mask, _ in found)


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >= 1 << 63 else bits


def _differ(a: str, b: str, mask: int = (1 << 64) - 1) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)).bitwiseAND(F.lit(_signed(mask))))


def chain_holds(a: str, b: str, start: Column, chain: int = CHAIN, segments: int = SEGMENTS, radius: int = RADIUS) -> Column:
    """Whether the budgets of all chains from ``start`` that are longer than the join's hold, up to the whole ring."""
    held = F.lit(False)
    for first in range(segments):
        own = start == first
        for length in range(chain + 1, segments):
            own = own & (_differ(a, b, chain_mask(first, length, segments)) <= length * radius // segments)
        held = held | own
    return held & (_differ(a, b) <= radius)


def placed(nodes: DataFrame, chain: int = CHAIN, segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """(start, key, own, bits): where each fingerprint stands by its own bits, and by each change the budgets allow."""
    spots = [F.struct(F.lit(start).cast("byte").alias("start"),
                      F.col("bits").bitwiseAND(F.lit(_signed(chain_mask(start, chain, segments)))).bitwiseXOR(F.lit(_signed(change))).alias("key"),
                      F.lit(change == 0).alias("own"))
             for start in range(segments) for change in allowed_changes(start, chain, segments, radius)]
    return nodes.select("bits", F.inline(F.array(*spots)))


def _half_way(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Every bit pattern at most half the radius from each fingerprint."""
    masks = np.array([sum(1 << b for b in bits) for n in range(radius // 2 + 1) for bits in combinations(range(64), n)], np.uint64)
    for batch in batches:
        bits = batch.column("bits").to_numpy()
        for at in range(0, len(bits), 64):
            some = bits[at:at + 64]
            pattern = (some.view(np.uint64)[:, None] ^ masks[None, :]).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(pattern.view(np.int64)), pa.array(np.repeat(some, len(masks)))], ["pattern", "bits"])


def linked_fingerprints(nodes: DataFrame, chain: int = CHAIN, segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """(node, component) for the distinct fingerprints ``bits`` that are linked with any other; ``radius`` is even."""
    bucket = ["start", "key"]
    spots = placed(nodes, chain, segments, radius)
    # of two that meet, one stands there by its own bits
    shared = staged(spots.groupBy(*bucket).agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 AND own").select(*bucket), "shared")
    met = staged(spots.join(small_side(shared), bucket, "left_semi"), "met")
    owned = F.when(F.col("own"), F.col("bits"))
    ends = [F.min(owned), F.max(owned)]  # two members are two hubs, of more some are drawn
    draws = [F.min_by("bits", F.when(F.col("own"), F.xxhash64("bits", F.lit(turn)))) for turn in range(DRAWS)]
    hubs = staged(met.groupBy(*bucket).agg(F.count("*").alias("n"), F.count(owned).alias("n_own"), F.array_distinct(F.array(*ends, *draws)).alias("hubs")), "hubs")
    stars = met.join(hubs, bucket).select("start", "bits", F.explode("hubs").alias("hub")).where("bits <> hub").where(
        chain_holds("bits", "hub", F.col("start"), chain, segments, radius))
    parts = staged(connected_components(stars.select(F.col("bits").alias("a"), F.col("hub").alias("b"))), "parts")

    # buckets of several components in which one that stands by its own bits and another met no hub
    unmet = (F.col("n_own") > F.size("hubs")) & (F.col("n") > F.size("hubs") + 1)
    crowded = met.join(hubs.where(unmet).select(*bucket), bucket).select(*bucket, "bits")
    located = crowded.join(parts, crowded.bits == parts.node, "left").withColumn("component", F.coalesce("component", "bits")).drop("node")
    mixed = located.groupBy(*bucket).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select(*bucket)
    loose = located.join(mixed, bucket, "left_semi").select("bits").distinct()
    patterns = loose.mapInArrow(lambda batches: _half_way(batches, radius), "pattern long, bits long")
    # a pattern has 2,081 neighbours at most, so its window is small
    more = patterns.withColumn("a", F.min("bits").over(W.partitionBy("pattern"))).where("bits <> a").select("a", F.col("bits").alias("b"))
    known = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return connected_components(known.unionByName(more))


def simhash_components(documents: DataFrame, k: int = WORDS) -> DataFrame:
    """One row per row of ``documents``: doc_id, fingerprint, component_id."""
    rows = staged(fingerprints(documents, k), "fingerprints")
    # every fingerprint becomes some seventy rows further on, so they are dealt to all tasks
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nodes = staged(rows.groupBy("bits").agg(F.min("doc_id").alias("lowest")).repartition(tasks, "bits"), "nodes")
    parts = linked_fingerprints(nodes.select("bits"))
    grouped = nodes.join(parts, nodes.bits == parts.node, "left").withColumn("component", F.coalesce("component", "bits"))
    names = grouped.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = grouped.select("bits", "component").join(names, "component").select("bits", "component_id")
    return rows.join(named, "bits").select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
