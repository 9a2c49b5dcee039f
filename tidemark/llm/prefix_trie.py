"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

1. Turns are numbered within their conversation and conversations rebuilt: the first
   turns of the opening conversation of their block of BLOCK, then their own.
2. A node is a distinct sequence of first turns. It is known by two 64-bit numbers,
   each the exclusive or of a hash of every turn with its position, so the prefixes of
   a conversation are running totals: no list of turns is built, and long
   conversations are summed slice by slice.
3. Subtree totals: in rounds, all leaves are raked into their parents (a grouped sum),
   and nodes with one child left are cut out of their chains (a join of parent and
   child). A node is cut when its depth is divisible by a lower power of two than its
   parent's, and by none higher than its child's; of two neighbours one at most is cut,
   and a plain chain halves in each round. Cut nodes come back in reverse order, each
   from its child's total. Rounds grow with the logarithm of the depth.
4. The ids that end at a node are joined in slices of SLICE, then hashed in order by a
   task that holds one slice at a time.

Defined cases: rows with a null conv_id belong to no conversation; a null role or text
is empty; turns with the same number, null first, follow by role and text; a rebuilt
conversation without turns is a member of the root alone; an empty table gives no
node; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from tidemark.functions.stats import number_rows
from tidemark.session import staged

#: Conversations that share an opening, and turns of it that they take at most, less one.
BLOCK, OPENINGS = 20, 4
#: Turns summed, and ids joined, in one group.
SLICE = 1024


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, words): turns in order from 1, two hashes of role and text, and the text's words."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    numbered = number_rows(turns, ["conv_id"], order, F.coalesce(F.expr(f"turn div {SLICE}"), F.lit(-(1 << 62))), "pos")
    return numbered.select("conv_id", F.col("pos").cast("long").alias("pos"), F.xxhash64(F.lit(1), "role", "text").alias("t1"),
                           F.xxhash64(F.lit(2), "text", "role").alias("t2"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def shared_openings(turns: DataFrame, block: int = BLOCK, openings: int = OPENINGS) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, length, pos, t1, t2, words), and every conversation (conv_id, length)."""
    sizes = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    opened = sizes.select("conv_id", "n", (F.col("conv_id") - F.col("conv_id") % block).alias("opening"),
                          (F.crc32(F.col("conv_id").cast("string")) % openings).alias("h"))
    lengths = sizes.select(F.col("conv_id").alias("opening"), F.col("n").alias("opening_n"))
    taken = F.least("h", F.coalesce("opening_n", F.lit(0)))
    plan = opened.join(lengths, "opening", "left").select("conv_id", "opening", "h", taken.alias("taken"),
                                                          (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    plan = staged(plan, "plan")
    heads = turns.where(F.col("pos") < openings).select(F.col("conv_id").alias("opening"), "pos", "t1", "t2", "words")
    inherited = plan.join(heads, "opening").where("pos <= h").select("conv_id", "length", "pos", "t1", "t2", "words")
    own = turns.join(plan, "conv_id").where("pos > h").select("conv_id", "length", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "t1", "t2", "words")
    return inherited.unionByName(own), plan.select("conv_id", "length")


def prefixes(turns: DataFrame) -> DataFrame:
    """Each turn with ``node``, the key of the sequence up to it, and ``parent``, that of the sequence before it."""
    hashes = [F.xxhash64(F.lit(3), "pos", "t1", "t2").alias("g1"), F.xxhash64(F.lit(4), "pos", "t2", "t1").alias("g2")]
    sliced = turns.select("conv_id", "length", "pos", "words", *hashes, F.expr(f"pos div {SLICE}").alias("slice"))
    before = W.partitionBy("conv_id").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    totals = sliced.groupBy("conv_id", "slice").agg(F.bit_xor("g1").alias("s1"), F.bit_xor("g2").alias("s2")).select(
        "conv_id", "slice", *(F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2)))
    upto = W.partitionBy("conv_id", "slice").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    running = sliced.withColumns({f"r{i}": F.bit_xor(f"g{i}").over(upto) for i in (1, 2)}).join(totals, ["conv_id", "slice"])
    here = [F.col(f"r{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return running.select("conv_id", "length", F.col("pos").alias("depth"), "words", F.struct(here[0].alias("h1"), here[1].alias("h2")).alias("node"),
                          F.struct(here[0].bitwiseXOR(F.col("g1")).alias("h1"), here[1].bitwiseXOR(F.col("g2")).alias("h2")).alias("parent"))


def _low_bit(depth: str) -> Column:
    return F.when(F.col(depth) == 0, F.lit(1 << 62)).otherwise(F.col(depth).bitwiseAND(-F.col(depth)))


def subtree_totals(tree: DataFrame, values: list[str]) -> DataFrame:
    """(node, *values) summed over every node's subtree, by rounds of rake and compress.

    ``tree`` has node, parent (null for a root), depth (edges above it) and the values, which are whole numbers.
    """
    edges = [f"{v}_edge" for v in values]  # what nodes cut out above a node, up to its present parent, add
    kids = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("kids"))
    live = staged(tree.join(kids, "node", "left").select(
        "node", "parent", "depth", (F.col("depth") - 1).alias("above"), F.coalesce("kids", F.lit(0)).alias("kids"),
        *(F.col(v).cast("long").alias(v) for v in values), *(F.lit(0).cast("long").alias(e) for e in edges)), "live")
    raked, cuts = [], []
    while True:
        leaves = live.where("kids = 0")
        raked.append(leaves.select("node", *values))
        inner = live.where("kids > 0")
        if inner.isEmpty():
            break
        gains = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("gone"), *(F.sum(F.col(v) + F.col(e)).alias(f"{v}_gain") for v, e in zip(values, edges)))
        pruned = staged(inner.join(gains, "node", "left").select(
            "node", "parent", "depth", "above", (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
            *((F.col(v) + F.coalesce(f"{v}_gain", F.lit(0))).alias(v) for v in values), *edges), "pruned")
        # the one child left of a node with one, unless that is a leaf by now
        child = pruned.where("kids > 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.min(F.struct(F.col("depth").alias("below"), F.col("node").alias("child"), *(F.col(e).alias(f"child_{e}") for e in edges))).alias("c")).select("node", "c.*")
        cut = staged(pruned.where((F.col("kids") == 1) & F.col("parent").isNotNull() & (_low_bit("depth") < _low_bit("above"))).join(child, "node").where(
            _low_bit("depth") <= _low_bit("below")), "cut")
        cuts.append(cut.select("node", "child", *((F.col(v) + F.col(f"child_{e}")).alias(v) for v, e in zip(values, edges))))
        spliced = cut.select(F.col("child").alias("node"), F.col("parent").alias("new_parent"), F.col("above").alias("new_above"),
                             *((F.col(v) + F.col(e)).alias(f"{e}_gain") for v, e in zip(values, edges)))
        moved = F.col("new_above").isNotNull()
        live = staged(pruned.join(cut.select("node"), "node", "left_anti").join(spliced, "node", "left").select(
            "node", F.when(moved, F.col("new_parent")).otherwise(F.col("parent")).alias("parent"), "depth",
            F.when(moved, F.col("new_above")).otherwise(F.col("above")).alias("above"), "kids", *values,
            *((F.col(e) + F.coalesce(f"{e}_gain", F.lit(0))).alias(e) for e in edges)), "live")
    # a cut node's child goes in a later round, so only what those rounds know is joined
    later, known = raked[-1], [*raked]
    for round_, cut in reversed(list(enumerate(cuts))):
        child = later.select(F.col("node").alias("child"), *(F.col(v).alias(f"{v}_below") for v in values))
        back = staged(cut.join(child, "child").select("node", *((F.col(v) + F.col(f"{v}_below")).alias(v) for v in values)), "back")
        known.append(back)
        later = later.unionByName(back).unionByName(raked[round_])
    return reduce(DataFrame.unionByName, known)


def _hash_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's slices, which come in order, joined by commas."""
    names = ["h1", "h2", "ends_sha256"]
    current, digest = None, None
    for batch in batches:
        out: list[tuple] = []
        for key, ids in zip(zip(batch.column("h1").to_pylist(), batch.column("h2").to_pylist()), batch.column("ids").to_pylist()):
            if key == current:
                digest.update(b"," + ids.encode())
                continue
            if current is not None:
                out.append((*current, digest.hexdigest()))
            current, digest = key, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*current, digest.hexdigest())], names)


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids of (node, conv_id) in ascending order, joined by commas."""
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    slices = ends.groupBy("node", F.expr(f"conv_id div {SLICE}").alias("slice")).agg(ids.alias("ids"))
    inside = slices.select("node.*", "slice", "ids").repartition("h1", "h2").sortWithinPartitions("h1", "h2", "slice").select("h1", "h2", "ids")
    return inside.mapInArrow(_hash_slices, "h1 long, h2 long, ends_sha256 string").select(F.struct("h1", "h2").alias("node"), "ends_sha256")


def trie(conversations: DataFrame, block: int = BLOCK, openings: int = OPENINGS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = shared_openings(staged(numbered_turns(conversations), "turns"), block, openings)
    root = F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"))
    tops = convs.select("conv_id", "length", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"), root.alias("node"))
    members = staged(prefixes(turns).unionByName(tops, allowMissingColumns=True), "members")
    nodes = staged(members.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("words").alias("words"),
        F.count("*").alias("n_convs")), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    counted = staged(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "counted")
    totals = subtree_totals(counted.select("node", "parent", "depth", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                           ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), ["n_leaves", "saved_tokens"])
    ends = ends_digest(members.where("depth = length").select("node", "conv_id"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return counted.join(above, "parent", "left").join(totals, "node").join(ends, "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


ORACLE_SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
-- CRC-32 of the decimal id: nine steps a character, the character itself and eight shifts
s AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR) AS id, 0 AS i, CAST(4294967295 AS BIGINT) AS x FROM c
  UNION ALL
  SELECT conv_id, id, i + 1, CASE WHEN i % 9 = 0 THEN xor(x, CAST(ascii(substr(id, CAST(i // 9 + 1 AS INTEGER), 1)) AS BIGINT))
                                  ELSE xor(x >> 1, 3988292384 * (x & 1)) END
  FROM s WHERE i < 9 * length(id)),
h AS (SELECT conv_id, conv_id - conv_id % 20 AS opening, xor(x, 4294967295) % 4 AS h FROM s WHERE i = 9 * length(id)),
p AS (SELECT h.conv_id, h.opening, h.h, least(h.h, coalesce(c.n, 0)) AS taken FROM h LEFT JOIN c ON c.conv_id = h.opening),
r AS (
  SELECT p.conv_id, t.pos, t.role, t.text FROM p JOIN t ON t.conv_id = p.opening AND t.pos <= p.h
  UNION ALL SELECT t.conv_id, t.pos - p.h + p.taken, t.role, t.text FROM t JOIN p ON p.conv_id = t.conv_id WHERE t.pos > p.h),
m AS (
  SELECT conv_id, pos AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY pos) AS node
  FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
l AS (SELECT conv_id, max(depth) AS depth FROM m GROUP BY conv_id),
n AS (SELECT node, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words FROM m GROUP BY node),
u AS (SELECT n.*, m.node AS parent FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1),
k AS (SELECT parent AS node, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
v AS (SELECT u.*, coalesce(k.n_children, 0) AS n_children FROM u LEFT JOIN k ON k.node = u.node),
a AS (
  SELECT m.node, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
  FROM v JOIN m ON m.conv_id = v.conv_id AND m.depth <= v.depth GROUP BY m.node),
e AS (SELECT m.node, string_agg(CAST(m.conv_id AS VARCHAR), ',' ORDER BY m.conv_id) AS ids FROM m JOIN l ON l.conv_id = m.conv_id AND l.depth = m.depth GROUP BY m.node)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, q.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves,
       CAST(a.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM v JOIN a ON a.node = v.node LEFT JOIN n q ON q.node = v.parent LEFT JOIN e ON e.node = v.node
"""
