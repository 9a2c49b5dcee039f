"""Ranked search against brute force, and the shard's blocks by themselves."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from tidemark.llm import lexical_search as L
from tidemark.session import staged

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    counted = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, wanted in asked.items():
        scores = []
        for d, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, score int, item_id string"),
            spark.createDataFrame([(i, t, 2.0) for i, t in items], "item_id long, text string, rank double"))


def corpus(rng, n=400):
    words = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(n)], words


@pytest.mark.parametrize("shard_docs, k", [(37, 5), (10_000, 50)])
def test_matches_brute_force(spark, shard_docs, k):
    rng = random.Random(1)
    docs, words = corpus(rng)
    docs += [(500, None), (501, ""), (502, "?! -"), (None, docs[3][1]), (3, "W1 w1-W1"), (600, "É wörter 12 w0"), (601, "w5 " * 50_000), *((700 + i, docs[9][1]) for i in range(80))]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)] + [(3, "w59 w1"), (20, None), (21, "unheard of"), (None, "w3, W4"), (22, "é 12")]
    d, q = frames(spark, docs, items)
    for blocks in (1_000_000, 10):
        got = L.search(staged(L.build_index(d, shard_docs, 3_000), "index"), q, k, blocks).collect()
        assert sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in got), key=str) == brute(docs, items, k)


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b")], [(1, "a")])
    assert [tuple(r) for r in L.rank_documents(docs, items).collect()] == brute([(1, "a b")], [(1, "a")])
    for d, q in ((docs.limit(0), items), (docs, items.limit(0))):
        out = L.rank_documents(d, q)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def packed(rng, n_docs=3_000):
    rows = [(t, d, rng.choice([1, 1, 2, 300, 70_000])) for t in (5, 9, 2**63 + 1) for d in sorted(rng.sample(range(n_docs), rng.randint(1, n_docs)))]
    rows.sort(key=lambda r: r[1])
    t, d, f = (np.array(c, x) for c, x in zip(zip(*rows), (np.uint64, np.int64, np.int64)))
    sizes = np.array([rng.randint(1, 90_000) for _ in range(n_docs)])
    row = L.pack(t, d, f, sizes)
    return rows, sizes, L.Shard({**row, "payload": row["payload"].tobytes()}, 50_000, 9_000_000)


def test_blocks_unpack_and_bound_their_postings():
    rng = random.Random(2)
    rows, sizes, shard = packed(rng)
    for place, term in enumerate((5, 9, 2**63 + 1)):
        docs, values = shard.unpack_all(place)
        own = [(d, f) for t, d, f in rows if t == term]
        assert docs.tolist() == [d for d, _ in own]
        assert values.tolist() == L.impacts(np.array([f for _, f in own]), sizes[docs], 50_000, 9_000_000).tolist()
        for b in range(shard.first_block[place], shard.first_block[place + 1]):
            assert (shard.unpack(place, b)[1] <= shard.block_bound[b]).all()


def test_blocks_are_rejected_before_they_are_unpacked():
    """A list that cannot lift a document over the threshold stays packed where its block maxima say so."""
    n = 5_000
    rare, common = np.arange(0, n, 50), np.arange(n)
    docs = np.r_[rare, common]
    tfs = np.r_[np.full(len(rare), 9), np.ones(n, np.int64)]
    order = np.argsort(docs, kind="stable")
    row = L.pack(np.r_[np.full(len(rare), 1, np.uint64), np.full(n, 2, np.uint64)][order], docs[order], tfs[order], np.full(n, 100))
    shard = L.Shard({**row, "payload": row["payload"].tobytes()}, n, 100 * n)
    found, scores = shard.best(np.array([1, 2]), np.array([6_000, 10]), 10, 0)
    assert len(found) == len(rare) and len(set(scores.tolist())) == 1  # all tie, so none may go
    top = int(scores[0])
    shard.opened.clear(), shard.whole.clear()
    found, _ = shard.best(np.array([1, 2]), np.array([6_000, 10]), 10, top + 1)
    assert not len(found) and not [b for b in shard.opened if b >= shard.first_block[1]]


def test_packing_holds_few_bytes_a_posting_and_unpacks_to_them():
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.integers(0, 4_000, 700_000) * (1 << 40) + rng.integers(0, 50_000, 700_000))
    docs, terms = (pairs >> 40).astype(np.int32), (pairs & ((1 << 40) - 1)).astype(np.uint64)
    tfs, sizes = rng.integers(1, 70_000, len(pairs)).astype(np.int32), rng.integers(1, 900, 4_000)
    tracemalloc.start()
    made = L.pack(terms, docs, tfs, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 * len(pairs)
    shard = L.Shard(made, 4_000, 1_000_000)
    order = np.argsort(terms, kind="stable")
    heads = np.r_[0, np.cumsum(made["counts"])]
    for place in range(0, len(made["terms"]), 999):
        held, values = shard.unpack_all(place)
        own = order[heads[place]:heads[place + 1]]
        assert np.array_equal(held, docs[own]) and np.array_equal(values, L.impacts(tfs[own].astype(np.int64), sizes[docs[own]], 4_000, 1_000_000))


def test_row_groups_of_the_written_index_hold_few_shards(spark):
    long = spark.range(0, 40, 1, 1).selectExpr("id", "repeat(sha2(string(id), 256), 4000) AS payload")
    held = staged(long, "index", **{**L._SHARD_GROUPS, "parquet.block.size": "300000"})
    assert held.count() == 40
    assert sum(pq.ParquetFile(f.removeprefix("file:")).metadata.num_row_groups for f in held.inputFiles()) > 10
