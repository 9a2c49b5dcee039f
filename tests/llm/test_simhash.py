"""SimHash fingerprints and components against brute force."""

import random
import re

import pyarrow as pa
import xxhash

from tidemark.llm import simhash as S
from tidemark.llm import textbytes as B

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(bits):
    """Component number of each fingerprint, by comparing all pairs."""
    group = list(range(len(bits)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(bits)):
        for j in range(i):
            if (bits[i] ^ bits[j]).bit_count() <= 4:
                group[root(i)] = root(j)
    return [root(i) for i in range(len(bits))]


def brute(rows):
    bits = [fingerprint(t) for _, t in rows]
    group = groups(bits)
    lowest = {}
    for g, (d, _) in zip(group, rows):
        if d is not None:
            lowest[g] = min(lowest.get(g, d), d)
    return sorted(((d, f"{b:016x}", lowest.get(g)) for b, g, (d, _) in zip(bits, group, rows)), key=str)


def run(frame):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.simhash_components(frame).collect()), key=str)


def test_fingerprints_of_all_lengths():
    rng = random.Random(1)
    texts = ["", " ", "a", "A b", "a b c", "a  b\nc D", "é" * 700] + [
        " ".join(rng.choice("xyzabé") * rng.randint(1, rng.choice([3, 9, 90, 400])) for _ in range(rng.randint(0, 700))) for _ in range(30)]
    for size in (1000, 1 << 20):
        got = [b for p in B.pieces(pa.array(texts), size) for b in S.fingerprints_of(p).tolist()]
        assert got == [fingerprint(t) for t in texts]


def test_every_near_pair_has_a_chain(spark):
    """All ways to differ in four bits of few places, and random ones, keep some chain's budgets."""
    rng = random.Random(2)
    changes = [sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}) for _ in range(3000)]
    for change in changes:
        holds = [s for s in range(S.SEGMENTS) if all((change & S.chain_mask(s, n)).bit_count() <= n * S.RADIUS // S.SEGMENTS for n in range(1, S.SEGMENTS + 1))]
        assert holds
        assert any(change & S.chain_mask(s, S.CHAIN) in set(S.allowed_changes(s)) for s in holds)


def test_matches_brute_force(docs):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(500)]
    texts = []
    for base in range(15):
        text = rng.choices(words, k=rng.choice([1, 3, 4, 30, 200]))
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(rng.randint(0, len(copy) // 25)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rows = list(enumerate(texts)) + [(900, None), (901, ""), (902, " \n"), (3, texts[3]), (None, texts[4]), (None, "alone in its group"), (950, "long text " * 40_000)]
    rng.shuffle(rows)
    assert run(docs(*rows)) == brute(rows)
    assert run(docs((1, "x")).limit(0)) == []


def test_dense_clusters_match_brute_force(spark):
    """Clouds of fingerprints around centres, in which most buckets hold several components."""
    rng = random.Random(4)
    bits = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(120):
            bits.add(centre ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 7))}))
        for step in range(12):  # a chain of small steps
            bits.add(centre := centre ^ (15 << (5 * step)))
    bits = sorted(bits)
    nodes = spark.createDataFrame([(S._signed(b),) for b in bits], "bits long")
    got = {r.node % (1 << 64): r.component for r in S.linked_fingerprints(nodes).collect()}
    group, want = groups(bits), {}
    for b, g in zip(bits, group):
        want.setdefault(g, set()).add(b)
    found = {}
    for b, c in got.items():
        found.setdefault(c, set()).add(b)
    assert sorted(map(sorted, found.values())) == sorted(sorted(m) for m in want.values() if len(m) > 1)
    assert any(len(m) == 1 for m in want.values())
