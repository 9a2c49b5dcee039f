"""Near-duplicate components against brute force on full sets."""

import random
import re

import pytest

from tidemark.llm import near_duplicates as N
from tidemark.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def grams(text, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} - {()} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(texts, k, percent=80):
    sets = [grams(t, k) for _, t in texts]
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(texts):
        if d is not None:
            lowest[root(i)] = min(lowest.get(root(i), d), d)
    return sorted(((d, len(sets[i]), lowest.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(texts)), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for base in range(12):
        words = rng.choices(vocabulary, k=rng.choice([1, 2, 6, 40, 90]))
        for _ in range(rng.choice([1, 2, 9])):
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(copy) // 14))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("k", [2, 5])
def test_matches_brute_force(docs, k):
    texts = corpus(k) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "Single"), (1004, "sINGLE "), (None, "single"), (1003, "Single")]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicate_components(docs(*texts), k).collect()]
    assert sorted(got, key=str) == brute(texts, k)


def test_chain_of_links_between_a_hub_and_its_neighbours(docs):
    """A slides into C by small steps: neighbours link, ends do not."""
    words = [f"t{i}" for i in range(200)]
    texts = [(i, " ".join(words[i * 5:i * 5 + 100])) for i in range(15)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in N.near_duplicate_components(docs(*texts), 2).collect()), key=str)
    assert got == brute(texts, 2) and {c for _, _, c in got} == {0}


def test_stage_keeps_one_of_each_group(docs):
    frame = docs((5, "a b c d"), (2, "A b c d"), (2, "A b c d"), (9, "other words here"), (11, None), (12, ""), (None, "a b  c d"))
    out = N.keep_first(frame, 2)
    assert out.columns == frame.columns and sorted(r.doc_id for r in out.collect()) == [2, 9, 11, 12]
    assert N.keep_first(frame.limit(0), 2).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
