"""Decontamination against a brute-force scan, whole and in blocks."""

import hashlib
import random
import re

from tidemark.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in texts:
        w, hit, found = words(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i:i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(3)
    vocabulary = ["a", "b", "Cé", "d1", "e", "É", "x-y", "z.", "ß"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 5, 7, 9, 10, 11, 14]))) for i in range(14)] + [(None, "null item of six words here"), (99, None), (3, "repeated id")]
    texts = [(i, " ".join([text(rng.randint(0, 12)), rng.choice(items)[1] or "", text(rng.randint(0, 4))])) for i in range(50)]
    return texts + [(7, texts[7][1]), (None, "Null item OF six words here."), (60, None), (61, ""), (61, "a"), (62, "...")], items


def test_matches_brute_force(spark, docs):
    texts, items = cases()
    # single-word items would hit everything, so half the cases go without the shortest
    for chosen in (items, [x for x in items if len(words(x[1])) > 3]):
        bench = spark.createDataFrame(chosen, "item_id int, text string")
        for block in (D.BLOCK_WORDS, 15):
            got = D.digest(D.contamination(docs(*texts), bench, block)).collect()
            assert sorted(map(tuple, got), key=str) == brute(texts, chosen)


def test_stage_keeps_clean_rows_and_columns(spark, docs):
    item = "one two three four five six seven eight nine ten eleven"
    frame = docs((1, f"before {item.upper()} after"), (2, "clean text"), (None, None), (3, ""))
    out = D.remove_contaminated(frame, spark.createDataFrame([(1, item)], "item_id int, text string"))
    assert out.columns == frame.columns and sorted((r.doc_id for r in out.collect()), key=str) == [2, 3, None]


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "item_id int, text string")
    assert [r.n_hit for r in D.contamination(docs((1, "a b")), none).collect()] == [0]
    assert D.contamination(docs((1, "x")).limit(0), spark.createDataFrame([(1, "x")], none.schema)).count() == 0
