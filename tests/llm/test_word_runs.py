"""Repeated runs of words inside lines against a plain version."""

import random
import re

from tidemark.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def brute(texts, need):
    """Words in windows of ``need`` words seen earlier, cut out line by line."""
    first, out = {}, {}
    for doc, text in sorted(texts):
        words, marked = WORD.findall(text), set()
        for a in range(len(words) - need + 1):
            at = first.setdefault(tuple(words[a:a + need]), (doc, a))
            if at != (doc, a):
                marked.update(range(max(a, at[1] + need) if at[0] == doc else a, a + need))
        lines, i = [], 0
        for line in text.split("\n"):
            own = WORD.findall(line)
            kept = [w for j, w in enumerate(own, i) if j not in marked]
            i += len(own)
            if kept or not own:
                lines.append(" ".join(kept))
        out[doc] = "\n".join(lines)
    return out


def run(spark, texts, need):
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    return {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(frame, 1_000_000, need).collect()}


def test_runs_inside_lines_match_brute_force(spark):
    rng = random.Random(3)
    sources = [[f"s{i}_{j}" for j in range(120)] for i in range(6)]
    texts = []
    for doc in range(60):
        words = []
        for _ in range(rng.randint(1, 6)):
            at, size = rng.randrange(100), rng.randint(1, 45)
            words += rng.choice(sources)[at:at + size] if rng.random() < 0.7 else [f"own{rng.randrange(4)}"] * rng.randint(1, 40)
        texts.append((doc, "".join(w + rng.choice("    \n") for w in words[:-1]) + words[-1]))
    for need in (5, 20):
        assert run(spark, texts, need) == brute(texts, need)


def test_passage_inside_a_line_and_an_edited_line(spark):
    passage = [f"w{i}" for i in range(60)]
    edited = passage[:30] + ["new"] + passage[31:]
    texts = [(1, "start " + " ".join(passage) + " end"), (2, "é own  " + " ".join(passage[5:]) + " tail\nlast "), (3, " ".join(edited)), (4, " ".join(passage[:19]))]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_lines_removed) for r in line_dedup.report(frame).collect()}
    assert got == {1: (texts[0][1], 1, 0), 2: ("é own  tail\nlast ", 2, 0), 3: ("new", 1, 0), 4: (texts[3][1], 1, 0)}


def test_many_repeated_anchors_are_joined_by_a_shuffle_with_the_same_result(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(90)]
    texts = [(d, " ".join(rng.choices("abcdefg", k=rng.randint(0, 30)) + passage[rng.randrange(40):rng.randint(50, 90)] * rng.randint(0, 2))) for d in range(50)]
    frame = spark.createDataFrame([*texts, *texts[:3]], "doc_id long, text string")
    spans = [sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in line_dedup.repeated_words(frame, 20, n).collect()) for n in (2_000_000, 0)]
    assert spans[0] == spans[1] and len(spans[0]) > 20
