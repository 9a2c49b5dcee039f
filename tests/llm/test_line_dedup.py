"""Line deduplication against a quadratic version."""

import random
import re

import pytest

from tidemark.llm import line_dedup


def brute(texts: list[tuple], need: int) -> list:
    """Mark every window of at least ``need`` words, shortest from either side, that was seen earlier."""
    tables = []
    for doc, text in texts:
        lines = [] if text is None else text.split("\n")
        tables.append([(i, line.strip(" \t\n\r\f\v"), len(re.findall(r"[^\x20\x09-\x0d]+", line))) for i, line in enumerate(lines) if line.strip(" \t\n\r\f\v")])
    order = sorted(range(len(texts)), key=lambda j: (texts[j][0] is None, texts[j][0]))
    first, marked = {}, [set() for _ in texts]
    for j in order:
        rows = tables[j]
        found = []
        for a in range(len(rows)):
            for b in range(a + 1, len(rows) + 1):
                total = sum(r[2] for r in rows[a:b])
                if total >= need and (total - rows[b - 1][2] < need or total - rows[a][2] < need):
                    found.append((a, b))
        for a, b in sorted(found):
            content = tuple(r[1] for r in rows[a:b])
            if content in first:
                marked[j].update(r[0] for r in rows[a:b])
            else:
                first[content] = (j, a)
    return [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in m) for (_, t), m in zip(texts, marked)]


def run(spark, texts, need):
    frame = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(texts)], "doc_id long, text string, removed int")
    rows = line_dedup.drop_repeated_lines(frame, need).collect()
    return [r.text for r in sorted(rows, key=lambda r: r.removed)]


def test_random_corpora_match_brute_force(spark):
    rng = random.Random(5)
    lines = ["", " ", "a b c", "d e f g h i j k", "x", "y z", "  a b c ", "l m n o p q r s t u v w", "é ü", "a\u00a0b c d"]
    texts = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(60)]
    for need in (1, 5, 9):
        assert run(spark, texts, need) == brute(texts, need)


def test_passage_stays_once_and_clean_text_is_untouched(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    texts = [(3, f"own three\n{passage}\nend"), (1, f"{passage}"), (2, "nothing shared\n\n tail "), (None, f"{passage}\nlast"), (4, None), (5, "")]
    assert run(spark, texts, 20) == ["own three\nend", passage, "nothing shared\n\n tail ", "last", None, ""]


def test_repeated_rows_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    assert run(spark, [(1, text), (1, text)], 20) == [text, text]
    empty = spark.createDataFrame([], "doc_id long, text string, n_chars int, lang string")
    out = line_dedup.drop_repeated_lines(empty)
    assert out.columns == empty.columns and out.count() == 0


@pytest.mark.parametrize("n", [3000])
def test_long_text(spark, n):
    text = "\n".join(f"line number {i} of a long text with ten words" for i in range(n))
    assert run(spark, [(1, text), (2, text + "\nfresh")], 20) == [text, "fresh"]
