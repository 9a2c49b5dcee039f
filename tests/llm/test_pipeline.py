"""The pipeline, stage by stage and as a whole, against plain versions on the smallest tables."""

import hashlib
import os
import re
from collections import defaultdict

import pytest

import corpus_pipeline
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_near_duplicates import brute as components
from tidemark.llm import language_model, line_dedup
from tidemark.llm.registry import tokenizer_path

SMALL = "/root/testdata/sf0.001"
tokenizers = pytest.importorskip("tokenizers")
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables absent")


def without_runs(texts, need):
    """Words in windows of ``need`` words seen earlier are cut with the white space behind them; lines of such words alone go."""
    first, out = {}, []
    for doc, text in sorted(texts):
        found = [m.span() for m in re.finditer(r"[^\x20\x09-\x0d]+", text)]
        words, marked = [text[a:b] for a, b in found], set()
        for a in range(len(words) - need + 1):
            at = first.setdefault(tuple(words[a:a + need]), (doc, a))
            if at != (doc, a):
                marked.update(range(max(a, at[1] + need) if at[0] == doc else a, a + need))
        lines, begin = [], 0
        for line in text.split("\n"):
            own = [i for i, (a, _) in enumerate(found) if begin <= a < begin + len(line)]
            kept = [i for i in own if i not in marked]
            if kept or not own:
                for i in reversed(own):  # from the end, so that places before stay
                    if i in marked:
                        behind = [j for j in kept if j > i]
                        cut = (found[i][0], found[i + 1][0]) if behind else (found[i - 1][1], found[i][1])
                        line = line[:cut[0] - begin] + line[cut[1] - begin:]
                lines.append(line)
            begin = text.index("\n", begin) + 1 if "\n" in text[begin:] else len(text)
        out.append((doc, "\n".join(lines)))
    return out


def test_whole_run_matches_plain_versions(spark):
    table = lambda t: spark.read.parquet(f"{SMALL}/{t}.parquet")
    good = {r.doc_id for r in language_model.classify(table("documents"), table("labels")).collect() if r.accepted}
    texts = sorted((r.doc_id, r.text) for r in table("documents").collect() if r.doc_id in good)
    before = dict(texts)
    texts = without_runs(texts, line_dedup.RUN_WORDS)
    assert sum(before[d] != t for d, t in texts) > 10
    firsts = {d for d, _, c in components(texts, 5) if d == c}
    texts = [(d, t) for d, t in texts if d in firsts]
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    bad = {row[0] for row in contaminated(texts, items) if row[5]}
    texts = [(d, t) for d, t in texts if d not in bad]
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = sorted((d, library.encode(t, add_special_tokens=False).ids, hashlib.sha256(t.encode()).hexdigest()) for d, t in texts)
    assert 100 < len(want) < 200
    got = sorted((r.doc_id, r.ids, r.decoded_sha256) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want


def test_stages_keep_columns_and_take_odd_rows(spark):
    rows = [(1, "good words " * 20, "en", "s", 220, 1), (1, "good words " * 20, "en", "s", 220, 1), (None, None, None, None, None, None), (2, "", "en", "s", 0, 5),
            (3, "long " * 30_000, "xx", "s", 150_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int, text_key int")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "near_dedup", "decontamination", "bpe"]
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SMALL)
            counts = defaultdict(int)
            for r in out.select("doc_id").collect():
                counts[r.doc_id] += 1
            if name != "bpe":
                assert out.columns == docs.columns
            if frame is docs and name in ("line_dedup", "bpe"):
                assert counts == {1: 2, None: 1, 2: 1, 3: 1}
            if frame is docs and name == "near_dedup":
                assert counts == {1: 1, None: 1, 2: 1, 3: 1}


def test_near_dedup_stage_takes_five_words(spark):
    """Five edits in a hundred words: near duplicates by two words, none by five."""
    words = [f"w{i}" for i in range(100)]
    edited = [f"x{i}" if i % 20 == 10 else w for i, w in enumerate(words)]
    texts = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[:99]))]
    assert {c for _, _, c in components(texts, 2)} == {1}
    assert [(d, c) for d, _, c in components(texts, 5)] == [(1, 1), (2, 2), (3, 1)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SMALL).collect()) == [1, 2]
