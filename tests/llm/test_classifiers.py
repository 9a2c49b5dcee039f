"""Toxicity, language model and quality rules: statistics against brute force, accuracy on held-out labels, edge cases."""

import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm import language_model as L
from tidemark.llm import quality_rules as Q
from tidemark.llm import textbytes as B
from tidemark.llm import toxicity as X
from tidemark.llm import word_model as W

SMALL = "/root/testdata/sf0.1"
given = pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables absent")


def held(doc):
    return zlib.crc32(str(doc).encode()) % 4 == 2


@given
def test_toxicity_on_held_out_labels(spark):
    frame, known = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in known.collect()}
    rows = [(truth[r.doc_id], r.predicted) for r in X.toxicity(frame, known).collect() if r.held_out and r.doc_id in truth]
    hits = sum(t and p for t, p in rows)
    assert hits >= 0.85 * sum(t for t, _ in rows) and hits >= 0.9 * sum(p for _, p in rows)


def test_toxicity_grammar():
    lexicon = X.Lexicon({"zork": X.INSULT, "blip$": X.SUSPECT})
    found = lambda text: {p: n for p, n in zip(X.PATTERNS, X.pattern_counts(text, lexicon)) if n}
    assert found("You are an idiot.") == {"insult_at_target": 1}
    assert found("Idiot! A clown; zorked") == {"insult": 3}
    assert found("stupid idiot") == {"insult_pile": 1}
    assert found("It is not an idiot.") == {"denied": 1}
    assert found("They said he is a moron") == {"quoted": 1}
    assert found("not now, or in a long while a moron") == {"insult": 1}
    assert found("I will kill you") == {"threat_at_target": 1} and found("a blip.\nfine") == {"suspect": 1}
    assert found("") == found("nothing here") == {}


def test_toxicity_edges(docs, labels):
    frame = docs((1, "you idiot"), (1, "you idiot"), (2, None), (3, ""), (None, "fine words"), (4, "word " * 30_000))
    rows = X.toxicity(frame, labels((1, 1, 1), (1, 1, 0), (None, 0, 1), (2, 1, 0)).limit(0)).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert {r.predicted for r in rows if r.doc_id == 1} == {1} and {r.predicted for r in rows if r.doc_id != 1} == {0}
    assert all(r.held_out == (r.doc_id is not None and held(r.doc_id)) for r in rows)
    assert X.toxicity(frame.limit(0), labels((1, 1, 1))).count() == 0


def test_labels_of_held_out_rows_change_nothing(docs, labels):
    ids = [i for i in range(200)]
    frame = docs(*((i, "zorky zorkly thing" if i % 3 == 0 else "plain thing") for i in ids))
    known = [(i, 1, int(i % 3 == 0)) for i in ids]
    flipped = [(i, 1, 1 - t if held(i) else t) for i, _, t in known]
    scores = [sorted((r.doc_id, r.score) for r in X.toxicity(frame, labels(*k)).collect()) for k in (known, flipped)]
    assert scores[0] == scores[1]


def brute_model(texts):
    """Interpolated modified Kneser-Ney over symbol strings, from plain dictionaries."""
    grams = collections.Counter()
    for text in texts:
        raw = text.encode()
        piece = B.Piece(0, 1, np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        for g in L.symbol_grams(piece)[0].tolist():
            grams[tuple(g >> 6 * k & 63 for k in (3, 2, 1, 0))] += 1
    tables = [dict(grams)]
    for _ in range(3):
        lower = collections.Counter(g[1:] for g in tables[-1])
        tables.append(dict(lower))
    tables.reverse()

    def discounts(table):
        n = [sum(c == k for c in table.values()) for k in range(5)]
        if not (n[1] and n[2] and n[3]):
            return (0.5, 0.5, 0.5)
        y = n[1] / (n[1] + 2 * n[2])
        return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k) for k in (1, 2, 3))

    ds = [discounts(t) for t in tables]

    def p(g):
        lower = p(g[1:]) if len(g) > 1 else 1 / 64
        table, d = tables[len(g) - 1], ds[len(g) - 1]
        same = {h: c for h, c in table.items() if h[:-1] == g[:-1]}
        total = sum(same.values())
        if not total:
            return lower
        cut = lambda c: d[min(c, 3) - 1]
        own = table.get(g, 0)
        return (own - cut(own) if own else 0) / total + sum(map(cut, same.values())) / total * lower

    return p


def test_model_equals_plain_dictionaries(docs):
    texts = ["the cat sat on the the mat.", "a cat, a hat; the bat sat", "Éa 12 ## | the the the", "then that other thing there"]
    table = L.dense(L.train(docs(*enumerate(texts))))
    p = brute_model(texts)
    rng = np.random.default_rng(1)
    some = [tuple(rng.integers(0, 12, 4).tolist()) for _ in range(60)] + [(0, 22, 10, 7), (22, 10, 7, 1), (7, 1, 42, 1), (63, 63, 63, 63)]
    for g in some:
        code = g[0] << 18 | g[1] << 12 | g[2] << 6 | g[3]
        assert abs(float(table[code]) - np.log(max(p(g), 1e-12))) < 1e-3, g
    assert abs(np.exp(table.reshape(-1, 64)[:4096].astype(float)).sum(1) - 1).max() < 1e-3


def brute_words(training, texts, least, frequent):
    """Mean surprise of the words of each text and of their order, their spreads and token counts, from plain dictionaries."""
    def shape(t):
        return ("CAPS" if "A" <= t[-1] <= "Z" and len(t) > 1 else "Cap") if "A" <= t[0] <= "Z" else "digit" if t[0] in "0123456789" else "far" if t[0] > "\x7f" \
            else "small" if "a" <= t[0] <= "z" else "mark"

    cut_up = lambda t: re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+|[^\s]", t or "")
    seen = collections.Counter(t for x in training for t in cut_up(x))
    known = {t for t, n in seen.items() if n >= least}
    tokens = lambda x: ["^"] + [("known", t) if t in known else shape(t) for t in cut_up(x)]
    pairs = collections.Counter(p for x in training for p in zip(tokens(x), tokens(x)[1:]))
    after = collections.Counter(b for _, b in pairs)

    def discount(table):
        n = [sum(c == k for c in table.values()) for k in range(5)]
        if not (n[1] and n[2] and n[3]):
            return lambda c: 0.5
        y = n[1] / (n[1] + 2 * n[2])
        d = [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.05), i) for i in (1, 2, 3)]
        return lambda c: d[min(c, 3) - 1]

    low, high = discount(after), discount(pairs)
    size = len(known) + W.SHAPES
    alone = lambda b: (after[b] - low(after[b]) if after[b] else 0) / sum(after.values()) + sum(map(low, after.values())) / sum(after.values()) / size

    def p(a, b):
        own = [c for (x, _), c in pairs.items() if x == a]
        if not own:
            return alone(b)
        return ((pairs[a, b] - high(pairs[a, b])) if pairs[a, b] else 0) / sum(own) + sum(map(high, own)) / sum(own) * alone(b)

    out = {}
    for doc, x in texts.items():
        t = tokens(x)
        if len(t) > 1:
            logs = [math.log(p(a, b)) for a, b in zip(t, t[1:])]
            order = [v - math.log(alone(b)) for v, b in zip(logs, t[1:])]
            out[doc] = (len(logs), -np.mean(logs), np.std(logs), -np.mean(order), np.std(order))
    return out


@pytest.mark.parametrize("frequent", [1, 8, 1 << 17])
def test_word_scores_equal_plain_dictionaries(docs, monkeypatch, frequent):
    """Whether bigrams count as frequent (sent to all tasks) or are joined, the result is the same."""
    monkeypatch.setattr(W, "FREQUENT_ONE_IN", frequent)
    training = ["The cat sat on the mat. The cat sat, the dog ran.", "A DOG ran to the mat; 12 cats sat on 7 mats.", "Éa the cat. The dog sat on the cat.\nThe end", ""] * 2
    texts = {1: training[0], 2: "mat the on sat cat the The", 3: "", 4: None, 5: " \n ", 6: "Zork 99 !! éé the", 7: "the cat " * 3_000, 8: training[0], None: "The dog"}
    model = W.WordModel(docs(*enumerate(training)))
    frame = docs(*texts.items(), (1, training[0]))  # one row twice
    rows = W.word_scores(frame.selectExpr("coalesce(doc_id, -1) AS key", "text"), model).collect()
    got = {None if r.key == -1 else r.key: (r.n_tokens, r.word_surprise, r.word_spread, r.order_surprise, r.order_spread) for r in rows}
    want = brute_words(training, texts, W.LEAST_SEEN, frequent)
    assert len(rows) == len(got) and got.keys() == want.keys() == {1, 2, 6, 7, 8, None}
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-5), key
    assert got[2][3] > got[1][3]


@pytest.mark.parametrize("frequent", [1, 1 << 17])
def test_bigrams_of_texts_are_looked_up_packed(docs, monkeypatch, frequent):
    """Many shards, rows of few bigrams and tasks that add up often give the same; no bigram of a text is a row of a join."""
    monkeypatch.setattr(W, "FREQUENT_ONE_IN", frequent)
    for name, value in (("SHARD_TOKENS", 256), ("ROW", 2), ("GATHERED", 7)):
        monkeypatch.setattr(W, name, value)
    dice = random.Random(3)
    training = [" ".join(dice.choice(["one", "two", "Three", "4", "é", "six", "x."]) for _ in range(60)) for _ in range(40)]
    texts = dict(enumerate(training[:20] + ["new words one two", "two one " * 2_000]))
    model = W.WordModel(docs(*enumerate(training)))
    assert model.shards_log > 3 and model.table.where("grams is not null").groupBy("shard").count().where("count > 1").count()
    scored = W.word_scores(docs(*texts.items()).selectExpr("doc_id AS key", "text"), model)
    assert "Join" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {r.key: (r.n_tokens, r.word_surprise, r.word_spread, r.order_surprise, r.order_spread) for r in scored.collect()}
    want = brute_words(training, texts, W.LEAST_SEEN, frequent)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=1e-5), key


def test_packed_numbers_are_small_and_come_back():
    gram = np.unique(np.random.default_rng(1).integers(0, 1 << 35, 50_000))
    packed = W._pack(np.diff(gram, prepend=0))
    assert (np.cumsum(W._unpack(packed)) == gram).all() and len(packed) < 4 * len(gram)
    for values in (np.zeros(0, np.int64), np.array([-1, 1 << 62, 0, -(1 << 63)])):
        assert W._unpack(W._pack(values)).tolist() == values.tolist()


def test_word_model_without_training_text(docs):
    model = W.WordModel(docs((1, "a b")).limit(0))
    assert [r.n_tokens for r in W.word_scores(docs((1, "a b c")).selectExpr("doc_id AS key", "text"), model).collect()] == [3]


@given
def test_shuffled_words_are_rejected(spark):
    """Trusted texts of 50 words or more, their words in random order: at most a tenth still passes, while the texts themselves do."""
    frame, known = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    trusted = frame.join(known.where("quality = 1"), "doc_id").select("doc_id", "text", "lang").where("text is not null").collect()
    shuffle = random.Random(5).shuffle
    mixed = []
    for r in trusted:
        words = r.text.split()
        if len(words) >= 50:
            shuffle(words)
            mixed.append((-1 - r.doc_id, " ".join(words), r.lang))
    both = frame.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(mixed, "doc_id long, text string, lang string"))
    passed = {r.doc_id for r in L.classify(both, known).where("accepted").select("doc_id").collect()}
    assert len(mixed) > 3000 and sum(d in passed for d, _, _ in mixed) <= 0.1 * len(mixed)
    assert sum(r.doc_id in passed for r in trusted) >= 0.995 * len(trusted)


@given
def test_quality_model_and_rules_follow_the_labels(spark):
    frame, known = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in known.collect()}
    for rows in ([(truth[r.doc_id], r.accepted) for r in L.classify(frame, known).collect() if r.doc_id in truth],
                 [(truth[r.doc_id], r.kept or r.n_words < 20) for r in Q.classify(frame, known).collect() if r.doc_id in truth]):
        good, bad = [k for q, k in rows if q], [k for q, k in rows if not q]
        assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.15 * len(bad)


def test_columns_named_like_the_models_own_are_left_alone(docs, labels):
    frame = docs((1, "some good text here"), (2, "other text")).selectExpr("*", "doc_id AS trusted_id", "1 AS surprise", "'x' AS limit_lang", "0 AS quality", "1 AS toxic")
    assert {r.doc_id for r in L.classify(frame, labels((1, 1, 0))).collect()} == {1, 2}
    kept = L.keep_accepted(frame, labels((1, 1, 0)))
    assert kept.columns == frame.columns and kept.count() == 2
    assert {r.doc_id for r in Q.classify(frame, labels((1, 1, 0), (2, 0, 0))).collect()} == {1, 2}


def test_model_edges(docs, labels):
    frame = docs((1, "some good text here"), (1, "some good text here"), (2, None), (3, ""), (None, "some good text"), (4, "x" * 100_000))
    rows = L.classify(frame, labels((1, 1, 0))).collect()
    assert sorted((str(r.doc_id), r.accepted) for r in rows if r.doc_id in (2, 3)) == [("2", False), ("3", False)] and len(rows) == 6
    kept = L.keep_accepted(frame, labels((1, 1, 0)).limit(0))
    assert kept.columns == frame.columns and kept.where("doc_id in (2, 3)").count() == 0 and kept.where("doc_id = 1").count() == 2
    assert L.keep_accepted(frame.limit(0), labels((1, 1, 0))).count() == 0


def test_tables_sent_to_tasks_are_taken_back(docs, labels, monkeypatch):
    """Later stages need the memory: no table stays with the executors after scoring."""
    sent, context = [], docs((1, "")).sparkSession.sparkContext
    send = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda value: sent.append(send(value)) or sent[-1])
    found = L.classify(docs((1, "some good text here"), (2, "other text")), labels((1, 1, 0)))
    assert len(sent) >= 5 and not any(b._jbroadcast.isValid() for b in sent)
    assert found.count() == 2 and {r.accepted for r in found.collect()} == {True}


def brute_statistics(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_statistics_match_brute_force(docs):
    eight = "a b c d e f g h"
    texts = [None, "", " \n\t", "one", eight, f"{eight} {eight}", f"x {eight} y {eight[2:]} a b", "a " * 40, "é ñ\x0b z\u00a0q #$%&|<>*\n\na\na\n b\nb ", f"{eight} i {eight} i {eight}",
             "line one\nline one\nline two\n\n\nline one", "w " * 9000 + " ".join(str(i) for i in range(9000)), "$1 \\ a.b*c"]
    rows = Q.statistics(docs(*enumerate(texts))).collect()
    for r in rows:
        want = brute_statistics(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])


def test_rules_edges(docs, labels):
    frame = docs((1, "word " * 3), (2, " ".join(f"w{i}" for i in range(30))), (None, None))
    rows = {r.doc_id: r.kept for r in Q.classify(frame, labels((1, 0, 0)).limit(0)).collect()}
    assert rows == {1: False, 2: True, None: False}
    assert Q.classify(frame.limit(0), labels((1, 0, 0))).count() == 0


def test_covering_finds_a_planted_rule():
    cells = [({"a": a, "b": b}, 5 if a > 1 and b <= 1 else 0, 0 if a > 1 and b <= 1 else 5) for a in range(4) for b in range(4)]
    conditions = [Q.Condition(n, i, float(i), above) for n in "ab" for i in range(4) for above in (True, False)]
    rules = Q.cover(cells, cells, conditions)
    assert [sorted(map(str, r)) for r in rules] == [["a > 1", "b <= 1"]]
