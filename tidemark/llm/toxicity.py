"""Toxicity scores from a weighted finite-state pattern grammar.

Words become symbols (insult, suspect, threat, target, negation, reporting), marks
end clauses. Small transducers rewrite the symbols of a clause one after another
and are composed into one table:

* negation turns an insult or a threat in its scope of three words into a denied one;
* reported speech turns those that follow in the clause into quoted ones;
* the target transducer notes whether the clause addresses somebody;
* the clause transducer emits, at the clause's end, the strongest pattern found.

A text's score is a logistic function of how often each pattern was emitted; an
insult inside "they said he is not an ..." thus counts by other weights than one
thrown at the reader. Insult stems and pattern weights are learned from labelled
texts: stems that occur in many different surroundings of toxic texts and hardly in
others join the fixed words below. Labels of texts whose crc32(doc_id) leaves 2
when divided by 4 are never used; lang, source and doc_id are no inputs of a score.

Learning uses at most SAMPLE labelled texts, the first by a hash of their id, read
as a table; scoring reads every whole text once.

Defined cases: a null or empty text gets the score of a text without patterns;
without labels the default weights hold; repeated labels of a text count once, the
larger one wins; repeated rows are scored alike; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import staged

#: Labelled texts that are read for learning, at most.
SAMPLE = 20_000
#: Stems that are learned, at most, best first.
STEMS = 1_000
#: Different neighbouring word pairs a stem must occur between in toxic texts.
SURROUNDINGS = 5
#: How much likelier a stem must be in a toxic text than in another.
LIKELIER = 12.0
THRESHOLD = 0.3
#: Words a negation reaches.
SCOPE = 3

#: Learned stems in fewer toxic texts than this are suspect words, not insults.
CERTAIN_TEXTS, CERTAIN_ODDS = 15, 60.0

OTHER, INSULT, SUSPECT, THREAT, TARGET, NEGATION, REPORT, END, DENIED, QUOTED = range(10)
GRAVE = (INSULT, SUSPECT, THREAT)
FIXED_WORDS = {
    INSULT: """idiot idiots idiotic moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns imbecile dumb dumbass
        bastard bitch asshole retard scumbag vermin idiote imbécile connard connasse crétin ordure salaud débile dummkopf arschloch blödmann
        trottel abschaum idiota imbécil estúpido estúpida gilipollas cabrón basura""",
    THREAT: "kill murder hurt stab strangle shoot destroy tuer frapper töten umbringen schlagen matar golpear",
    TARGET: "you your yours yourself u ur he she they him her them toi tu vous ton te du dich dir ihr euch sie tú usted ustedes te",
    NEGATION: "not no never isn't aren't wasn't weren't don't doesn't without hardly ne pas jamais nicht kein keine keiner nie ni nunca jamás",
    REPORT: "said says say told wrote quoted quote claims claimed called reported allegedly dit disait sagte sagt schrieb dijo dice escribió",
}
PATTERNS = ("insult_pile", "insult_at_target", "insult", "suspect", "threat_at_target", "threat", "quoted", "denied")
DEFAULT_WEIGHTS = np.array([-3.0, 4.0, 4.0, 3.5, 1.5, 2.5, 1.0, 0.3, 0.1])

_WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;:\n]")
_MARKS = ".!?;:\n"

Transducer = dict[tuple[int, int], tuple[int, int]]


def negation() -> Transducer:
    """State: words of scope left."""
    table = {}
    for left in range(SCOPE + 1):
        for symbol in range(10):
            state = SCOPE if symbol == NEGATION else 0 if symbol == END else max(left - 1, 0)
            out = DENIED if left and symbol in GRAVE else OTHER if symbol == NEGATION else symbol
            table[left, symbol] = (state, out)
    return table


def reporting() -> Transducer:
    """State 1 after a reporting word, to the clause's end."""
    table = {}
    for told in (0, 1):
        for symbol in range(10):
            state = 1 if symbol == REPORT else 0 if symbol == END else told
            out = QUOTED if told and symbol in GRAVE else OTHER if symbol == REPORT else symbol
            table[told, symbol] = (state, out)
    return table


def clause() -> Transducer:
    """State: strongest finding so far and whether a target was met; emits a pattern number + 1 at the end, else 0.

    Findings, weakest first: none, denied, quoted, threat, suspect word, insult, more than one of the last two.
    """
    emitted = [(0, 0), (8, 8), (7, 7), (6, 5), (4, 4), (3, 2), (1, 1)]
    finding = {DENIED: 1, QUOTED: 2, THREAT: 3, SUSPECT: 4, INSULT: 5}
    table = {}
    for state in range(2 * len(emitted)):
        found, met = divmod(state, 2)
        for symbol in range(10):
            if symbol == END:
                table[state, symbol] = (0, emitted[found][met])
            else:
                now = 6 if found >= 4 and symbol in (INSULT, SUSPECT) else max(found, finding.get(symbol, 0))
                table[state, symbol] = (now * 2 + (1 if symbol == TARGET else met), 0)
    return table


def compose(first: Transducer, second: Transducer) -> Transducer:
    """Feed the output of the first into the second; states are numbered as reached from (0, 0)."""
    symbols = sorted({symbol for _, symbol in first})
    numbers, todo, table = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        a, b = pair = todo.pop()
        for symbol in symbols:
            a2, middle = first[a, symbol]
            b2, out = second[b, middle]
            if (a2, b2) not in numbers:
                numbers[a2, b2] = len(numbers)
                todo.append((a2, b2))
            table[numbers[pair], symbol] = (numbers[a2, b2], out)
    return table


GRAMMAR = compose(compose(negation(), reporting()), clause())


class Lexicon(dict):
    """Symbol of each word: fixed words, then stems by their longest prefix; remembered within bounds."""

    def __init__(self, stems: dict[str, int]):
        super().__init__()
        self.fixed = {w: symbol for symbol, text in FIXED_WORDS.items() for w in text.split()} | {m: END for m in _MARKS}
        self.stems, self.lengths = stems, sorted({len(s) for s in stems})

    def __missing__(self, word: str) -> int:
        symbol = self.fixed.get(word, OTHER)
        if symbol == OTHER:
            grades = [self.stems[s] for s in (word + "$", *(word[:n] for n in self.lengths if len(word) >= n)) if s in self.stems]
            symbol = min(grades, default=OTHER)  # an insult before a suspect word
        if len(self) > 500_000:
            self.clear()
        self[word] = symbol
        return symbol


def pattern_counts(text: str, lexicon: Lexicon) -> list[int]:
    """How many clauses of a whole text emit each pattern."""
    counts = [0] * len(PATTERNS)
    symbols = [lexicon[w] for w in _WORDS.findall(text.lower())]
    if not any(grave in symbols for grave in GRAVE):
        return counts
    state = 0
    for symbol in [*symbols, END]:
        state, out = GRAMMAR[state, symbol]
        if out:
            counts[out - 1] += 1
    return counts


def _stems_of(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in (4, 5, 6, 7) if len(word) >= n)]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch.column("text").to_pylist()]


def _toxic_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stems of toxic texts: texts that have them, and some of their surroundings."""
    texts: Counter = Counter()
    around: dict[str, set[int]] = defaultdict(set)
    for batch in batches:
        for text in _texts(batch):
            words = _WORDS.findall(text.lower())
            mine = set()
            for i, word in enumerate(words):
                if len(word) < 4:
                    continue
                nearby = zlib.crc32(" ".join(words[max(i - 1, 0):i + 2:2]).encode())
                for stem in _stems_of(word):
                    mine.add(stem)
                    if len(around[stem]) < 4 * SURROUNDINGS:
                        around[stem].add(nearby)
            texts.update(mine)
    stems = list(texts)
    yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([texts[s] for s in stems], pa.int64()),
                                      pa.array([list(around[s]) for s in stems], pa.list_(pa.int64()))], ["stem", "toxic_texts", "around"])


def learn_stems(sample: DataFrame) -> dict[str, int]:
    """Stems, and the symbol of each, whose odds of standing in a toxic text are LIKELIER or more, from (text, toxic) rows."""
    toxic, clean = sample.where("toxic = 1"), sample.where("toxic = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    found = toxic.select("text").mapInArrow(_toxic_stems, "stem string, toxic_texts long, around array<long>")
    support = found.groupBy("stem").agg(F.sum("toxic_texts").alias("t"), F.size(F.array_distinct(F.flatten(F.collect_list("around")))).alias("around"))
    candidates = staged(support.where((F.col("around") >= SURROUNDINGS) & (F.col("t") >= 4)).orderBy(F.desc("t"), "stem").limit(50_000), "stems")
    wanted = sample.sparkSession.sparkContext.broadcast({r.stem for r in candidates.select("stem").toLocalIterator()})

    def clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: Counter = Counter()
        for batch in batches:
            for text in _texts(batch):
                texts.update({s for w in set(_WORDS.findall(text.lower())) if len(w) >= 4 for s in _stems_of(w)} & wanted.value)
        yield pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64())], ["stem", "n"])

    others = clean.select("text").mapInArrow(clean_counts, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("c"))
    odds = ((F.col("t") + 0.5) / (n_toxic + 1)) / ((F.coalesce("c", F.lit(0)) + 0.5) / (n_clean + 1))
    best = candidates.join(others, "stem", "left").where(odds >= LIKELIER).orderBy(F.desc(F.col("t") * F.log(odds)), "stem").limit(STEMS)
    certain = (F.col("t") >= CERTAIN_TEXTS) & (odds >= CERTAIN_ODDS)
    return {r.stem: r.symbol for r in best.select("stem", F.when(certain, INSULT).otherwise(SUSPECT).alias("symbol")).collect()}


def fit_weights(counts: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Logistic weights of log(1 + count), by Newton steps from the defaults and drawn towards them."""
    if not len(toxic) or not toxic.any() or toxic.all():
        return DEFAULT_WEIGHTS.copy()
    # sorted, so that the order in which tasks deliver rows does not show in the last digits
    order = np.lexsort([*counts.T, toxic])
    counts, toxic = counts[order], toxic[order]
    x = np.c_[np.ones(len(counts)), np.log1p(counts)]
    w, pull = DEFAULT_WEIGHTS.copy(), np.r_[0.01, np.full(len(PATTERNS), 0.5)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - toxic) + pull * (w - DEFAULT_WEIGHTS)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def held_out(doc_id: Column) -> Column:
    """Labels that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(documents: DataFrame, labels: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Insult stems and pattern weights from a bounded sample of labelled texts."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = staged(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"), "labelled")
    stems = learn_stems(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in batches:
            found = np.array([pattern_counts(t, lexicon) for t in _texts(batch)], np.int64).reshape(-1, len(PATTERNS))
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), *(pa.array(found[:, i]) for i in range(len(PATTERNS)))], ["toxic", *PATTERNS])

    table = sample.select("text", "toxic").mapInArrow(count, "toxic int, " + ", ".join(f"{p} long" for p in PATTERNS)).toArrow()
    return stems, fit_weights(np.stack([table[p].to_numpy() for p in PATTERNS], 1), table["toxic"].to_numpy())


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the number of clauses of each pattern; one row per row of ``documents``."""
    stems, weights = learn(documents, labels)
    schema = T.StructType([documents.schema["doc_id"], T.StructField("score", T.DoubleType()), *(T.StructField(p, T.LongType()) for p in PATTERNS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(stems)
        for batch in batches:
            found = np.array([pattern_counts(t, lexicon) for t in _texts(batch)], np.int64).reshape(-1, len(PATTERNS))
            score = 1 / (1 + np.exp(-np.clip(weights[0] + np.log1p(found) @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), *(pa.array(found[:, i]) for i in range(len(PATTERNS)))],
                                             schema.fieldNames())

    scored = documents.select("doc_id", "text").mapInArrow(scan, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), *PATTERNS)
