"""Quality rules: a learned decision list over text statistics.

Statistics of every whole text are Spark SQL expressions. From a bounded sample of
labelled texts, thresholds are taken at quantiles of each statistic, texts are
counted by the cells between thresholds, and sequential covering works on those
counts: a rule is grown by the condition that gains most on two thirds of the
sample, pruned on the last third, kept while it is right often enough there, and
what it covers is taken out before the next. The result is an ordered list
of readable conjunctions, applied as one conditional expression: the first rule that
fires rejects, otherwise the text is kept. Texts that fail the base checks are
rejected before any rule.

Nothing is shuffled when the list is applied, and repeated windows are found inside
the text's own row in n log n steps.

Defined cases: a null or empty text has no words, zero statistics and fails the base
checks; a text shorter than a window repeats none; without labels, or with one class
only, the list is empty and the base checks decide alone; repeated labels of a text
count once, the smaller quality wins; repeated rows give repeated rows; other
columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import staged

#: Labelled texts that are read for learning, at most.
SAMPLE = 20_000
#: Quantiles at which thresholds are tried.
CUTS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.8, 0.9, 0.93, 0.95, 0.97, 0.98, 0.99)
#: Share of rejected texts that must be rightly rejected, on the part held for pruning.
PRECISION = 0.9
#: Texts a rule must cover in the growing part, conditions it may have, rules a list may have.
COVER, CONDITIONS, RULES = 4, 3, 12
WINDOW = 8
SPACE = r"[\x20\x09-\x0D]+"

#: Statistics the rules are made of.
STATISTICS = ("n_words", "mean_word_chars", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "capital_share", "pipe_share", "shout_share", "digit_share")


def _count_of(members: str) -> Column:
    """Characters of the text that belong to a class."""
    return F.length(F.regexp_replace("text", f"[^{members}]+", "")).cast("long")


def _covered(places: Column) -> Column:
    """Words in the union of windows that start at the sorted places."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    add = lambda s, p: F.struct((p + WINDOW).alias("end"), (s["total"] + F.least(F.lit(WINDOW), p + WINDOW - s["end"])).alias("total"))
    return F.aggregate(places, zero, add, lambda s: s["total"])


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id, the counts of the base checks, base_failed, and the statistics of the rules; one row per row."""
    trimmed = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    read = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", words.alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counted = read.select(
        "doc_id", "words", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count_of(r"#*$%&|<>").alias("n_symbols"), lines.alias("lines"), _count_of("A-Z").alias("capitals"), _count_of("|").alias("pipes"),
        _count_of("!").alias("shouts"), _count_of("0-9").alias("digits"), F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    starts = F.sequence(F.lit(0), F.size("h") - WINDOW)
    windows = F.transform(starts, lambda i: F.xxhash64(*(F.get("h", i + k) for k in range(WINDOW))))
    hashed = counted.select("*", F.when(F.size("h") >= WINDOW, windows).otherwise(F.array().cast("array<long>")).alias("win"),
                            F.size(F.array_distinct("h")).alias("n_distinct"))
    # only texts with equal windows are sorted, as (hash, place)
    placed = F.when(F.size(F.array_distinct("win")) < F.size("win"), F.sort_array(F.transform("win", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    ordered = hashed.select("*", placed.alias("placed"))
    # missing neighbours compare to null, which the filter must read as false
    twin = F.filter("placed", lambda p, j: F.coalesce(p["x"] == F.get(F.col("placed"), j - 1)["x"], F.lit(False))
                    | F.coalesce(p["x"] == F.get(F.col("placed"), j + 1)["x"], F.lit(False)))
    repeats = F.when(F.col("placed").isNull(), F.lit(0).cast("long")).otherwise(_covered(F.sort_array(F.transform(twin, lambda p: p["i"]))))
    n_dup = (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")
    based = ordered.select("doc_id", "n_words", "word_chars", "n_symbols", n_dup.alias("n_dup_lines"), repeats.alias("n_repeat_words"), F.size("lines").alias("n_lines"),
                           "n_distinct", "capitals", "pipes", "shouts", "digits")
    share = lambda part, whole: (F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("double")
    return based.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        share("word_chars", "n_words").alias("mean_word_chars"), share("n_symbols", "word_chars").alias("symbol_share"), share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"), share("n_distinct", "n_words").alias("distinct_share"), share("capitals", "word_chars").alias("capital_share"),
        share("pipes", "n_words").alias("pipe_share"), share("shouts", "n_words").alias("shout_share"), share("digits", "word_chars").alias("digit_share"))


@dataclass(frozen=True)
class Condition:
    """A statistic above a threshold, or not above it."""

    name: str
    cut: int
    threshold: float
    above: bool

    def holds(self, cell: dict[str, int]) -> bool:
        # a cell's number is how many thresholds lie below its values
        return (cell[self.name] > self.cut) == self.above

    def column(self) -> Column:
        return F.col(self.name) > self.threshold if self.above else F.col(self.name) <= self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>' if self.above else '<='} {self.threshold:.6g}"


Cell = tuple[dict[str, int], int, int]
Rule = list[Condition]


def _totals(cells: list[Cell], rule: Rule) -> tuple[int, int]:
    """(bad, good) texts a rule covers."""
    covered = [(bad, good) for cell, bad, good in cells if all(c.holds(cell) for c in rule)]
    return sum(b for b, _ in covered), sum(g for _, g in covered)


def _grow(cells: list[Cell], conditions: list[Condition]) -> Rule:
    """Add the condition of the highest information gain until no good text is covered or nothing is gained."""
    rule: Rule = []
    bad, good = _totals(cells, rule)
    while good and len(rule) < CONDITIONS:
        covered = [x for x in cells if all(c.holds(x[0]) for c in rule)]
        best, gain, left = None, 0.0, (bad, good)
        for c in conditions:
            b, g = _totals(covered, [c])
            if b >= COVER and (value := b * (math.log2(b / (b + g)) - math.log2(bad / (bad + good)))) > gain:
                best, gain, left = c, value, (b, g)
        if best is None:
            break
        rule.append(best)
        bad, good = left
    return rule


def _prune(rule: Rule, cells: list[Cell]) -> Rule:
    """Drop last conditions while that does not lower the rule's worth on the pruning part."""

    def worth(r: Rule) -> float:
        b, g = _totals(cells, r)
        return (b - g) / (b + g) if b + g else -1.0

    best = rule
    for n in range(len(rule) - 1, 0, -1):
        if worth(rule[:n]) >= worth(best):
            best = rule[:n]
    return best


def cover(grow: list[Cell], prune: list[Cell], conditions: list[Condition]) -> list[Rule]:
    """Sequential covering: rules for bad texts, in the order in which they are applied."""
    rules: list[Rule] = []
    while len(rules) < RULES and sum(b for _, b, _ in grow) >= COVER:
        rule = _grow(grow, conditions)
        if not rule:
            break
        rule = _prune(rule, prune)
        (b, g), (pb, pg) = _totals(grow, rule), _totals(prune, rule)
        # the estimate leans towards one half where the pruning part has few texts
        if b < PRECISION * (b + g) or pb + 1 < PRECISION * (pb + pg + 1):
            break
        rules.append(rule)
        grow = [x for x in grow if not all(c.holds(x[0]) for c in rule)]
        prune = [x for x in prune if not all(c.holds(x[0]) for c in rule)]
    return rules


def learn(documents: DataFrame, labels: DataFrame) -> list[Rule]:
    """A decision list for quality 0 from a bounded sample of labelled texts that pass the base checks."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # as a table first: a filter on a statistic would be pushed down with the whole expression written out in it
    known = staged(statistics(sample).join(F.broadcast(chosen), "doc_id"), "statistics").where(~F.col("base_failed"))
    cuts = known.agg(*(F.percentile_approx(F.col(s).cast("double"), list(CUTS), 10_000).alias(s) for s in STATISTICS)).first()
    thresholds = {s: sorted(set(cuts[s] or [])) for s in STATISTICS}
    cell = [sum((F.when(F.col(s) > t, 1).otherwise(0) for t in thresholds[s]), F.lit(0)).alias(s) for s in STATISTICS]
    counted = known.select(*cell, (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0).alias("pruning"), "quality").groupBy("pruning", *STATISTICS).agg(
        F.sum(F.when(F.col("quality") == 0, 1).otherwise(0)).alias("bad"), F.sum(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good")).collect()
    cells = {flag: [({s: r[s] for s in STATISTICS}, r.bad, r.good) for r in counted if r.pruning is flag] for flag in (False, True)}
    conditions = [Condition(s, i, t, above) for s in STATISTICS for i, t in enumerate(thresholds[s]) for above in (True, False)]
    return cover(cells[False], cells[True], conditions)


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional expression: true keeps."""
    expression = None
    for rule in rules:
        fires = rule[0].column()
        for condition in rule[1:]:
            fires = fires & condition.column()
        expression = F.when(fires, False) if expression is None else expression.when(fires, False)
    return F.lit(True) if expression is None else expression.otherwise(True)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every row, with ``kept``: base checks passed and no rule fires."""
    rules = learn(documents, labels)
    return statistics(documents).withColumn("kept", F.when(F.col("base_failed"), False).otherwise(verdict(rules)))
