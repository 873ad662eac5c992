"""Quality rules: a decision list learned from labelled statistics.

Sequential covering: rules are conjunctions of thresholds that pick out bad
documents.  A rule is grown, condition by condition, by information gain on two
thirds of the labelled rows; pruned from its end on the rest; and kept if it is
precise there.  The rows it covers go, and the next rule is grown from what is
left.  The list becomes one ``CASE WHEN`` over the statistics of a text.

Rows are learned from as bins of their statistics, in a table of bounded size;
each step counts labels by statistic and bin in Spark and brings those counts
(at most ``len(FEATURES) * BINS * 4`` rows) to the driver.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import BLANKS, SPACE, UPPER, WORD, fresh, grams_of, let, quoted, settled

SAMPLE = 20_000  # about so many labelled rows are learned from, chosen by a hash of doc_id
BINS = 32
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.75  # of a rule on the rows held back for pruning
MIN_COVER = 5  # bad rows a rule must cover, and that must be left to grow one
SYMBOLS = "#*$%&|<>"

FEATURES = {
    "n_words": "n_words",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
}
BASE_FAILED = "n_words < 50 or 100 * n_repeat_words > 50 * n_words"


def _without(text: str, characters: str) -> str:
    return f"length({text}) - length(translate({text}, '{characters}', ''))"


def _repeated(words: str) -> str:
    """Words inside a window of three that occurs again in the text.

    Windows are sorted by hash, so equal ones are neighbours; each adds the
    words up to the next repeated window, three at most.
    """
    same = "coalesce(get(s, j - 1).gram = x.gram, false) or coalesce(get(s, j + 1).gram = x.gram, false)"
    places = f"sort_array(transform(filter(s, (x, j) -> {same}), x -> x.at))"
    reach = "aggregate(transform(p, (x, j) -> least(3, coalesce(get(p, j + 1) - x, 3))), 0L, (a, x) -> a + x)"
    ordered = f"sort_array(transform({grams_of(words, 3)}, (g, at) -> struct(g as gram, at as at)))"
    return let(ordered, "s", let(places, "p", reach))


def statistics(text: str = "text") -> Column:
    """A struct of the counts the rules are made of; NULL counts as the empty text."""
    body = f"coalesce({text}, '')"
    lines = f"filter(split(t, '\\\\n'), l -> l rlike '{quoted(WORD)}')"
    blanks = "".join(f"\\u{ord(x):04x}" for x in BLANKS)
    counts = (
        "struct("
        "cast(size(w) as bigint) as n_words, "
        f"cast(length(translate(t, '{blanks}', '')) as bigint) as word_chars, "
        f"cast({_without('t', SYMBOLS)} as bigint) as n_symbols, "
        "cast(size(l) as bigint) as n_lines, "
        "cast(size(l) - size(array_distinct(l)) as bigint) as n_dup_lines, "
        f"{_repeated('w')} as n_repeat_words, "
        "cast(size(array_distinct(w)) as bigint) as n_distinct, "
        f"cast({_without('t', UPPER)} as bigint) as n_upper, "
        f"cast({_without('t', '0123456789')} as bigint) as n_digits, "
        f"cast({_without('t', '!?')} as bigint) as n_marks)"
    )
    words = f"array_remove(split(t, '{quoted(SPACE)}'), '')"
    return F.expr(let(body, "t", let(words, "w", let(lines, "l", counts))))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def sql(self) -> str:
        return f"{FEATURES[self.feature]} {'>' if self.above else '<='} {self.threshold!r}D"


@dataclass(frozen=True)
class DecisionList:
    """Rules in order; a row is bad if one of them holds, else good."""

    rules: tuple[tuple[Condition, ...], ...]

    def good(self) -> str:
        """SQL over the fields of ``statistics``."""
        cases = [f"when {' and '.join(f'({c.sql()})' for c in rule)} then false" for rule in self.rules]
        return f"case {' '.join(cases)} else true end" if cases else "true"


def learn(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """Fit to ``labels`` (doc_id, quality; 0 is bad).

    Labels other than 0 and 1 and NULL ids are left out; of several labels of a
    document the lowest counts; without bad rows the list is empty.  Documents
    the fixed rules reject are not learned from.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = min(1.0, sample / max(1, known.count()))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # about `sample` ids
    rows = rows.select("doc_id", "quality", statistics().alias("s")).select("doc_id", "quality", "s.*")
    held = F.pmod(F.xxhash64(F.lit("prune"), "doc_id"), F.lit(3)) == 0
    features = [F.expr(sql).cast("double").alias(name) for name, sql in FEATURES.items()]
    failed = F.expr(BASE_FAILED).alias("failed")
    # Settled ahead of the filter, which would else be computed for every document below the join.
    rows = settled(rows.select((F.col("quality") == 0).alias("bad"), held.alias("held"), failed, *features))
    rows = rows.where("not failed")
    cuts = _cuts(rows)
    bins = [F.expr(f"size(filter({_array(cuts[f])}, t -> t < {f}))").alias(f) for f in FEATURES]
    return _cover(settled(rows.select("bad", "held", *bins)), cuts)


def _array(numbers: list[float]) -> str:
    return f"array({', '.join(f'{x!r}D' for x in numbers)})"


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds: quantiles of all rows and of the bad ones, and the middles between them."""
    half = BINS // 2
    shares = ", ".join(str(k / half) for k in range(half))
    sides = [
        (f, F.expr(f"percentile({value}, array({shares}))").alias(f"{f}_{k}"))
        for f in FEATURES
        for k, value in enumerate((f, f"if(bad, {f}, null)"))
    ]
    row = rows.agg(*(column for _, column in sides)).first()
    found = {f: sorted({x for k in range(2) for x in row[f"{f}_{k}"] or []}) or [0.0] for f in FEATURES}
    return {f: sorted({*cuts, *((a + b) / 2 for a, b in zip(cuts, cuts[1:]))}) for f, cuts in found.items()}


def _holds(rule: list[tuple[str, bool, int]]) -> str:
    return " and ".join(f"{f} {'>' if above else '<='} {k}" for f, above, k in rule) or "true"


def _cover(binned: DataFrame, cuts: dict[str, list[float]]) -> DecisionList:
    rules: list[list[tuple[str, bool, int]]] = []
    left = "true"
    while len(rules) < MAX_RULES:
        rule = _grow(binned.where(f"not held and {left}"), cuts)
        rule, precise = _prune(binned.where(f"held and {left}"), rule)
        if not precise:
            break
        rules.append(rule)
        left += f" and not ({_holds(rule)})"
    return DecisionList(tuple(tuple(Condition(f, above, cuts[f][k]) for f, above, k in rule) for rule in rules))


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[str, bool, int]]:
    rule: list[tuple[str, bool, int]] = []
    while len(rule) < MAX_CONDITIONS:
        pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("bin")) for f in FEATURES))
        counts = rows.where(_holds(rule)).select("bad", F.explode(pairs).alias("x"))
        counts = counts.groupBy("x.feature", "x.bin", "bad").count().collect()
        table = {(r["feature"], r["bin"], r["bad"]): r["count"] for r in counts}
        first = next(iter(FEATURES))
        bad, good = (sum(n for (f, _, b), n in table.items() if f == first and b == side) for side in (True, False))
        if bad < MIN_COVER or good == 0:
            break
        best, chosen = 1e-9, None
        for f in FEATURES:
            gains: dict[bool, list[float]] = {False: [], True: []}
            below = [0, 0]
            for k in range(len(cuts[f])):
                below = [below[0] + table.get((f, k, True), 0), below[1] + table.get((f, k, False), 0)]
                for above, (p, n) in ((False, below), (True, [bad - below[0], good - below[1]])):
                    gain = p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good))) if p >= MIN_COVER else 0.0
                    gains[above].append(gain)
            for above, by_cut in gains.items():
                if max(by_cut) > best + 1e-9:
                    best = max(by_cut)
                    equal = [k for k, gain in enumerate(by_cut) if gain > best - 1e-9]
                    chosen = (f, above, equal[len(equal) // 2])  # far from the rows on either side
        if chosen is None:
            break
        rule.append(chosen)
    return rule


def _prune(rows: DataFrame, rule: list[tuple[str, bool, int]]) -> tuple[list[tuple[str, bool, int]], bool]:
    """The start of the rule that tells best, and whether it is precise and covers enough."""
    if not rule:
        return rule, False
    starts = [rule[: k + 1] for k in range(len(rule))]
    sums = [
        F.coalesce(F.sum(F.expr(f"if({_holds(s)} and {side}, 1, 0)")), F.lit(0)).alias(f"{name}{k}")
        for k, s in enumerate(starts)
        for name, side in (("bad", "bad"), ("good", "not bad"))
    ]
    row = rows.agg(*sums).first()
    worth = [(row[f"bad{k}"] - row[f"good{k}"]) / max(1, row[f"bad{k}"] + row[f"good{k}"]) for k in range(len(starts))]
    k = max(range(len(starts)), key=lambda k: (worth[k], -k))
    covered = row[f"bad{k}"] + row[f"good{k}"]
    return starts[k], row[f"bad{k}"] >= MIN_COVER and row[f"bad{k}"] >= MIN_PRECISION * covered


def judged(documents: DataFrame, rules: DecisionList) -> DataFrame:
    """One row a document: doc_id, its statistics, base_failed, kept."""
    rows = documents.select("doc_id", statistics().alias("s")).select("doc_id", "s.*")
    rows = rows.withColumn("base_failed", F.expr(BASE_FAILED))
    return rows.withColumn("kept", F.expr(f"not base_failed and {rules.good()}"))


def kept_documents(documents: DataFrame, rules: DecisionList) -> DataFrame:
    """The documents that pass, with all their columns; no row is moved."""
    name = fresh(documents, "quality")
    passes = _inside(name, f"not ({BASE_FAILED}) and {rules.good()}")
    return documents.withColumn(name, statistics()).where(passes).drop(name)


def _inside(struct: str, sql: str) -> str:
    """The same expression over the fields of a struct."""
    return re.sub(r"\b(n_[a-z_]+|word_chars)\b", rf"{struct}.\1", sql)
