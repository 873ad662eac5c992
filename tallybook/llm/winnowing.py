"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer
words is one window.  Of the hashes of the k-word grams inside a window the
smallest is its fingerprint, and so is a document's, as equal windows choose
alike.  A document therefore keeps one fingerprint for a run of windows that
share their smallest hash, about two for seven windows, and any shared window
is found by joining fingerprints.  A hit is then extended: every window of the
run is compared by the hashes of its first and its last gram, which cover it
whole (128 bits; the runs carry the hashes, so texts are not shuffled).

Very many items may hold one window, and very many documents may hit it.  So a
hit carries the name of its window's set of items, a document the name of its
combination of sets, and the items are listed once per distinct combination.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import LOWER, UPPER, broadcast_if_small, grams_of, let, quoted, settled

WINDOW = 10
LEAST_WORDS = 8  # of a window that condemns a document
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def gram_length(window: int) -> int:
    """Two grams cover a window."""
    return (window + 1) // 2


def words_of(text: str) -> str:
    """Lower-case words; only A-Z change case.  NULL has none."""
    lowered = f"translate(coalesce({text}, ''), '{UPPER}', '{LOWER}')"
    return f"array_remove(split({lowered}, '{quoted(BREAK)}'), '')"


def minima_of(grams: str, span: int) -> str:
    """The smallest of each ``span`` consecutive hashes."""
    if span == 1:
        return grams
    parts = ", ".join(f"get({grams}, i + {j})" for j in range(span))
    return f"if(size({grams}) < {span}, array(), transform(sequence(0, size({grams}) - {span}), i -> least({parts})))"


def runs_of(words: str, window: int) -> str:
    """Runs of windows with one smallest hash: (window, fingerprint, first, grams).

    ``first`` counts from 0; ``grams`` are those of all windows of the run.
    """
    length = gram_length(window)
    span = window - length + 1
    start = "filter(sequence(1, size(m)), i -> i = 1 or get(m, i - 2) <> get(m, i - 1))"
    run = (
        f"transform(s, (a, n) -> struct({window} as window, get(m, a - 1) as fingerprint, a - 1 as first, "
        f"slice(g, a, coalesce(get(s, n + 1), size(m) + 1) - a + {span - 1}) as grams))"
    )
    runs = let(minima_of("g", span), "m", f"if(size(m) = 0, array(), {let(start, 's', run)})")
    return let(grams_of(words, length), "g", runs)


def _item_windows(items: DataFrame, window: int) -> DataFrame:
    """Distinct windows of the items with the items that hold them, and a name for that set of items."""
    whole = items.select("item_id", F.expr(words_of("text")).alias("words")).where("size(words) > 0")
    whole = whole.select("item_id", "words", F.least(F.size("words"), F.lit(window)).alias("window"))
    found = None
    for n in range(1, window + 1):
        runs = whole.where(F.col("window") == n).select("item_id", F.explode(F.expr(runs_of("words", n))).alias("run"))
        found = runs if found is None else found.unionByName(runs)
    spread = found.select("item_id", "run.window", "run.fingerprint", F.posexplode(_pairs()).alias("at", "pair"))
    held = spread.groupBy("window", "fingerprint", "pair").agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return held.withColumn("item_set", F.expr(_named("items")))


def _named(array: str) -> str:
    """SQL for a name of 128 bits for an array."""
    return f"md5(array_join({array}, ','))"


def _pairs() -> Column:
    """First and last gram of each window of a run."""
    reach = "run.window - cast((run.window + 1) div 2 as int)"
    pair = f"struct(get(run.grams, i) as head, get(run.grams, i + {reach}) as tail)"
    return F.expr(f"transform(sequence(0, size(run.grams) - 1 - ({reach})), i -> {pair})")


def hits(documents: DataFrame, items: DataFrame, window: int = WINDOW, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Windows of items found in documents: keys, first (word position from 0), window, item_set.

    ``item_set`` names the set of items that hold the window.  NULL texts and
    texts without words give nothing; an empty table of items gives an empty result.
    Rows with equal keys are told apart by the caller's choice of keys.
    """
    return _found(documents, settled(_item_windows(items, window)), window, keys)


def _found(documents: DataFrame, windows: DataFrame, window: int, keys: tuple[str, ...]) -> DataFrame:
    lengths = sorted(row[0] for row in windows.select("window").distinct().collect())  # at most WINDOW values
    by_window = broadcast_if_small(windows.drop("items"))
    prints = broadcast_if_small(settled(windows.select("window", "fingerprint").distinct()))
    worded = documents.select(*keys, F.expr(words_of("text")).alias("words"))
    runs = ", ".join(runs_of("words", n) for n in lengths or [window])
    found = worded.select(*keys, F.explode(F.expr(f"concat({runs})")).alias("run"))
    found = found.select(*keys, "run", "run.window", "run.fingerprint")
    found = found.join(prints, ["window", "fingerprint"], "left_semi")
    spread = found.select(
        *keys, F.col("run.first").alias("start"), "window", "fingerprint", F.posexplode(_pairs()).alias("at", "pair")
    )
    spread = spread.select(*keys, (F.col("start") + F.col("at")).alias("first"), "window", "fingerprint", "pair")
    return spread.join(by_window, ["window", "fingerprint", "pair"]).select(*keys, "first", "window", "item_set")


def _listed(combinations: DataFrame, windows: DataFrame, told: dict[str, str]) -> DataFrame:
    """What is told of each combination of item sets: one row each, (combination, *told)."""
    sets = settled(windows.groupBy("item_set").agg(F.any_value("items").alias("items")))
    sets = broadcast_if_small(sets, held=F.size("items") * 8)
    members = combinations.select("combination", F.explode("sets").alias("item_set")).join(sets, "item_set")
    lists = members.groupBy("combination").agg(F.collect_list("items").alias("lists"))
    lists = lists.select("combination", F.expr("array_sort(array_distinct(flatten(lists)))").alias("items"))
    return lists.select("combination", *[F.expr(sql).alias(name) for name, sql in told.items()])


def contamination(
    documents: DataFrame, items: DataFrame, window: int = WINDOW, told: dict[str, str] | None = None
) -> DataFrame:
    """One row a document: doc_id, n_words, n_hit (words inside found windows), items (sorted ids).

    ``told`` may name other columns, SQL over ``items``; each is computed once per
    distinct list of items, and the lists themselves then do not travel with documents.

    Documents count as the same if id and text are equal, and then share a
    result; each of their rows is returned.  A NULL text has no words.  NULL
    item ids are left out of ``items``.  Extra columns are ignored.
    """
    told = told or {"items": "items"}
    windows = settled(_item_windows(items, window))
    mark = F.xxhash64("text").alias("_mark")
    found = _found(documents.select("doc_id", "text", mark), windows, window, ("doc_id", "_mark"))
    per_document = found.groupBy("doc_id", "_mark").agg(
        F.collect_set(F.struct("first", "window")).alias("spans"), F.sort_array(F.collect_set("item_set")).alias("sets")
    )
    covered = (
        "aggregate(array_sort(spans), struct(0 as upto, 0L as n), (a, s) -> struct("
        "greatest(a.upto, s.first + s.window) as upto, "
        "a.n + greatest(0, s.first + s.window - greatest(a.upto, s.first)) as n)).n"
    )
    per_document = settled(
        per_document.select(
            "doc_id", "_mark", F.expr(covered).alias("n_hit"), "sets", F.expr(_named("sets")).alias("combination")
        )
    )
    combinations = per_document.groupBy("combination").agg(F.any_value("sets").alias("sets"))
    per_document = per_document.drop("sets").join(_listed(combinations, windows, told), "combination")
    counted = documents.select("doc_id", mark, F.expr(f"cast(size({words_of('text')}) as bigint)").alias("n_words"))
    matched = F.expr("d.doc_id <=> h.doc_id and d._mark = h._mark")
    none = {name: F.expr(let("cast(array() as array<bigint>)", "items", sql)) for name, sql in told.items()}
    return counted.alias("d").join(per_document.alias("h"), matched, "left").select(
        "d.doc_id",
        "d._mark",
        "d.n_words",
        F.coalesce("h.n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
        *[F.coalesce(f"h.{name}", none[name]).alias(name) for name in told],
    )


def decontaminated(documents: DataFrame, items: DataFrame, window: int = WINDOW, least: int = LEAST_WORDS) -> DataFrame:
    """The documents that hold no window of an item of ``least`` words or more, with all their columns.

    An item of fewer words is one window, and a word or two, such as a short
    answer, stand in very many documents that have nothing of the benchmark.
    """
    marked = documents.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    found = hits(marked, items, window, ("doc_id", "mark")).where(F.col("window") >= least)
    found = settled(found.select("doc_id", "mark").distinct())
    matched = F.expr("d.doc_id <=> h.doc_id and xxhash64(d.text) = h.mark")
    return documents.alias("d").join(broadcast_if_small(found).alias("h"), matched, "left_anti")
