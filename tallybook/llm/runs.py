"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of words with smallest period ``q``, at least ``4 * q`` and at
least six words long, which no neighbouring word extends.  Each pair of
neighbours inside a run occurs three times or more in the text.  A text is
therefore cut between the words of rarer pairs, and what is left is compressed
by Re-Pair: the most frequent pair becomes a nonterminal, until no pair repeats.
A run lies inside one word of the derivation tree or crosses the boundary between the
two halves of the lowest node around it.  So the runs that cross a nonterminal's
boundary are computed once, at its first place, and moved to all places it is
derived at; the symbols left at the top are halved as a balanced tree.  Pieces
of a run seen in lower nodes lie inside the whole run and are dropped.

Each row is its own work; nothing is moved between tasks.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybook.llm import common

WORD = re.compile(common.WORD)
LEAST_WORDS, LEAST_PERIODS = 6, 4
REPEATS = 3  # occurrences of each pair of neighbours inside a run, at least
WIDE = 4  # bytes of a word's number

RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id bigint, n_words bigint, runs array<{RUN}>, collapsed string"

Run = tuple[int, int, int]  # start, stop, period


def stretches(numbers: np.ndarray) -> list[tuple[int, int]]:
    """The parts (start, stop) of a text that may hold runs: no pair in them is rare, in the text or in the parts."""
    cuts = [(0, len(numbers))]
    while True:
        starts = [np.arange(a, b - 1) for a, b in cuts if b - a >= LEAST_WORDS]
        if not starts:
            return []
        at = np.concatenate(starts)
        pairs = numbers[at] << 32 | numbers[at + 1]
        _, which, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        kept = at[counts[which] >= REPEATS]
        if not len(kept):
            return []
        breaks = np.flatnonzero(np.diff(kept) > 1) + 1
        firsts, lasts = kept[np.concatenate(([0], breaks))], kept[np.concatenate((breaks, [len(kept)])) - 1]
        found = [(int(a), int(b) + 2) for a, b in zip(firsts, lasts) if b + 2 - a >= LEAST_WORDS]
        if len(kept) == len(at) or 2 * len(kept) > len(at):
            return found
        cuts = found


class Grammar:
    """Re-Pair over stretches of a text.

    ``nodes`` has, for each nonterminal, the places it is derived at and the
    lengths of its two halves; ``tops`` the places of the symbols left in each
    stretch.
    """

    def __init__(self, numbers: np.ndarray, cuts: list[tuple[int, int]]):
        self.nodes: list[tuple[list[int], int, int]] = []
        self._symbol: dict[int, int] = {}
        self._after: dict[int, int] = {}
        self._before: dict[int, int] = {}
        self._places: dict[tuple[int, int], set[int]] = {}
        words = numbers.tolist()
        self._next = int(numbers.max(initial=0)) + 1
        self._length: dict[int, int] = {}
        for start, stop in cuts:
            for at in range(start, stop):
                self._symbol[at] = words[at]
                if at > start:
                    self._before[at], self._after[at - 1] = at - 1, at
                    self._places.setdefault((words[at - 1], words[at]), set()).add(at - 1)
        heap = [(-len(found), pair) for pair, found in self._places.items() if len(found) > 1]
        heapq.heapify(heap)
        while heap:
            count, pair = heapq.heappop(heap)
            known = len(self._places.get(pair, ()))
            if known < 2:
                continue
            if known != -count:
                heapq.heappush(heap, (-known, pair))
                continue
            for other in self._replace(pair):
                if len(self._places.get(other, ())) > 1:
                    heapq.heappush(heap, (-len(self._places[other]), other))
        self.tops = [self._top(start) for start, _ in cuts]

    def _replace(self, pair: tuple[int, int]) -> set[tuple[int, int]]:
        """Write a new symbol for a pair wherever it stands; returns the pairs that came up."""
        left, right = pair
        new, places, touched = self._next, [], set()
        symbol, after, before = self._symbol, self._after, self._before
        for at in sorted(self._places.pop(pair)):
            second = after.get(at)
            if second is None or symbol.get(at) != left or symbol[second] != right:
                continue  # overlapped the one before
            ahead, behind = before.get(at), after.get(second)
            if ahead is not None:
                self._drop((symbol[ahead], left), ahead)
                touched.add((symbol[ahead], new))
                self._places.setdefault((symbol[ahead], new), set()).add(ahead)
            if behind is not None:
                self._drop((right, symbol[behind]), second)
                touched.add((new, symbol[behind]))
                self._places.setdefault((new, symbol[behind]), set()).add(at)
                before[behind], after[at] = at, behind
            else:
                del after[at]
            symbol[at] = new
            del symbol[second]
            after.pop(second, None)
            before.pop(second, None)
            places.append(at)
        if places:
            halves = self._length.get(left, 1), self._length.get(right, 1)
            self._length[new] = sum(halves)
            self.nodes.append((places, *halves))
            self._next += 1
        return touched

    def _drop(self, pair: tuple[int, int], at: int) -> None:
        if (places := self._places.get(pair)) is not None:
            places.discard(at)

    def _top(self, start: int) -> list[int]:
        places, at = [start], start
        while (at := self._after.get(at)) is not None:
            places.append(at)
        return places


class Text:
    """A text as numbers of equal width, for comparing stretches of it at once."""

    def __init__(self, numbers: np.ndarray, cuts: list[tuple[int, int]]):
        self._bytes = numbers.astype(np.uint32).tobytes()
        self._words = numbers.tolist()
        self._pairs: dict[tuple[int, int], list[int]] = {}
        for start, stop in cuts:
            for at in range(start, stop - 1):
                self._pairs.setdefault((self._words[at], self._words[at + 1]), []).append(at)

    def same(self, a: int, b: int, n: int) -> bool:
        return self._bytes[a * WIDE : (a + n) * WIDE] == self._bytes[b * WIDE : (b + n) * WIDE]

    def forward(self, a: int, b: int, most: int) -> int:
        """How many words from ``a`` on equal those from ``b`` on."""
        done, step = 0, 1
        while done < most:
            step = min(step, most - done)
            if self.same(a + done, b + done, step):
                done, step = done + step, step * 2
            elif step == 1:
                return done
            else:
                step = max(1, step // 4)
        return done

    def backward(self, a: int, b: int, most: int) -> int:
        """How many words ahead of ``a`` equal those ahead of ``b``."""
        done, step = 0, 1
        while done < most:
            step = min(step, most - done)
            if self.same(a - done - step, b - done - step, step):
                done, step = done + step, step * 2
            elif step == 1:
                return done
            else:
                step = max(1, step // 4)
        return done

    def crossing(self, low: int, middle: int, high: int) -> list[Run]:
        """Runs within [low, high) that hold the words on both sides of ``middle``.

        Two whole periods of a run lie on one side of the boundary, so the pair
        at the boundary occurs again a period away on that side.
        """
        if high - low < LEAST_WORDS:
            return []
        places = self._pairs[self._words[middle - 1], self._words[middle]]
        most, here = (high - low) // LEAST_PERIODS, middle - 1
        first = max(low, here - min(most, (middle - low) // 2))
        last = here + min(most, (high - middle) // 2)
        at = bisect_left(places, here)
        ahead = (here - places[k] for k in range(at - 1, bisect_left(places, first) - 1, -1))
        behind = (places[k] - here for k in range(at + 1, bisect_left(places, last + 1)))
        found: set[Run] = set()
        for side, periods in ((-1, ahead), (1, behind)):
            for q in periods:
                begin = middle - 2 * q if side < 0 else middle
                end = begin + 2 * q
                if any(q % p == 0 and a <= begin and end <= b for a, b, p in found):
                    continue  # the same run, told by a multiple of its period
                if self.same(begin, begin + q, q):
                    # Two equal stretches, extended as long as words q apart are the same.
                    start = begin - self.backward(begin, begin + q, begin - low)
                    stop = end + self.forward(end - q, end, high - end)
                    if start < middle < stop and stop - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                        found.add((start, stop, q))
        return list(found)


def _halved(places: list[int], stop: int) -> Iterator[tuple[int, int, int]]:
    """(low, middle, high) of a balanced tree over the symbols that begin at ``places``."""
    ends = [*places[1:], stop]
    pending = [(0, len(places))]
    while pending:
        a, b = pending.pop()
        if b - a > 1:
            middle = (a + b) // 2
            yield places[a], places[middle], ends[b - 1]
            pending += [(a, middle), (middle, b)]


def periodic_runs(words: list[str]) -> list[Run]:
    """All runs as (start, stop, period), by start and period."""
    known: dict[str, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    cuts = stretches(numbers)
    if not cuts:
        return []
    text, grammar = Text(numbers, cuts), Grammar(numbers, cuts)
    found: set[Run] = set()
    for places, left, right in grammar.nodes:
        at = places[0]
        for start, stop, q in text.crossing(at, at + left, at + left + right):
            found.update((start + p - at, stop + p - at, q) for p in places)
    for places, (_, stop) in zip(grammar.tops, cuts):
        for low, middle, high in _halved(places, stop):
            found.update(text.crossing(low, middle, high))
    return _maximal(found)


def _maximal(found: Iterable[Run]) -> list[Run]:
    """Without the pieces of a run that lie inside another of its period."""
    kept, reach = [], {}
    for start, stop, q in sorted(found, key=lambda r: (r[2], r[0], -r[1])):
        if stop > reach.get(q, -1):
            reach[q] = stop
            kept.append((start, stop, q))
    return sorted(kept, key=lambda r: (r[0], r[2]))


def collapsed(words: list[str], runs: list[Run]) -> str:
    """The text with one period left of each run, words joined by a space."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, stop, q in runs:
        change[start + q] += 1
        change[stop] -= 1
    dropped = np.cumsum(change[:-1]) > 0
    return " ".join([w for w, gone in zip(words, dropped.tolist()) if not gone])


def find_runs(documents: DataFrame, rewrite: Callable[[int | None, list[str]], list[str]] | None = None) -> DataFrame:
    """One row a document: doc_id, n_words, runs (by start, then period), collapsed.

    Words are runs of characters other than blanks.  A NULL text has none; a
    text without runs has an empty list.  ``rewrite`` may change a document's
    words first.  Repeated rows each give a row; other columns are ignored.  A
    task holds one text at a time.
    """

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sizes, lists, texts = [], [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1)):
                    words = WORD.findall(text.as_py() or "")
                    if rewrite is not None:
                        words = rewrite(doc_id, words)
                    runs = periodic_runs(words)
                    sizes.append(len(words))
                    lists.append([{"start": a, "length": b - a, "period": q} for a, b, q in runs])
                    texts.append(collapsed(words, runs))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(lists, kind), pa.array(texts, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return documents.select("doc_id", "text").mapInArrow(found, SCHEMA)
