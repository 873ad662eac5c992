"""Sampled segmentations: forward filtering and backward sampling over the lattice of pieces.

The forward sums of the distinct pre-tokens of a run of rows are computed along
their trie, level by level as arrays (a prefix once).  A segmentation is then
drawn from the end: at each node one of the pieces that end there, by its share
of the forward sum.  All occurrences of the run take a step at a time.  The draw
of a step comes from a hash of seed, row key, place and step, so a row's
segmentation does not depend on partitions, batches or retries.

A pre-token of very many characters is filtered alone: only its forward sums are
kept, and the pieces that end at a place are found anew when it is drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from tallybook.llm.hashing import mixed
from tallybook.llm.pieces import (
    Open,
    SharedTrie,
    Steps,
    Vocabulary,
    advance,
    byte_edge,
    chunks,
    decode,
    load,
    numbered,
    parted,
    written,
)

SEED = 42
GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # splitmix64's step (fixed value)
DRAWS = 1 << 16  # of a long pre-token, made at a time
SCHEMA = "doc_id bigint, ids array<int>, n_ids bigint, lossless boolean"


def draws(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 to below 1; a node's number plus one of them is exact."""
    return (mixed(keys) >> np.uint64(40)).astype(np.float64) * 2.0**-24


class Lattice:
    """Nodes are prefixes of pre-tokens; node 0 is the empty one.

    The edges of node ``n`` begin at ``begins[n]``.  Edge ``e`` leads back to
    ``source[e]``, with the id ``spelling[e]`` (or ``-1 - c`` for the character
    ``c`` spelled in bytes).  ``reach[e]`` sums up the shares of the node's
    edges up to it, so a draw takes the first edge that reaches beyond it.
    """

    def __init__(self, pre_tokens: list[str], steps: Steps, vocabulary: Vocabulary):
        trie = SharedTrie(pre_tokens, steps, vocabulary)
        self._trie = trie
        forward = np.zeros(1 << 16)
        begins, source, spelling, reach, edges = [np.zeros(1, np.int64)], [], [], [], 0
        for level in trie.levels():
            count = len(level.begins)
            while level.first + count > len(forward):
                forward = np.concatenate((forward, forward))
            scores = forward[level.source] + level.score
            top = np.maximum.reduceat(scores, level.begins)
            shares = np.exp(scores - top[level.owner])
            place = np.arange(len(shares)) - level.begins[level.owner]
            summed, total = shares, np.zeros(count)
            for k in range(int(place.max(initial=-1)) + 1):
                here = np.flatnonzero(place == k)
                total[level.owner[here]] += shares[here]
                summed[here] = total[level.owner[here]]
            forward[level.first : level.first + count] = top + np.log(total)
            summed = summed / total[level.owner]
            summed[np.append(level.begins[1:], len(shares)) - 1] = 1.0  # the last edge takes all that is left
            begins.append(level.begins + edges)
            source.append(level.source)
            spelling.append(level.spelling)
            reach.append(summed)
            edges += len(shares)
        none = [np.zeros(0, np.int64)]
        self.terminal = trie.terminal
        self.begins = np.concatenate(begins)
        self.source, self.spelling = np.concatenate(source or none), np.concatenate(spelling or none)
        self.reach = np.concatenate(reach or [np.zeros(0)])

    def sample(self, types: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all occurrences, one after the other, and how many each has.

        ``types`` numbers the pre-token of each, ``keys`` (uint64) seeds its draws.
        """
        node = self.terminal[types]
        active = np.arange(len(types))
        steps, taken = np.zeros(len(types), np.int64), []
        while len(active):
            keys = keys + GOLDEN
            draw = draws(keys)
            edge = self.begins[node]
            further = np.flatnonzero(self.reach[edge] <= draw)
            while len(further):
                edge[further] += 1
                further = further[self.reach[edge[further]] <= draw[further]]
            taken.append((active, self.spelling[edge]))
            node = self.source[edge]
            steps[active] += 1
            more = node > 0
            active, node, keys = active[more], node[more], keys[more]
        ends = np.cumsum(steps)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
        for step, (who, found) in enumerate(taken):
            ids[ends[who] - 1 - step] = found
        return self._spelled(ids, steps)

    def _spelled(self, ids: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace characters spelled in bytes by the ids of their bytes."""
        places = np.flatnonzero(ids < 0)
        if not len(places):
            return ids, steps
        codes, which = np.unique(-1 - ids[places], return_inverse=True)
        spelled = [self._trie.bytes_of(code)[0] for code in codes.tolist()]
        sizes = np.array([len(x) for x in spelled], np.int64)
        flat = np.array([b for x in spelled for b in x], np.int64)
        firsts = np.cumsum(sizes) - sizes
        width = np.ones(len(ids), np.int64)
        width[places] = sizes[which]
        spread = np.repeat(ids, width)
        begins = np.cumsum(width) - width
        inside = np.arange(sizes[which].sum()) - np.repeat(np.cumsum(sizes[which]) - sizes[which], sizes[which])
        spread[np.repeat(begins[places], sizes[which]) + inside] = flat[np.repeat(firsts[which], sizes[which]) + inside]
        ends = np.cumsum(steps)
        upto = np.concatenate(([0], np.cumsum(width)))
        return spread, upto[ends] - upto[ends - steps]


class LongWord:
    """The forward sums of one long pre-token, a number a character."""

    def __init__(self, raw: str, root: dict, backward: dict, vocabulary: Vocabulary):
        self._raw, self._word = raw, written(raw)
        self._backward, self._vocabulary = backward, vocabulary
        self._forward = np.zeros(len(raw) + 1)
        forward, exp, log = self._forward, math.exp, math.log
        keep = vocabulary.longest + 1
        recent = [0.0] * keep  # the sums of the last places, as plain numbers
        under_way: Open = []
        for at, character in enumerate(self._word):
            under_way, ended = advance(under_way, root, at, character)
            scores = [recent[start % keep] + piece[1] for start, piece in ended]
            if character not in vocabulary.pieces:
                scores.append(recent[at % keep] + byte_edge(raw, at, vocabulary)[1])
            top = max(scores)
            total = scores[0] if len(scores) == 1 else top + log(sum([exp(x - top) for x in scores]))
            recent[(at + 1) % keep] = forward[at + 1] = total

    def _edges(self, at: int) -> list[tuple[int, list[int], float]]:
        """What ends at a place, longer pieces first: where it begins, its ids and the score of the sums with it."""
        found, node = [], self._backward
        for start in range(at - 1, -1, -1):
            node = node.get(self._word[start])
            if node is None:
                break
            if "" in node:
                piece, chance = node[""]
                found.append((start, [piece], self._forward[start] + chance))
        found.reverse()
        if self._word[at - 1] not in self._vocabulary.pieces:
            ids, cost = byte_edge(self._raw, at - 1, self._vocabulary)
            found.append((at - 1, ids, self._forward[at - 1] + cost))
        return found

    def sample(self, key: np.uint64) -> np.ndarray:
        """The ids of one segmentation."""
        ids = np.empty(4 * len(self._word), np.int32)
        used, at, step, drawn = len(ids), len(self._word), 0, np.zeros(0)
        while at:
            if step % DRAWS == 0:
                with np.errstate(over="ignore"):
                    drawn = draws(key + np.arange(step + 1, step + DRAWS + 1).astype(np.uint64) * GOLDEN)
            edges = self._edges(at)
            top = max(score for _, _, score in edges)
            shares = [math.exp(score - top) for _, _, score in edges]
            wanted, summed, chosen = drawn[step % DRAWS], 0.0, 0
            total = sum(shares)
            while chosen < len(edges) - 1 and (summed := summed + shares[chosen]) / total <= wanted:
                chosen += 1
            at, spelled, _ = edges[chosen]
            ids[used - len(spelled) : used] = spelled
            used, step = used - len(spelled), step + 1
        return ids[used:].astype(np.int64)


def row_seed(key: object, seed: int) -> int:
    return xxhash.xxh64_intdigest(str(key), seed)


class Sampler:
    """Samples segmentations; the trie of pieces is built once."""

    def __init__(self, vocabulary: Vocabulary, seed: int):
        self._vocabulary, self._seed, self._steps = vocabulary, seed, Steps(vocabulary)
        self._tries: tuple[dict, dict] | None = None

    def ids(self, texts: list[str], keys: list[object]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each text has."""
        distinct, types, lengths = numbered(texts)
        if not len(types):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        ends = np.cumsum(lengths)
        place = np.arange(len(types)) - np.repeat(ends - lengths, lengths)
        seeds = np.repeat(np.array([row_seed(k, self._seed) for k in keys], np.uint64), lengths)
        seeds = mixed(seeds ^ mixed(place.astype(np.uint64) + GOLDEN))
        usual, long = parted(distinct)
        lattice = Lattice([distinct[k] for k in usual], self._steps, self._vocabulary)
        number = np.full(len(distinct), -1)
        number[usual] = np.arange(len(usual))
        types_of = number[types]
        among = np.flatnonzero(types_of >= 0)
        ids, found = lattice.sample(types_of[among], seeds[among])
        sizes = np.zeros(len(types), np.int64)
        sizes[among] = found
        if long:
            ids, sizes = self._with_long(distinct, long, types, seeds, ids, sizes)
        upto = np.concatenate(([0], np.cumsum(sizes)))
        return ids, upto[ends] - upto[ends - lengths]

    def _with_long(self, distinct, long, types, seeds, ids, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Put the ids of long pre-tokens, which are sampled one by one, between the others."""
        if self._tries is None:
            self._tries = self._vocabulary.trie(), self._vocabulary.backward_trie()
        spelled: dict[int, np.ndarray] = {}
        occurrences = np.flatnonzero(np.isin(types, long))
        for k in long:
            word = LongWord(distinct[k], *self._tries, self._vocabulary)
            for at in occurrences[types[occurrences] == k].tolist():
                spelled[at] = word.sample(seeds[at])
        before = np.concatenate(([0], np.cumsum(sizes)))
        parts, done = [], 0
        for at in occurrences.tolist():
            parts += [ids[done : before[at]], spelled[at]]
            done = before[at]
            sizes[at] = len(spelled[at])
        return np.concatenate([*parts, ids[done:]]), sizes


def sampled_ids(texts: list[str], keys: list[object], vocabulary: Vocabulary, seed: int) -> tuple[np.ndarray, np.ndarray]:
    return Sampler(vocabulary, seed).ids(texts, keys)


def encode(documents: DataFrame, path: str | None = None, seed: int = SEED) -> DataFrame:
    """One row a document: doc_id, ids, n_ids, lossless (whether the decoded ids are the text).

    NULL counts as the empty text, which has no ids.  The row key is doc_id, so
    rows that repeat an id and a text get the same segmentation; NULL ids share
    a key.  Other columns are ignored.
    """
    vocabulary = load(path)

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(vocabulary, seed)
        for batch in batches:
            for start, stop, texts in chunks(batch, 1):
                doc_ids = batch.column(0).slice(start, stop - start)
                ids, sizes = sampler.ids(texts, doc_ids.to_pylist())
                ends = np.cumsum(sizes)
                lossless = [decode(ids[b - n : b].tolist(), vocabulary) == x for x, b, n in zip(texts, ends, sizes)]
                offsets = pa.array(np.concatenate(([0], ends)), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                arrays = [doc_ids, lists, pa.array(sizes), pa.array(lossless, pa.bool_())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "ids", "n_ids", "lossless"])

    return documents.select("doc_id", "text").mapInArrow(encoded, SCHEMA)
