"""Token counts of whole texts, by dynamic programming shared along a trie.

The distinct pre-tokens of a run of rows form a trie, which is walked level by
level as arrays: each node, a shared prefix, gets its forward score (best log
chance and its number of tokens) once.  The count at a terminal node serves
every occurrence.  A pre-token of very many characters shares nothing worth
keeping and is walked alone, with the scores of the longest piece's stretch at
hand.  Rows are never moved; a task holds a run of about two million
characters, or one text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallybook.llm.pieces import Open, SharedTrie, Steps, Vocabulary, advance, byte_edge, chunks, load, numbered, parted, written

SCHEMA = "doc_id bigint, n_pre_tokens bigint, n_tokens bigint"


class Counter:
    """Counts tokens of pre-tokens; the trie of pieces is built once."""

    def __init__(self, vocabulary: Vocabulary):
        self._vocabulary, self._steps, self._root = vocabulary, Steps(vocabulary), vocabulary.trie()

    def counts(self, pre_tokens: list[str]) -> np.ndarray:
        """Number of tokens of the likeliest segmentation of each pre-token; of equally likely ones the fewest."""
        found = np.zeros(len(pre_tokens), np.int64)
        usual, long = parted(pre_tokens)
        trie = SharedTrie([pre_tokens[k] for k in usual], self._steps, self._vocabulary)
        best, fewest = np.zeros(1 << 16), np.zeros(1 << 16, np.int64)
        for level in trie.levels():
            stop = level.first + len(level.begins)
            while stop > len(best):
                best, fewest = np.concatenate((best, best)), np.concatenate((fewest, fewest))
            chance, n = best[level.source] + level.score, fewest[level.source] + level.tokens
            top = np.maximum.reduceat(chance, level.begins)
            n[chance < top[level.owner]] = np.iinfo(np.int64).max
            best[level.first : stop] = top
            fewest[level.first : stop] = np.minimum.reduceat(n, level.begins)
        found[usual] = fewest[trie.terminal]
        for k in long:
            found[k] = self._alone(pre_tokens[k])
        return found

    def _alone(self, raw: str) -> int:
        """The same for one long pre-token; only the scores a piece can reach back to are kept."""
        word, pieces, keep = written(raw), self._vocabulary.pieces, self._vocabulary.longest
        best: list[tuple[float, int]] = [(0.0, 0)] * (keep + 1)  # of the last places: log chance, minus the number of tokens
        under_way: Open = []
        for at, character in enumerate(word):
            under_way, ended = advance(under_way, self._root, at, character)
            options = []
            for start, (_, chance) in ended:
                before = best[start % (keep + 1)]
                options.append((before[0] + chance, before[1] - 1))
            if character not in pieces:
                ids, cost = byte_edge(raw, at, self._vocabulary)
                before = best[at % (keep + 1)]
                options.append((before[0] + cost, before[1] - len(ids)))
            best[(at + 1) % (keep + 1)] = max(options)
        return -best[len(word) % (keep + 1)][1]


def terminal_counts(pre_tokens: list[str], vocabulary: Vocabulary) -> np.ndarray:
    return Counter(vocabulary).counts(pre_tokens)


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """One row a document: doc_id, n_pre_tokens, n_tokens.  NULL and empty texts have none.

    ``path`` is a sentencepiece file that the driver reads; its pieces go to
    the tasks.  Repeated rows each count; other columns are ignored.
    """
    vocabulary = load(path)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            for start, stop, texts in chunks(batch, 1):
                distinct, occurrences, lengths = numbered(texts)
                tokens = counter.counts(distinct)[occurrences]
                sums = np.concatenate(([0], np.cumsum(tokens)))
                ends = np.cumsum(lengths)
                per_text = sums[ends] - sums[ends - lengths]
                ids = batch.column(0).slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([ids, pa.array(lengths), pa.array(per_text)], ["doc_id", "n_pre_tokens", "n_tokens"])

    return documents.select("doc_id", "text").mapInArrow(counted, SCHEMA)
