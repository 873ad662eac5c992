"""A piece vocabulary as a unigram model, and texts cut into pre-tokens.

The public vocabulary files hold merge ranks, no probabilities, and tokenizers
are not trained here.  The chance of a piece is therefore taken from its rank
by Zipf's law, ``1 / (rank + ZIPF)``; byte pieces come after all others.

A pre-token is a run of non-blank characters with the one space ahead of it, or
a single other blank.  Joined, pre-tokens are the text.  The space is written
as the mark of the vocabulary; a character without a piece of its own, and the
mark itself where it stands in a text, falls back to the bytes of UTF-8, so
that decoding gives back the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

MARK = "▁"
NO_PIECE = "\0"  # stands for a mark in a text; in no piece
ZIPF = 2.7
PRE_TOKEN = re.compile(r" ?[^ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]")
CHUNK_CHARS = 2_000_000
LONG = 64  # characters of a pre-token that is no part of the shared trie

# The pieces that are under way at a place of a text: where each began, and its node in the trie of pieces.
Open = list[tuple[int, dict]]


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with ids and log chances, and the ids and log chances of the 256 bytes."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    byte_scores: tuple[float, ...]
    spelled: tuple[bytes, ...]  # of each id

    def trie(self) -> dict:
        """Pieces by their characters; what a node spells, if anything, is at the key ``""``."""
        root: dict = {}
        for name, piece in self.pieces.items():
            node = root
            for character in name:
                node = node.setdefault(character, {})
            node[""] = piece
        return root

    def backward_trie(self) -> dict:
        """The same by their characters from the last to the first."""
        return Vocabulary({name[::-1]: piece for name, piece in self.pieces.items()}, (), (), ()).trie()

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)


class Steps:
    """The trie of pieces as arrays: states by number, 0 is the root.

    ``piece`` and ``score`` have what a state spells, -1 if nothing.
    """

    def __init__(self, vocabulary: Vocabulary):
        keys, states, piece, score = [], [], [-1], [0.0]
        pending = [(0, vocabulary.trie())]
        while pending:
            state, node = pending.pop()
            for character, further in node.items():
                if character:
                    keys.append(state << 21 | ord(character))
                    states.append(len(piece))
                    piece.append(further.get("", (-1, 0.0))[0])
                    score.append(further.get("", (-1, 0.0))[1])
                    pending.append((states[-1], further))
        order = np.argsort(np.array(keys, np.int64))
        self._keys, self._states = np.array(keys, np.int64)[order], np.array(states, np.int64)[order]
        self.piece, self.score = np.array(piece, np.int64), np.array(score)
        first = self._keys < 1 << 21
        self._from_root = np.full(1 << 21, -1, np.int32)
        self._from_root[self._keys[first]] = self._states[first]

    def start(self, codes: np.ndarray) -> np.ndarray:
        """The states a piece is in after its first character; -1 if there is no such piece."""
        return self._from_root[codes].astype(np.int64)

    def go(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The states after one more character; -1 if no piece goes on like that."""
        wanted = states << 21 | codes
        at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
        return np.where(self._keys[at] == wanted, self._states[at], -1)


@dataclass(frozen=True)
class Level:
    """The nodes of one depth in a trie of pre-tokens, numbered from ``first`` on, and the edges that lead back from them.

    Edges stand together by node, longer pieces first: ``begins`` has the place
    of each node's first edge.  An edge leads to the node ``source``; it spells
    the piece ``spelling``, or the character ``-1 - spelling`` in bytes, has
    the log chance ``score`` and gives ``tokens`` ids.
    """

    first: int
    begins: np.ndarray
    owner: np.ndarray
    source: np.ndarray
    spelling: np.ndarray
    score: np.ndarray
    tokens: np.ndarray


class SharedTrie:
    """The trie of sorted, distinct pre-tokens, level by level; node 0 is the empty prefix.

    ``terminal`` has the node of each whole pre-token once all levels were read.
    """

    def __init__(self, pre_tokens: list[str], steps: Steps, vocabulary: Vocabulary):
        self._steps = steps
        self._lengths = np.fromiter(map(len, pre_tokens), np.int64, len(pre_tokens))
        depth = int(self._lengths.max(initial=0))
        inside = np.arange(depth) < self._lengths[:, None]
        self._raw = np.zeros((len(pre_tokens), depth), np.int64)
        self._raw[inside] = np.frombuffer("".join(pre_tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
        self._codes = np.where(self._raw == ord(MARK), ord(NO_PIECE), self._raw)
        if depth:
            self._codes[self._raw[:, 0] == ord(" "), 0] = ord(MARK)
        # How many characters a pre-token shares with the one ahead of it.
        differ = self._raw[1:] != self._raw[:-1]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1) if depth else 0, depth)
        short = np.minimum(self._lengths[1:], self._lengths[:-1])
        self._shared = np.concatenate(([-1], np.minimum(shared, short)))[: len(pre_tokens)]
        self.terminal = np.zeros(len(pre_tokens), np.int64)
        self._vocabulary = vocabulary

    def bytes_of(self, code: int) -> tuple[list[int], float]:
        return byte_edge(chr(code), 0, self._vocabulary)

    def levels(self) -> Iterator[Level]:
        node_of_row = np.zeros(len(self._lengths), np.int64)
        first = 1
        # Pieces under way at the nodes of the level ahead: together by node, in the order they began.
        owner, source, state = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        above, n_above = 0, 1  # first node and number of nodes of the level ahead
        for depth in range(self._raw.shape[1]):
            rows = np.flatnonzero(self._lengths > depth)
            new = self._shared[rows] <= depth
            leads = rows[new]
            codes, parents = self._codes[leads, depth], node_of_row[leads]
            count = len(leads)
            node_of_row[rows] = first + np.cumsum(new) - 1
            # Each child goes on with the pieces of its parent, and with one that begins at it.
            per_node = np.bincount(owner - above, minlength=n_above) if len(owner) else np.zeros(n_above, np.int64)
            starts = np.cumsum(per_node) - per_node
            held = per_node[parents - above]
            child = np.repeat(np.arange(count), held)
            at = np.arange(len(child)) - np.repeat(np.cumsum(held) - held, held) + np.repeat(starts[parents - above], held)
            going = self._steps.go(state[at], codes[child])
            alive = going >= 0
            own = self._steps.start(codes)
            begun = own >= 0
            owner = np.concatenate((child[alive], np.flatnonzero(begun)))
            order = np.argsort(owner, kind="stable")
            owner = owner[order]
            source = np.concatenate((source[at[alive]], parents[begun]))[order]
            state = np.concatenate((going[alive], own[begun]))[order]
            yield self._level(first, count, owner, source, state, self._raw[leads, depth], begun & (self._steps.piece[own] >= 0), parents)
            owner = owner + first
            done = rows[self._lengths[rows] == depth + 1]
            self.terminal[done] = node_of_row[done]
            above, n_above, first = first, count, first + count

    def _level(self, first, count, owner, source, state, raw, named, parents) -> Level:
        """The edges of the pieces that end at a level, and those of characters without a piece."""
        piece = self._steps.piece[state]
        ends = piece >= 0
        nameless = np.flatnonzero(~named)
        tokens, scores = np.ones(len(nameless), np.int64), np.zeros(len(nameless))
        for code in np.unique(raw[nameless]).tolist():
            ids, cost = self.bytes_of(code)
            here = raw[nameless] == code
            tokens[here], scores[here] = len(ids), cost
        owners = np.concatenate((owner[ends], nameless))
        order = np.argsort(owners, kind="stable")  # a character spelled in bytes comes after the pieces
        owners = owners[order]
        return Level(
            first,
            np.searchsorted(owners, np.arange(count)),
            owners,
            np.concatenate((source[ends], parents[nameless]))[order],
            np.concatenate((piece[ends], -1 - raw[nameless]))[order],
            np.concatenate((self._steps.score[state[ends]], scores))[order],
            np.concatenate((np.ones(int(ends.sum()), np.int64), tokens))[order],
        )


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str | None = None) -> Vocabulary:
    """Read a sentencepiece file with byte pieces; the driver does it once."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or default_path())
    size = model.get_piece_size()
    names = [model.id_to_piece(k) for k in range(size)]
    plain = [k for k in range(size) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))]
    plain = [k for k in plain if MARK not in names[k][1:] and NO_PIECE not in names[k]]
    byte_ids = [k for k in range(size) if model.is_byte(k)]
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary needs a piece for each byte")
    ranks = {k: rank for rank, k in enumerate(plain + byte_ids)}
    total = np.log(sum(1 / (rank + ZIPF) for rank in ranks.values()))
    scores = {k: float(-np.log(rank + ZIPF) - total) for k, rank in ranks.items()}
    spelled = [b""] * size
    for k in plain:
        spelled[k] = names[k].replace(MARK, " ").encode()
    for value, k in enumerate(byte_ids):
        spelled[k] = bytes([value])
    return Vocabulary(
        {names[k]: (k, scores[k]) for k in plain},
        tuple(byte_ids),
        tuple(scores[k] for k in byte_ids),
        tuple(spelled),
    )


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text that ids were made from; control ids spell nothing."""
    spelled = vocabulary.spelled
    return b"".join([spelled[k] for k in ids]).decode("utf-8", "surrogatepass")


def written(pre_token: str) -> str:
    """As the vocabulary writes it."""
    if MARK in pre_token:
        pre_token = pre_token.replace(MARK, NO_PIECE)
    return MARK + pre_token[1:] if pre_token[0] == " " else pre_token


def byte_edge(pre_token: str, at: int, vocabulary: Vocabulary) -> tuple[list[int], float]:
    """Ids and log chance of one character spelled in bytes."""
    spelled = pre_token[at].encode("utf-8", "surrogatepass")
    return [vocabulary.byte_ids[b] for b in spelled], sum(vocabulary.byte_scores[b] for b in spelled)


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    """A batch in runs of rows of about CHUNK_CHARS characters: first row, row after the last, texts."""
    start, size, texts = 0, 0, []
    for k in range(batch.num_rows):
        text = batch.column(column)[k].as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= CHUNK_CHARS:
            yield start, k + 1, texts
            start, size, texts = k + 1, 0, []
    if texts:
        yield start, batch.num_rows, texts


class Numbering(dict):
    """Numbers pre-tokens in the order they come."""

    def __missing__(self, pre_token: str) -> int:
        number = self[pre_token] = len(self)
        return number


def numbered(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pre-tokens, the number of each occurrence, and how many each text has."""
    numbers = Numbering()
    occurrences, lengths = [], []
    for text in texts:
        found = PRE_TOKEN.findall(text)
        occurrences.extend([numbers[x] for x in found])
        lengths.append(len(found))
    return list(numbers), np.array(occurrences, np.int64), np.array(lengths, np.int64)


def parted(pre_tokens: list[str]) -> tuple[list[int], list[int]]:
    """Places of the pre-tokens for the shared trie, sorted as it wants them, and of the long ones."""
    usual, long = [], []
    for k, pre_token in enumerate(pre_tokens):
        (long if len(pre_token) > LONG else usual).append(k)
    return sorted(usual, key=pre_tokens.__getitem__), long


def advance(under_way: Open, root: dict, at: int, character: str) -> tuple[Open, list[tuple[int, tuple[int, float]]]]:
    """Take one more character: the pieces still under way, and those that end with it (start, piece)."""
    going, ended = [], []
    for start, node in under_way:
        further = node.get(character)
        if further is not None:
            going.append((start, further))
            if "" in further:
                ended.append((start, further[""]))
    further = root.get(character)
    if further is not None:
        going.append((at, further))
        if "" in further:
            ended.append((at, further[""]))
    return going, ended
