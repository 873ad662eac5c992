from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallybook.llm import pieces, sampling, token_counts
from tallybook.llm.pieces import byte_edge, decode, load, written
from tallybook.llm.queries import QUERIES

TEXT = st.text(alphabet=st.sampled_from("the quick ▁\0\n\té漢🙂<0x41>"), max_size=40)


@pytest.fixture(scope="module")
def vocabulary():
    return load()


def segmentations(pre_token: str, vocabulary) -> dict[tuple[int, ...], float]:
    """All segmentations with their log chances."""
    word = written(pre_token)
    ways = {0: {(): 0.0}}
    for stop in range(1, len(word) + 1):
        ways[stop] = {}
        edges = [(k, [vocabulary.pieces[word[k:stop]][0]], vocabulary.pieces[word[k:stop]][1]) for k in range(stop) if word[k:stop] in vocabulary.pieces]
        if word[stop - 1] not in vocabulary.pieces:
            edges.append((stop - 1, *byte_edge(pre_token, stop - 1, vocabulary)))
        for start, ids, score in edges:
            ways[stop].update({(*way, *ids): before + score for way, before in ways[start].items()})
    return ways[len(word)]


def test_chances_of_pieces_add_up_to_one(vocabulary):
    total = sum(math.exp(x) for _, x in vocabulary.pieces.values()) + sum(map(math.exp, vocabulary.byte_scores))
    assert abs(total - 1) < 1e-9


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(TEXT, max_size=5))
def test_round_trip(vocabulary, texts):
    ids, sizes = sampling.sampled_ids(texts, list(range(len(texts))), vocabulary, 42)
    ends = np.cumsum(sizes)
    assert [decode(ids[b - n : b], vocabulary) for b, n in zip(ends, sizes)] == texts


@settings(max_examples=80, deadline=None)
@given(texts=st.lists(st.text(alphabet="the▁q \né🙂", min_size=1, max_size=7), min_size=1, max_size=8))
def test_counts_against_all_segmentations(vocabulary, texts):
    distinct, _, _ = pieces.numbered(texts)
    counts = token_counts.terminal_counts(distinct, vocabulary)
    for pre_token, n in zip(distinct, counts):
        ways = segmentations(pre_token, vocabulary)
        best = max(ways.values())
        assert n == min(len(way) for way, score in ways.items() if score > best - 1e-9)


def test_samples_follow_the_chances(vocabulary):
    words = [" there", " the", "theré"]
    ids, sizes = sampling.sampled_ids(["".join(words[:2]) + words[2]] * 1, [0], vocabulary, 1)
    for word in words:
        ways = segmentations(word, vocabulary)
        total = sum(map(math.exp, ways.values()))
        drawn = 20_000
        ids, sizes = sampling.sampled_ids([word] * drawn, list(range(drawn)), vocabulary, 7)
        ends = np.cumsum(sizes)
        seen = Counter(tuple(ids[b - n : b].tolist()) for b, n in zip(ends, sizes))
        assert set(seen) <= set(ways)
        for way, score in ways.items():
            share = math.exp(score) / total
            assert abs(seen[way] / drawn - share) < 5 * math.sqrt(share / drawn) + 1e-3


def test_a_rows_sample_depends_on_its_key_alone(vocabulary):
    text = "there and then the others gathered together"
    alone, _ = sampling.sampled_ids([text], [5], vocabulary, 42)
    both, sizes = sampling.sampled_ids(["gather", text], [4, 5], vocabulary, 42)
    assert both[sizes[0] :].tolist() == alone.tolist()
    other, _ = sampling.sampled_ids([text], [6], vocabulary, 42)
    assert other.tolist() != alone.tolist()


def test_small_chunks_change_nothing(spark, small, monkeypatch):
    expected = {tuple(r) for r in QUERIES["op6_token_counts"](spark, small).collect()}
    monkeypatch.setattr(pieces, "CHUNK_CHARS", 500)
    assert {tuple(r) for r in QUERIES["op6_token_counts"](spark, small).collect()} == expected


def test_queries_over_whole_texts(spark, small, vocabulary):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = QUERIES["op7_sampling"](spark, small).collect()
    assert {r.doc_id: decode(r.ids, vocabulary) for r in rows} == texts
    assert all(r.lossless and r.n_ids == len(r.ids) for r in rows)
    again = QUERIES["op7_sampling"](spark, small).repartition(7).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    counts = {r.doc_id: r.n_pre_tokens for r in QUERIES["op6_token_counts"](spark, small).collect()}
    assert counts == {k: len(pieces.PRE_TOKEN.findall(x)) for k, x in texts.items()}


def test_edge_cases(edge_documents, no_documents, vocabulary):
    texts = sorted((r.doc_id or -1, r.text or "") for r in edge_documents.collect())
    rows = sampling.encode(edge_documents).collect()
    assert sorted((r.doc_id or -1, decode(r.ids, vocabulary)) for r in rows) == texts
    assert all(r.lossless for r in rows)
    counted = token_counts.count_tokens(edge_documents).collect()
    assert sorted((r.doc_id or -1, r.n_pre_tokens) for r in counted) == sorted((k, len(pieces.PRE_TOKEN.findall(x))) for k, x in texts)
    assert sampling.encode(no_documents).count() == token_counts.count_tokens(no_documents).count() == 0


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(TEXT, max_size=5))
def test_long_words_alone_give_what_the_shared_trie_gives(vocabulary, texts):
    keys = list(range(len(texts)))
    ids, sizes = sampling.sampled_ids(texts, keys, vocabulary, 42)
    distinct, _, _ = pieces.numbered(texts)
    counts = token_counts.terminal_counts(distinct, vocabulary)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "LONG", 2)
        alone, alone_sizes = sampling.sampled_ids(texts, keys, vocabulary, 42)
        assert alone.tolist() == ids.tolist() and alone_sizes.tolist() == sizes.tolist()
        assert token_counts.terminal_counts(distinct, vocabulary).tolist() == counts.tolist()


def peak_mb(call) -> float:
    import tracemalloc

    tracemalloc.start()
    call()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_memory_of_one_very_long_word(vocabulary):
    """About 40 bytes a character at most, so 20 million of them fit a gigabyte; counting needs next to nothing."""
    word = "Zm9vYmFyMDEyMzQ1Njc4" * 10_000
    sampler, counter = sampling.Sampler(vocabulary, 42), token_counts.Counter(vocabulary)
    sampler.ids([word[:200]], [1])  # the tries
    assert peak_mb(lambda: sampler.ids([word], [1])) < 40e-6 * len(word) + 4
    assert peak_mb(lambda: counter.counts([word])) < 8e-6 * len(word) + 2
    ids, sizes = sampler.ids(["a " + word + " b", word], [1, 2])
    assert decode(ids[: sizes[0]], vocabulary) == "a " + word + " b" and decode(ids[sizes[0] :], vocabulary) == word


def test_steps_walk_the_trie(vocabulary):
    steps = pieces.Steps(vocabulary)
    for name, (piece, chance) in list(vocabulary.pieces.items())[::97]:
        state = steps.start(np.array([ord(name[0])]))
        for character in name[1:]:
            state = steps.go(state, np.array([ord(character)]))
        assert steps.piece[state[0]] == piece and steps.score[state[0]] == chance
    assert steps.start(np.array([0x10FFFF]))[0] == -1
    assert steps.go(steps.start(np.array([ord("t")])), np.array([0x10FFFF]))[0] == -1
