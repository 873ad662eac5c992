from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybook.llm import simhash
from tallybook.llm.components import components
from tallybook.llm.queries import QUERIES
from tallybook.llm.tries import linked_groups


def plain_fingerprint(text: str | None, size: int = 3) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(numbers: list[int], budget: int) -> list[int]:
    """Least index of each number's group, pair by pair."""
    group = list(range(len(numbers)))
    changed = True
    while changed:
        changed = False
        for i in range(len(numbers)):
            for j in range(i):
                if (numbers[i] ^ numbers[j]).bit_count() <= budget and group[i] != group[j]:
                    low, high = sorted((group[i], group[j]))
                    group = [low if x == high else x for x in group]
                    changed = True
    return group


def crowd(size: int, seed: int, flips: int = 12) -> list[int]:
    """Numbers near a few centres, some far apart."""
    draw = random.Random(seed)
    centres = [draw.getrandbits(64) for _ in range(4)]
    found = set()
    while len(found) < size:
        number = draw.choice(centres)
        for bit in draw.sample(range(64), draw.randrange(flips)):
            number ^= 1 << bit
        found.add(number)
    return sorted(found)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_fingerprint(text):
    text = text.encode("utf-8", "ignore").decode()
    assert simhash.simhash(text.encode()) % 2**64 == plain_fingerprint(text)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("budget", [1, 2, 3])
def test_trie_walk_finds_the_groups(seed, budget):
    numbers = crowd(150, seed, flips=7)
    found = linked_groups(np.array(numbers, np.uint64), np.array([0]), np.array([len(numbers)]), budget)
    assert found.tolist() == plain_groups(numbers, budget)


def test_trie_walk_in_small_pieces(monkeypatch):
    numbers = crowd(400, 1, flips=8)
    monkeypatch.setattr("tallybook.llm.tries.FRONTIER", 50)
    found = linked_groups(np.array(numbers, np.uint64), np.array([0]), np.array([len(numbers)]), 3)
    assert found.tolist() == plain_groups(numbers, 3)


@pytest.mark.parametrize("crowded", [20_000, 5])
def test_links_of_crowded_tops(spark, monkeypatch, crowded):
    """With a low bound every top is split twice."""
    monkeypatch.setattr(simhash, "CROWD", crowded)
    monkeypatch.setattr(simhash, "CHUNK", 64)
    numbers = crowd(300, 3, flips=8)
    signed = [(x - 2**64 if x >= 2**63 else x,) for x in numbers]
    roots = components(simhash.links(spark.createDataFrame(signed, "fp bigint"))).collect()
    root = {r.node: r.root for r in roots}
    expected = plain_groups(numbers, 3)
    least = {}
    for g, (x,) in zip(expected, signed):
        least[g] = min(least.get(g, x), x)
    assert [root.get(x, x) for (x,) in signed] == [least[g] for g in expected]


def test_components_of_chain_star_and_loop(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (500, 501), (501, 500), (100, 101)], "u bigint, v bigint")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 500: 500, 501: 500}


def test_query_against_brute_force(spark, small):
    rows = QUERIES["op3_simhash"](spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[k]) for k in ids]
    groups = plain_groups(prints, 3)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        k: (f"{p:016x}", ids[g]) for k, p, g in zip(ids, prints, groups)
    }


def test_edge_cases(edge_documents, no_documents):
    rows = simhash.near_duplicates(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    blank = [r for r in rows if r.fp == 0]
    assert len(blank) == 3 and {r.component_id for r in blank} == {1}
    assert simhash.near_duplicates(no_documents).count() == 0
    assert simhash.one_of_each(no_documents).columns == no_documents.columns


def test_one_of_each_keeps_one(edge_documents):
    kept = simhash.one_of_each(edge_documents)
    assert kept.columns == edge_documents.columns
    assert sorted((r.doc_id, len(r.text)) for r in kept.collect()) == sorted(
        (k, len(t)) for k, t in {(r.doc_id, r.text) for r in edge_documents.where(F.col("doc_id").isin(1, 3, 4, 5)).collect()}
    )
