"""SimHash near-duplicates: fingerprints linked by a self-join of binary tries.

The top of the trie is dealt out by Spark.  Two numbers of 64 bits that differ
in at most three share one of four blocks of 16 bits, so each distinct
fingerprint goes into four tries, rotated to have one block on top, and the
walk of a trie starts below that block.  A top with too many fingerprints is
split again by the same rule (blocks of 12, then of 9 bits), so a task's share
stays small at any input size.  Copies of a text have one fingerprint, which is
walked once.  A task returns its fingerprints' groups, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tallybook.llm.common import broadcast_if_small, fresh, settled
from tallybook.llm.components import components
from tallybook.llm.tries import linked_groups

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
CROWD = 20_000  # fingerprints below one top of the trie; with more it is split
CHUNK = 100_000  # fingerprints walked at a time
BYTE_OFFSETS = np.arange(8) * 256
BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1


def simhash(text: bytes | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Fingerprint of a text in UTF-8, as a signed number; 0 if it has no word."""
    # bytes.lower and bytes.split know A-Z and the six ASCII blanks only, as wanted.
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.cumsum(lengths + 1) - 1
        spans = zip((stops - lengths)[: len(words) - shingle_words + 1].tolist(), stops[shingle_words - 1 :].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
    # How often each byte value occurs at each of the eight places gives the votes of all 64 bits.
    places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + BYTE_OFFSETS
    votes = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ BITS_OF_BYTE
    bits = (2 * votes > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprint(text: str = "text", shingle_words: int = SHINGLE_WORDS) -> Column:
    @pandas_udf("bigint")
    def fingerprints(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(x, shingle_words) for x in texts], dtype="int64")

    return fingerprints(F.col(text).cast("binary"))


def _dealt(rows: DataFrame, fixed: int, block: int, top: str) -> DataFrame:
    """Four copies of each (path, turned): turned below its ``fixed`` leading bits, a new path."""
    low = 64 - fixed
    mask = (1 << low) - 1 if low < 64 else -1
    free = f"(turned & {mask}L)"
    copies = []
    for k in range(4):
        shift = k * block
        if shift == 0:
            moved = free
        else:
            moved = f"((shiftleft({free}, {shift}) | shiftrightunsigned({free}, {low - shift})) & {mask}L)"
        copies.append(f"struct({k} as turn, {moved} as moved)")
    kept = f"(turned & ~{mask}L) | copy.moved" if low < 64 else "copy.moved"
    dealt = rows.select("path", "fp", "turned", F.explode(F.expr(f"array({', '.join(copies)})")).alias("copy"))
    dealt = dealt.select(F.expr("path * 4 + copy.turn").alias("path"), "fp", F.expr(kept).alias("turned"))
    return dealt.withColumn(top, F.expr(f"shiftrightunsigned(turned, {low - block})"))


def _links_below(dealt: DataFrame, fixed: int, max_bits: int) -> DataFrame:
    """Links (u, v) of each fingerprint to one of its group, below a common top."""

    def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, turned, fp in _chunks(batches, fixed):
            numbers = turned.view(np.uint64)
            cut = np.flatnonzero(_tops_differ(path, turned, fixed)) + 1
            starts, stops = np.concatenate(([0], cut)), np.concatenate((cut, [len(fp)]))
            group = linked_groups(numbers, starts, stops, max_bits, 63 - fixed)
            tied = np.flatnonzero(group != np.arange(len(group)))
            if len(tied):
                yield pa.RecordBatch.from_arrays([pa.array(fp[tied]), pa.array(fp[group[tied]])], ["u", "v"])

    sorted_tries = dealt.select("path", "top", "turned", "fp").repartition("path", "top")
    sorted_tries = sorted_tries.sortWithinPartitions("path", "top", "turned").drop("top")
    return sorted_tries.mapInArrow(walk, "u bigint, v bigint")


def _tops_differ(path: np.ndarray, turned: np.ndarray, fixed: int) -> np.ndarray:
    top = turned.view(np.uint64) >> np.uint64(64 - fixed)
    return (path[1:] != path[:-1]) | (top[1:] != top[:-1])


def _chunks(batches: Iterable[pa.RecordBatch], fixed: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Sorted rows in pieces of about CHUNK that end with a top of the trie."""
    held: list[np.ndarray] = []
    for batch in batches:
        held.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]))
        if sum(x.shape[1] for x in held) >= CHUNK:
            rows = np.concatenate(held, axis=1)
            ends = np.flatnonzero(_tops_differ(rows[0], rows[1], fixed))
            if len(ends):
                yield tuple(np.ascontiguousarray(x) for x in rows[:, : ends[-1] + 1])
                rows = rows[:, ends[-1] + 1 :]
            held = [rows]
    if held:
        yield tuple(np.ascontiguousarray(x) for x in np.concatenate(held, axis=1))


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) that connect whatever distinct fingerprints ``fp`` differ in ``max_bits`` (1 to 3) at most.

    They need not list each near pair, but connect exactly the same groups.
    """
    if not 1 <= max_bits <= 3:
        raise ValueError("four blocks find fingerprints that differ in 1 to 3 bits")
    rows = fingerprints.select(F.lit(0).cast("bigint").alias("path"), "fp", F.col("fp").alias("turned"))
    found, fixed = None, 0
    for block in (16, 12, 9):
        dealt = _dealt(rows, fixed, block, "top")
        fixed += block
        last = block == 9
        if last:
            small = dealt
        else:
            crowded = settled(dealt.groupBy("path", "top").count().where(F.col("count") > CROWD).select("path", "top"))
            crowded = broadcast_if_small(crowded)
            small = dealt.join(crowded, ["path", "top"], "left_anti")
        here = _links_below(small, fixed, max_bits)
        found = here if found is None else found.unionByName(here)
        if last or crowded.isEmpty():
            return found
        rows = dealt.join(crowded, ["path", "top"], "left_semi").select("path", "fp", "turned")
    return found


def near_duplicates(
    documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``documents``: doc_id, mark, fp, group, component_id.

    ``mark`` is the hash of the text, ``group`` the least fingerprint of the
    component and ``component_id`` its least doc_id (NULL if all are NULL).
    Texts that are NULL, empty or blank have fingerprint 0 and are linked like
    any other; other columns are ignored; an empty table gives none.
    """
    marked = settled(
        documents.select("doc_id", F.xxhash64("text").alias("mark"), fingerprint("text", shingle_words).alias("fp"))
    )
    distinct = settled(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(links(distinct, max_bits))
    named = distinct.alias("d").join(roots.alias("r"), F.expr("d.fp = r.node"), "left")
    named = settled(named.select("d.fp", "d.first_id", F.coalesce("r.root", "d.fp").alias("group")))
    ids = named.groupBy("group").agg(F.min("first_id").alias("component_id"))
    named = named.select("fp", "group").join(ids, "group")
    return marked.join(named, "fp").select("doc_id", "mark", "fp", "group", "component_id")


def one_of_each(documents: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each group of near-duplicates: that of the least doc_id, with all its columns.

    NULL ids come last; of rows with the same id, that of the least text hash
    stays, and of equal rows one.
    """
    rows = near_duplicates(documents, shingle_words, max_bits)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "mark")
    chosen = rows.groupBy("group").agg(F.min(order).alias("chosen")).select("chosen.doc_id", "chosen.mark")
    mark = fresh(documents, "mark")
    marked = documents.withColumn(mark, F.xxhash64("text"))
    kept = marked.alias("d").join(chosen.alias("c"), F.expr(f"d.doc_id <=> c.doc_id and d.{mark} = c.mark"), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).drop(mark)
