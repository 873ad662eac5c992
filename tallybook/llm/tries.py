"""Near-equal 64-bit numbers, by walking a binary trie against itself.

A sorted array of numbers is a trie: a node is a range of it that shares its
leading bits, and splits where the next bit turns from 0 to 1.  The walk holds
pairs of nodes of one depth with the number of bits in which their paths
differ, replaces each pair by the pairs of their children, and drops a pair
once the bits exceed the budget.  Pairs of nodes of few numbers are compared
number by number.
"""

from __future__ import annotations

import numpy as np

LEAF_PAIRS = 48  # two nodes with at most so many pairs of numbers are leaves
FRONTIER = 400_000  # node pairs walked at a time, the others wait; bounds the memory of a walk


def linked_groups(numbers: np.ndarray, starts: np.ndarray, stops: np.ndarray, budget: int, first_bit: int = 63) -> np.ndarray:
    """For each number the index of its group's first member, within its range.

    ``numbers`` (uint64) are distinct and sorted within each range [start,
    stop).  Two numbers of a range are linked if they differ in ``budget`` bits
    at most; groups are what links connect.  Bits above ``first_bit`` must be
    equal within a range.

    The budget is raised bit by bit.  What a lower budget has connected is not
    walked again: a pair of nodes whose numbers all lie in one group is
    dropped, so the walk of a crowd of near copies does not list its pairs.
    """
    group = np.arange(len(numbers))
    for allowed in range(1, budget + 1):
        _walk(numbers, starts, stops, allowed, first_bit, group)
    return group


def _walk(numbers, starts, stops, allowed, first_bit, group) -> None:
    wide = stops - starts > 1
    roots = starts[wide].astype(np.int64), stops[wide].astype(np.int64)
    waiting = [(first_bit, (*roots, *roots, np.zeros(len(roots[0]), np.int8)))]
    while waiting:
        bit, pairs = waiting.pop()
        while len(pairs[0]):
            if len(pairs[0]) > FRONTIER:
                waiting.append((bit, tuple(x[FRONTIER // 2 :] for x in pairs)))
                pairs = tuple(x[: FRONTIER // 2] for x in pairs)
            pairs = _open(pairs, group)
            pairs = _leaves(numbers, pairs, allowed, group)
            if bit < 0:
                break
            pairs = _children(numbers, pairs, bit, allowed)
            bit -= 1


def _open(pairs, group):
    """Without the pairs that lie in one group."""
    a0, a1, b0, b1, _ = pairs
    changes = np.concatenate(([0], np.cumsum(group[1:] != group[:-1])))
    done = (changes[a1 - 1] == changes[a0]) & (changes[b1 - 1] == changes[b0]) & (group[a0] == group[b0])
    return tuple(x[~done] for x in pairs)


def _leaves(numbers, pairs, allowed, group):
    """Compare the numbers of small nodes; return the other pairs."""
    a0, a1, b0, b1, _ = pairs
    size = (a1 - a0) * (b1 - b0)
    small = size <= LEAF_PAIRS
    a, b, wide, size = a0[small], b0[small], (b1 - b0)[small], size[small]
    step = max(1, 4_000_000 // LEAF_PAIRS)
    for k in range(0, len(a), step):
        n = size[k : k + step]
        which = np.repeat(np.arange(k, k + len(n)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i, j = a[which] + at // wide[which], b[which] + at % wide[which]
        near = (i < j) & (np.bitwise_count(numbers[i] ^ numbers[j]) <= allowed)
        _connect(group, i[near], j[near])
    return tuple(x[~small] for x in pairs)


def _children(numbers, pairs, bit, allowed):
    a0, a1, b0, b1, differ = pairs
    ones = np.concatenate(([0], np.cumsum((numbers >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)))
    am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
    same = a0 == b0
    apart = differ < allowed
    cross = apart & ~same
    made = [
        (a0, am, b0, bm, differ, np.ones(len(a0), bool)),
        (am, a1, bm, b1, differ, np.ones(len(a0), bool)),
        (a0, am, bm, b1, differ + 1, apart),
        (am, a1, b0, bm, differ + 1, cross),
    ]
    kept = []
    for p0, p1, q0, q1, d, keep in made:
        keep = keep & (p1 > p0) & (q1 > q0) & ~((p0 == q0) & (p1 - p0 < 2))
        kept.append((p0[keep], p1[keep], q0[keep], q1[keep], d[keep].astype(np.int8)))
    return tuple(np.concatenate(x) for x in zip(*kept))


def _connect(group: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the groups of i and j; a group is named by its least index."""
    while len(i):
        left, right = group[i], group[j]
        apart = left != right
        if not apart.any():
            return
        i, j, left, right = i[apart], j[apart], left[apart], right[apart]
        np.minimum.at(group, np.maximum(left, right), np.minimum(left, right))
        while not np.array_equal(further := group[group], group):
            group[:] = further
