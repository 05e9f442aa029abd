"""Deep-shallow sorting of byte suffixes, in numpy for use inside tasks."""

from __future__ import annotations

import numpy as np


def _characters(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """``size`` (at most 8) bytes from each place as one big-endian number."""
    key = np.zeros(len(at), np.uint64)
    for j in range(size):
        key = (key << np.uint64(8)) | data[at + j].astype(np.uint64)
    return key


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Group numbers of rows that follow each other with equal values."""
    new = np.zeros(len(columns[0]), bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def deep_shallow(data: np.ndarray, starts: np.ndarray, depth: int, shallow: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Order suffixes by their first ``depth`` bytes: (order, group), equal group = equal bytes.

    Every suffix must have ``depth`` bytes. Down to ``shallow`` bytes this is
    multikey quicksort on characters of eight bytes: each group of suffixes that
    still agree is sorted by its next character. Groups that agree for longer
    have long common prefixes and go into blind tries, built from the root: a
    node is the first place at which its members differ, only the byte at that
    place is looked at, and its members part by it.
    """
    order, group = np.arange(len(starts)), np.zeros(len(starts), np.int64)
    shallow = min(shallow, depth)
    for at in range(0, shallow, 8):
        key = _characters(data, starts[order] + at, min(8, shallow - at))
        by = np.lexsort((key, group))
        order = order[by]
        group = _runs(group[by], key[by])
    return _blind_tries(data, starts, order, group, shallow, depth)


def _blind_tries(data, starts, order, group, shallow: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    if shallow >= depth or not len(order):
        return order, group
    live = np.flatnonzero(np.bincount(group)[group] > 1)
    final = np.searchsorted(group, group, "left")  # the sorted place at which each suffix's group begins
    while len(live):
        at = starts[order[live]]
        node = _runs(final[live])
        head = np.searchsorted(node, np.arange(node[-1] + 1))
        first = np.full(len(live), depth)
        same = np.ones(len(live), bool)  # of each member: no difference from the node's head yet
        for place in range(shallow, depth):
            check = np.flatnonzero(same)
            if not len(check):
                break
            differs = check[data[at[check] + place] != data[at[head[node[check]]] + place]]
            first[differs] = place
            same[differs] = False
        branch = np.minimum.reduceat(first, head)
        byte = np.zeros(len(live), np.uint8)
        split = branch[node] < depth
        byte[split] = data[at[split] + branch[node][split]]
        by = np.lexsort((byte, node))
        order[live] = order[live][by]
        byte = byte[by]
        child = _runs(node, byte)
        begin = np.searchsorted(child, np.arange(child[-1] + 1))
        final[live] = live[begin][child]
        more = split & (np.bincount(child)[child] > 1)  # node and split follow the sorted order: nodes stay in place
        live = live[more]
    return order, _runs(final)
