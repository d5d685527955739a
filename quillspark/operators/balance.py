"""Balancing variable-length sequences over partitions and micro-batches.

The sequential algorithms run on the lengths of one step (a bounded batch) inside one Arrow call; steps are spread.
"""

from __future__ import annotations

import functools
import heapq

import pandas as pd
from pyspark.sql import DataFrame


@functools.total_ordering
class _Largest:
    """Orders a heap by the largest key first."""

    def __init__(self, key):
        self.key = key

    def __eq__(self, other):
        return self.key == other.key

    def __lt__(self, other):
        return self.key > other.key


def largest_differencing(lengths: list[int], k: int, equal: bool = False) -> list[list[int]]:
    """k-way largest differencing: the two states of largest spread are merged, large sets with small ones.

    A set is (sum, size, items); ties go to the state with the larger first set. ``equal`` starts from k-tuples of neighbours in
    ascending order, so that all partitions have the same number of items, which must be a multiple of k.
    """
    if not lengths or k < 1 or len(lengths) < k:
        raise ValueError("at least one item for each partition is needed")
    if equal and len(lengths) % k:
        raise ValueError(f"{len(lengths)} items don't fill {k} equal partitions")
    ranked = sorted((n, i) for i, n in enumerate(lengths))
    step = k if equal else 1
    heap = []
    for at in range(0, len(ranked), step):
        sets = [(n, 1, ((i, n),)) for n, i in ranked[at : at + step]]
        heap.append(_state(sets + [(0, 0, ())] * (k - len(sets))))
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        heapq.heappush(heap, _state([(x[0] + y[0], x[1] + y[1], x[2] + y[2]) for x, y in zip(a, reversed(b), strict=True)]))
    return [sorted(i for i, _ in s[2]) for s in heap[0][1]]


def _state(sets: list[tuple]) -> tuple:
    sets = sorted(sets, reverse=True)
    return _Largest((sets[0][0] - sets[-1][0], sets[0])), sets


def least_loaded(lengths: list[int], k: int) -> list[int]:
    """Partition of each item: the least loaded one so far, in the order of arrival."""
    heap = [(0, p) for p in range(k)]
    out = []
    for n in lengths:
        load, p = heapq.heappop(heap)
        out.append(p)
        heapq.heappush(heap, (load + n, p))
    return out


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """Bin of each item: the first that has room, in the order of arrival; an item above the capacity fills a bin of its own."""
    room: list[int] = []
    out = []
    for n in lengths:
        at = next((i for i, r in enumerate(room) if r >= n), -1)
        if at < 0:
            room.append(capacity)
            at = len(room) - 1
        room[at] -= n
        out.append(at)
    return out


def chunks_by_size(lengths: list[int], limit: int) -> list[int]:
    """Chunk of each item of a stream: a new one begins when the sum would reach the limit."""
    out, chunk, held = [], 0, 0
    for n in lengths:
        if held and held + n >= limit:
            chunk, held = chunk + 1, 0
        held += n
        out.append(chunk)
    return out


def per_group(df: DataFrame, by: list[str], order: str, length: str, fn, out: str = "part") -> DataFrame:
    """Adds ``out``: the numbers that ``fn(lengths)`` gives to the rows of each group in their order."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        return rows.assign(**{out: fn([int(x) for x in rows[length]])})

    return df.groupBy(*by).applyInPandas(run, ", ".join(f"{c} {t}" for c, t in df.dtypes) + f", {out} int")


def balanced(lengths: list[int], k: int, equal: bool = False) -> list[int]:
    """Partition of each item by largest differencing; fewer items than partitions get one each."""
    if len(lengths) < k:
        return list(range(len(lengths)))
    out = [0] * len(lengths)
    for p, items in enumerate(checked_partitions(lengths, k, equal)):
        for i in items:
            out[i] = p
    return out


def checked_partitions(lengths: list[int], k: int, equal: bool = False) -> list[list[int]]:
    """Largest differencing, checked: k partitions, none empty, every item in exactly one, each in ascending order. Fewer items than partitions are an error."""
    if len(lengths) < k:
        raise ValueError(f"{len(lengths)} items for {k} partitions")
    parts = [sorted(p) for p in largest_differencing(lengths, k, equal)]
    if len(parts) != k or not all(parts) or sorted(i for p in parts for i in p) != list(range(len(lengths))):
        raise ValueError("the partitions don't cover the items")
    return parts


def micro_batches(df: DataFrame, step: str, rank: str, order: str, length: str, capacity: int, least: int = 1) -> DataFrame:
    """Adds ``mb``: the micro-batches of each rank and step. All ranks of a step get the same number, the most that any rank needs by
    first fit; lengths are then balanced within each rank. One step is one bounded batch."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([rank, order])
        parts = [(p, [int(x) for x in g[length]]) for p, g in rows.groupby(rank, sort=True)]
        n = max([least, *(max(first_fit(x, capacity)) + 1 for _, x in parts)])
        return rows.assign(mb=[m for _, x in parts for m in balanced(x, n)])

    return df.groupBy(step).applyInPandas(run, ", ".join(f"{c} {t}" for c, t in df.dtypes) + ", mb int")
