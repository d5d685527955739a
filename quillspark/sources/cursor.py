"""A prompt source with a cursor: takes go on where the last one ended, over the end of an epoch, and a buffer of recycled groups goes first."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.ordering import row_index


@dataclass
class State:
    """Where the source stands; what is saved and restored."""

    epoch: int = 0
    offset: int = 0
    group_index: int = 0
    index: int = 0


class PromptSource:
    """Prompts of ``df`` in a seeded order that is new in every epoch, ``copies`` samples each.

    A take that reaches over the end gets the rest of the epoch and the head of the next one. It wraps once: a take larger than the rest and one more epoch gets less
    than it asks for. Recycled rows added to the buffer are taken first, ``first`` of them at a time by ``pick`` (the earliest by default).
    """

    def __init__(self, df: DataFrame, key: str, seed: int | None = 7, copies: int = 1, state: State | None = None, pick: Callable[[DataFrame, int], DataFrame] | None = None):
        self.df, self.key, self.seed, self.copies, self.state = df, key, seed, copies, state or State()
        self.size = df.count()
        self.buffer: DataFrame | None = None
        self.pick = pick or (lambda rows, n: rows.orderBy(self.key).limit(n))

    def epoch(self, e: int) -> DataFrame:
        """``key, pos``: the order of an epoch, the same under any partitioning; without a seed the key's own."""
        k = F.col(self.key) if self.seed is None else F.md5(F.concat(F.lit(f"{self.seed}-{e}-"), F.col(self.key).cast("string")))
        return row_index(self.df.select(self.key, k.alias("_k")), "_k", self.key, name="pos").select(self.key, "pos")

    def add(self, rows: DataFrame) -> None:
        """Adds rows with the key to the buffer."""
        own = rows.select(self.key)
        self.buffer = own if self.buffer is None else self.buffer.unionByName(own)

    def take(self, n: int) -> DataFrame:
        """``origin, epoch, key, pos, group_index, index`` of the next n prompts; rows of the buffer have no epoch and position."""
        out = None
        if self.buffer is not None and n > 0:
            got = self.pick(self.buffer, n)
            have = got.count()
            self.buffer = self.buffer.exceptAll(got)
            if have:
                rows = row_index(got, self.key, name="nth").select(F.lit("buffer").alias("origin"), F.lit(None).cast("int").alias("epoch"), self.key, F.lit(None).cast("long").alias("pos"), "nth")
                out, n = self._numbered(rows, have), n - have
        if n > 0:
            s = self.state
            end = s.offset + n
            parts = [self._part(s.epoch, s.offset, min(end, self.size), 0)]
            got = max(0, min(end, self.size) - s.offset)
            if end <= self.size:
                s.offset = end
            else:
                rest = n - got
                s.epoch, s.offset = s.epoch + 1, rest
                parts.append(self._part(s.epoch, 0, rest, got))
                got += min(rest, self.size)
            rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
            taken = self._numbered(rows, got)
            out = taken if out is None else out.unionByName(taken)
        return out if out is not None else self._numbered(self._part(0, 0, 0, 0), 0)

    def _part(self, e: int, start: int, end: int, before: int) -> DataFrame:
        x = self.epoch(e).where((F.col("pos") >= start) & (F.col("pos") < end))
        return x.select(F.lit("dataset").alias("origin"), F.lit(e).alias("epoch"), self.key, "pos", (F.col("pos") - start + before).alias("nth"))

    def _numbered(self, rows: DataFrame, n: int) -> DataFrame:
        s, c = self.state, self.copies
        g = F.col("nth") + s.group_index
        j = F.explode(F.sequence(F.lit(0), F.lit(c - 1)))
        out = rows.select("origin", "epoch", self.key, "pos", g.alias("group_index"), "nth", j.alias("j")).select("origin", "epoch", self.key, "pos", "group_index", (F.col("nth") * c + F.col("j") + s.index).alias("index"))
        s.group_index, s.index = s.group_index + n, s.index + n * c
        return out

    def saved(self) -> dict:
        return asdict(self.state)
