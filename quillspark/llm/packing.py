"""Problem 5: filling fixed-capacity containers with items.

Vector best fit in falling order of size. A container has three residual capacities: tokens, documents and attention cost
(the sum of squared lengths). An item goes to the open container that takes it under every constraint and is left with the
smallest weighted residual norm; if none does, a new one is opened. Items are spread over shards by a hash, each shard is
packed by itself, and every shard wastes at most its last containers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import encoder, map_batches, spread, tokenizer_path

#: Items of one shard, on average.
SHARD_ITEMS = 16_384
#: Most pack sizes; more are an error.
MOST_PACKS = 1000


@dataclass(frozen=True)
class Limits:
    """``documents`` is the most pieces in a container; ``attention`` caps the sum of squared lengths as a share of
    capacity squared (at 1 a single full piece just fits, so the cap excludes nothing that fits by tokens). A piece is never larger than a container takes under every limit."""

    documents: int = 512
    attention: float = 1.0
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)

    def largest(self, capacity: int) -> int:
        """Tokens of the largest piece: the capacity, or what the attention cap allows by itself."""
        return max(1, min(capacity, math.isqrt(int(self.attention * capacity**2))))


def best_fit(sizes: np.ndarray, capacity: int, limits: Limits = Limits()) -> np.ndarray:  # noqa: B008
    """Container number of each piece; no piece is larger than ``limits.largest(capacity)``."""
    n = len(sizes)
    out = np.full(n, -1, dtype=np.int64)
    cost_cap = limits.attention * float(capacity) ** 2
    order = np.argsort(-sizes, kind="stable")
    full = order[(sizes[order] == capacity) | (sizes[order].astype(np.float64) ** 2 >= cost_cap)]
    out[full] = np.arange(len(full))
    rest, opened = order[len(full) :], len(full)
    smallest = int(sizes[rest].min()) if len(rest) else 0
    w0, w1, w2 = limits.weights
    number = np.zeros(n + 1, dtype=np.int64)
    tokens, docs, cost = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    used = 0
    for step, i in enumerate(rest):
        s = float(sizes[i])
        t, d, c = tokens[:used] - s, docs[:used] - 1, cost[:used] - s * s
        norm = w0 * (t / capacity) ** 2 + w1 * (d / limits.documents) ** 2 + w2 * (c / cost_cap) ** 2
        norm[(t < 0) | (d < 0) | (c < 0)] = np.inf
        k = int(norm.argmin()) if used else -1
        if k < 0 or norm[k] == np.inf:
            k, number[used] = used, opened
            tokens[k], docs[k], cost[k] = capacity, limits.documents, cost_cap
            used, opened = used + 1, opened + 1
        tokens[k] -= s
        docs[k] -= 1
        cost[k] -= s * s
        out[i] = number[k]
        if step % 256 == 255:  # containers that nothing fits into any more are closed
            keep = np.flatnonzero((tokens[:used] >= smallest) & (docs[:used] >= 1))
            for a in (number, tokens, docs, cost):
                a[: len(keep)] = a[keep]
            used = len(keep)
    return out


def split(n_tokens: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, piece number and size of every piece: only items above the capacity are split, into full pieces and a rest."""
    pieces = np.maximum(1, -(-n_tokens // capacity))
    item = np.repeat(np.arange(len(n_tokens)), pieces)
    piece = np.arange(len(item)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return item, piece, np.minimum(capacity, n_tokens[item] - piece * capacity)


def sized(documents: DataFrame, id_col: str, text_col: str, tokenizer: str | None = None) -> DataFrame:
    """``item, n_tokens, copy``: sizes in tokens of a public tokenizer; repeated rows of one size are numbered.

    The numbers don't depend on the order of rows, so that a repeated task puts the same rows into the same shards.
    """
    file, kind = tokenizer or tokenizer_path(), dict(documents.dtypes)[id_col]

    def count(batch: pa.RecordBatch):
        enc = encoder(file)
        n = [len(enc.encode_ordinary(t)) if t else 0 for t in batch.column(1).to_pylist()]
        yield pa.table({"item": batch.column(0), "n_tokens": pa.array(n, pa.int64())})

    rows = map_batches(spread(documents.select(id_col, text_col)), count, f"item {kind}, n_tokens bigint")
    same = rows.groupBy("item", "n_tokens").agg(F.count(F.lit(1)).alias("k"))
    return same.select("item", "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), F.col("k"))).alias("copy"))


def pack(documents: DataFrame, packs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, limits: Limits = Limits(), shard_items: int = SHARD_ITEMS) -> DataFrame:  # noqa: B008
    """``pack_id, capacity_tokens, container_id, doc_id, piece_no, piece_tokens`` for every piece and pack size.

    A document larger than the capacity, or than the attention limit lets a container take, becomes full pieces and one rest; no other document is split. Null and empty texts
    have 0 tokens and stand in a container as well. Repeated rows are packed as often as they occur. Capacities below 1 and null
    capacities are left out, more than ``MOST_PACKS`` are an error; no documents or no capacities give an empty result. ``packs`` is a short configuration table.
    """
    wanted = packs.select("pack_id", "capacity_tokens").where("capacity_tokens > 0").distinct().orderBy("pack_id", "capacity_tokens").limit(MOST_PACKS + 1).collect()
    if len(wanted) > MOST_PACKS:
        raise ValueError(f"more than {MOST_PACKS} pack sizes")
    sizes = [(r[0], int(r[1])) for r in wanted]
    kind = dict(documents.dtypes)[id_col]
    schema = f"pack_id int, capacity_tokens int, container_id bigint, {id_col} {kind}, piece_no int, piece_tokens int"
    if not sizes:
        return documents.sparkSession.createDataFrame([], schema)
    shards = max(1, round(documents.count() / shard_items))
    items = sized(documents, id_col, text_col, tokenizer).withColumn("shard", F.pmod(F.xxhash64("item", "n_tokens", "copy"), F.lit(shards)).cast("int"))
    each = F.explode(F.array(*[F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("int").alias("capacity")) for p, c in sizes]))
    jobs = items.select("item", "n_tokens", "shard", each.alias("w")).select("item", "n_tokens", "shard", "w.*")

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, pack_id, capacity = (int(k) for k in key)
        rows = rows.sort_values(["n_tokens", "item"], ascending=[False, True], kind="stable", na_position="last")
        item, piece, size = split(rows["n_tokens"].to_numpy(), limits.largest(capacity))
        box = best_fit(size, capacity, limits)
        return pd.DataFrame({"pack_id": pack_id, "capacity_tokens": capacity, "container_id": shard * (1 << 32) + box, id_col: rows["item"].to_numpy()[item], "piece_no": piece, "piece_tokens": size})

    return jobs.groupBy("shard", "pack_id", "capacity").applyInPandas(fill, schema)


def summary(packed: DataFrame) -> DataFrame:
    """Containers, pieces, tokens and the unused share of each pack size."""
    boxes = packed.groupBy("pack_id", "capacity_tokens", "container_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("piece_tokens").alias("tokens"))
    return boxes.groupBy("pack_id", "capacity_tokens").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("fullest"),
        (1 - F.sum("tokens") / (F.count(F.lit(1)) * F.col("capacity_tokens"))).alias("unused_share"),
    )
