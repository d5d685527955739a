"""Problem 6: mixing sources to target weights.

Every source gets an exact token quota: each record is used a whole number of times, and the records that come first in a hash order once more. The uses of a
source form blocks (use number, range of the hash). A multivariate-hypergeometric splitting tree divides the blocks of all sources among the output shards,
each shard draws its blocks from a permuted list, without overlap, and is shuffled locally.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.operators.ordering import ensure_checkpoint_dir

from .common import spread, table, with_token_count

#: Bits of the order's hash, and bits by which the end of a quota is narrowed down at a time.
HASH_BITS, STEP_BITS = 54, 9
#: Records among which the end of a quota is looked for row by row; a larger range is narrowed down further.
EDGE_ROWS = 8192
#: Records before and after the end of a quota among which its last tokens are made up exactly.
FILL = 64
#: Most sources of a mix.
MOST_SOURCES = 2000
#: Tokens of a shard, and bounds of their number; blocks of a shard. Sources and shards bound the table of blocks that is broadcast.
SHARD_TOKENS, LEAST_SHARDS, MOST_SHARDS, SHARD_BLOCKS = 50_000_000, 32, 8192, 16
SEED = 20240


def clean_source(c: Column) -> Column:
    """Spellings that differ in case, outer blanks, hyphens or underscores fall together; blanks only are null."""
    s = F.regexp_replace(F.lower(F.trim(c)), r"[-\s]+", "_")
    return F.when(s != "", s)


@dataclass
class Quota:
    """What a source gives: each record ``whole`` times, and once more those with a hash below ``low`` and some of those in [``low``, ``high``),
    which are to add up to ``wanted`` tokens together with the ``before`` tokens below ``low``."""

    source: str
    target: float
    reachable: float
    cap: int
    tokens: float
    records: int
    whole: int = 0
    wanted: float = 0.0
    low: int = 0
    high: int = 0
    before: float = 0.0


def quotas(sizes: dict[str, tuple[float, int]], targets: list[tuple[str, float, int]], total: float | None = None) -> tuple[float, list[Quota]]:
    """Size of the largest mix in which no source exceeds its repeats, and the quotas; ``sizes`` has tokens and records of each source.

    Sources without tokens can't be reached: the others keep their proportions and share the whole.
    """
    have = {s: sizes[s] for s, w, _ in targets if s in sizes and w > 0 and sizes[s][0] > 0}
    weight = sum(w for s, w, _ in targets if s in have)
    most = min((have[s][0] * m * weight / w for s, w, m in targets if s in have), default=0.0)
    size = most if total is None else min(total, most)
    out = []
    for s, w, m in targets:
        if s in have:
            tokens, records = have[s]
            quota = size * w / weight
            whole = min(m, int(quota / tokens + 1e-9))
            out.append(Quota(s, float(w), w / weight, int(m), float(tokens), int(records), whole, float(quota - whole * tokens) if whole < m else 0.0))
    return float(size), out


def narrow(q: Quota, level: int, tokens: np.ndarray, records: np.ndarray) -> bool:
    """Moves the quota's range to the part of it in which the quota ends; True if that part must be narrowed down further.

    ``tokens`` and ``records`` are those of the parts. The last range is widened by parts on either side until ``FILL`` records stand there.
    """
    width = 1 << (HASH_BITS - STEP_BITS * level)
    until = q.before + np.cumsum(tokens)
    edge = min(int(np.searchsorted(until, q.wanted, side="right")), len(tokens) - 1)
    last, more = edge, records[edge] > EDGE_ROWS and width > 1
    if not more:
        last = edge + min(int(np.searchsorted(np.cumsum(records[edge + 1 :]), FILL)) + 1, len(tokens) - 1 - edge)
        edge -= min(int(np.searchsorted(np.cumsum(records[:edge][::-1]), FILL)) + 1, edge)
    q.before = float(until[edge - 1]) if edge > 0 else q.before
    q.low, q.high = q.low + edge * width, q.low + (last + 1) * width
    return bool(more)


def best_subset(sizes: list[int], gap: int) -> list[int]:
    """Positions of the sizes whose sum comes nearest to the gap from below (exact, over the sums that can be reached)."""
    reach, steps = 1, []
    full = (1 << (gap + 1)) - 1
    for n in sizes:
        steps.append(reach)
        reach |= (reach << n) & full if n <= gap else 0
    at, chosen = reach.bit_length() - 1, []
    for i in range(len(sizes) - 1, -1, -1):
        if not (steps[i] >> at) & 1:
            chosen.append(i)
            at -= sizes[i]
    return chosen


def splitting_tree(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source for each shard; every shard gets the same number of blocks, to within one."""
    if shards == 1:
        return counts[None, :]
    left = shards // 2
    want = round(int(counts.sum()) * left / shards)
    drawn = rng.multivariate_hypergeometric(counts, want, method="marginals") if counts.sum() else counts * 0
    return np.concatenate([splitting_tree(drawn, left, rng), splitting_tree(counts - drawn, shards - left, rng)])


def _targets(targets: DataFrame) -> list[tuple[str, float, int]]:
    rows = targets.select(clean_source(F.col("source")).alias("s"), F.col("target_share").cast("double").alias("w"), F.coalesce(F.col("max_repeats"), F.lit(1)).cast("int").alias("m"))
    rows = rows.where("s is not null and w > 0 and m > 0").groupBy("s").agg(F.sum("w").alias("w"), F.max("m").alias("m"))
    got = rows.orderBy("s").limit(MOST_SOURCES + 1).collect()
    if len(got) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources in a mix")
    return [(r[0], r[1], r[2]) for r in got]


class Mix:
    """A planned mix of ``documents`` (id, text, source). Sizes are written once to the shared checkpoint folder.

    Records without a target, and null sources, are used 0 times. Null and empty texts have 0 tokens and follow their source's uses.
    Repeated rows count one by one. No documents or no targets give an empty mix.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", total: float | None = None, tokenizer: str | None = None, shard_tokens: int = SHARD_TOKENS, least_shards: int = LEAST_SHARDS, seed: int = SEED):
        self.spark = documents.sparkSession
        ensure_checkpoint_dir(self.spark)
        self.id, self.seed = id_col, seed
        self.wanted = _targets(targets)
        base = spread(documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), clean_source(F.col(source_col)).alias("source")))
        self.sized = with_token_count(base, "text", "n_tokens", tokenizer).select("id", "source", "n_tokens", F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "text"), 64 - HASH_BITS).alias("h")).checkpoint()
        names = [s for s, _, _ in self.wanted]
        self.mixed = self.sized.where(F.col("source").isin(names)) if names else self.sized.limit(0)
        parts = self._parts(self.mixed.withColumn("low", F.lit(0).cast("long")), 1)
        self.total, self.quotas = quotas({s: (t.sum(), n.sum()) for s, (t, n) in parts.items()}, self.wanted, total)
        open_ = {q.source: q for q in self.quotas if q.wanted > 0}
        level = 1
        while open_:
            open_ = {s: q for s, q in open_.items() if narrow(q, level, *parts[s])}
            level += 1
            if open_:  # at most MOST_SOURCES rows
                ranges = F.broadcast(self.spark.createDataFrame([(q.source, q.low, q.high) for q in open_.values()], "source string, low long, high long"))
                parts = self._parts(self.mixed.join(ranges, "source").where("h >= low and h < high"), level)
        self._deal(shard_tokens, least_shards)

    def _parts(self, rows: DataFrame, level: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Tokens and records of the parts of each source's range; at most sources x 2 ** STEP_BITS rows come to the driver."""
        part = F.shiftright(F.col("h") - F.col("low"), HASH_BITS - STEP_BITS * level).cast("int").alias("part")
        out: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for r in rows.groupBy("source", part).agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect():
            own = out.setdefault(r["source"], (np.zeros(1 << STEP_BITS), np.zeros(1 << STEP_BITS, dtype=np.int64)))
            own[0][r["part"]], own[1][r["part"]] = r["t"], r["n"]
        return out

    def _deal(self, shard_tokens: int, least_shards: int) -> None:
        """Blocks of every source in number as its uses' tokens are, and the shard of each use of each block."""
        rng = np.random.default_rng(self.seed)
        shards = int(min(MOST_SHARDS, max(least_shards, math.ceil(self.total / shard_tokens))))
        size = max(1.0, self.total / (shards * SHARD_BLOCKS))
        self.bits = {q.source: min(20, max(0, math.ceil(math.log2(max(1.0, min(q.tokens / size, q.records / 4)))))) for q in self.quotas}
        blocks, counts = [], []
        for q in self.quotas:
            shift = HASH_BITS - self.bits[q.source]
            own = [(r, b) for r in range(q.whole) for b in range(1 << self.bits[q.source])]
            own += [(q.whole, b) for b in range(((q.high - 1) >> shift) + 1)] if q.high else []
            blocks.append(own), counts.append(len(own))
        self.shard_count = max(1, min(shards, sum(counts) // 4))
        deal = splitting_tree(np.array(counts, dtype=np.int64), self.shard_count, rng) if counts else np.zeros((self.shard_count, 0), dtype=np.int64)
        rows = []
        for j, (q, own) in enumerate(zip(self.quotas, blocks, strict=True)):
            shard = np.empty(len(own), dtype=np.int64)
            shard[rng.permutation(len(own))] = np.repeat(np.arange(self.shard_count), deal[:, j])
            by: dict[int, list[int]] = {}
            for (_, b), k in zip(own, shard.tolist(), strict=True):
                by.setdefault(b, []).append(k)  # in the order of uses
            rows += [(q.source, b, ks) for b, ks in by.items()]
        self.places = self.spark.createDataFrame(rows, "source string, block int, dealt array<int>")
        self.chosen = self._fill()

    def _planned(self) -> DataFrame:
        plan = [(q.source, q.whole, q.low, q.high, q.before, q.wanted, HASH_BITS - self.bits[q.source]) for q in self.quotas]
        return self.sized.join(F.broadcast(self.spark.createDataFrame(plan, "source string, whole int, low long, high long, before double, wanted double, shift int")), "source", "left")  # at most MOST_SOURCES rows

    def _end(self, rows: DataFrame) -> DataFrame:
        """The records about the end of each quota, a bounded number; ``rank`` is at most 0 in its prefix and 1 to 2 FILL about its end."""
        w = Window.partitionBy("source").orderBy("h", "id", "n_tokens")
        end = rows.where("h >= low and h < high").withColumn("until", F.col("before") + F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        fits = F.sum((F.col("until") <= F.col("wanted")).cast("int")).over(Window.partitionBy("source"))
        return end.withColumn("rank", F.row_number().over(w) - (fits - FILL))

    def _fill(self) -> list[tuple[str, int]]:
        """Ranks that make up the end of each quota; at most 2 FILL records of each source are looked at."""
        near = self._end(self._planned()).where(F.col("rank").between(1, 2 * FILL)).select("source", "rank", "n_tokens", "until", "wanted").collect() if self.quotas else []
        out, by = [], {}
        for r in near:
            by.setdefault(r["source"], []).append(r)
        for s, rows in by.items():
            rows.sort(key=lambda r: r["rank"])
            gap = max(0, int(rows[0]["wanted"] - (rows[0]["until"] - rows[0]["n_tokens"])))
            out += [(s, int(rows[i]["rank"])) for i in best_subset([int(r["n_tokens"]) for r in rows], gap)]
        return out

    def uses(self) -> DataFrame:
        """``id, source, n_tokens, uses, shards`` of every record; ``shards`` has the shard of each use."""
        rows = self._planned()
        edge = F.col("high").isNotNull() & (F.col("h") >= F.col("low")) & (F.col("h") < F.col("high"))
        inside = rows.where(~F.coalesce(edge, F.lit(False))).withColumn("uses", F.coalesce(F.col("whole") + (F.col("h") < F.col("low")).cast("int"), F.lit(0)))
        picked = self.spark.createDataFrame(self.chosen, "source string, rank bigint").withColumn("more", F.lit(1))
        end = self._end(rows).join(F.broadcast(picked), ["source", "rank"], "left")  # at most 2 FILL rows for each source
        end = end.withColumn("uses", F.col("whole") + F.when((F.col("rank") <= 0) | F.col("more").isNotNull(), 1).otherwise(0))
        keep = ["id", "source", "n_tokens", "uses", F.expr("cast(shiftright(h, shift) as int)").alias("block")]
        both = inside.select(*keep).unionByName(end.select(*keep)).join(F.broadcast(self.places), ["source", "block"], "left")  # MOST_SHARDS x SHARD_BLOCKS blocks, and some for each source
        return both.select("id", "source", "n_tokens", "uses", F.when(F.col("uses") > 0, F.slice("dealt", F.lit(1), F.col("uses"))).otherwise(F.array().cast("array<int>")).alias("shards"))

    def shares(self) -> DataFrame:
        """Target and actual share of each source; ``reachable_share`` is the target among sources that have documents."""
        caps = {s: m for s, _, m in self.wanted}
        near = {q.source: q.reachable for q in self.quotas}
        rows = [(s, float(w), near.get(s, 0.0), caps[s]) for s, w, _ in self.wanted]
        used = self.uses().where("uses > 0").groupBy("source").agg(F.sum(F.col("uses").cast("long") * F.col("n_tokens")).alias("tokens"), F.count(F.lit(1)).alias("records"), F.max("uses").alias("most_uses"))
        out = self.spark.createDataFrame(rows, "source string, target_share double, reachable_share double, max_repeats int").join(used, "source", "left").na.fill(0, ["tokens", "records", "most_uses"])
        whole = Window.partitionBy()  # one row for each target
        return out.withColumn("actual_share", F.when(F.sum("tokens").over(whole) > 0, F.col("tokens") / F.sum("tokens").over(whole)).otherwise(F.lit(0.0)))

    def shards(self) -> DataFrame:
        """``shard, position, id, use_no, source, n_tokens``: every use of every record in its place in the mix."""
        placed = self.uses().select("id", "source", "n_tokens", F.posexplode("shards").alias("use_no", "shard"))
        local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(self.seed), "id", "use_no"), "id", "use_no")
        return placed.select("shard", F.row_number().over(local).alias("position"), F.col("id").alias(self.id), "use_no", "source", "n_tokens")


def mix_of(spark, sf_dir: str) -> Mix:
    return Mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))
