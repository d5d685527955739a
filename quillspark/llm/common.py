"""Shared helpers of the training-data operators."""

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of letters; every Han character is a word of its own.
WORD = regex.compile(r"[\p{Han}&&\p{L}]|[\p{L}--\p{Han}]+", regex.V1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core for Python work when the scan has fewer splits than the cluster has cores.

    On large inputs the scan already has more splits, so nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads consecutive codes over all bits."""
    x = np.asarray(x, dtype=np.uint64).copy()
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n codes that begin at each position; the last n-1 positions have none."""
    if len(codes) < n:
        return np.empty(0, dtype=np.uint64)
    h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            h = mix64(h * _MIX + codes[i : len(codes) - n + 1 + i] + np.uint64(i + 1))
    return h


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch | pa.Table]], schema: str, rows: int = 2048) -> DataFrame:
    """``mapInArrow`` in slices, so that long texts never sit in memory in one huge batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                for out in fn(batch.slice(at, rows)):
                    yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


#: Pre-split pattern of the byte-level vocabularies (fixed value, see the tokenizers' own description).
@lru_cache(maxsize=4)
def encoder(path: str):
    """Public byte-level tokenizer from a rank file; cached per Python worker."""
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern(), mergeable_ranks=ranks, special_tokens={})


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def with_token_count(df: DataFrame, text: str, out: str, path: str | None = None) -> DataFrame:
    """Size of a text in tokens of a public tokenizer; null and empty texts have 0."""
    file = path or tokenizer_path()

    @F.pandas_udf("int")
    def size(s: pd.Series) -> pd.Series:
        enc = encoder(file)
        return pd.Series([len(enc.encode_ordinary(x)) if x else 0 for x in s], dtype="int32")

    return df.withColumn(out, size(F.col(text)))


#: An answer-format instruction stands before or after at least this share of all distinct prompts, and at least so many.
INSTRUCTION_SHARE, INSTRUCTION_LEAST = 0.01, 5
#: Never matches: no instructions are known.
NO_INSTRUCTIONS = regex.compile(r"(?!)")


def standing_instructions(prompts: DataFrame, share: float = INSTRUCTION_SHARE, least: int = INSTRUCTION_LEAST) -> list[str]:
    """The one to three sentences that stand both before and after many distinct prompts (one column), longest first.

    At most ``2 / share`` come back, whatever the number of prompts.
    """
    text = prompts.columns[0]
    cut = F.filter(F.split(F.col(text), r"(?<=[.!?。！？])\s+|\n+"), lambda x: F.trim(x) != "")
    distinct = prompts.where(F.col(text).isNotNull()).select(text).distinct().select(F.transform(cut, lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))).alias("s"))
    n = F.size("s")
    ends = [F.when(n > k, F.struct(F.lit(side).alias("side"), F.concat_ws(" ", F.slice("s", at, k)).alias("t"))) for k in (1, 2, 3) for side, at in (("pre", F.lit(1)), ("post", n - k + 1))]
    counts = distinct.select(F.explode(F.array(*[F.when(n > k, e) for k, e in zip((1, 1, 2, 2, 3, 3), ends, strict=True)])).alias("e")).where("e is not null")
    both = counts.groupBy("e.t").agg(F.sum((F.col("e.side") == "pre").cast("long")).alias("pre"), F.sum((F.col("e.side") == "post").cast("long")).alias("post"))
    total = distinct.agg(F.count(F.lit(1)).alias("n"))  # one row
    often = both.crossJoin(F.broadcast(total)).where((F.col("pre") + F.col("post") >= F.greatest(F.lit(least), share * F.col("n"))) & (F.least("pre", "post") >= 0.2 * F.greatest("pre", "post")))
    return sorted((r[0] for r in often.select("t").collect()), key=lambda t: (-len(t), t))


@lru_cache(maxsize=8)
def _pattern_of(instructions: tuple[str, ...]) -> regex.Pattern:
    return regex.compile("|".join(r"\s+".join(map(regex.escape, t.split())) for t in instructions), regex.I) if instructions else NO_INSTRUCTIONS


def instruction_pattern(instructions: list[str]) -> regex.Pattern:
    """Finds the instructions in any case and spacing; compiled once per worker."""
    return _pattern_of(tuple(instructions))
