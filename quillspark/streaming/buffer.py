"""Group buffer over a stream of samples.

Samples are kept per group until a group is complete; a complete group is emitted whole and forgotten, so that later members begin a new
one. Groups wait without a limit unless a time-out is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "group_index bigint, emission int, sample_index bigint, reward double, raw_reward double, complete boolean"
STATE = "emitted int, ids array<bigint>, rewards array<double>"


def file_stream(spark: SparkSession, path: str, files: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a directory, or of one file; ``files`` bounds a micro-batch."""
    schema = spark.read.parquet(path).schema
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()
    reader = spark.readStream.schema(schema)
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", at.getName()).parquet(str(at.getParent().toString()))


def normalized(rewards: list[float | None], eps: float = 1e-8) -> list[float | None]:
    """Population-normalized rewards in [0, 1]; others pass through."""
    ok = [r for r in rewards if r is not None and 0 <= r <= 1]
    if not ok or max(ok) == 0:
        return rewards
    mean = sum(ok) / len(ok)
    sd = (sum((r - mean) ** 2 for r in ok) / len(ok)) ** 0.5
    return [r if r is None or not 0 <= r <= 1 else 0.0 if sd < eps else (r - mean) / (sd + eps) for r in rewards]


def _rows(key: int, emission: int, ids: list[int], rewards: list, complete: bool) -> pd.DataFrame:
    return pd.DataFrame({"group_index": key, "emission": emission, "sample_index": ids, "reward": normalized(rewards), "raw_reward": rewards, "complete": complete})


def group_buffer(stream: DataFrame, size: int, order: str = "arrived_at", wait_ms: int | None = None) -> DataFrame:
    """Complete groups of a stream of ``group_index, sample_index, reward`` and an arrival time.

    With ``wait_ms`` a group that got nothing for so long is emitted as it is, with ``complete`` false.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        emitted, ids, rewards = state.get if state.exists else (0, [], [])
        ids, rewards = list(ids), list(rewards)
        if state.hasTimedOut:
            state.remove()
            if ids:
                yield _rows(key[0], emitted, ids, rewards, False)
            return
        new = pd.concat(list(batches)).sort_values([order, "sample_index"])
        for i, r in zip(new["sample_index"], new["reward"], strict=True):
            ids.append(int(i))
            rewards.append(None if pd.isna(r) else float(r))
            if len(ids) >= size:
                yield _rows(key[0], emitted, ids, rewards, True)
                emitted, ids, rewards = emitted + 1, [], []
        state.update((emitted, ids, rewards))
        if wait_ms:
            state.setTimeoutDuration(wait_ms)

    wait = GroupStateTimeout.ProcessingTimeTimeout if wait_ms else GroupStateTimeout.NoTimeout
    return stream.groupBy("group_index").applyInPandasWithState(update, OUT, STATE, "append", wait)


def run_to_end(df: DataFrame, path: str, checkpoint: str) -> None:
    """Runs a streaming frame over what its source has now, into Parquet files."""
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
