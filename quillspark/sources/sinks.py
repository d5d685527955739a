"""Sinks: dumps, cursors, metrics and cached tables, all written by the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dump_rollout(samples: DataFrame, path: str, rollout_id: int, is_eval: bool = False) -> None:
    out = samples.withColumn("rollout_id", F.lit(rollout_id)).withColumn("is_eval", F.lit(is_eval))
    out.write.mode("append").partitionBy("rollout_id", "is_eval").parquet(path)


def dump_ranks(rows: DataFrame, path: str) -> None:
    """One partition directory per rollout and rank; the frame has both columns."""
    rows.write.mode("append").partitionBy("rollout_id", "rank").parquet(path)


def save_cursor(spark: SparkSession, path: str, **state: int) -> None:
    cols = ", ".join(f"{k} bigint" for k in sorted(state))
    spark.createDataFrame([tuple(state[k] for k in sorted(state))], cols).coalesce(1).write.mode("overwrite").parquet(path)


def load_cursor(spark: SparkSession, path: str) -> dict[str, int] | None:
    """The saved state, or None where there is none."""
    try:
        row = spark.read.parquet(path).first()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return row.asDict() if row else None


def append_metrics(metrics: DataFrame, path: str, step: int, step_key: str) -> None:
    """Long table of ``metric, value, step, step_key``."""
    metrics.select("metric", F.col("value").cast("double").alias("value"), F.lit(step).alias("step"), F.lit(step_key).alias("step_key")).write.mode("append").parquet(path)


def write_lines(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; an existing path is an error unless told otherwise."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite" if overwrite else "errorifexists").text(path)


def cached(spark: SparkSession, source: str, path: str, build: Callable[[], DataFrame], version: int = 1) -> DataFrame:
    """A built table, reused while its source and its version are the same."""
    file = spark._jvm.org.apache.hadoop.fs.Path(source)
    stamp = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).getModificationTime()
    at = f"{path}/v{version}-{stamp}"
    try:
        return spark.read.parquet(at)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    build().write.mode("overwrite").parquet(at)
    return spark.read.parquet(at)
