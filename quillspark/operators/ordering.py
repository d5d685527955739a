"""Row numbers over a whole table without a single-task window."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the shared folder that the cluster names; a local master may do with a local one, any other must name one."""
    if not spark.conf.get("spark.checkpoint.dir", "") and spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillspark-"))


_WRITTEN: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share; it is deleted with :func:`drop_tables`, or when the driver's JVM ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.conf.get('spark.checkpoint.dir', '') or spark.sparkContext.getCheckpointDir()}/quillspark-{name}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(at)
    files.deleteOnExit(at)
    _WRITTEN.append(path)
    return path


def drop_tables(spark: SparkSession) -> None:
    """Deletes what was written to scratch paths in this process; frames that read it are no longer usable."""
    while _WRITTEN:
        at = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame) -> DataFrame:
    """The frame, written to the shared checkpoint folder and read again: cuts lineage and gives true sizes to the planner.

    ``checkpoint()`` keeps the size estimate of the plan it cuts, which squares with every join of a loop.
    """
    path = f"{scratch(df.sparkSession, 'table')}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_index(df: DataFrame, *order: str | Column, name: str = "row") -> DataFrame:
    """Adds the 0-based position of each row in the given order.

    Rows are range-partitioned and sorted once, written to the checkpoint folder so that both passes see the same partitions, and shifted by
    the sizes of the partitions before theirs. Only one count per partition is windowed. Ties keep no particular order.
    """
    ensure_checkpoint_dir(df.sparkSession)
    part = F.spark_partition_id()
    x = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", part).withColumn("_at", F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).checkpoint()
    sizes = x.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    start = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    return x.join(F.broadcast(start), "_part").withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")  # one row per partition


def previous(df: DataFrame, by: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the value of the row before in its group's order, null for the first: a group of any size is spread by ranges."""
    x = row_index(df, by, *order, name="_row")
    before = x.select((F.col("_row") + 1).alias("_row"), F.col(by).alias("_by"), F.col(value).alias(out))
    return x.join(before, (x["_row"] == before["_row"]) & x[by].eqNullSafe(before["_by"]), "left").select(*df.columns, out)


def running_sum(df: DataFrame, by: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds the sum of the values before each row in its group's order: sums inside ranges, plus one offset for each range and group."""
    ensure_checkpoint_dir(df.sparkSession)
    x = df.repartitionByRange(by, *order).withColumn("_part", F.spark_partition_id()).checkpoint()
    w = Window.partitionBy("_part", by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    parts = x.groupBy("_part", by).agg(F.sum(value).alias("_sum"))
    start = parts.select(F.col("_part").alias("_p"), F.col(by).alias("_by"), F.coalesce(F.sum("_sum").over(Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))  # one row for each range of a group
    y = x.withColumn("_own", F.coalesce(F.sum(value).over(w), F.lit(0)))
    return y.join(start, (y["_part"] == start["_p"]) & y[by].eqNullSafe(start["_by"])).withColumn(out, F.col("_own") + F.col("_start")).select(*df.columns, out)


def exact_percentiles(df: DataFrame, by: str, value: str, qs: dict[str, float]) -> DataFrame:
    """Interpolated percentiles of each group, exact: values are ranked over ranges of (group, value) and only the two ranks about each percentile are kept."""
    x = row_index(df.where(F.col(value).isNotNull()).select(by, value), by, value, name="_row")
    g = x.groupBy(by).agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    at = g.select(F.col(by).alias("_by"), "_first", "_n", F.explode(F.array(*[F.struct(F.lit(k).alias("name"), (F.lit(q) * (F.col("_n") - 1)).alias("t")) for k, q in qs.items()])).alias("e"))
    near = at.select("_by", "e.name", "e.t", F.explode(F.array_distinct(F.array(F.floor("e.t"), F.ceil("e.t")))).alias("k"), "_first").withColumn("_row", F.col("_first") + F.col("k"))
    hit = near.join(x.select("_row", value), "_row")
    share = F.when(F.col("k") == F.floor("t"), 1 - (F.col("t") - F.floor("t"))).otherwise(F.col("t") - F.floor("t"))
    one = hit.groupBy("_by", "name").agg(F.sum(F.col(value) * share).alias("v")).groupBy("_by").pivot("name", list(qs)).agg(F.first("v"))
    everyone = df.select(F.col(by).alias("_all")).distinct()
    return everyone.join(one, everyone["_all"].eqNullSafe(one["_by"]), "left").select(F.col("_all").alias(by), *qs)


@F.pandas_udf(StringType())
def round_label(x: pd.Series) -> pd.Series:
    """The number to one decimal as Python rounds it (exact binary value, half to even); null stays null."""
    return x.map(lambda v: None if pd.isna(v) else str(round(float(v), 1)))
