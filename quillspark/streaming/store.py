"""Group buffer as a table in the shared folder: appended by streams, read whole groups at a time, recycled and polled."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.groups import meta


class GroupStore:
    """Rows with a group column, kept until their group is read.

    A batch is written under its number, so that a repeated one replaces itself. A group with at least ``size`` rows is valid; a read gives the valid groups whole
    and forgets them, so that later rows begin a new one. Nothing but file names and counts comes to the driver.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, size: int, group: str = "group_index"):
        self.spark, self.path, self.schema, self.size, self.group = spark, path, schema, size, group
        self.batches = self.reads = self.calls = 0
        self.since = 0  # first batch that the meta data of the next read covers
        kind = dict(spark.createDataFrame([], schema).dtypes)[group]
        self._gone = f"{group} {kind}, upto int, read_no int"

    def append(self, rows: DataFrame, batch: int | None = None) -> None:
        """A batch; fits ``foreachBatch``."""
        k = self.batches if batch is None else int(batch)
        names = [c.split()[0] for c in self.schema.split(",")]
        rows.select(*[n.strip() for n in names]).write.mode("overwrite").parquet(f"{self.path}/items/batch={k}")
        self.batches = max(self.batches, k + 1)

    def drain(self, stream: DataFrame, checkpoint: str) -> None:
        """Appends all that a stream's source has now."""
        first = self.batches
        stream.writeStream.foreachBatch(lambda b, k: self.append(b, first + k)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    def _all(self) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], f"{self.schema}, batch int")
        return self.spark.read.schema(f"{self.schema}, batch int").option("basePath", f"{self.path}/items").parquet(*[f"{self.path}/items/batch={k}" for k in range(self.batches)])

    def waiting(self) -> DataFrame:
        """Rows that no read has given."""
        x = self._all()
        if not self.reads:
            return x
        gone = self.spark.read.schema(self._gone).parquet(f"{self.path}/gone").groupBy(self.group).agg(F.max("upto").alias("_upto"))
        return x.join(gone, self.group, "left").where(F.col("_upto").isNull() | (F.col("batch") > F.col("_upto"))).drop("_upto")

    def valid(self) -> DataFrame:
        g = self.waiting().groupBy(self.group).agg(F.count(F.lit(1)).alias("n"))
        return g.where(F.col("n") >= self.size)

    def queued(self) -> int:
        """Rows of the valid groups."""
        return self.valid().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def read(self) -> tuple[DataFrame, DataFrame]:
        """The valid groups' rows, and meta data of all rows that came since the last read that gave any."""
        report = meta(self._all().where(F.col("batch") >= self.since), self.group)
        target = f"{self.path}/data/call={self.calls}"
        self.calls += 1
        self.waiting().join(self.valid().select(self.group), self.group, "left_semi").write.mode("overwrite").parquet(target)
        data = self.spark.read.schema(f"{self.schema}, batch int").parquet(target)
        report = self.spark.createDataFrame(report.collect(), report.schema)  # one row, as of now
        if not data.isEmpty():
            data.select(self.group).distinct().select(self.group, F.lit(self.batches - 1).alias("upto"), F.lit(self.reads).alias("read_no")).write.mode("append").parquet(f"{self.path}/gone")
            self.since = self.batches
            self.reads += 1
        return data, report

    def expired(self, arrived: str, wait: str, now: Column | None = None) -> DataFrame:
        """Groups that are not complete and got nothing for the interval ``wait`` before ``now``, by default the last arrival of all."""
        g = self.waiting().groupBy(self.group).agg(F.count(F.lit(1)).alias("n"), F.max(arrived).alias("_last"))
        if now is None:
            g, now = g.crossJoin(F.broadcast(self._all().agg(F.max(arrived).alias("_now")))), F.col("_now")  # one row
        return g.where((F.col("n") < self.size) & (F.col("_last") < now - F.expr(f"INTERVAL {wait}"))).select(self.group, "n")


def collect_and_recycle(df: DataFrame, kept: DataFrame, n: int, done: str, rollout_id: int, group: str = "group_index", response: str = "response", started: str = "start_rollout_id") -> tuple[DataFrame, DataFrame]:
    """The first ``n`` kept groups in the order of their completion, and the rows of all groups that were not decided then: those that completed later and so are aborted.

    Recycled rows with a response are marked with the rollout that began them, once. ``kept`` has the groups that pass the filter.
    """
    ends = df.groupBy(group).agg(F.max(done).alias("_done"))
    first = ends.join(kept.select(group), group, "left_semi").orderBy("_done", group).limit(n)
    last = first.agg(F.max(F.struct("_done", group)).alias("_last"), F.count(F.lit(1)).alias("_n"))  # one row
    late = ends.crossJoin(F.broadcast(last)).where((F.col("_n") == n) & (F.struct("_done", group) > F.col("_last"))).select(group)
    mark = F.when(F.col(started).isNull() & (F.coalesce(F.length(response), F.lit(0)) > 0), F.lit(rollout_id)).otherwise(F.col(started))
    return df.join(first.select(group), group, "left_semi"), df.join(late, group, "left_semi").withColumn(started, mark)


def poll(step: Callable[[], int], enough: int, retries: int = -1, pause: float = 0.0, sleep: Callable[[float], None] = time.sleep) -> tuple[int, int]:
    """Calls ``step`` until it says that there are ``enough`` rows: how many there are, after how many calls. ``retries`` bounds the calls after the first; -1 doesn't."""
    calls = 0
    while True:
        rows = step()
        calls += 1
        if rows >= enough or 0 <= retries < calls:
            return rows, calls
        sleep(pause)
