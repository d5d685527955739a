"""Problem 4: percentiles of very large numeric columns.

Merging centroid digests. The sorted values of a group are clustered by the cell that the arcsine size function
``k(q) = delta * (asin(2q - 1) / pi + 1/2)`` gives their quantile: wide clusters in the middle, single values at both
ends. Digests of partitions, days or workers are merged by clustering their centroids again. A second pass
counts the values below and up to each estimate and so certifies its true rank error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELTA = 500
#: Stated bound of the rank error, as a share of the group's values.
BOUND = 0.005
QUANTILES = (0.5, 0.95, 0.99)
#: Lines of one run that share a partition; keeps a run of any size spread over the cluster.
BLOCK = 2048
_COMPACT = 400_000


def recluster(group: np.ndarray, value: np.ndarray, weight: np.ndarray, delta: int = DELTA) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Clusters all groups at once; the result is sorted by group and value."""
    if not len(group):
        return group, value, weight
    order = np.lexsort((value, group))
    group, value, weight = group[order], value[order], weight[order]
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[first, len(group)])
    total = np.repeat(np.add.reduceat(weight, first), size)
    until = np.cumsum(weight)
    start = np.repeat(until[first] - weight[first], size)
    q = np.clip((until - weight / 2 - start) / total, 0, 1)
    cell = np.floor(delta * (np.arcsin(2 * q - 1) / np.pi + 0.5)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (cell[1:] != cell[:-1])])
    w = np.add.reduceat(weight, new)
    return group[new], np.add.reduceat(value * weight, new) / w, w


def quantiles(group: np.ndarray, mean: np.ndarray, weight: np.ndarray, n_groups: int, qs: tuple[float, ...]) -> np.ndarray:
    """Interpolates between centroid centres at rank q(n-1); groups without values give NaN."""
    out = np.full((n_groups, len(qs)), np.nan)
    bounds = np.searchsorted(group, np.arange(n_groups + 1))
    for g in range(n_groups):
        a, b = bounds[g], bounds[g + 1]
        if a < b:
            w = weight[a:b]
            centre = np.cumsum(w) - w + (w - 1) / 2
            out[g] = np.interp(np.array(qs) * (w.sum() - 1), centre, mean[a:b])
    return out


class _Groups:
    """Digests of one grouping inside a task."""

    def __init__(self, delta: int):
        self.delta, self.ids, self.keys = delta, {}, []
        self.nulls: dict[int, int] = {}
        self.rows: dict[int, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held, self.limit = 0, _COMPACT

    def codes(self, keys: pd.DataFrame) -> np.ndarray:
        code = np.zeros(len(keys), dtype=np.int64)
        for c in keys:
            own, names = pd.factorize(keys[c], use_na_sentinel=False)
            code = code * (len(names) + 1) + own
            _, code = np.unique(code, return_inverse=True)
        _, at, code = np.unique(code, return_index=True, return_inverse=True)
        known = np.empty(len(at), dtype=np.int64)
        for i, key in enumerate(keys.iloc[at].itertuples(index=False, name=None)):
            key = tuple(None if pd.isna(x) else x for x in key)
            if key not in self.ids:
                self.ids[key] = len(self.keys)
                self.keys.append(key)
            known[i] = self.ids[key]
        return known[code]

    def add(self, code: np.ndarray, value: np.ndarray, weight: np.ndarray) -> None:
        self.parts.append((code, value, weight))
        self.held += len(code)
        if self.held > self.limit:
            self.parts = [self.done()]
            self.held = len(self.parts[0][0])
            self.limit = max(_COMPACT, 2 * self.held)  # many groups don't cluster again with each batch

    def count(self, code: np.ndarray, rows: np.ndarray, nulls: np.ndarray) -> None:
        r = np.bincount(code, weights=rows, minlength=len(self.keys))
        m = np.bincount(code, weights=nulls, minlength=len(self.keys))
        for i in np.flatnonzero(r + m):
            self.rows[i] = self.rows.get(i, 0) + int(r[i])
            self.nulls[i] = self.nulls.get(i, 0) + int(m[i])

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0)
        return recluster(*(np.concatenate(x) for x in zip(*self.parts, strict=True)), self.delta)

    def frame(self, columns: list[str], kinds: list[pa.DataType]) -> dict[str, pa.Array]:
        out = {c: pa.array([k[i] for k in self.keys], kinds[i]) for i, c in enumerate(columns)}
        n = range(len(self.keys))
        return out | {"n": pa.array([self.rows.get(i, 0) for i in n], pa.int64()), "n_null": pa.array([self.nulls.get(i, 0) for i in n], pa.int64())}


def _kinds(df: DataFrame, columns: list[str]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(df.schema[c].dataType) for c in columns]


def _ddl(df: DataFrame, columns: list[str]) -> str:
    return ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)


def digests(df: DataFrame, groupings: dict[str, list[str]], value: str, delta: int = DELTA) -> DataFrame:
    """One digest for each task and group: ``grouping``, all key columns, ``n``, ``n_null``, ``means``, ``weights``.

    ``value`` is a number or an array of numbers; a row of an array counts each of its numbers. Null and NaN are counted in
    ``n_null`` only. Null keys form groups of their own.
    """
    columns = list(dict.fromkeys(c for cs in groupings.values() for c in cs))
    kinds = _kinds(df, columns)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {g: _Groups(delta) for g in groupings}
        for batch in batches:
            keys = {c: batch.column(c).to_pandas(date_as_object=True) if pa.types.is_date(batch.column(c).type) else batch.column(c).to_pandas(integer_object_nulls=True) for c in columns}
            v = batch.column(value)
            if pa.types.is_list(v.type):
                row = pa.compute.list_parent_indices(v).to_numpy()
                numbers = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            else:
                row, numbers = np.arange(batch.num_rows), v.to_numpy(zero_copy_only=False).astype(np.float64)
            good = ~np.isnan(numbers)
            for g, cs in groupings.items():
                code = own[g].codes(pd.DataFrame({c: keys[c] for c in cs}))
                own[g].count(code, np.bincount(row, weights=good, minlength=len(code)), np.bincount(row, weights=~good, minlength=len(code)))
                own[g].add(code[row[good]], numbers[good], np.ones(good.sum()))
        for g, cs in groupings.items():
            if not own[g].keys:
                continue
            code, mean, weight = own[g].done()
            at = np.searchsorted(code, np.arange(len(own[g].keys) + 1)).astype(np.int32)
            cols = own[g].frame(cs, [kinds[columns.index(c)] for c in cs])
            n = len(own[g].keys)
            cols |= {c: pa.nulls(n, kinds[i]) for i, c in enumerate(columns) if c not in cs}
            cols |= {"grouping": pa.array([g] * n), "means": pa.ListArray.from_arrays(at, mean), "weights": pa.ListArray.from_arrays(at, weight)}
            yield from pa.table({c: cols[c] for c in ["grouping", *columns, "n", "n_null", "means", "weights"]}).to_batches(max_chunksize=2048)

    return df.select(*columns, value).mapInArrow(build, f"grouping string, {_ddl(df, columns)}, n long, n_null long, means array<double>, weights array<double>")


#: Digests of one group that a task merges; of more, parts are merged first.
FAN_IN = 256


def merge(parts: DataFrame, columns: list[str], qs: tuple[float, ...] = QUANTILES, delta: int = DELTA, fan_in: int = FAN_IN) -> DataFrame:
    """Merges digests of equal groups and reads the quantiles off: ``grouping``, keys, ``n``, ``n_null``, ``p50`` ...

    A group has at most one digest for each task; where there may be more tasks than ``fan_in``, digests meet in salted parts of a group first.
    """
    salts = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")) // fan_in
    if salts > 1:
        parts = parts.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts))).repartition("grouping", *columns, "_salt").drop("_salt")
        parts = _merged(parts, columns, None, delta)
    return _merged(parts.repartition("grouping", *columns), columns, qs, delta)


def _merged(parts: DataFrame, columns: list[str], qs: tuple[float, ...] | None, delta: int) -> DataFrame:
    """One row for each group of a partition: its quantiles, or its digest where ``qs`` is None."""
    kinds = [pa.string(), *_kinds(parts, columns)]
    names = [f"p{round(q * 100)}" for q in qs or ()]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Groups(delta)
        for batch in batches:
            keys = {c: batch.column(c).to_pandas(date_as_object=True) if pa.types.is_date(batch.column(c).type) else batch.column(c).to_pandas(integer_object_nulls=True) for c in ["grouping", *columns]}
            code = own.codes(pd.DataFrame(keys))
            own.count(code, batch.column("n").to_numpy(), batch.column("n_null").to_numpy())
            row = pa.compute.list_parent_indices(batch.column("means")).to_numpy()
            own.add(code[row], batch.column("means").flatten().to_numpy(), batch.column("weights").flatten().to_numpy())
        if not own.keys:
            return
        code, mean, weight = own.done()
        cols = own.frame(["grouping", *columns], kinds)
        if qs is None:
            at = np.searchsorted(code, np.arange(len(own.keys) + 1)).astype(np.int32)
            cols |= {"means": pa.ListArray.from_arrays(at, mean), "weights": pa.ListArray.from_arrays(at, weight)}
        else:
            found = quantiles(code, mean, weight, len(own.keys), qs)
            cols |= {c: pa.array(found[:, i], mask=np.isnan(found[:, i])) for i, c in enumerate(names)}
        yield from pa.table(cols).to_batches(max_chunksize=2048)

    last = "means array<double>, weights array<double>" if qs is None else ", ".join(f"{c} double" for c in names)
    return parts.mapInArrow(build, f"grouping string, {_ddl(parts, columns)}, n long, n_null long, {last}")


def rank_error(q: float, n: Column, below: Column, upto: Column) -> Column:
    """Distance between rank q(n-1) and the ranks that the estimate holds, as a share of n."""
    t = F.lit(q) * (n - 1)
    return F.when(n > 0, F.greatest(F.lit(0.0), below - 1 - t, t - upto) / n)


def distinct_results(results: DataFrame) -> DataFrame:
    """Each replay result once, as last recorded: keys and one struct ``r``.

    A result is one (run_id, replay_round, line_number, result_id), nulls being equal to each other. Copies meet in the partition of
    their run's block of lines, so that a run of any size is spread and nothing else is shuffled again.
    """
    part = F.xxhash64("run_id", (F.col("line_number") / BLOCK).cast("long"))
    r = F.struct(F.col("latency_ms").cast("double").alias("latency_ms"), F.col("sent_at").cast("date").alias("replay_day"), "model", "status_code")
    return results.select(part.alias("part"), "run_id", "replay_round", "line_number", "result_id", "recorded_at", r.alias("r")).groupBy("part", "run_id", "replay_round", "line_number", "result_id").agg(F.max_by("r", F.coalesce("recorded_at", F.lit("1970-01-01").cast("timestamp"))).alias("r"))


GROUPINGS = {"run": ["run_id"], "run_day": ["run_id", "replay_day"], "model_status": ["model", "status_code"]}
_KEYS = ["run_id", "replay_day", "model", "status_code"]


def latency_percentiles(results: DataFrame, delta: int = DELTA, bound: float = BOUND) -> DataFrame:
    """p50, p95 and p99 of ``latency_ms`` per run, per run and day, and per model and status code.

    ``err*`` is the certified rank error of each estimate (counted over all values in a second pass) and ``bound`` the stated bound.
    Groups of up to about 300 values are exact. A group of null latencies only has n = 0 and null percentiles. An empty table gives
    an empty result.
    """
    base = distinct_results(results)
    flat = base.select("part", "run_id", "r.*")
    est = merge(digests(flat, GROUPINGS, "latency_ms", delta), _KEYS, delta=delta)
    names = [f"p{round(q * 100)}" for q in QUANTILES]

    # thresholds of every (block, keys) combination; far fewer rows than results
    cell = F.xxhash64("part", *_KEYS)
    cells = flat.select(cell.alias("cell"), *_KEYS).distinct()
    for g, cs in GROUPINGS.items():
        e = est.where(F.col("grouping") == g).select(*[F.col(c).alias(f"{g}_{c}") for c in cs], *[F.col(c).alias(f"{g}_{c}") for c in names])
        cells = cells.join(e, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{g}_{c}")) for c in cs])).drop(*[f"{g}_{c}" for c in cs])
    values = flat.where(F.col("latency_ms").isNotNull() & ~F.isnan("latency_ms")).select(cell.alias("cell"), "latency_ms")
    marks = [(f"{g}_{c}", kind) for g in GROUPINGS for c in names for kind in ("lt", "le")]
    counts = [F.sum((F.col("latency_ms") < F.col(c) if kind == "lt" else F.col("latency_ms") <= F.col(c)).cast("long")).alias(f"{c}_{kind}") for c, kind in marks]
    counted = values.join(cells.hint("shuffle_hash"), "cell").groupBy("cell", *_KEYS).agg(*counts)
    rows = [
        F.struct(F.lit(g).alias("grouping"), *[(F.col(c) if c in cs else F.lit(None).cast(flat.schema[c].dataType)).alias(c) for c in _KEYS], *[F.col(f"{g}_{c}_{k}").alias(f"{c}_{k}") for c in names for k in ("lt", "le")])
        for g, cs in GROUPINGS.items()
    ]
    ranks = counted.select(F.explode(F.array(*rows)).alias("x")).select("x.*").groupBy("grouping", *_KEYS).agg(*[F.sum(f"{c}_{k}").alias(f"{c}_{k}") for c in names for k in ("lt", "le")])
    a, b = est.alias("a"), ranks.alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ["grouping", *_KEYS]])
    errors = [rank_error(q, F.col("a.n"), F.col(f"b.p{round(q * 100)}_lt"), F.col(f"b.p{round(q * 100)}_le")).alias(f"err{round(q * 100)}") for q in QUANTILES]
    return a.join(b, on, "left").select("a.*", *errors, F.lit(bound).alias("bound"))


def distinct_reports(stats: DataFrame) -> DataFrame:
    """Each report once, as last reported."""
    keep = F.struct("run_id", "replay_day", "worker", "completed", "status_counts", "latencies_ms")
    spark = stats.sparkSession
    # a number of its own keeps the parts apart, few bytes stand for much work
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return stats.repartition(parts, "stats_id").groupBy("stats_id").agg(F.max_by(keep, F.coalesce("reported_at", F.lit("1970-01-01").cast("timestamp"))).alias("r")).select("stats_id", "r.*")


def _less(c: str):
    return lambda x: x < F.col(c)


def _upto(c: str):
    return lambda x: x <= F.col(c)


def report_percentiles(stats: DataFrame, delta: int = DELTA, bound: float = BOUND) -> DataFrame:
    """The same percentiles per run and per run and day, combined from the workers' daily reports.

    Each report becomes a digest; digests are merged over workers and days. The errors are certified over the reported
    latencies. A null array counts as empty; ``results`` sums ``status_counts``, null latencies included.
    """
    reports = distinct_reports(stats)
    groupings = {g: GROUPINGS[g] for g in ("run", "run_day")}
    keys = ["run_id", "replay_day"]
    est = merge(digests(reports, groupings, "latencies_ms", delta), keys, delta=delta)
    names = [f"p{round(q * 100)}" for q in QUANTILES]
    total = F.aggregate(F.map_values("status_counts"), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0).cast("long")))
    out = None
    for g, cs in groupings.items():
        e = est.where(F.col("grouping") == g).select(*[F.col(c).alias(f"e_{c}") for c in cs], "n", "n_null", *names)
        joined = reports.join(e, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"e_{c}")) for c in cs]))
        aggs = [F.sum(F.coalesce(F.size(F.filter("latencies_ms", t)), F.lit(0)).cast("long")).alias(f"{c}_{k}") for c in names for k, t in (("lt", _less(c)), ("le", _upto(c)))]
        one = joined.groupBy(*cs, "n", *names).agg(F.sum(F.coalesce(total, F.lit(0))).alias("results"), *aggs)
        errors = [rank_error(q, F.col("n"), F.col(f"p{round(q * 100)}_lt"), F.col(f"p{round(q * 100)}_le")).alias(f"err{round(q * 100)}") for q in QUANTILES]
        one = one.select(F.lit(g).alias("grouping"), "run_id", ("replay_day" if "replay_day" in cs else F.lit(None).cast("date").alias("replay_day")), "n", "results", *names, *errors, F.lit(bound).alias("bound"))
        out = one if out is None else out.unionByName(one)
    return out
