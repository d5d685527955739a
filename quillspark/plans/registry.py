"""Queries by operator id, and user functions by dotted path."""

from __future__ import annotations

import importlib
import inspect
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def positive_zero(sql: str) -> str:
    """Every ``round(...)`` with 0.0 added, which turns a negative zero into a positive one as Spark's rounding does."""
    out, at = [], 0
    while (start := sql.find("round(", at)) >= 0:
        depth, end = 0, start + 5
        while True:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
            if depth == 0:
                break
        out.append(f"{sql[at:start]}(round({positive_zero(sql[start + 6:end - 1])}) + 0.0)")
        at = end
    return "".join(out) + sql[at:]


def op(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its operator id, with the SQL that gives the same rows."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql:
            SQL[name] = positive_zero(sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_hook(path: str) -> Callable:
    """The function or class at a dotted path; a wrong path raises ImportError or AttributeError."""
    module, _, name = path.rpartition(".")
    if not module:
        raise ImportError(f"{path!r} is no dotted path")
    return getattr(importlib.import_module(module), name)


class Hooks:
    """User functions of a pipeline: table hooks map a DataFrame to a DataFrame, column hooks build a Column.

    A hook that is not set leaves its input as it is. Arguments that a function doesn't accept are not passed to it.
    """

    TABLE = ("rollout", "generate", "dynamic_filter", "buffer_filter", "sample_filter", "all_samples", "reward_post_process", "convert", "data_post_process", "data_source", "model_init", "before_log_prob", "before_train_step")
    COLUMN = ("reward", "loss", "importance")

    def __init__(self, **hooks: str | Callable):
        unknown = set(hooks) - set(self.TABLE) - set(self.COLUMN) - {"log"}
        if unknown:
            raise ValueError(f"unknown hooks: {sorted(unknown)}")
        self.hooks = {k: load_hook(v) if isinstance(v, str) else v for k, v in hooks.items()}

    def table(self, name: str, df: DataFrame, **args) -> DataFrame:
        fn = self.hooks.get(name)
        return fn(df, **accepted(fn, args)) if fn else df

    def column(self, name: str, default: Column, **args) -> Column:
        fn = self.hooks.get(name)
        return fn(**accepted(fn, args)) if fn else default

    def log(self, metrics: DataFrame, default: Callable[[DataFrame], None]) -> None:
        """A log hook that returns a true value replaces the default."""
        fn = self.hooks.get("log")
        if not (fn and fn(metrics)):
            default(metrics)


def accepted(fn: Callable, args: dict) -> dict:
    kinds = inspect.signature(fn).parameters.values()
    if any(p.kind is p.VAR_KEYWORD for p in kinds):
        return args
    names = {p.name for p in kinds}
    return {k: v for k, v in args.items() if k in names}
