"""Scores from a remote service, asked in batches by the executors; used only where a client is given."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def with_retries(call: Callable[[dict], float], payload: dict, tries: int = 10, longest: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> float:
    """Calls until it succeeds; waits 2^k seconds, at most ``longest``, plus up to one second. The last failure is raised."""
    for k in range(tries):
        try:
            return call(payload)
        except Exception:
            if k + 1 == tries:
                raise
            sleep(min(2.0**k, longest) + random.random())
    raise ValueError("at least one try is needed")


def remote_reward(df: DataFrame, id_col: str, client: Callable[[], Callable[[dict], float]], fields: tuple[str, ...] = ("prompt", "response", "label"), tries: int = 10, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``id_col, reward`` of every row; ``client`` makes one connection per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        call = client()
        for b in batches:
            yield pd.DataFrame({id_col: b[id_col], "reward": [with_retries(call, dict(zip(fields, r, strict=True)), tries, sleep=sleep) for r in b[list(fields)].itertuples(index=False)]})

    return df.select(id_col, *fields).mapInPandas(run, f"{id_col} {dict(df.dtypes)[id_col]}, reward double")
