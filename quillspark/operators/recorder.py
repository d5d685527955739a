"""Records spans, events and attempts of a driver program as rows of a span log."""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "trace string, ord long, ts double, type string, name string, span_id string, parent_id string, attempt int, error string, attrs map<string,string>"
_STACK: ContextVar[tuple[tuple[str, str], ...]] = ContextVar("spans", default=())


class Recorder:
    """Rows in the order they were recorded; a span's parent is the innermost span of its trace in the running context.

    ``trace`` may be several traces: each gets its rows. An exception inside a span is noted at its end and passes on. Null attributes are left out.
    """

    def __init__(self, clock: Callable[[], float] = time.time):
        self.rows: list[tuple] = []
        self.attempts: dict[str, int] = {}
        self._clock, self._number = clock, itertools.count()

    def _add(self, kind: str, trace: str, name: str, span: str | None, parent: str | None, error: str | None, attrs: dict) -> None:
        own = {k: str(v) for k, v in attrs.items() if v is not None}
        self.rows.append((trace, len(self.rows), float(self._clock()), kind, name, span, parent, self.attempts.get(trace, 0), error, own))

    def next_attempt(self, trace: str) -> int:
        self.attempts[trace] = self.attempts.get(trace, 0) + 1
        return self.attempts[trace]

    @staticmethod
    def _inner(trace: str) -> str | None:
        return next((s for t, s in reversed(_STACK.get()) if t == trace), None)

    def event(self, name: str, *traces: str, **attrs) -> None:
        for t in traces:
            self._add("event", t, name, None, self._inner(t), None, attrs)

    @contextmanager
    def span(self, name: str, *traces: str, **attrs) -> Iterator[dict]:
        """The yielded dictionary takes attributes for the span's end."""
        own = [(t, f"s{next(self._number)}", self._inner(t)) for t in traces]
        for t, s, parent in own:
            self._add("span_start", t, name, s, parent, None, attrs)
        token = _STACK.set(_STACK.get() + tuple((t, s) for t, s, _ in own))
        late: dict = {}
        error = None
        try:
            yield late
        except BaseException as e:
            error = type(e).__name__
            raise
        finally:
            _STACK.reset(token)
            for t, s, parent in own:
                self._add("span_end", t, name, s, parent, error, late)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows, SCHEMA)
