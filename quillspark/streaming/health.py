"""Health checks of workers: a failed check kills a worker, killed ones are not checked until they are recovered."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def health_events(checks: DataFrame, engine: str = "engine", nth: str = "round", ok: str = "ok", recover_every: int = 1) -> DataFrame:
    """``engine, round, event`` of a log of check rounds: ``passed``, ``killed`` or ``skipped``.

    Workers are recovered before every ``recover_every``-th round (rounds count from 0). A null result is a check that timed out and fails.
    """
    term = F.floor(F.col(nth) / recover_every)
    x = checks.withColumn("_bad", (~F.coalesce(F.col(ok), F.lit(False))).cast("int")).withColumn("_term", term)
    before = F.coalesce(F.sum("_bad").over(Window.partitionBy(engine, "_term").orderBy(nth).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one term of one worker
    event = F.when(before > 0, "skipped").when(F.col("_bad") == 1, "killed").otherwise("passed")
    return x.select(engine, nth, event.alias("event"))


class Monitor:
    """Runs the checks of a driver's own workers.

    ``check`` raises or gives a false value where a worker is not well; it is then killed, with all of its ``parts`` (names of processes by worker), and left out until
    :meth:`recover`. Checks begin paused; after each :meth:`resume` the first waits. Errors of killing are noted and passed over.
    """

    def __init__(self, parts: dict[str, list[str]], check: Callable[[str], bool], kill: Callable[[str], None], start: Callable[[str], None], interval: float = 10.0, first_wait: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        self.parts, self.check, self.kill, self.start = parts, check, kill, start
        self.interval, self.first_wait, self.sleep = interval, first_wait, sleep
        self.dead: set[str] = set()
        self.log: list[tuple[str, str]] = []
        self.paused, self._fresh = True, True

    def pause(self) -> None:
        self.paused = True

    def resume(self) -> None:
        self.paused, self._fresh = False, True

    def run(self, rounds: int) -> None:
        for _ in range(rounds):
            if self.paused:
                return
            if self._fresh:
                self.sleep(self.first_wait)
                self._fresh = False
            for worker in self.parts:
                self._one(worker)
            self.sleep(self.interval)

    def _one(self, worker: str) -> None:
        if worker in self.dead:
            self.log.append((worker, "skipped"))
            return
        try:
            well = self.check(worker)
        except Exception:  # noqa: BLE001
            well = False
        self.log.append((worker, "passed" if well else "killed"))
        if not well:
            for part in self.parts[worker]:
                try:
                    self.kill(part)
                except Exception:  # noqa: BLE001
                    self.log.append((part, "kill failed"))
            self.dead.add(worker)

    def recover(self) -> list[str]:
        """Starts all parts of the dead workers again; which they were."""
        back = sorted(self.dead)
        for worker in back:
            for part in self.parts[worker]:
                self.start(part)
        self.dead.clear()
        return back
