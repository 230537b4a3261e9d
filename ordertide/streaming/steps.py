"""M3: what each step of a batch's work took.

Steps inside a batch are timed around their write, and the rows they wrote are counted on the way by an
observation, without another pass. What Spark spends around them (planning, offsets, commit) comes from
its own progress reports. Both go to one log, a row per step.
"""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ordertide import schemas as S

# Reports held until the next batch takes them; older ones go first.
MOST_REPORTS = 10_000
# For the counts of a batch's steps to arrive.
WAIT_SECONDS = 2.0


class ProgressLog(StreamingQueryListener):
    """Phases of finished triggers of the session's queries. Add it with ``spark.streams.addListener``."""

    def __init__(self) -> None:
        self._held: deque = deque(maxlen=MOST_REPORTS)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        began = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        name = p.name or str(p.id)
        self._held.extend((name, f"spark:{phase}", began, p.numInputRows, float(ms)) for phase, ms in p.durationMs.items())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def taken(self) -> list[tuple]:
        """The reports so far; each is given once."""
        return [self._held.popleft() for _ in range(len(self._held))]


class StepClock:
    """Times the steps of one batch."""

    def __init__(self, query: str) -> None:
        self._query, self._steps = query, []

    @contextmanager
    def step(self, name: str, df: DataFrame | None = None) -> Iterator[DataFrame | None]:
        """Time the block. Inside it ``df`` is to be written once; its rows are counted by that."""
        seen = Observation() if df is not None else None
        began, start = datetime.now(timezone.utc), time.perf_counter()
        yield df.observe(seen, F.count(F.lit(1)).alias("rows")) if df is not None else None
        self._steps.append((self._query, name, began, seen, (time.perf_counter() - start) * 1000.0))

    def rows(self, spark: SparkSession, progress: ProgressLog | None = None) -> DataFrame:
        until = time.monotonic() + WAIT_SECONDS
        own = [(query, name, began, _counted(seen, until), ms) for query, name, began, seen, ms in self._steps]
        return spark.createDataFrame(own + (progress.taken() if progress else []), S.STEP_LOG).coalesce(1)


def _counted(seen: Observation | None, until: float) -> int | None:
    """The observed count; null for a step that Spark never had to run. Observations arrive just after their write."""
    if seen is None:
        return None
    done = seen._jo.future()
    while not done.isCompleted() and time.monotonic() < until:
        time.sleep(0.005)
    return seen.get["rows"] if done.isCompleted() else None
