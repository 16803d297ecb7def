"""Counters of a stage that are taken in the pass that writes its rows.

``observe`` puts aggregates into the plan: when the write ends, so do they, and no job
of its own counts anything.  Streams report the same counters with each batch to a
listener.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class Counters:
    """Named aggregates of the rows that pass a point of a plan, known when an action has run."""

    def __init__(self, name: str, counted: dict[str, Column] | None = None, **conditions: Column):
        self.name, self.began = name, time.monotonic()
        columns = dict(counted or {}) | {k: F.count_if(c) for k, c in conditions.items()}
        self.columns = {"rows": F.count(F.lit(1)), **columns}
        self.observed: Observation | None = None

    def over(self, df: DataFrame) -> DataFrame:
        """``df``, counted where it stands: filters that follow don't change the counters."""
        if self.observed is not None:
            raise ValueError("the counters are on a plan already")
        # Names of observations are a session's; each run has its own.
        self.observed = Observation(f"{self.name}-{id(self)}-{time.monotonic_ns()}")
        return df.observe(self.observed, *[c.alias(n) for n, c in self.columns.items()])

    def read(self) -> dict[str, object]:
        """What was counted; call it after an action on the plan."""
        if self.observed is None:
            raise ValueError("the counters are on no plan")
        return dict(self.observed.get)

    @property
    def elapsed(self) -> float:
        return round(time.monotonic() - self.began, 3)


def by_value(column: str, values: list[str], prefix: str = "") -> dict[str, Column]:
    """A counter for each of ``values`` and one, ``prefix``other, for all else (null too)."""
    each = {f"{prefix}{v}": F.count_if(F.col(column) == v) for v in values}
    return each | {f"{prefix}other": F.count_if(~F.coalesce(F.col(column).isin(*values), F.lit(False)))}


class Progress(StreamingQueryListener):
    """Hands on, for each batch of a stream, its number, rows, milliseconds and counters."""

    def __init__(self, told: Callable[[dict], None]):
        self.told = told

    def onQueryStarted(self, event) -> None:  # noqa: N802 - Spark's names
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        counted = {name: row.asDict() for name, row in (p.observedMetrics or {}).items()}
        self.told({"batch": p.batchId, "rows": p.numInputRows, "milliseconds": p.batchDuration, "counters": counted})

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
