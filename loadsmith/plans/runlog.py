"""Run log (G1-G3): a run is a list of named steps; what became of them is stored once.

``run_steps`` carries the steps out in order and keeps one immutable outcome per
step.  Row counts that a later write observes are settled when the run has ended,
and only if it succeeded: an observation on a write that never ended would have
nothing to tell and is not asked.  The outcomes are appended to the log in one
write, whether the run succeeded or failed; a failure is then raised again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from loadsmith.sinks.publish import observed_metrics
from loadsmith.sources.tables import is_path

RUNLOG_SCHEMA = ("run_id string, package string, step string, status string, row_count bigint, "
                 "message string, started_at timestamp, ended_at timestamp")


@dataclass(frozen=True)
class StepOutcome:
    run_id: str
    package: str
    step: str
    status: str
    row_count: int
    message: str
    started_at: dt.datetime
    ended_at: dt.datetime


def later(obs: Observation, name: str = "n") -> Callable[[], int]:
    """A count that ``obs`` knows once the run's writes have ended."""
    return lambda: int(observed_metrics(obs, [name])[name] or 0)


def _utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_steps(spark: SparkSession, package: str, steps: Iterable[tuple[str, Callable[[dict], object]]],
              log_to: str | None = None, run_id: str | None = None) -> list[StepOutcome]:
    """Run ``(name, work)`` steps in order; each ``work(shared)`` returns its row count.

    The count is a number, or a function (see ``later``) that is called after the
    last step.  A failing step ends the run: it is logged as FAILED with its error,
    later steps aren't logged, and counts that wait for a write stay 0.
    """
    run_id, shared, ended, failure = run_id or str(uuid.uuid4()), {}, [], None
    for name, work in steps:
        began, count = _utc(), 0
        try:
            count = work(shared) or 0
        except Exception as error:  # noqa: BLE001 - logged, then raised again
            failure = error
        ended.append((name, count, began, _utc()))
        if failure is not None:
            break
    outcomes = []
    for i, (name, count, began, over) in enumerate(ended):
        failed = failure is not None and i == len(ended) - 1
        if callable(count):
            count = 0 if failure is not None else count()
        message = f"{type(failure).__name__}: {failure}" if failed else f"{(over - began).total_seconds():.2f} s"
        outcomes.append(StepOutcome(run_id, package, name, "FAILED" if failed else "SUCCEEDED", int(count), message,
                                    began, over))
    if log_to:
        store(spark, outcomes, log_to)
    if failure is not None:
        raise failure
    return outcomes


def frame(spark: SparkSession, outcomes: list[StepOutcome]) -> DataFrame:
    return spark.createDataFrame([astuple(o) for o in outcomes], RUNLOG_SCHEMA)


def store(spark: SparkSession, outcomes: list[StepOutcome], target: str) -> None:
    """Append a run's outcomes to the log, a folder or a catalog table, in one write."""
    writer = frame(spark, outcomes).coalesce(1).write.mode("append").format("parquet")
    writer.save(target) if is_path(target) else writer.saveAsTable(target)
