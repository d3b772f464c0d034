"""Run log: events are appended; the log is the latest event of each run and stage."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import AUDIT_COLUMNS
from tidemark.operators.conform import RunInfo, latest
from tidemark.sources.layers import LayerStore

LOG_TABLE = "control_pipeline_run_log"
LOG_KEY = ("pipeline_run_id", "stage")
LONGEST_MESSAGE = 2000
RECORDED = "recorded"
_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "timestamp": T.TimestampType()}
EVENTS = T.StructType([T.StructField(name, _KINDS[kind])
                       for name, kind in {**AUDIT_COLUMNS, RECORDED: "bigint"}.items()])


@dataclass
class StageCounts:
    rows_read: int = 0
    rows_written: int = 0


def run_log(store: LayerStore) -> DataFrame:
    """One row per run and stage: the last one recorded, so a retry replaces its row."""
    return latest(store.appended("control", LOG_TABLE, EVENTS), LOG_KEY, (RECORDED,)).drop(RECORDED)


def compact_run_log(store: LayerStore) -> int:
    return store.compact("control", LOG_TABLE, EVENTS)


class RunLog:
    """Writes the events of one run, a small file each; runs at the same time do not
    disturb each other.  Messages are cut after ``longest_message`` characters."""

    def __init__(self, store: LayerStore, run: RunInfo, longest_message: int = LONGEST_MESSAGE):
        self.store = store
        self.run = run
        self.longest_message = longest_message

    def record(self, stage: str, status: str, counts: StageCounts | None = None,
               started: dt.datetime | None = None, error: str | None = None) -> None:
        counts = counts or StageCounts()
        ended = dt.datetime.now(dt.UTC)
        started = started or ended
        row = (self.run.run_id, self.run.run_date, stage, status, counts.rows_read,
               counts.rows_written, started, ended, int((ended - started).total_seconds()),
               error[:self.longest_message] if error else None, time.time_ns())
        event = self.store.spark.range(1, numPartitions=1).select(*[
            F.lit(value).cast(field.dataType).alias(field.name)
            for value, field in zip(row, EVENTS, strict=True)])
        self.store.append(event, "control", LOG_TABLE)

    @contextmanager
    def stage(self, name: str, announce: bool = False) -> Iterator[StageCounts]:
        """Log a stage as Succeeded, or as Failed with its message and re-raise."""
        started = dt.datetime.now(dt.UTC)
        counts = StageCounts()
        if announce:
            self.record(name, "Started", counts, started)
        try:
            yield counts
        except Exception as error:
            self.record(name, "Failed", counts, started, str(error))
            raise
        self.record(name, "Succeeded", counts, started)
