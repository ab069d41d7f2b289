"""Pipeline event log: buffered records appended to a log table in one write per flush.

Logging never breaks a job: if the log table cannot be written, the log
disables itself for the rest of the run and keeps the records in memory.
"""
from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession

from sluice.context import RunContext

# The log's column names.
LOG_SCHEMA = "event_ts timestamp, run_id string, job_name string, module string, level string, message string"


class EventLog:
    def __init__(self, spark: SparkSession, path: str, job_name: str, ctx: RunContext | None = None,
                 clock=None):
        self.spark = spark
        self.path = path
        self.job_name = job_name
        self.ctx = ctx or RunContext()
        self.clock = clock or (lambda: _dt.datetime.now(_dt.timezone.utc))  # aware: the instant, whatever the process's zone
        self.buffer: list[tuple] = []
        self.disabled = False
        self.log = logging.getLogger("sluice.eventlog")

    def record(self, module: str, level: str, message: str) -> None:
        self.buffer.append((self.clock(), self.ctx.run_id, self.job_name, module, level, message))
        self.log.log(getattr(logging, level, logging.INFO), "%s | %s", module, message)

    def info(self, module: str, message: str) -> None:
        self.record(module, "INFO", message)

    def error(self, module: str, message: str) -> None:
        self.record(module, "ERROR", message)

    def __enter__(self) -> EventLog:
        return self

    def __exit__(self, kind, error, trace) -> None:
        """What was recorded is kept, also of a job that fails."""
        if error is not None:
            self.error("job", f"{kind.__name__}: {error}")
        self.flush()

    def flush(self) -> int:
        """Append buffered records in one write; returns how many were written."""
        if self.disabled or not self.buffer:
            return 0
        try:
            rows = list(self.buffer)
            self.spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.buffer.clear()
            return len(rows)
        except Exception as exc:  # logging must never break the job
            self.disabled = True
            self.log.debug("no more events are written to %s: %s", self.path, exc)
            return 0

    def table(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.path)
