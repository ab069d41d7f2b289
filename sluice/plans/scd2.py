"""A type-2 dimension that is the same in whatever order its snapshots come.

It is kept as two tables of runs (see ``splice_snapshot``): those of the current versions, replaced by each snapshot, and those of closed
versions. A snapshot newer than all others reads and replaces current runs only and adds the runs it closes; a late one is spliced into the
whole history, which is written anew once. The commit of the current runs names the closed loads that go with it and the times of
all snapshots so far, so both tables change at once.
"""
from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import new_workdir, release
from sluice.operators.history import SCD_COLUMNS, SEEN, run_versions, splice_snapshot
from sluice.plans.tables import Table

_STATE = ("_version", *SCD_COLUMNS)


class RepeatedSnapshot(ValueError):
    """Another snapshot of a time that the dimension already holds one of."""


class Scd2Table:
    def __init__(self, spark: SparkSession, path: str, keys: list[str], tracked: list[str]):
        self.spark, self.keys, self.tracked = spark, keys, tracked
        self.open_rows, self.closed_rows = Table(spark, f"{path}/open"), Table(spark, f"{path}/closed")

    def _named(self, kind: str) -> list[str]:
        commits = self.open_rows.commits()
        return [s.removeprefix(f"{kind}=") for s in (commits[-1]["sources"] or []) if s.startswith(f"{kind}=")] if commits else []

    def applied(self) -> list[_dt.datetime]:
        """The times of all snapshots applied so far, in time order."""
        return sorted(_dt.datetime.fromisoformat(t) for t in self._named("as_of"))

    def _runs(self, closed: bool) -> DataFrame:
        opened = self.open_rows.read()
        loads = self._named("closed") if closed else []
        if not loads:
            return opened
        ended = self.closed_rows.read(with_load_id=True).filter(F.col("load_id").isin(loads)).drop("load_id")
        return ended.unionByName(opened, allowMissingColumns=True).select(*[F.col(f"`{c}`") for c in opened.columns])

    def apply(self, snapshot: DataFrame, as_of: _dt.datetime, load_id: str, run_id: str = "") -> int:
        """Apply a full snapshot; returns how many versions end with it. A repeated ``load_id`` is a no-op, another snapshot of an applied time is refused.

        Keys that a snapshot lacks stay open; new attributes widen the dimension and are NULL in other snapshots.
        """
        if self.open_rows.has_load(load_id):
            return 0
        applied = self.applied()
        if as_of in applied:
            raise RepeatedSnapshot(f"a snapshot of {as_of} was applied before")
        late = bool(applied) and as_of < applied[-1]
        runs = self._runs(closed=late).drop(*_STATE) if applied else None
        when = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        rows = run_versions(splice_snapshot(runs, snapshot, self.keys, when), self.keys, self.tracked)
        work = new_workdir(self.spark, "scd2")
        rows.write.parquet(f"{work}/rows")
        staged = self.spark.read.schema(rows.schema).parquet(f"{work}/rows")
        ended = f"{load_id}-{uuid.uuid4().hex[:8]}"  # a load that a stopped run left is named by no commit
        got, schema = self.closed_rows.stage_load(staged.filter("NOT is_current"), ended, observed={"ended": F.count_if(F.col("_version") & (F.col("valid_to") == when))})
        self.closed_rows.commit_load(ended, got["rows"], schema, run_id=run_id)
        closed = [ended] if late else [*self._named("closed"), ended]
        self.open_rows.write_load(staged.filter("is_current"), load_id, mode="overwrite", run_id=run_id,
                                  sources=[*[f"closed={c}" for c in closed], *[f"as_of={t.isoformat()}" for t in [*applied, as_of]]])
        release(self.spark, work)
        return got["ended"]

    def read(self) -> DataFrame:
        """Every version: keys, attributes, ``valid_from, valid_to, is_current``."""
        runs = self._runs(closed=True)
        return runs.filter("_version").select(*[F.col(f"`{c}`") for c in runs.columns if c not in (SEEN, *_STATE)], *SCD_COLUMNS)
