"""Streaming upsert: late-arriving rows merged by key, newest event wins.

Micro-batches land as loads of the change table ``<target>/_changes`` (as any stream does, tagged with audit columns); once the stream
is drained, all loads that the target doesn't hold yet are merged in one go, newest ``(order_by, load_dt)`` first. The
merge commit names the loads it took, so a replayed batch, or a run that stopped before the merge, changes nothing twice.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sluice.context import RunContext
from sluice.plans.merge import merge_into
from sluice.plans.tables import Table
from sluice.sources.spec import SourceSpec
from sluice.streaming.ingest import stream_ingest


def stream_upsert(spark: SparkSession, spec: SourceSpec, target: str, keys: list[str], order_by: list[str],
                  ctx: RunContext | None = None, max_files: int | None = None, max_bytes: int | None = None, gate=None) -> dict:
    ctx = ctx or RunContext()
    changes, table = Table(spark, f"{target.rstrip('/')}/_changes"), Table(spark, target)
    landed = stream_ingest(spark, spec, changes.path, ctx, max_files=max_files, max_bytes=max_bytes, gate=gate)
    todo = sorted(set(changes.visible_loads()) - table.merged_sources()) if changes.exists() else []
    if not todo:
        return {"batches": landed.new_files, "merged": 0}
    updates = changes.read(with_load_id=True).filter(F.col("load_id").isin(todo)).drop("load_id")
    load_id = "m" + hashlib.sha256("\n".join(todo).encode()).hexdigest()[:16]
    rows = merge_into(table, updates, keys, [*order_by, "load_dt"], load_id, ctx.run_id, sources=todo)
    return {"batches": landed.new_files, "merged": len(todo), "rows": rows}
