"""Merge (upsert) into a table: target and updates together, the newest row per key, one shuffle."""
from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.operators.history import upsert
from sluice.plans.tables import Table


def merge_into(table: Table, updates: DataFrame, keys: list[str], order_by: list[str], load_id: str,
               run_id: str = "", sources: list[str] | None = None) -> int:
    """Upsert ``updates`` into ``table``: per key the newest ``order_by`` wins; late rows never win.

    The result replaces the table's content as one load. Columns that only the updates have are added (older rows
    read them as NULL); columns that they lack stay. Re-running the same ``load_id`` is a no-op.
    """
    if table.has_load(load_id):
        return 0
    merged = upsert(table.read() if table.exists() else None, updates, keys, order_by)
    return table.write_load(merged, load_id, mode="overwrite", run_id=run_id, sources=sources)
