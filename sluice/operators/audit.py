"""Audit columns: who wrote each row, when, and from where.

``load_dt``, ``source_format``, ``source_file`` and ``run_id`` are added in one
projection. Re-tagging (a row that already carries audit columns from an
upstream step) drops the old values and appends fresh ones at the end; the
old ``source_file`` can be kept as ``upstream_source_file``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.context import RunContext

# Audit column names, in table order.
AUDIT_COLUMNS = ("load_dt", "source_format", "source_file", "run_id")


def audit_values(
    source_format: str, source_file: str | Column | None, ctx: RunContext | None = None
) -> dict[str, Column]:
    ctx = ctx or RunContext()
    if source_file is None:
        # Per-row truth: the file the row was read from (batch and streaming file scans).
        file_col = F.col("_metadata.file_name")
    elif isinstance(source_file, Column):
        file_col = source_file
    else:
        file_col = F.lit(source_file)
    return {
        "load_dt": ctx.load_dt_column(),
        "source_format": F.lit(source_format),
        "source_file": file_col,
        "run_id": F.lit(ctx.run_id),
    }


def add_audit_columns(
    df: DataFrame,
    source_format: str,
    source_file: str | Column | None,
    ctx: RunContext | None = None,
    keep_position: bool = False,
    keep_upstream_file: bool = False,
) -> DataFrame:
    """Tag every row.

    ``source_file=None`` takes the per-row file name from the scan's ``_metadata``.
    With ``keep_position`` existing audit columns are replaced where they are;
    otherwise they are dropped and fresh ones appended at the end.
    """
    values = audit_values(source_format, source_file, ctx)
    if keep_upstream_file and "source_file" in df.columns:
        values = {"upstream_source_file": F.col("source_file"), **values}
    if keep_position:
        return df.withColumns(values)
    present = [c for c in AUDIT_COLUMNS if c in df.columns]
    projection = [F.col(f"`{c}`") for c in df.columns if c not in present and c not in values]
    return df.select(*projection, *[v.alias(k) for k, v in values.items()])


def strip_audit_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT_COLUMNS if c in df.columns])
