"""Loaders: exactly-once bulk load, full refresh, refresh with expectations, zero-row create, and the
registry-driven ``ingest``.

Every loader goes the same way: read with the schema of the spec, set lines that do not fit it aside,
tag rows with audit columns, write them as an invisible load, check what the write counted, and only then
commit. Lines set aside and loads refused go to the table ``<target>/_quarantine`` with their reason.
"""
from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.context import RunContext
from sluice.operators.audit import AUDIT_COLUMNS, add_audit_columns, strip_audit_columns
from sluice.operators.columns import sanitize_columns
from sluice.operators.quality import EMPTY_TABLE, MISSING_COLUMN, NULL_VALUES, Expectation, enforce, expect
from sluice.plans.eventlog import EventLog
from sluice.plans.tables import Table
from sluice.sources import formats
from sluice.sources.formats import BAD, RAW
from sluice.sources.records import input_files
from sluice.sources.rescue import csv_by_header, read_rescued
from sluice.sources.spec import Registry, SourceSpec


class LoadRejected(RuntimeError):
    """A staged load failed its checks and was not published."""


@dataclass(frozen=True)
class Gate:
    """What a load has to meet before it is published; counted by the write itself."""

    required_columns: tuple[str, ...] = ()
    not_null_columns: tuple[str, ...] = ()
    allow_empty: bool = False

    def counters(self, df: DataFrame) -> dict:
        held = [c for c in (*AUDIT_COLUMNS, *self.not_null_columns) if c in df.columns]
        return {f"null:{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in dict.fromkeys(held)}

    def failures(self, df: DataFrame, got: dict[str, int]) -> list[str]:
        out = [] if got["rows"] or self.allow_empty else [EMPTY_TABLE]
        out += [NULL_VALUES.format(column=k[5:], n=n, rows=got["rows"]) for k, n in got.items() if k.startswith("null:") and n]
        return out + [MISSING_COLUMN.format(column=c) for c in dict.fromkeys((*self.required_columns, *self.not_null_columns)) if c not in df.columns]


@dataclass
class LoadResult:
    source_key: str
    target: str
    rows_loaded: int
    run_id: str
    load_id: str | None = None
    new_files: int = 0
    quarantined: int = 0
    metrics: dict = field(default_factory=dict)

    def row_count(self, spark: SparkSession) -> int:
        return Table(spark, self.target).read().count()


def spec_schema(spark: SparkSession, spec: SourceSpec, paths=None) -> StructType:
    if isinstance(spec.schema, str):
        return StructType.fromDDL(spec.schema)
    return spec.schema or formats.bare_schema(spark, paths or spec.path, spec.format, **dict(spec.options))


_FILE = "_file"


def read_spec(spark: SparkSession, spec: SourceSpec, paths=None, per_file: bool = False) -> DataFrame:
    """The rows of a source, with ``_bad`` and ``_raw`` (see ``formats.read_checked``); with the spec's ``rescue`` what doesn't fit stays with its row.

    CSV files may differ in their headers (see ``csv_by_header``). ``per_file`` adds each row's file name where the scan itself won't tell it later.
    """
    options, where = dict(spec.options), paths or spec.path
    by_header = spec.format == "csv" and str(options.get("header", "true")).lower() == "true" and str(options.get("multiLine", "false")).lower() != "true"
    if by_header:
        schema = spec_schema(spark, spec, paths) if spec.schema or spec.rescue else None
        df = csv_by_header(spark, input_files(spark, where), schema, spec.rescue, _FILE if per_file else None, **options)
    elif spec.rescue:
        df = read_rescued(spark, where, spec.format, spec_schema(spark, spec, paths), spec.rescue, **options)
    else:
        df = formats.read_checked(spark, where, spec.format, spec_schema(spark, spec, paths), **options)
    return strip_audit_columns(df) if spec.has_audit_columns else df


def tag(df: DataFrame, spec: SourceSpec, ctx: RunContext, per_file: bool = False) -> DataFrame:
    if _FILE in df.columns:
        return add_audit_columns(df, spec.format, F.coalesce(F.col(_FILE), F.lit(spec.source_file)), ctx).drop(_FILE)
    return add_audit_columns(df, spec.format, None if per_file else spec.source_file, ctx)


def quarantine_table(spark: SparkSession, target: str) -> Table:
    return Table(spark, f"{target.rstrip('/')}/_quarantine")


def _set_aside(spark: SparkSession, target: str, rows: DataFrame, load_id: str, ctx: RunContext) -> None:
    """Rows with ``_raw`` and ``_bad`` as a load of the quarantine table: text, reason, what could be read of it, audit columns."""
    data = [F.col(f"`{c}`") for c in rows.columns if c not in (RAW, BAD, *AUDIT_COLUMNS)]
    parsed = F.to_json(F.struct(*data)) if data else F.lit(None).cast("string")
    quarantine_table(spark, target).write_load(rows.select(F.col(RAW).alias("raw"), F.col(BAD).alias("reason"), parsed.alias("parsed"), *AUDIT_COLUMNS),
                                               f"q-{load_id}", run_id=ctx.run_id)


def publish(table: Table, df: DataFrame, load_id: str, mode: str, ctx: RunContext, files: DataFrame | None = None, gate: Gate | None = None,
            shape=lambda rows: rows, check=None) -> tuple[int, int, dict]:
    """Stage the good rows of ``df`` (as ``shape`` makes them), check, commit; returns rows, lines set aside, counters.

    The lines set aside are counted by the same write; only if there are any are they read once more. A refused load is
    recorded as a ``reject`` commit: its rows go to quarantine, its source files count as seen, so the good
    files that follow are not held up. ``check(counters)`` may refuse a load by raising.
    """
    bad = Observation(f"bad_{load_id}")
    good = shape(df.observe(bad, F.count_if(F.col(BAD).isNotNull()).alias("n")).filter(F.col(BAD).isNull()).drop(BAD, RAW))
    got, schema = table.stage_load(good, load_id, observed=gate.counters(good) if gate else None)
    n_bad = int(bad.get.get("n") or 0)
    failures = gate.failures(good, got) if gate else []
    if failures:
        reason = "load refused: " + "; ".join(failures)
        rows = table.spark.read.schema(good.schema).parquet(table.load_path(load_id))
        refused = rows.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in good.columns if c not in AUDIT_COLUMNS])).alias(RAW), F.lit(reason).alias(BAD), *AUDIT_COLUMNS)
        _set_aside(table.spark, table.path, refused, load_id, ctx)
        table.commit_load(load_id, 0, schema, "reject", ctx.run_id, files)
        raise LoadRejected(f"load {load_id} into {table.path} rejected: {failures}")
    if check is not None:
        check()
    if n_bad:
        _set_aside(table.spark, table.path, df.filter(F.col(BAD).isNotNull()), load_id, ctx)
    table.commit_load(load_id, got["rows"], schema, mode, ctx.run_id, files)
    return got["rows"], n_bad, got


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """File identities under ``path`` — metadata only, no file content is read."""
    return (spark.read.format("binaryFile").load(path)
            .select("path", "length", F.unix_millis("modificationTime").alias("mtime_ms")))


def copy_into(spark: SparkSession, spec: SourceSpec, target: str, ctx: RunContext | None = None, gate: Gate | None = None) -> LoadResult:
    """Idempotent bulk load: only files never seen before (by path, length, mtime).

    The new-file set is an anti join between the listing and the table's file
    ledger; only the new paths (metadata) reach the driver to build the read.
    ``load_id`` hashes the new file identities, so a retry after a crash between
    data write and commit rewrites the same invisible directory.
    """
    ctx = ctx or RunContext()
    table = Table(spark, target)
    new = list_files(spark, spec.path).join(table.loaded_files(), ["path", "length", "mtime_ms"], "left_anti")
    files = [r.asDict() for r in new.orderBy("path").collect()]
    if not files:
        return LoadResult(spec.key, target, 0, ctx.run_id, None, 0)
    ident = "\n".join(f"{f['path']}|{f['length']}|{f['mtime_ms']}" for f in files)
    load_id = "f" + hashlib.sha1(ident.encode()).hexdigest()[:16]  # letter first: never read back as a number
    if table.has_load(load_id):
        return LoadResult(spec.key, target, 0, ctx.run_id, load_id, 0)
    df = tag(read_spec(spark, spec, [f["path"] for f in files]), spec, ctx)
    seen = spark.createDataFrame([(f["path"], f["length"], f["mtime_ms"]) for f in files], "path string, length long, mtime_ms long")
    rows, bad, _ = publish(table, df, load_id, "append", ctx, seen, gate)
    return LoadResult(spec.key, target, rows, ctx.run_id, load_id, len(files), bad)


def create_empty_like(spark: SparkSession, spec: SourceSpec, target: str, ctx: RunContext | None = None) -> bool:
    """Create ``target`` with exactly the schema a load of ``spec`` would produce, and no rows.

    Only the schema is looked at: no data is read (beyond inference when the spec has no schema). No-op if present.
    """
    ctx = ctx or RunContext()
    plain = spark.createDataFrame([], spec_schema(spark, spec))
    shaped = tag(strip_audit_columns(plain) if spec.has_audit_columns else plain, spec, ctx)
    return Table(spark, target).create_empty(shaped.schema, ctx.run_id)


def full_refresh(spark: SparkSession, spec: SourceSpec, target: str, ctx: RunContext | None = None, gate: Gate | None = None) -> LoadResult:
    """Read the whole source, sanitize names, tag, and replace the table's content.

    The new content is a new load committed with mode ``overwrite``; readers never see a half-written table.
    """
    ctx = ctx or RunContext()
    load_id = f"refresh-{uuid.uuid4().hex[:12]}"
    rows, bad, _ = publish(Table(spark, target), tag(read_spec(spark, spec), spec, ctx), load_id, "overwrite", ctx, gate=gate, shape=sanitize_columns)
    return LoadResult(spec.key, target, rows, ctx.run_id, load_id, quarantined=bad)


def refresh_with_expectations(spark: SparkSession, spec: SourceSpec, target: str, expectations: list[Expectation],
                              ctx: RunContext | None = None, gate: Gate | None = None) -> LoadResult:
    """Whole recompute, audit, expectations counted during the write; violated ``fail`` rules raise before the commit."""
    ctx = ctx or RunContext()
    load_id = f"refresh-{uuid.uuid4().hex[:12]}"
    counted: dict = {}

    def shape(rows: DataFrame) -> DataFrame:
        checked, counted["obs"] = expect(rows, expectations, label=f"expect_{load_id}")
        return checked

    def check() -> None:
        counted["metrics"] = enforce(counted["obs"], expectations)

    rows, bad, _ = publish(Table(spark, target), tag(read_spec(spark, spec), spec, ctx), load_id, "overwrite", ctx, gate=gate, shape=shape, check=check)
    return LoadResult(spec.key, target, rows, ctx.run_id, load_id, quarantined=bad, metrics=counted["metrics"])


# The names of loading techniques in source specs.
TECHNIQUES = ("copy_into", "full_refresh", "pyspark_read_write", "autoloader", "stream", "expectations", "delta_live_tables", "materialized_view")


def ingest(spark: SparkSession, registry: Registry, key: str, root: str, ctx: RunContext | None = None,
           gate: bool = True, required_columns: tuple[str, ...] = (), not_null_columns: tuple[str, ...] = (),
           expectations: list[Expectation] | None = None, log: EventLog | None = None) -> LoadResult:
    """Load source ``key`` with its technique into ``root/<target as folders>``: load, check, publish, comment, log.

    Techniques: ``copy_into``, ``full_refresh`` (alias ``pyspark_read_write``), ``autoloader`` (alias ``stream``: available-now
    stream), ``expectations`` (aliases ``delta_live_tables``, ``materialized_view``). All of them go through the same gate. The spec's description and
    column comments are kept with the table. With ``log``, what happened is recorded and written, also when the load fails.
    """
    from sluice.streaming.ingest import stream_ingest

    spec = registry.get(key)
    target = spec.target_path(root)
    technique = spec.technique or "copy_into"
    checks = Gate(tuple(required_columns), tuple(not_null_columns)) if gate else None
    ctx = ctx or RunContext()
    try:
        if technique in ("autoloader", "stream"):
            result = stream_ingest(spark, spec, target, ctx=ctx, gate=checks)
        elif technique in ("expectations", "delta_live_tables", "materialized_view"):
            result = refresh_with_expectations(spark, spec, target, expectations or [], ctx, checks)
        elif technique in ("full_refresh", "pyspark_read_write"):
            result = full_refresh(spark, spec, target, ctx, checks)
        elif technique == "copy_into":
            result = copy_into(spark, spec, target, ctx, checks)
        else:
            raise ValueError(f"unknown technique {technique!r} for {key!r}. Known: {sorted(TECHNIQUES)}")
        if spec.description or spec.column_comments:
            Table(spark, target).comment(spec.description, dict(spec.column_comments))
        if log is not None:
            log.info(technique, f"loaded {result.rows_loaded} rows")
            if result.quarantined:
                log.record(technique, "WARNING", f"set {result.quarantined} lines aside")
        return result
    except Exception as error:
        if log is not None:
            log.error(technique, f"{type(error).__name__}: {error}")
        raise
    finally:
        if log is not None:
            log.flush()
