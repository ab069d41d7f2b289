"""Registered queries over the driver tables, each with a DuckDB oracle.

Every query runs its operator for real on whole tables (writes files, streams
them, re-reads them) and returns the lazy result; the oracle is plain SQL over
the same parquet tables that states what the result must be.
"""
from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sluice.context import FIXED_CONTEXT, RunContext, basename, new_workdir, scan_partitions
from sluice.functions.dates import matched_pattern, parse_first
from sluice.operators.audit import AUDIT_COLUMNS, add_audit_columns
from sluice.operators.columns import sanitize_columns
from sluice.operators.datevote import vote_dates
from sluice.operators.dependencies import inclusion_dependencies
from sluice.operators.history import reconcile
from sluice.operators.movement import entity_stays, transitions
from sluice.operators.profile import entity_profile, profile_table, time_gaps
from sluice.operators.quality import (Expectation, check_result, expect, expectation_report,
                                      key_overlap, quarantine, row_counts, sanity_check, split_dates)
from sluice.operators.rank import global_rank, slice_shares
from sluice.plans.chunking import read_slices, run_chunking
from sluice.plans.clustering import files_met, write_clustered
from sluice.plans.eventlog import EventLog
from sluice.plans.merge import merge_into
from sluice.plans.load import (LoadRejected, copy_into, create_empty_like, full_refresh, ingest, quarantine_table,
                               refresh_with_expectations)
from sluice.plans.model import LAYOUTS, date_span, dim_date, facts_by_date, read_layout, write_layouts
from sluice.plans.promote import promote_rescued
from sluice.plans.scd2 import Scd2Table
from sluice.plans.tables import Table
from sluice.sources import formats
from sluice.sources.spec import Registry, SourceSpec
from sluice.streaming.ingest import stream_ingest
from sluice.streaming.upsert import stream_upsert

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


# ---------------------------------------------------------------- slicing ---

_ORDERS_RANK = """
SELECT *, count(*) OVER () AS n,
       row_number() OVER (ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST,
                          o_custkey ASC NULLS FIRST, o_orderstatus ASC NULLS FIRST,
                          o_totalprice ASC NULLS FIRST, o_orderpriority ASC NULLS FIRST) AS rn
FROM orders
"""


def chunk_orders(spark: SparkSession, sf_dir: str):
    out = new_workdir(spark, "chunks")
    return run_chunking(table(spark, sf_dir, "orders"), "o_orderdate", out, source_name="orders",
                        ctx=FIXED_CONTEXT)


@register("chronological_slices", f"""
WITH r AS ({_ORDERS_RANK})
SELECT CAST(CASE WHEN rn <= n*40//100 THEN 1 WHEN rn <= n*70//100 THEN 2
                 WHEN rn <= n*90//100 THEN 3 ELSE 4 END AS INTEGER) AS slice_id,
       count(*) AS n_rows, min(o_orderdate) AS first_date, max(o_orderdate) AS last_date,
       CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM r GROUP BY 1
""")
def chronological_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → 40/30/20/10 slices written as CSV, CSV, JSON, XML → read back → per-slice stats."""
    result = chunk_orders(spark, sf_dir)
    back = read_slices(spark, result)
    return back.groupBy("slice_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("o_orderdate").alias("first_date"),
        F.max("o_orderdate").alias("last_date"),
        F.sum("o_orderkey").alias("key_sum"),
    )


_LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                  "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LI_ORDER = ", ".join(["l_shipdate ASC NULLS FIRST"] + [f"{c} ASC NULLS FIRST" for c in _LINEITEM_COLS if c != "l_shipdate"])
_LI_RANK = f"SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY {_LI_ORDER}) AS rn FROM lineitem"
_SLICE_CASE = "CASE WHEN rn <= n*40//100 THEN 1 WHEN rn <= n*70//100 THEN 2 WHEN rn <= n*90//100 THEN 3 ELSE 4 END"


@register("slice_rows", f"""
WITH r AS ({_LI_RANK}), s AS (SELECT *, {_SLICE_CASE} AS sid FROM r)
SELECT {", ".join(_LINEITEM_COLS)}, CAST(sid AS INTEGER) AS slice_id,
       CASE sid WHEN 3 THEN 'json' WHEN 4 THEN 'xml' ELSE 'csv' END AS source_format,
       'lineitem[rows ' || CAST(CASE sid WHEN 1 THEN 1 WHEN 2 THEN n*40//100+1 WHEN 3 THEN n*70//100+1
                                        ELSE n*90//100+1 END AS VARCHAR)
       || '-' || CAST(CASE sid WHEN 1 THEN n*40//100 WHEN 2 THEN n*70//100 WHEN 3 THEN n*90//100
                           ELSE n END AS VARCHAR) || ']' AS source_file
FROM s
""")
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem sliced by ship date (ties inside every cut): every row with its slice and audit tags."""
    out = new_workdir(spark, "chunks")
    result = run_chunking(table(spark, sf_dir, "lineitem"), "l_shipdate", out, source_name="lineitem",
                          ctx=FIXED_CONTEXT)
    return read_slices(spark, result).select(*_LINEITEM_COLS, "slice_id", "source_format", "source_file")


@register("slice_shares", f"""
WITH r AS ({_ORDERS_RANK}), s AS (SELECT {_SLICE_CASE} AS sid FROM r)
SELECT CAST(sid AS INTEGER) AS slice_id, count(*) AS n_rows,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS pct_of_total,
       CAST(sum(count(*)) OVER () AS BIGINT) AS total_rows
FROM s GROUP BY sid
""")
def slice_shares_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of each written orders slice in the total, computed from the files read back."""
    return slice_shares(read_slices(spark, chunk_orders(spark, sf_dir)))


@register("global_rank", f"""
SELECT {", ".join(_LINEITEM_COLS)}, CAST(row_number() OVER (ORDER BY {_LI_ORDER}) AS BIGINT) AS rank FROM lineitem
""")
def global_rank_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact global row number of lineitem by ship date (every other column breaks ties)."""
    return global_rank(table(spark, sf_dir, "lineitem"), "l_shipdate").frame


# -------------------------------------------------------------- formats ---

_EVENTS = "event_id, ts, user_id, event_type, value, props"


def _roundtrip(spark: SparkSession, df: DataFrame, fmt: str, **options) -> DataFrame:
    path = f"{new_workdir(spark, 'roundtrip')}/data.{fmt}"
    formats.write(df, path, fmt, **options)
    return formats.read(spark, path, fmt, schema=df.schema, **options)


for _fmt in ("csv", "json", "xml"):
    def _make(fmt):
        def q(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _roundtrip(spark, table(spark, sf_dir, "events"), fmt)

        q.__doc__ = f"events written as {fmt} and read back with the explicit schema: every value intact."
        return q

    register(f"roundtrip_{_fmt}", f"SELECT {_EVENTS} FROM events")(_make(_fmt))


_DOCS = "doc_id, text, lang, source, n_chars"


@register("roundtrip_text_csv", f"SELECT {_DOCS} FROM documents")
def roundtrip_text_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents (multi-line text, quotes, markup) through CSV and back."""
    return _roundtrip(spark, table(spark, sf_dir, "documents"), "csv", quotedLines="true")


@register("roundtrip_text_xml", f"SELECT {_DOCS} FROM documents")
def roundtrip_text_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through XML and back (markup in text is escaped, blanks kept)."""
    return _roundtrip(spark, table(spark, sf_dir, "documents"), "xml")


# ---------------------------------------------------------------- audit ---

_FIXED_AUDIT = "TIMESTAMP '2024-01-01 00:00:00' AS load_dt, '{fmt}' AS source_format, '{file}' AS source_file, 'run-1' AS run_id"


def fixed_audit(fmt: str, file: str) -> str:
    return _FIXED_AUDIT.format(fmt=fmt, file=file)


@register("audit_columns", f"SELECT {_EVENTS}, {fixed_audit('parquet', 'events.parquet')} FROM events")
def audit_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events tagged with audit columns; ``source_file`` is each row's own file (scan metadata)."""
    return add_audit_columns(table(spark, sf_dir, "events"), "parquet", None, FIXED_CONTEXT)


@register("retag_audit", f"""
SELECT {_EVENTS}, 'events.parquet' AS upstream_source_file, {fixed_audit('csv', 'events_tagged.csv')} FROM events
""")
def retag_audit_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows tagged upstream (run-0) land as CSV; the load drops the old tags and appends fresh ones."""
    upstream = RunContext(run_id="run-0", load_dt=FIXED_CONTEXT.load_dt)
    tagged = add_audit_columns(table(spark, sf_dir, "events"), "parquet", "events.parquet", upstream)
    path = f"{new_workdir(spark, 'retag')}/events_tagged.csv"
    formats.write(tagged, path, "csv")
    landed = formats.read(spark, path, "csv", schema=tagged.schema)
    return add_audit_columns(landed, "csv", basename(path), FIXED_CONTEXT, keep_upstream_file=True)


_PART_AWKWARD = {"p_partkey": "part key", "p_name": "p-name", "p_brand": "p:brand", "p_type": "p--type::x",
                 "p_size": "p_size", "p_retailprice": "p size"}


@register("sanitize_columns", """
SELECT p_partkey AS part_key, p_name AS p_name, p_brand AS p_brand, p_type AS p__type__x, p_size AS p_size,
       p_retailprice AS p_size_2, p_brand AS attrs_x_brand_name, p_size AS attrs_x_size_n FROM part
""")
def sanitize_columns_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with names that are not Parquet-safe (one collides after cleaning, one struct is nested)."""
    part = table(spark, sf_dir, "part")
    awkward = part.select(*[F.col(k).alias(v) for k, v in _PART_AWKWARD.items()],
                          F.struct(F.col("p_brand").alias("brand-name"), F.col("p_size").alias("size:n")).alias("attrs:x"))
    path = f"{new_workdir(spark, 'sanitize')}/part"
    formats.write(sanitize_columns(awkward), path, "parquet")
    clean = spark.read.parquet(path)
    return clean.select(*[c for c in clean.columns if c != "attrs_x"],
                        F.col("attrs_x.brand_name").alias("attrs_x_brand_name"),
                        F.col("attrs_x.size_n").alias("attrs_x_size_n"))


# ---------------------------------------------------------------- loads ---

_NEW_ID = 1_000_000_000_000


def land(df: DataFrame, path: str, fmt: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Write ``df`` as ``files`` files, split by event id ranges (deterministic file contents).

    By default one file per input scan partition (at least 4), so the landing write stays as parallel
    as the scan at any size instead of funnelling the table through a fixed handful of tasks.
    """
    files = files or max(4, scan_partitions(df))
    formats.write(df.repartitionByRange(files, F.col(df.columns[0])), path, fmt, mode=mode)


#: What a micro-batch of the streams takes in at most.
STREAM_BYTES = 1 << 30


def events_spec(path: str, fmt: str, schema, key: str = "events", **kw) -> SourceSpec:
    return SourceSpec(key=key, path=path, format=fmt, schema=schema, **kw)


def later_batch(events: DataFrame) -> DataFrame:
    """A new day's file derived from events: fresh ids, values shifted."""
    return events.select((F.col("event_id") + F.lit(_NEW_ID)).alias("event_id"), "ts", "user_id", "event_type",
                         (F.col("value") + F.lit(1.0)).alias("value"), "props")


def _landed_events(spark: SparkSession, sf_dir: str, fmt: str, name: str):
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "landing")
    path = f"{work}/incoming/{name}"
    land(events, path, fmt)
    return events, work, events_spec(path, fmt, events.schema)


@register("create_empty_like", f"SELECT {_EVENTS}, {fixed_audit('csv', 'events_landing.csv')} FROM events WHERE 1 = 0")
def create_empty_like_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zero-row target with exactly the load's schema (audit included); the second call is a no-op."""
    work = new_workdir(spark, "landing")
    spec = events_spec(f"{work}/incoming/events_landing.csv", "csv", table(spark, sf_dir, "events").schema)
    target = f"{work}/bronze/events"
    create_empty_like(spark, spec, target, FIXED_CONTEXT)
    create_empty_like(spark, spec, target, FIXED_CONTEXT)
    return Table(spark, target).read()


_COPY_ONCE = f"SELECT {_EVENTS}, {fixed_audit('csv', 'events_landing.csv')} FROM events"


@register("copy_into_once", _COPY_ONCE)
def copy_into_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk load of a folder of CSV files into an audited table."""
    _, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    return Table(spark, target).read()


@register("copy_into_rerun", _COPY_ONCE)
def copy_into_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same load run twice: the second finds no new file and adds nothing."""
    _, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    second = copy_into(spark, spec, target, RunContext("run-2", FIXED_CONTEXT.load_dt))
    assert second.rows_loaded == 0, second
    return Table(spark, target).read()


@register("copy_into_new_file", f"""
SELECT {_EVENTS}, {fixed_audit('csv', 'events_landing.csv')} FROM events
UNION ALL
SELECT event_id + {_NEW_ID} AS event_id, ts, user_id, event_type, value + 1.0 AS value, props,
       TIMESTAMP '2024-01-01 00:00:00' AS load_dt, 'csv' AS source_format, 'events_landing.csv' AS source_file,
       'run-2' AS run_id
FROM events
""")
def copy_into_new_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, then new files arrive in the same folder: only the new files are loaded (run-2)."""
    events, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    land(later_batch(events), spec.path, "csv", mode="append")
    copy_into(spark, spec, target, RunContext("run-2", FIXED_CONTEXT.load_dt))
    copy_into(spark, spec, target, RunContext("run-3", FIXED_CONTEXT.load_dt))
    return Table(spark, target).read()


_STREAMED = f"SELECT {_EVENTS}, {fixed_audit('json', 'events_landing.json')} FROM events"


@register("stream_ingest", _STREAMED)
def stream_ingest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files drained by an available-now stream in micro-batches of bounded size."""
    _, work, spec = _landed_events(spark, sf_dir, "json", "events_landing.json")
    target = f"{work}/bronze/events_stream"
    stream_ingest(spark, spec, target, FIXED_CONTEXT, max_bytes=STREAM_BYTES)
    return Table(spark, target).read()


@register("stream_ingest_rerun", _STREAMED)
def stream_ingest_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream re-run on the same checkpoint: nothing new, nothing added."""
    _, work, spec = _landed_events(spark, sf_dir, "json", "events_landing.json")
    target = f"{work}/bronze/events_stream"
    stream_ingest(spark, spec, target, FIXED_CONTEXT)
    again = stream_ingest(spark, spec, target, FIXED_CONTEXT)
    assert again.rows_loaded == 0, again
    return Table(spark, target).read()


@register("stream_schema_evolution", f"""
SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props, {fixed_audit('json', 'events_landing.json')} FROM events
UNION ALL
SELECT event_id + {_NEW_ID} AS event_id, ts, user_id, event_type, value + 1.0 AS value, props,
       {fixed_audit('json', 'events_landing.json')} FROM events
""")
def stream_schema_evolution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later delivery to the streamed folder has a column more: the table widens, older rows read it as NULL."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "landing")
    path, target = f"{work}/incoming/events_landing.json", f"{work}/bronze/events_stream"
    spec = events_spec(path, "json", events.drop("props").schema)
    land(events.drop("props"), path, "json")
    stream_ingest(spark, spec, target, FIXED_CONTEXT, max_bytes=STREAM_BYTES)
    land(later_batch(events), path, "json", mode="append")
    stream_ingest(spark, spec, target, FIXED_CONTEXT, max_bytes=STREAM_BYTES)
    return Table(spark, target).read().select(*events.columns, *AUDIT_COLUMNS)


@register("load_bad_records", """
SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'click' THEN 'unknown fields: extra' ELSE 'loaded' END AS outcome,
       count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY 1
""")
def load_bad_records_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a text for a number, or a field that the schema lacks, are set aside with their reason; the rest loads."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "landing")
    user = F.when(F.col("event_type") == "error", F.concat(F.lit("user "), F.col("user_id"))).otherwise(F.col("user_id").cast("string"))
    plain = F.to_json(F.struct("event_id", "ts", "event_type", "value", "props"), formats.JSON_OPTIONS)
    field = F.when(F.col("event_type") == "error", F.concat(F.lit('"user_id":"'), user, F.lit('"'))).otherwise(F.concat(F.lit('"user_id":'), user))
    extra = F.when(F.col("event_type") == "click", F.lit(',"extra":1')).otherwise(F.lit(""))
    line = F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(","), field, extra, F.lit("}"))
    events.withColumn("line", plain).select(line.alias("value")).write.text(f"{work}/incoming/events.json")
    spec = SourceSpec(key="events", path=f"{work}/incoming/events.json", format="json", schema=events.schema)
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    aside = quarantine_table(spark, target).read().select(F.col("reason").alias("outcome"), F.get_json_object("raw", "$.event_id").cast("long").alias("event_id"))
    loaded = Table(spark, target).read().select(F.lit("loaded").alias("outcome"), "event_id")
    return loaded.unionByName(aside).groupBy("outcome").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))


@register("rescue_and_promote", f"""
SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, event_type,
  CASE WHEN event_type = 'view' THEN value + 0.5 ELSE floor(value) END AS value, props,
  CASE WHEN event_type = 'click' THEN event_id % 7 END AS extra, CASE WHEN event_type = 'click' THEN 'n' || CAST(user_id AS VARCHAR) END AS nested_name,
  CASE WHEN event_type = 'error' THEN '{{"user_id":"user ' || CAST(user_id AS VARCHAR) || '"}}' END AS _rescued,
  {fixed_audit('json', 'events.json')} FROM events
""")
def rescue_and_promote_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with a text for a number, halves for whole numbers, and fields that the schema lacks: every row loads, what doesn't fit is
    rescued, and the second phase makes typed columns of it. A text for a number stays rescued."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "landing")
    kind = F.col("event_type")
    user = F.when(kind == "error", F.concat(F.lit('"user '), F.col("user_id"), F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    value = F.when(kind == "view", F.to_json(F.struct((F.col("value") + 0.5).alias("value")))).otherwise(
        F.to_json(F.struct(F.floor("value").alias("value"))))
    extra = F.when(kind == "click", F.concat(F.lit(',"extra":'), (F.col("event_id") % 7).cast("string"), F.lit(',"nested":{"name":"n'), F.col("user_id"), F.lit('"}'))).otherwise(F.lit(""))
    line = F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit(',"user_id":'), user, F.lit(","), F.expr("substring(value_json, 2, length(value_json) - 2)"), extra, F.lit("}"))
    plain = F.to_json(F.struct("event_id", "ts", "event_type", "props"), formats.JSON_OPTIONS)
    events.withColumns({"line": plain, "value_json": value}).select(line.alias("value")).write.text(f"{work}/incoming/events.json")
    narrow = StructType([StructField("value", LongType()) if f.name == "value" else f for f in events.schema.fields])
    spec = SourceSpec(key="events", path=f"{work}/incoming/events.json", format="json", schema=narrow, rescue="_rescued")
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    promote_rescued(spark, target, ctx=FIXED_CONTEXT)
    got = Table(spark, target).read().withColumn("value", F.col("value").cast("double"))  # whole numbers and halves: a decimal
    return got.select(*events.columns, "extra", F.col("nested.name").alias("nested_name"), "_rescued", *AUDIT_COLUMNS)


@register("csv_header_evolution", """
WITH e AS (SELECT event_id, user_id, event_type, value FROM events)
SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS note, 1 AS delivery FROM e
UNION ALL SELECT event_id, user_id, event_type, value, event_type || '!', 2 FROM e
UNION ALL SELECT event_id, NULL, event_type, CAST(event_id AS DOUBLE), NULL, 3 FROM e
UNION ALL SELECT event_id, user_id, event_type, CAST(event_id AS DOUBLE) + 0.25, 'late', 4 FROM e
""")
def csv_header_evolution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV deliveries to one folder: as first agreed; a column more and another order; a column fewer with whole numbers; all of it once more in a later load.
    Columns go by their names and types widen to hold every delivery; a file of another kind is set aside and holds nothing up."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    work = new_workdir(spark, "landing")
    path, target = f"{work}/incoming/events.csv", f"{work}/bronze/events"
    spec = SourceSpec(key="events", path=path, format="csv")  # no schema: each header's types are looked for
    formats.write(events.withColumn("delivery", F.lit(1)), path, "csv")
    formats.write(events.select(F.concat("event_type", F.lit("!")).alias("note"), "value", "event_type", F.lit(2).alias("delivery"), "user_id", "event_id"), path, "csv", mode="append")
    copy_into(spark, spec, target, FIXED_CONTEXT)
    formats.write(events.select("event_id", F.lit(3).alias("delivery"), "event_type", F.col("event_id").alias("value")), path, "csv", mode="append")
    copy_into(spark, spec, target, FIXED_CONTEXT)
    whole = Table(spark, target).schema()
    formats.write(events.select(F.lit("late").alias("note"), F.lit(4).alias("delivery"), (F.col("event_id") + 0.25).alias("value"), "event_type", "event_id", "user_id"), path, "csv", mode="append")
    formats.write(table(spark, sf_dir, "region"), path, "csv", mode="append")
    known = StructType([f for f in whole.fields if f.name not in AUDIT_COLUMNS])
    copy_into(spark, replace(spec, schema=known), target, FIXED_CONTEXT)
    aside = quarantine_table(spark, target).read().filter("reason LIKE 'file refused%'").count()
    if aside != 1:
        raise AssertionError(f"{aside} files set aside")
    kinds = {"event_id": "long", "user_id": "long", "value": "double", "delivery": "int"}
    got = Table(spark, target).read()
    return got.select(*[F.col(c).cast(kinds.get(c, "string")).alias(c) for c in ("event_id", "user_id", "event_type", "value", "note", "delivery")])


@register("full_refresh", f"SELECT {_EVENTS}, {fixed_audit('xml', 'events_landing.xml')} FROM events")
def full_refresh_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML with a tag name that is not Parquet-safe, refreshed twice: the table holds one copy."""
    events = table(spark, sf_dir, "events")
    awkward = events.withColumnRenamed("event_type", "event-type")
    work = new_workdir(spark, "landing")
    spec = events_spec(f"{work}/incoming/events_landing.xml", "xml", awkward.schema)
    land(awkward, spec.path, "xml")
    target = f"{work}/bronze/events_xml"
    full_refresh(spark, spec, target, FIXED_CONTEXT)
    full_refresh(spark, spec, target, FIXED_CONTEXT)
    return Table(spark, target).read()


_NULLED = "event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props"


def nulled_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with the ``error`` type blanked out to NULL (the test tables hold no nulls)."""
    e = table(spark, sf_dir, "events")
    return e.withColumn("event_type", F.nullif(F.col("event_type"), F.lit("error")))


# The expectation rules of the declarative refresh.
EVENT_RULES = [
    Expectation("non_null_type", "event_type IS NOT NULL"),
    Expectation("value_over_5", "value > 5"),
    Expectation("not_a_view", "event_type <> 'view'"),
]


@register("refresh_with_expectations", f"SELECT {_NULLED}, {fixed_audit('csv', 'events_nulled.csv')} FROM events")
def refresh_with_expectations_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole recompute with warn-policy expectations: all rows kept, violations counted on the write."""
    src = nulled_events(spark, sf_dir)
    work = new_workdir(spark, "landing")
    spec = events_spec(f"{work}/incoming/events_nulled.csv", "csv", src.schema)
    land(src, spec.path, "csv")
    target = f"{work}/bronze/events_checked"
    result = refresh_with_expectations(spark, spec, target, EVENT_RULES, FIXED_CONTEXT)
    assert set(result.metrics) >= {r.name for r in EVENT_RULES}, result.metrics
    return Table(spark, target).read()


@register("schema_evolution", f"""
SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props,
       {fixed_audit('csv', 'events_v1.csv')} FROM events
UNION ALL
SELECT event_id + {_NEW_ID} AS event_id, ts, user_id, event_type, value + 1.0 AS value, props,
       {fixed_audit('csv', 'events_v2.csv')} FROM events
""")
def schema_evolution_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second source adds a column: the table widens, older rows read it as NULL."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "landing")
    v1 = events.drop("props")
    v2 = later_batch(events)
    s1 = events_spec(f"{work}/incoming/events_v1.csv", "csv", v1.schema)
    s2 = events_spec(f"{work}/incoming/events_v2.csv", "csv", v2.schema)
    land(v1, s1.path, "csv")
    land(v2, s2.path, "csv")
    target = f"{work}/bronze/events_evolving"
    copy_into(spark, s1, target, FIXED_CONTEXT)
    copy_into(spark, s2, target, FIXED_CONTEXT)
    return Table(spark, target).read().select(*events.columns, *AUDIT_COLUMNS)


def events_registry(path: str, schema) -> Registry:
    return Registry({
        "raw_events": {"path": path, "format": "csv", "schema": schema, "description": "Clickstream events"},
        "bronze_events": {"source_key": "raw_events", "technique": "copy_into", "target": "bronze.events"},
    })


@register("ingest_by_key", _COPY_ONCE)
def ingest_by_key_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A child registry entry inherits path/format from its base and picks the loader by technique."""
    events, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    reg = events_registry(spec.path, events.schema)
    result = ingest(spark, reg, "bronze_events", f"{work}/lake", FIXED_CONTEXT)
    return Table(spark, result.target).read()


@register("ingest_gate", _COPY_ONCE)
def ingest_gate_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery with no user ids fails the staged check and never becomes visible."""
    events, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    reg = events_registry(spec.path, events.schema)
    root = f"{work}/lake"
    first = ingest(spark, reg, "bronze_events", root, FIXED_CONTEXT, not_null_columns=("user_id",))
    broken = later_batch(events).withColumn("user_id", F.lit(None).cast("long"))
    land(broken, spec.path, "csv", mode="append")
    try:
        ingest(spark, reg, "bronze_events", root, RunContext("run-2", FIXED_CONTEXT.load_dt),
               not_null_columns=("user_id",))
        raise AssertionError("broken delivery was published")
    except LoadRejected:
        pass
    return Table(spark, first.target).read()


@register("ingest_gate_stream", f"""
SELECT {_EVENTS}, {fixed_audit('json', 'events_landing.json')} FROM events
UNION ALL
SELECT event_id + {2 * _NEW_ID} AS event_id, ts, user_id, event_type, value, props, {fixed_audit('json', 'events_landing.json').replace("'run-1'", "'run-3'")} FROM events
""")
def ingest_gate_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate on a stream: a delivery without user ids is set aside, the good one after it is loaded."""
    events, work, spec = _landed_events(spark, sf_dir, "json", "events_landing.json")
    reg = Registry({"raw": {"path": spec.path, "format": "json", "schema": events.schema},
                    "bronze_events": {"source_key": "raw", "technique": "autoloader", "target": "bronze.events"}})
    run = lambda ctx: ingest(spark, reg, "bronze_events", f"{work}/lake", ctx, not_null_columns=("user_id",))
    first = run(FIXED_CONTEXT)
    land(later_batch(events).withColumn("user_id", F.lit(None).cast("long")), spec.path, "json", mode="append")
    try:
        run(RunContext("run-2", FIXED_CONTEXT.load_dt))
        raise AssertionError("broken delivery was published")
    except LoadRejected:
        pass
    land(events.withColumn("event_id", F.col("event_id") + F.lit(2 * _NEW_ID)), spec.path, "json", mode="append")
    run(RunContext("run-3", FIXED_CONTEXT.load_dt))
    return Table(spark, first.target).read()


# -------------------------------------------------------------- quality ---

_ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
               "benchmark labels conversations").split()


@register("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL_TABLES))
def row_counts_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of every driver table in one job."""
    return row_counts({t: table(spark, sf_dir, t) for t in _ALL_TABLES})


def _bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    target = f"{work}/bronze/events"
    copy_into(spark, spec, target, FIXED_CONTEXT)
    return Table(spark, target).read()


def _check_output(df: DataFrame) -> DataFrame:
    return df.select(F.col("table").alias("table_name"), "row_count", "passed",
                     F.array_join("failures", "; ").alias("failures"))


@register("sanity_check", """
SELECT 'bronze.events' AS table_name, count(*) AS row_count, true AS passed, '' AS failures FROM events
""")
def sanity_check_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded table: rows present, every audit column populated — one aggregation."""
    return _check_output(sanity_check(_bronze_events(spark, sf_dir), "bronze.events"))


@register("sanity_check_failing", """
SELECT 'bronze.events_broken' AS table_name, count(*) AS row_count, false AS passed,
       'source_file has ' || CAST(count(*) FILTER (WHERE event_type = 'error') AS VARCHAR) || ' null values out of '
       || CAST(count(*) AS VARCHAR) || '; missing required column ingest_date' AS failures
FROM events
""")
def sanity_check_failing_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit column blanked for error events and a required column missing: both reported."""
    bronze = _bronze_events(spark, sf_dir)
    broken = bronze.withColumn("source_file", F.when(F.col("event_type") != "error", F.col("source_file")))
    return _check_output(sanity_check(broken, "bronze.events_broken", required_columns=("ingest_date",)))


def _rule_sql(rule: str) -> str:
    return rule.replace("'", "''")


@register("expectations_report", "\nUNION ALL\n".join(
    f"SELECT '{e.name}' AS expectation, '{e.policy}' AS policy, '{_rule_sql(e.rule)}' AS rule, "
    f"count(*) FILTER (WHERE NOT coalesce({e.rule}, false)) AS violations, count(*) AS total_rows "
    f"FROM (SELECT {_NULLED} FROM events)" for e in EVENT_RULES))
def expectations_report_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations per rule in one pass; a rule that evaluates to NULL counts as violated."""
    return expectation_report(nulled_events(spark, sf_dir), EVENT_RULES)


_DROP_RULES = [Expectation(e.name, e.rule, "drop") for e in EVENT_RULES[:2]]


@register("expectations_drop", f"""
SELECT * FROM (SELECT {_NULLED} FROM events)
WHERE {" AND ".join(f"coalesce({e.rule}, false)" for e in _DROP_RULES)}
""")
def expectations_drop_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop policy: rows breaking a rule are removed after being counted."""
    kept, _ = expect(nulled_events(spark, sf_dir), _DROP_RULES)
    return kept


# Rejection rules for customers.
CUSTOMER_RULES = {
    "negative_balance": "c_acctbal < 0",
    "thin_machinery": "c_mktsegment = 'MACHINERY' AND c_acctbal < 1000",
}
_CUST = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@register("quarantine_valid", f"""
SELECT {_CUST} FROM customer WHERE NOT ({" OR ".join(f"coalesce({r}, false)" for r in CUSTOMER_RULES.values())})
""")
def quarantine_valid_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers passing every rule."""
    valid, _ = quarantine(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return valid


@register("quarantine_rejected", f"""
SELECT {_CUST}, concat_ws(',', {", ".join(f"CASE WHEN {r} THEN '{n}' END" for n, r in CUSTOMER_RULES.items())}) AS reasons
FROM customer WHERE {" OR ".join(f"coalesce({r}, false)" for r in CUSTOMER_RULES.values())}
""")
def quarantine_rejected_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers breaking a rule, with every reason — kept, not corrected."""
    _, rejected = quarantine(table(spark, sf_dir, "customer"), CUSTOMER_RULES)
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


# Fixed values: (relation, child table, child key, parent table, parent key).
RELATIONS = [
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("customer.c_nationkey->nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    ("labels.doc_id->documents", "labels", "doc_id", "documents", "doc_id"),
]


@register("key_overlap", "\nUNION ALL\n".join(f"""
SELECT '{rel}' AS relation, count(*) AS child_keys,
       count(*) FILTER (WHERE k IN (SELECT {pk} FROM {pt})) AS matched_keys,
       count(*) FILTER (WHERE k NOT IN (SELECT {pk} FROM {pt} WHERE {pk} IS NOT NULL)) AS orphan_keys,
       CASE WHEN count(*) = 0 THEN 0.0
            ELSE round(100.0 * count(*) FILTER (WHERE k IN (SELECT {pk} FROM {pt})) / count(*), 2) END AS pct_matched
FROM (SELECT DISTINCT {ck} AS k FROM {ct} WHERE {ck} IS NOT NULL)""" for rel, ct, ck, pt, pk in RELATIONS))
def key_overlap_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Referential coverage of distinct child keys for every foreign key of the star schema."""
    parts = [key_overlap(table(spark, sf_dir, ct), ck, table(spark, sf_dir, pt), pk, rel)
             for rel, ct, ck, pt, pk in RELATIONS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# The date patterns a report may use, tried in this order.
DATE_PATTERNS = ["yyyy-MM-dd", "dd/MM/yyyy", "MMM d, yyyy"]


def render_dates(orders: DataFrame) -> DataFrame:
    """Order dates written as free text the way reports arrive: three layouts and junk."""
    k = F.col("o_orderkey") % 4
    d = F.col("o_orderdate")
    text = (F.when(k == 0, F.date_format(d, DATE_PATTERNS[0])).when(k == 1, F.date_format(d, DATE_PATTERNS[1]))
            .when(k == 2, F.date_format(d, DATE_PATTERNS[2]))
            .otherwise(F.concat(F.lit("unknown-"), F.col("o_orderkey").cast("string"))))
    return orders.select("o_orderkey", text.alias("date_text"))


@register("normalize_dates", """
SELECT o_orderkey,
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN 2 THEN strftime(o_orderdate, '%b %-d, %Y') ELSE 'unknown-' || CAST(o_orderkey AS VARCHAR) END AS date_text,
       CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE o_orderdate END AS parsed_date,
       CAST(CASE o_orderkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END AS INTEGER) AS pattern_no
FROM orders
""")
def normalize_dates_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text dates parsed by the first pattern that fits; junk becomes NULL with pattern 0, never a guess."""
    text = render_dates(table(spark, sf_dir, "orders"))
    return text.select("o_orderkey", "date_text", parse_first(F.col("date_text"), DATE_PATTERNS).alias("parsed_date"),
                       F.coalesce(matched_pattern(F.col("date_text"), DATE_PATTERNS), F.lit(0)).alias("pattern_no"))


@register("normalize_dates_rejected", """
SELECT o_orderkey, 'unknown-' || CAST(o_orderkey AS VARCHAR) AS date_text, 'unparsed_date_text' AS reasons FROM orders WHERE o_orderkey % 4 = 3
""")
def normalize_dates_rejected_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows whose date text no pattern fits, with the reason: quarantined, not turned into NULL dates."""
    _, rejected = split_dates(render_dates(table(spark, sf_dir, "orders")), "date_text", DATE_PATTERNS)
    return rejected.withColumn("reasons", F.array_join("reasons", ","))


# The date patterns of reports whose day and month may stand either way.
VOTE_PATTERNS = ["yyyy-MM-dd", "dd/MM/yyyy", "MM/dd/yyyy"]


def render_reports(orders: DataFrame) -> DataFrame:
    """Order dates as five sources write them: day first, month first, both mixed, day first beside ISO, and so that nothing tells."""
    d = F.col("o_orderdate")
    iso, day_first, month_first = (F.date_format(d, p) for p in VOTE_PATTERNS)
    src = F.substring("o_orderpriority", 1, 1)
    even = F.col("o_orderkey") % 2 == 0
    text = (F.when(src == "1", day_first).when(src == "2", month_first).when(src == "3", F.when(even, day_first).otherwise(month_first))
            .when(src == "4", F.when(even, iso).otherwise(day_first))
            .otherwise(F.when(F.dayofmonth(d) <= 12, day_first).otherwise(F.concat(F.lit("day "), iso))))
    return orders.select("o_orderkey", F.col("o_orderpriority").alias("report"), text.alias("date_text"))


@register("date_votes", """
WITH t AS (SELECT o_orderkey, o_orderpriority AS report, CASE substr(o_orderpriority, 1, 1)
    WHEN '1' THEN strftime(o_orderdate, '%d/%m/%Y') WHEN '2' THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN '3' THEN CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END
    WHEN '4' THEN CASE WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END
    ELSE CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE 'day ' || strftime(o_orderdate, '%Y-%m-%d') END END AS date_text FROM orders),
r AS (SELECT *, try_strptime(date_text, '%Y-%m-%d') AS i, try_strptime(date_text, '%d/%m/%Y') AS d, try_strptime(date_text, '%m/%d/%Y') AS m FROM t),
v AS (SELECT report, bool_or(d <> m) AS rivals, bool_or(d IS NOT NULL AND m IS NULL) AS d_more, bool_or(m IS NOT NULL AND d IS NULL) AS m_more FROM r GROUP BY report),
c AS (SELECT r.*, CASE WHEN rivals AND m_more AND NOT d_more THEN NULL ELSE d END AS dd, CASE WHEN rivals AND d_more AND NOT m_more THEN NULL ELSE m END AS mm
  FROM r JOIN v ON r.report IS NOT DISTINCT FROM v.report)
SELECT o_orderkey, report, date_text, CASE WHEN dd <> mm THEN NULL ELSE coalesce(i, dd, mm) END AS parsed_date,
  CASE WHEN dd <> mm THEN 'ambiguous_date_text' WHEN coalesce(i, dd, mm) IS NULL THEN 'unparsed_date_text' ELSE '' END AS reason FROM c
""")
def date_votes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports whose layout each source's own dates settle; what stays open is set aside with its reason, not guessed."""
    valid, rejected = vote_dates(render_reports(table(spark, sf_dir, "orders")), "report", "date_text", VOTE_PATTERNS)
    return valid.withColumn("reason", F.lit("")).unionByName(
        rejected.withColumn("parsed_date", F.lit(None).cast("timestamp_ntz")).withColumn("reason", F.array_join("reasons", ",")).drop("reasons"))


# -------------------------------------------------------------- history ---

def _events_with(ts_shift: str, value: str) -> str:
    return f"event_id, ts{ts_shift} AS ts, user_id, event_type, {value} AS value, props"


@register("reconcile_sources", """
SELECT event_id, ts, user_id, event_type,
       CASE WHEN event_type = 'click' THEN value + 1.0 ELSE value END AS value, props FROM events
""")
def reconcile_sources_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four slices (CSV, CSV, JSON, XML) plus a later correction file, merged back into one table."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "reconcile")
    result = run_chunking(events, "ts", f"{work}/chunks", source_name="events", ctx=FIXED_CONTEXT)
    slices = [formats.read(spark, p, result.formats[k], schema=result.schema) for k, p in result.paths.items()]
    fix_ctx = RunContext("run-2", datetime.datetime(2024, 1, 2))
    fixes = add_audit_columns(events.filter(F.col("event_type") == "click")
                              .withColumn("value", F.col("value") + F.lit(1.0)), "json", "fixes.json", fix_ctx)
    formats.write(fixes, f"{work}/fixes.json", "json")
    fixes_back = formats.read(spark, f"{work}/fixes.json", "json", schema=result.schema)
    merged = reconcile(slices + [fixes_back], result.schema, ["event_id"], ["load_dt"])
    return merged.select(*events.columns)


def _upsert_batches(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Views corrected an hour later (newer: win); clicks re-sent a day late (older: ignored)."""
    newer = events.filter(F.col("event_type") == "view").select(
        "event_id", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("ts"), "user_id", "event_type",
        (F.col("value") * F.lit(10.0)).alias("value"), "props")
    late = events.filter(F.col("event_type") == "click").select(
        "event_id", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("ts"), "user_id", "event_type",
        F.lit(-1.0).alias("value"), "props")
    return newer, late


_UPSERTED = """
SELECT event_id, CASE WHEN event_type = 'view' THEN ts + INTERVAL 1 HOUR ELSE ts END AS ts, user_id, event_type,
       CASE event_type WHEN 'view' THEN value * 10.0 WHEN 'error' THEN -value ELSE value END AS value, props,
       CASE WHEN event_type = 'error' THEN 'corrected' END AS note FROM events
"""


def _corrections(events: DataFrame) -> DataFrame:
    """Errors corrected under their own event time, with a column more."""
    return events.filter(F.col("event_type") == "error").withColumn("value", -F.col("value")).withColumn("note", F.lit("corrected"))


@register("upsert_latest", _UPSERTED)
def upsert_latest_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads merged by (event time, load time): newer wins, late older rows do not, a later correction of equal time does."""
    events = table(spark, sf_dir, "events")
    tbl = Table(spark, f"{new_workdir(spark, 'upsert')}/silver_events")
    for i, batch in enumerate([events, *_upsert_batches(events), _corrections(events)], start=1):
        ctx = RunContext(f"run-{i}", datetime.datetime(2024, 1, i))
        merge_into(tbl, add_audit_columns(batch, "parquet", "events", ctx), ["event_id"], ["ts", "load_dt"], f"v{i}", ctx.run_id)
    return tbl.read().select(*events.columns, "note")


@register("stream_upsert", _UPSERTED)
def stream_upsert_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge driven by a stream: base, newer and late files in one drain, the corrections in the next."""
    events = table(spark, sf_dir, "events")
    work = new_workdir(spark, "stream-upsert")
    folder, target = f"{work}/incoming/events_cdc", f"{work}/silver/events"
    spec = SourceSpec(key="events_cdc", path=folder, format="json", schema=events.schema)
    newer, late = _upsert_batches(events)
    for batch in (events, newer, late):
        formats.write(batch, folder, "json", mode="append")
    stream_upsert(spark, spec, target, ["event_id"], ["ts"], FIXED_CONTEXT, max_bytes=STREAM_BYTES)
    formats.write(_corrections(events), folder, "json", mode="append")
    stream_upsert(spark, spec, target, ["event_id"], ["ts"], RunContext("run-2", datetime.datetime(2024, 1, 2)), max_bytes=STREAM_BYTES)
    return Table(spark, target).read().select(*events.columns, "note")


_SUPP_SNAPSHOTS = """
s1 AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, TIMESTAMP '2024-01-01' AS snap FROM supplier),
s2 AS (SELECT s_suppkey, s_name, s_nationkey,
              CASE WHEN s_suppkey % 5 = 1 THEN round(s_acctbal + 100, 2) ELSE s_acctbal END AS s_acctbal,
              TIMESTAMP '2024-02-01' AS snap FROM supplier),
s3 AS (SELECT s_suppkey, s_name, s_nationkey,
              CASE WHEN s_suppkey % 5 = 1 THEN round(s_acctbal + 100, 2)
                   WHEN s_suppkey % 5 = 2 THEN round(s_acctbal - 50, 2) ELSE s_acctbal END AS s_acctbal,
              TIMESTAMP '2024-03-01' AS snap FROM supplier WHERE s_suppkey % 7 <> 3
       UNION ALL
       SELECT s_suppkey + 100000, s_name, s_nationkey, s_acctbal, TIMESTAMP '2024-03-01' FROM supplier
       WHERE s_suppkey % 10 = 0)
"""


@register("scd2_history", f"""
WITH {_SUPP_SNAPSHOTS},
a AS (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3),
c AS (SELECT *, lag(s_acctbal) OVER w AS pb, lag(s_name) OVER w AS pn, lag(s_nationkey) OVER w AS pk,
             row_number() OVER w AS k FROM a WINDOW w AS (PARTITION BY s_suppkey ORDER BY snap)),
v AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, snap AS valid_from FROM c
      WHERE k = 1 OR pb IS DISTINCT FROM s_acctbal OR pn IS DISTINCT FROM s_name OR pk IS DISTINCT FROM s_nationkey)
SELECT *, lead(valid_from) OVER (PARTITION BY s_suppkey ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY s_suppkey ORDER BY valid_from) IS NULL AS is_current
FROM v
""")
def scd2_history_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three supplier snapshots → type-2 history (changes close and reopen, absent keys stay open)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    k = F.col("s_suppkey") % 5
    s2 = s.withColumn("s_acctbal", F.when(k == 1, F.round(F.col("s_acctbal") + 100, 2)).otherwise(F.col("s_acctbal")))
    s3 = (s2.withColumn("s_acctbal", F.when(k == 2, F.round(F.col("s_acctbal") - 50, 2)).otherwise(F.col("s_acctbal")))
          .filter(F.col("s_suppkey") % 7 != 3)
          .unionByName(s.filter(F.col("s_suppkey") % 10 == 0)
                       .withColumn("s_suppkey", F.col("s_suppkey") + F.lit(100000))))
    dim = Scd2Table(spark, f"{new_workdir(spark, 'scd2')}/dim_supplier", ["s_suppkey"], ["s_name", "s_nationkey", "s_acctbal"])
    for i, (snap, month) in enumerate([(s, 1), (s2, 2), (s3, 3)], start=1):
        dim.apply(snap, datetime.datetime(2024, month, 1), f"v{i}")
    return dim.read()


@register("scd2_out_of_order", """
WITH s AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier),
a AS (SELECT *, CAST(NULL AS VARCHAR) AS grade, 1 AS m FROM s
  UNION ALL SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_suppkey % 3 = 1 THEN round(s_acctbal + 100, 2) ELSE s_acctbal END, NULL, 2 FROM s
  UNION ALL SELECT *, NULL, 3 FROM s WHERE s_suppkey % 4 <> 1
  UNION ALL SELECT *, CASE WHEN s_acctbal < 0 THEN 'low' END, 4 FROM s WHERE s_suppkey % 5 <> 0
  UNION ALL SELECT *, CASE WHEN s_acctbal < 0 THEN 'low' END, 5 FROM s),
t AS (SELECT * EXCLUDE m, make_timestamp(2024, m, 1, 0, 0, 0.0) AS snap FROM a),
c AS (SELECT *, lag(s_acctbal) OVER w AS pb, lag(grade) OVER w AS pg, row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY s_suppkey ORDER BY snap)),
v AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, grade, snap AS valid_from FROM c WHERE k = 1 OR pb IS DISTINCT FROM s_acctbal OR pg IS DISTINCT FROM grade)
SELECT *, lead(valid_from) OVER (PARTITION BY s_suppkey ORDER BY valid_from) AS valid_to,
       lead(valid_from) OVER (PARTITION BY s_suppkey ORDER BY valid_from) IS NULL AS is_current
FROM v
""")
def scd2_out_of_order_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five monthly supplier snapshots that come as March, May, January, April, February; April and May bring an attribute more, some lack suppliers."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    graded = s.withColumn("grade", F.when(F.col("s_acctbal") < 0, F.lit("low")))
    raised = F.when(F.col("s_suppkey") % 3 == 1, F.round(F.col("s_acctbal") + 100, 2)).otherwise(F.col("s_acctbal"))
    months = {1: s, 2: s.withColumn("s_acctbal", raised), 3: s.filter(F.col("s_suppkey") % 4 != 1), 4: graded.filter(F.col("s_suppkey") % 5 != 0), 5: graded}
    dim = Scd2Table(spark, f"{new_workdir(spark, 'scd2')}/dim_supplier", ["s_suppkey"], ["s_name", "s_nationkey", "s_acctbal", "grade"])
    for m in (3, 5, 1, 4, 2):
        dim.apply(months[m], datetime.datetime(2024, m, 1), f"m{m}")
    return dim.read()


# ---------------------------------------------------------------- model ---

_SPAN = """span AS (SELECT min(d) AS lo, max(d) AS hi FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders
                      UNION ALL SELECT CAST(l_shipdate AS DATE) FROM lineitem)),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM span)"""
_DAY_KEY = "CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER)"


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return dim_date(date_span([(orders, "o_orderdate"), (lineitem, "l_shipdate")]))


@register("dim_date", f"""
WITH {_SPAN}
SELECT {_DAY_KEY} AS date_key, CAST(d AS TIMESTAMP) AS date, CAST(year(d) AS INTEGER) AS year,
       CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(isodow(d) AS INTEGER) AS day_of_week, isodow(d) >= 6 AS is_weekend
FROM days
""")
def dim_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shared date dimension over the span of both fact tables."""
    return _dim(spark, sf_dir).withColumn("date", F.col("date").cast("timestamp_ntz"))


@register("facts_by_date", f"""
WITH {_SPAN},
o AS (SELECT coalesce({_DAY_KEY.replace("(d)", "(o_orderdate)")}, -1) AS date_key, count(*) AS orders_n,
             round(sum(o_totalprice), 2) AS orders_total
      FROM (SELECT o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders) GROUP BY 1),
l AS (SELECT {_DAY_KEY.replace("(d)", "(l_shipdate)")} AS date_key, count(*) AS lineitem_n,
             round(sum(l_extendedprice * (1 - l_discount)), 4) AS lineitem_revenue FROM lineitem GROUP BY 1)
SELECT k.date_key, CAST(k.d AS TIMESTAMP) AS date, coalesce(o.orders_n, 0) AS orders_n, o.orders_total,
       coalesce(l.lineitem_n, 0) AS lineitem_n, l.lineitem_revenue
FROM (SELECT {_DAY_KEY} AS date_key, d FROM days UNION ALL SELECT -1, NULL) k
LEFT JOIN o ON o.date_key = k.date_key LEFT JOIN l ON l.date_key = k.date_key
WHERE o.orders_n IS NOT NULL OR l.lineitem_n IS NOT NULL
""")
def facts_by_date_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two facts bridged by the date dimension: each aggregated per day, then joined by day; undated orders stay."""
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    orders = orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    facts = {
        "orders": (orders, "o_orderdate", {"n": F.count(F.lit(1)), "total": F.round(F.sum("o_totalprice"), 2)}),
        "lineitem": (lineitem, "l_shipdate", {
            "n": F.count(F.lit(1)),
            "revenue": F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4)}),
    }
    out = facts_by_date(facts, _dim(spark, sf_dir))
    return out.withColumn("date", F.col("date").cast("timestamp_ntz"))


_LAYOUT_FILTER = ("l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' AND l_shipdate < TIMESTAMP '1997-04-01 00:00:00'")


@register("layout_pruning", "\nUNION ALL\n".join(f"""
SELECT '{layout}' AS layout, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem WHERE {_LAYOUT_FILTER}"""
    for layout in LAYOUTS))
def layout_pruning_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter of lineitem from three layouts (plain, range-sorted, month-partitioned): same answer."""
    paths = write_layouts(table(spark, sf_dir, "lineitem"), "l_shipdate", new_workdir(spark, "layouts"))
    parts = []
    for layout, path in paths.items():
        df = read_layout(spark, path, layout, "l_shipdate", "1997-01-01 00:00:00", "1997-04-01 00:00:00")
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
                            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4).alias("revenue"))
                     .select(F.lit(layout).alias("layout"), "n_rows", "sum_qty", "revenue"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_CLUSTER_FILTERS = {
    "date": {"l_shipdate": ("1997-01-01 00:00:00", "1997-04-01 00:00:00")},
    "part": {"l_partkey": (10, 40)},
    "date and part": {"l_shipdate": ("1997-01-01 00:00:00", "1998-01-01 00:00:00"), "l_partkey": (10, 200)},
}
_CLUSTER_FILES = 64


def _cluster_layouts(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    lineitem, work = table(spark, sf_dir, "lineitem"), new_workdir(spark, "clusters")
    paths = {"date_sorted": f"{work}/date_sorted", "clustered": f"{work}/clustered"}
    write_clustered(lineitem, ["l_shipdate"], paths["date_sorted"], _CLUSTER_FILES)
    write_clustered(lineitem, ["l_shipdate", "l_partkey"], paths["clustered"], _CLUSTER_FILES)
    return paths


def _in_ranges(df: DataFrame, ranges: dict) -> DataFrame:
    for c, (low, high) in ranges.items():
        df = df.filter((F.col(c) >= F.lit(low).cast(df.schema[c].dataType)) & (F.col(c) < F.lit(high).cast(df.schema[c].dataType)))
    return df


@register("cluster_files")
def cluster_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes that filters on one and on two columns of lineitem meet, sorted by date and clustered on date and part."""
    out = None
    for layout, path in _cluster_layouts(spark, sf_dir).items():
        for name, ranges in _CLUSTER_FILTERS.items():
            row = files_met(spark, path, ranges).select(F.lit(layout).alias("layout"), F.lit(name).alias("filter"), "*")
            out = row if out is None else out.unionByName(row)
    return out


@register("cluster_pruning", """
SELECT 'date' AS filter, count(*) AS n_rows, round(sum(l_quantity), 2) AS sum_qty, FALSE AS clustering_meets_less FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-04-01'
UNION ALL SELECT 'part', count(*), round(sum(l_quantity), 2), TRUE FROM lineitem WHERE l_partkey >= 10 AND l_partkey < 40
UNION ALL SELECT 'date and part', count(*), round(sum(l_quantity), 2), TRUE FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' AND l_partkey >= 10 AND l_partkey < 200
""")
def cluster_pruning_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filters' answers from the clustered table, and whether it meets fewer bytes than the one sorted by date: on the second column it does."""
    paths = _cluster_layouts(spark, sf_dir)
    out = None
    for name, ranges in _CLUSTER_FILTERS.items():
        answer = _in_ranges(spark.read.parquet(paths["clustered"]), ranges).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"))
        less = files_met(spark, paths["clustered"], ranges).select(F.col("n_bytes").alias("a")).crossJoin(  # two single rows
            files_met(spark, paths["date_sorted"], ranges).select(F.col("n_bytes").alias("b"))).select((F.col("a") < F.col("b")).alias("clustering_meets_less"))
        row = answer.crossJoin(less).select(F.lit(name).alias("filter"), "*")
        out = row if out is None else out.unionByName(row)
    return out


# ------------------------------------------------------------ profiling ---

_KEY_TABLES = {
    "region": "r_regionkey r_name", "nation": "n_nationkey n_name n_regionkey", "customer": "c_custkey c_name c_nationkey c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey", "part": "p_partkey p_name p_brand p_type p_size",
    "orders": "o_orderkey o_custkey o_orderstatus o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type props", "documents": "doc_id text lang source n_chars", "labels": "doc_id quality toxic",
    "pages": "page_id url html", "benchmark": "item_id text", "conversations": "conv_id turn role text",
}
_KEY_TIMES = {"o_orderdate", "l_shipdate", "ts"}
_KEY_TEXTS = set("r_name n_name c_name c_mktsegment s_name p_name p_brand p_type o_orderstatus o_orderpriority l_returnflag l_linestatus event_type props "
                 "text lang source url html role".split())


def _key_sql() -> str:
    value = lambda c: f"'t' || epoch_us({c})" if c in _KEY_TIMES else f"'s' || {c}" if c in _KEY_TEXTS else f"'i' || {c}"
    cols = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, {value(c)} AS v FROM {t}" for t, cs in _KEY_TABLES.items() for c in cs.split())
    return f"""
WITH cols AS ({cols}),
keys AS (SELECT t, c, count(*) AS n FROM cols GROUP BY t, c HAVING count(*) = count(DISTINCT v)),
held AS (SELECT DISTINCT t, c, v FROM cols WHERE v IS NOT NULL),
sizes AS (SELECT t, c, count(*) AS n FROM held GROUP BY t, c),
pairs AS (SELECT a.t AS ct, a.c AS cc, b.t AS pt, b.c AS pc, count(*) AS n FROM held a JOIN (SELECT held.* FROM held JOIN keys USING (t, c)) b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c) GROUP BY ALL)
SELECT ct AS child_table, cc AS child_column, pt AS parent_table, pc AS parent_column, CAST(p.n AS BIGINT) AS n_values, CAST(k.n AS BIGINT) AS parent_values
FROM pairs p JOIN sizes s ON p.ct = s.t AND p.cc = s.c AND p.n = s.n JOIN keys k ON p.pt = k.t AND p.pc = k.c"""


@register("key_discovery", _key_sql())
def key_discovery_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All inclusions of a column in a key, over whole numbers, texts and times of all tables, from one pass over each."""
    return inclusion_dependencies({t: table(spark, sf_dir, t).select(*cs.split()) for t, cs in _KEY_TABLES.items()})


@register("entity_profile", """
SELECT user_id, count(*) AS n_events, min(ts) AS first_seen, max(ts) AS last_seen,
       count(DISTINCT event_type) AS n_places, count(*) > 1 AS is_recurring, count(DISTINCT event_type) > 1 AS is_moving
FROM events GROUP BY user_id
""")
def entity_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: activity span and how many distinct event types (places) it touches."""
    return entity_profile(table(spark, sf_dir, "events"), "user_id", "ts", "event_type")


# Errors have no place here, which is a place of its own.
_STAYS = """
WITH e AS (SELECT user_id, ts, nullif(event_type, 'error') AS place, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY ALL),
f AS (SELECT *, row_number() OVER w AS rn, lag(place) OVER w AS prev FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, place NULLS FIRST)),
g AS (SELECT *, sum(CASE WHEN rn > 1 AND place IS NOT DISTINCT FROM prev THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY rn) AS stay_no FROM f),
s AS (SELECT user_id, CAST(stay_no AS BIGINT) AS stay_no, max(place) AS place, CAST(sum(n) AS BIGINT) AS n_events, min(ts) AS arrived, max(ts) AS last_seen
  FROM g GROUP BY user_id, stay_no),
stays AS (SELECT *, lead(place) OVER w AS next_place, epoch_us(last_seen) - epoch_us(arrived) AS stay_us,
  lead(epoch_us(arrived)) OVER w - epoch_us(arrived) AS dwell_us FROM s WINDOW w AS (PARTITION BY user_id ORDER BY stay_no))
"""


def _stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("place", F.nullif("event_type", F.lit("error")))
    return entity_stays(events, "user_id", "ts", "place")


@register("entity_stays", _STAYS + "SELECT * FROM stays")
def entity_stays_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: every stay at one kind of event, with its length and the time until the next."""
    return _stays(spark, sf_dir)


@register("entity_transitions", _STAYS + """SELECT place, next_place, count(*) AS n_moves, CAST(sum(dwell_us) AS BIGINT) AS dwell_us,
  min(dwell_us) AS min_dwell_us, max(dwell_us) AS max_dwell_us FROM stays WHERE dwell_us IS NOT NULL GROUP BY ALL""")
def entity_transitions_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often and how fast users move from one kind of event to another."""
    return transitions(_stays(spark, sf_dir))


def _profile_sql() -> str:
    kinds = {"event_id": "int", "ts": "ts", "user_id": "int", "event_type": "str", "value": "num", "props": "str"}
    parts = []
    for c, kind in kinds.items():
        def slot(k, agg):
            target = {"int": "VARCHAR", "num": "DOUBLE", "str": "VARCHAR", "ts": "TIMESTAMP"}[k]
            return f"CAST({agg}({c}) AS {target})" if k == kind else f"CAST(NULL AS {target})"

        parts.append(
            f"SELECT count(*) AS n_rows, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, "
            f"count(DISTINCT {c}) AS n_distinct, {slot('int', 'min')} AS min_int, {slot('int', 'max')} AS max_int, {slot('num', 'min')} AS min_num, {slot('num', 'max')} AS max_num, "
            f"{slot('str', 'min')} AS min_str, {slot('str', 'max')} AS max_str, "
            f"{slot('ts', 'min')} AS min_ts, {slot('ts', 'max')} AS max_ts FROM (SELECT {_NULLED} FROM events)")
    return "\nUNION ALL\n".join(parts)


@register("profile_table", _profile_sql())
def profile_table_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form column profile of events (with NULLs) from one aggregation."""
    return profile_table(nulled_events(spark, sf_dir))


@register("time_gaps", """
WITH e AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN epoch_us(ts) END AS us FROM events),
g AS (SELECT user_id, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM e WHERE us IS NOT NULL),
p AS (SELECT user_id, min(gap) / 1e6 AS min_gap_s, max(gap) / 1e6 AS max_gap_s FROM g GROUP BY user_id)
SELECT n.user_id, n.n_events, p.min_gap_s, p.max_gap_s
FROM (SELECT user_id, count(*) AS n_events FROM e GROUP BY user_id) n LEFT JOIN p ON n.user_id = p.user_id
""")
def time_gaps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: smallest and largest gap between consecutive events; errors have no time here, but count."""
    events = table(spark, sf_dir, "events")
    return time_gaps(events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts"))), "user_id", "ts")


# ------------------------------------------------------- log & comments ---

@register("event_log_summary", """
SELECT 'bronze_events' AS job_name, module, level, message, 'run-1' AS run_id FROM (
  SELECT 'copy_into' AS module, 'INFO' AS level, 'loaded ' || CAST(count(*) AS VARCHAR) || ' rows' AS message FROM events
  UNION ALL
  SELECT 'sanity_check', 'INFO', 'bronze.events passed with ' || CAST(count(*) AS VARCHAR) || ' rows' FROM events
  UNION ALL
  SELECT 'copy_into', 'INFO', 'loaded 0 rows')
""")
def event_log_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, its check and a no-op re-run: the loader and the check write to the append-only event table."""
    events, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    reg = events_registry(spec.path, events.schema)
    with EventLog(spark, f"{work}/audit/pipeline_logs", "bronze_events", FIXED_CONTEXT) as log:
        first = ingest(spark, reg, "bronze_events", f"{work}/lake", FIXED_CONTEXT, log=log)
        check = check_result(sanity_check(Table(spark, first.target).read(), "bronze.events"))
        log.record("sanity_check", "INFO" if check["passed"] else "ERROR",
                   f"bronze.events {'passed' if check['passed'] else 'failed'} with {check['row_count']} rows")
        ingest(spark, reg, "bronze_events", f"{work}/lake", FIXED_CONTEXT, log=log)
    return log.table().select("job_name", "module", "level", "message", "run_id")


# Descriptions applied as comments.
EVENTS_COMMENTS = {
    "table": "Clickstream events, one row per event; 'raw' as landed",
    "event_id": "Event key",
    "ts": "Event time (wall clock, no zone)",
    "user_id": "Acting user",
}


@register("table_comments", f"""
SELECT object_name, comment, (SELECT count(*) FROM events) AS row_count FROM (VALUES
  ('TABLE', '{EVENTS_COMMENTS["table"].replace("'", "''")}'),
  ('event_id', '{EVENTS_COMMENTS["event_id"]}'), ('ts', '{EVENTS_COMMENTS["ts"]}'),
  ('user_id', '{EVENTS_COMMENTS["user_id"]}'), ('event_type', NULL), ('value', NULL), ('props', NULL),
  ('load_dt', NULL), ('source_format', NULL), ('source_file', NULL), ('run_id', NULL)
) AS t(object_name, comment)
""")
def table_comments_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load keeps its source's description and column comments with the table it loads."""
    events, work, spec = _landed_events(spark, sf_dir, "csv", "events_landing.csv")
    columns = {k: v for k, v in EVENTS_COMMENTS.items() if k != "table"}
    reg = Registry({"events": {"path": spec.path, "format": "csv", "schema": events.schema, "target": "bronze.events",
                               "description": EVENTS_COMMENTS["table"], "column_comments": columns}})
    loaded = Table(spark, ingest(spark, reg, "events", f"{work}/lake", FIXED_CONTEXT).target)
    n = loaded.read().agg(F.count(F.lit(1)).alias("row_count"))
    return loaded.comments().withColumn("row_count", F.lit(n.first()[0]).cast("long"))
