"""Available-now streaming ingestion of new files.

The stream is one of file identities: Spark's file source lists the folder and remembers in the checkpoint every file it has handed out, however old
the file is, and no content is read by it. Each micro-batch reads its files as the bulk loader does (in splits, CSV by header, lines
that don't fit aside or rescued), and lands as one load of the target whose id holds the stream's own id and the batch
number: a batch replayed after a crash finds its load committed and is skipped, and a stream started anew on an emptied checkpoint is another stream.

The schema is the spec's, or inferred from the first files, and kept beside the checkpoint. The files of every batch, whatever their time, are
looked at for columns it lacks; those are added, and older rows read them as NULL.
"""
from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluice.context import RunContext, path_exists, read_text, write_text
from sluice.functions.types import widen
from sluice.plans.tables import Table
from sluice.sources import formats
from sluice.sources.formats import BAD, RAW
from sluice.sources.spec import SourceSpec

_FILES = "path string, modificationTime timestamp, length long, content binary"  # fixed value: the columns of Spark's binaryFile source
_LISTING = ("pathGlobFilter", "recursiveFileLookup")
_ANY_AGE = "36500d"


def stream_state(target: str, source: str) -> str:
    """Where a stream keeps its state: with its target, in a folder of its own for each source."""
    return f"{target.rstrip('/')}/_streams/{hashlib.sha256(source.rstrip('/').encode()).hexdigest()[:20]}"


def kept_schema(spark: SparkSession, location: str) -> StructType | None:
    return StructType.fromJson(json.loads(read_text(spark, location))["schema"]) if path_exists(spark, location) else None


def stream_schema(spark: SparkSession, spec: SourceSpec, location: str, paths: list[str]) -> StructType:
    """The schema kept at ``location`` (or the spec's, or that of the first files), widened by columns that ``paths`` have more.

    With a rescue column such fields go there instead; CSV headers are looked at when the files are read.
    """
    from sluice.plans.load import spec_schema

    kept = kept_schema(spark, location)
    schema = kept or spec_schema(spark, spec, paths)
    if spec.format in ("json", "xml", "parquet") and not spec.rescue:
        found = formats.bare_schema(spark, paths, spec.format, **dict(spec.options))
        have = {c.lower() for c in schema.names}
        schema = widen(schema, StructType([f for f in found.fields if f.name.lower() not in have]))
    keep_schema(spark, location, schema, kept)
    return schema


def keep_schema(spark: SparkSession, location: str, schema: StructType, kept: StructType | None) -> None:
    if schema != kept:
        write_text(spark, location, json.dumps({"schema": schema.jsonValue()}))


def stream_files(spark: SparkSession, spec: SourceSpec, max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``readStream`` of the identities of files under the spec's folder (a directory or glob), of any age."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFileAge", _ANY_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    elif max_bytes:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes))
    return reader.options(**{k: v for k, v in spec.options.items() if k in _LISTING}).load(spec.path).select("path", "length", "modificationTime")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint; another one after the checkpoint is emptied."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"].replace("-", "")[:16]


def run_available_now(stream: DataFrame, batch_fn, checkpoint: str) -> None:
    """Drain everything available now through ``batch_fn(df, batch_id)`` and stop."""
    query = (stream.writeStream.foreachBatch(batch_fn)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_ingest(spark: SparkSession, spec: SourceSpec, target: str, ctx: RunContext | None = None, checkpoint: str | None = None,
                  max_files: int | None = None, max_bytes: int | None = None, per_file: bool = False, gate=None):
    """Available-now load of files not seen before into ``target``; returns a ``LoadResult``.

    ``max_bytes`` (or ``max_files``) bounds a micro-batch. ``per_file`` tags each row with the name of the file it came from (scan
    metadata) instead of the spec's source name. Micro-batches that ``gate`` refuses go to quarantine; the rest of the
    stream is drained, then ``LoadRejected`` is raised.
    """
    from sluice.plans.load import LoadRejected, LoadResult, publish, read_spec, tag

    ctx = ctx or RunContext()
    state = stream_state(target, spec.path)
    checkpoint = checkpoint or f"{state}/checkpoint"
    location = f"{state}/schema.json"
    table = Table(spark, target)
    loaded = {"rows": 0, "batches": 0, "bad": 0}
    refused: list[str] = []

    def land(batch: DataFrame, batch_id: int) -> None:
        load_id = f"s{stream_id(spark, checkpoint)}-{batch_id}"
        if table.has_load(load_id):
            return
        paths = sorted(r["path"] for r in batch.select("path").collect())  # of one micro-batch, which ``max_bytes`` bounds
        if not paths:
            return
        schema = stream_schema(spark, spec, location, paths)
        rows_in = read_spec(spark, replace(spec, schema=schema), paths, per_file)
        if spec.format == "csv" and not spec.rescue:
            more = StructType([f for f in rows_in.schema.fields if f.name not in (RAW, BAD, "_file")])
            keep_schema(spark, location, widen(schema, more), schema)
        try:
            rows, bad, _ = publish(table, tag(rows_in, spec, ctx, per_file), load_id, "append", ctx, gate=gate)
        except LoadRejected as error:
            refused.append(str(error))
            return
        loaded["rows"] += rows
        loaded["bad"] += bad
        loaded["batches"] += 1

    run_available_now(stream_files(spark, spec, max_files, max_bytes), land, checkpoint)
    if refused:
        raise LoadRejected("; ".join(refused))
    return LoadResult(spec.key, target, loaded["rows"], ctx.run_id, None, loaded["batches"], loaded["bad"])
