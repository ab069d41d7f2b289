"""Chronological chunking: split a table by time into percentage slices, one file set each.

Slices come from :func:`sluice.operators.rank.plan_slices`: approximate quantiles beside the slice
boundaries cut the order column into segments, one count per segment gives every slice's size, and
only the few rows in segments that a boundary cuts through are ranked exactly. Nothing is sorted
globally and the bulk of the data is never shuffled: each slice write is a range scan of the source
plus its share of the staged boundary rows. A source that isn't Parquet is parsed once, into the
shared folder, so that those scans don't parse it again.
"""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import json

from sluice.context import RunContext, new_workdir, path_exists, read_text, release, write_text
from sluice.operators.audit import AUDIT_COLUMNS, add_audit_columns, strip_audit_columns
from sluice.operators.rank import SlicedFrame, plan_slices
from sluice.sources import formats


@dataclass(frozen=True)
class SliceTarget:
    key: str
    percent: int | float
    format: str


# The default plan — earliest 40% first, then 30, 20 and 10 percent.
DEFAULT_PLAN = (
    SliceTarget("chunk1", 40, "csv"),
    SliceTarget("chunk2", 30, "csv"),
    SliceTarget("chunk3", 20, "json"),
    SliceTarget("chunk4", 10, "xml"),
)


@dataclass
class ChunkResult:
    counts: dict[str, int]
    bounds: list[tuple[int, int]]
    paths: dict[str, str]
    formats: dict[str, str]
    schema: StructType
    n: int
    sliced: SlicedFrame = field(repr=False, default=None)
    skipped: list[str] = field(default_factory=list)


def audited_schema(schema: StructType) -> StructType:
    from pyspark.sql.types import StringType, TimestampType

    base = [f for f in schema.fields if f.name not in AUDIT_COLUMNS]
    return StructType(
        base
        + [
            StructField("load_dt", TimestampType(), False),
            StructField("source_format", StringType(), False),
            StructField("source_file", StringType(), False),
            StructField("run_id", StringType(), False),
        ]
    )


def run_chunking(
    df: DataFrame,
    order_by: str,
    out_dir: str,
    plan=DEFAULT_PLAN,
    source_name: str = "source",
    ctx: RunContext | None = None,
    tiebreak: list[str] | None = None,
    num_buckets: int | None = None,
    skip_unchanged: bool = True,
) -> ChunkResult:
    """Rank ``df`` by ``order_by`` (ties broken by every other column) and write each slice.

    Slice ``k`` holds ranks ``floor(n*c_{k-1}/100)+1 .. floor(n*c_k/100)``; it is
    written with mode overwrite to ``out_dir/<key>.<format>`` with audit columns
    whose ``source_file`` reads ``<source_name>[rows a-b]``.

    With ``skip_unchanged`` a slice whose content fingerprint (rows, sum of row hashes, rank range,
    format) equals the one saved beside its output is not rewritten: its files keep their names and
    times, so file-tracking loaders downstream do not ingest the same rows twice on a re-run.
    """
    spark = df.sparkSession
    work = new_workdir(spark, "chunk-rank")
    df = strip_audit_columns(df)
    if not reads_parquet(df):
        df.write.parquet(f"{work}/source")
        df = spark.read.schema(df.schema).parquet(f"{work}/source")
    sliced = plan_slices(df, order_by, [t.percent for t in plan], tiebreak=tiebreak, num_buckets=num_buckets,
                         workdir=work, fingerprint=skip_unchanged)
    bounds = sliced.bounds
    counts, paths, fmts, writes = {}, {}, {}, []
    for i, target in enumerate(plan):
        start, end = bounds[i]
        rows = sliced.frame(i)
        tagged = add_audit_columns(rows, target.format, f"{source_name}[rows {start}-{end}]", ctx)
        path = f"{out_dir}/{target.key}.{target.format}"
        writes.append((tagged, path, target.format))
        counts[target.key] = max(0, end - start + 1)
        paths[target.key] = path
        fmts[target.key] = target.format
    prints = slice_fingerprints(sliced, plan, df.schema) if skip_unchanged else {}
    fp_dir = f"{out_dir}/_fingerprints"
    todo, skipped = [], []
    for (d, p, f), target in zip(writes, plan):
        old = f"{fp_dir}/{target.key}.json"
        if prints and path_exists(spark, old) and path_exists(spark, p) and read_text(spark, old) == prints[target.key]:
            skipped.append(target.key)
        else:
            todo.append((d, p, f, target.key))
    # Slices read disjoint rows: submit the writes as concurrent jobs.
    if todo:
        with ThreadPoolExecutor(max_workers=len(todo)) as pool:
            for fut in [pool.submit(formats.write, d, p, f, "overwrite") for d, p, f, _ in todo]:
                fut.result()
    for _, _, _, key in todo:  # only after the data is in place
        if prints:
            write_text(spark, f"{fp_dir}/{key}.json", prints[key])
    schema = audited_schema(df.schema)
    release(spark, work)  # the slices are written: nothing reads the staged rows any more
    return ChunkResult(counts, bounds, paths, fmts, schema, sliced.n, sliced, skipped)


def reads_parquet(df: DataFrame) -> bool:
    """Whether ``df`` is a projection or filter of Parquet files, which a range scan can prune."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    kinds = {node.strip(" :+-").split(" ")[0] for node in plan.treeString().splitlines()}
    return leaves.size() == 1 and "parquet" in leaves.apply(0).toString().lower() and kinds <= {"Project", "Filter", "Relation"}


def slice_fingerprints(sliced: SlicedFrame, plan, schema: StructType) -> dict[str, str]:
    """Per slice: JSON of (rows, exact sum of 64-bit row hashes, rank range, format, schema).

    Whole segments take the sums the count pass already made (``fingerprint=True``); only the
    staged boundary rows are aggregated again, in one small job.
    """
    got = sliced.slice_prints(whole_hashes=True)
    return {t.key: json.dumps({"rows": got[i][0], "hash_sum": str(got[i][1]), "ranks": list(sliced.bounds[i]),
                               "format": t.format, "schema": schema.jsonValue()}, sort_keys=True)
            for i, t in enumerate(plan)}


def read_slices(spark: SparkSession, result: ChunkResult, slice_col: str = "slice_id") -> DataFrame:
    """Read every written slice back with the explicit schema, tagged with its slice number."""
    frames = []
    for i, (key, path) in enumerate(result.paths.items(), start=1):
        part = formats.read(spark, path, result.formats[key], schema=result.schema)
        frames.append(part.withColumn(slice_col, F.lit(i)))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

