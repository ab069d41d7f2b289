"""Exact global rank and chronological slicing without a single-partition sort.

A global ``row_number() OVER (ORDER BY ts)`` has no partition key, so Spark
funnels every row through one task. Here the rank is built from three
distributed steps instead:

1. **Range-partition on the full sort key** — the order column first, then
   every other orderable column as a tiebreak, then a per-row salt. Spark's
   range partitioner samples the whole composite key, so a timestamp shared by
   millions of rows (or a run of fully identical rows) is split across
   buckets instead of landing in one task.
2. **Sort within each bucket and stage it** to the shared scratch folder with
   the bucket id and the row's position inside the bucket. Staging pins the
   bucket boundaries: later reads never re-sample, and an executor lost after
   the write costs nothing.
3. **Bucket sizes → offsets.** Counting the staged bucket ids returns one row
   per bucket (a bounded, tiny result); prefix sums give each bucket's first
   rank. ``rank = offset[bucket] + position + 1``, a narrow projection.

Identical rows are interchangeable, so the salt only decides which of them
gets which of their (consecutive) ranks; every output row set is unique.
"""
from __future__ import annotations

import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from sluice.context import new_workdir, scan_partitions

_SALT, _PART, _POS = "_sl_salt", "_sl_part", "_sl_pos"
DEFAULT_ROWS_PER_BUCKET = 2_000_000


def _orderable(dtype) -> bool:
    """Spark orders every type but maps and variants, and what holds them."""
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    return not isinstance(dtype, (MapType, VariantType))


def order_keys(df: DataFrame, order_by: str | list[str], tiebreak: list[str] | None = None) -> list[str]:
    """Order column(s) first, then the tiebreak (default: all other orderable columns in schema order)."""
    lead = [order_by] if isinstance(order_by, str) else list(order_by)
    if tiebreak is None:
        tiebreak = [f.name for f in df.schema.fields if f.name not in lead and _orderable(f.dataType)]
    return lead + [c for c in tiebreak if c not in lead]


def sort_columns(keys: list[str]) -> list[Column]:
    """Ascending, nulls first (Spark's default, written out for readers of the plan)."""
    return [F.col(f"`{k}`").asc_nulls_first() for k in keys]


@dataclass
class Ranked:
    """A staged, ranked table: ``frame`` has ``rank_col``; ``n`` rows in total.

    ``with_bucket`` additionally carries the bucket id, which lets filters on a
    rank range skip whole staged files.
    """

    with_bucket: DataFrame
    n: int
    bucket_counts: list[int]
    staged_path: str
    rank_col: str

    @property
    def frame(self) -> DataFrame:
        return self.with_bucket.drop(_PART)

    def offsets(self) -> list[int]:
        out, acc = [], 0
        for c in self.bucket_counts:
            out.append(acc)
            acc += c
        return out

    def bucket_span(self, first_rank: int, last_rank: int) -> tuple[int, int]:
        """Buckets that hold ranks ``first_rank..last_rank`` (1-based, inclusive)."""
        offs = self.offsets()
        lo = hi = None
        for b, (off, cnt) in enumerate(zip(offs, self.bucket_counts)):
            if cnt and off + cnt >= first_rank and off + 1 <= last_rank:
                lo = b if lo is None else lo
                hi = b
        return (lo if lo is not None else 0, hi if hi is not None else -1)


def choose_buckets(spark, n: int, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> int:
    """Range buckets for ``n`` rows: the shuffle partitions, fewer where they would be nearly empty, more where they would be too large."""
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(1, min(parallel, math.ceil(n / 20_000)), math.ceil(n / max(1, rows_per_bucket)))


def global_rank(
    df: DataFrame,
    order_by: str | list[str],
    tiebreak: list[str] | None = None,
    rank_col: str = "rank",
    num_buckets: int | None = None,
    rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET,
    workdir: str | None = None,
) -> Ranked:
    """Exact 1-based ``row_number()`` over ``order_by ASC NULLS FIRST, tiebreak…``."""
    spark = df.sparkSession
    keys = order_keys(df, order_by, tiebreak)
    if num_buckets is None:
        num_buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(df))
    workdir = workdir or new_workdir(spark, "rank")
    staged_path = f"{workdir}/staged"
    order = sort_columns(keys) + [F.col(_SALT).asc()]
    (
        df.withColumn(_SALT, F.monotonically_increasing_id())
        .repartitionByRange(num_buckets, *order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        # monotonically_increasing_id = (partition << 33) + row index within the partition
        .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PART).cast("long"), 33))
        .drop(_SALT)
        .write.mode("overwrite")
        .parquet(staged_path)
    )
    staged = spark.read.parquet(staged_path)
    # One row per bucket: the only thing that reaches the driver.
    sizes = {r[0]: r[1] for r in staged.groupBy(_PART).agg(F.count(F.lit(1))).collect()}
    counts = [int(sizes.get(b, 0)) for b in range(num_buckets)]
    ranked = Ranked(staged, sum(counts), counts, staged_path, rank_col)
    offsets = ranked.offsets()
    # num_buckets rows of two longs: a size we chose, safe to broadcast.
    off_df = spark.createDataFrame(list(enumerate(offsets)), f"{_PART} int, _sl_off long")
    frame = staged.join(F.broadcast(off_df), _PART).withColumn(rank_col, F.col("_sl_off") + F.col(_POS) + 1).drop("_sl_off")
    ranked.with_bucket = frame.select(*[F.col(f"`{c}`") for c in df.columns], F.col(rank_col).cast("long").alias(rank_col),
                                F.col(_PART))
    return ranked


def slice_bounds(n: int, percents: list[int | float]) -> list[tuple[int, int]]:
    """1-based inclusive rank ranges per slice: ``floor(n*c/100)`` at each cumulative cut.

    ``start = floor(n*c_prev/100) + 1``, ``end = floor(n*c/100)``, the last end is ``n``.
    Slices are contiguous, disjoint and cover ``1..n``; an empty slice has ``end < start``.
    """
    total = sum(percents)
    if total != 100:
        raise ValueError(f"slice percentages must sum to 100, got {total}")
    bounds, cum = [], Fraction(0)
    for i, p in enumerate(percents):
        start = math.floor(n * cum / 100) + 1
        cum += Fraction(p)
        end = n if i == len(percents) - 1 else math.floor(n * cum / 100)
        bounds.append((start, end))
    return bounds


def slice_id_column(rank: Column, bounds: list[tuple[int, int]]) -> Column:
    """1-based slice number from the rank and the slice end ranks."""
    expr = F.lit(len(bounds))
    for i in range(len(bounds) - 2, -1, -1):
        expr = F.when(rank <= F.lit(bounds[i][1]), F.lit(i + 1)).otherwise(expr)
    return expr.cast("int")


def slice_frame(ranked: Ranked, bounds: list[tuple[int, int]], index: int) -> DataFrame:
    """Rows of one slice; the bucket-range filter lets the scan skip other buckets' files."""
    start, end = bounds[index]
    lo, hi = ranked.bucket_span(start, end)
    rank = F.col(ranked.rank_col)
    return ranked.with_bucket.filter(F.col(_PART).between(lo, hi) & rank.between(start, end)).drop(_PART)


def slice_shares(df: DataFrame, slice_col: str = "slice_id") -> DataFrame:
    """Per slice: rows, share of the total in percent (1 decimal, 0 when empty) and the total."""
    per = df.groupBy(slice_col).agg(F.count(F.lit(1)).alias("n_rows"))
    # ``per`` holds one row per slice (a handful), so an unpartitioned window is free here.
    out = per.withColumn("total_rows", F.sum("n_rows").over(Window.partitionBy()).cast("long"))
    pct = F.when(F.col("total_rows") == 0, F.lit(0.0)).otherwise(
        F.round(F.lit(100.0) * F.col("n_rows") / F.col("total_rows"), 1)
    )
    return out.select(slice_col, "n_rows", pct.alias("pct_of_total"), "total_rows")


# ----------------------------------------------------------------------------------------------
# Selective slicing: exact slices without ranking every row.
#
# The lead order column is read as an integer (epoch micros, day number, or the integer itself).
# Approximate quantiles a little below and above each slice boundary cut it into a few segments; their
# accuracy decides only how few rows lie between two cuts, not the result. One aggregation counts the
# segments. Only rows of segments that a boundary cuts through get an exact rank on the full key (the
# staged range rank above, which also splits one value held by a third of all rows); every other row
# belongs to one slice by its lead value alone, so a slice's bulk is a range scan of the source (pushed
# to Parquet). A lead without an integer form (text, floating point) ranks every row.
# ----------------------------------------------------------------------------------------------

# The quantiles taken in the first pass, in steps of 1/QUANTILES, and how many steps below and above a boundary cuts lie.
QUANTILES = 2_000
CUT_STEPS = (1, 10, 100)
QUANTILE_ACCURACY = 10_000
_V, _LEAF, _RANK = "_sl_v", "_sl_leaf", "_sl_rank"


def _integral(col: Column, dtype) -> Column | None:
    """A monotone integer form of the lead column, or None when it has none."""
    from pyspark.sql.types import (ByteType, DateType, IntegerType, LongType, ShortType, TimestampNTZType,
                                   TimestampType)

    from sluice.functions.dates import epoch_micros

    if isinstance(dtype, TimestampNTZType):
        return epoch_micros(col)
    if isinstance(dtype, TimestampType):
        return F.unix_micros(col)
    if isinstance(dtype, DateType):
        return F.unix_date(col).cast("long")
    if isinstance(dtype, (ByteType, ShortType, IntegerType, LongType)):
        return col.cast("long")
    return None


def _raw_literal(value: int, dtype) -> Column:
    """Literal of the lead column's own type for a value in integer form (foldable, pushable)."""
    import datetime as _dt

    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

    if isinstance(dtype, TimestampNTZType):
        wall = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=int(value))
        return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(dtype, TimestampType):
        return F.timestamp_micros(F.lit(int(value)))
    if isinstance(dtype, DateType):
        return F.date_from_unix_date(F.lit(int(value)))
    return F.lit(int(value)).cast(dtype)


def _search(value: Column, cuts: list[Column], lo: int, hi: int) -> Column:
    """``lo`` + number of cuts in ``cuts[lo:hi]`` that are ``<= value`` — a balanced CASE tree."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(value >= cuts[mid], _search(value, cuts, mid + 1, hi)).otherwise(_search(value, cuts, lo, mid))


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of a row, as an exact decimal so sums never overflow.

    Every column enters with its position, its name, whether it is null, and its value (nested ones as JSON),
    so a value that moves to another column, or a null beside it, changes the hash.
    """
    parts = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (StructType, ArrayType, MapType, VariantType)):
            c = F.to_json(F.struct(c))
        parts += [F.lit(f"{i}:{f.name}"), c.isNull(), c]
    return F.xxhash64(*parts).cast("decimal(38,0)")


@dataclass
class Segment:
    """Rows whose lead value ``v`` (integer form) lies in ``lo <= v < hi``; ``lo is None``: NULL leads."""

    lo: int | None
    hi: int | None
    n: int
    h: int = 0  # exact sum of the rows' hashes (0 unless fingerprinting)
    offset: int = 0  # rows before this segment in the global order


@dataclass
class SlicedFrame:
    """``df`` split into percentage slices; ``frame(i)`` gives the rows of slice ``i`` (0-based)."""

    source: DataFrame
    keys: list[str]
    n: int
    bounds: list[tuple[int, int]]
    segments: list[Segment]
    split: list[int]  # indices of segments that a slice boundary cuts through
    lead_type: object
    sub: DataFrame | None  # staged rows of the split segments with their global rank ``_sl_rank``
    ranked: Ranked | None = None  # fallback: every row ranked

    @property
    def bucket_counts(self) -> list[int]:
        return [s.n for s in self.segments]

    @property
    def split_buckets(self) -> list[int]:
        return list(self.split)

    def slice_of_rank(self, r: int) -> int:
        return next(i for i, (s, e) in enumerate(self.bounds) if s <= r <= e)

    def whole_segments(self, i: int) -> list[Segment]:
        """Segments lying wholly inside slice ``i``: contiguous in lead order, between split segments."""
        return [s for j, s in enumerate(self.segments)
                if s.n and j not in self.split and self.slice_of_rank(s.offset + 1) == i]

    def _lead_filter(self, whole: list[Segment]) -> Column:
        lead = F.col(f"`{self.keys[0]}`")
        vals = [s for s in whole if s.lo is not None]
        cond = None
        if vals:
            lo, hi = min(s.lo for s in vals), max(s.hi for s in vals)
            cond = (lead >= _raw_literal(lo, self.lead_type)) & (lead <= _raw_literal(hi - 1, self.lead_type))
        if any(s.lo is None for s in whole):
            cond = lead.isNull() if cond is None else (lead.isNull() | cond)
        return cond

    def frame(self, i: int) -> DataFrame:
        cols = [F.col(f"`{c}`") for c in self.source.columns]
        if self.ranked is not None:
            return slice_frame(self.ranked, self.bounds, i).select(*cols)
        start, end = self.bounds[i]
        parts = []
        whole = self.whole_segments(i)
        if whole:
            parts.append(self.source.filter(self._lead_filter(whole)).select(*cols))
        if self.sub is not None and end >= start:
            parts.append(self.sub.filter(F.col(_RANK).between(start, end)).select(*cols))
        if not parts:
            return self.source.filter(F.lit(False)).select(*cols)
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def slice_prints(self, whole_hashes: bool) -> list[tuple[int, int]]:
        """Per slice: (rows, exact sum of row hashes). Whole segments add what the count pass already
        summed (``whole_hashes``); the staged split rows (or the ranked fallback) take one small job."""
        out = [[0, 0] for _ in self.bounds]
        if whole_hashes:
            for i in range(len(self.bounds)):
                for s in self.whole_segments(i):
                    out[i][0] += s.n
                    out[i][1] += s.h
        rest = self.ranked.frame if self.ranked is not None else self.sub
        if rest is not None:
            rank = F.col(self.ranked.rank_col if self.ranked is not None else _RANK)
            rows = rest.select(*[F.col(f"`{c}`") for c in self.source.columns], rank.alias("_sl_r"))
            h = row_hash(rows.drop("_sl_r"))
            got = (rows.groupBy(slice_id_column(F.col("_sl_r"), self.bounds).alias("_sid"))
                   .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(h), F.lit(0)).alias("h")).collect())
            for r in got:
                out[r["_sid"] - 1][0] += int(r["n"])
                out[r["_sid"] - 1][1] += int(r["h"])
        return [(a, b) for a, b in out]


def _segment_range(lead: Column, seg: Segment, lead_type) -> Column:
    if seg.lo is None:
        return lead.isNull()
    return (lead >= _raw_literal(seg.lo, lead_type)) & (lead <= _raw_literal(seg.hi - 1, lead_type))


def _cut_points(grid: list[int], n: int, nn: int, bounds: list[tuple[int, int]]) -> list[int]:
    """Lead values a little below and above each slice boundary, ascending; ``grid`` are the lead's quantiles."""
    cuts = set()
    for _, end in bounds[:-1]:
        at = (end - (n - nn)) / nn * QUANTILES  # NULL leads come first
        for d in CUT_STEPS:
            cuts |= {grid[i] for i in (math.floor(at) - d, math.ceil(at) + d) if 0 <= i < len(grid)}
    return sorted(int(c) for c in cuts)


def plan_slices(
    df: DataFrame,
    order_by: str | list[str],
    percents: list[int | float],
    tiebreak: list[str] | None = None,
    num_buckets: int | None = None,
    workdir: str | None = None,
    fingerprint: bool = False,
) -> SlicedFrame:
    """Exact percentage slices of ``df`` ordered by ``order_by ASC NULLS FIRST, tiebreak…``.

    Jobs: count, min, max and quantiles of the lead column; one count per segment between those beside the slice boundaries (a few
    rows per slice reach the driver; with ``fingerprint`` each segment also sums its rows' hashes); an exact range rank of the rows
    in the segments that a boundary cuts through (about a thousandth of the data per boundary, or all rows of the lead value
    there), staged once in ``num_buckets`` range buckets.
    """
    spark = df.sparkSession
    keys = order_keys(df, order_by, tiebreak)
    lead_type = df.schema[keys[0]].dataType
    lead = F.col(f"`{keys[0]}`")
    value = _integral(lead, lead_type)
    workdir = workdir or new_workdir(spark, "slice-rank")
    if value is None:
        ranked = global_rank(df, keys, tiebreak=[], workdir=workdir, num_buckets=num_buckets)
        bounds = slice_bounds(ranked.n, percents)
        return SlicedFrame(df, keys, ranked.n, bounds, [], [], lead_type, None, ranked)
    # min/max of the raw column, then its integer form: monotone, so f(min) = min(f)
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.count(lead).alias("nn"),
                   _integral(F.min(lead), lead_type).alias("lo"),
                   _integral(F.max(lead), lead_type).alias("hi"),
                   F.percentile_approx(value, [i / QUANTILES for i in range(QUANTILES + 1)], QUANTILE_ACCURACY).alias("grid")).first()
    n, nn, lo, hi = int(stats["n"]), int(stats["nn"]), stats["lo"], stats["hi"]
    bounds = slice_bounds(n, percents)
    segments: list[Segment] = []
    if n:
        edges = [lo, *[c for c in _cut_points(stats["grid"], n, nn, bounds) if lo < c <= hi], hi + 1] if nn else []
        base = df.select(value.alias(_V), *([row_hash(df).alias("_sl_h")] if fingerprint else []))
        inner = [F.lit(e) for e in edges[1:-1]]
        segment = F.when(F.col(_V).isNull(), F.lit(-1)).otherwise(_search(F.col(_V), inner, 0, len(inner)))
        aggs = [F.count(F.lit(1)).alias("n")] + ([F.sum("_sl_h").alias("h")] if fingerprint else [])
        for r in sorted(base.groupBy(segment.alias("_b")).agg(*aggs).collect(), key=lambda r: r["_b"]):
            b, cnt, h = int(r["_b"]), int(r["n"]), int(r["h"] or 0) if fingerprint else 0
            segments.append(Segment(None, None, cnt, h) if b < 0 else Segment(edges[b], edges[b + 1], cnt, h))
    sliced = SlicedFrame(df, keys, n, bounds, segments, [], lead_type, None)
    off = 0
    for j, s in enumerate(segments):
        s.offset = off
        off += s.n
        if sliced.slice_of_rank(s.offset + 1) != sliced.slice_of_rank(s.offset + s.n):
            sliced.split.append(j)
    if not sliced.split:
        return sliced
    split = [segments[j] for j in sliced.split]
    leaf, any_split = None, None
    for i, s in enumerate(split):
        cond = _segment_range(lead, s, lead_type)
        leaf = F.when(cond, F.lit(i)) if leaf is None else leaf.when(cond, F.lit(i))
        any_split = cond if any_split is None else (any_split | cond)
    ranked = global_rank(df.filter(any_split).withColumn(_LEAF, leaf), keys, tiebreak=[], workdir=workdir,
                         num_buckets=num_buckets or choose_buckets(spark, sum(s.n for s in split)))
    # rank among the split rows → global rank: the segments are disjoint lead ranges in order
    shift, before = [], 0
    for s in split:
        shift.append(s.offset - before)
        before += s.n
    sliced.sub = ranked.frame.withColumn(
        _RANK, F.col(ranked.rank_col) + F.element_at(F.array(*[F.lit(x) for x in shift]), F.col(_LEAF) + 1))
    return sliced
