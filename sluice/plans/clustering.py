"""Clustering on several columns: rows range-partitioned along a curve that keeps rows near which are near in every column.

Each column's values are ranked by quantile cuts (one aggregation for all columns; the cuts decide the balance of files, never what a query returns), between
two cuts by their distance. The bits of the ranks, interleaved, are the place on the curve. A filter on any of the columns then meets a
part of the files, where a sort by one column helps filters on that one alone.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from sluice.context import scan_partitions
from sluice.functions.dates import epoch_micros

CUT_BITS = 6  # 63 quantile cuts a column
BITS = 16  # resolution of a rank, fewer where many columns share the key
KEY = "_curve"


def as_number(column: Column, kind: DataType) -> Column:
    """A double that grows with the column: numbers, times, days, and the first six bytes of texts."""
    if isinstance(kind, NumericType):
        return column.cast("double")
    if isinstance(kind, TimestampNTZType):
        return epoch_micros(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise ValueError(f"cannot cluster on {kind.simpleString()}")


def _cell(v: Column, cuts: list[float], lo: int, hi: int) -> Column:
    """How many of the cuts are not above ``v``, by halves."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(v < F.lit(cuts[mid]), _cell(v, cuts, lo, mid)).otherwise(_cell(v, cuts, mid + 1, hi))


def curve_ranks(df: DataFrame, columns: list[str], bits: int) -> list[Column]:
    """A rank of ``bits`` bits for each column; NULL (and NaN) lowest."""
    numbers = [F.nanvl(as_number(F.col(f"`{c}`"), df.schema[c].dataType), F.lit(None).cast("double")) for c in columns]
    shares = [i / 2**CUT_BITS for i in range(2**CUT_BITS + 1)]
    row = df.agg(*[F.percentile_approx(n, shares, 2**CUT_BITS * 100).alias(str(i)) for i, n in enumerate(numbers)]).first()
    out = []
    for i, n in enumerate(numbers):
        bounds = sorted(set(row[str(i)] or [0.0]))
        cuts = bounds[1:-1]
        cell = _cell(n, cuts, 0, len(cuts))
        place = F.lit(0.0)
        if len(bounds) > 1:
            edge = F.array(*[F.lit(float(b)) for b in bounds])
            low, high = F.element_at(edge, cell + 1), F.element_at(edge, cell + 2)
            place = F.least(F.greatest((n - low) / (high - low), F.lit(0.0)), F.lit(1.0 - 2.0**-20))
        top = float(2**bits - 2)
        out.append(F.coalesce(F.floor((cell + place) / max(len(bounds) - 1, 1) * top).cast("long") + 1, F.lit(0).cast("long")))
    return out


def curve_key(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with its place on the curve: the ranks' bits interleaved (at most 62)."""
    bits = min(BITS, 62 // len(columns))
    ranks = [f"_rank{i}" for i in range(len(columns))]
    ranked = df.withColumns(dict(zip(ranks, curve_ranks(df, columns, bits), strict=True)))
    key = F.lit(0).cast("long")
    for b in range(bits):
        for i, r in enumerate(ranks):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")), b * len(ranks) + i))
    return ranked.withColumn(KEY, key).drop(*ranks)


def write_clustered(df: DataFrame, columns: list[str], path: str, num_files: int | None = None) -> None:
    """Write ``df`` as Parquet clustered on ``columns``; rows at one place of the curve are still cut across files by a row hash."""
    spark = df.sparkSession
    n = num_files or max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(df))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    curve_key(df, columns).repartitionByRange(n, F.col(KEY), spread).sortWithinPartitions(KEY).drop(KEY).write.mode("overwrite").parquet(path)


def files_met(spark: SparkSession, path: str, ranges: dict[str, tuple]) -> DataFrame:
    """``(n_files, n_bytes, all_files, all_bytes)``: the files whose least and greatest values let rows in ``low <= column < high`` be there, for every
    column of ``ranges``. These are the files that a scan with these filters can't skip."""
    df = spark.read.parquet(path)
    limits = [f(F.col(f"`{c}`")).alias(f"{k}{i}") for i, c in enumerate(ranges) for k, f in (("lo", F.min), ("hi", F.max))]
    files = df.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.max("_metadata.file_size").alias("size"), *limits)
    met = F.lit(True)
    for i, (c, (low, high)) in enumerate(ranges.items()):
        kind = df.schema[c].dataType
        met = met & (F.col(f"hi{i}") >= F.lit(low).cast(kind)) & (F.col(f"lo{i}") < F.lit(high).cast(kind))
    some = F.coalesce(met, F.lit(False))
    return files.agg(F.count_if(some).alias("n_files"), F.coalesce(F.sum(F.when(some, F.col("size"))), F.lit(0)).alias("n_bytes"),
                     F.count(F.lit(1)).alias("all_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("all_bytes"))
