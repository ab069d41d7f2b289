"""Dimensional model pieces: a shared date dimension, per-date facts, layout comparison."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import scan_partitions
from sluice.sources import formats


def date_key(d: Column) -> Column:
    """``yyyymmdd`` as an int."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_span(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row ``(lo, hi)``: the min and max date over several (frame, column) pairs."""
    parts = [df.agg(F.min(F.to_date(c)).alias("lo"), F.max(F.to_date(c)).alias("hi")) for df, c in frames]
    span = parts[0]
    for p in parts[1:]:
        span = span.unionByName(p)
    return span.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def dim_date(span: DataFrame) -> DataFrame:
    """Every calendar day from ``lo`` to ``hi`` with its attributes (ISO day of week, 1 = Monday).

    ``sequence`` + ``explode`` expands the single span row; the day count is the
    calendar range, not the data volume.
    """
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    dow = ((F.dayofweek("date") + 5) % 7 + 1).cast("int")
    return days.select(
        date_key(F.col("date")).alias("date_key"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        dow.alias("day_of_week"),
        (dow >= 6).alias("is_weekend"),
    )


#: The date key of facts without a date.
UNKNOWN_DATE = -1


def facts_by_date(facts: dict[str, tuple[DataFrame, str, dict[str, Column]]], dim: DataFrame) -> DataFrame:
    """Aggregate each fact per ``date_key`` on its own, then join the aggregates on the date.

    Facts are never joined row to row: each is reduced to one row per day first
    (partial aggregation map-side), so the join sees at most one row per day
    per fact. Facts without a date are kept under ``UNKNOWN_DATE`` (date NULL).
    """
    spark = dim.sparkSession
    out = dim.select("date_key", "date")
    out = out.unionByName(spark.range(1).select(F.lit(UNKNOWN_DATE).alias("date_key"), F.lit(None).cast(dim.schema["date"].dataType).alias("date")))
    for name, (df, date_col, measures) in facts.items():
        key = F.coalesce(date_key(F.col(date_col)), F.lit(UNKNOWN_DATE)).alias("date_key")
        agg = df.groupBy(key).agg(*[m.alias(f"{name}_{k}") for k, m in measures.items()])
        out = out.join(agg, "date_key", "left")
    value_cols = [c for c in out.columns if c not in ("date_key", "date")]
    present = F.lit(False)
    for c in value_cols:
        present = present | F.col(c).isNotNull()
    counts = {c: F.coalesce(F.col(c), F.lit(0)) for c in value_cols if c.endswith("_n")}
    return out.where(present).withColumns(counts)


LAYOUTS = ("plain", "range_sorted", "partitioned")


def write_layouts(df: DataFrame, date_col: str, out_dir: str, num_files: int | None = None) -> dict[str, str]:
    """The same table in three layouts: as-is, range-sorted by date, partitioned by month.

    The range-sorted layout is range-partitioned on the date with a row hash as the last key, so one
    date holding a third of all rows is still cut across many write tasks; the file count follows the
    larger of the shuffle partitions and the input's scan partitions. The month-partitioned layout is
    written from those files without another shuffle: the month is a monotone function of the date, so
    each range file already covers a short run of months.
    """
    spark = df.sparkSession
    n = num_files or max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(df))
    paths = {k: f"{out_dir}/{k}" for k in LAYOUTS}
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    formats.write(df, paths["plain"], "parquet")
    formats.write(df.repartitionByRange(n, F.col(date_col), spread).sortWithinPartitions(date_col),
                  paths["range_sorted"], "parquet")
    (spark.read.parquet(paths["range_sorted"]).withColumn("ship_month", F.date_format(date_col, "yyyy-MM"))
     .write.mode("overwrite").partitionBy("ship_month").parquet(paths["partitioned"]))
    return paths


def read_layout(spark: SparkSession, path: str, layout: str, date_col: str, since: str, before: str) -> DataFrame:
    """The rows with ``since <= date_col < before`` of one layout. In the month-partitioned one the range of months is part of
    the filter, so only the folders of those months are listed and opened."""
    df = spark.read.parquet(path)
    wanted = (F.col(date_col) >= F.lit(since).cast("timestamp_ntz")) & (F.col(date_col) < F.lit(before).cast("timestamp_ntz"))
    if layout == "partitioned":
        df = df.filter(F.col("ship_month").between(since[:7], before[:7]))
    return df.filter(wanted)


def files_read(df: DataFrame) -> DataFrame:
    """``(n_files, n_bytes)`` of the files that rows of a filtered scan come from."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("n_bytes"))
