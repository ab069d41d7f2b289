"""Profiles: per-entity activity, per-column statistics, and time gaps."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, DecimalType, DoubleType, FloatType, IntegralType, MapType,
                               StringType, StructType, TimestampNTZType, TimestampType, VariantType)

from sluice.context import new_workdir, scan_partitions
from sluice.functions.dates import epoch_micros


def entity_profile(df: DataFrame, entity: str, ts: str, place: str) -> DataFrame:
    """Per entity: events, first/last seen, distinct places, and whether it recurs or moves.

    ``count_distinct`` inside a grouped aggregate is planned as a two-level
    aggregation keyed by (entity, place) first, so a hot entity with few places
    is combined map-side.
    """
    return df.groupBy(entity).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min(ts).alias("first_seen"),
        F.max(ts).alias("last_seen"),
        F.count_distinct(place).alias("n_places"),
    ).select(
        entity, "n_events", "first_seen", "last_seen", F.col("n_places").cast("long").alias("n_places"),
        (F.col("n_events") > 1).alias("is_recurring"),
        (F.col("n_places") > 1).alias("is_moving"),
    )


_SLOTS = {"int": "string", "num": "double", "str": "string", "ts": "timestamp_ntz"}


def _kind(dtype) -> str | None:
    """The slot that a column's least and greatest value go to; None: the type has no order worth showing."""
    if isinstance(dtype, IntegralType):
        return "int"
    if isinstance(dtype, (FloatType, DoubleType)):
        return "num"
    if isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        return "ts"
    if isinstance(dtype, (StringType, BooleanType, DecimalType)):
        return "str"
    return None


def _plain(column: Column, dtype) -> Column:
    """A form of the column that can be grouped: maps and variants, and what may hold them, as JSON."""
    if isinstance(dtype, (MapType, VariantType, StructType, ArrayType)):
        return F.when(column.isNotNull(), F.to_json(F.struct(column.alias("v"))))
    return column


def profile_table(df: DataFrame, approx_distinct: bool = False, rsd: float = 0.01) -> DataFrame:
    """Long-form profile ``(column_name, n_rows, n_nulls, n_distinct, min/max per kind)``, one row per column.

    Rows, NULLs, least and greatest values of all columns come from one pass (whole numbers, decimals and booleans as
    text, so nothing is rounded; binary and nested columns have none). Distinct values take one grouping per column, which reads that column
    alone and combines a hot value map-side; ``approx_distinct`` takes sketches in the one pass instead. A text source
    should be staged as Parquet first, or every grouping parses it again.
    """
    fields = df.schema.fields
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        kind = _kind(f.dataType)
        aggs.append(F.count_if(c.isNull()).alias(f"_nulls{i}"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(_plain(c, f.dataType), rsd).alias(f"_d{i}"))
        if kind:
            aggs += [F.min(c).alias(f"_min{i}"), F.max(c).alias(f"_max{i}")]
        slots = []
        for k, target in _SLOTS.items():
            slots += [(F.col(f"_{m}{i}") if k == kind else F.lit(None)).cast(target).alias(f"{m}_{k}") for m in ("min", "max")]
        rows.append(F.struct(F.lit(f.name).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"_nulls{i}").alias("n_nulls"),
                             (F.col(f"_d{i}") if approx_distinct else F.lit(None)).cast("long").alias("n_distinct"), *slots))
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if approx_distinct:
        return out
    counts = None
    for f in fields:
        one = (df.select(_plain(F.col(f"`{f.name}`"), f.dataType).alias("v")).groupBy("v").agg(F.lit(1).alias("one"))
               .agg(F.count("v").alias("_distinct")).select(F.lit(f.name).alias("column_name"), "_distinct"))
        counts = one if counts is None else counts.unionByName(one)
    names = [c for c in out.columns if c != "n_distinct"]
    return out.select(*names).join(counts, "column_name").select(
        "n_rows", "column_name", "n_nulls", F.col("_distinct").alias("n_distinct"), *names[3:])


def time_gaps(df: DataFrame, entity: str, ts: str) -> DataFrame:
    """Per entity: all its rows, and the min/max gap in seconds between consecutive timestamps.

    Rows without a time count, and so do entities that have no other rows (their gaps are NULL). Zoned timestamps are compared by
    instant, zone-free ones by wall time. Distinct times are range-partitioned by entity and time and staged, so an entity with a third of all
    rows lies in as many pieces as its data fills; the gaps between pieces come from their first and last times.
    """
    spark = df.sparkSession
    at = F.unix_micros(F.col(ts)) if isinstance(df.schema[ts].dataType, TimestampType) else epoch_micros(F.col(ts))
    base = df.select(F.col(entity).alias("_e"), at.alias("_us"))
    totals = base.groupBy("_e").agg(F.count(F.lit(1)).alias("n_events"))
    times = base.filter("_us IS NOT NULL").groupBy("_e", "_us").agg((F.count(F.lit(1)) > 1).alias("_tied"))
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(df))
    path = f"{new_workdir(spark, 'gaps')}/times"
    times.repartitionByRange(pieces, "_e", "_us").withColumn("_piece", F.spark_partition_id()).write.parquet(path)
    staged = spark.read.parquet(path)
    gap = F.col("_us") - F.lag("_us").over(Window.partitionBy("_e", "_piece").orderBy("_us"))
    inner = (staged.withColumn("_gap", gap).groupBy("_e", "_piece")
             .agg(F.min(F.when(F.col("_tied"), F.lit(0)).otherwise(F.col("_gap"))).alias("_mn"), F.max("_gap").alias("_mx"),
                  F.bool_or("_tied").alias("_tie"), F.min("_us").alias("_first"), F.max("_us").alias("_last")))
    edge = F.col("_first") - F.lag("_last").over(Window.partitionBy("_e").orderBy("_piece"))
    per = inner.withColumn("_edge", edge).groupBy("_e").agg(
        F.least(F.min("_mn"), F.min("_edge")).alias("_min"),
        F.greatest(F.max("_mx"), F.max("_edge"), F.when(F.bool_or("_tie"), F.lit(0))).alias("_max"))
    out = totals.join(per.withColumnRenamed("_e", "_k"), F.col("_e").eqNullSafe(F.col("_k")), "left")
    return out.select(F.col("_e").alias(entity), "n_events", (F.col("_min") / F.lit(1e6)).alias("min_gap_s"),
                      (F.col("_max") / F.lit(1e6)).alias("max_gap_s"))
