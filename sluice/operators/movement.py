"""Moving entities: stays at a place, and the moves between places."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from sluice.context import new_workdir, scan_partitions
from sluice.functions.dates import epoch_micros


def entity_stays(df: DataFrame, entity: str, ts: str, place: str) -> DataFrame:
    """One row per stay: ``entity, stay_no, place, n_events, arrived, last_seen, next_place, stay_us, dwell_us``.

    A stay is a run of an entity's events at one place, in the order of time and, at one time, of place (NULL first). ``stay_us`` goes from its
    first to its last event, ``dwell_us`` to the arrival at the next place (NULL for the last stay). A NULL place is a place, a NULL
    entity an entity; rows without a time are in no stay; repeated rows count in ``n_events``. An empty table gives none.

    Distinct events are range-partitioned by entity and time and staged, so an entity with a third of all rows lies in as many pieces as its
    data fills. Runs are found within each piece; a row per entity and piece says which first runs go on from the piece before and
    where each piece's numbers begin.
    """
    spark = df.sparkSession
    base = new_workdir(spark, "stays")
    events = (df.select(F.col(f"`{entity}`").alias("_e"), F.col(f"`{ts}`").alias("_t"), F.col(f"`{place}`").alias("_p"))
              .filter("_t IS NOT NULL").groupBy("_e", "_t", "_p").agg(F.count(F.lit(1)).alias("_n")))
    pieces = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), scan_partitions(df))
    (events.repartitionByRange(pieces, "_e", "_t", "_p").withColumn("_piece", F.spark_partition_id())
     .write.parquet(f"{base}/events"))
    inside = Window.partitionBy("_e", "_piece").orderBy("_t", "_p")
    before = F.lag(F.struct("_p")).over(inside)
    starts = before.isNull() | ~before["_p"].eqNullSafe(F.col("_p"))
    (spark.read.parquet(f"{base}/events").withColumn("_starts", starts.cast("long"))
     .withColumn("_run", F.sum("_starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
     .groupBy("_e", "_piece", "_run").agg(F.first("_p").alias("_p"), F.sum("_n").alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last"))
     .write.parquet(f"{base}/runs"))
    runs = spark.read.parquet(f"{base}/runs")
    edges = runs.groupBy("_e", "_piece").agg(F.max("_run").alias("_runs"), F.min_by(F.struct("_p"), "_run").alias("_head"),
                                             F.max_by(F.struct("_p"), "_run").alias("_tail"))
    of_entity = Window.partitionBy("_e").orderBy("_piece")
    tail = F.lag("_tail").over(of_entity)
    goes_on = F.coalesce(tail.isNotNull() & tail["_p"].eqNullSafe(F.col("_head")["_p"]), F.lit(False))
    edges = edges.withColumn("_on", goes_on.cast("long"))
    edges = edges.withColumn("_from", F.coalesce(F.sum(F.col("_runs") - F.col("_on")).over(
        of_entity.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_on"))
    edges = edges.select(F.col("_e").alias("_k"), F.col("_piece").alias("_at"), "_from")
    numbered = runs.join(edges, F.col("_e").eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_at")))
    (numbered.groupBy("_e", (F.col("_from") + F.col("_run")).alias("_no"))
     .agg(F.first("_p").alias("_p"), F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
     .write.parquet(f"{base}/stays"))
    stays = spark.read.parquet(f"{base}/stays")
    following = stays.select(F.col("_e").alias("_k"), (F.col("_no") - 1).alias("_before"), F.col("_p").alias("_next"), F.col("_first").alias("_left"))
    both = stays.join(following, F.col("_e").eqNullSafe(F.col("_k")) & (F.col("_no") == F.col("_before")), "left")
    us = F.unix_micros if isinstance(df.schema[ts].dataType, TimestampType) else epoch_micros
    arrived = us(F.col("_first"))
    return both.select(F.col("_e").alias(entity), F.col("_no").alias("stay_no"), F.col("_p").alias("place"), F.col("_n").alias("n_events"),
                       F.col("_first").alias("arrived"), F.col("_last").alias("last_seen"), F.col("_next").alias("next_place"),
                       (us(F.col("_last")) - arrived).alias("stay_us"), (us(F.col("_left")) - arrived).alias("dwell_us"))


def transitions(stays: DataFrame) -> DataFrame:
    """``(place, next_place, n_moves, dwell_us, min_dwell_us, max_dwell_us)`` of the moves in ``entity_stays``; last stays are no moves."""
    return stays.filter("dwell_us IS NOT NULL").groupBy("place", "next_place").agg(
        F.count(F.lit(1)).alias("n_moves"), F.sum("dwell_us").alias("dwell_us"),
        F.min("dwell_us").alias("min_dwell_us"), F.max("dwell_us").alias("max_dwell_us"))
