"""History operators: reconcile sources, latest-per-key upserts, SCD type 2.

Latest-per-key is ``max(struct(order…, payload…))`` grouped by the key — an
aggregate Spark combines map-side, so a key holding a third of all rows is
reduced to one row per task before the shuffle instead of forming one giant
window partition.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.types import conform_frame, widen


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema`` by name: cast present columns, NULL for missing ones."""
    return conform_frame(df, schema)


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by`` (then by the remaining columns)."""
    payload = [c for c in df.columns if c not in keys and c not in order_by]
    winner = F.max(F.struct(*[F.col(f"`{c}`") for c in order_by + payload])).alias("_w")
    picked = df.groupBy(*keys).agg(winner)
    return picked.select(*keys, *[F.col("_w").getField(c).alias(c) for c in order_by + payload]).select(*df.columns)


def reconcile(frames: list[DataFrame], schema: StructType, keys: list[str], order_by: list[str]) -> DataFrame:
    """Align every source to one schema, union them and keep the newest row per key."""
    aligned = [align(f, schema) for f in frames]
    union = aligned[0]
    for f in aligned[1:]:
        union = union.unionByName(f)
    return latest_per_key(union, keys, order_by)


def upsert(target: DataFrame | None, updates: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Merge ``updates`` into ``target``: per key the newest ``order_by`` wins.

    A late row older than what the target holds never overwrites it. With the load time last in ``order_by`` a correction with
    an equal event time wins over the row it corrects. Both sides are widened to all columns of either, put together
    and reduced to one row per key: one shuffle, combined map-side, whatever share of the keys is touched.
    """
    if target is None:
        return latest_per_key(updates, keys, order_by)
    schema = widen(target.schema, updates.schema)
    return latest_per_key(align(target, schema).unionByName(align(updates, schema)), keys, order_by)


SCD_COLUMNS = ("valid_from", "valid_to", "is_current")


def scd2_apply(
    current: DataFrame | None,
    snapshot: DataFrame,
    keys: list[str],
    tracked: list[str],
    as_of: Column,
) -> DataFrame:
    """Rows that a full snapshot as of ``as_of`` leaves of the ``current`` (open) rows, and those it opens.

    * key unchanged (tracked columns equal, NULL-safe) → current row kept as is;
    * key changed → current row closed (``valid_to = as_of``), new row opened;
    * key new → row opened; key absent from the snapshot → stays open (no deletes);
    * a NULL key is a key like any other.

    One join; every joined row gives its one or two results. Rows closed by earlier snapshots are not needed and not touched.
    The caller sees to it that snapshots come in order (``Scd2Table`` refuses a late one).
    """
    attrs = [c for c in snapshot.columns if c not in keys]
    none = F.lit(None).cast("timestamp_ntz")
    if current is None:
        return snapshot.select(*keys, *attrs, as_of.alias("valid_from"), none.alias("valid_to"), F.lit(True).alias("is_current"))
    s = snapshot.select(*[F.col(f"`{c}`").alias(f"_s_{c}") for c in keys + attrs], F.lit(True).alias("_in_snap"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"`{k}`").eqNullSafe(F.col(f"`_s_{k}`"))
    j = current.filter("is_current").join(s, on, "full_outer")
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_s_{c}`"))
    in_current, in_snap = F.col("is_current").isNotNull(), F.col("_in_snap").isNotNull()
    changed = in_current & in_snap & ~same
    row = lambda prefix, since, to, is_open: F.struct(
        *[F.col(f"`{prefix}{c}`").alias(c) for c in keys + attrs], since.alias("valid_from"), to.alias("valid_to"), F.lit(is_open).alias("is_current"))
    kept, closed = row("", F.col("valid_from"), none, True), row("", F.col("valid_from"), as_of.cast("timestamp_ntz"), False)
    opened = row("_s_", as_of.cast("timestamp_ntz"), none, True)
    results = F.when(changed, F.array(closed, opened)).when(in_current, F.array(kept)).otherwise(F.array(opened))
    return j.select(F.inline(results))


SEEN = "_seen"  # when the snapshots were taken in which a run's attributes were met


def splice_snapshot(runs: DataFrame | None, snapshot: DataFrame, keys: list[str], as_of: Column) -> DataFrame:
    """Runs of equal attributes per key after one more snapshot, wherever in time it lies.

    A run is a key's attributes with the sorted times (``_seen``) of the snapshots that showed them one after the other. The run that the new time falls into is cut there,
    the snapshot's rows become runs of one time, and a sweep over each key's runs in time order puts neighbours with equal attributes
    together. So the runs are the same in whatever order snapshots come. NULL is a key and a value like any other; of rows
    that repeat a key within the snapshot the greatest counts; attributes that one side lacks are NULL there.
    """
    attrs = [c for c in snapshot.columns if c not in keys]
    named = lambda cols: [F.col(f"`{c}`") for c in cols]
    one = snapshot.groupBy(*named(keys)).agg(F.max(F.struct(*named(attrs))).alias("_row"))
    new = one.select(*named(keys), *[F.col("_row").getField(c).alias(c) for c in attrs], F.array(as_of).alias(SEEN))
    if runs is None:
        return new
    schema = widen(runs.drop(SEEN).schema, snapshot.schema)
    attrs = [c for c in schema.names if c not in keys]
    parts = F.array(F.filter(SEEN, lambda t: t < as_of), F.filter(SEEN, lambda t: t > as_of))
    cut = runs.select(*[F.col(f"`{c}`") for c in runs.columns if c != SEEN], F.explode(F.filter(parts, lambda p: F.size(p) > 0)).alias(SEEN))
    whole = StructType([*schema.fields, runs.schema[SEEN]])
    both = align(cut, whole).unionByName(align(new, whole))
    in_time = Window.partitionBy(*named(keys)).orderBy(F.element_at(SEEN, 1))
    values = F.struct(*named(attrs))
    begins = (~F.lag(values).over(in_time).eqNullSafe(values)).cast("int")
    numbered = both.withColumn("_begins", begins).withColumn("_run", F.sum("_begins").over(in_time))
    merged = numbered.groupBy(*named(keys), "_run").agg(F.first(values).alias("_row"), F.array_sort(F.flatten(F.collect_list(SEEN))).alias(SEEN))
    return merged.select(*named(keys), *[F.col("_row").getField(c).alias(c) for c in attrs], SEEN)


def run_versions(runs: DataFrame, keys: list[str], tracked: list[str]) -> DataFrame:
    """Every run with its version's end: ``valid_from, valid_to, is_current`` and ``_version`` (the run is the first of a version).

    Neighbouring runs with equal ``tracked`` attributes are one version; its other attributes are those first seen. A tracked column that no
    snapshot had so far counts as NULL.
    """
    in_time = Window.partitionBy(*[F.col(f"`{c}`") for c in keys]).orderBy(F.element_at(SEEN, 1))
    values = F.struct(F.lit(0), *[F.col(f"`{c}`") for c in tracked if c in runs.columns])
    since = F.element_at(SEEN, 1)
    first = runs.withColumn("_version", ~F.lag(values).over(in_time).eqNullSafe(values))
    ends = F.min(F.when(F.col("_version"), since)).over(in_time.rowsBetween(1, Window.unboundedFollowing))
    return (first.withColumn("valid_to", ends).withColumns({"valid_from": since, "is_current": F.col("valid_to").isNull()})
            .select(*runs.columns, "_version", *SCD_COLUMNS))
