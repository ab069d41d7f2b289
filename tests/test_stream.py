"""Available-now streaming ingestion and streaming upserts."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.context import FIXED_CONTEXT, RunContext, release
from sluice.plans.load import Gate, LoadRejected, quarantine_table
from sluice.plans.tables import Table
from sluice.sources import SourceSpec, formats
from sluice.streaming.ingest import stream_ingest, stream_state
from sluice.streaming.upsert import stream_upsert


@pytest.fixture()
def landed(workdir, events):
    path = f"{workdir}/incoming/events.json"
    formats.write(events.repartition(3), path, "json")
    return SourceSpec("ev", path=path, format="json", schema=events.schema)


def test_targets_of_the_same_name_do_not_share_state(spark, workdir, events, landed):
    targets = [f"{workdir}/bronze/events", f"{workdir}/silver/events"]
    assert len({stream_state(t, landed.path) for t in targets}) == 2
    for t in targets:
        assert stream_ingest(spark, landed, t, FIXED_CONTEXT).rows_loaded == events.count()


def test_only_new_files_are_read(spark, workdir, events, landed):
    target = f"{workdir}/bronze/ev"
    first = stream_ingest(spark, landed, target, FIXED_CONTEXT, max_files=1)
    assert first.rows_loaded == events.count() and first.new_files == 3
    assert stream_ingest(spark, landed, target, FIXED_CONTEXT).rows_loaded == 0
    formats.write(events.withColumn("event_id", F.col("event_id") + 10**9).coalesce(1), landed.path, "json", mode="append")
    assert stream_ingest(spark, landed, target, FIXED_CONTEXT).rows_loaded == events.count()
    assert Table(spark, target).read().count() == 2 * events.count()


def test_an_emptied_checkpoint_is_a_new_stream(spark, workdir, events, landed):
    target = f"{workdir}/bronze/ev"
    stream_ingest(spark, landed, target, FIXED_CONTEXT)
    release(spark, f"{stream_state(target, landed.path)}/checkpoint")
    assert stream_ingest(spark, landed, target, FIXED_CONTEXT).rows_loaded == events.count()


def test_later_columns_widen_the_table(spark, workdir, events):
    path, target = f"{workdir}/incoming/e.json", f"{workdir}/bronze/e"
    spec = SourceSpec("ev", path=path, format="json")  # no schema: inferred on the first run
    formats.write(events.drop("props").coalesce(1), path, "json")
    stream_ingest(spark, spec, target, FIXED_CONTEXT)
    assert "props" not in Table(spark, target).read().columns
    formats.write(events.coalesce(1), path, "json", mode="append")
    stream_ingest(spark, spec, target, FIXED_CONTEXT)
    got = Table(spark, target).read()
    assert got.filter("props IS NULL").count() == events.count() == got.filter("props IS NOT NULL").count()


def test_bad_lines_and_refused_batches_go_to_quarantine(spark, workdir, events, landed):
    target, gate = f"{workdir}/bronze/ev", Gate(not_null_columns=("user_id",))
    spark.createDataFrame([('{"event_id": "x"}',)], "value string").coalesce(1).write.mode("append").text(landed.path)
    first = stream_ingest(spark, landed, target, FIXED_CONTEXT, gate=gate)
    assert (first.rows_loaded, first.quarantined) == (events.count(), 1)
    formats.write(events.limit(4).withColumn("user_id", F.lit(None).cast("long")).coalesce(1), landed.path, "json", mode="append")
    with pytest.raises(LoadRejected, match="user_id has 4 null values"):
        stream_ingest(spark, landed, target, FIXED_CONTEXT, gate=gate)
    formats.write(events.limit(6).coalesce(1), landed.path, "json", mode="append")
    assert stream_ingest(spark, landed, target, FIXED_CONTEXT, gate=gate).rows_loaded == 6
    assert quarantine_table(spark, target).read().count() == 5


def test_stream_upsert_newest_wins_late_rows_ignored(spark, workdir, events):
    folder, target = f"{workdir}/incoming/cdc", f"{workdir}/silver/ev"
    newer = events.filter("event_type = 'view'").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")) \
        .withColumn("value", F.lit(99.0))
    late = events.filter("event_type = 'click'").withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY")) \
        .withColumn("value", F.lit(-1.0))
    for batch in (newer, events, late):  # the correction even arrives before the base row
        formats.write(batch.coalesce(1), folder, "json", mode="append")
    spec = SourceSpec("cdc", path=folder, format="json", schema=events.schema)
    done = stream_upsert(spark, spec, target, ["event_id"], ["ts"], FIXED_CONTEXT, max_files=1)
    assert done["batches"] == done["merged"] == 3
    got = Table(spark, target).read()
    assert got.count() == events.count() and got.columns[-4:] == ["load_dt", "source_format", "source_file", "run_id"]
    assert got.filter("value = -1.0").count() == 0
    assert got.filter("value = 99.0").count() == events.filter("event_type = 'view'").count()
    # a correction under the same time, loaded later, with a column more; and nothing when run again
    formats.write(events.filter("event_type = 'click'").withColumn("value", F.lit(0.25)).withColumn("note", F.lit("n")).coalesce(1), folder, "json", mode="append")
    stream_upsert(spark, spec, target, ["event_id"], ["ts"], RunContext("r2", dt.datetime(2024, 1, 2)))
    assert stream_upsert(spark, spec, target, ["event_id"], ["ts"], RunContext("r3", dt.datetime(2024, 1, 3)))["merged"] == 0
    got = Table(spark, target).read()
    assert got.count() == events.count()
    assert got.filter("value = 0.25 AND note = 'n'").count() == events.filter("event_type = 'click'").count()


def test_stream_ingest_per_file_source(spark, workdir, events, landed):
    target = f"{workdir}/bronze/pf"
    stream_ingest(spark, landed, target, FIXED_CONTEXT, per_file=True)
    names = {r[0] for r in Table(spark, target).read().select("source_file").distinct().collect()}
    assert len(names) == 3 and all(n.startswith("part-") and n.endswith(".json") for n in names)
