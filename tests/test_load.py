"""Exactly-once loads, refresh, evolution, create-empty and the gate."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sluice.context import FIXED_CONTEXT, RunContext
from sluice.plans.eventlog import EventLog
from sluice.plans.load import (Gate, LoadRejected, copy_into, create_empty_like, full_refresh, ingest, quarantine_table,
                               refresh_with_expectations)
from sluice.operators.quality import Expectation, ExpectationFailed
from sluice.plans.tables import SchemaConflict, Table
from sluice.sources import Registry, SourceSpec, formats


def land(df, path, fmt="csv", mode="overwrite", files=3):
    formats.write(df.repartitionByRange(files, df.columns[0]), path, fmt, mode=mode)


@pytest.fixture()
def landed(spark, workdir, events):
    path = f"{workdir}/incoming/events.csv"
    land(events, path)
    return SourceSpec("events", path=path, format="csv", schema=events.schema)


def test_copy_into_loads_once_then_only_new_files(spark, workdir, events, landed):
    target = f"{workdir}/bronze/events"
    first = copy_into(spark, landed, target, FIXED_CONTEXT)
    assert first.rows_loaded == events.count() and first.new_files == 3
    again = copy_into(spark, landed, target, FIXED_CONTEXT)
    assert again.rows_loaded == 0
    more = events.withColumn("event_id", F.col("event_id") + 10**9)
    land(more, landed.path, mode="append", files=1)
    third = copy_into(spark, landed, target, RunContext("run-2"))
    assert third.rows_loaded == events.count() and third.new_files == 1
    table = Table(spark, target).read()
    assert table.count() == 2 * events.count()
    assert table.select("source_file").distinct().first()[0] == "events.csv"


def test_crash_between_write_and_commit_is_invisible_and_retried(spark, workdir, events, landed):
    target = f"{workdir}/bronze/events"
    table = Table(spark, target)
    # simulate a crash: data staged for the load id, commit never written
    from sluice.plans import load as L
    files = [r.asDict() for r in L.list_files(spark, landed.path).orderBy("path").collect()]
    import hashlib
    load_id = "f" + hashlib.sha1("\n".join(f"{f['path']}|{f['length']}|{f['mtime_ms']}" for f in files).encode()).hexdigest()[:16]
    table.stage_load(events.limit(5), load_id)
    assert not table.exists()
    result = copy_into(spark, landed, target, FIXED_CONTEXT)
    assert result.load_id == load_id and result.rows_loaded == events.count()
    assert table.read().count() == events.count()


def test_schema_evolution_adds_columns_and_refuses_type_change(spark, workdir, events):
    target = f"{workdir}/bronze/ev"
    s1 = SourceSpec("v1", path=f"{workdir}/in/v1", format="json", schema=events.drop("props").schema)
    land(events.drop("props"), s1.path, "json")
    s2 = SourceSpec("v2", path=f"{workdir}/in/v2", format="json", schema=events.schema)
    land(events.withColumn("event_id", F.col("event_id") + 10**9), s2.path, "json")
    copy_into(spark, s1, target, FIXED_CONTEXT)
    copy_into(spark, s2, target, FIXED_CONTEXT)
    t = Table(spark, target).read()
    assert "props" in t.columns
    assert t.filter(F.col("props").isNull()).count() == events.count()
    bad = events.withColumn("user_id", F.col("user_id").cast("string"))
    s3 = SourceSpec("v3", path=f"{workdir}/in/v3", format="json", schema=bad.schema)
    land(bad, s3.path, "json")
    with pytest.raises(SchemaConflict):
        copy_into(spark, s3, target, FIXED_CONTEXT)


def test_create_empty_like_is_zero_rows_and_idempotent(spark, workdir, landed):
    target = f"{workdir}/bronze/empty"
    assert create_empty_like(spark, landed, target, FIXED_CONTEXT) is True
    assert create_empty_like(spark, landed, target, FIXED_CONTEXT) is False
    t = Table(spark, target).read()
    assert t.count() == 0 and t.columns[-4:] == ["load_dt", "source_format", "source_file", "run_id"]


def test_full_refresh_replaces(spark, workdir, events):
    spec = SourceSpec("x", path=f"{workdir}/in/x.xml", format="xml", schema=events.schema)
    land(events, spec.path, "xml")
    target = f"{workdir}/bronze/x"
    full_refresh(spark, spec, target, FIXED_CONTEXT)
    full_refresh(spark, spec, target, FIXED_CONTEXT)
    assert Table(spark, target).read().count() == events.count()


def test_expectation_policies(spark, workdir, events, landed):
    target = f"{workdir}/bronze/checked"
    res = refresh_with_expectations(spark, landed, target, [Expectation("big", "value > 5")], FIXED_CONTEXT)
    assert res.metrics["big"] == events.filter("NOT coalesce(value > 5, false)").count()
    with pytest.raises(ExpectationFailed):
        refresh_with_expectations(spark, landed, f"{workdir}/bronze/c2", [Expectation("big", "value > 5", "fail")])
    assert not Table(spark, f"{workdir}/bronze/c2").exists()


def test_gate_blocks_bad_delivery(spark, workdir, events, landed):
    reg = Registry({"raw": {"path": landed.path, "format": "csv", "schema": events.schema},
                    "b": {"source_key": "raw", "technique": "copy_into", "target": "bronze.events"}})
    first = ingest(spark, reg, "b", f"{workdir}/lake", FIXED_CONTEXT, not_null_columns=("user_id",))
    land(events.withColumn("event_id", F.col("event_id") + 10**9).withColumn("user_id", F.lit(None).cast("long")),
         landed.path, mode="append", files=1)
    with pytest.raises(LoadRejected, match="user_id has"):
        ingest(spark, reg, "b", f"{workdir}/lake", FIXED_CONTEXT, not_null_columns=("user_id",))
    assert Table(spark, first.target).read().count() == events.count()
    with pytest.raises(ValueError, match="unknown technique"):
        ingest(spark, Registry({"z": {"path": landed.path, "format": "csv", "technique": "magic"}}), "z",
               f"{workdir}/lake")


def test_visible_loads_and_ledger(spark, workdir, events):
    t = Table(spark, f"{workdir}/many")
    small = events.limit(3)
    for i in range(8):
        files = spark.createDataFrame([(f"/src/f{i}", i, i)], "path string, length long, mtime_ms long")
        t.write_load(small, f"l{i}", mode="overwrite" if i == 5 else "append", files=files)
    fresh = Table(spark, t.path)
    assert [c["seq"] for c in fresh.commits()] == list(range(1, 9))
    assert fresh.visible_loads() == ["l5", "l6", "l7"]
    assert fresh.read().count() == 9
    assert fresh.loaded_files().count() == 8
    assert t.write_load(small, "l3") == 0


def test_a_commit_is_whole_or_not_there(spark, workdir, events):
    """A record that was being written when the job died lies beside the log and is not read."""
    from sluice.context import create_text

    t = Table(spark, f"{workdir}/torn")
    t.write_load(events.limit(3), "l0")
    create_text(spark, f"{t.log_path}/00000000000000000002.json.0123.tmp", '{"seq": 2, "load')
    assert Table(spark, t.path).read().count() == 3
    with pytest.raises(FileExistsError):
        create_text(spark, f"{t.log_path}/00000000000000000001.json", "{}")


BAD_LINES = [('{"id": 1, "v": 1.5}', None), ('{"id": "one", "v": 2.0}', "malformed"), ('{"id": 3, "v": 2.0, "w": 1, "a": 2}', "unknown fields: a,w"),
             ('{"id": 4, "v"', "malformed"), ("", None), ('{"id": 5}', None)]


def test_json_lines_that_do_not_fit_are_set_aside(spark, workdir):
    spark.createDataFrame([(x,) for x, _ in BAD_LINES], "value string").write.text(f"{workdir}/in.json")
    spec = SourceSpec("x", path=f"{workdir}/in.json", format="json", schema="id long, v double")
    res = copy_into(spark, spec, f"{workdir}/t", FIXED_CONTEXT, Gate())
    assert (res.rows_loaded, res.quarantined) == (2, 3)
    assert sorted((r["id"], r["v"]) for r in Table(spark, f"{workdir}/t").read().collect()) == [(1, 1.5), (5, None)]
    aside = {(r["raw"], r["reason"]) for r in quarantine_table(spark, f"{workdir}/t").read().collect()}
    assert aside == {(x, why) for x, why in BAD_LINES if why}


@pytest.mark.parametrize("fmt,lines,tag", [
    ("csv", ['id,v', '1,1.5', 'one,2.0', '3,2.0,9', '5,\\N'], None),
    ("xml", ["<records>", "<record><id>1</id><v>1.5</v></record>", "<record><id>one</id><v>2.0</v></record>", "<record><id>5</id></record>", "</records>"], "record")])
def test_text_rows_that_do_not_fit_are_set_aside(spark, workdir, fmt, lines, tag):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{workdir}/in")
    spec = SourceSpec("x", path=f"{workdir}/in", format=fmt, schema="id long, v double")
    res = copy_into(spark, spec, f"{workdir}/t", FIXED_CONTEXT)
    assert sorted(r["id"] for r in Table(spark, f"{workdir}/t").read().collect()) == [1, 5]
    assert res.quarantined == (2 if fmt == "csv" else 1)


def test_a_refused_delivery_does_not_hold_up_the_next(spark, workdir, events, landed):
    target, gate = f"{workdir}/bronze/events", Gate(not_null_columns=("user_id",))
    copy_into(spark, landed, target, FIXED_CONTEXT, gate)
    land(events.limit(7).withColumn("user_id", F.lit(None).cast("long")), landed.path, mode="append", files=1)
    with pytest.raises(LoadRejected, match="user_id has 7 null values out of 7"):
        copy_into(spark, landed, target, FIXED_CONTEXT, gate)
    assert quarantine_table(spark, target).read().filter("reason LIKE 'load refused: user_id%'").count() == 7
    land(events.limit(5).withColumn("event_id", F.col("event_id") + 10**9), landed.path, mode="append", files=1)
    assert copy_into(spark, landed, target, FIXED_CONTEXT, gate).rows_loaded == 5
    assert Table(spark, target).read().count() == events.count() + 5


def test_ingest_comments_and_logs_also_when_it_fails(spark, workdir, events, landed):
    old = spark.conf.get("spark.sql.session.timeZone")
    reg = Registry({"e": {"path": landed.path, "format": "csv", "schema": events.schema, "target": "t.e", "description": "Events, 'raw'",
                          "column_comments": {"ts": "wall time"}}})
    log = EventLog(spark, f"{workdir}/log", "job", FIXED_CONTEXT)
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        res = ingest(spark, reg, "e", f"{workdir}/lake", FIXED_CONTEXT, log=log)
        with pytest.raises(LoadRejected):
            land(events.limit(2).withColumn("user_id", F.lit(None).cast("long")), landed.path, mode="append", files=1)
            ingest(spark, reg, "e", f"{workdir}/lake", FIXED_CONTEXT, not_null_columns=("user_id",), log=log)
        age = log.table().select((F.unix_seconds(F.current_timestamp()) - F.unix_seconds("event_ts")).alias("s")).collect()
        assert all(-5 < r["s"] < 600 for r in age)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    said = {r["object_name"]: r["comment"] for r in Table(spark, res.target).comments().collect()}
    assert said["TABLE"] == "Events, 'raw'" and said["ts"] == "wall time" and said["value"] is None
    assert sorted(r["level"] for r in log.table().collect()) == ["ERROR", "INFO"]


def test_a_loaded_table_in_the_catalog(spark, workdir, events):
    """The view shows committed loads only, widened, with comments; a staged load stays out."""
    from sluice.context import basename
    from sluice.plans.comments import expose

    t = Table(spark, f"{workdir}/t")
    t.write_load(events.select("event_id", "ts").limit(3), "l1")
    t.write_load(events.select("event_id", "ts", "value").limit(2), "l2")
    t.stage_load(events.select("event_id").limit(9), "l3")
    t.comment("it's \\ quoted", {"ts": "wall 'time'"})
    name = f"default.v_{basename(workdir).replace('-', '_')}"
    expose(t, name)
    view = spark.table(name)
    assert view.count() == 5 and view.filter("value IS NULL").count() == 3
    described = {r["col_name"]: r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert described["ts"]["comment"] == "wall 'time'" and described["Comment"]["data_type"] == "it's \\ quoted"
    spark.sql(f"DROP VIEW {name}")
