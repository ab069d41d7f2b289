"""Nothing is lost on the way in: rescue column, CSV headers that differ, files of any age, and the promotion to typed columns."""
from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql.types import StructType

from sluice.context import FIXED_CONTEXT
from sluice.plans.load import copy_into, quarantine_table
from sluice.plans.promote import promote_rescued, rescued_types
from sluice.plans.tables import Table
from sluice.sources import SourceSpec
from sluice.sources.rescue import csv_by_header, read_rescued
from sluice.streaming.ingest import stream_ingest


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return str(tmp_path)


def put(folder, name, text, age_days=0):
    path = f"{folder}/in/{name}"
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    os.utime(path, (time.time() - 86400 * age_days,) * 2)
    return path


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_json_keeps_every_field(spark, folder):
    lines = ['{"a":1,"b":"x"}', '{"a":2,"w":1.50,"o":{"p":[1]}}', '{"a":"two","b":"y"}', '{"a":3,"s":{"n":"z","m":4}}', '{"a":4,"b":"d","b":"e"}', '{"a":null,"b":null,"w":null}', "[1]", "junk", ""]
    put(folder, "x.json", "\n".join(lines))
    got = read_rescued(spark, f"{folder}/in", "json", StructType.fromDDL("a int, b string, s struct<n:int,m:int>"))
    by = {(r["a"], r["b"]): json.loads(r["_rescued"]) if r["_rescued"] else None for r in got.filter("_bad IS NULL").collect()}
    assert by[(1, "x")] is None and by[(None, None)] is None
    assert by[(2, None)] == {"w": 1.5, "o": {"p": [1]}}
    assert by[(None, "y")] == {"a": "two"}
    assert by[(3, None)] == {"s": {"n": "z", "m": 4}}
    assert [v for (a, _), v in by.items() if a == 4] == [{"_line": lines[4]}]
    assert rows_of(got.filter("_bad IS NOT NULL"), "_raw", "_bad") == [("[1]", "malformed"), ("junk", "malformed")]


def test_xml_keeps_every_field(spark, folder):
    put(folder, "x.xml", "<records><record><a>1</a><b>x</b></record><record><a>two</a><b>y</b></record><record><a>3</a><z>9</z><o><p>q</p></o></record><record><a>4</record></records>")
    got = read_rescued(spark, f"{folder}/in", "xml", StructType.fromDDL("a int, b string"))
    held = {(r["a"], r["b"]): json.loads(r["_rescued"]) if r["_rescued"] else None for r in got.filter("_bad IS NULL").collect()}
    assert held == {(1, "x"): None, (None, "y"): {"a": "two"}, (3, None): {"z": 9, "o": {"p": "q"}}}
    assert rows_of(got.filter("_bad IS NOT NULL"), "_bad") == [("malformed",)]


def test_csv_keeps_every_field(spark, folder):
    put(folder, "a.csv", 'id,v\n1,x\nten,y\n3\n')
    put(folder, "b.csv", 'extra,id,More\n"e, 1",4,\n\\N,5,m\n')
    got = read_rescued(spark, f"{folder}/in", "csv", StructType.fromDDL("id int, v string"))
    assert rows_of(got.filter("_bad IS NULL"), "id", "v", "_rescued") == sorted(
        [(1, "x", None), (None, "y", '{"id":"ten"}'), (4, None, '{"extra":"e, 1"}'), (5, None, '{"More":"m"}')], key=str)
    assert rows_of(got.filter("_bad IS NOT NULL"), "_raw") == [("3",)]


def test_csv_headers_decide_columns_and_types(spark, folder):
    put(folder, "a.csv", "id,v\n1,10\n")
    put(folder, "b.csv", "v,note,id\n2.5,n,3000000000\n")
    put(folder, "c.csv", "ID\n7\n")
    put(folder, "d.csv", "")
    put(folder, "with blank.csv", "id,v\n8,1\n")
    got = csv_by_header(spark, [f"{folder}/in/{n}" for n in ("a.csv", "b.csv", "c.csv", "d.csv", "with blank.csv")], None)
    assert {f.name: f.dataType.simpleString() for f in got.schema.fields if f.name[0] != "_"} == {"ID": "bigint", "v": "double", "note": "string"}
    assert rows_of(got, "ID", "v", "note") == sorted([(1, 10.0, None), (3000000000, 2.5, "n"), (7, None, None), (8, 1.0, None)], key=str)


def test_a_file_of_another_kind_holds_nothing_up(spark, folder, workdir):
    spec, target = SourceSpec("s", path=f"{folder}/in", format="csv", schema="id int, v string"), f"{workdir}/bronze/s"
    put(folder, "bad.csv", "x,y\n1,2\n3,4\n")
    put(folder, "worse.csv", "id,id\n1,2\n")
    put(folder, "good.csv", "id,v,w\n1,a,0.5\n")
    first = copy_into(spark, spec, target, FIXED_CONTEXT)
    assert (first.rows_loaded, first.quarantined) == (1, 2)
    put(folder, "later.csv", "v,id\nb,2\n")
    assert copy_into(spark, spec, target, FIXED_CONTEXT).rows_loaded == 1
    assert rows_of(Table(spark, target).read(), "id", "v", "w") == [(1, "a", 0.5), (2, "b", None)]
    assert rows_of(quarantine_table(spark, target).read(), "raw", "reason") == [
        ("id,id", "file refused: the header of worse.csv names a column twice"), ("x,y", "file refused: the header of bad.csv has no column of the schema")]


def test_the_stream_reads_files_of_any_age(spark, folder, workdir):
    spec, target = SourceSpec("s", path=f"{folder}/in", format="json", schema="a int"), f"{workdir}/bronze/s"
    put(folder, "new.json", '{"a":1}\n')
    assert stream_ingest(spark, spec, target, FIXED_CONTEXT).rows_loaded == 1
    put(folder, "old.json", '{"a":2}\n', age_days=8)
    put(folder, "very old.json", '{"a":3}\n', age_days=4000)
    assert stream_ingest(spark, spec, target, FIXED_CONTEXT).rows_loaded == 2
    assert rows_of(Table(spark, target).read(), "a") == [(1,), (2,), (3,)]


def test_the_stream_keeps_fields_of_older_files(spark, folder, workdir):
    spec, target = SourceSpec("s", path=f"{folder}/in", format="json", schema="a int"), f"{workdir}/bronze/s"
    put(folder, "new.json", '{"a":1}\n')
    stream_ingest(spark, spec, target, FIXED_CONTEXT)
    put(folder, "older.json", '{"a":2,"b":"kept"}\n', age_days=0.1)
    stream_ingest(spark, spec, target, FIXED_CONTEXT)
    assert rows_of(Table(spark, target).read(), "a", "b") == [(1, None), (2, "kept")]


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_stream_and_bulk_rescue_alike(spark, folder, workdir, fmt):
    if fmt == "json":
        put(folder, "a.json", '{"a":1}\n{"a":"x","b":2}\nnone\n')
    else:
        put(folder, "a.csv", 'a\n1\n"one\n')
        put(folder, "b.csv", "b,a\n2,x\n")
    spec = SourceSpec("s", path=f"{folder}/in", format=fmt, schema="a int", rescue="_rescued")
    copy_into(spark, spec, f"{workdir}/bulk", FIXED_CONTEXT)
    stream_ingest(spark, spec, f"{workdir}/stream", FIXED_CONTEXT)
    bulk, streamed = (rows_of(Table(spark, f"{workdir}/{t}").read(), "a", "_rescued") for t in ("bulk", "stream"))
    assert bulk == streamed and (1, None) in bulk
    lost = [json.loads(r) for a, r in bulk if r and a is None]
    assert {"a": "x", "b": 2 if fmt == "json" else "2"} in lost
    aside = [quarantine_table(spark, f"{workdir}/{t}") for t in ("bulk", "stream")]
    assert [rows_of(q.read(), "raw", "reason") if q.exists() else [] for q in aside][0] == [rows_of(q.read(), "raw", "reason") if q.exists() else [] for q in aside][1]


def test_csv_stream_with_a_column_more(spark, folder, workdir):
    spec, target = SourceSpec("s", path=f"{folder}/in", format="csv", schema="a int"), f"{workdir}/bronze/s"
    put(folder, "a.csv", "a\n1\n")
    stream_ingest(spark, spec, target, FIXED_CONTEXT, per_file=True)
    put(folder, "b.csv", "n,a\nx,2\n")
    stream_ingest(spark, spec, target, FIXED_CONTEXT, per_file=True)
    put(folder, "c.csv", "a\n3\n")
    stream_ingest(spark, spec, target, FIXED_CONTEXT, per_file=True)
    assert rows_of(Table(spark, target).read(), "a", "n", "source_file") == [(1, None, "a.csv"), (2, "x", "b.csv"), (3, None, "c.csv")]


def test_promotion_types_fills_and_leaves_the_rest(spark, workdir):
    target = f"{workdir}/t"
    held = ['{"n":1,"s":"x","o":{"p":1}}', '{"n":2.5,"k":"no number"}', '{"k":7.5,"mixed":1}', '{"mixed":"m"}', None]
    Table(spark, target).write_load(spark.createDataFrame(list(enumerate(held)), "k int, _rescued string").selectExpr("CASE WHEN k < 1 THEN k END AS k", "k AS id", "_rescued"), "a")
    assert promote_rescued(spark, target) == {"mixed": "string", "n": "decimal(21,1)", "o": "struct<p:bigint>", "s": "string"}
    got = Table(spark, target).read()
    assert got.columns == ["k", "id", "_rescued", "mixed", "n", "o", "s"]
    assert [(float(r["n"]) if r["n"] is not None else None, r["s"], r["o"] and r["o"]["p"], r["mixed"], r["_rescued"]) for r in got.orderBy("id").collect()] == [
        (1.0, "x", 1, None, None), (2.5, None, None, None, '{"k":"no number"}'), (None, None, None, "1", '{"k":7.5}'), (None, None, None, "m", None), (None, None, None, None, None)]
    assert promote_rescued(spark, target) == {}


def test_promotion_widens_a_column_and_reads_texts(spark, workdir):
    target = f"{workdir}/t"
    rows = [(1, None), (None, '{"k":"2.5","d":"2024-01-02","t":"x"}'), (None, '{"k":"3","d":"2024-01-03","t":"1"}')]
    Table(spark, target).write_load(spark.createDataFrame(rows, "k int, _rescued string"), "a")
    assert {k: v.simpleString() for k, v in rescued_types(Table(spark, target).read(), texts=True).items()} == {"d": "date", "k": "double", "t": "string"}
    assert promote_rescued(spark, target, texts=True) == {"d": "date", "k": "double", "t": "string"}
    got = Table(spark, target).read()
    assert sorted((r["k"], str(r["d"]), r["t"], r["_rescued"]) for r in got.collect()) == [(1.0, "None", None, None), (2.5, "2024-01-02", "x", None), (3.0, "2024-01-03", "1", None)]


def test_nothing_rescued_nothing_written(spark, workdir):
    target = f"{workdir}/t"
    Table(spark, target).write_load(spark.createDataFrame([(1, None)], "k int, _rescued string"), "a")
    assert promote_rescued(spark, target) == {} and len(Table(spark, target).commits()) == 1
