"""Records that span lines, read in splits: XML row tags, CSV values with line breaks; types that hold two types."""
from __future__ import annotations

import csv
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.types import SchemaConflict, widen
from sluice.plans.tables import Table
from sluice.sources import formats
from sluice.sources.records import RECORD, Follower, _odd_quotes, csv_records, xml_records


@pytest.fixture()
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def put(path, text):
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


# ------------------------------------------------------------------- XML ---

def test_xml_is_read_in_splits(small_splits, folder):
    spark = small_splits
    rows = [(i, f"text {i} & <b>\n  blanks ", None if i % 7 == 0 else float(i)) for i in range(1200)]
    df = spark.createDataFrame(rows, "id long, t string, v double").coalesce(1)
    formats.write(df, f"{folder}/x", "xml")
    got = formats.read(spark, f"{folder}/x", "xml", df.schema)
    assert got.rdd.getNumPartitions() >= 9
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_xml_attributes_prologue_empty_rows_and_similar_names(small_splits, folder):
    put(f"{folder}/a.xml", '<?xml version="1.0"?>\n<!-- head -->\n<records xmlns:ns="http://n">\n<recorder>no</recorder><record id="1"><ns:k ns:u="x">5</ns:k></record>'
        '<record/><record id="2"/>\n\n<record id="3"><recordings>7</recordings><e/></record  ></records>\n<!-- tail -->'.replace("</record  >", "</record>"))
    records = sorted(r[0] for r in xml_records(small_splits, f"{folder}/a.xml", "record").collect())
    assert records == ['<record id="1"><ns:k ns:u="x">5</ns:k></record>', '<record id="2"/>', '<record id="3"><recordings>7</recordings><e/></record>', "<record/>"]
    got = formats.read(small_splits, f"{folder}/a.xml", "xml", "_id int, recordings int").collect()
    assert sorted(map(tuple, got), key=str) == [(1, None), (2, None), (3, 7), (None, None)]


def test_an_end_tag_within_cdata_is_never_read_wrong(small_splits, folder):
    put(f"{folder}/a.xml", "<records><record><t><![CDATA[a</record>b]]></t></record><record><t>c</t></record></records>")
    with pytest.raises(Exception, match="rowSplit"):
        formats.read(small_splits, f"{folder}/a.xml", "xml", "t string").collect()
    assert sorted(r["t"] for r in formats.read(small_splits, f"{folder}/a.xml", "xml", "t string", rowSplit="false").collect()) == ["a</record>b", "c"]
    checked = formats.read_checked(small_splits, f"{folder}/a.xml", "xml", StructType.fromDDL("t string")).collect()
    assert [r["t"] for r in checked if r["_bad"] is None] == ["c"] and len([r for r in checked if r["_bad"] == "malformed"]) >= 1


# ------------------------------------------------------------------- CSV ---

def test_follower_against_the_whole_text():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice('ab"\n\n') for _ in range(rng.randint(1, 60)))
        if text.count('"') % 2:
            text += '"'
        lines = text.split("\n")
        want, open_ = [], None
        for line in lines:
            open_ = line if open_ is None else f"{open_}\n{line}"
            if open_.count('"') % 2 == 0:
                want.append(open_)
                open_ = None
        cuts = sorted(rng.sample(range(len(lines) + 1), min(2, len(lines))))
        got, pieces, inside = [], [], False
        for lo, hi in zip([0, *cuts], [*cuts, len(lines)], strict=True):  # blocks, each fed in two parts
            f = Follower(inside)
            mid = (lo + hi) // 2
            for a, b in ((lo, mid), (mid, hi)):
                part = pa.array(lines[a:b], pa.string())
                found = f.feed(part, _odd_quotes(part))
                got += found.to_pylist() if found is not None else []
            if hi > lo:
                head, tail = f.left()
                if head is not None:
                    pieces[-1].append(head)
                if tail is not None:
                    pieces.append([tail])
            inside = f.inside
        assert sorted(got + ["\n".join(p) for p in pieces]) == sorted(want)


def csv_text(rows, end="\r\n"):
    out = io.StringIO()
    writer = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator=end)
    writer.writerow(["id", "t"])
    writer.writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_values_with_line_breaks_are_read_in_splits(small_splits, folder, end):
    rng = random.Random(2)
    rows = [(str(i), "".join(rng.choice('ab ,"\n\r') for _ in range(rng.randint(0, 80)))) for i in range(1500)]
    rows[700] = ("700", "huge\n" * 6000 + 'with "quotes"\n')  # over several blocks
    rows[900] = ("900", "\n\n\n")
    os_files = {"a": rows[:1400], "b": rows[1400:1401], "c": rows[1401:]}
    for name, part in os_files.items():
        put(f"{folder}/{name}.csv", csv_text(part, end))
    got = formats.read(small_splits, folder, "csv", "id string, t string", quotedLines="true")
    assert csv_records(small_splits, folder).rdd.getNumPartitions() >= 9
    assert sorted(map(tuple, got.collect())) == sorted(rows)


def test_blank_lines_and_an_open_quote_at_the_end(small_splits, folder):
    put(f"{folder}/a.csv", 'id,t\n1,a\n\n   \n2,"b\nc"\n3,"open\nto the end')
    assert sorted(r[RECORD] for r in csv_records(small_splits, f"{folder}/a.csv").collect()) == ["1,a", '2,"b\nc"', '3,"open\nto the end']


def test_other_splits_than_counted_are_an_error(small_splits, folder):
    put(f"{folder}/a.csv", csv_text([(str(i), 'x\ny"z') for i in range(3000)]))
    df = csv_records(small_splits, f"{folder}/a.csv")
    small_splits.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    with pytest.raises(Exception, match="split otherwise"):
        df.count()


def test_another_header_is_refused(spark, folder):
    put(f"{folder}/a.csv", "t,id\nx,1\n")
    with pytest.raises(ValueError, match="header"):
        formats.read(spark, f"{folder}/a.csv", "csv", "id string, t string", quotedLines="true")


# ----------------------------------------------------------------- types ---

def test_widen_finds_the_narrowest_common_type():
    w = lambda a, b: widen(StructType.fromDDL(f"x {a}"), StructType.fromDDL(f"x {b}")).fields[0].dataType.simpleString()
    assert [w("int", "bigint"), w("bigint", "smallint"), w("bigint", "decimal(10,2)"), w("decimal(38,10)", "decimal(30,2)"), w("int", "double"), w("float", "int")] == [
        "bigint", "bigint", "decimal(22,2)", "decimal(38,10)", "double", "double"]
    assert w("date", "timestamp_ntz") == "timestamp_ntz"
    assert w("struct<a:int,b:string>", "struct<c:date,a:bigint>") == "struct<a:bigint,b:string,c:date>"
    assert w("array<struct<a:int>>", "array<struct<a:double>>") == "array<struct<a:double>>" and w("map<string,int>", "map<string,bigint>") == "map<string,bigint>"
    for a, b in (("string", "int"), ("struct<a:int>", "struct<a:string>"), ("timestamp_ntz", "timestamp")):
        with pytest.raises(SchemaConflict):
            w(a, b)


def test_loads_of_other_types_read_as_one_table(spark, workdir):
    t = Table(spark, f"{workdir}/t")
    t.write_load(spark.sql("SELECT 1 AS k, 7 AS v, named_struct('a', 1) AS s"), "a")
    t.write_load(spark.sql("SELECT 2 AS k, 2.5D AS v, named_struct('b', 'x', 'a', 3000000000) AS s"), "b")
    t.write_load(spark.sql("SELECT 3 AS k, 9 AS v, named_struct('a', 5) AS s, 'new' AS n"), "c")
    got = t.read().orderBy("k")
    assert got.schema.simpleString() == "struct<k:int,v:double,s:struct<a:bigint,b:string>,n:string>"
    assert [(r["k"], r["v"], tuple(r["s"]), r["n"]) for r in got.collect()] == [(1, 7.0, (1, None), None), (2, 2.5, (3000000000, "x"), None), (3, 9.0, (5, None), "new")]
    assert t.read(with_load_id=True).filter("load_id = 'a'").count() == 1
    for i in range(4):
        t.write_load(spark.sql("SELECT 4 AS k, 1.5D AS v"), f"more{i}")
    assert t.read()._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2  # a scan for each set of types, not for each load
    assert np.isclose(t.read().agg(F.sum("v")).first()[0], 7 + 2.5 + 9 + 6)
