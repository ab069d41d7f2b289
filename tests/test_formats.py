"""Lossless text formats, the format registry and source specs."""
from __future__ import annotations

import datetime as dt

import pytest

from sluice.sources import Registry, SourceSpec, formats
from sluice.operators.columns import sanitize_columns

AWKWARD = [
    (1, None, dt.datetime(2024, 1, 1, 0, 0, 0, 123456)),
    (2, "", dt.datetime(2024, 1, 1, 0, 0, 0, 1)),
    (3, 'he said "hi", then left', None),
    (4, "line one\nline two\r\nline three", dt.datetime(1999, 12, 31, 23, 59, 59, 999999)),
    (5, "back\\slash <b>markup</b> & 'quotes'", dt.datetime(2024, 2, 29, 12, 0, 0)),
    (6, "  outer blanks  ", dt.datetime(2024, 3, 10, 2, 30, 0)),
    (7, "\\N", None),
    (8, "\\\\N", None),
    (9, "N", None),
]
SCHEMA = "id long, text string, ts timestamp_ntz"


@pytest.mark.parametrize("fmt", ["csv", "json", "xml", "parquet"])
def test_roundtrip_is_lossless(spark, workdir, fmt):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    options = {"quotedLines": "true"} if fmt == "csv" else {}
    formats.write(df.repartition(3), f"{workdir}/{fmt}", fmt, **options)
    back = formats.read(spark, f"{workdir}/{fmt}", fmt, schema=df.schema, **options)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_with_line_breaks_is_refused_unless_asked_for(spark, workdir):
    df = spark.createDataFrame(AWKWARD, SCHEMA)
    with pytest.raises(Exception, match="line break"):
        formats.write(df, f"{workdir}/a", "csv")
    flat = df.filter("id <> 4")
    formats.write(flat, f"{workdir}/b", "csv")
    assert sorted(formats.read(spark, f"{workdir}/b", "csv", schema=df.schema).collect()) == sorted(flat.collect())


def test_a_large_csv_file_is_read_in_splits(spark, workdir):
    df = spark.range(60_000).selectExpr("id", "repeat('text ', 8) AS t")
    formats.write(df.coalesce(1), f"{workdir}/one", "csv")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
        back = formats.read(spark, f"{workdir}/one", "csv", schema=df.schema)
        assert back.rdd.getNumPartitions() >= 5
        assert back.count() == 60_000 and back.agg({"id": "sum"}).first()[0] == sum(range(60_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("fmt", ["csv", "json", "xml"])
def test_events_microseconds_survive(spark, workdir, events, fmt):
    formats.write(events, f"{workdir}/{fmt}", fmt)
    back = formats.read(spark, f"{workdir}/{fmt}", fmt, schema=events.schema)
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0


@pytest.mark.parametrize("fmt", ["csv", "json", "xml"])
def test_empty_write_reads_back_with_schema(spark, workdir, fmt):
    df = spark.createDataFrame([], SCHEMA)
    formats.write(df, f"{workdir}/{fmt}", fmt)
    back = formats.read(spark, f"{workdir}/{fmt}", fmt, schema=df.schema)
    assert back.count() == 0 and back.columns == ["id", "text", "ts"]


def test_unknown_format_lists_known(spark):
    with pytest.raises(ValueError, match="Known"):
        formats.read(spark, "/nowhere", "avro-ish")


def test_xml_attributes_and_colliding_names(spark, workdir):
    xml = ('<records><record id="7"><node-id>1</node-id><node_id>2</node_id><street name>x</street name></record>'
           '</records>').replace("<street name>x</street name>", "<street.name>x</street.name>")
    spark.createDataFrame([(xml,)], "value string").coalesce(1).write.text(f"{workdir}/x")
    df = formats.read(spark, f"{workdir}/x", "xml")
    clean = sanitize_columns(df)
    assert clean.columns == ["_id", "node_id", "node_id_2", "street_name"]
    clean.write.parquet(f"{workdir}/p")
    assert spark.read.parquet(f"{workdir}/p").first()["street_name"] == "x"


def test_registry_inheritance_and_errors():
    reg = Registry({
        "raw": {"path": "/v/raw/incoming/streets.csv", "format": "csv", "description": "streets"},
        "bronze": {"source_key": "raw", "technique": "copy_into", "target": "cat.bronze.street_conditions"},
    })
    spec = reg.get("bronze")
    assert (spec.path, spec.format, spec.description, spec.technique) == (
        "/v/raw/incoming/streets.csv", "csv", "streets", "copy_into")
    assert spec.source_file == "streets.csv"
    assert spec.target_name == "street_conditions"
    assert spec.target_path("/lake") == "/lake/cat/bronze/street_conditions"
    with pytest.raises(KeyError, match="Known keys"):
        reg.get("nope")
    with pytest.raises(KeyError, match="unknown source_key"):
        Registry({"a": {"source_key": "zz"}}).get("a")
    with pytest.raises(ValueError):
        Registry({"a": {"bogus": 1}})


def test_child_fields_win():
    reg = Registry({"base": {"path": "/a", "format": "csv"}, "child": {"source_key": "base", "format": "json"}})
    assert reg.get("child").format == "json"
    assert isinstance(reg.get("child"), SourceSpec)
