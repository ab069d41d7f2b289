from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sluice.context import RunContext
from sluice.functions.names import sanitize_name, unique_names
from sluice.operators.audit import AUDIT_COLUMNS, add_audit_columns
from sluice.operators.columns import sanitize_columns


def test_tagged_rows_are_the_rows_and_four_columns(spark):
    """Over a driver table: nothing of the rows changes, and every row carries the run, the load time, the format and the file."""
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    out = add_audit_columns(nation, "parquet", "nation.parquet", RunContext("r-1", dt.datetime(2024, 5, 1)))
    assert out.columns == [*nation.columns, *AUDIT_COLUMNS]
    assert [out.schema[c].nullable for c in AUDIT_COLUMNS] == [False] * 4
    assert out.select(*nation.columns).exceptAll(nation).count() == 0 and out.count() == nation.count()
    assert [tuple(r) for r in out.select(*AUDIT_COLUMNS).distinct().collect()] == [(dt.datetime(2024, 5, 1), "parquet", "nation.parquet", "r-1")]


def test_retag_drops_old_values_and_appends_at_end(spark):
    df = add_audit_columns(spark.createDataFrame([(1, "a")], "x int, y string"), "csv", "old.csv", RunContext("old"))
    df = df.select("load_dt", "x", "source_format", "y", "source_file", "run_id")
    out = add_audit_columns(df, "xml", "new.xml", RunContext("new"), keep_upstream_file=True)
    assert out.columns == ["x", "y", "upstream_source_file", *AUDIT_COLUMNS]
    row = out.first()
    assert (row["upstream_source_file"], row["source_file"], row["run_id"]) == ("old.csv", "new.xml", "new")


def test_retag_in_place_keeps_positions(spark):
    df = add_audit_columns(spark.createDataFrame([(1,)], "x int"), "csv", "a.csv").select("run_id", "x", "load_dt",
                                                                                          "source_file", "source_format")
    out = add_audit_columns(df, "json", "b.json", RunContext("z"), keep_position=True)
    assert out.columns == df.columns
    assert out.first()["run_id"] == "z"


def test_per_row_source_file_from_scan(spark):
    out = add_audit_columns(spark.read.parquet("/root/testdata/sf0.001/region.parquet"), "parquet", None)
    assert {r[0] for r in out.select("source_file").distinct().collect()} == {"region.parquet"}


def test_clean_names_are_parquet_safe_stable_and_distinct():
    for raw in ("customer id", "o:orderdate", "l-shipdate", "p.size", "a (b) {c};d,e=f\tg\nh", "", "___", "größe"):
        clean = sanitize_name(raw)
        assert not set(clean) & set(" ,;{}()\n\t=:-"), (raw, clean)
        assert sanitize_name(clean) == clean
    names = unique_names(["ship-date", "ship_date", "Ship date", "ship_date_2"])
    assert len({n.lower() for n in names}) == 4 and names[0] == "ship_date"


def test_sanitize_nested_columns(spark, workdir):
    df = spark.createDataFrame([(1, (2, [(3,)]))], "`a-b` int, `s:t` struct<`x y`: int, `l-l`: array<struct<`z.z`: int>>>")
    out = sanitize_columns(df)
    assert out.columns == ["a_b", "s_t"]
    assert out.schema["s_t"].dataType.simpleString() == "struct<x_y:int,l_l:array<struct<z_z:int>>>"
    out.write.parquet(f"{workdir}/p")
    assert spark.read.parquet(f"{workdir}/p").select(F.col("s_t.l_l")[0]["z_z"]).first()[0] == 3
