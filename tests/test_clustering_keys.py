"""Clustering on several columns, and keys found in the data, against plain Python."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators.dependencies import inclusion_dependencies
from sluice.plans.clustering import curve_key, files_met, write_clustered


def test_curve_keeps_neighbours_and_every_row(spark, workdir):
    rng = random.Random(1)
    day = dt.datetime(2024, 1, 1)
    rows = [(i, rng.choice([None, *range(1000)]), day + dt.timedelta(minutes=rng.randrange(10**6)), rng.choice(["aa", "b", "ü", "", None])) for i in range(8000)]
    df = spark.createDataFrame(rows, "id long, n int, t timestamp_ntz, s string").cache()
    write_clustered(df, ["t", "n"], f"{workdir}/both", 36)
    write_clustered(df, ["t"], f"{workdir}/one", 36)
    assert sorted(map(tuple, spark.read.parquet(f"{workdir}/both").collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    met = lambda kind, **r: files_met(spark, f"{workdir}/{kind}", r).first()
    month = (dt.datetime(2024, 6, 1), dt.datetime(2024, 7, 1))
    assert met("one", n=(100, 120))["n_files"] == 36 and met("both", n=(100, 120))["n_files"] <= 14
    assert met("both", n=(100, 120), t=month)["n_files"] <= 4 < 36 == met("both", n=(0, 2000))["all_files"]
    assert met("both", n=(5000, 6000))["n_files"] == 0


def test_files_met_hold_all_rows_of_the_filter(spark, workdir):
    df = spark.range(5000).selectExpr("id % 97 AS a", "(id * 7919) % 1009 AS b", "cast(id AS string) AS s")
    write_clustered(df, ["a", "b", "s"], f"{workdir}/c", 20)
    wanted = spark.read.parquet(f"{workdir}/c").filter("a >= 10 AND a < 20 AND b >= 100 AND b < 300")
    hold = wanted.select(F.input_file_name()).distinct().count()
    assert 0 < hold <= files_met(spark, f"{workdir}/c", {"a": (10, 20), "b": (100, 300)}).first()["n_files"] < 20


def test_hard_columns(spark, workdir):
    same = spark.createDataFrame([(1, None, float("nan"))] * 50 + [(1, None, 2.0)] * 50, "a int, b string, c double")
    write_clustered(same, ["a", "b", "c"], f"{workdir}/same", 4)
    assert spark.read.parquet(f"{workdir}/same").count() == 100
    assert curve_key(same.limit(0), ["a", "b"]).count() == 0
    with pytest.raises(ValueError, match="cluster"):
        curve_key(spark.sql("SELECT array(1) AS a"), ["a"])


def test_keys_against_all_pairs(spark):
    rng = random.Random(3)
    long_ = "long text " * 10
    parent = [(i, f"n{i}", long_ + str(i)) for i in range(40)]
    child = [(rng.choice([None, *range(40)]), rng.randrange(50), f"n{rng.randrange(40)}", long_ + str(rng.randrange(40)), None) for _ in range(500)]
    other = [(i % 39, i, 1.5) for i in range(40)]
    frames = {"p": spark.createDataFrame(parent, "id int, name string, body string"), "c": spark.createDataFrame(child, "pid long, wide int, pname string, pbody string, none string"),
              "o": spark.createDataFrame(other, "again short, id long, x double")}
    got = {tuple(r) for r in inclusion_dependencies(frames).collect()}
    columns = {(t, f): [r[i] for r in rows] for t, fields, rows in (("p", ("id", "name", "body"), parent), ("c", ("pid", "wide", "pname", "pbody", "none"), child), ("o", ("again", "id"), other))
               for i, f in enumerate(fields)}
    want = set()
    for a, va in columns.items():
        for b, vb in columns.items():
            inside = {v for v in va if v is not None}
            if a != b and inside and None not in vb and len(set(vb)) == len(vb) and inside <= set(vb):
                want.add((*a, *b, len(inside), len(vb)))
    assert got == want and ("c", "pid", "p", "id", 40, 40) in got


def test_tables_without_values(spark):
    assert inclusion_dependencies({"a": spark.createDataFrame([], "x int"), "b": spark.createDataFrame([(1.5,)], "y double")}).count() == 0
    assert inclusion_dependencies({"b": spark.createDataFrame([(1.5,)], "y double")}).count() == 0
