"""Checks, expectations, quarantine, key overlap; SCD2, upserts, reconcile."""
from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from sluice.operators.history import latest_per_key, reconcile, scd2_apply, upsert
from sluice.operators.quality import (Expectation, check_result, expect, expectation_report, key_overlap,
                                      quarantine, sanity_check)
from sluice.plans.merge import merge_into
from sluice.plans.scd2 import RepeatedSnapshot, Scd2Table
from sluice.plans.tables import Table


def test_sanity_check_messages(spark, events):
    ok = check_result(sanity_check(events, "t", columns=("event_id",)))
    assert ok == {"table": "t", "row_count": events.count(), "passed": True, "failures": []}
    n = events.count()
    k = events.filter("event_type = 'error'").count()
    broken = events.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    res = check_result(sanity_check(broken, "t", columns=("user_id", "load_dt"), required_columns=("zz",)))
    assert res["failures"] == [f"user_id has {k} null values out of {n}", "missing required column zz"]
    odd = check_result(sanity_check(broken.withColumnRenamed("user_id", "100% of {n}"), "t", columns=("100% of {n}",)))
    assert odd["failures"] == [f"100% of {{n}} has {k} null values out of {n}"]
    empty = check_result(sanity_check(events.limit(0), "t"))
    assert empty["failures"] == ["row_count is 0"] and not empty["passed"]


def test_expectation_counts_null_as_violation(spark, events):
    df = events.withColumn("event_type", F.nullif("event_type", F.lit("error")))
    rep = {r["expectation"]: r["violations"] for r in
           expectation_report(df, [Expectation("nv", "event_type <> 'view'")]).collect()}
    naive = df.filter("NOT (event_type <> 'view')").count()
    assert rep["nv"] == naive + df.filter("event_type IS NULL").count()


def test_expect_observes_during_the_action(spark, events):
    kept, obs = expect(events, [Expectation("pos", "value > 5", "drop")])
    n_kept = kept.count()
    assert obs.get["pos"] + n_kept == events.count()


def test_quarantine_partitions_input(spark):
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    valid, rejected = quarantine(cust, {"neg": "c_acctbal < 0", "mach": "c_mktsegment = 'MACHINERY'"})
    assert valid.count() + rejected.count() == cust.count()
    assert valid.unionByName(rejected.drop("reasons")).exceptAll(cust).count() == 0
    both = rejected.filter(F.size("reasons") == 2).count()
    assert both == cust.filter("c_acctbal < 0 AND c_mktsegment = 'MACHINERY'").count()


def test_key_overlap_counts(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k long")
    parent = spark.createDataFrame([(1,), (3,), (4,)], "k long")
    r = key_overlap(child, "k", parent, "k", "c->p").first()
    assert (r["child_keys"], r["matched_keys"], r["orphan_keys"], r["pct_matched"]) == (3, 2, 1, 66.67)


def test_latest_per_key_handles_a_hot_key(spark):
    hot = spark.range(0, 50000).select(F.lit(7).alias("k"), F.col("id").alias("v"))
    other = spark.range(0, 100).select(F.col("id").alias("k"), F.col("id").alias("v"))
    got = {r["k"]: r["v"] for r in latest_per_key(hot.unionByName(other), ["k"], ["v"]).collect()}
    assert got[7] == 49999 and got[3] == 3 and len(got) == 100


def test_upsert_keeps_newer_and_ignores_late(spark):
    t = spark.createDataFrame([(1, 10, "a"), (2, 10, "b")], "k int, ts int, v string")
    u = spark.createDataFrame([(1, 11, "new"), (2, 9, "late"), (3, 1, "ins")], "k int, ts int, v string")
    got = sorted(map(tuple, upsert(t, u, ["k"], ["ts"]).collect()))
    assert got == [(1, 11, "new"), (2, 10, "b"), (3, 1, "ins")]


def test_reconcile_aligns_schemas(spark):
    a = spark.createDataFrame([(1, "2024-01-01", "x")], "k int, d string, v string")
    b = spark.createDataFrame([(1, 5, "y")], "k long, extra int, v string")
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    schema = StructType([StructField("k", LongType()), StructField("v", StringType()), StructField("d", StringType())])
    got = reconcile([a, b.withColumn("d", F.lit("2024-02-01"))], schema, ["k"], ["d"]).collect()
    assert [tuple(r) for r in got] == [(1, "y", "2024-02-01")]


def ts(s):
    return F.lit(s).cast("timestamp_ntz")


def test_scd2_invariants(spark):
    s1 = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    s2 = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (4, "d")], "k int, v string")
    s3 = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")
    h = scd2_apply(None, s1, ["k"], ["v"], ts("2024-01-01"))
    second = scd2_apply(h, s2, ["k"], ["v"], ts("2024-02-01"))
    third = scd2_apply(second.filter("is_current"), s3, ["k"], ["v"], ts("2024-03-01"))
    h = second.filter("NOT is_current").unionByName(third)
    key = lambda t: tuple(str(x) for x in t)
    rows = sorted(((r["k"], r["v"], r["valid_from"], r["valid_to"], r["is_current"]) for r in h.collect()), key=key)
    d = dt.datetime
    assert rows == sorted([
        (1, "a", d(2024, 1, 1), None, True),                      # absent from s3: stays open
        (2, "B", d(2024, 2, 1), None, True),
        (2, "b", d(2024, 1, 1), d(2024, 2, 1), False),
        (3, None, d(2024, 1, 1), d(2024, 3, 1), False),           # NULL → NULL is no change
        (3, "c", d(2024, 3, 1), None, True),
        (4, "d", d(2024, 2, 1), None, True),
    ], key=key)
    assert h.groupBy("k").agg(F.sum(F.col("is_current").cast("int")).alias("c")).filter("c != 1").count() == 0


def test_upsert_ties_and_new_columns(spark):
    t = spark.createDataFrame([(1, 10, 1, 10.0), (2, 10, 1, 7.0)], "k int, ts int, load int, v double")
    u = spark.createDataFrame([(1, 10, 2, 5.0, "x")], "k int, ts int, load int, v double, extra string")
    got = sorted(map(tuple, upsert(t, u, ["k"], ["ts", "load"]).collect()))
    assert got == [(1, 10, 2, 5.0, "x"), (2, 10, 1, 7.0, None)]


def test_merge_into_is_one_shuffle_and_replays_are_no_ops(spark, workdir, events):
    t = Table(spark, f"{workdir}/silver")
    versions = events.unionByName(events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 2 HOURS")).withColumn("value", F.lit(2.0)))
    assert merge_into(t, versions, ["event_id"], ["ts"], "v1") == events.count()
    few = events.filter("event_id < 4")
    batch = few.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 HOURS")).withColumn("value", F.lit(3.0)) \
        .unionByName(few.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR")).withColumn("value", F.lit(1.0)))
    plan = upsert(t.read(), batch, ["event_id"], ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    merge_into(t, batch, ["event_id"], ["ts"], "v2")
    assert merge_into(t, batch, ["event_id"], ["ts"], "v2") == 0
    after = t.read()
    assert after.count() == events.count()
    assert after.filter("value = 3.0").count() == 4 and after.filter("value = 1.0").count() == 0


def test_scd2_refuses_repeated_times_and_keeps_null_keys_once(spark, workdir):
    s1 = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    dim = Scd2Table(spark, f"{workdir}/dim", ["k"], ["v"])
    d = dt.datetime
    dim.apply(s1, d(2024, 2, 1), "a")
    dim.apply(s1, d(2024, 3, 1), "b")
    assert dim.apply(spark.createDataFrame([(1, "A")], "k int, v string"), d(2024, 4, 1), "c") == 1
    assert dim.apply(spark.createDataFrame([(1, "B")], "k int, v string"), d(2024, 4, 1), "c") == 0
    with pytest.raises(RepeatedSnapshot):
        dim.apply(s1, d(2024, 3, 1), "d")
    rows = sorted((tuple(r) for r in dim.read().collect()), key=str)
    assert rows == sorted([(1, "a", d(2024, 2, 1), d(2024, 4, 1), False), (1, "A", d(2024, 4, 1), None, True),
                           (None, "n", d(2024, 2, 1), None, True)], key=str)
    assert [c["rows"] for c in dim.closed_rows.commits()] == [0, 0, 1]


def _history(observed, tracked):
    """Versions by plain Python: ``observed`` is ``{as_of: {key: attributes}}``."""
    out = []
    for key in {k for snap in observed.values() for k in snap}:
        mine = [(t, snap[key]) for t, snap in sorted(observed.items()) if key in snap]
        kept = [x for i, x in enumerate(mine) if i == 0 or x[1][:tracked] != mine[i - 1][1][:tracked]]
        ends = [t for t, _ in kept[1:]] + [None]
        out += [(key, *v, t, e, e is None) for (t, v), e in zip(kept, ends, strict=True)]
    return sorted(out, key=str)


def test_scd2_is_the_same_in_all_six_orders(spark, workdir):
    d = dt.datetime
    snaps = {d(2024, 1, 1): {1: ("a", "x"), 2: ("b", None), None: ("n", "x")},
             d(2024, 2, 1): {1: ("B", "y"), 2: ("b", "z"), 3: (None, "x")},
             d(2024, 3, 1): {1: ("a", "x"), 3: (None, "w"), None: ("n", "x")}}
    want = _history(snaps, 1)
    for i, order in enumerate(itertools.permutations(sorted(snaps))):
        dim = Scd2Table(spark, f"{workdir}/dim{i}", ["k"], ["v"])
        for t in order:
            dim.apply(spark.createDataFrame([(k, *v) for k, v in snaps[t].items()], "k int, v string, w string"), t, f"{t:%m}")
        assert sorted((tuple(r) for r in dim.read().collect()), key=str) == want, order
        assert dim.applied() == sorted(snaps)


def test_scd2_unchanged_snapshots_count(spark, workdir):
    """January a, March a, then February b: March's snapshot moved nothing, but it ends b."""
    d, row = dt.datetime, lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    dim = Scd2Table(spark, f"{workdir}/dim", ["k"], ["v"])
    assert [dim.apply(row(v), d(2024, m, 1), f"m{m}") for v, m in (("a", 1), ("a", 3), ("b", 2))] == [0, 0, 1]
    assert [tuple(r) for r in dim.read().orderBy("valid_from").collect()] == [
        (1, "a", d(2024, 1, 1), d(2024, 2, 1), False), (1, "b", d(2024, 2, 1), d(2024, 3, 1), False), (1, "a", d(2024, 3, 1), None, True)]
    dim.apply(row("a"), d(2024, 2, 15), "mid")  # ends b earlier
    dim.apply(row("a"), d(2024, 1, 15), "more")  # changes nothing
    assert [r["valid_from"] for r in dim.read().orderBy("valid_from").collect()] == [d(2024, 1, 1), d(2024, 2, 1), d(2024, 2, 15)]


def test_scd2_new_attributes_and_repeated_keys(spark, workdir):
    d = dt.datetime
    dim = Scd2Table(spark, f"{workdir}/dim", ["k"], ["v", "extra"])
    dim.apply(spark.createDataFrame([(1, "a")], "k int, v string"), d(2024, 2, 1), "b")
    dim.apply(spark.createDataFrame([(1, "a", 5), (1, "a", 4)], "k int, v string, extra int"), d(2024, 3, 1), "c")
    dim.apply(spark.createDataFrame([(1, "a", 5)], "k int, v string, extra int"), d(2024, 1, 1), "a")
    assert [tuple(r) for r in dim.read().orderBy("valid_from").collect()] == [
        (1, "a", 5, d(2024, 1, 1), d(2024, 2, 1), False), (1, "a", None, d(2024, 2, 1), d(2024, 3, 1), False), (1, "a", 5, d(2024, 3, 1), None, True)]


def test_scd2_survives_a_stop_between_its_tables(spark, workdir, monkeypatch):
    d, row = dt.datetime, lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    dim = Scd2Table(spark, f"{workdir}/dim", ["k"], ["v"])
    dim.apply(row("a"), d(2024, 1, 1), "a")
    before = dim.read().collect()
    with monkeypatch.context() as m:
        m.setattr(dim.open_rows, "write_load", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            dim.apply(row("b"), d(2024, 3, 1), "b")
    assert dim.read().collect() == before
    dim.apply(row("c"), d(2024, 2, 1), "c")
    dim.apply(row("b"), d(2024, 3, 1), "b")
    assert [(r["v"], r["valid_to"]) for r in dim.read().orderBy("valid_from").collect()] == [("a", d(2024, 2, 1)), ("c", d(2024, 3, 1)), ("b", None)]
