"""Profiles, time gaps (vs brute force), date dimension, entry contract."""
from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators.profile import entity_profile, profile_table, time_gaps
from sluice.plans.model import (LAYOUTS, date_span, dim_date, facts_by_date, files_read, read_layout,
                                write_layouts)


def brute_gaps(pdf):
    out = {}
    for user, g in pdf.sort_values("ts").groupby("user_id"):
        d = g["ts"].diff().dropna().dt.total_seconds()
        out[user] = (len(g), d.min() if len(d) else None, d.max() if len(d) else None)
    return out


def test_time_gaps_match_brute_force_with_a_hot_user(spark, events):
    hot = events.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    got = {r["user_id"]: (r["n_events"], r["min_gap_s"], r["max_gap_s"])
           for r in time_gaps(hot, "user_id", "ts").collect()}
    want = brute_gaps(hot.select("user_id", "ts").toPandas())
    assert set(got) == set(want)
    for k, (n, lo, hi) in want.items():
        gn, glo, ghi = got[k]
        assert gn == n
        assert (lo is None and glo is None) or abs(glo - lo) < 1e-6
        assert (hi is None and ghi is None) or abs(ghi - hi) < 1e-6


def test_entity_profile(spark, events):
    p = entity_profile(events, "user_id", "ts", "event_type")
    assert p.count() == events.select("user_id").distinct().count()
    assert p.agg(F.sum("n_events")).first()[0] == events.count()


def test_profile_table_counts(spark, events):
    df = events.withColumn("event_type", F.nullif("event_type", F.lit("error")))
    rows = {r["column_name"]: r for r in profile_table(df).collect()}
    assert rows["event_type"]["n_nulls"] == events.filter("event_type = 'error'").count()
    assert rows["event_id"]["n_distinct"] == events.count()
    assert rows["ts"]["min_ts"] == events.agg(F.min("ts")).first()[0]
    approx = {r["column_name"]: r for r in profile_table(df, approx_distinct=True).collect()}
    assert abs(approx["event_id"]["n_distinct"] - events.count()) <= 0.05 * events.count()


def test_dim_date_covers_span(spark):
    span = spark.createDataFrame([("2024-02-27", "2024-03-02")], "a string, b string") \
        .select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    dim = dim_date(date_span([(span, "a"), (span, "b")])).orderBy("date").collect()
    assert [r["date_key"] for r in dim] == [20240227, 20240228, 20240229, 20240301, 20240302]
    assert [r["day_of_week"] for r in dim] == [2, 3, 4, 5, 6]
    assert [r["is_weekend"] for r in dim] == [False, False, False, False, True]


def test_entry_contract(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    rows = {r["slice_id"]: r["n_rows"] for r in df.collect()}
    assert rows == {1: 600, 2: 450, 3: 300, 4: 150}


def test_epoch_micros_ignores_session_zone(spark):
    from sluice.functions.dates import epoch_micros

    df = spark.createDataFrame([("2024-03-10 01:00:00.000001",), ("2024-03-10 04:00:00.5",), ("1969-12-31 23:59:59",)],
                               "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(epoch_micros(F.col("ts"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [1710032400000001, 1710043200500000, -1000000]


def test_gaps_of_missing_tied_and_zoned_times(spark):
    rows = [(1, None), (1, "2024-03-10 06:30:00"), (1, "2024-03-10 07:30:00"), (2, None), (2, None), (3, "2024-01-01 00:00:00"),
            (3, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:00"), (None, "2024-01-01 00:00:05")]
    df = spark.createDataFrame(rows, "e int, s string")
    want = {1: (3, 3600.0, 3600.0), 2: (2, None, None), 3: (2, 0.0, 0.0), None: (2, 5.0, 5.0)}
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone, kind in (("UTC", "timestamp_ntz"), ("UTC", "timestamp"), ("America/New_York", "timestamp")):
            # instants written in UTC: in New York the clock is put forward between the first two
            spark.conf.set("spark.sql.session.timeZone", zone)
            at = F.col("s").cast(kind) if zone == "UTC" else F.concat("s", F.lit("Z")).cast(kind)
            got = {r["e"]: (r["n_events"], r["min_gap_s"], r["max_gap_s"]) for r in time_gaps(df.withColumn("t", at), "e", "t").collect()}
            assert got == want, (zone, kind)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_profile_is_exact_and_covers_every_type(spark):
    df = spark.createDataFrame([(9007199254740993, True, b"a", [1], {"k": 1}, 1.5), (2, None, b"a", None, {"k": 2}, None)],
                               "big long, flag boolean, raw binary, list array<int>, map map<string,int>, x double")
    got = {r["column_name"]: r for r in profile_table(df).collect()}
    assert set(got) == set(df.columns)
    assert (got["big"]["min_int"], got["big"]["max_int"]) == ("2", "9007199254740993")
    assert (got["flag"]["n_nulls"], got["flag"]["max_str"]) == (1, "true")
    assert [got[c]["n_distinct"] for c in ("big", "flag", "raw", "list", "map", "x")] == [2, 1, 1, 1, 2, 1]


def test_facts_without_a_date_are_kept(spark):
    import datetime as dt

    facts = spark.createDataFrame([(dt.date(2024, 1, 1), 2.0), (None, 3.0)], "d date, v double")
    dim = dim_date(date_span([(facts, "d")]))
    got = facts_by_date({"f": (facts, "d", {"total": F.sum("v")})}, dim).collect()
    assert sorted((r["date_key"], r["f_total"]) for r in got) == [(-1, 3.0), (20240101, 2.0)]


def test_layouts_spread_a_hot_date_keep_every_row_and_prune(spark, workdir):
    import datetime as dt

    hot = dt.datetime(2024, 3, 5)
    rows = [(i, hot if i % 3 else dt.datetime(2024, 1, 1) + dt.timedelta(days=i % 180), float(i)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, d timestamp_ntz, v double").cache()
    paths = write_layouts(df, "d", workdir, num_files=6)
    want = sorted(map(tuple, df.collect()))
    read = {}
    for layout in LAYOUTS:
        everything = read_layout(spark, paths[layout], layout, "d", "2000-01-01 00:00:00", "2100-01-01 00:00:00")
        assert sorted(map(tuple, everything.select("id", "d", "v").collect())) == want, layout
        some = read_layout(spark, paths[layout], layout, "d", "2024-02-01 00:00:00", "2024-03-01 00:00:00")
        assert some.count() == sum(1 for r in want if dt.datetime(2024, 2, 1) <= r[1] < dt.datetime(2024, 3, 1))
        read[layout] = files_read(some).first()
        if layout == "partitioned":
            plan = some._jdf.queryExecution().executedPlan().toString()
            assert "PartitionFilters: []" not in plan and "ship_month" in plan.split("PartitionFilters:")[1][:200]
    assert read["partitioned"]["n_bytes"] < read["plain"]["n_bytes"]
    # two thirds of the rows share one date: range partitioning with a row-hash tiebreak cuts it
    per_file = (spark.read.parquet(paths["range_sorted"]).where(F.col("d") == F.lit(hot))
                .groupBy(F.input_file_name()).count().collect())
    assert len(per_file) > 1
    assert max(r["count"] for r in per_file) < 2000


def test_event_log_summary_does_not_depend_on_the_number_of_files(spark):
    from sluice.suite import QUERIES

    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        got = {r["message"] for r in QUERIES["event_log_summary"](spark, "/root/testdata/sf0.001").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    n = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert got == {f"loaded {n} rows", f"bronze.events passed with {n} rows", "loaded 0 rows"}


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace

    from sluice.context import scratch_root

    none = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=none)
    try:
        scratch_root(session)
    except RuntimeError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a temporary folder was taken")
