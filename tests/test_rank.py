"""Global rank and chronological slicing: exact against a brute-force rank."""
from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sluice.context import FIXED_CONTEXT
from sluice.operators.rank import global_rank, order_keys, plan_slices, row_hash, slice_bounds, slice_shares
from sluice.plans.chunking import DEFAULT_PLAN, SliceTarget, read_slices, run_chunking

SF = "/root/testdata/sf0.001"


def brute_rank(df, order_by):
    keys = order_keys(df, order_by)
    w = Window.orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    return df.withColumn("rank", F.row_number().over(w).cast("long"))


def same_rows(a, b):
    return sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_a_plan_that_leaves_rows_out_is_refused(spark, parts, workdir):
    assert slice_bounds(10, [t.percent for t in DEFAULT_PLAN])[-1] == (10, 10)
    with pytest.raises(ValueError):
        run_chunking(parts, "o_orderdate", workdir, plan=[SliceTarget("a", 50, "csv"), SliceTarget("b", 40, "csv")])


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 11, 100, 12345])
def test_slice_bounds_are_contiguous_and_complete(n):
    b = slice_bounds(n, [40, 30, 20, 10])
    assert b[0][0] == 1 and b[-1][1] == n
    for (s0, e0), (s1, _) in zip(b, b[1:]):
        assert s1 == e0 + 1
    assert sum(max(0, e - s + 1) for s, e in b) == n
    if n == 100:
        assert [e - s + 1 for s, e in b] == [40, 30, 20, 10]


@pytest.fixture(scope="module")
def parts(spark):
    """The first 250 orders by key; several share a date."""
    return spark.read.parquet(f"{SF}/orders.parquet").orderBy("o_orderkey").limit(250).cache()


def test_slices_follow_the_order_date(spark, parts, workdir):
    res = run_chunking(parts, "o_orderdate", workdir, source_name="orders", ctx=FIXED_CONTEXT)
    back = read_slices(spark, res)
    dates = sorted(r[0] for r in parts.select("o_orderdate").collect())
    got = {r["slice_id"]: r for r in back.groupBy("slice_id").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"), F.count(F.lit(1)).alias("n")).collect()}
    for i, (start, end) in enumerate(slice_bounds(250, [40, 30, 20, 10]), start=1):
        assert (got[i]["lo"], got[i]["hi"], got[i]["n"]) == (dates[start - 1], dates[end - 1], end - start + 1)
    names = {(r[0], r[1]) for r in back.select("slice_id", "source_file").distinct().collect()}
    assert names == {(i, f"orders[rows {a}-{b}]") for i, (a, b) in enumerate(slice_bounds(250, [40, 30, 20, 10]), start=1)}
    assert same_rows(back.select(*parts.columns), parts)


def test_row_order_of_the_input_does_not_matter(spark, parts, workdir):
    first = read_slices(spark, run_chunking(parts, "o_orderdate", workdir + "/a", ctx=FIXED_CONTEXT))
    second = read_slices(spark, run_chunking(parts.orderBy(F.rand(7)), "o_orderdate", workdir + "/b", ctx=FIXED_CONTEXT))
    assert same_rows(first, second)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 9, 10, 11])
def test_rank_matches_brute_force_small_n(spark, events, n):
    df = events.orderBy("event_id").limit(n).orderBy(F.rand(3))
    assert same_rows(global_rank(df, "ts", num_buckets=4).frame, brute_rank(df, "ts"))


def test_rank_with_ties_and_nulls(spark, events):
    # every date tied except some NULLs: order decided entirely by the tiebreak columns
    df = events.withColumn("ts", F.when(F.col("event_type") == "error", None)
                           .otherwise(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    got = global_rank(df, "ts", num_buckets=8)
    assert got.n == events.count()
    assert same_rows(got.frame, brute_rank(df, "ts"))
    # nulls first
    n_null = df.filter(F.col("ts").isNull()).count()
    assert got.frame.filter(F.col("rank") <= n_null).filter(F.col("ts").isNotNull()).count() == 0


def test_rank_duplicate_rows_are_split_across_buckets(spark, events):
    hot = events.select("user_id", "event_type").limit(1)
    dup = hot.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(400)))).drop("x")  # 400 identical rows
    df = dup.unionByName(events.select("user_id", "event_type"))
    got = global_rank(df, "user_id", num_buckets=8)
    assert sorted(r[0] for r in got.frame.select("rank").collect()) == list(range(1, got.n + 1))
    assert max(got.bucket_counts) < 400  # the hot run is spread over several buckets


def test_rank_plan_has_no_single_partition_exchange(spark, events, workdir):
    got = global_rank(events, "ts", num_buckets=4)
    plan = got.frame._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_slice_shares(spark, parts, workdir):
    res = run_chunking(parts, "o_orderdate", workdir, ctx=FIXED_CONTEXT)
    rows = {r["slice_id"]: (r["n_rows"], r["pct_of_total"], r["total_rows"])
            for r in slice_shares(read_slices(spark, res)).collect()}
    assert rows == {1: (100, 40.0, 250), 2: (75, 30.0, 250), 3: (50, 20.0, 250), 4: (25, 10.0, 250)}


def test_empty_input_gives_empty_slices_that_read_back(spark, parts, workdir):
    res = run_chunking(parts.limit(0), "o_orderdate", workdir, ctx=FIXED_CONTEXT)
    assert res.counts == {"chunk1": 0, "chunk2": 0, "chunk3": 0, "chunk4": 0}
    back = read_slices(spark, res)
    assert back.count() == 0 and "o_orderdate" in back.columns


def brute_slices(df, order_by, percents):
    ranked = brute_rank(df, order_by)
    n = df.count()
    b = slice_bounds(n, percents)
    expr = F.lit(len(b) - 1)
    for i in range(len(b) - 2, -1, -1):
        expr = F.when(F.col("rank") <= b[i][1], F.lit(i)).otherwise(expr)
    return ranked.withColumn("sid", expr).drop("rank")


@pytest.mark.parametrize("case", ["plain", "all_tied", "null_dates", "hot_identical", "tiny"])
def test_selective_slices_match_brute_force(spark, events, case):
    df = events
    if case == "all_tied":
        df = events.withColumn("ts", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
    elif case == "null_dates":
        df = events.withColumn("ts", F.when(F.col("event_type") != "error", F.col("ts")))
    elif case == "hot_identical":
        hot = events.limit(1).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(700)))).drop("x")
        df = events.unionByName(hot)
    elif case == "tiny":
        df = events.limit(11)
    sliced = plan_slices(df, "ts", [40, 30, 20, 10], num_buckets=16)
    got = None
    for i in range(4):
        part = sliced.frame(i).withColumn("sid", F.lit(i))
        got = part if got is None else got.unionByName(part)
    want = brute_slices(df, "ts", [40, 30, 20, 10])
    assert same_rows(got, want)


def test_the_bulk_of_a_slice_is_a_pushed_range_scan(spark, events):
    sliced = plan_slices(events, "ts", [40, 30, 20, 10])
    plan = sliced.frame(1)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan


@pytest.mark.parametrize("case", ["outliers", "one_hot_time"])
def test_few_rows_are_ranked(spark, events, case):
    df, n = events, events.count()
    if case == "outliers":
        far = [events.limit(1).withColumn("ts", F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz")) for y in (1900, 2999)]
        df = events.unionByName(far[0]).unionByName(far[1])
    else:
        df = events.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts")))
    sliced = plan_slices(df, "ts", [40, 30, 20, 10])
    ranked = sum(sliced.bucket_counts[b] for b in sliced.split_buckets)
    assert ranked < (0.1 * n if case == "outliers" else 0.45 * n)
    got = None
    for i in range(4):
        part = sliced.frame(i).withColumn("sid", F.lit(i))
        got = part if got is None else got.unionByName(part)
    assert same_rows(got, brute_slices(df, "ts", [40, 30, 20, 10]))


def test_ties_that_differ_in_binary_or_nested_columns(spark):
    rows = [(1, bytes([i % 7, i % 3]), [i % 5, i], (i % 2, str(i))) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, b binary, a array<int>, s struct<x:int,y:string>")
    assert order_keys(df, "k") == ["k", "b", "a", "s"]
    runs = [{r["s"]["y"]: r["rank"] for r in global_rank(df.orderBy(F.rand(seed)), "k", num_buckets=3).frame.collect()} for seed in (1, 2)]
    assert runs[0] == runs[1]


def test_rerun_skips_unchanged_slices_so_loaders_do_not_reload(spark, parts, workdir):
    from sluice.plans.load import copy_into
    from sluice.sources import SourceSpec

    first = run_chunking(parts, "o_orderdate", workdir + "/out", ctx=FIXED_CONTEXT)
    assert first.skipped == []
    spec = SourceSpec("c1", path=first.paths["chunk1"], format="csv", schema=first.schema, has_audit_columns=True)
    assert copy_into(spark, spec, workdir + "/bronze", FIXED_CONTEXT).rows_loaded == 100
    again = run_chunking(parts.orderBy(F.rand(1)), "o_orderdate", workdir + "/out", ctx=FIXED_CONTEXT)
    assert again.skipped == ["chunk1", "chunk2", "chunk3", "chunk4"]
    assert copy_into(spark, spec, workdir + "/bronze", FIXED_CONTEXT).rows_loaded == 0
    least = parts.orderBy("o_orderdate", "o_orderkey").first()["o_orderkey"]
    changed = parts.withColumn("o_totalprice", F.when(F.col("o_orderkey") == least, F.lit(-1.0)).otherwise(F.col("o_totalprice")))
    assert run_chunking(changed, "o_orderdate", workdir + "/out", ctx=FIXED_CONTEXT).skipped == ["chunk2", "chunk3", "chunk4"]


def test_a_moved_value_or_a_renamed_column_is_a_change(spark, workdir):
    plan = [SliceTarget("a", 50, "json"), SliceTarget("b", 50, "json")]
    start = spark.createDataFrame([(i, None, 7 + i) for i in range(20)], "t long, a long, b long")
    moved = spark.createDataFrame([(i, 7 + i, None) for i in range(20)], "t long, a long, b long")
    for df, skipped in ((start, []), (start, ["a", "b"]), (moved, []), (moved, ["a", "b"]), (moved.withColumnRenamed("a", "c"), [])):
        res = run_chunking(df, "t", workdir, plan=plan, ctx=FIXED_CONTEXT)
        assert res.skipped == skipped
        assert same_rows(read_slices(spark, res).select(*df.columns), df)


@pytest.mark.parametrize("lead", ["user_id", "event_type", "value"])
def test_selective_slices_other_lead_types_match_brute_force(spark, events, lead):
    """Integer leads take the bucketed path; text and floating-point leads rank every row."""
    sliced = plan_slices(events, lead, [40, 30, 20, 10])
    assert (sliced.ranked is None) == (lead == "user_id")
    got = None
    for i in range(4):
        part = sliced.frame(i).withColumn("sid", F.lit(i))
        got = part if got is None else got.unionByName(part)
    assert same_rows(got, brute_slices(events, lead, [40, 30, 20, 10]))


def test_slice_prints_equal_a_direct_hash_of_each_slice(spark, events):
    sliced = plan_slices(events, "ts", [40, 30, 20, 10], num_buckets=16, fingerprint=True)
    prints = sliced.slice_prints(whole_hashes=True)
    for i in range(4):
        rows = sliced.frame(i)
        want = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_hash(rows)), F.lit(0))).first()
        assert prints[i] == (want[0], int(want[1]))
