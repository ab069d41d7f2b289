"""Stays (vs a plain loop over each entity) and date layouts settled by their source."""
from __future__ import annotations

import datetime as dt
from itertools import groupby

from pyspark.sql import functions as F

from sluice.operators.datevote import vote_dates
from sluice.operators.movement import entity_stays, transitions

DAY = dt.datetime(2024, 5, 1)


def plain_stays(rows):
    """Per entity, the runs of one place in the order of (time, place), NULL places first."""
    out = set()
    at = lambda r: (r[1], r[2] is not None, r[2] or "")
    micros = lambda a, b: (b - a) // dt.timedelta(microseconds=1)
    rows = [r for r in rows if r[1] is not None]
    for entity in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == entity), key=at)
        runs = [list(g) for _, g in groupby(mine, key=lambda r: r[2])]
        for no, run in enumerate(runs, start=1):
            following = runs[no] if no < len(runs) else None
            out.add((entity, no, run[0][2], len(run), run[0][1], run[-1][1], following[0][2] if following else None,
                     micros(run[0][1], run[-1][1]), micros(run[0][1], following[0][1]) if following else None))
    return out


def stays_of(spark, rows):
    df = spark.createDataFrame(rows, "who long, at timestamp_ntz, spot string").withColumn("place", F.lit("clash"))
    return entity_stays(df, "who", "at", "spot")


def test_a_hot_entity_is_cut_into_pieces_and_its_stays_are_whole(spark):
    rows = [(7, DAY + dt.timedelta(minutes=i), ["a", "a", "b", None, None, "a"][i // 40 % 6]) for i in range(900)]
    rows += [(7, DAY + dt.timedelta(days=3, minutes=i), "a") for i in range(600)]  # one stay over several pieces
    rows += [(k, DAY + dt.timedelta(seconds=i * 7), "xyz"[(i * i + k) % 3]) for k in range(5) for i in range(60)]
    got = stays_of(spark, rows)
    assert {tuple(r) for r in got.collect()} == plain_stays(rows)
    assert got.count() == len(plain_stays(rows))


def test_stays_with_nulls_ties_and_repeated_rows(spark):
    rows = [(None, DAY, "a"), (None, DAY, "a"), (None, DAY, None), (None, DAY + dt.timedelta(hours=1), None), (1, None, "a"),
            (2, DAY, "b"), (2, DAY, "a"), (2, DAY + dt.timedelta(microseconds=1), "b"), (2, None, "c")]
    assert {tuple(r) for r in stays_of(spark, rows).collect()} == plain_stays(rows)
    empty = stays_of(spark, [])
    assert empty.count() == 0 and transitions(empty).count() == 0


def test_stays_take_zoned_times_and_moves_add_up(spark):
    rows = [(1, DAY, "a"), (1, DAY + dt.timedelta(seconds=2), "b"), (1, DAY + dt.timedelta(seconds=5), "a"), (1, DAY + dt.timedelta(seconds=6), "b")]
    df = spark.createDataFrame(rows, "who long, at timestamp, spot string")
    moves = {(r["place"], r["next_place"]): (r["n_moves"], r["dwell_us"], r["min_dwell_us"], r["max_dwell_us"])
             for r in transitions(entity_stays(df, "who", "at", "spot")).collect()}
    assert moves == {("a", "b"): (2, 3_000_000, 1_000_000, 2_000_000), ("b", "a"): (1, 3_000_000, 3_000_000, 3_000_000)}


def votes_of(spark, rows, patterns=("dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd")):
    df = spark.createDataFrame(rows, "src string, txt string").withColumn("_extra", F.lit(1))
    valid, rejected = vote_dates(df, "src", "txt", list(patterns))
    assert valid.columns == ["src", "txt", "_extra", "parsed_date"] and rejected.columns == ["src", "txt", "_extra", "reasons"]
    return ({(r["src"], r["txt"]): r["parsed_date"] for r in valid.collect()}, {(r["src"], r["txt"]): r["reasons"] for r in rejected.collect()})


def test_one_value_that_contradicts_settles_its_source(spark):
    valid, rejected = votes_of(spark, [("uk", "03/04/2024"), ("uk", "25/04/2024"), ("us", "03/04/2024"), ("us", "04/25/2024"),
                                       (None, "03/04/2024"), (None, "31/12/2024")])
    assert not rejected
    assert valid[("uk", "03/04/2024")] == dt.datetime(2024, 4, 3) and valid[("us", "03/04/2024")] == dt.datetime(2024, 3, 4)
    assert valid[(None, "03/04/2024")] == dt.datetime(2024, 4, 3)


def test_what_stays_open_is_set_aside(spark):
    rows = [("open", "03/04/2024"), ("open", "05/05/2024"), ("mixed", "03/04/2024"), ("mixed", "25/04/2024"), ("mixed", "04/25/2024"),
            ("uk", "2024-02-03"), ("uk", "25/04/2024"), ("uk", "03/04/2024"), ("uk", "soon"), ("uk", None), ("uk", "")]
    valid, rejected = votes_of(spark, rows)
    assert rejected == {("open", "03/04/2024"): ["ambiguous_txt"], ("mixed", "03/04/2024"): ["ambiguous_txt"],
                        ("uk", "soon"): ["unparsed_txt"], ("uk", ""): ["unparsed_txt"]}
    assert valid[("open", "05/05/2024")] == dt.datetime(2024, 5, 5) and valid[("mixed", "25/04/2024")] == dt.datetime(2024, 4, 25)
    assert valid[("uk", "2024-02-03")] == dt.datetime(2024, 2, 3) and valid[("uk", "03/04/2024")] == dt.datetime(2024, 4, 3)
    assert valid[("uk", None)] is None


def test_votes_without_rows_or_rivals(spark):
    assert votes_of(spark, []) == ({}, {})
    valid, rejected = votes_of(spark, [("a", "2024-01-02"), ("a", "x")], ["yyyy-MM-dd"])
    assert valid == {("a", "2024-01-02"): dt.datetime(2024, 1, 2)} and rejected == {("a", "x"): ["unparsed_txt"]}
