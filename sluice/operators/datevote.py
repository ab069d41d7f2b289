"""Date text whose layout is settled per source by the values that contradict a layout."""
from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.dates import parse_first
from sluice.operators.quality import quarantine


def _readings(text: Column, patterns: list[str]) -> list[Column]:
    return [parse_first(text, [p]).alias(f"_r{i}") for i, p in enumerate(patterns)]


def ruled_out(df: DataFrame, source: str, column: str, patterns: list[str]) -> DataFrame:
    """``(source, _out)``: per source, the positions of the patterns that its values rule out; one aggregation, one row a source.

    Two patterns are rivals in a source where some text means different times to them. A pattern loses to a rival that reads all that
    it reads, and some text more. Where each reads something that the other can't, the source mixes layouts and neither loses.
    """
    read = df.select(F.col(f"`{source}`").alias("_s"), *_readings(F.col(f"`{column}`"), patterns))
    counts, loses = [], {i: [] for i in range(len(patterns))}
    for i, j in combinations(range(len(patterns)), 2):
        a, b = F.col(f"_r{i}"), F.col(f"_r{j}")
        counts += [F.bool_or(a.isNotNull() & b.isNotNull() & (a != b)).alias(f"_rivals_{i}_{j}"),
                   F.bool_or(a.isNotNull() & b.isNull()).alias(f"_more_{i}_{j}"), F.bool_or(b.isNotNull() & a.isNull()).alias(f"_more_{j}_{i}")]
        loses[i].append(F.expr(f"_rivals_{i}_{j} AND _more_{j}_{i} AND NOT _more_{i}_{j}"))
        loses[j].append(F.expr(f"_rivals_{i}_{j} AND _more_{i}_{j} AND NOT _more_{j}_{i}"))
    flags = []
    for i, losses in loses.items():
        lost = F.lit(False)
        for one in losses:
            lost = lost | F.coalesce(one, F.lit(False))
        flags.append(F.when(lost, F.lit(i)))
    if not counts:
        return read.select("_s", F.array().cast("array<int>").alias("_out")).distinct()
    return read.groupBy("_s").agg(*counts).select("_s", F.array_compact(F.array(*flags)).alias("_out"))


def vote_dates(df: DataFrame, source: str, column: str, patterns: list[str], out: str = "parsed_date") -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)``: date text read by the patterns that its source's values leave.

    Text that no pattern reads is rejected as ``unparsed_<column>``, text that two patterns left read as different times as
    ``ambiguous_<column>``; nothing is guessed. Rows without text are valid, with a NULL date; a NULL source is a source. Together the two
    hold every row once. The verdicts are one row per source: Spark broadcasts them where their size allows, and splits a hot source otherwise.
    """
    votes = ruled_out(df, source, column, patterns)
    read = df.select("*", *_readings(F.col(f"`{column}`"), patterns))
    joined = read.join(votes, F.col(f"`{source}`").eqNullSafe(F.col("_s")), "left")
    left = F.array_distinct(F.array_compact(F.array(*[F.when(~F.array_contains("_out", i), F.col(f"_r{i}")) for i in range(len(patterns))])))
    judged = joined.withColumn("_left", left).select(*[F.col(f"`{c}`") for c in df.columns], F.col("_left"),
                                                     F.when(F.size("_left") == 1, F.get("_left", F.lit(0))).alias(out))
    valid, rejected = quarantine(judged, {f"unparsed_{column}": F.col(f"`{column}`").isNotNull() & (F.size("_left") == 0),
                                          f"ambiguous_{column}": F.size("_left") > 1})
    return valid.drop("_left"), rejected.drop("_left", out)
