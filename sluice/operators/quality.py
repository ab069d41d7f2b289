"""Data-quality operators: sanity checks, expectations, quarantine, key overlap.

Every check is a single aggregation pass (one job) no matter how many columns
or rules it covers; results come back as small DataFrames.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField,
                               StructType)

from sluice.functions.dates import parse_first
from sluice.operators.audit import AUDIT_COLUMNS

CHECK_SCHEMA = StructType([
    StructField("table", StringType(), False),
    StructField("row_count", LongType(), False),
    StructField("passed", BooleanType(), False),
    StructField("failures", ArrayType(StringType(), False), False),
])

# The texts of failed checks.
EMPTY_TABLE = "row_count is 0"
NULL_VALUES = "{column} has {n} null values out of {rows}"
MISSING_COLUMN = "missing required column {column}"


def _as_column(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def violated(rule: str | Column) -> Column:
    """True when a row breaks ``rule``; a NULL outcome counts as a break."""
    return ~F.coalesce(_as_column(rule), F.lit(False))


def sanity_check(
    df: DataFrame,
    table: str,
    columns: tuple[str, ...] = AUDIT_COLUMNS,
    required_columns: tuple[str, ...] = (),
) -> DataFrame:
    """One-row result ``(table, row_count, passed, failures)`` from one aggregation.

    Failures: ``row_count is 0``; ``<c> has k null values out of n`` for each of
    ``columns`` present in ``df``; ``missing required column <c>`` for each of
    ``required_columns`` absent from ``df``.
    """
    present = [c for c in columns if c in df.columns]
    missing = [c for c in required_columns if c not in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null_{i}") for i, c in enumerate(present)
    ]
    stats = df.agg(*aggs)
    n = F.col("_n")
    messages = [F.when(n == 0, F.lit(EMPTY_TABLE))]
    for i, c in enumerate(present):
        k = F.col(f"_null_{i}")
        messages.append(F.when(k > 0, F.format_string(NULL_VALUES.format(column=c.replace("%", "%%"), n="%d", rows="%d"), k, n)))
    messages += [F.lit(MISSING_COLUMN.format(column=c)) for c in missing]
    failures = F.filter(F.array(*messages), lambda m: m.isNotNull())
    return stats.select(
        F.lit(table).alias("table"),
        n.cast("long").alias("row_count"),
        (F.size(failures) == 0).alias("passed"),
        failures.alias("failures"),
    )


def check_result(check_df: DataFrame) -> dict:
    """Bring the one-row check result to the driver as a dict."""
    row = check_df.first()
    return {"table": row["table"], "row_count": row["row_count"], "passed": row["passed"],
            "failures": list(row["failures"])}


@dataclass(frozen=True)
class Expectation:
    """A named row rule. ``policy``: ``warn`` keeps rows, ``drop`` removes them, ``fail`` raises."""

    name: str
    rule: str
    policy: str = "warn"


class ExpectationFailed(RuntimeError):
    pass


def expect(df: DataFrame, expectations: list[Expectation], label: str = "expectations"):
    """Attach violation counters to ``df`` without an extra pass.

    Returns ``(frame, observation)``. Counters fill in when ``frame`` is first
    acted upon (e.g. written); rows of ``drop`` rules are filtered out after
    counting, so the counts always refer to the input.
    """
    obs = Observation(label)
    metrics = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(violated(e.rule)).alias(e.name) for e in expectations
    ]
    out = df.observe(obs, *metrics)
    keep = [F.coalesce(_as_column(e.rule), F.lit(False)) for e in expectations if e.policy == "drop"]
    for cond in keep:
        out = out.filter(cond)
    return out, obs


def expectation_report(df: DataFrame, expectations: list[Expectation]) -> DataFrame:
    """One aggregation: ``(expectation, policy, rule, violations, total_rows)`` per rule."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(violated(e.rule)).alias(f"_v{i}") for i, e in enumerate(expectations)
    ]
    stats = df.agg(*aggs)
    entries = [
        F.struct(F.lit(e.name).alias("expectation"), F.lit(e.policy).alias("policy"),
                 F.lit(e.rule).alias("rule"), F.col(f"_v{i}").cast("long").alias("violations"))
        for i, e in enumerate(expectations)
    ]
    return stats.select(F.inline(F.array(*entries)), F.col("_rows").cast("long").alias("total_rows"))


def enforce(obs: Observation, expectations: list[Expectation]) -> dict[str, int]:
    """After the action: raise for violated ``fail`` rules; return all counters."""
    got = obs.get
    bad = [e.name for e in expectations if e.policy == "fail" and got.get(e.name, 0) > 0]
    if bad:
        raise ExpectationFailed(f"expectations failed: {', '.join(bad)} ({got})")
    return dict(got)


def quarantine(df: DataFrame, rules: dict[str, str | Column], reasons_col: str = "reasons"):
    """Split rows by named *rejection* rules (a row is rejected when a rule is true).

    Returns ``(valid, rejected)``; ``rejected`` carries the ``reasons`` array of
    every rule that matched. Both come from one shared projection and together
    hold every input row exactly once; nothing is corrected.
    """
    flags = [F.when(F.coalesce(_as_column(r), F.lit(False)), F.lit(name)) for name, r in rules.items()]
    tagged = df.withColumn(reasons_col, F.filter(F.array(*flags), lambda m: m.isNotNull()))
    valid = tagged.filter(F.size(reasons_col) == 0).drop(reasons_col)
    rejected = tagged.filter(F.size(reasons_col) > 0)
    return valid, rejected


def split_dates(df: DataFrame, column: str, patterns: list[str], out: str = "parsed_date"):
    """``(valid, rejected)``: date text read by the first pattern that fits; text that none fits is rejected with
    its reason instead of turning into a NULL. Rows without text are valid, with a NULL date."""
    parsed = df.withColumn(out, parse_first(F.col(f"`{column}`"), patterns))
    valid, rejected = quarantine(parsed, {f"unparsed_{column}": F.col(f"`{column}`").isNotNull() & F.col(f"`{out}`").isNull()})
    return valid, rejected.drop(out)


def key_overlap(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, relation: str) -> DataFrame:
    """Referential coverage of distinct child keys: matched, orphans and the matched percentage.

    Both sides are reduced to distinct keys first (map-side partial aggregation),
    so a hot key costs one row per task, not one per occurrence.
    """
    ck = child.select(F.col(child_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    pk = parent.select(F.col(parent_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    flagged = ck.join(pk.withColumn("_hit", F.lit(True)), "_k", "left")
    stats = flagged.agg(
        F.count(F.lit(1)).alias("child_keys"),
        F.count_if(F.col("_hit").isNotNull()).alias("matched"),
    )
    return stats.select(
        F.lit(relation).alias("relation"),
        F.col("child_keys").cast("long").alias("child_keys"),
        F.col("matched").cast("long").alias("matched_keys"),
        (F.col("child_keys") - F.col("matched")).cast("long").alias("orphan_keys"),
        F.when(F.col("child_keys") == 0, F.lit(0.0))
        .otherwise(F.round(F.lit(100.0) * F.col("matched") / F.col("child_keys"), 2)).alias("pct_matched"),
    )


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)`` for several frames in one job (a union of tiny aggregates)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
