"""Keys and foreign keys found in the data: inclusion dependencies between all columns of several tables, without joining any two.

Every value is sent once with the columns that hold it. What comes together for a value is a set of columns; equal sets are counted, and a column is included in another if
every set that has the one has the other: a count per pair of columns over the few different sets. So the work is one shuffle of distinct (value, column)
pairs, however many pairs of columns there are.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, IntegralType, StringType, TimestampNTZType, TimestampType

from sluice.functions.dates import epoch_micros

LONG_TEXT = 32  # longer texts are compared by their MD5


def comparable(column: Column, kind: DataType) -> Column | None:
    """A text that is equal where two columns hold the same value: whole numbers, texts, times (dates are midnights). None for other types."""
    if isinstance(kind, IntegralType):
        return F.concat(F.lit("i"), column.cast("string"))
    if isinstance(kind, StringType):
        return F.when(F.octet_length(column) > LONG_TEXT, F.concat(F.lit("h"), F.md5(column.cast("binary")))).otherwise(F.concat(F.lit("s"), column))
    if isinstance(kind, (DateType, TimestampNTZType)):
        return F.concat(F.lit("t"), epoch_micros(column.cast("timestamp_ntz")).cast("string"))
    if isinstance(kind, TimestampType):
        return F.concat(F.lit("z"), F.unix_micros(column).cast("string"))
    return None


def inclusion_dependencies(tables: dict[str, DataFrame]) -> DataFrame:
    """``(child_table, child_column, parent_table, parent_column, n_values, parent_values)``: every column whose values all occur in a key.

    A key is a column without NULLs and repeated values. NULLs of a child are no values, and a column without values is in no result; neither is a
    key in itself. Columns other than whole numbers, texts and times are left out.
    """
    names, parts = [], []
    for table, df in sorted(tables.items()):
        held = []
        for f in df.schema.fields:
            value = comparable(F.col(f"`{f.name}`"), f.dataType)
            if value is not None:
                held.append(F.struct(F.lit(len(names)).alias("c"), value.alias("v")))
                names.append((len(names), table, f.name))
        if held:
            parts.append(df.select(F.inline(F.array(*held))))
    if not parts:
        return next(iter(tables.values())).sparkSession.createDataFrame([], "child_table string, child_column string, parent_table string, parent_column string, n_values long, parent_values long")
    pairs = parts[0]
    for p in parts[1:]:
        pairs = pairs.unionByName(p)
    # Combined before it is sent: a value that fills a third of a column is a row a task. NULL stays a value here, to tell keys.
    counted = pairs.groupBy("v", "c").agg(F.count(F.lit(1)).alias("n"))
    again = F.when(F.col("v").isNull() | (F.col("n") > 1), 1).otherwise(0)
    sets = counted.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("c", again.alias("again")))).alias("cs"))
    shapes = sets.groupBy("cs", F.col("v").isNull().alias("none")).agg(F.count(F.lit(1)).alias("n"))
    flat = shapes.select("cs", "none", "n", F.explode("cs").alias("a"))
    columns = flat.groupBy(F.col("a.c").alias("c")).agg(F.sum(F.when(~F.col("none"), F.col("n")).otherwise(0)).alias("n_values"), F.max("a.again").alias("again"))
    both = (flat.filter("NOT none").select(F.col("a.c").alias("child"), "n", F.explode("cs").alias("b")).groupBy("child", F.col("b.c").alias("parent")).agg(F.sum("n").alias("n_both"))
            .filter("child <> parent"))
    spark = pairs.sparkSession
    named = spark.createDataFrame(names, "c int, table string, column string")
    of = lambda side: columns.join(F.broadcast(named), "c").select(  # noqa: E731  (a row per column of the tables)
        F.col("c").alias(side), F.col("table").alias(f"{side}_table"), F.col("column").alias(f"{side}_column"), F.col("n_values").alias(f"{side}_n"), F.col("again").alias(f"{side}_again"))
    found = both.join(F.broadcast(of("child")), "child").join(F.broadcast(of("parent")), "parent")
    return found.filter("n_both = child_n AND child_n > 0 AND parent_again = 0").select(
        "child_table", "child_column", "parent_table", "parent_column", F.col("child_n").alias("n_values"), F.col("parent_n").alias("parent_values"))
