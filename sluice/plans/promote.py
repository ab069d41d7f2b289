"""Second phase of the rescue column: what rows keep there becomes typed columns."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType, VariantType

from sluice.context import RunContext
from sluice.functions.types import common_type, conform
from sluice.plans.tables import Table
from sluice.sources.rescue import LINE, RESCUED, as_object

# Types that texts are tried as, narrowest first.
_TEXT_TYPES = ("bigint", "double", "boolean", "date", "timestamp_ntz")


def rescued_types(df: DataFrame, column: str = RESCUED, texts: bool = False) -> dict[str, DataType]:
    """Fields of the rescue column and the type that holds all their values; with ``texts`` a field of texts that all read as numbers, dates .. is one.

    Two aggregations over the rows that have something there; fields whose values have no type in common are texts (of JSON).
    """
    some = df.filter(F.col(column).isNotNull()).select(F.parse_json(column).alias("v"))
    ddl = some.agg(F.schema_of_variant_agg("v")).first()[0]
    if not ddl or not ddl.startswith("OBJECT<"):
        return {}
    found = {f.name: StringType() if isinstance(f.dataType, VariantType) else f.dataType
             for f in StructType.fromDDL(ddl[len("OBJECT<"):-1].replace("OBJECT<", "STRUCT<")).fields if f.name != LINE}
    if not texts or not found:
        return found
    get = lambda c: F.try_variant_get("v", f"$['{c}']", "string")
    tried = [c for c, t in found.items() if isinstance(t, StringType) and "'" not in c]
    fits = [F.count_if(get(c).isNotNull() & get(c).try_cast(t).isNull()).alias(f"{i}_{t}") for i, c in enumerate(tried) for t in _TEXT_TYPES]
    bad = some.agg(F.count(F.lit(1)), *fits).first() if fits else None
    for i, c in enumerate(tried):
        best = next((t for t in _TEXT_TYPES if bad[f"{i}_{t}"] == 0), None)
        if best:
            found[c] = StructType.fromDDL(f"x {best}").fields[0].dataType
    return found


def promote_rescued(spark: SparkSession, target: str, column: str = RESCUED, texts: bool = False, ctx: RunContext | None = None) -> dict[str, str]:
    """Second phase: rescued fields of a table become typed columns; returns their types.

    New fields are new columns, after those there are. For a column there is, the rescued values are put in where the two types have one in
    common, which the column then has; otherwise they stay rescued. The table is written anew as one load; nothing rescued, nothing written.
    """
    ctx = ctx or RunContext()
    table = Table(spark, target)
    df = table.read()
    own = {f.name: f.dataType for f in df.schema.fields}
    lower = {c.lower(): c for c in own}
    promoted: dict[str, tuple[str, DataType]] = {}
    for name, kind in rescued_types(df, column, texts).items():
        there = lower.get(name.lower())
        both = common_type(own[there], kind) if there else kind
        if both is not None and "'" not in name:
            promoted[name] = (there or name, both)
    if not promoted:
        return {}
    v = F.parse_json(F.col(column))
    fields = {}
    for name, (into, kind) in promoted.items():
        raw = F.try_variant_get(v, f"$['{name}']", "string")
        value = raw.try_cast(kind) if texts and not isinstance(kind, (StructType, ArrayType, MapType, StringType)) else F.try_variant_get(v, f"$['{name}']", kind.simpleString())
        held = conform(F.col(f"`{into}`"), own[into], kind) if into in own else F.lit(None).cast(kind)
        fields[into] = F.coalesce(held, value)
    done = F.array(*[F.when(F.col(f"_new.`{into}`").isNotNull(), F.lit(name)) for name, (into, _) in promoted.items()])
    held = F.try_variant_get(F.parse_json(F.col(column)), "$", "map<string,variant>")
    rest = as_object(F.map_filter(held, lambda k, _: ~F.coalesce(F.array_contains(done, k), F.lit(False))))
    staged = df.withColumn("_new", F.struct(*[c.alias(k) for k, c in fields.items()])).withColumn(column, rest)
    order = [*own, *[c for c in fields if c not in own]]
    out = staged.select(*[F.col(f"_new.`{c}`").alias(c) if c in fields else F.col(f"`{c}`") for c in order])
    table.write_load(out, f"promote-{uuid.uuid4().hex[:12]}", mode="overwrite", run_id=ctx.run_id)
    return {into: kind.simpleString() for into, kind in promoted.values()}
