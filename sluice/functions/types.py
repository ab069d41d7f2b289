"""Types that hold the values of two types, and columns brought to a type by name at every depth."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType,
                               NullType, ShortType, StructField, StructType, TimestampNTZType)


class SchemaConflict(ValueError):
    pass


# Integer types with the decimal digits that hold all their values, narrowest first.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def common_type(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds the values of both: integers, then decimals, then double; dates, then timestamps; structs, arrays and
    maps part by part (fields that one lacks are added at the end). None where there is none."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    kinds = type(a), type(b)
    if kinds[0] in _DIGITS and kinds[1] in _DIGITS:
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if all(k in _DIGITS or k is DecimalType for k in kinds):
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()
    if all(k in _DIGITS or k in (DecimalType, FloatType, DoubleType) for k in kinds):
        return DoubleType()
    if set(kinds) == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    if kinds == (StructType, StructType):
        try:
            return widen(a, b)
        except SchemaConflict:
            return None
    if kinds == (ArrayType, ArrayType):
        part = common_type(a.elementType, b.elementType)
        return part and ArrayType(part, True)
    if kinds == (MapType, MapType) and a.keyType == b.keyType:
        part = common_type(a.valueType, b.valueType)
        return part and MapType(a.keyType, part, True)
    return None


def widen(current: StructType | None, incoming: StructType) -> StructType:
    """Both schemas in one: new columns are appended, types widened to hold both sides; types with nothing in common raise."""
    if current is None:
        return incoming
    fields = list(current.fields)
    index = {f.name.lower(): i for i, f in enumerate(fields)}
    for f in incoming.fields:
        i = index.get(f.name.lower())
        if i is None:
            index[f.name.lower()] = len(fields)
            fields.append(StructField(f.name, f.dataType, True, f.metadata))
            continue
        old = fields[i]
        both = common_type(old.dataType, f.dataType)
        if both is None:
            raise SchemaConflict(f"column {f.name}: table has {old.dataType.simpleString()}, "
                                 f"load has {f.dataType.simpleString()}")
        if both != old.dataType:
            fields[i] = StructField(old.name, both, old.nullable, old.metadata)
    return StructType(fields)


def conform(column: Column, have: DataType, want: DataType) -> Column:
    """``column`` as type ``want``: struct fields by name (NULL where there is none), everything else by cast."""
    if have == want:
        return column
    if isinstance(have, StructType) and isinstance(want, StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = []
        for f in want.fields:
            held = own.get(f.name.lower())
            part = F.lit(None).cast(f.dataType) if held is None else conform(column.getField(held.name), held.dataType, f.dataType)
            parts.append(part.alias(f.name))
        return F.when(column.isNotNull(), F.struct(*parts))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(column, lambda x: conform(x, have.elementType, want.elementType))
    if isinstance(have, MapType) and isinstance(want, MapType) and have.keyType == want.keyType:
        return F.transform_values(column, lambda _, x: conform(x, have.valueType, want.valueType))
    return column.cast(want)


def conform_frame(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, by name."""
    own = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        held = own.get(f.name.lower())
        cols.append((F.lit(None).cast(f.dataType) if held is None else conform(F.col(f"`{held.name}`"), held.dataType, f.dataType)).alias(f.name))
    return df.select(*cols)
