"""Make column names Parquet-safe, top level and nested, in one projection."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from sluice.functions.names import sanitize_type, unique_names


def sanitize_columns(df: DataFrame, nested: bool = True) -> DataFrame:
    """Rename every column (and, with ``nested``, every struct field) to ``[0-9a-zA-Z_]``.

    Collisions after cleaning get ``_2``, ``_3``… instead of failing on write.
    Nested renames are a cast to the renamed type — no data movement.
    """
    names = unique_names(df.columns)
    cols = []
    for field, new in zip(df.schema.fields, names):
        c = F.col(f"`{field.name}`")
        if nested and isinstance(field.dataType, (StructType, ArrayType, MapType)):
            clean = sanitize_type(field.dataType)
            if clean != field.dataType:
                c = c.cast(clean)
        cols.append(c.alias(new))
    return df.select(*cols)
