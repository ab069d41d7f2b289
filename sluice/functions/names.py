"""Column-name rules for Parquet-safe tables."""
from __future__ import annotations

import re

from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType

# Fixed value: the characters a clean column name may contain.
_INVALID = re.compile(r"[^0-9a-zA-Z_]")


def sanitize_name(name: str) -> str:
    """Every character outside ``[0-9a-zA-Z_]`` becomes ``_`` (runs are not collapsed)."""
    return _INVALID.sub("_", name)


def unique_names(names: list[str]) -> list[str]:
    """Sanitize names; a name that collides with an earlier one gets ``_2``, ``_3``…"""
    out: list[str] = []
    taken: set[str] = set()
    for name in names:
        clean = sanitize_name(name)
        candidate, i = clean, 1
        while candidate.lower() in taken:
            i += 1
            candidate = f"{clean}_{i}"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def sanitize_type(dtype: DataType) -> DataType:
    """Rename struct fields at every depth (through arrays and map values)."""
    if isinstance(dtype, StructType):
        names = unique_names([f.name for f in dtype.fields])
        return StructType(
            [StructField(n, sanitize_type(f.dataType), f.nullable, f.metadata) for n, f in zip(names, dtype.fields)]
        )
    if isinstance(dtype, ArrayType):
        return ArrayType(sanitize_type(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, MapType):
        return MapType(dtype.keyType, sanitize_type(dtype.valueType), dtype.valueContainsNull)
    return dtype
