"""Reading that loses nothing: fields that the schema lacks, and values that don't fit it, stay with their row as JSON.

``read_rescued`` gives a text column more: an object of what the typed columns couldn't take, null where there is nothing (``plans.promote`` makes columns
of it). ``csv_by_header`` reads CSV files whose headers differ.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from sluice.functions.types import conform_frame, widen
from sluice.sources import formats
from sluice.sources.formats import BAD, CSV_OPTIONS, JSON_OPTIONS, RAW, XML_OPTIONS
from sluice.sources.records import RECORD, csv_headers, input_files, xml_records

RESCUED = "_rescued"
LINE = "_line"  # where a whole line is kept that has no fields of its own (a JSON object that names a field twice)
_CORRUPT = "_corrupt"


def as_object(entries: Column) -> Column:
    """JSON of a map, null where it is empty."""
    return F.when(F.size(entries) > 0, F.to_json(entries))


def _left_over(parsed: Column, held: Column, schema: StructType, misfit: Column) -> Column:
    """Fields of ``held`` (a map of variants) that the schema lacks, or, where ``misfit``, that the parsed row couldn't take."""
    known = F.array(*[F.lit(f.name) for f in schema.fields])
    names = []
    for f in schema.fields:
        inside = isinstance(f.dataType, (StructType, ArrayType, MapType))  # a part of it may be missing
        lost = F.lit(True) if inside else parsed.getField(f.name).isNull()
        names.append(F.when(misfit & lost, F.lit(f.name)))
    lost_names = F.array(*names)
    return as_object(F.map_filter(held, lambda k, v: ~F.is_variant_null(v) & (~F.array_contains(known, k) | F.coalesce(F.array_contains(lost_names, k), F.lit(False)))))


def _rescued_json(lines: DataFrame, schema: StructType, column: str, options: Mapping[str, str]) -> DataFrame:
    wide = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    settings = {**JSON_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    rows = lines.filter(F.length(F.trim(RAW)) > 0).withColumn("_row", F.from_json(RAW, wide, settings))
    parsed, misfit = F.col("_row"), F.col(f"_row.{_CORRUPT}").isNotNull()
    names = F.json_object_keys(RAW)
    extra = F.size(F.array_except(names, F.array(*[F.lit(f.name) for f in schema.fields]))) > 0
    held = F.try_variant_get(F.try_parse_json(RAW), "$", "map<string,variant>")
    rows = rows.withColumn("_held", F.when(misfit | extra | (F.size(names) != F.size(F.array_distinct(names))), held))
    plain = F.coalesce(~misfit & ~extra & (F.size(names) == F.size(F.array_distinct(names))), F.lit(False))
    twice = F.col("_held").isNull() & names.isNotNull() & ~misfit  # an object that the variant parser refuses
    bad = F.when(~plain & F.col("_held").isNull() & ~F.coalesce(twice, F.lit(False)), F.lit("malformed"))
    left = F.when(plain, F.lit(None).cast("string")).when(F.col("_held").isNotNull(), _left_over(parsed, F.col("_held"), schema, misfit)).when(
        twice, F.to_json(F.struct(F.col(RAW).alias(LINE))))
    return rows.select(*[parsed.getField(f.name).alias(f.name) for f in schema.fields], left.alias(column), F.when(bad.isNotNull(), F.col(RAW)).alias(RAW), bad.alias(BAD))


def _rescued_xml(records: DataFrame, schema: StructType, column: str, settings: Mapping[str, str]) -> DataFrame:
    settings = {**settings, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    wide = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    texts = StructType([StructField(_CORRUPT, StringType())])
    rows = records.withColumns({"_row": F.from_xml(RECORD, wide, settings), "_sound": F.from_xml(RECORD, texts, settings)[_CORRUPT].isNull()})
    # Only well-formed records are read as variants: others would end the job.
    held = F.when(F.col("_sound"), F.try_variant_get(F.from_xml(RECORD, "variant", {k: v for k, v in settings.items() if k not in ("mode", "columnNameOfCorruptRecord")}), "$", "map<string,variant>"))
    rows = rows.withColumn("_held", held)
    misfit = F.col(f"_row.{_CORRUPT}").isNotNull()
    # Where a value doesn't fit, the parser gives up the whole row: its other fields are read one by one.
    single = [F.when(misfit, F.from_xml(RECORD, StructType([f]), {k: v for k, v in settings.items() if k != "columnNameOfCorruptRecord"}).getField(f.name))
              .otherwise(F.col("_row").getField(f.name)).alias(f.name) for f in schema.fields]
    fields = rows.select(RECORD, "_held", "_sound", F.struct(*single).alias("_row"), F.col("_row").getField(_CORRUPT).alias(_CORRUPT))
    left = F.when(F.col("_held").isNotNull(), _left_over(F.col("_row"), F.col("_held"), schema, F.col(_CORRUPT).isNotNull()))
    bad = F.when(~F.col("_sound"), F.lit("malformed"))
    return fields.select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields], left.alias(column), F.when(bad.isNotNull(), F.col(RECORD)).alias(RAW), bad.alias(BAD))


def csv_group(spark: SparkSession, paths: list[str], header: tuple[str, ...], schema: StructType, extras: Mapping[str, DataType], column: str | None,
              options: Mapping[str, str], file_col: str | None = None) -> DataFrame:
    """Files that share a header, their columns matched to ``schema`` by name, ``extras`` the types of columns that it lacks; with ``column`` what
    doesn't fit is rescued (columns without a type there too), without it such lines are bad."""
    known = {f.name.lower(): f for f in schema.fields}
    fields = []
    for name in header:
        f = known.get(name.lower())
        fields.append(StructField(name, f.dataType if f else extras.get(name, StringType())))
    df = formats.read(spark, paths, "csv", StructType([*fields, StructField(RAW, StringType())]), mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, **options)
    named = lambda c: F.col(f"`{c}`")
    out = [named(c).alias(known[c.lower()].name if c.lower() in known else c) for c in header if c.lower() in known or c in extras]
    if file_col:
        out.append(F.col("_metadata.file_name").alias(file_col))
    if column is None:
        return df.select(*out, named(RAW), F.when(named(RAW).isNotNull(), F.lit("malformed")).alias(BAD))
    settings = {**CSV_OPTIONS, **{k: str(v) for k, v in options.items() if k != "quotedLines"}, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "multiLine": "true"}
    places = [f"_{i}" for i in range(len(header))]
    text = F.from_csv(named(RAW), F.lit(", ".join(f"{p} string" for p in [*places, _CORRUPT])), {k: v for k, v in settings.items() if k not in ("header", "enforceSchema")})
    df = df.withColumn("_text", F.when(named(RAW).isNotNull(), text))
    bad = F.when(named(RAW).isNotNull() & F.col(f"_text.{_CORRUPT}").isNotNull(), F.lit("malformed"))
    entries = []
    for c, p in zip(header, places, strict=True):
        lost = F.when(named(c).isNull(), F.col(f"_text.{p}")) if c.lower() in known or c in extras else named(c)
        entries.append(F.struct(F.lit(c).alias("key"), lost.alias("value")))
    left = as_object(F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())))
    return df.select(*out, F.when(bad.isNull(), left).alias(column), F.when(bad.isNotNull(), named(RAW)).alias(RAW), bad.alias(BAD))


def csv_by_header(spark: SparkSession, paths: list[str], schema: StructType | None, column: str | None = None, file_col: str | None = None, **options) -> DataFrame:
    """CSV files whose headers differ: grouped by header, columns matched by name, types widened to hold all files' values.

    Columns that ``schema`` lacks are typed by their files and appended (with ``column`` they are rescued); columns that a file lacks are NULL. Without ``schema`` all
    columns are. A file that has no column of the schema, or names one twice, is bad as a whole: one line with its header stands for it. Files without a line
    give no rows.
    """
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, header in csv_headers(spark, paths, options).items():
        if header:
            groups.setdefault(header, []).append(path)
    whole, parts, refused = schema, [], []
    for header, files in sorted(groups.items()):
        known = {f.name.lower() for f in schema.fields} if schema else set()
        names = [c.lower() for c in header]
        if len(set(names)) < len(names) or (schema and not known & set(names)):
            why = "names a column twice" if len(set(names)) < len(names) else "has no column of the schema"
            refused += [(",".join(header), f"file refused: the header of {f.rsplit('/', 1)[-1]} {why}") for f in files]
            continue
        extras: dict[str, DataType] = {}
        if column is None and set(names) - known:
            found = formats.bare_schema(spark, files, "csv", **options)
            extras = {f.name: f.dataType for f in found.fields if f.name.lower() not in known}
            whole = widen(whole, StructType([StructField(n, t) for n, t in extras.items()]))
        parts.append((files, header, extras))
    whole = whole or StructType()
    own = StructType([*whole.fields, *[StructField(c, StringType()) for c in (column, file_col) if c], StructField(RAW, StringType()), StructField(BAD, StringType())])
    frames = [conform_frame(csv_group(spark, files, header, schema or StructType(), extras, column, options, file_col), own) for files, header, extras in parts]
    if refused or not frames:
        frames.append(conform_frame(spark.createDataFrame(refused, f"{RAW} string, {BAD} string"), own))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_rescued(spark: SparkSession, paths, fmt: str, schema: StructType, column: str = RESCUED, **options) -> DataFrame:
    """The columns of ``schema``, the rescue column, and ``_raw``/``_bad`` for lines that are no record at all.

    JSON lines, XML rows, CSV lines (per file header) and Parquet columns beyond the schema. JSON and XML keep the values' own JSON types, CSV
    texts; XML's are the parser's. An object that names a field twice keeps its whole line under ``_line``.
    """
    if fmt == "json" and str(options.get("multiLine", "false")).lower() != "true":
        return _rescued_json(spark.read.text(paths).withColumnRenamed("value", RAW), schema, column, options)
    if fmt == "xml":
        settings = {k: str(v) for k, v in {**XML_OPTIONS, **options}.items() if k != "rowSplit"}
        return _rescued_xml(xml_records(spark, paths, settings["rowTag"]), schema, column, settings)
    if fmt == "csv":
        return csv_by_header(spark, input_files(spark, paths), schema, column, **options)
    if fmt == "parquet":
        found = formats.bare_schema(spark, paths, fmt, mergeSchema="true", **options)
        extra = [f.name for f in found.fields if f.name.lower() not in {c.lower() for c in schema.names}]
        wide = StructType([*schema.fields, *[f for f in found.fields if f.name in extra]])
        df = formats.read(spark, paths, fmt, wide, **options)
        any_ = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in extra]).isNotNull() if extra else F.lit(False)
        left = F.when(any_, F.to_json(F.struct(*[F.col(f"`{c}`") for c in extra]))) if extra else F.lit(None).cast("string")
        return df.select(*[F.col(f"`{c}`") for c in schema.names], left.alias(column), F.lit(None).cast("string").alias(RAW), F.lit(None).cast("string").alias(BAD))
    raise ValueError(f"format {fmt!r} has no rescue column (json lines, xml, csv, parquet have)")
