"""Format registry over ``spark.read`` / ``df.write``.

Text formats are configured so that a write followed by a read with the same schema gives back the rows that went in:
nulls stay nulls, empty strings stay empty, quotes survive, and timestamps keep their microseconds.
Type inference is an opt-in (``schema=None``); at scale always pass the schema — inference is an extra full pass.

Files are read in parallel splits: XML at its row tags (``rowSplit="false"`` goes back to Spark's own scanner, one task a file), CSV at line
ends. A CSV value must not hold a line break (``write`` refuses it) unless both sides pass ``quotedLines="true"``, which finds out by the quotes which line
ends are inside values, or ``multiLine="true"``, which reads a file in one task. Null is written as ``\\N``; a text that looks like that marker gets one more
backslash on the way out and loses it on the way in. ``read_checked`` also tells which lines do not fit the schema.
"""
from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.sources.records import RECORD, csv_headers, csv_records, cut_inside, input_files, xml_records

# Timestamp patterns that keep microseconds and the zone offset.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
TIMESTAMP_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV_NULL_TOKEN = "\\N"
XML_ROW_TAG = "record"
XML_ROOT_TAG = "records"

_TS = {"timestampFormat": TIMESTAMP_FORMAT, "timestampNTZFormat": TIMESTAMP_NTZ_FORMAT}

# Options applied on both sides of a text round trip.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "false",
    "escape": '"',
    "nullValue": CSV_NULL_TOKEN,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    **_TS,
}
CSV_WRITE_ONLY = {"quoteAll": "true"}
JSON_OPTIONS = {**_TS}
XML_OPTIONS = {"rowTag": XML_ROW_TAG, "ignoreSurroundingSpaces": "false", **_TS}
XML_WRITE_ONLY = {"rootTag": XML_ROOT_TAG}

Reader = Callable[..., DataFrame]
Writer = Callable[..., None]


BAD, RAW = "_bad", "_raw"  # why a line doesn't fit the schema, and the line


def _marked(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Texts that look like the null marker, with one backslash more or less."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.select(*[F.regexp_replace(F.col(f"`{c}`"), pattern, replacement).alias(c) if c in texts and c not in (BAD, RAW) else F.col(f"`{c}`")
                       for c in df.columns])


def mark_nulls(df: DataFrame) -> DataFrame:
    return _marked(df, r"^(\\+N)$", r"\\$1")


def unmark_nulls(df: DataFrame) -> DataFrame:
    return _marked(df, r"^\\(\\+N)$", "$1")


def _on(options: Mapping[str, str], name: str, default: str = "false") -> bool:
    return str(options.get(name, default)).lower() == "true"


def _in_records(fmt: str, options: Mapping[str, str]) -> bool:
    """Whether the source is read record by record in splits."""
    if str(options.get("mode", "PERMISSIVE")).upper() == "DROPMALFORMED":
        return False
    return _on(options, "rowSplit", "true") if fmt == "xml" else fmt == "csv" and _on(options, "quotedLines")


def parse_records(spark: SparkSession, path, fmt: str, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    """The parsed records of XML or CSV files, read in splits."""
    settings = {k: str(v) for k, v in {**(XML_OPTIONS if fmt == "xml" else CSV_OPTIONS), **options}.items() if k not in ("rowSplit", "quotedLines", "header", "enforceSchema")}
    if fmt == "xml":
        records, parsed = xml_records(spark, path, settings["rowTag"]), F.from_xml(RECORD, schema, settings)
        if "columnNameOfCorruptRecord" not in settings:  # where bad records aren't asked for, none may turn into nulls unseen
            message = "a CDATA section or comment holds the row's end tag: read this XML with rowSplit='false'"
            records = records.select(F.when(cut_inside(), F.raise_error(F.lit(message)).cast("string")).otherwise(F.col(RECORD)).alias(RECORD))
    else:
        wanted = tuple(f.name for f in schema.fields if f.name != RAW)
        for file, header in csv_headers(spark, input_files(spark, path), options).items():
            if header and header != wanted:
                raise ValueError(f"the header of {file} is {header}, the schema has {wanted}")
        records, parsed = csv_records(spark, path), F.from_csv(F.col(RECORD), F.lit(schema.toDDL()), {**settings, "multiLine": "true"})
    return records.select(parsed.alias("_row")).select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields])


def _reader(fmt: str, base: Mapping[str, str], infer: Mapping[str, str] | None = None) -> Reader:
    def read_fmt(spark: SparkSession, path, schema: StructType | str | None = None, **options) -> DataFrame:
        if schema is not None and _in_records(fmt, options):
            df = parse_records(spark, path, fmt, StructType.fromDDL(schema) if isinstance(schema, str) else schema, options)
            return unmark_nulls(df) if fmt == "csv" else df
        if fmt == "csv" and _on(options, "quotedLines"):
            options = {**options, "multiLine": "true"}  # the types are looked for file by file
        r = spark.read.format(fmt).options(**base)
        if schema is None:
            r = r.options(**(infer or {}))
        else:
            r = r.schema(schema)
        df = r.options(**options).load(path)
        return unmark_nulls(df) if fmt == "csv" else df

    return read_fmt


def _writer(fmt: str, base: Mapping[str, str], write_only: Mapping[str, str] | None = None) -> Writer:
    def write_fmt(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None, **options) -> None:
        if fmt == "csv":
            df = mark_nulls(df)
            if not (_on(options, "multiLine") or _on(options, "quotedLines")):
                df = _one_line(df)
            options = {k: v for k, v in options.items() if k not in ("multiLine", "quotedLines")}
        w = df.write.format(fmt).mode(mode).options(**base).options(**(write_only or {})).options(**options)
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(path)

    return write_fmt


def _one_line(df: DataFrame) -> DataFrame:
    """``df`` whose write fails where a text holds a line break, which a split read would tear apart."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            c = F.col(f"`{f.name}`")
            message = F.lit(f"column {f.name} holds a line break: write and read this CSV with quotedLines='true'")
            out[f.name] = F.when(c.rlike(r"[\r\n]"), F.raise_error(message).cast("string")).otherwise(c)
    return df.withColumns(out) if out else df


_READERS: dict[str, Reader] = {
    "csv": _reader("csv", CSV_OPTIONS, {"inferSchema": "true"}),
    "json": _reader("json", JSON_OPTIONS),
    "xml": _reader("xml", XML_OPTIONS),
    "parquet": _reader("parquet", {}),
}
_WRITERS: dict[str, Writer] = {
    "csv": _writer("csv", CSV_OPTIONS, CSV_WRITE_ONLY),
    "json": _writer("json", JSON_OPTIONS),
    "xml": _writer("xml", XML_OPTIONS, XML_WRITE_ONLY),
    "parquet": _writer("parquet", {}),
}


def register_format(name: str, reader: Reader, writer: Writer | None = None) -> None:
    """Add a format; every registry-driven loader picks it up."""
    _READERS[name] = reader
    if writer is not None:
        _WRITERS[name] = writer


def known_formats() -> list[str]:
    return sorted(_READERS)


def read(spark: SparkSession, path, fmt: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """Read ``path`` (file, directory, glob or list) in format ``fmt``; caller options win."""
    if fmt not in _READERS:
        raise ValueError(f"cannot read format {fmt!r}. Known: {known_formats()}")
    return _READERS[fmt](spark, path, schema, **options)


def write(df: DataFrame, path: str, fmt: str, mode: str = "overwrite", partition_by=None, **options) -> None:
    """Write ``df`` to ``path`` in format ``fmt``; caller options win."""
    if fmt not in _WRITERS:
        raise ValueError(f"cannot write format {fmt!r}. Known: {sorted(_WRITERS)}")
    _WRITERS[fmt](df, path, mode=mode, partition_by=partition_by, **options)


def bare_schema(spark: SparkSession, path, fmt: str, **options) -> StructType:
    """The inferred schema of a source, without Spark's column for lines it couldn't read."""
    fields = read(spark, path, fmt, **options).schema.fields
    return StructType([f for f in fields if f.name != "_corrupt_record"])


def read_checked(spark: SparkSession, path, fmt: str, schema: StructType, **options) -> DataFrame:
    """``read`` with ``_bad`` (null, or why the line doesn't fit the schema) and ``_raw`` (such a line's text).

    JSON lines are also held against the schema's names: a field that the schema doesn't have is a reason. Parquet and formats
    registered by callers have no text lines and no bad ones.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if fmt == "json" and not _on(options, "multiLine"):
        return _checked_json(spark.read.text(path).withColumnRenamed("value", RAW), schema, options)
    if fmt not in ("csv", "json", "xml"):
        return read(spark, path, fmt, schema, **options).withColumns({BAD: F.lit(None).cast("string"), RAW: F.lit(None).cast("string")})
    wide = StructType([*schema.fields, StructField(RAW, StringType())])
    df = read(spark, path, fmt, wide, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW, **options)
    return df.withColumn(BAD, F.when(F.col(RAW).isNotNull(), F.lit("malformed")))


def _checked_json(lines: DataFrame, schema: StructType, options: Mapping[str, str]) -> DataFrame:
    corrupt = "_corrupt"
    wide = StructType([*schema.fields, StructField(corrupt, StringType())])
    settings = {**JSON_OPTIONS, **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = lines.filter(F.length(F.trim(RAW)) > 0).withColumn("_row", F.from_json(RAW, wide, settings))
    extra = F.array_except(F.json_object_keys(RAW), F.array(*[F.lit(f.name) for f in schema.fields]))
    bad = (F.when(F.col("_row").isNull() | F.col(f"_row.{corrupt}").isNotNull(), F.lit("malformed"))
           .when(F.size(extra) > 0, F.concat(F.lit("unknown fields: "), F.array_join(F.array_sort(extra), ","))))
    return parsed.withColumn(BAD, bad).select(*[F.col("_row").getField(f.name).alias(f.name) for f in schema.fields],
                                              F.when(F.col(BAD).isNotNull(), F.col(RAW)).alias(RAW), BAD)
