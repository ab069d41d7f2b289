"""Records of text files that can be read in splits although a record may span lines: XML row tags, CSV values with line breaks.

XML: the text source cuts files at the row's end tag, which splits like lines do; each piece is from the row's start tag on a record of its own.

CSV: a line break belongs to a value if the quotes before it, from the start of the file, are odd in number. One pass counts the quotes of each
block (a file's part that one task reads), and running sums over a file's blocks tell which of them begin inside a value. A second pass emits the
records that lie within a block; the pieces of those that block edges cut, two rows a block at most, are put together in a shuffle.
"""
from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.context import new_workdir, ship_package

RECORD = "_record"

# ------------------------------------------------------------------- XML ---


def xml_records(spark: SparkSession, path, row_tag: str) -> DataFrame:
    """``_record``: the text of every ``<row_tag ..>`` element, in splits.

    Text before the first row, between rows and after the last is passed over. Rows don't nest. A row whose CDATA section or comment holds the row's own end tag is cut
    there: such records don't parse.
    """
    start = rf"<{row_tag}(?=[\s/>])"
    pieces = spark.read.option("lineSep", f"</{row_tag}>").text(path)
    # Elements without content have no end tag: several may stand before the one that ends the piece.
    parts = F.split("value", rf"(?<=/>)\s*(?={start})")
    part = F.explode(F.filter(F.transform(parts, lambda p: F.regexp_extract(p, rf"(?s)({start}.*)$", 1)), lambda p: p != "")).alias("p")
    empty = F.regexp_extract("p", rf"^<{row_tag}(?:\s[^<>]*)?/>", 0)
    return pieces.select(part).select(F.when(empty != "", empty).otherwise(F.concat("p", F.lit(f"</{row_tag}>"))).alias(RECORD))


def cut_inside() -> Column:
    """Whether a record was cut within a CDATA section or a comment, which held the row's end tag."""
    opened = lambda begin, end: F.size(F.split(RECORD, begin)) > F.size(F.split(RECORD, end))
    return F.contains(RECORD, F.lit("<!")) & (opened(r"<!\[CDATA\[", "]]>") | opened("<!--", "-->"))


# ------------------------------------------------------------------- CSV ---


class Follower:
    """Follows the lines of one block; knows whether it begins inside a value."""

    def __init__(self, inside: bool):
        self.inside = self.began_inside = self.in_head = inside
        self.head: list[str] = []
        self.open: list[str] = []

    def feed(self, lines: pa.Array, odd: np.ndarray, emit: bool = True) -> pa.Array | None:
        """Take more lines (``odd``: those with an odd number of quotes); gives the records that end there."""
        if not len(lines):
            return None
        after = np.bitwise_xor.accumulate(odd) ^ self.inside
        before = np.concatenate([[self.inside], after[:-1]])
        starts, ends = np.flatnonzero(~before), np.flatnonzero(before & ~after)
        text = lambda lo, hi: lines.slice(lo, hi - lo).to_pylist()
        found = [lines.filter(pa.array(~before & ~after))] if emit else []
        several: list[str] = []
        for e in ends.tolist():
            at = int(np.searchsorted(starts, e, side="right")) - 1
            if at >= 0:
                if emit:
                    several.append("\n".join(text(int(starts[at]), e + 1)))
            elif self.in_head:
                self.head += text(0, e + 1)
                self.in_head = False
            else:
                if emit:
                    several.append("\n".join([*self.open, *text(0, e + 1)]))
                self.open = []
        self.inside = bool(after[-1])
        if self.inside:
            if len(starts):
                self.open = text(int(starts[-1]), len(lines))
            elif self.in_head:
                self.head += text(0, len(lines))
            else:
                self.open += text(0, len(lines))
        if several:
            found.append(pa.array(several, lines.type))
        return pa.concat_arrays(found) if found else None

    def left(self) -> tuple[str | None, str | None]:
        """``(head, tail)``: what is left of records that began before the block or end after it."""
        head = "\n".join(self.head) if self.began_inside else None
        tail = "\n".join(self.open) if self.inside and not self.in_head else None
        return head, tail


def _odd_quotes(lines: pa.Array) -> np.ndarray:
    return (pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) & 1).astype(bool)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int, int], pa.Array, bool]]:
    """Lines as ``((path, begin, key), lines, whether they are the block's first)``; the header, the first line of a file, is passed over."""
    last = None
    for batch in batches:
        path, begin = batch.column("path"), batch.column("block").to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(path)
        code = coded.indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (begin[1:] != begin[:-1])) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            if lo == hi:
                continue
            block = (path[lo].as_py(), int(begin[lo]), batch.column("key")[lo].as_py())
            first = block != last
            last = block
            skip = 1 if first and block[1] == 0 else 0
            yield block, batch.column("value").slice(lo + skip, hi - lo - skip), first


def csv_records(spark: SparkSession, path) -> DataFrame:
    """``_record``: the text of every record of CSV files with a header line, in splits, line breaks within quoted values kept.

    Quotes have to stand around values only (doubled inside); lines end with LF or CRLF. Blank lines are passed over. The header is one line.
    """
    ship_package(spark.sparkContext)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumn("key", F.xxhash64("path", "block"))

    quotes = F.sum(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))))
    in_file = Window.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("quotes").over(in_file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = (lines.groupBy("path", "block", "key").agg(quotes.alias("quotes")).withColumn("before", before)
              .select("key", (F.col("before") % 2).cast("int").alias("begins"), ((F.col("before") + F.col("quotes")) % 2).cast("int").alias("ends")))
    kept = f"{new_workdir(spark, 'csv-blocks')}/blocks"
    blocks.write.parquet(kept)
    blocks = spark.read.schema(blocks.schema).parquet(kept)
    # Eight bytes a block (128 MB as a rule) and a byte for how it begins and ends: 100 TB give 7 MB.
    table = blocks.select("key", (F.col("begins") + 2 * F.col("ends")).alias("state")).orderBy("key").toPandas()
    known = spark.sparkContext.broadcast((table["key"].to_numpy(np.int64), table["state"].to_numpy(np.uint8)))

    def state_of(key: int) -> int:
        keys, states = known.value
        at = int(np.searchsorted(keys, key))
        if at == len(keys) or keys[at] != key:
            raise RuntimeError("the files are split otherwise than when their quotes were counted (other settings or cores): read them anew")
        return int(states[at])

    def records(batches):
        follower, expected = None, 0

        def check():
            if follower is not None and follower.inside != bool(expected & 2):
                raise RuntimeError("the files are split otherwise than when their quotes were counted (other settings or cores): read them anew")

        for block, part, first in _blocks(batches):
            if first:
                check()
                expected = state_of(block[2])
                follower = Follower(bool(expected & 1))
            found = follower.feed(part, _odd_quotes(part))
            if found is not None and len(found):
                yield pa.RecordBatch.from_arrays([found], names=[RECORD])
        check()

    def edge_pieces(batches):
        """``(path, block, part, text)``: what a block holds of a record begun before (part 0) and of one that goes on behind it (part 1)."""
        at, follower = None, None

        def left():
            rows = [(*at[:2], part, text) for part, text in enumerate(follower.left()) if text is not None] if at else []
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.string()), strict=True)],
                                                 names=["path", "block", "part", "text"])

        for block, part, first in _blocks(batches):
            if first:
                yield from left()
                at, follower = block, Follower(bool(state_of(block[2]) & 1))
            follower.feed(part, _odd_quotes(part), emit=False)
        yield from left()

    within = lines.mapInArrow(records, f"{RECORD} string")
    # A tail, the blocks that lie wholly inside the value, and the head that ends it.
    pieces = lines.join(F.broadcast(blocks.filter("begins + ends > 0").select("key")), "key", "left_semi").select(*lines.columns).mapInArrow(edge_pieces, "path string, block long, part int, text string")
    in_order = Window.partitionBy("path").orderBy("block", "part")
    numbered = pieces.withColumn("nth", F.sum("part").over(in_order))
    stitched = (numbered.groupBy("path", "nth").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
                .select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias(RECORD)))
    whole = within.unionByName(stitched).select(F.regexp_replace(RECORD, r"\r$", "").alias(RECORD))
    return whole.filter(F.length(F.trim(RECORD)) > 0)


def input_files(spark: SparkSession, path) -> list[str]:
    """The files that a path, folder, glob or list of them stands for."""
    return [unquote(f) for f in spark.read.text(path).inputFiles()]


def csv_headers(spark: SparkSession, paths: list[str], options: Mapping[str, str] | None = None) -> dict[str, tuple[str, ...]]:
    """The column names in the first line of each file: one short read a file, several at a time. A file without a line has none."""
    options = options or {}
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(path: str) -> str | None:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        stream = hpath.getFileSystem(conf).open(hpath)
        try:
            codec = codecs.getCodec(hpath)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")).readLine()
        finally:
            stream.close()

    def names(path: str) -> tuple[str, ...]:
        line = first_line(path)
        return tuple(next(csv.reader(io.StringIO(line.lstrip("﻿")), delimiter=options.get("sep", options.get("delimiter", ","))), ())) if line else ()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(names, paths), strict=True))
