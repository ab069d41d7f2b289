"""Small helpers of the corpus operators: written tables in the shared folder, column guards."""
from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.context import new_workdir


#: Shuffle files go as soon as the query that wrote them ends, instead of when the driver's garbage collector finds them unused.
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, workdir: str, name: str) -> DataFrame:
    """``df`` written as Parquet under ``workdir`` (in the shared folder) and read again: lineage ends there, and its shuffle files are removed."""
    path, conf = f"{workdir}/{name}", df.sparkSession.conf
    before = conf.get(_CLEANUP_KEY, None)
    conf.set(_CLEANUP_KEY, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        conf.unset(_CLEANUP_KEY) if before is None else conf.set(_CLEANUP_KEY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Texts are long: so many rows go to a Python worker at a time, unless the session says otherwise.
BATCH_ROWS = 2_000
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: And so many bytes, whatever the texts' length: a batch is held several times over, by the executor beside its heap and by its worker.
BATCH_BYTES = 1 << 20
_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship_package(sc: SparkContext) -> None:
    """Send this package's sources to the executors' Python workers, once per application (as ``--py-files`` would)."""
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-src-"), "sluice_src.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def workdir(spark: SparkSession, tag: str) -> str:
    """A fresh folder of the shared scratch space; the package's sources are with the executors afterwards, and batches are small."""
    ship_package(spark.sparkContext)
    if spark.conf.get(_BATCH_KEY, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    if spark.conf.get(_BYTES_KEY, None) is None:
        spark.conf.set(_BYTES_KEY, str(BATCH_BYTES))
    return new_workdir(spark, f"llm-{tag}")


@contextmanager
def rows_at_a_time(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside sends so many rows to a Python worker at a time, unless the session says otherwise."""
    before = spark.conf.get(_BATCH_KEY, None)
    if before not in (None, _BATCH_DEFAULT, str(BATCH_ROWS)):
        yield
        return
    spark.conf.set(_BATCH_KEY, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_KEY) if before is None else spark.conf.set(_BATCH_KEY, before)


def trimmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after each, and after the last, the memory that Arrow holds unused goes back: idle workers keep theirs beside the next stage's."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def columns(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns under the operator's own names; whatever else the input carries can't clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in cols.items()])


#: Bits of a scan filter: 4 MB however many keys there are. With very many keys it lets more rows pass, never fewer.
FILTER_BITS = 1 << 25
_SHIFTS = (0, 19, 38)


def key_filter(keys: DataFrame) -> Broadcast:
    """A Bloom filter of fixed size over hash keys (a single long column), to drop rows at the scan that no join would keep."""
    name = keys.columns[0]
    bits = F.array(*[F.shiftrightunsigned(F.col(name), s).bitwiseAND(F.lit(FILTER_BITS - 1)) for s in _SHIFTS])
    words = (keys.select(F.explode(bits).alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, CAST(bit & 63 AS INT))").alias("one"))
             .groupBy("word").agg(F.bit_or("one").alias("ones")).toPandas())
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[words["word"].to_numpy(np.int64)] = words["ones"].to_numpy(np.int64).view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (int64) the filter may hold."""
    u, out = keys.view(np.uint64), np.ones(len(keys), bool)
    for s in _SHIFTS:
        bit = (u >> np.uint64(s)) & np.uint64(FILTER_BITS - 1)
        out &= (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def scan_filtered(df: DataFrame, key: str, held: Broadcast, wanted: bool = True) -> DataFrame:
    """The rows of ``df`` whose key the filter may hold (or, not ``wanted``, all others; a null key is held by none)."""

    def run(batches):
        for batch in trimmed(batches):
            column = batch.column(key)
            some = may_hold(held.value, column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            some &= column.is_valid().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(some if wanted else ~some))

    return df.mapInArrow(run, df.schema)
