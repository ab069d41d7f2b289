"""Run identity and scratch space.

A run is one process-level unit of work: every row written during it carries
the same ``run_id``. ``load_dt`` defaults to ``current_timestamp()`` (one value
per query / micro-batch) but can be pinned for reproducible output.

Scratch space (staged intermediate tables, ledgers, checkpoints) always lives
under the shared folder the cluster names in ``spark.checkpoint.dir``. Only in
local mode, where driver and executors are one process, may a temporary folder
stand in for it; on a cluster an unset folder is an error.
"""
from __future__ import annotations

import datetime as _dt
import os
import re
import tempfile
import uuid
import zipfile
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_PROCESS_RUN_ID = str(uuid.uuid4())


def process_run_id() -> str:
    """The run id shared by everything this Python process writes."""
    return _PROCESS_RUN_ID


@dataclass(frozen=True)
class RunContext:
    """Who is writing and when. ``load_dt=None`` means ``current_timestamp()``."""

    run_id: str = field(default_factory=process_run_id)
    load_dt: _dt.datetime | None = None

    def load_dt_column(self) -> Column:
        if self.load_dt is None:
            return F.current_timestamp()
        return F.lit(self.load_dt)


FIXED_CONTEXT = RunContext(run_id="run-1", load_dt=_dt.datetime(2024, 1, 1))


def scratch_root(spark: SparkSession) -> str:
    """Shared root for intermediate data: ``spark.checkpoint.dir`` of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set (master {master}): name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_workdir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the scratch root for one operator call."""
    path = f"{scratch_root(spark)}/sluice/{tag}-{uuid.uuid4().hex[:12]}"
    fs, hpath = _fs(spark, path)  # the session's file system for this path (HDFS, object store or local)
    fs.mkdirs(hpath)
    return path


_shipped: set[str] = set()


def ship_package(sc) -> None:
    """Send this package's sources to the executors' Python workers, once per application (as ``--py-files`` would)."""
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-core-"), "sluice_core.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # Spark's own file service hands it out: no executor reads the driver's folder
    _shipped.add(sc.applicationId)


def scan_partitions(df) -> int:
    """How many scan partitions the files under ``df`` fill, by the sizes Spark plans with (no job).

    Leaves of unknown size (rows that are no files) count nothing.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(s for s in sizes if s < 1 << 60)
    return max(1, -(-size // df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()))


def release(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose data has been written on."""
    root = scratch_root(spark)
    if not path.startswith(f"{root}/sluice/"):
        raise ValueError(f"{path} is not a scratch folder of {root}")
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def list_names(spark: SparkSession, path: str, files_only: bool = False) -> list[str]:
    """Names directly under ``path`` (empty when it does not exist); ``files_only`` skips folders."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(hpath) if not files_only or st.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    """Whole content of a small file, read on the driver through the Hadoop file system."""
    fs, hpath = _fs(spark, path)
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file; fails if it already exists (the caller lost a race).

    It is written beside and renamed, so a reader finds the whole file or none.
    """
    fs, hpath = _fs(spark, path)
    beside, bpath = _fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = beside.create(bpath, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(hpath) or not fs.rename(bpath, hpath):
        fs.delete(bpath, False)
        raise FileExistsError(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small file on the driver through the Hadoop file system."""
    fs, hpath = _fs(spark, path)
    if fs.exists(hpath):
        fs.delete(hpath, False)
    create_text(spark, path, text)


def basename(path: str) -> str:
    """Text after the last ``/`` (trailing slash ignored)."""
    return path.rstrip("/").rsplit("/", 1)[-1]
