"""Path-based Parquet tables: one directory per load and a small commit list.

Layout under the table path::

    data/load_id=<id>/part-*.parquet    one directory per load (written with overwrite)
    _files/load_id=<id>/                the source files of a load (path, length, time), written by Spark
    _log/<seq>.json                     one small record per commit, written beside and renamed
    _comments.json                      descriptions of the table and its columns

A load becomes visible only when its commit record is written, so a crash between the data write and
the commit leaves nothing visible and the retry (same ``load_id``) overwrites the orphan. An
``overwrite`` commit hides every earlier load; a ``reject`` commit is never visible, but its source
files count as seen. The schema is kept in the records, widened per load: columns are added, types widened
(see ``functions.types``); a type with nothing in common is refused. Loads are read with the types they were written with and cast, columns missing in older
loads are NULL. One writer per table is assumed.
"""
from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.context import create_text, list_names, path_exists, read_text, write_text
from sluice.functions.types import SchemaConflict, conform, conform_frame, widen

FILE_SCHEMA = "path string, length long, mtime_ms long"


class Table:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.data_path = f"{self.path}/data"
        self.files_path = f"{self.path}/_files"
        self.log_path = f"{self.path}/_log"
        self._known: dict[str, dict] = {}

    # ---------------------------------------------------------------- log ---
    def commits(self) -> list[dict]:
        """Commit records in order: a small dict per load, each read once per ``Table``."""
        names = [n for n in list_names(self.spark, self.log_path) if n.endswith(".json")]
        for n in names:
            if n not in self._known:
                self._known[n] = json.loads(read_text(self.spark, f"{self.log_path}/{n}"))
        return [self._known[n] for n in sorted(names)]

    def exists(self) -> bool:
        return any(c["mode"] != "reject" for c in self.commits())

    def visible_loads(self) -> list[str]:
        visible: list[str] = []
        for c in self.commits():
            if c["mode"] == "overwrite":
                visible = []
            if c["mode"] != "reject":
                visible.append(c["load_id"])
        return visible

    def schema(self) -> StructType | None:
        kept = [c for c in self.commits() if c["mode"] != "reject"]
        return StructType.fromJson(kept[-1]["schema"]) if kept else None

    def has_load(self, load_id: str) -> bool:
        return any(c["load_id"] == load_id for c in self.commits())

    def merged_sources(self) -> set[str]:
        """Names of the staged inputs that commits of this table say they hold."""
        return {s for c in self.commits() for s in c.get("sources") or ()}

    # -------------------------------------------------------------- write ---
    def load_path(self, load_id: str) -> str:
        return f"{self.data_path}/load_id={load_id}"

    def stage_load(self, df: DataFrame, load_id: str, evolve: bool = True,
                   observed: dict[str, Column] | None = None) -> tuple[dict[str, int], StructType]:
        """Write ``df`` as (invisible) load ``load_id``; returns what the write counted (``rows`` and the
        ``observed`` aggregates) and the widened schema."""
        current = self.schema()
        if current is not None and not evolve:
            known = {c.lower() for c in current.names}
            extra = [f.name for f in df.schema.fields if f.name.lower() not in known]
            if extra:
                raise SchemaConflict(f"new columns without evolution: {extra}")
        merged = widen(current, df.schema)
        kinds = {f.name.lower(): f.dataType for f in merged.fields}
        if any(kinds[f.name.lower()] != f.dataType for f in df.schema.fields):  # a load is written with the table's types
            df = df.select(*[conform(F.col(f"`{f.name}`"), f.dataType, kinds[f.name.lower()]).alias(f.name) for f in df.schema.fields])
        obs = Observation(f"load_{load_id}")
        counters = {"rows": F.count(F.lit(1)), **(observed or {})}
        df.observe(obs, *[c.alias(k) for k, c in counters.items()]).write.mode("overwrite").parquet(self.load_path(load_id))
        got = obs.get
        return {k: int(got.get(k) or 0) for k in counters}, merged

    def commit_load(self, load_id: str, rows: int, schema: StructType, mode: str = "append", run_id: str = "",
                    files: DataFrame | None = None, sources: list[str] | None = None) -> None:
        if files is not None:
            files.write.mode("overwrite").json(f"{self.files_path}/load_id={load_id}")
        commits = self.commits()
        seq = commits[-1]["seq"] + 1 if commits else 1
        record = {"seq": seq, "load_id": load_id, "mode": mode, "rows": rows, "run_id": run_id, "has_files": files is not None,
                  "committed_at": _dt.datetime.now(_dt.timezone.utc).isoformat(), "schema": schema.jsonValue(), "sources": sources}
        create_text(self.spark, f"{self.log_path}/{seq:020d}.json", json.dumps(record) + "\n")

    def write_load(self, df: DataFrame, load_id: str, mode: str = "append", run_id: str = "",
                   files: DataFrame | None = None, evolve: bool = True, sources: list[str] | None = None) -> int:
        """Write ``df`` as load ``load_id`` and commit it; returns the rows written.

        Re-running an already committed ``load_id`` is a no-op returning 0.
        """
        if self.has_load(load_id):
            return 0
        got, merged = self.stage_load(df, load_id, evolve)
        self.commit_load(load_id, got["rows"], merged, mode, run_id, files, sources)
        return got["rows"]

    def create_empty(self, schema: StructType, run_id: str = "") -> bool:
        """Create the table with ``schema`` and no rows; no-op when it exists."""
        if self.exists():
            return False
        self.write_load(self.spark.createDataFrame([], schema), "empty", mode="overwrite", run_id=run_id)
        return True

    # --------------------------------------------------------------- read ---
    def read(self, with_load_id: bool = False) -> DataFrame:
        schema = self.schema()
        if schema is None:
            raise FileNotFoundError(f"table {self.path} has no commits")
        now = {f.name.lower(): f.dataType for f in schema.fields}
        # One scan for all loads of the same types: as many as there were changes of a type, and one more.
        groups: dict[str, tuple[StructType, list[str]]] = {}
        schemas = {c["load_id"]: c["schema"] for c in self.commits()}
        for load_id in self.visible_loads():
            wrote = StructType.fromJson(schemas[load_id])
            other = StructType([f for f in wrote.fields if now[f.name.lower()] != f.dataType])
            groups.setdefault(other.json(), (other, []))[1].append(self.load_path(load_id))
        out = None
        for other, paths in groups.values():
            then = {f.name.lower(): f for f in other.fields}
            written = StructType([then.get(f.name.lower(), f) for f in schema.fields])
            df = self.spark.read.schema(written).option("basePath", self.data_path).parquet(*paths)
            if other.fields:
                df = conform_frame(df, StructType([*schema.fields, df.schema["load_id"]]))
            out = df if out is None else out.unionByName(df)
        return out if with_load_id else out.select(*[F.col(f"`{c}`") for c in schema.names])

    def loaded_files(self) -> DataFrame:
        """``(path, length, mtime_ms)`` of every source file of the committed loads, read by Spark."""
        paths = [f"{self.files_path}/load_id={c['load_id']}" for c in self.commits() if c.get("has_files")]
        return self.spark.read.schema(FILE_SCHEMA).json(paths) if paths else self.spark.createDataFrame([], FILE_SCHEMA)

    # ----------------------------------------------------------- comments ---
    def comment(self, text: str, columns: dict[str, str] | None = None) -> None:
        """Describe the table and some of its columns; what was said before of others stays."""
        said = self.described()
        said = {"table": text or said["table"], "columns": {**said["columns"], **(columns or {})}}
        write_text(self.spark, f"{self.path}/_comments.json", json.dumps(said))

    def described(self) -> dict:
        path = f"{self.path}/_comments.json"
        return json.loads(read_text(self.spark, path)) if path_exists(self.spark, path) else {"table": None, "columns": {}}

    def comments(self) -> DataFrame:
        """``(object_name, comment)``: of the table (as ``TABLE``) and of every column."""
        said = self.described()
        rows = [("TABLE", said["table"])] + [(c, said["columns"].get(c)) for c in (self.schema() or StructType()).names]
        return self.spark.createDataFrame(rows, "object_name string, comment string")
