"""A loaded table in the session catalog: a view over its visible loads that carries its comments (plain SQL, quotes escaped)."""
from __future__ import annotations

from sluice.plans.tables import Table


def quote_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def expose(table: Table, name: str) -> None:
    """Create or replace the catalog view ``name`` of what ``table`` shows now, with the comments of table and columns.

    Only committed loads are in it (a staged or refused one never is); columns that an older load lacks are NULL there. To be
    called again after each load.
    """
    spark, schema, said = table.spark, table.schema(), table.described()
    columns = [quote_name(f"{f.name}") + (f" COMMENT {quote_text(said['columns'][f.name])}" if f.name in said["columns"] else "") for f in schema.fields]
    parts = []
    for load in table.visible_loads():
        path = table.load_path(load)
        have = {c.lower() for c in spark.read.parquet(path).columns}
        cells = [(quote_name(f.name) if f.name.lower() in have else f"CAST(NULL AS {f.dataType.simpleString()})") + f" AS {quote_name(f.name)}" for f in schema.fields]
        parts.append(f"SELECT {', '.join(cells)} FROM parquet.{'`' + path.replace('`', '``') + '`'}")
    comment = f" COMMENT {quote_text(said['table'])}" if said["table"] else ""
    spark.sql(f"CREATE OR REPLACE VIEW {quote_name(name)} ({', '.join(columns)}){comment} AS {' UNION ALL '.join(parts)}")
