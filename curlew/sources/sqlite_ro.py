"""Read-only SQLite files as a Spark data source: rows, and catalog profiles.

``spark.read.format("sqlite_ro").option("paths", "a.db,b.db").option("table", "projects")``
gives (source, table_name, row MAP<STRING,STRING>, raw_json STRING): one input
partition for each file and table, column names in lower case, blobs as UTF-8 text in
``row`` and as ``{"bytes_hex": ...}`` in ``raw_json``. Without ``table`` every table is
read. ``mode=profile`` gives one row for each table: (source, quick_check,
table_name, row_count, columns, primary_key, error). A file that can't be opened is
a row with its error in profile mode and fails the scan otherwise.
"""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from curlew.session import importable

BATCH = 1000


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def connect(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def tables_of(connection: sqlite3.Connection) -> dict[str, str]:
    """Lower-case name -> name of the user tables."""
    rows = connection.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name")
    return {n.lower(): n for (n,) in rows}


def as_text(value: object) -> str | None:
    if value is None:
        return None
    return value.decode("utf-8", "replace") if isinstance(value, bytes) else str(value)


def raw_json(row: dict[str, object]) -> str:
    return json.dumps(row, sort_keys=True, ensure_ascii=False, default=lambda v: {"bytes_hex": v.hex()} if isinstance(v, bytes) else str(v))


class _Part(InputPartition):
    def __init__(self, path: str, table: str):
        self.path, self.table = path, table


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p.strip() for p in options["paths"].split(",") if p.strip()]
        self.table, self.profile = options.get("table", "").lower(), options.get("mode", "rows") == "profile"

    def partitions(self) -> list[InputPartition]:
        if self.profile:
            return [_Part(p, "") for p in self.paths]
        out = []
        for p in self.paths:
            connection = connect(p)
            try:
                out += [_Part(p, t) for t in tables_of(connection) if not self.table or t == self.table]
            finally:
                connection.close()
        return out or [_Part("", "")]

    def read(self, partition: _Part) -> Iterator[tuple]:
        if not partition.path:
            return
        yield from self._profile(partition.path) if self.profile else self._rows(partition.path, partition.table)

    @staticmethod
    def _rows(path: str, table: str) -> Iterator[tuple]:
        connection = connect(path)
        try:
            cursor = connection.execute(f"SELECT * FROM {quoted(tables_of(connection)[table])}")
            names = [d[0].lower() for d in cursor.description]
            while batch := cursor.fetchmany(BATCH):
                for values in batch:
                    row = dict(zip(names, values))
                    yield path, table, {k: as_text(v) for k, v in row.items()}, raw_json(row)
        finally:
            connection.close()

    @staticmethod
    def _profile(path: str) -> Iterator[tuple]:
        try:
            connection = connect(path)
            check = (connection.execute("PRAGMA quick_check").fetchone() or ("NO_RESULT",))[0]
            for table, name in tables_of(connection).items():
                info = connection.execute(f"PRAGMA table_info({quoted(name)})").fetchall()
                count = connection.execute(f"SELECT count(*) FROM {quoted(name)}").fetchone()[0]
                yield path, check, table, count, [c[1] for c in info], [c[1] for c in sorted(info, key=lambda c: c[5]) if c[5]], None
            connection.close()
        except sqlite3.Error as e:
            yield path, None, None, None, None, None, f"{type(e).__name__}: {e}"


class SqliteReadOnly(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_ro"

    def schema(self) -> str:
        if self.options.get("mode", "rows") == "profile":
            return "source string, quick_check string, table_name string, row_count long, columns array<string>, primary_key array<string>, error string"
        return "source string, table_name string, row map<string,string>, raw_json string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(SqliteReadOnly)
