"""SQLite tables as a data source: ranges of row ids are partitions, a condition and the columns go into each query.

The file must lie where all executors see it by the same path (a mounted folder). Filters are not
taken from Spark's plan: in Spark 4.1 a frame that is used twice keeps those of its first use.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: SQLite's declared types, by the affinity that their names give.
_TYPES = [("INT", "bigint"), ("CHAR", "string"), ("CLOB", "string"), ("TEXT", "string"), ("BLOB", "binary"), ("REAL", "double"), ("FLOA", "double"), ("DOUB", "double")]


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path.removeprefix('file://')}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


@dataclass
class _Range(InputPartition):
    low: int
    high: int


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, parts: int, where: str):
        self.path, self.table, self.names, self.parts, self.where = path, table, schema.names, parts, where

    def partitions(self) -> list[InputPartition]:
        with _open(self.path) as c:
            low, high = c.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
        if low is None:
            return [_Range(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [_Range(at, min(at + step - 1, high)) for at in range(low, high + 1, step)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        c = _open(self.path)
        try:
            query = f"SELECT {', '.join(map(_quoted, self.names))} FROM {_quoted(self.table)} WHERE rowid BETWEEN ? AND ? AND ({self.where})"
            yield from c.execute(query, (partition.low, partition.high))
        finally:
            c.close()


class SqliteSource(DataSource):
    """spark.read.format("sqlite") with the options path, table, partitions, where (SQLite's SQL); a schema names the columns wanted."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> str:
        with _open(self.options["path"]) as c:
            found = c.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        kind = lambda declared: next((t for part, t in _TYPES if part in declared.upper()), "string")
        return ", ".join(f"`{name}` {kind(declared or '')}" for _, name, declared, *_ in found)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["table"], schema, int(self.options.get("partitions", "2")), self.options.get("where", "1"))
