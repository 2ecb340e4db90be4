"""Snapshots of several tables: an append-only log, published by one atomic step.

A snapshot is a file ``log/<number>.json`` that names the folders of every table
and their schemas. Folders are written once and never changed, so a reader of a
snapshot sees one state whatever writers do. A writer begins at a snapshot,
writes new folders, and publishes the next number; who comes second finds the
number taken and is refused, so no writer undoes another's work unseen. What a
writer left that stopped before publishing is not named by any snapshot.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(RuntimeError):
    """Another writer has published since this one began."""


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def put_text(spark: SparkSession, path: str, value: str) -> None:
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    out.write(value.encode("utf-8"))
    out.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """The file's text, None where there is none; for small files."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def publish(spark: SparkSession, made: str, path: str) -> bool:
    """Moves a finished file to its place if that is free; False if another one is there."""
    fs, source = _fs(spark, made)
    target = _fs(spark, path)[1]
    if fs.getScheme() == "file":  # a local rename replaces what is there, a link does not
        try:
            os.link(source.toUri().getPath(), target.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            fs.delete(source, False)
        return True
    done = fs.rename(source, target)
    if not done:
        fs.delete(source, False)
    return done


class Snapshots:
    """The log of the tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, number: int) -> str:
        return f"{self.path}/log/{number:012d}.json"

    def latest(self) -> int:
        """The number of the last snapshot, 0 before the first."""
        fs, where = _fs(self.spark, f"{self.path}/log")
        names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
        return max((int(n[:12]) for n in names if n.endswith(".json") and n[:12].isdigit()), default=0)

    def state(self, number: int | None = None) -> dict:
        """{number, tables: {name: {folders, schema}}, notes} of a snapshot, the last one by default; a KeyError for one that is not there."""
        number = self.latest() if number is None else number
        if not number:
            return {"number": 0, "tables": {}, "notes": {}}
        found = get_text(self.spark, self._file(number))
        if found is None:
            raise KeyError(f"no snapshot {number} in {self.path}")
        return json.loads(found)

    def read(self, table: str, number: int | None = None) -> DataFrame:
        """A table at a snapshot; a KeyError for a table that the snapshot lacks."""
        entry = self.state(number)["tables"][table]
        schema = StructType.fromJson(entry["schema"])
        folders = [f"{self.path}/{f}" for f in entry["folders"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def begin(self) -> Transaction:
        return Transaction(self, self.state())

    def unused(self) -> list[str]:
        """Folders below ``data`` that no snapshot names: what stopped writers left. A writer at work owns some of them too."""
        fs, where = _fs(self.spark, f"{self.path}/data")
        there = {f"data/{s.getPath().getName()}" for s in fs.listStatus(where)} if fs.exists(where) else set()
        named = {f for n in range(1, self.latest() + 1) for t in self.state(n)["tables"].values() for f in t["folders"]}
        return sorted(there - named)


class Transaction:
    """Changes of one writer to the tables of a snapshot. Nothing is seen before ``commit``."""

    def __init__(self, log: Snapshots, base: dict):
        self.log, self.base = log, base
        self.tables = {k: {"folders": [*v["folders"]], "schema": v["schema"]} for k, v in base["tables"].items()}
        self.notes = dict(base["notes"])

    def folder(self, table: str) -> str:
        """A new folder's name, for writers that lay out their files themselves; ``name`` it before the commit."""
        return f"data/{table}-{uuid.uuid4().hex[:12]}"

    def name(self, table: str, folders: list[str], schema: StructType) -> None:
        """The table consists of these folders."""
        self.tables[table] = {"folders": folders, "schema": json.loads(schema.json())}

    def append(self, table: str, df: DataFrame) -> None:
        """The rows of ``df`` are added. A ValueError where its columns are not the table's."""
        entry = self.tables.get(table)
        if entry and [(f["name"], f["type"]) for f in entry["schema"]["fields"]] != [(f["name"], f["type"]) for f in json.loads(df.schema.json())["fields"]]:
            raise ValueError(f"{table} has other columns")
        folder = self.folder(table)
        df.write.option("compression", "zstd").parquet(f"{self.log.path}/{folder}")
        self.name(table, [*(entry["folders"] if entry else []), folder], df.schema)

    def replace(self, table: str, df: DataFrame) -> None:
        """The table becomes ``df``, which may have been read from it."""
        self.tables.pop(table, None)
        self.append(table, df)

    def commit(self) -> int:
        """Publishes the next snapshot and returns its number. Conflict where another writer has published since ``begin``."""
        number = self.base["number"] + 1
        made = f"{self.log.path}/log/.{uuid.uuid4().hex}.tmp"
        put_text(self.log.spark, made, json.dumps({"number": number, "tables": self.tables, "notes": self.notes}))
        if not publish(self.log.spark, made, self.log._file(number)):
            raise Conflict(f"snapshot {number} of {self.log.path} was published by another writer")
        return number
