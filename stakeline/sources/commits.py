"""Tables that grow by loads: several tables, one atomic step, the same outcome when repeated.

A load writes its rows of every table into folders of its own and is published by one small file
that appears whole or not at all. Readers see the folders of published loads only, so what a crash
leaves behind is never read, and both tables of a load appear at once. The published file names
what was loaded, so a load that was done is known and skipped, and it holds the greatest id, so
continuing the ids reads no table.

Loads are numbered without gaps. Of two that run at the same time one gets the next number; the
other finds it taken and fails without being seen, and can be repeated.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stakeline.sources.tables import table_exists

LOAD = "load_id"
_COMMITS = "commits"
_COMMIT = "number long, load_id string, key string, greatest_id long, details map<string, long>"


class LoadTaken(RuntimeError):
    """Another load was published since this one began."""


@dataclass(frozen=True)
class Commit:
    """A published load: its key (what was loaded), its greatest id, and counts of it."""

    number: int
    load_id: str
    key: str
    greatest_id: int | None
    details: dict[str, int] = field(default_factory=dict)


class LoadedTables:
    """The tables under ``root``, each a folder of loads."""

    def __init__(self, spark: SparkSession, root: str):
        self._spark, self.root = spark, root

    def commits(self) -> list[Commit]:
        """All published loads, oldest first: one small file each."""
        folder = f"{self.root}/{_COMMITS}"
        if not table_exists(self._spark, folder):
            return []
        rows = self._spark.read.schema(_COMMIT).json(folder).collect()
        return sorted(
            (Commit(**{**r.asDict(), "details": dict(r.details or {})}) for r in rows),
            key=lambda c: c.number,
        )

    def find(self, key: str) -> Commit | None:
        """The published load of this key."""
        return next((c for c in self.commits() if c.key == key), None)

    def greatest_id(self) -> int | None:
        """The greatest id of all published loads, without reading a table."""
        ids = [c.greatest_id for c in self.commits() if c.greatest_id is not None]
        return max(ids, default=None)

    def begin(self, key: str) -> Load:
        return Load(self, key, len(self.commits()), uuid4().hex)

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """The rows of a table's published loads. Folders of other loads are not even listed.

        Every load writes all its tables. Before the first one there is only the schema to go by.
        """
        paths = [f"{self.root}/{table}/{c.load_id}" for c in self.commits()]
        if not paths and schema is None:
            raise FileNotFoundError(f"no load of {self.root} is published")
        if not paths:
            return self._spark.createDataFrame([], schema)
        reader = self._spark.read
        return (reader.schema(schema) if schema else reader).parquet(*paths)

    def discard_unpublished(self, table: str) -> int:
        """Deletes what loads that were never published left in a table; returns their number.

        For times when no load runs.
        """
        known = {c.load_id for c in self.commits()}
        folder = _path(self._spark, f"{self.root}/{table}")
        files = _files(self._spark, folder)
        if not files.exists(folder):
            return 0
        left = [s.getPath() for s in files.listStatus(folder) if s.getPath().getName() not in known]
        for path in left:
            files.delete(path, True)
        return len(left)


@dataclass(frozen=True)
class Load:
    """One load while it is written."""

    tables: LoadedTables
    key: str
    number: int
    load_id: str

    def write(self, df: DataFrame, table: str) -> None:
        """The load's rows of one table; a repeated attempt replaces them."""
        df.write.mode("overwrite").parquet(f"{self.tables.root}/{table}/{self.load_id}")

    def publish(self, greatest_id: int | None = None, **details: int) -> Commit:
        """Makes all tables of the load visible at once, or raises ``LoadTaken``."""
        commit = Commit(self.number, self.load_id, self.key, greatest_id, details)
        name = f"{self.tables.root}/{_COMMITS}/{self.number:08d}.json"
        if not _create_whole(self.tables._spark, name, json.dumps(commit.__dict__)):
            raise LoadTaken(f"load {self.number} of {self.tables.root} is already published")
        return commit


def append_once(df: DataFrame, root: str, table: str, key: str) -> Commit:
    """Appends rows under a key; a repetition of the key appends nothing."""
    tables = LoadedTables(df.sparkSession, root)
    done = tables.find(key)
    if done is not None:
        return done
    load = tables.begin(key)
    load.write(df, table)
    return load.publish()


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def _files(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _create_whole(spark: SparkSession, name: str, text: str) -> bool:
    """Creates a file with its whole content at once; False if there is one of that name.

    The content goes to a hidden file first, which is then renamed without replacing.
    """
    jvm, final = spark._jvm, _path(spark, name)
    files = _files(spark, final)
    hidden = _path(spark, f"{final.getParent()}/_{uuid4().hex}")
    out = files.create(hidden, False)
    out.write(bytearray(f"{text}\n".encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.makeQualified(files.getUri(), files.getWorkingDirectory()).toUri(),
        spark._jsc.hadoopConfiguration(),
    )
    try:
        context.rename(hidden, final, options)
    except Py4JJavaError as error:
        files.delete(hidden, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True
