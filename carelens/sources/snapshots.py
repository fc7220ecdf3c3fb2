"""Load snapshots: all tables of a load become current in one step, or none does.

A load writes its tables under ``<root>/loads/<id>/<table>``, where no reader looks.  Its commit is one
small file ``<root>/commits/<number>.json`` with the places of all its tables, written under another
name first and renamed to the next free number; the rename fails if the number is taken, so of two
loads at the same time one commits after the other, and no reader ever sees half a commit.  Readers
take the commit of the highest number and find every table through it.  A load that dies at any point
before the rename leaves the last commit, and the tables it names, as they were.

Numbers and names go through Hadoop's file system API, so any store that Spark writes to will do
whose renames don't overwrite (HDFS, ABFS, local disks; on S3 with a committer that provides this).
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

DIGITS = 12


class Conflict(RuntimeError):
    """The next number was taken again and again by other loads."""


def _context(spark: SparkSession, path: str):
    """Hadoop's file context of a path, and the path."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    where = where.getFileSystem(conf).makeQualified(where)
    return jvm, jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf), where


def _rename(spark: SparkSession, source: str, target: str) -> bool:
    """Whether the file could be moved to a name that was free."""
    from py4j.protocol import Py4JJavaError

    jvm, context, to = _context(spark, target)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), to, how)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
            return False
        raise
    return True


def _numbers(spark: SparkSession, root: str) -> list[int]:
    """The committed numbers, ascending."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[:DIGITS]) for n in names if n.endswith(".json") and n[:DIGITS].isdigit())


def _commit_path(root: str, number: int) -> str:
    return f"{root}/commits/{number:0{DIGITS}d}.json"


@dataclass
class Snapshot:
    """A committed load: its number, id and the place of every table."""

    number: int
    load: str
    tables: dict[str, str]

    def read(self, spark: SparkSession, name: str, schema=None) -> DataFrame:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(self.tables[name])


@dataclass
class Load:
    """A load under way: tables written so far, seen by nobody until ``commit``."""

    spark: SparkSession
    root: str
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    tables: dict[str, str] = field(default_factory=dict)

    def write(self, name: str, rows: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table of the load and read it back (later tables are built from what was written)."""
        path = f"{self.root}/loads/{self.id}/{name}"
        writer = rows.write.partitionBy(partition_by) if partition_by else rows.write
        writer.parquet(path)
        self.tables[name] = path
        return self.spark.read.schema(rows.schema).parquet(path)

    def commit(self, tries: int = 100) -> Snapshot:
        """Make all written tables current at once."""
        jvm = self.spark.sparkContext._jvm
        held = f"{self.root}/loads/{self.id}/commit.json"
        path = jvm.org.apache.hadoop.fs.Path(held)
        out = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
        try:
            out.write(bytearray(json.dumps({"load": self.id, "tables": self.tables}).encode()))
        finally:
            out.close()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/commits")
        folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
        for _ in range(tries):
            number = max(_numbers(self.spark, self.root), default=0) + 1
            if _rename(self.spark, held, _commit_path(self.root, number)):
                return Snapshot(number, self.id, dict(self.tables))
        raise Conflict(f"no free number under {self.root}/commits after {tries} tries")


def begin(spark: SparkSession, root: str) -> Load:
    return Load(spark, root.rstrip("/"))


def at(spark: SparkSession, root: str, number: int) -> Snapshot:
    """The snapshot of a number (older ones stay readable while their tables are kept)."""
    text = spark.read.option("wholetext", True).text(_commit_path(root.rstrip("/"), number)).first()[0]
    made = json.loads(text)
    return Snapshot(number, made["load"], made["tables"])


def last(spark: SparkSession, root: str) -> Snapshot | None:
    """The snapshot committed last, if there is one."""
    numbers = _numbers(spark, root.rstrip("/"))
    return at(spark, root, numbers[-1]) if numbers else None


def current(spark: SparkSession, root: str) -> Snapshot:
    """The snapshot committed last."""
    found = last(spark, root)
    if found is None:
        raise AnalysisException(f"no load has been committed under {root}")
    return found


def every(spark: SparkSession, root: str) -> list[Snapshot]:
    """All committed snapshots, the oldest first."""
    return [at(spark, root, n) for n in _numbers(spark, root.rstrip("/"))]


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of all committed loads that have it (for states, which are merged over loads)."""
    paths = [s.tables[name] for s in every(spark, root) if name in s.tables]
    if not paths:
        raise AnalysisException(f"no load under {root} has a table {name}")
    return spark.read.parquet(*paths)
