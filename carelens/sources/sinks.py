"""Sinks: staging, star schema, ranking table and reports as parquet/CSV/JSON.

Each table is one ``write.mode("overwrite")`` — partitioned writers replace the
reference's 1,000-row insert batches.  ``write_star`` writes every table of a
load to a fresh directory and only then points ``current`` at it, so readers
never see staging and star schema out of step.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame


def write_staging(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def write_star(tables: dict[str, DataFrame], root: str) -> str:
    """Write every table under ``root/<load-id>/<name>``; returns the load directory."""
    load = f"{root.rstrip('/')}/load-{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{load}/{name}")
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(load,)], "current string").coalesce(1) \
         .write.mode("overwrite").text(f"{root.rstrip('/')}/current")
    return load


def current_load(spark, root: str) -> str:
    return spark.read.text(f"{root.rstrip('/')}/current").first()[0]


def write_ranking(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_report(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Reports are DataFrames; ``fmt`` is ``json`` or ``csv`` (with header)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.json(path)
