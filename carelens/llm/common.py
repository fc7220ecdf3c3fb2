"""Helpers shared by the text operators: the word pattern, null-safe text, let-binding."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: A word is a maximal run without blank, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Prefix of columns that operators add for themselves, apart from any name in the input.
OWN = "_llm_"
#: monotonically_increasing_id holds the partition above these bits, the place in it below.
PLACE_BITS = 33


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda parameter is never
    inlined, so it may be used again and again inside inner lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def equal_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Null-safe equi-join condition (null equals null; still a hash/sort key for Spark)."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows range-partitioned and sorted by ``order`` (nulls first) and checkpointed, with
    their place (partition in the high bits, see ``PLACE_BITS``) in the column ``_llm_place``."""
    ensure_checkpoint_dir(rows.sparkSession)
    sort = [F.col(c).asc_nulls_first() for c in order]
    return (rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
            .withColumn(f"{OWN}place", F.monotonically_increasing_id()).checkpoint(eager=True))


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """``name`` = 0, 1, ... in each group by ``order``; the rows move once, by range, so a group of
    any size is spread.  The offsets have one row per group and range that meet."""
    placed = in_order(rows, [*group, *order])
    place, part = F.col(f"{OWN}place"), f"{OWN}part"
    placed = placed.withColumn(part, F.shiftright(place, PLACE_BITS))
    per = placed.groupBy(*group, part).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = per.select(*[F.col(c).alias(f"{OWN}g{i}") for i, c in enumerate([*group, part])],
                       (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(f"{OWN}shift"))
    both = placed.join(shift, equal_keys(placed, shift, [(c, f"{OWN}g{i}") for i, c in enumerate([*group, part])]))
    return both.select(*rows.columns, (place + F.col(f"{OWN}shift")).alias(name))


def release(spark: SparkSession) -> None:
    """Free the shuffle files and checkpoints of steps that are done.  Spark's cleaner removes them once
    nothing refers to them, but learns of that only when the driver's JVM collects garbage, which by
    itself may be half an hour later, with the files of every step before still on the disks."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
