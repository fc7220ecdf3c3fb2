"""CSV claim files: raw read with a declared schema, header contract, strict read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLAIMS_SCHEMA, EXPECTED_COLUMNS, RAW_SCHEMA
from ..session import ensure_checkpoint_dir
from . import records

CORRUPT = "_corrupt_record"


def check_header(spark: SparkSession, path: str, expected=EXPECTED_COLUMNS) -> list[str]:
    """Raise ValueError unless the trimmed header equals ``expected`` in order; returns it as spelt.

    Without schema inference the reader only parses the header line, so this is one
    tiny job; the data is not scanned.
    """
    spelt = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    got = [c.strip() for c in spelt]
    if got != list(expected):
        raise ValueError("CSV columns don't match expected schema.\n"
                         f"  Expected: {list(expected)}\n  Got:      {got}")
    return spelt


def whole_rows(read: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """An empty field is an empty text; only what a short row lacks is NULL."""
    whole = F.col(CORRUPT).isNull()
    return read.select(*[F.when(whole, F.coalesce(f"`{c}`", F.lit(""))).otherwise(F.col(f"`{c}`")).alias(c.strip())
                         for c in read.columns if c not in (CORRUPT, *(carry or []))], CORRUPT, *(carry or []))


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = False,
                 encoding: str = "UTF-8", check: bool = True) -> DataFrame:
    """All 15 fields as strings (no inference), blanks preserved for the validator.

    A short row arrives NULL-padded; the malformed line is kept in ``_corrupt_record``.  With
    ``check`` every file must carry the first file's header (Spark compares them as it reads).
    """
    names = check_header(spark, path) if check else RAW_SCHEMA.names
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, CORRUPT]])
    read = (spark.read.schema(schema)
                 .option("header", True)
                 .option("escape", '"')
                 .option("enforceSchema", not check)
                 .option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", CORRUPT)
                 .option("ignoreLeadingWhiteSpace", False)
                 .option("ignoreTrailingWhiteSpace", False)
                 .option("multiLine", multi_line)
                 .option("encoding", encoding)
                 .csv(path))
    return whole_rows(read)


def read_numbered_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", check: bool = True, name: str = "line") -> DataFrame:
    """As ``read_raw_csv`` with the number of every record in its file (the first after the header is 2),
    and with records whose quoted fields hold line ends, in files that are split all the same.

    The files are read once for the numbers, and again by whatever reads the result; their texts are not stored.
    With ``check`` one job compares the first record of every file and names the file that differs."""
    found = records.lines(spark, path, encoding)
    splits = records.split_table(found)
    if check:
        differs = " OR ".join(f"NOT (trim(`{c}`) <=> '{c}')" for c in EXPECTED_COLUMNS)
        first = records.fields(records.first_records(found, splits), EXPECTED_COLUMNS, CORRUPT)
        wrong = first.where(f"{differs} OR `{CORRUPT}` IS NOT NULL").orderBy("file").limit(1).collect()
        if wrong:
            raise ValueError(f"CSV columns of {wrong[0]['file']} don't match expected schema.\n  Expected: {EXPECTED_COLUMNS}\n"
                             f"  Got:      {wrong[0][CORRUPT] or [wrong[0][c] for c in EXPECTED_COLUMNS]}")
    made = records.fields(records.split_records(found, splits), EXPECTED_COLUMNS, CORRUPT)
    return whole_rows(made.where("number > 1").drop("file").withColumnRenamed("number", name), carry=[name])


def with_line_numbers(raw: DataFrame, name: str = "line") -> DataFrame:
    """Number records in file order, per file, starting at 2 (line 1 is the header).

    A CSV split is read in file order and Spark keeps the splits of one file in offset
    order, so (partition id, position in partition) orders the records of a file.  The
    tagged rows are checkpointed once, so the numbers hold however a later scan would be
    split; counts per (file, partition) - about one row per split - have running sums that
    give each split's first line.
    """
    ensure_checkpoint_dir(raw.sparkSession)
    tagged = (raw.withColumn("_file", F.col("_metadata.file_path"))
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_pos", F.monotonically_increasing_id()).checkpoint(eager=True))
    per_split = tagged.groupBy("_file", "_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                                   F.min("_pos").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_split.select("_file", "_pid", "_first",
                               F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    j = tagged.join(offsets, ["_file", "_pid"])
    line = F.col("_off") + (F.col("_pos") - F.col("_first")) + 2
    return j.withColumn(name, line.cast("long")).drop("_file", "_pid", "_pos", "_first", "_off")


def read_strict(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Typed read that fails on the first unconvertible field (legacy strict load)."""
    check_header(spark, path)
    typed = CLAIMS_SCHEMA
    return (spark.read.schema(typed).option("header", True).option("escape", '"').option("mode", "FAILFAST")
                 .option("dateFormat", "yyyy-MM-dd").option("encoding", encoding).csv(path))


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """Write raw claims as CSV with the expected header (blanks kept)."""
    (raw.select(*[F.col(f"`{c}`") for c in EXPECTED_COLUMNS])
        .write.mode("overwrite").option("header", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path))
