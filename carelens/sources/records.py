"""CSV records of files of any size, split in parallel although a quoted field may hold line ends.

A line end inside quotes does not end a record, and whether a byte stands inside quotes depends on
every quote before it.  The files are read as blocks of bytes (Spark's whole-file ``binaryFile`` source
cannot split a file, its text source can), twice.  The first reading leaves one row for each split: its
lines, the parity of its quotes, and how many records begin in it if it begins outside or inside
quotes.  Sums of these over the splits before tell where each split begins and at which number, so the
second reading makes the records as the lines stream by.  A file of any size is read by as many tasks
as it has splits, a record may cross any number of them, and no text is shuffled or stored on the way.

Lines that begin inside quotes belong to the record of the nearest earlier line that begins outside;
a record's lines are joined by the line end they were split at.  A record that crosses splits is
gathered by one small exchange of those lines alone.

In CSV as Python's ``csv`` module and spreadsheets write it, a quote inside a field is doubled, which
leaves the parity as it was; so the parity alone decides.  A file with an odd number of quotes has
a record open to its end, as for the ``csv`` module.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'


def lines(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """file, split, and the text of every line, line end ``\\n`` taken off; in the order of the file within a split.

    A carriage return before the line end stays in ``text``.  Whoever reads the rows gets the same splits."""
    read = spark.read.option("lineSep", "\n").option("encoding", encoding).text(path)
    return _held(read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                             F.col("value").alias("text")))


def _held(read: DataFrame) -> DataFrame:
    """The same rows, by the same tasks in every plan.  Spark splits the files anew for each plan, by the
    settings and cores it has by then; the RDD below keeps its splits (as under a checkpoint, with nothing stored)."""
    spark = read.sparkSession
    rows = read._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, read._jdf.schema(), False), spark)


def split_table(found: DataFrame) -> DataFrame:
    """One row for each split of ``lines``: file, split, lines, records (that begin in it), records_before,
    ``opened`` and ``goes_on`` (it begins and ends inside quotes), and ``head``, in a file's first split the
    first record if it ends there.  Checkpointed, as it is read several times."""
    ensure_checkpoint_dir(found.sparkSession)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = found.mapInArrow(_counted, COUNTED).withColumn("opened", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1)
    records = F.when(F.col("opened"), F.col("inside")).otherwise(F.col("outside"))
    return sums.select("file", "split", "lines", records.alias("records"), F.coalesce(F.sum(records).over(before), F.lit(0)).alias("records_before"),
                       "opened", (F.col("opened") != (F.col("odd") == 1)).alias("goes_on"), "head").checkpoint(eager=True)


def split_records(found: DataFrame, splits: DataFrame | None = None) -> DataFrame:
    """(file, number, record): the records of every file, numbered from 1 (the header); blank lines are none.

    ``found`` are ``lines``, ``splits`` their ``split_table`` or some rows of it.  Reading the result reads the
    files; a split that no longer has the table's lines and records stops it."""
    splits = split_table(found) if splits is None else splits
    whole = _made(found, splits).where("NOT part").select("file", "number", "record")
    cut = splits.where("opened OR goes_on")
    if cut.isEmpty():
        return whole
    # records over several splits: at most two pieces of each split, one of which belongs to the last record before it
    joined = (_made(found, cut).where("part").groupBy("file", "number")
              .agg(F.array_sort(F.collect_list(F.struct("split", "record"))).alias("parts"))
              .select("file", "number", F.array_join("parts.record", "\n").alias("record")))
    return whole.union(joined)


def first_records(found: DataFrame, splits: DataFrame) -> DataFrame:
    """(file, number, record): the first record of every file."""
    known = splits.where("head IS NOT NULL").select("file", F.lit(1).cast("long").alias("number"), F.col("head").alias("record"))
    # a first record that begins or ends beyond the first split is read with the splits it lies in
    rest = (splits.join(known.select("file"), "file", "left_anti")
            .where("records_before = 0 OR records_before = 1 AND opened"))
    return known if rest.isEmpty() else known.union(split_records(found, rest).where("number = 1"))


def _made(found: DataFrame, splits: DataFrame) -> DataFrame:
    # no shuffle: the lines stay in the order of the file, as ``_pieces`` needs them; the driver's list of files is as long as the table
    return found.join(F.broadcast(splits.drop("head")), ["file", "split"]).select("file", "split", "text", *STATE).mapInArrow(_pieces, PIECES)


COUNTED = "file string, split long, lines long, odd long, outside long, inside long, head string"
STATE = ["lines", "records", "records_before", "opened", "goes_on"]
PIECES = "file string, split long, number long, part boolean, record string"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """((file, split), the rows) for every run of rows of one split in a batch."""
    for b in batches:
        if not b.num_rows:
            continue
        file, split = b.column(0), b.column(1).to_numpy()
        same = pc.equal(file.slice(1), file.slice(0, len(file) - 1)).to_numpy(zero_copy_only=False)
        ends = [*(np.flatnonzero(~same | (split[1:] != split[:-1])) + 1), b.num_rows]
        for start, end in zip([0, *ends], ends):
            yield (file[start].as_py(), int(split[start])), b.slice(start, end - start)


def _odd(text: pa.Array) -> np.ndarray:
    return pc.count_substring(text, QUOTE).to_numpy() & 1


def _begins(text: pa.Array) -> np.ndarray:
    """Not blank: outside quotes a record begins here."""
    return ~pc.is_in(text, value_set=pa.array(["", "\r"], text.type)).to_numpy(zero_copy_only=False)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its lines, the parity of its quotes, the records that begin in it if it
    begins outside quotes and if inside, and the first record of the file if it begins and ends here."""
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    names = [c.split()[0] for c in COUNTED.split(", ")]
    at = None

    def row() -> pa.RecordBatch:
        values = (*at, lines, odd, outside, inside, "\n".join(head) if ended else None)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    for key, rows in _runs(batches):
        if key != at:
            if at:
                yield row()
            at, lines, odd, outside, inside, head, ended = key, 0, 0, 0, 0, [], False
        text = rows.column(2)
        odds, begins = _odd(text), _begins(text)
        upto = np.cumsum(odds) + odd
        within = (upto - odds) & 1
        if key[1] == 0 and not ended and (head or begins.any()):  # a file begins outside quotes
            first = 0 if head else int(begins.argmax())
            close = np.flatnonzero(upto[first:] & 1 == 0)
            last = first + int(close[0]) + 1 if close.size else len(text)
            head += text.slice(first, last - first).to_pylist()
            ended = bool(close.size)
        lines, odd = lines + len(text), int(upto[-1]) & 1
        outside, inside = outside + int((begins & (within == 0)).sum()), inside + int((begins & (within == 1)).sum())
    if at:
        yield row()


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of each split put together to records.  ``part``: begun in an earlier split, and then with the
    number of the last record before this one, or going on in the next."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    at = None

    def made(number, part, record) -> pa.RecordBatch:
        n = len(record)
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array(number, pa.int64()), pa.array(part, pa.bool_()),
             record.cast(pa.string()) if isinstance(record, pa.Array) else pa.array(record, pa.string())], names=names)

    def rest() -> Iterator[pa.RecordBatch]:
        if (seen, number - before, bool(inside)) != end:
            raise ValueError(f"{at[0]} changed while it was read (split {at[1]})")
        if held:
            yield made([number], [True], ["\n".join(held)])

    for key, rows in _runs(batches):
        if key != at:
            if at:
                yield from rest()
            total, begun, number, inside, goes_on = (rows.column(2 + k)[0].as_py() for k in range(1, 6))
            # held: the lines so far of a record that is open; cut: it was begun in an earlier split
            at, before, seen, end, held, cut = key, number, 0, (total, begun, goes_on), [], inside
        text = rows.column(2)
        odds, begins = _odd(text), _begins(text)
        seen += len(text)
        if not inside and not odds.any():  # every line is a record
            whole = text.filter(pa.array(begins))
            if len(whole):
                yield made(np.arange(number + 1, number + 1 + len(whole)), np.zeros(len(whole), bool), whole)
            number += len(whole)
            continue
        out = []
        for line, odd, begin in zip(text.to_pylist(), odds.tolist(), begins.tolist()):
            if inside:
                held.append(line)
            elif begin:
                number, held = number + 1, [line]
            inside = inside != bool(odd)
            if held and not inside:
                out.append((number, cut, "\n".join(held)))
                held, cut = [], False
        if out:
            yield made(*map(list, zip(*out)))
    if at:
        yield from rest()


def fields(records: DataFrame, names: list[str], corrupt: str) -> DataFrame:
    """The records' fields as strings beside ``file`` and ``number``.

    A record with fewer fields than ``names`` has NULL for the missing ones, and, as one with more,
    its text in the column ``corrupt``."""
    schema = ", ".join(f"`{n}` string" for n in [*names, corrupt])
    got = F.from_csv(F.regexp_replace("record", "\r$", ""), schema, {
        "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "maxCharsPerColumn": "-1",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    return records.select("file", "number", got.alias("csv")).select("file", "number", "csv.*")
