"""Records with line ends in quotes, in files of any number of splits, against Python's csv module."""

import contextlib
import csv
import os
import random
import secrets

import pytest

from carelens.schema import EXPECTED_COLUMNS
from carelens.session import ensure_checkpoint_dir
from carelens.sources import files

from .conftest import RAW_ROW


def write(path, rows, end="\r\n"):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(EXPECTED_COLUMNS)
        for k, r in enumerate(rows):
            out.writerow(r)
            if k % 7 == 3:
                f.write(end)  # a blank line is no record


@pytest.mark.parametrize("splits", [1, 3, 50])
def test_rows_and_numbers_equal_the_csv_module(spark, tmp_dir, splits):
    r, total = random.Random(splits), 0
    bits = ['"', "\n", ",", "\r\n", "é", "a", "plain text", " ", '""', "\n\n"]
    os.makedirs(f"{tmp_dir}/in")
    for name, end in (("a", "\r\n"), ("b", "\n")):
        rows = [[*("".join(r.choice(bits) for _ in range(r.randint(0, 6))) for _ in EXPECTED_COLUMNS[:3]), *list(RAW_ROW.values())[3:]] for _ in range(120)]
        rows.append(["x\n" * 3000, *list(RAW_ROW.values())[1:]])  # one record over many splits
        write(f"{tmp_dir}/in/{name}.csv", rows, end)
        total += os.path.getsize(f"{tmp_dir}/in/{name}.csv")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(k) for k in keys]
    try:
        spark.conf.set(keys[0], str(total // splits + 1))
        spark.conf.set(keys[1], "1")
        got = files.read_numbered_csv(spark, f"{tmp_dir}/in")
        found = sorted((x["line"], *[x[c] for c in EXPECTED_COLUMNS]) for x in got.collect())
    finally:
        for k, v in zip(keys, before):
            spark.conf.set(k, v)
    want = []
    for name in "ab":
        with open(f"{tmp_dir}/in/{name}.csv", newline="", encoding="utf-8") as f:
            want += [(k, *[row[c] for c in EXPECTED_COLUMNS]) for k, row in enumerate(csv.DictReader(f), start=2)]
    assert found == sorted(want)


def test_the_file_with_another_header_is_named(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.csv", [list(RAW_ROW.values())])
    assert files.read_numbered_csv(spark, f"{tmp_dir}/in").count() == 1
    with open(f"{tmp_dir}/in/b.csv", "w") as f:
        f.write(",".join([EXPECTED_COLUMNS[1], EXPECTED_COLUMNS[0], *EXPECTED_COLUMNS[2:]]) + "\n")
    with pytest.raises(ValueError, match="b.csv"):
        files.read_numbered_csv(spark, f"{tmp_dir}/in")


@contextlib.contextmanager
def splits_of(spark, size):
    keys = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rows_named(names):
    return [[n, *list(RAW_ROW.values())[1:]] for n in names]


def size(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)


def test_no_text_is_stored_or_shuffled(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    names = [secrets.token_hex(300) for _ in range(3000)]
    write(f"{tmp_dir}/in/a.csv", rows_named(names))
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = size(folder)
    with splits_of(spark, 200_000):
        got = files.read_numbered_csv(spark, f"{tmp_dir}/in")
        assert [r.Name for r in got.orderBy("line").select("Name").collect()] == names
    assert size(folder) - before < size(f"{tmp_dir}/in") / 10
    assert got.rdd.getNumPartitions() > 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_numbers_hold_under_another_split_size(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    names = [f"N{k}\n{k}" if k % 50 == 0 else f"N{k}" for k in range(2000)]
    write(f"{tmp_dir}/in/a.csv", rows_named(names))
    with splits_of(spark, 20_000):
        got = files.read_numbered_csv(spark, f"{tmp_dir}/in")
    for n in (7_000, 10_000_000):
        with splits_of(spark, n):
            assert {r.Name: r.line for r in got.select("Name", "line").collect()} == {v: k + 2 for k, v in enumerate(names)}


def test_a_header_beyond_the_first_split(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/b.csv", rows_named(["Ann", "Bo"]))
    good = open(f"{tmp_dir}/in/b.csv", newline="").read()
    with open(f"{tmp_dir}/in/a.csv", "w", newline="") as f:
        f.write("\r\n" * 500 + good)
    with splits_of(spark, 100):
        got = files.read_numbered_csv(spark, f"{tmp_dir}/in")
        assert sorted((r.Name, r.line) for r in got.collect()) == [("Ann", 2), ("Ann", 2), ("Bo", 3), ("Bo", 3)]
        for wrong in ("\r\n" * 500 + good.replace("Age", "Years"), '"' + good):  # late; open to the end of the file
            with open(f"{tmp_dir}/in/a.csv", "w", newline="") as f:
                f.write(wrong)
            with pytest.raises(ValueError, match="a.csv"):
                files.read_numbered_csv(spark, f"{tmp_dir}/in")


def test_a_file_that_changes_meanwhile_stops_the_read(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.csv", rows_named(["Ann", "Bo"]), end="\n")
    got = files.read_numbered_csv(spark, f"{tmp_dir}/in")
    text = open(f"{tmp_dir}/in/a.csv").read()
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write(text.replace("Ann,", "A\nn,"))
    with pytest.raises(Exception, match="changed while it was read"):
        got.collect()
