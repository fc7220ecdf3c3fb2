"""Order statistics by sketch bands against sorting, with sketches so coarse that bands must widen."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from carelens.plans import quantiles as q

RANKS = [("p0", 0.0), ("p25", 0.25), ("p50", 0.5), ("p99", 0.99), ("p100", 1.0)]


def groups(seed):
    r = random.Random(seed)
    out = [("hot", Decimal(r.randint(-10**9, 10**9)) / 10**4) for _ in range(6000)]
    out += [("ties", Decimal(r.choice([1, 1, 1, 2, 3]))) for _ in range(3000)]
    out += [("nulls", None if r.random() < .4 else Decimal(r.randint(0, 50))) for _ in range(500)]
    out += [("one", Decimal(7)), ("no value", None), ("no value", None), (None, Decimal(1)), (None, Decimal(2))]
    out += [("near", Decimal(10**13) + Decimal(i) / 10**4) for i in range(200)]  # alike as doubles in part
    return out


@pytest.mark.parametrize("options", [{}, {"sketch": 8, "eps": 0.001}])
def test_ranks_equal_sorting(spark, options):
    rows = groups(3)
    df = spark.createDataFrame(rows, "g string, x decimal(18,4)").repartition(5)
    ranks = lambda n: [(name, F.greatest(F.lit(1), F.floor(n * p)).cast("long")) for name, p in RANKS] + [("beyond", n + 1)]
    got = {(r.g, r.target): r.value for r in q.rank_lookup(df, ["g"], "x", ranks, **options).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        xs = sorted((x for h, x in rows if h == g), key=lambda x: (x is not None, x or 0))
        want |= {(g, name): xs[max(1, int(len(xs) * p)) - 1] for name, p in RANKS}
    assert got == want


def test_doubles_with_nan_and_infinity(spark):
    xs = [float("nan"), float("inf"), float("-inf"), 1.0, 2.0, None, 3.0, float("nan")]
    df = spark.createDataFrame([("a", x) for x in xs], "g string, x double")
    got = {r.target: r.value for r in q.rank_lookup(df, ["g"], "x", lambda n: [(str(k), F.lit(k)) for k in range(1, 9)]).collect()}
    assert [repr(got[str(k)]) for k in range(1, 9)] == ["None", "-inf", "1.0", "2.0", "3.0", "inf", "nan", "nan"]


def test_an_empty_table_has_no_ranks(spark):
    df = spark.createDataFrame([], "g string, x double")
    assert q.rank_lookup(df, ["g"], "x", lambda n: [("a", n)]).count() == 0
    assert q.boxes(spark.createDataFrame([], "g string, x decimal(18,4)"), "g", "x", [("q1", "0.25"), ("median", "0.50"), ("q3", "0.75")]).count() == 0


def test_boxes_equal_numpy(spark):
    r = random.Random(5)
    rows = [(g, Decimal(int(x * 10**4)) / 10**4) for g in "abc" for x in ([r.gauss(0, 1) * 10 ** (ord(g) - 97) for _ in range(4000)] + [50.0, -80.0, 1e6])]
    rows += [("flat", Decimal(3))] * 40 + [("flat", Decimal(4)), ("two", Decimal(1)), ("two", Decimal(9))]
    df = spark.createDataFrame(rows, "g string, x decimal(18,4)").repartition(4)
    got = {x.g: x for x in q.boxes(df, "g", "x", [("q1", "0.25"), ("median", "0.50"), ("q3", "0.75")]).collect()}
    for g in got:
        xs = np.array([float(x) for h, x in rows if h == g])
        q1, mid, q3 = np.quantile(xs, [.25, .5, .75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert [float(got[g][c]) for c in ("q1", "median", "q3")] == pytest.approx([q1, mid, q3])
        assert float(got[g].whislo) == pytest.approx(min(xs[xs >= lo].min(), q1)) and float(got[g].whishi) == pytest.approx(max(xs[xs <= hi].max(), q3))
        assert got[g].fliers == ((xs < lo) | (xs > hi)).sum() and got[g].n == len(xs)


def test_only_band_values_are_kept(spark):
    df = spark.range(200_000).select(F.lit("a").alias("g"), F.xxhash64("id").alias("x"))
    made = q.Banded(df, ["g"], "x", lambda n: [("m", F.floor(n / 2))])
    assert made.cells.count() < 200_000 * 0.03


def test_rows_meet_their_group_without_a_shuffle_by_group(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    plans, checkpoint = [], DataFrame.checkpoint

    def recorded(df, eager=True):
        if "least" in df.columns:  # counts of the rows by band
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpoint(df, eager)

    monkeypatch.setattr(DataFrame, "checkpoint", recorded)
    df = spark.createDataFrame([("a" if i % 3 else "b", Decimal(i)) for i in range(300)], "g string, x decimal(18,4)")
    got = {r.g: r.p for r in q.quantiles(df, ["g"], "x", [("p", "0.5")]).collect()}
    assert got == {"a": Decimal("150"), "b": Decimal("148.5")}
    assert plans and all("BroadcastHashJoin" in p and "SortMergeJoin" not in p for p in plans)
