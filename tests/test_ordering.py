"""Distributed ranks / order statistics against brute force, including a hot group."""

import random
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from carelens.operators.advanced import order_stat_percentiles
from carelens.operators.profile import kth_values
from carelens.plans.quantiles import quantiles
from carelens.plans.ordering import (
    dense_sequence, dense_sequence_grouped, number_rows, rank_lookup,
)


def _data(spark, rows):
    return spark.createDataFrame(rows, "g string, x decimal(18,4)")


def test_rank_lookup_matches_sort_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", Decimal(rnd.randint(0, 500)) / 4) for _ in range(3000)]
    rows += [(f"g{i % 5}", Decimal(rnd.randint(0, 50))) for i in range(300)]
    rows += [("hot", None)] * 7
    df = _data(spark, rows)
    ks = [1, 2, 7, 8, 50, 299, 1500, 3007]
    got = rank_lookup(df, ["g"], "x", lambda n: [(f"k{k}", F.lit(k)) for k in ks], num_partitions=16)
    got = {(r.g, r.k): r.value for r in got.collect()}
    for g in {r[0] for r in rows}:
        vals = sorted((r[1] for r in rows if r[0] == g), key=lambda v: (v is not None, v or 0))
        for k in ks:
            if k <= len(vals):
                assert got[(g, k)] == vals[k - 1], (g, k)
            else:
                assert (g, k) not in got


def test_mysql_percentile_rule_small_groups(spark):
    rows = []
    for size in (1, 3, 4, 5):
        rows += [(f"s{size}", Decimal(i)) for i in range(1, size + 1)]
    v = spark.createDataFrame(rows, "MedicalCondition string, BillingAmount decimal(18,4)")
    got = {r.MedicalCondition: r for r in order_stat_percentiles(v).collect()}
    # row GREATEST(1, FLOOR(n * p)) of the ascending order
    assert (got["s1"].p25, got["s1"].median, got["s1"].p99) == (1.0, 1.0, 1.0)
    assert (got["s3"].p25, got["s3"].median, got["s3"].p75, got["s3"].p90) == (1.0, 1.0, 2.0, 2.0)
    assert (got["s4"].p25, got["s4"].median, got["s4"].p75) == (1.0, 2.0, 3.0)
    assert (got["s5"].p25, got["s5"].median, got["s5"].p75, got["s5"].p90, got["s5"].p99) == \
        (1.0, 2.0, 3.0, 4.0, 4.0)
    assert got["s5"].iqr == 2.0


def test_offset_rule_whole_table(spark):
    df = spark.createDataFrame([(Decimal(i),) for i in range(1, 6)], "BillingAmount decimal(18,4)")
    got = {r.percentile: r.value for r in kth_values(df, "BillingAmount").collect()}
    # LIMIT 1 OFFSET k with k = n//4, n//2, 3n//4, int(.9n), int(.99n) → one row later than the rule above
    assert got == {"p25": 2.0, "p50": 3.0, "p75": 4.0, "p90": 5.0, "p99": 5.0}
    empty = spark.createDataFrame([], "BillingAmount decimal(18,4)")
    assert kth_values(empty, "BillingAmount").count() == 0


def test_interpolated_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    rows = [(g, Decimal(rnd.randint(0, 10000)) / 100) for g in "abc" for _ in range(rnd.randint(1, 60))]
    df = _data(spark, rows)
    ps = [("q1", "0.25"), ("median", "0.5"), ("q3", "0.75")]
    got = {r.g: r for r in quantiles(df, ["g"], "x", ps).collect()}
    for g in "abc":
        vals = np.array([float(r[1]) for r in rows if r[0] == g])
        for name, p in ps:
            assert abs(float(got[g][name]) - np.percentile(vals, float(p) * 100)) < 1e-9


def test_number_rows_and_dense_sequence(spark):
    rnd = random.Random(5)
    vals = [rnd.randint(0, 200) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    n = number_rows(df, ["v"], "rn", num_partitions=8).collect()
    assert sorted(r.rn for r in n) == list(range(1, 1001))
    assert all(a.v <= b.v for a, b in zip(sorted(n, key=lambda r: r.rn), sorted(n, key=lambda r: r.rn)[1:]))
    keys = {r.v: r.k for r in dense_sequence(df, ["v"], "k", num_partitions=8).collect()}
    assert keys == {v: i + 1 for i, v in enumerate(sorted(set(vals)))}


def test_dense_sequence_grouped(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "x"), ("b", "z"), ("b", "a"), ("a", "b")]
    df = spark.createDataFrame(rows, "dim string, Name string")
    got = {(r.dim, r.Name): r.k for r in dense_sequence_grouped(df, "dim", ["Name"], "k", 4).collect()}
    assert got == {("a", "b"): 1, ("a", "x"): 2, ("a", "y"): 3, ("b", "a"): 1, ("b", "z"): 2}


def test_number_rows_with_many_identical_copies(spark):
    rows = [(1,)] * 3000 + [(v,) for v in range(2, 1002)]
    df = spark.createDataFrame(rows, "v int")
    got = number_rows(df, ["v"], "rn", num_partitions=8).collect()
    assert sorted(r.rn for r in got) == list(range(1, 4001))
    assert all(r.v == 1 for r in got if r.rn <= 3000)
    assert all(r.v == r.rn - 2999 for r in got if r.rn > 3000)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.integers(min_value=-50, max_value=50))),
                min_size=1, max_size=120),
       st.lists(st.integers(min_value=1, max_value=130), min_size=1, max_size=5))
def test_rank_lookup_property(spark, rows, ks):
    df = spark.createDataFrame([(g, None if v is None else Decimal(v)) for g, v in rows],
                               "g string, x decimal(18,4)")
    got = rank_lookup(df, ["g"], "x", lambda n: [(f"k{i}", F.lit(k)) for i, k in enumerate(ks)],
                      num_partitions=3)
    got = {(r.g, r.target): r.value for r in got.collect()}
    want = {}
    for g in {r[0] for r in rows}:
        vals = sorted((r[1] for r in rows if r[0] == g), key=lambda v: (v is not None, v or 0))
        for i, k in enumerate(ks):
            if k <= len(vals):
                want[(g, f"k{i}")] = None if vals[k - 1] is None else Decimal(vals[k - 1])
    assert got == want
