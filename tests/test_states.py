"""States of a load merged over loads, and the profile observed while rows are written."""

import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelens.functions.distributions import f_survival, t_quantile, t_two_sided_p
from carelens.operators import profile, states
from carelens.operators import statistics as st
from carelens.plans.load import run_load
from carelens.schema import CLAIMS_SCHEMA
from carelens.sources import snapshots

from .test_load import GOOD
from .test_validate import HEADER


def _brute(xs):
    n = len(xs)
    mean = math.fsum(xs) / n
    return n, mean, math.fsum((x - mean) ** 2 for x in xs)


def test_merged_moments_equal_one_pass_for_1000_random_splits(spark):
    rnd, rows, want = random.Random(5), [], {}
    for g in range(1000):
        at = rnd.choice([0.0, 1e6, -1e9])
        xs = [at + rnd.gauss(0, rnd.choice([1e-2, 1.0, 500.0])) for _ in range(rnd.randint(1, 40))]
        want[g] = _brute(xs)
        rows += [(g, rnd.randint(0, 4), x) for x in xs]
    df = spark.createDataFrame(rows, "k int, load int, x double")
    got = states.merge_moments(states.moment_states(df, ["k", "load"], "x"), ["k"]).collect()
    one = {r.k: r for r in states.moment_states(df, ["k"], "x").collect()}
    assert len(got) == 1000
    for r in got:
        n, mean, m2 = want[r.k]
        scale = abs(mean) * 1e-15 * math.sqrt(n)  # what rounding of the values themselves allows
        assert r.n == n == one[r.k].n
        assert r.mean == pytest.approx(mean, rel=1e-12) and one[r.k].mean == pytest.approx(mean, rel=1e-12)
        assert r.m2 == pytest.approx(m2, rel=1e-9, abs=10 * scale * math.sqrt(m2) + n * scale ** 2)


def test_moments_from_states_with_null_keys_and_empty_tables(spark):
    rows = [(None, "Asthma", 1, Decimal("2")), (None, "Cancer", 2, Decimal("4")), ("A", None, 1, Decimal("5")), ("A", "Asthma", 1, None)]
    df = spark.createDataFrame(rows, "InsuranceProvider string, MedicalCondition string, load int, BillingAmount decimal(18,4)")
    m = {r.InsuranceProvider: r for r in states.moments_from(states.moment_states(df, ["load", *states.MOMENT_KEYS])).collect()}
    assert (m[None].n, m[None].mean, m[None].var) == (2, 3.0, 2.0)
    assert (m["A"].n, m["A"].mean, m["A"].var) == (1, 5.0, None)
    only = states.moments_from(states.moment_states(df), where={"MedicalCondition": "Cancer"}).collect()
    assert [(r.InsuranceProvider, r.n) for r in only] == [(None, 1)]
    assert states.moments_from(states.moment_states(df.limit(0))).count() == 0


def _claims(spark, rows):
    full = [tuple(r.get(c) for c in CLAIMS_SCHEMA.names) for r in rows]
    return spark.createDataFrame(full, CLAIMS_SCHEMA)


def test_sketches_of_loads_merge_to_that_of_all_rows(spark):
    df = (spark.range(60_000).select(
        F.concat(F.lit("p"), (F.col("id") % 41_000).cast("string")).alias("Name"), (F.col("id") % 90).cast("int").alias("Age"),
        F.when(F.col("id") % 3 > 0, "Male").alias("Gender"),
        (F.col("id") % 30_000).cast("decimal(18,4)").alias("BillingAmount"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 700).cast("int")).alias("DateOfAdmission"), (F.col("id") % 7).alias("load")))
    for c in CLAIMS_SCHEMA.names:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(CLAIMS_SCHEMA[c].dataType))
    parts = [df.where(F.col("load") == k) for k in range(7)]
    sketches, values = states.sketch_states(parts[0]), states.value_states(parts[0])
    for p in parts[1:]:
        sketches, values = sketches.unionByName(states.sketch_states(p)), values.unionByName(states.value_states(p))
    merged = states.cardinality_from(sketches, values).collect()
    assert merged == states.cardinality_from(states.sketch_states(df), states.value_states(df)).collect()
    got = {r.column: r for r in merged}
    exact = {r.column: r.distinct_values for r in profile.profile_cardinality(df).collect()}
    for c, r in got.items():
        assert r.exact == (c in states.FEW)
        assert r.distinct_values == exact[c] if r.exact else abs(r.distinct_values - exact[c]) <= 4 * states.STANDARD_ERROR * exact[c]
    assert got["Gender"].distinct_values == 1 and got["Hospital"].distinct_values == 0
    none = states.cardinality_from(states.sketch_states(df.limit(0)), states.value_states(df.limit(0))).collect()
    assert len(none) == 15 and {r.distinct_values for r in none} == {0}


def test_profile_is_observed_while_rows_are_written(spark, tmp_dir):
    rows = [{"Name": "A", "Age": 3, "BillingAmount": Decimal("1.5"), "Gender": " ", "DateOfAdmission": dt.date(2023, 1, 1),
             "DischargeDate": dt.date(2023, 1, 1)}, {"Name": None, "Age": 200, "BillingAmount": Decimal("-2")}]
    seen = states.ObservedProfile(_claims(spark, rows))
    seen.rows.write.parquet(f"{tmp_dir}/staging")
    got = {(r.section, r.item, r.metric): r.day or r.number for r in seen.report().collect()}
    assert got["overview", "all", "total_records"] == 2 and got["overview", "all", "latest"] == dt.date(2023, 1, 1)
    assert got["completeness", "Gender", "nulls"] == 1 and got["completeness", "Gender", "empties"] == 1
    assert got["stay", "all", "same_day"] == 1 and got["quality", "Age in range 0-150", "violations"] == 1
    assert states.quality_score_from(seen.report()).first()[:] == (1, 5, 20)
    empty = states.ObservedProfile(_claims(spark, []))
    empty.rows.write.parquet(f"{tmp_dir}/none")
    got = {(r.section, r.metric): r.number for r in empty.report().where("section <> 'completeness'").collect()}
    assert got["overview", "total_records"] == 0 and got["billing", "mean"] is None


def test_reports_over_two_loads_from_their_states(spark, tmp_dir):
    p, root = f"{tmp_dir}/in.csv", f"{tmp_dir}/out"
    for first, last in ((0, 4), (2, 9)):
        with open(p, "w") as f:
            f.write(HEADER + "".join(GOOD.format(i=i, b=100 + i) for i in range(first, last)))
        run_load(spark, p, root)
    bills = [100.0 + i for i in [*range(4), *range(2, 9)]]
    n, mean, m2 = _brute(bills)
    m = states.moments_from(snapshots.stored(spark, root, "moments")).first()
    assert m.n == n and m["mean"] == pytest.approx(mean) and m["var"] == pytest.approx(m2 / (n - 1))
    card = {r.column: r for r in states.cardinality_from(
        snapshots.stored(spark, root, "sketches"), snapshots.stored(spark, root, "value_counts")).collect()}
    assert card["Name"].distinct_values == 9 and card["InsuranceProvider"].distinct_values == 1 and card["Age"].exact
    counts = states.categories_from(snapshots.stored(spark, root, "value_counts")).where("column = 'Gender'").first()
    assert (counts.value, counts.n) == ("Female", 11)
    report = snapshots.current(spark, root).read(spark, "profile")
    assert report.where("metric = 'total_records'").first().number == 7
    assert st.moments_report(states.moments_from(snapshots.stored(spark, root, "moments"))).first().n == 11


@pytest.mark.parametrize("df", [1e8, 1e10, 1e12, 1e14, math.inf])
def test_many_degrees_of_freedom_approach_the_limits(df):
    for t in (1e-3, 0.5, 1.0, 1.96, 3.0):
        assert abs(t_two_sided_p(t, df) - math.erfc(t / math.sqrt(2))) < max(1e-9, 3 / df)
        for x in (0.2, 1.0, 4.0, 20.0):  # four degrees of freedom: (1 + x/2) e^(-x/2)
            assert abs(f_survival(x / 4, 4, df) - (1 + x / 2) * math.exp(-x / 2)) < 1e-9 + 3 / df
    assert t_quantile(0.975, df) == pytest.approx(1.959963984540054, rel=max(1e-12, 3 / df))


def test_tails_keep_their_digits():
    assert t_two_sided_p(10.0, math.inf) == pytest.approx(math.erfc(10 / math.sqrt(2)), rel=1e-12)
    for d in (1e8, 1e12, 1e14):  # equal degrees on both sides: the median is 1, log F nearly normal
        assert f_survival(1.0, d, d) == pytest.approx(0.5, abs=1e-13)
        z = 2 / math.sqrt(d)
        assert f_survival(math.exp(z), d, d) == pytest.approx(math.erfc(z / math.sqrt(4 / d) / math.sqrt(2)) / 2, abs=1e-8)
    # one degree: Cauchy, P(|T| > t) = 2 atan(1/t) / pi; two: 1 - t / sqrt(2 + t^2)
    for t in (1e-8, 0.1, 1.0, 7.0, 1e6):
        assert t_two_sided_p(t, 1) == pytest.approx(2 * math.atan(1 / t) / math.pi, rel=1e-12)
        assert t_two_sided_p(t, 2) == pytest.approx(2 / (2 + t * t) / (1 + t / math.sqrt(2 + t * t)), rel=1e-12)
    for q in (1e-10, 0.01, 0.3, 0.4999, 0.6, 0.999):
        for d in (0.7, 1, 3, 59_994, 1e13):
            back = t_two_sided_p(t_quantile(q, d), d)
            assert back == pytest.approx(2 * min(q, 1 - q), rel=1e-11)
    assert math.isnan(f_survival(2.0, 0, 5)) and math.isnan(t_two_sided_p(1.0, -1)) and math.isnan(t_quantile(1.0, 3))
