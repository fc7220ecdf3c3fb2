"""The fact's joins: what they shuffle, how often the claims are made, and its rows against plain Python."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from carelens.operators import model
from carelens.plans import registry
from carelens.schema import CLAIMS_SCHEMA, TYPED_COLUMNS
from carelens.sources.adapter import claims
from carelens.sources.snapshots import begin

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


def _rows(n, seed=3):
    from decimal import Decimal
    r = random.Random(seed)
    some = lambda *v: r.choice([*v, None])
    day = lambda: dt.date(2021, 1, 1) + dt.timedelta(r.randint(0, 40))
    rows = [(some(*"abcdefgh"), some(30, 31, 32), some("Male", "Female"), some("A+", "O-"), some("Asthma", "Cancer"), day(),
             some("d1", "d2", "d3"), some("h1", "h2"), some("Cigna", "Aetna"), Decimal(r.randint(1, 3)), some(101, 102), some("Urgent", "Elective"),
             day(), some("Aspirin", "Lipitor"), some("Normal", "Abnormal")) for _ in range(n)]
    return rows + rows[: n // 3] + rows[:1] * (n // 3)  # copies, and one claim many times


def _plain(rows):
    """The fact without its number, as SQL joins it: NULL keys meet nothing."""
    at = {c: i for i, c in enumerate(TYPED_COLUMNS)}
    first = lambda v: (v is not None, v)  # noqa: E731  (NULLs sort first)
    pick = lambda row, cols: tuple(row[at[c]] for c in cols)

    def numbered(cols):
        members = {k for k in (pick(row, cols) for row in rows) if k[0] is not None}
        return {k: i for i, k in enumerate(sorted(members, key=lambda k: [first(v) for v in k]), 1)}

    keyed = [model.PATIENT_KEYS, *[[src] for _k, src in model.NAME_DIMENSIONS.values()]]
    dims = [numbered(cols) for cols in keyed]
    fact = [(*[d[pick(row, cols)] for d, cols in zip(dims, keyed)], *pick(row, model.FACT_ATTRS)) for row in rows
            if all(v is not None for cols in keyed for v in pick(row, cols))]
    return sorted(fact, key=lambda x: [first(v) for v in x])


def test_fact_equals_plain_python_and_claims_are_made_once(spark, monkeypatch):
    rows = _rows(1500)
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(name):
        made.add(1)
        return name

    staged = spark.createDataFrame(rows, CLAIMS_SCHEMA).withColumn("Name", seen("Name"))
    monkeypatch.setattr(registry, "_claims", lambda s, d: staged)
    fact, _dims = registry._fact(spark, "")
    got = sorted(tuple(x) for x in fact.collect())
    assert [x[0] for x in got] == list(range(1, len(got) + 1))
    assert [x[1:] for x in got] == _plain(rows)
    assert made.value == len(rows)  # not once for the dimensions and again for the fact


def _shuffled(df):
    """Column lists of the shuffles in the plan before it runs."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)


def test_fact_shuffles_keys_not_names(spark, tmp_dir):
    load = begin(spark, tmp_dir)
    staged = load.write("staging", spark.createDataFrame(_rows(300), CLAIMS_SCHEMA))
    dims = {name: load.write(name, rows) for name, rows in model.dimensions(staged).items()}
    # patients that no broadcast may carry
    dims["Patient"] = dims["Patient"].unionByName(spark.range(10 ** 9).select(
        F.col("id").alias("PatientID"), F.lit("x").alias("Name"), F.lit(1).alias("Age"), F.lit("Male").alias("Gender"), F.lit("A+").alias("BloodType")))
    wide = [x for x in _shuffled(model.build_fact(staged, dims, with_id=False)) if "BillingAmount" in x]
    assert len(wide) == 1 and all(key in wide[0] for key, _src in model.NAME_DIMENSIONS.values())
    assert not re.search(r"\b(Doctor|Hospital|InsuranceProvider|Medication)#", wide[0])


def test_patients_are_never_broadcast(spark, tmp_dir):
    load = begin(spark, tmp_dir)
    staged = load.write("staging", spark.createDataFrame(_rows(300), CLAIMS_SCHEMA))
    dims = {name: load.write(name, rows) for name, rows in model.dimensions(staged).items()}
    plan = model.build_fact(staged, dims, with_id=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 4


def test_claims_meet_suppliers_without_a_shuffle(spark, tmp_dir):
    """Joined to nations first, suppliers were estimated at the product of both tables' sizes."""
    day = dt.datetime(2021, 1, 2)
    tables = {
        "lineitem": ([(i, i % 40, i % 50, 1, 2.0, 100.5, "N", day) for i in range(400)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(i, i % 30, day, "2-HIGH") for i in range(400)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "customer": ([(i, f"c{i}", "AUTO") for i in range(30)], "c_custkey long, c_name string, c_mktsegment string"),
        "part": ([(i, "LARGE", 1) for i in range(40)], "p_partkey long, p_type string, p_size int"),
        "supplier": ([(i, f"s{i}", i % 25) for i in range(49)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(i, f"n{i}") for i in range(25)], "n_nationkey int, n_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_dir}/{name}.parquet")
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "50k")
    try:
        c = claims(spark, tmp_dir)
        assert "hashpartitioning(l_suppkey" not in c._jdf.queryExecution().executedPlan().toString()
        assert c.count() == 392  # supplier 49 is missing
    finally:
        spark.conf.set(THRESHOLD, before)
