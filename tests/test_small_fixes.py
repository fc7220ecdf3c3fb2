"""Message texts as Python prints numbers, the pivot's further columns, the lookup's order."""

import random

from pyspark.sql import functions as F

from carelens.functions.columns import python_float
from carelens.operators import eda, validate


def test_floats_print_as_in_python(spark):
    r = random.Random(1)
    given = ["-12345678.9", "-0.00001", "-100", "-0.0001", "-0.00012", "1e16", "1.5e300", "-9999999", "-10000000", "123456789012345", "0", "-1e-7", "-0.5", "inf", "-inf"]
    given += [f"-{r.randint(0, 10 ** r.randint(1, 14))}.{r.randint(0, 9999):04d}" for _ in range(200)]
    rows = spark.createDataFrame([(g,) for g in given], "g string").select("g", python_float(F.col("g").cast("double")).alias("x")).collect()
    assert {x.g: x.x for x in rows} == {g: repr(float(g)) for g in given}


def test_negative_billing_message(raw_rows):
    checked = validate.validate(raw_rows({"Billing Amount": "-12345678.9"}, {"Billing Amount": "-0.00001"}))
    assert [x.errors for x in checked.orderBy("claim_id").collect()] == [
        ["Line 2: Negative billing amount -12345678.9"], ["Line 3: Negative billing amount -1e-05"]]


def test_pivot_has_a_column_for_every_condition(spark):
    v = spark.createDataFrame([("A", "Gout", 10.0), ("A", "Gout", 20.0), ("B", "Asthma", 5.0), ("B", None, 7.0)], "InsuranceProvider string, MedicalCondition string, BillingAmount double")
    got = eda.provider_condition_matrix(v.withColumn("BillingAmount", F.col("BillingAmount").cast("decimal(18,4)")))
    assert got.columns[-1] == "Gout" and [x["Gout"] for x in got.collect()] == [15.0, None]
