"""Validator cases (one row at a time), header contract, permissive load, age bands."""

import datetime
from decimal import Decimal

import pytest

from carelens.operators import validate as val


def errors_of(raw_rows, **override):
    row = val.validate(raw_rows(override)).collect()[0]
    return row, list(row["errors"])


def test_valid_row_has_no_errors(raw_rows):
    row, errs = errors_of(raw_rows)
    assert errs == []
    assert row["Name"] == "Ines Falk" and row["Age"] == 62
    assert row["BillingAmount"] == Decimal("1840.2500")
    assert row["DateOfAdmission"] == datetime.date(2021, 6, 3)
    assert row["DischargeDate"] == datetime.date(2021, 6, 9)


@pytest.mark.parametrize("age", ["0", "45", "150"])
def test_age_in_range(raw_rows, age):
    assert errors_of(raw_rows, Age=age)[1] == []


@pytest.mark.parametrize("age", ["-1", "151"])
def test_age_out_of_range(raw_rows, age):
    errs = errors_of(raw_rows, Age=age)[1]
    assert errs == [f"Line 2: Age {age} out of range 0-150"]


def test_age_not_a_number(raw_rows):
    assert errors_of(raw_rows, Age="old")[1] == ["Line 2: Invalid age 'old'"]


@pytest.mark.parametrize("field,good,bad,label", [
    ("Gender", ["Male", "Female"], "F", "gender"),
    ("Blood Type", ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"], "0+", "blood type"),
    ("Medical Condition", ["Diabetes", "Asthma", "Obesity", "Arthritis", "Hypertension", "Cancer"],
     "Gout", "medical condition"),
    ("Admission Type", ["Elective", "Emergency", "Urgent"], "Walk-in", "admission type"),
    ("Test Results", ["Normal", "Abnormal", "Inconclusive"], "Unknown", "test results"),
])
def test_domains(raw_rows, field, good, bad, label):
    for g in good:
        assert errors_of(raw_rows, **{field: g})[1] == []
    assert errors_of(raw_rows, **{field: bad})[1] == [f"Line 2: Invalid {label} '{bad}'"]


def test_billing(raw_rows):
    assert errors_of(raw_rows, **{"Billing Amount": "0"})[1] == []
    row, errs = errors_of(raw_rows, **{"Billing Amount": "512.00007312"})
    assert errs == [] and row["BillingAmount"] == Decimal("512.0001")
    assert errors_of(raw_rows, **{"Billing Amount": "-7"})[1] == ["Line 2: Negative billing amount -7.0"]
    assert errors_of(raw_rows, **{"Billing Amount": "n/a"})[1] == ["Line 2: Invalid billing amount 'n/a'"]


def test_dates(raw_rows):
    same_day = {"Date of Admission": "2021-06-03", "Discharge Date": "2021-06-03"}
    assert errors_of(raw_rows, **same_day)[1] == []
    before = {"Date of Admission": "2021-06-03", "Discharge Date": "2021-06-02"}
    assert errors_of(raw_rows, **before)[1] == ["Line 2: Discharge date before admission date"]
    bad = {"Date of Admission": "3 June 2021"}
    assert errors_of(raw_rows, **bad)[1] == ["Line 2: Invalid admission date '3 June 2021'"]
    assert errors_of(raw_rows, **{"Discharge Date": "2021-06-31"})[1] == \
        ["Line 2: Invalid discharge date '2021-06-31'"]
    # strptime accepts one-digit month and day, and no surrounding blanks
    assert errors_of(raw_rows, **{"Date of Admission": "2021-6-3"})[1] == []
    assert errors_of(raw_rows, **{"Date of Admission": " 2021-06-03"})[1] == \
        ["Line 2: Invalid admission date ' 2021-06-03'"]


def test_room_number(raw_rows):
    assert errors_of(raw_rows, **{"Room Number": "x1"})[1] == ["Line 2: Invalid room number 'x1'"]


def test_whitespace_is_stripped(raw_rows):
    row, errs = errors_of(raw_rows, Name="  Ines Falk  ", Gender=" Female ", **{"Blood Type": " O+ "})
    assert errs == []
    assert (row["Name"], row["Gender"], row["BloodType"]) == ("Ines Falk", "Female", "O+")
    row, errs = errors_of(raw_rows, Name="\tInes Falk\n", Gender=" Male　")
    assert errs == [] and row["Name"] == "Ines Falk" and row["Gender"] == "Male"


def test_several_errors_in_one_row(raw_rows):
    errs = errors_of(raw_rows, Age="-5", Gender="X", **{"Blood Type": "Z", "Billing Amount": "abc"})[1]
    assert len(errs) == 4
    assert errs[0] == "Line 2: Age -5 out of range 0-150"


def test_split_and_summary(raw_rows):
    v = val.validate(raw_rows({}, {"Age": "abc"}, {"Gender": "X", "Age": "200"}))
    ok, bad = val.split(v)
    assert ok.count() == 1 and bad.count() == 2
    s = val.reject_summary(v).collect()[0]
    assert (s.rows_read, s.valid, s.rejected, s.error_count) == (3, 1, 2, 3)
    first = [r.message for r in val.first_errors(v).collect()]
    assert first == ["Line 3: Invalid age 'abc'", "Line 4: Age 200 out of range 0-150",
                     "Line 4: Invalid gender 'X'"]


def test_types_only_load(raw_rows):
    v = val.validate(raw_rows({}, {"Age": "NOT_A_NUMBER", "Gender": "Other"}), level="types")
    rows = {r.claim_id: list(r.errors) for r in v.collect()}
    assert rows["2"] == []
    assert rows["3"] == ["Line 3: invalid literal for int() with base 10: 'NOT_A_NUMBER'"]


def test_constraint_audit(raw_rows):
    v = val.validate(raw_rows({}, {"Gender": "Other", "Age": "151"}), level="types")
    ok, _ = val.split(v)
    audit = {r.rule: r.violations for r in val.constraint_audit(ok).collect()}
    assert audit["patient_gender_domain"] == 1 and audit["patient_age_range"] == 1
    assert audit["billing_non_negative"] == 0


AGE_CASES = [(0, "0-1"), (1, "0-1"), (2, "2-5"), (5, "2-5"), (6, "6-12"), (12, "6-12"), (13, "13-18"),
             (18, "13-18"), (19, "19-30"), (30, "19-30"), (31, "31-45"), (45, "31-45"), (46, "46-60"),
             (60, "46-60"), (61, "61-80"), (80, "61-80"), (81, "81+"), (100, "81+"), (150, "81+"),
             (None, "Unknown"), (-1, "Unknown")]


def test_age_bands(spark):
    from pyspark.sql import functions as F
    from carelens.functions.columns import age_group, age_group_of_profile
    df = spark.createDataFrame([(a,) for a, _ in AGE_CASES], "Age int")
    got = [r.g for r in df.select(age_group("Age").alias("g")).collect()]
    assert got == [g for _, g in AGE_CASES]
    prof = [r.g for r in df.where(F.col("Age") >= 0).select(age_group_of_profile("Age").alias("g")).collect()]
    assert prof == [g for a, g in AGE_CASES if a is not None and a >= 0]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


HEADER = ("Name,Age,Gender,Blood Type,Medical Condition,Date of Admission,Doctor,Hospital,"
          "Insurance Provider,Billing Amount,Room Number,Admission Type,Discharge Date,Medication,Test Results\n")


def test_csv_header_contract(spark, tmp_dir):
    from carelens.sources import files
    good = f"{tmp_dir}/good.csv"
    _write(good, HEADER + '"Doe, Jane",45,Female,O+,Diabetes,2023-01-15,Dr. X,H,Medicare,100.5,101,'
                          'Elective,2023-01-20,Aspirin,Normal\n')
    files.check_header(spark, good)
    bad = f"{tmp_dir}/bad.csv"
    _write(bad, HEADER.replace("Blood Type", "BloodType"))
    with pytest.raises(ValueError):
        files.check_header(spark, bad)
    spaced = f"{tmp_dir}/spaced.csv"
    _write(spaced, HEADER.replace("Age,", " Age ,"))
    files.check_header(spark, spaced)


def test_csv_read_validate_with_line_numbers(spark, tmp_dir):
    from carelens.sources import files
    p = f"{tmp_dir}/claims.csv"
    body = ('"Doe, Jane",45,Female,O+,Diabetes,2023-01-15,Dr. X,H,Medicare,100.5,101,Elective,2023-01-20,'
            'Aspirin,Normal\n'
            '  Bob  ,abc,Male,A+,Asthma,2023-02-01,Dr. Y,H,Aetna,20,102,Urgent,2023-02-03,Lipitor,Abnormal\n'
            'Short,40,Male\n')
    _write(p, HEADER + body)
    raw = files.with_line_numbers(files.read_raw_csv(spark, p))
    rows = {r.line: r for r in val.validate(raw, record_col="line").collect()}
    assert sorted(rows) == [2, 3, 4]
    assert list(rows[2].errors) == [] and rows[2].Name == "Doe, Jane"
    assert list(rows[3].errors) == ["Line 3: Invalid age 'abc'"] and rows[3].Name == "Bob"
    assert len(rows[4].errors) >= 5  # missing fields are errors, not a crash


def test_line_numbers_follow_file_order_across_splits(spark, tmp_dir):
    from carelens.sources import files
    p = f"{tmp_dir}/many.csv"
    row = "N{i},{a},Male,A+,Asthma,2023-02-01,Dr. Y,H,Aetna,20,102,Urgent,2023-02-03,Lipitor,Abnormal\n"
    with open(p, "w") as f:
        f.write(HEADER + "".join(row.format(i=i, a=i % 100) for i in range(20000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        raw = files.read_raw_csv(spark, p)
        assert raw.rdd.getNumPartitions() > 10
        got = {r.Name: r.line for r in files.with_line_numbers(raw).select("Name", "line").collect()}
        numbered = files.with_line_numbers(files.read_raw_csv(spark, p))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"N{i}": i + 2 for i in range(20000)}
    # built under one split size, run under another
    assert {r.Name: r.line for r in numbered.select("Name", "line").collect()} == got


def test_strip_matches_python_strip(spark):
    from carelens.functions.columns import strip_ws
    vals = [" Jane ", "Émile", "  Bob\t", "x", "", "　Zoë ", " \x01a ", " b ", "\n"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    assert [r[0] for r in df.select(strip_ws("v")).collect()] == [v.strip() for v in vals]


def _messages_in_plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Negative billing amount")


def test_messages_are_compiled_and_in_methods_the_jvm_compiles(spark, raw_rows):
    import re
    df = val.validate(raw_rows({}, {"Age": "151", "Gender": "x"}))
    # a lambda over the messages would have all of them interpreted
    assert "filter(array(" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    code = spark.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    assert all(int(n) <= 8000 for n in re.findall(r"maxMethodCodeSize:(\d+)", code))
    assert [r.errors for r in df.orderBy("claim_id").collect()] == [
        [], ["Line 3: Age 151 out of range 0-150", "Line 3: Invalid gender 'x'"]]
    odd = val.validate(raw_rows({"Room Number": "x", "Billing Amount": "y"}, {"Age": None}, {}), level="types")
    assert [r.errors for r in odd.orderBy("claim_id").collect()] == [
        ["Line 2: could not convert string to float: 'y'"],
        ["Line 3: invalid literal for int() with base 10: 'None'"], []]


def test_messages_of_rejects_are_made_once(raw_rows):
    bad = val.split(val.validate(raw_rows({}, {"Age": "-1", "Billing Amount": "-5"})))[1]
    assert _messages_in_plan(bad) == 1
    assert [(r.claim_id, len(r.errors)) for r in bad.collect()] == [("3", 2)]


def test_messages_of_the_first_errors_are_made_once(raw_rows):
    first = val.first_errors(val.validate(raw_rows({}, {"Age": "-1", "Billing Amount": "-5"}, {"Gender": "x"})), 2)
    assert _messages_in_plan(first) == 1
    assert [(r.claim_id, r.pos, r.message) for r in first.collect()] == [
        ("3", 0, "Line 3: Age -1 out of range 0-150"), ("3", 1, "Line 3: Negative billing amount -5.0")]
