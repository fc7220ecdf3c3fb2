"""Row validation of raw (all-string) claims, accept/reject split and summaries.

Validation is one projection: every rule is a column expression producing an
error message or NULL, and the non-NULL messages form the ``errors`` array.
Nothing leaves the executors; a rejected row keeps *all* of its messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import python_float, strip_ws
from ..schema import (
    ADMISSION_TYPES, AGE_MAX, AGE_MIN, BLOOD_TYPES, CONDITIONS, CSV_TO_TYPED, EXPECTED_COLUMNS,
    GENDERS, MONEY, TEST_RESULTS, TYPED_COLUMNS,
)

DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def _q(c: Column) -> Column:
    """Render a raw value inside quotes as the messages show it (missing → None)."""
    return F.concat(F.lit("'"), F.coalesce(c, F.lit("None")), F.lit("'"))


def parse_date(raw: Column) -> Column:
    """'%Y-%m-%d' as strptime reads it: one- or two-digit month/day, no blanks.

    The shape is checked first, so the (fast) string→date cast sees only
    'yyyy-[m]m-[d]d'; impossible dates such as 2023-02-30 become NULL.
    """
    return F.when(raw.rlike(DATE_SHAPE), raw.try_cast("date"))


def _typed(raw: DataFrame) -> dict[str, Column]:
    r = {c: F.col(f"`{c}`") for c in EXPECTED_COLUMNS}
    return {
        "Name": strip_ws(r["Name"]),
        "Age": r["Age"].try_cast("int"),
        "Gender": strip_ws(r["Gender"]),
        "BloodType": strip_ws(r["Blood Type"]),
        "MedicalCondition": strip_ws(r["Medical Condition"]),
        "DateOfAdmission": parse_date(r["Date of Admission"]),
        "Doctor": strip_ws(r["Doctor"]),
        "Hospital": strip_ws(r["Hospital"]),
        "InsuranceProvider": strip_ws(r["Insurance Provider"]),
        "BillingAmount": r["Billing Amount"].try_cast(MONEY),
        "RoomNumber": r["Room Number"].try_cast("int"),
        "AdmissionType": strip_ws(r["Admission Type"]),
        "DischargeDate": parse_date(r["Discharge Date"]),
        "Medication": strip_ws(r["Medication"]),
        "TestResults": strip_ws(r["Test Results"]),
    }


def _prefix(line: Column) -> Column:
    """'Line n: ', made by a lambda on purpose.  Spark compiles a projection that holds one as many small
    methods; merged with the scan or join below it would be a single one, beyond what the JVM compiles."""
    return F.get(F.transform(F.array(line), lambda n: F.concat(F.lit("Line "), n, F.lit(": "))), F.lit(0))


def _message(cond: Column, *parts) -> Column:
    """An array of one message, or none.  The arrays are put together by ``concat``: a lambda that
    filters NULLs out of an array has Spark interpret every expression in that array, row by row."""
    text = F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.when(cond, F.array(text)).otherwise(F.array().cast("array<string>"))


def _rules_full(raw: DataFrame, t: dict[str, Column], line: Column) -> list[Column]:
    r = {c: F.col(f"`{c}`") for c in EXPECTED_COLUMNS}
    pre = _prefix(line)

    def msg(cond: Column, *parts) -> Column:
        return _message(cond, pre, *parts)

    def domain(col: str, values, label: str) -> Column:
        v = t[col]
        return msg(v.isNull() | ~v.isin(values), f"Invalid {label} ", _q(v))

    # a whole number beyond 32 bits is out of range, not unreadable; the sign counts before rounding
    wide, bill = r["Age"].try_cast("decimal(38,0)"), t["BillingAmount"]
    wide = F.when(r["Age"].rlike(r"^\s*[+-]?[0-9]+\s*$"), wide)
    exact = r["Billing Amount"].try_cast("double")
    adm, dis = t["DateOfAdmission"], t["DischargeDate"]
    return [
        msg(wide.isNull(), "Invalid age ", _q(r["Age"])),
        msg(wide.isNotNull() & ((wide < AGE_MIN) | (wide > AGE_MAX)),
            "Age ", wide.cast("string"), f" out of range {AGE_MIN}-{AGE_MAX}"),
        domain("Gender", GENDERS, "gender"),
        domain("BloodType", BLOOD_TYPES, "blood type"),
        domain("MedicalCondition", CONDITIONS, "medical condition"),
        domain("AdmissionType", ADMISSION_TYPES, "admission type"),
        domain("TestResults", TEST_RESULTS, "test results"),
        msg(bill.isNull(), "Invalid billing amount ", _q(r["Billing Amount"])),
        msg(bill.isNotNull() & (exact < 0), "Negative billing amount ", python_float(exact)),
        msg(adm.isNull(), "Invalid admission date ", _q(r["Date of Admission"])),
        msg(dis.isNull(), "Invalid discharge date ", _q(r["Discharge Date"])),
        msg(adm.isNotNull() & dis.isNotNull() & (dis < adm), "Discharge date before admission date"),
        msg(t["RoomNumber"].isNull(), "Invalid room number ", _q(r["Room Number"])),
    ]


def _rules_types(raw: DataFrame, t: dict[str, Column], line: Column) -> list[Column]:
    """Permissive load: only the first failing number conversion (age, billing, room)."""
    r = {c: F.col(f"`{c}`") for c in EXPECTED_COLUMNS}
    pre = _prefix(line)
    first = (F.when(t["Age"].isNull(),
                    F.concat(pre, F.lit("invalid literal for int() with base 10: "), _q(r["Age"])))
              .when(t["BillingAmount"].isNull(),
                    F.concat(pre, F.lit("could not convert string to float: "), _q(r["Billing Amount"])))
              .when(t["RoomNumber"].isNull(),
                    F.concat(pre, F.lit("invalid literal for int() with base 10: "), _q(r["Room Number"]))))
    return [_message(t["Age"].isNull() | t["BillingAmount"].isNull() | t["RoomNumber"].isNull(), first)]


def validate(raw: DataFrame, level: str = "full", record_col: str = "claim_id") -> DataFrame:
    """Typed, cleaned columns + ``errors`` (array<string>) for every raw row.

    ``level="full"``: all thirteen checks; ``level="types"``: only numbers must parse.
    ``record_col`` (kept in front) is what the messages call the line.

    Two projections: the typed values are computed once, then every rule reads
    them by name (each typed value feeds its output column and up to three rules,
    so Catalyst keeps the projections apart instead of inlining the expressions
    into every message).
    """
    t = _typed(raw)
    typed = raw.select(F.col(record_col), *[F.col(f"`{c}`") for c in EXPECTED_COLUMNS],
                       *[t[c].alias(f"__{c}") for c in TYPED_COLUMNS])
    tc = {c: F.col(f"__{c}") for c in TYPED_COLUMNS}
    line = F.col(record_col).cast("string")
    rules = _rules_full(typed, tc, line) if level == "full" else _rules_types(typed, tc, line)
    errors = F.concat(*rules)
    return typed.select(F.col(record_col), *[tc[c].alias(c) for c in TYPED_COLUMNS],
                        errors.alias("errors"))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows without ``errors``, rejected rows with them)."""
    ok = validated.filter(F.size("errors") == 0).drop("errors")
    bad = _once(validated).filter(F.size("errors") > 0).select(*validated.columns)
    return ok, bad


def _once(validated: DataFrame) -> DataFrame:
    """The same rows; a filter on ``errors`` above reads them as they are.  Otherwise Catalyst moves it
    below the projection that makes the messages, and every row's are made for the filter and again for
    the output (three times below an ``explode``).  No filter passes a generator of its column."""
    return validated.withColumnRenamed("errors", "__errors").select("*", F.explode_outer(F.array("__errors")).alias("errors")).drop("__errors")


def reject_summary(validated: DataFrame) -> DataFrame:
    """One row: rows read, valid, rejected, total number of error messages."""
    n_err = F.size("errors")
    return validated.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(n_err == 0).alias("valid"),
        F.count_if(n_err > 0).alias("rejected"),
        F.coalesce(F.sum(n_err), F.lit(0)).cast("bigint").alias("error_count"))


def first_errors(validated: DataFrame, n: int = 10, record_col: str = "claim_id") -> DataFrame:
    """The first ``n`` messages in record order (a top-n report, not a sample)."""
    # outer, so that no filter on errors is put below the messages' projection
    e = validated.select(record_col, F.posexplode_outer("errors").alias("pos", "message")).where(F.col("message").isNotNull())
    number = F.col(record_col).try_cast("long")  # line numbers count as numbers, other keys as text
    return e.orderBy(number.asc_nulls_last(), record_col, "pos", "message").limit(n)


def as_strings(validated: DataFrame) -> DataFrame:
    """Flatten for reports: errors joined by '; ' plus their count; money as double."""
    return validated.select(
        *[c for c in validated.columns if c not in ("errors", "BillingAmount")],
        F.col("BillingAmount").cast("double").alias("BillingAmount"),
        F.array_join("errors", "; ").alias("errors"),
        F.size("errors").cast("bigint").alias("error_count"))


def constraint_audit(df: DataFrame) -> DataFrame:
    """Rows that would break each declared CHECK / NOT NULL rule of the star schema.

    A CHECK is broken only when its condition is FALSE (NULL passes, as in SQL).
    One aggregate pass, then ``stack`` to (rule, violations).
    """
    c = F.col
    rules = [
        ("patient_name_not_null", c("Name").isNull()),
        ("patient_age_range", ~c("Age").between(AGE_MIN, AGE_MAX)),
        ("patient_gender_domain", ~c("Gender").isin(GENDERS)),
        ("patient_blood_type_domain", ~c("BloodType").isin(BLOOD_TYPES)),
        ("doctor_name_not_null", c("Doctor").isNull()),
        ("hospital_name_not_null", c("Hospital").isNull()),
        ("insurer_name_not_null", c("InsuranceProvider").isNull()),
        ("medication_name_not_null", c("Medication").isNull()),
        ("admission_type_domain", ~c("AdmissionType").isin(ADMISSION_TYPES)),
        ("billing_non_negative", ~(c("BillingAmount") >= 0)),
        ("condition_domain", ~c("MedicalCondition").isin(CONDITIONS)),
        ("test_results_domain", ~c("TestResults").isin(TEST_RESULTS)),
        ("discharge_after_admission",
         ~(c("DischargeDate").isNull() | (c("DischargeDate") >= c("DateOfAdmission")))),
    ]
    wide = df.agg(*[F.count_if(cond).alias(name) for name, cond in rules])
    stack = "stack({}, {}) as (rule, violations)".format(
        len(rules), ", ".join(f"'{n}', `{n}`" for n, _ in rules))
    return wide.selectExpr(stack)


TYPED_OF = CSV_TO_TYPED
