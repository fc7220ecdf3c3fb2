"""Star schema: dimensions with surrogate keys, the Admission fact and audits.

Surrogate keys follow the sorted order of the natural key (as rows inserted
with ``ORDER BY`` into AUTO_INCREMENT tables) and are assigned with
``plans.ordering.dense_sequence`` — range-partitioned, never a
single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import collated
from ..plans.ordering import dense_sequence, dense_sequence_grouped, number_rows

# dimension table → (key column, staging column)
NAME_DIMENSIONS = {
    "Doctor": ("DoctorID", "Doctor"),
    "Hospital": ("HospitalID", "Hospital"),
    "InsuranceProvider": ("InsuranceID", "InsuranceProvider"),
    "Medication": ("MedicationID", "Medication"),
}
PATIENT_KEYS = ["Name", "Age", "Gender", "BloodType"]
FACT_ATTRS = ["DateOfAdmission", "RoomNumber", "AdmissionType", "DischargeDate", "BillingAmount",
              "MedicalCondition", "TestResults"]


def dimension(claims: DataFrame, source_col: str, key: str, collation: str | None = None) -> DataFrame:
    """Distinct non-NULL values of one column, keyed 1..n in sorted order → (key, Name).

    With ``collation="UNICODE_CI_AI"`` values differing only in case or accents are one
    member (the reference database's default collation behaves so).
    """
    vals = claims.select(collated(source_col, collation).alias("Name")).where(F.col("Name").isNotNull())
    return dense_sequence(vals, ["Name"], key)


def patients(claims: DataFrame) -> DataFrame:
    """Distinct (Name, Age, Gender, BloodType) with a Name, keyed in that sort order."""
    p = claims.select(*PATIENT_KEYS).where(F.col("Name").isNotNull())
    return dense_sequence(p, PATIENT_KEYS, "PatientID")


def test_dimension(claims: DataFrame) -> DataFrame:
    """Legacy test-result dimension: distinct TestResults, keyed."""
    return dense_sequence(claims.select(F.col("TestResults").alias("Name")), ["Name"], "TestID")


def admission_distinct(claims: DataFrame) -> DataFrame:
    """Legacy admission load: DISTINCT of five visit columns, no foreign keys."""
    return claims.select("DateOfAdmission", "RoomNumber", "AdmissionType", "DischargeDate",
                         "BillingAmount").distinct()


def name_dimensions(claims: DataFrame) -> dict[str, DataFrame]:
    """The four name dimensions keyed together: one stack → distinct → keyed pass."""
    pairs = ", ".join(f"'{name}', `{src}`" for name, (_k, src) in NAME_DIMENSIONS.items())
    stacked = claims.selectExpr(f"stack({len(NAME_DIMENSIONS)}, {pairs}) AS (dim, Name)") \
                    .where(F.col("Name").isNotNull())
    keyed = dense_sequence_grouped(stacked, "dim", ["Name"], "_key")
    return {name: keyed.where(F.col("dim") == name).select(F.col("_key").alias(key), "Name")
            for name, (key, _s) in NAME_DIMENSIONS.items()}


def dimensions(claims: DataFrame) -> dict[str, DataFrame]:
    """All five dimensions from one pass over the claims.

    Each dimension contributes (dim, k1..k4) rows — a name dimension its value and
    three NULLs, Patient its four columns — and one grouped numbering keys them all
    in their sort order (NULLs first, so a name dimension orders by name).
    """
    parts = [f"'{name}', `{src}`, CAST(NULL AS INT), CAST(NULL AS STRING), CAST(NULL AS STRING)"
             for name, (_k, src) in NAME_DIMENSIONS.items()]
    parts.append("'Patient', Name, Age, Gender, BloodType")
    stacked = claims.selectExpr(f"stack({len(parts)}, {', '.join(parts)}) AS (dim, k1, k2, k3, k4)") \
                    .where(F.col("k1").isNotNull())
    keyed = dense_sequence_grouped(stacked, "dim", ["k1", "k2", "k3", "k4"], "_key")
    dims = {name: keyed.where(F.col("dim") == name).select(F.col("_key").alias(key), F.col("k1").alias("Name"))
            for name, (key, _s) in NAME_DIMENSIONS.items()}
    dims["Patient"] = keyed.where(F.col("dim") == "Patient").select(
        F.col("_key").alias("PatientID"), F.col("k1").alias("Name"), F.col("k2").alias("Age"),
        F.col("k3").alias("Gender"), F.col("k4").alias("BloodType"))
    return dims


def extend(stored: DataFrame, rows: DataFrame, cols: list[str], key: str) -> DataFrame:
    """A stored dimension with the members of ``rows`` (columns ``cols``) that it lacks: stored members
    keep their keys, new ones are numbered in sort order above the largest stored key.

    Only new members are numbered, an anti join finds them; NULLs are compared as values.  Rows without
    new members leave the dimension as it is.  The largest key is fetched, one number."""
    new = rows.select(*cols).distinct().alias("n")
    same = None
    for c in cols:
        here = F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}"))
        same = here if same is None else same & here
    new = new.join(stored.select(*cols).alias("s"), same, "left_anti")
    above = stored.agg(F.coalesce(F.max(key), F.lit(0)).cast("long")).first()[0]
    numbered = dense_sequence(new, cols, key).withColumn(key, F.col(key) + F.lit(above))
    return stored.select(key, *cols).unionByName(numbered)


def extend_dimensions(stored: dict[str, DataFrame], claims: DataFrame) -> dict[str, DataFrame]:
    """The five dimensions of an earlier load, extended by the members that ``claims`` brings."""
    out = {}
    for name, (key, src) in NAME_DIMENSIONS.items():
        rows = claims.select(F.col(src).alias("Name")).where(F.col("Name").isNotNull())
        out[name] = extend(stored[name], rows, ["Name"], key)
    out["Patient"] = extend(stored["Patient"], claims.where(F.col("Name").isNotNull()), PATIENT_KEYS, "PatientID")
    return out


def build_fact(claims: DataFrame, dims: dict[str, DataFrame], with_id: bool = True) -> DataFrame:
    """Admission fact: staging inner-joined to the five dimensions.

    Patient is matched on four columns (equality, so a NULL key drops the row, as in
    SQL).  The name dimensions come first, so what the later shuffles carry are keys, no names; the
    planner picks their joins from their sizes.  Patients grow with the claims: their join is a merge
    join at any size (never a broadcast), whose skewed keys AQE splits.
    """
    f = claims
    for name in ("Hospital", "InsuranceProvider", "Medication", "Doctor"):
        key, src = NAME_DIMENSIONS[name]
        f = f.join(dims[name].withColumnRenamed("Name", src), src, "inner").drop(src)
    f = f.join(dims["Patient"].hint("merge"), PATIENT_KEYS, "inner")
    fact = f.select("PatientID", "DoctorID", "HospitalID", "InsuranceID", "MedicationID", *FACT_ATTRS)
    if not with_id:
        return fact
    order = ["PatientID", "DoctorID", "HospitalID", "InsuranceID", "MedicationID"] + FACT_ATTRS
    return number_rows(fact, order, "AdmissionID").select("AdmissionID", *fact.columns)


def fk_audit(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, per foreign key → (fk, orphans); one pass
    over the fact (dimension keys are unique, so the left joins add no rows)."""
    keys = ["PatientID", *[k for k, _s in NAME_DIMENSIONS.values()]]
    rows = fact.select(*keys)
    for name, key in zip(["Patient", *NAME_DIMENSIONS], keys):
        rows = rows.join(dims[name].select(key, F.lit(True).alias(f"_has_{key}")), key, "left")
    counts = rows.agg(*[F.count_if(F.col(f"_has_{k}").isNull()).alias(k) for k in keys])
    return counts.selectExpr(f"stack({len(keys)}, {', '.join(f"'{k}', `{k}`" for k in keys)}) AS (fk, orphans)")
