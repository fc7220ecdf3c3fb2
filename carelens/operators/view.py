"""Enriched claims view: PII dropped, length of stay and age band added."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import admission_month, age_group, cost_per_day, length_of_stay

VIEW_COLUMNS = [
    "Age", "Gender", "BloodType", "MedicalCondition", "DateOfAdmission", "Hospital",
    "InsuranceProvider", "BillingAmount", "RoomNumber", "AdmissionType", "DischargeDate",
    "Medication", "TestResults",
]


def enriched(claims: DataFrame) -> DataFrame:
    """Explicit projection of 13 staging columns plus LengthOfStay and AgeGroup.

    A plain projection: Catalyst prunes whatever a downstream operator does not use,
    so reading through the view costs nothing extra.
    """
    return claims.select(
        *VIEW_COLUMNS,
        length_of_stay().alias("LengthOfStay"),
        age_group().alias("AgeGroup"),
    )


def with_cost_per_day(v: DataFrame) -> DataFrame:
    return v.withColumn("CostPerDay", cost_per_day())


def with_admission_month(v: DataFrame) -> DataFrame:
    return v.withColumn("admission_month", admission_month())
