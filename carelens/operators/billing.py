"""Grouped billing summaries (the stored procedures and the analytics endpoints)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import avg_int1, avg_money, cost_per_day, money


def optional_filters(v: DataFrame, **equals) -> DataFrame:
    """AND of ``column == value`` for every value that is given (falsy values are skipped)."""
    for col, value in equals.items():
        if value:
            v = v.filter(F.col(col) == F.lit(value))
    return v


def _money_stats(b="BillingAmount", names=("AvgBilling", "ClaimCount", "MinBilling", "MaxBilling")):
    bc = F.col(b)
    return [avg_money(bc).alias(names[0]), F.count(F.lit(1)).alias(names[1]),
            money(F.min(bc)).alias(names[2]), money(F.max(bc)).alias(names[3])]


def billing_by_age_condition(v: DataFrame) -> DataFrame:
    keys = ["AgeGroup", "MedicalCondition"]
    return v.groupBy(*keys).agg(*_money_stats()).orderBy(*keys)


def cost_by_condition_insurer(v: DataFrame) -> DataFrame:
    keys = ["AgeGroup", "BloodType", "MedicalCondition", "AdmissionType", "InsuranceProvider"]
    return v.groupBy(*keys).agg(*_money_stats()).orderBy(*keys)


def length_of_stay(v: DataFrame) -> DataFrame:
    keys = ["AgeGroup", "MedicalCondition", "InsuranceProvider"]
    return (v.filter(F.col("LengthOfStay").isNotNull())
             .groupBy(*keys)
             .agg(avg_int1("LengthOfStay").alias("AvgStayDays"),
                  avg_money("BillingAmount").alias("AvgBilling"),
                  money(F.avg(cost_per_day())).alias("AvgCostPerDay"),
                  F.count(F.lit(1)).alias("ClaimCount"))
             .orderBy("AgeGroup", "MedicalCondition", "AvgCostPerDay"))


def billing_summary(v: DataFrame, condition: str | None = None,
                    age_group: str | None = None) -> DataFrame:
    keys = ["AgeGroup", "MedicalCondition"]
    f = optional_filters(v, MedicalCondition=condition, AgeGroup=age_group)
    return (f.groupBy(*keys)
             .agg(*_money_stats(names=("avg_billing", "claim_count", "min_billing", "max_billing")))
             .orderBy(*keys))


def provider_compare(v: DataFrame, condition: str, age_group: str | None = None) -> DataFrame:
    """Insurers side by side for one condition; population std dev, 0 reported as NULL."""
    f = optional_filters(v, MedicalCondition=condition, AgeGroup=age_group)
    sd = F.round(F.stddev_pop(F.col("BillingAmount").cast("double")), 2)
    return (f.groupBy("InsuranceProvider", "AgeGroup")
             .agg(avg_money().alias("avg_billing"),
                  F.count(F.lit(1)).alias("claim_count"),
                  sd.alias("_sd"))
             .withColumn("stddev_billing", F.when(F.col("_sd") != 0, F.col("_sd")))
             .drop("_sd")
             .orderBy("AgeGroup", "avg_billing"))
