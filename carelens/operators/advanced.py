"""Windowed and derived analytics: percentiles, market share, outliers, cost
efficiency, repeat admissions, monthly trend and the admission-type matrix."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import admission_month, collated, avg_int1, avg_money, cost_per_day, money
from ..plans.quantiles import rank_lookup

PERCENTILES = [("p25", "0.25"), ("median", "0.50"), ("p75", "0.75"), ("p90", "0.90"), ("p99", "0.99")]


def order_stat_percentiles(v: DataFrame, key: str = "MedicalCondition",
                           col: str = "BillingAmount", ps=PERCENTILES) -> DataFrame:
    """Per group, the value at row ``GREATEST(1, FLOOR(total * p))`` of the ascending order
    (NULLs first, counted in total), plus ``iqr = round(p75 - p25, 2)``.

    Exact, and no group is ever sorted inside a single task (see plans.quantiles).
    """
    def targets(n):
        return [(name, F.greatest(F.lit(1).cast("long"),
                                  F.floor(n * F.lit(Decimal(p))).cast("long"))) for name, p in ps]
    found = rank_lookup(v.select(key, col), [key], col, targets)
    wide = found.groupBy(key).agg(*[
        F.max(F.when(F.col("target") == name, F.col("value"))).alias(name) for name, _ in ps])
    out = [F.col(key)] + [F.col(name).cast("double").alias(name) for name, _ in ps]
    if {"p25", "p75"} <= {n for n, _ in ps}:
        out.append(money(F.col("p75") - F.col("p25")).alias("iqr"))
    return wide.select(*out).orderBy(key)


def market_share(v: DataFrame) -> DataFrame:
    """Claims per (condition, insurer), share of the condition in % (1 dp), rank by claims."""
    counts = v.groupBy("MedicalCondition", "InsuranceProvider").agg(F.count(F.lit(1)).alias("claims"))
    part = Window.partitionBy("MedicalCondition")
    share = F.round(F.col("claims") * F.lit(Decimal("100.0")) / F.sum("claims").over(part), 1)
    rank = F.rank().over(part.orderBy(F.col("claims").desc()))
    return (counts.select("MedicalCondition", "InsuranceProvider", "claims",
                          share.cast("double").alias("market_share_pct"),
                          rank.cast("bigint").alias("share_rank"))
                  .orderBy("MedicalCondition", "share_rank"))


def condition_stats(v: DataFrame, key: str = "MedicalCondition") -> DataFrame:
    """Per group: exact mean (decimal) and population std dev (double) of billing."""
    return v.groupBy(key).agg(
        F.avg("BillingAmount").alias("mean_bill"),
        F.stddev_pop(F.col("BillingAmount").cast("double")).alias("std_bill"))


def outlier_rows(v: DataFrame, key: str = "MedicalCondition") -> DataFrame:
    """Claims above their group's mean + 2·σ (population).  The per-group statistics
    are one small aggregate; AQE sees its size and joins it map-side."""
    j = v.join(condition_stats(v, key), key)
    return j.filter(F.col("BillingAmount") > F.col("mean_bill") + 2 * F.col("std_bill"))


def outlier_summary(v: DataFrame, condition: str | None = None) -> DataFrame:
    """Outlier count, their average, condition mean and threshold per condition.

    Statistics are computed over all claims; the optional condition filter applies after.
    """
    rows = outlier_rows(v)
    if condition:
        rows = rows.filter(F.col("MedicalCondition") == F.lit(condition))
    return (rows.groupBy("MedicalCondition", "mean_bill", "std_bill")
                .agg(F.count(F.lit(1)).alias("outlier_count"),
                     avg_money().alias("avg_outlier_bill"))
                .select("MedicalCondition", "outlier_count", "avg_outlier_bill",
                        money("mean_bill").alias("condition_mean"),
                        F.round(F.col("mean_bill") + 2 * F.col("std_bill"), 2).alias("threshold"))
                .orderBy(F.col("outlier_count").desc()))


def cost_efficiency(v: DataFrame, min_claims: int = 10) -> DataFrame:
    """Per (insurer, condition) with stay > 0: averages and dense rank of the unrounded
    cost per day within the condition; groups below ``min_claims`` are dropped first."""
    f = v.filter(F.col("LengthOfStay").isNotNull() & (F.col("LengthOfStay") > 0))
    g = (f.groupBy("InsuranceProvider", "MedicalCondition")
          .agg(F.count(F.lit(1)).alias("claims"),
               avg_money().alias("avg_billing"),
               avg_int1("LengthOfStay").alias("avg_stay_days"),
               F.avg(cost_per_day()).alias("_cpd"))
          .filter(F.col("claims") >= min_claims))
    rank = F.dense_rank().over(Window.partitionBy("MedicalCondition").orderBy(F.col("_cpd").asc()))
    return (g.select("InsuranceProvider", "MedicalCondition", "claims", "avg_billing",
                     "avg_stay_days", money("_cpd").alias("cost_per_day"),
                     rank.cast("bigint").alias("efficiency_rank"))
             .orderBy("MedicalCondition", "efficiency_rank"))


def readmission(claims: DataFrame, limit: int = 20, collation: str | None = None) -> DataFrame:
    """Two-level aggregate: patients (Name) admitted more than once for the same
    condition and insurer, then per (insurer, condition); top ``limit`` by patients.
    ``collation`` optionally groups names case/accent-insensitively."""
    per_patient = (claims.groupBy(collated("Name", collation).alias("Name"), "MedicalCondition",
                                  "InsuranceProvider")
                         .agg(F.count(F.lit(1)).alias("admission_count"))
                         .filter(F.col("admission_count") > 1))
    g = per_patient.groupBy("InsuranceProvider", "MedicalCondition").agg(
        F.count(F.lit(1)).alias("patients_with_readmissions"),
        avg_int1("admission_count").alias("avg_admissions_per_patient"),
        F.max("admission_count").alias("max_admissions"))
    return g.orderBy(F.col("patients_with_readmissions").desc(),
                     "InsuranceProvider", "MedicalCondition").limit(limit)


def monthly_stats(v: DataFrame) -> DataFrame:
    """admission_month ('yyyy-MM') → admissions, avg_billing (decimal, 2 dp), total_billing."""
    return v.groupBy(admission_month().alias("admission_month")).agg(
        F.count(F.lit(1)).alias("admissions"),
        F.round(F.avg("BillingAmount"), 2).alias("avg_billing"),
        F.round(F.sum("BillingAmount"), 2).alias("total_billing"))


def monthly_trend(v: DataFrame) -> DataFrame:
    """Monthly stats plus change of the rounded average versus the previous month.

    The LAG window has no partition key, but it runs over one row per month
    (already aggregated), so the single task handles a few hundred rows.
    """
    m = monthly_stats(v)
    prev = F.lag("avg_billing").over(Window.orderBy("admission_month"))
    return (m.select("admission_month", "admissions",
                     F.col("avg_billing").cast("double").alias("avg_billing"),
                     F.col("total_billing").cast("double").alias("total_billing"),
                     money(F.col("avg_billing") - prev).alias("month_over_month_change"))
             .orderBy("admission_month"))


def cost_matrix(v: DataFrame) -> DataFrame:
    """Per condition: average billing per admission type and the emergency premium
    (difference of the *unrounded* averages, then rounded)."""
    b = F.col("BillingAmount")
    t = F.col("AdmissionType")
    el = F.avg(F.when(t == "Elective", b))
    em = F.avg(F.when(t == "Emergency", b))
    ur = F.avg(F.when(t == "Urgent", b))
    return (v.groupBy("MedicalCondition")
             .agg(money(el).alias("elective_avg"), money(em).alias("emergency_avg"),
                  money(ur).alias("urgent_avg"), money(em - el).alias("emergency_premium"))
             .orderBy(F.col("emergency_premium").desc()))
