"""Exploratory summaries: group statistics with medians, describe, pivot tables,
means by group, outlier flags and shares, value counts, age bins, histograms and
box-plot statistics.  Quantiles are exact (see plans.quantiles)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import avg_money, cost_per_day, money
from ..plans.quantiles import boxes, quantiles
from ..schema import AGE_BANDS, CONDITIONS, OLDEST_BAND

QUARTILES = [("q1", "0.25"), ("median", "0.50"), ("q3", "0.75")]
VALUE_COUNT_COLUMNS = ["MedicalCondition", "InsuranceProvider", "AdmissionType", "Medication",
                       "TestResults", "Gender", "BloodType"]


def group_stats(df: DataFrame, key: str = "InsuranceProvider", col: str = "BillingAmount") -> DataFrame:
    """mean, median (interpolated) and sample std dev per group, rounded to 2."""
    q = quantiles(df.select(key, col), [key], col, [("median", "0.5")], also=[
        ("mean", avg_money("value")), ("std", F.round(F.stddev_samp(F.col("value").cast("double")), 2))])
    # a group without any value has no quantile, but its row
    every = df.select(key).distinct().join(q, key, "left")
    return every.select(key, "mean", money("median").alias("median"), "std").orderBy(key)


def describe(v: DataFrame, cols=("Age", "BillingAmount", "LengthOfStay")) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (interpolated), max per column, rounded to 2.

    The columns are stacked into (column, value); the first of two scans gives the moments with the
    sketches, the second the exact quartiles.
    """
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DECIMAL(18,4))" for c in cols)
    long = v.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, value)").where(F.col("value").isNotNull())
    v = F.col("value")
    q = quantiles(long, ["column"], "value", [("p25", "0.25"), ("p50", "0.50"), ("p75", "0.75")], also=[
        ("mean", avg_money("value")), ("std", F.round(F.stddev_samp(v.cast("double")), 2)),
        ("min", money(F.min(v))), ("max", money(F.max(v)))])
    return q.select("column", F.col("n").alias("count"), "mean", "std", "min", money("p25").alias("p25"),
                    money("p50").alias("p50"), money("p75").alias("p75"), "max")


#: A pivot has a column per value; beyond this many it is refused (``billing_summary`` has the long form).
MOST_COLUMNS = 1000


def provider_condition_matrix(v: DataFrame) -> DataFrame:
    """Insurer × condition mean billing, rounded to whole currency units.

    A first job finds the conditions there are (distinct values, at most ``MOST_COLUMNS``); the known
    ones always have their column, others follow in order, NULL has none.
    """
    found = [r[0] for r in v.select("MedicalCondition").where(F.col("MedicalCondition").isNotNull())
             .distinct().orderBy("MedicalCondition").limit(MOST_COLUMNS + 1).collect()]
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} conditions: use the long form")
    return (v.groupBy("InsuranceProvider")
             .pivot("MedicalCondition", [*CONDITIONS, *(c for c in found if c not in CONDITIONS)])
             .agg(money(F.avg("BillingAmount"), 0))
             .orderBy("InsuranceProvider"))


def los_by_condition(v: DataFrame) -> DataFrame:
    """Mean length of stay per condition (exact average, 4 decimals), ascending."""
    return (v.groupBy("MedicalCondition")
             .agg(F.avg(F.col("LengthOfStay").cast("decimal(20,0)")).cast("double").alias("avg_los"))
             .orderBy("avg_los"))


def cost_per_day_by_provider(v: DataFrame) -> DataFrame:
    """Mean billing per day of stay per insurer (stays of 0 days ignored), ascending."""
    return (v.groupBy("InsuranceProvider")
             .agg(money(F.avg(cost_per_day())).alias("cost_per_day"))
             .orderBy("cost_per_day"))


def _sample_stats(v: DataFrame, key: str) -> DataFrame:
    return v.groupBy(key).agg(F.avg("BillingAmount").alias("_mean"),
                              F.stddev_samp(F.col("BillingAmount").cast("double")).alias("_std"))


def flag_outliers(v: DataFrame, key: str = "MedicalCondition") -> DataFrame:
    """Every claim with ``IsOutlier`` = billing above its group's mean + 2 · sample std dev."""
    j = v.join(_sample_stats(v, key), key, "left")
    flag = F.coalesce(F.col("BillingAmount") > F.col("_mean") + 2 * F.col("_std"), F.lit(False))
    return j.withColumn("IsOutlier", flag).drop("_mean", "_std")


def outlier_share(v: DataFrame) -> DataFrame:
    """Per condition: claims, outliers, share as 'x.x%', mean billing of the outliers."""
    f = flag_outliers(v)
    out = F.col("IsOutlier")
    g = f.groupBy("MedicalCondition").agg(
        F.count("BillingAmount").alias("total"),
        F.count_if(out).alias("outliers"),
        avg_money(F.when(out, F.col("BillingAmount"))).alias("avg_outlier_bill"))
    pct = F.round(F.col("outliers") * F.lit(Decimal("100.0")) / F.col("total"), 1)
    return g.select("MedicalCondition", "total", "outliers",
                    F.format_string("%.1f%%", pct.cast("double")).alias("outlier_pct"),
                    "avg_outlier_bill").orderBy("MedicalCondition")


def value_counts(df: DataFrame, cols=VALUE_COUNT_COLUMNS) -> DataFrame:
    """(column, value, n) for several categorical columns in one pass."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, value)").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")) \
               .orderBy("column", F.col("n").desc(), "value")


def age_bins(df: DataFrame, age: str = "Age") -> DataFrame:
    """Claims per left-closed age bin [0,2) … [81,151); ages outside are not counted;
    every bin is listed, empty ones with 0."""
    a = F.col(age)
    expr = None
    for label, lo, hi in AGE_BANDS + [(OLDEST_BAND[0], OLDEST_BAND[1], 150)]:
        cond = (a >= lo) & (a < hi + 1)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    counts = df.select(expr.alias("AgeGroup")).where(F.col("AgeGroup").isNotNull()) \
               .groupBy("AgeGroup").agg(F.count(F.lit(1)).alias("n"))
    labels = [(i, b[0]) for i, b in enumerate(AGE_BANDS + [(OLDEST_BAND[0], 0, 0)])]
    bands = df.sparkSession.createDataFrame(labels, "band int, AgeGroup string")
    return (bands.join(counts, "AgeGroup", "left")
                 .select("band", "AgeGroup", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
                 .orderBy("band"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with the last bin closed; empty bins listed.

    min and max come from one aggregate; the bin of each value is arithmetic, and the
    counts are joined onto ``range(bins)`` so every bin appears.
    """
    x = F.col(col).cast("double")
    mm = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if mm is None or mm["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin bigint, lower double, upper double, n bigint")
    lo, hi = float(mm["lo"]), float(mm["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    norm = bins / (hi - lo)
    idx = F.least(F.floor((x - F.lit(lo)) * F.lit(norm)), F.lit(bins - 1)).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (grid.join(counts, "bin", "left")
                .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"),
                        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
                .orderBy("bin"))


def boxplot_stats(df: DataFrame, key: str = "MedicalCondition", col: str = "BillingAmount") -> DataFrame:
    """Quartiles, IQR, whiskers at the most extreme points within 1.5·IQR (never inside the box), flier count;
    groups ordered by median.

    Two scans: the fences' bands follow from the quartiles' (see plans.quantiles).
    """
    q = boxes(df, key, col, QUARTILES)
    return q.select(key, "n", *[money(c, 4).alias(c) for c in ["q1", "median", "q3", "iqr", "whislo", "whishi"]],
                    "fliers").orderBy("median", key)
