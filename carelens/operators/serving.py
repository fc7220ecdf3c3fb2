"""Calculations the dashboard performs on the API results, as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def condition_mean_of_means(summary: DataFrame) -> DataFrame:
    """Unweighted mean of the age-band averages per condition, rounded half up to a whole
    unit (in integer cents, so exact)."""
    cents = F.round(F.col("avg_billing") * 100).cast("long")
    g = summary.groupBy(F.col("MedicalCondition")).agg(F.sum(cents).alias("_s"), F.count(F.lit(1)).alias("_n"))
    rounded = F.expr("(2 * _s + 100 * _n) div (200 * _n)").cast("bigint")
    return g.select("MedicalCondition", rounded.alias("mean_of_means")).orderBy("MedicalCondition")


def provider_best(compare: DataFrame) -> DataFrame:
    """Best (lowest) age-band average per insurer, ranked; badges for first and last;
    relative cost in % of the spread (spread 0 counts as 1) and the bar length.

    The windows run over one row per insurer (already aggregated).
    """
    best = compare.groupBy(F.col("InsuranceProvider").alias("insurer")).agg(F.min("avg_billing").alias("best_avg"))
    all_rows = Window.partitionBy()
    lo, hi = F.min("best_avg").over(all_rows), F.max("best_avg").over(all_rows)
    pos = F.row_number().over(Window.orderBy("best_avg", "insurer"))
    total = F.count(F.lit(1)).over(all_rows)
    b = best.select("insurer", "best_avg", lo.alias("_lo"), hi.alias("_hi"), pos.alias("position"),
                    total.alias("_k"))
    spread = F.when(F.col("_hi") - F.col("_lo") != 0, F.col("_hi") - F.col("_lo")).otherwise(F.lit(1.0))
    pct = F.floor((F.col("best_avg") - F.col("_lo")) / spread * 100 + 0.5).cast("bigint")
    badge = F.when(F.col("position") == 1, "Cheapest").when(F.col("position") == F.col("_k"), "Most Exp.")
    return b.select("insurer", "best_avg", F.col("position").cast("bigint").alias("position"),
                    badge.alias("badge"), pct.alias("relative_pct"), (100 - pct).alias("bar_pct")) \
            .orderBy("position")
