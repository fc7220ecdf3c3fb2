"""Data-quality profile of the staging table, one DataFrame per report section.

Where the reference issues one query per column (25 scans for completeness,
15 for cardinality), each section here is a single pass: conditional counts
in one aggregate, or a ``stack`` to (column, value) pairs followed by one
grouped aggregation.
"""

from __future__ import annotations

from decimal import ROUND_FLOOR, Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import age_group, avg_int1, avg_money, length_of_stay
from ..plans.quantiles import rank_lookup
from ..schema import MONEY, ADMISSION_TYPES, BLOOD_TYPES, GENDERS, TEXT_COLUMNS, TYPED_COLUMNS

CATEGORICALS = ["Gender", "BloodType", "MedicalCondition", "AdmissionType", "InsuranceProvider",
                "TestResults"]


def _pct1(part, total):
    """round(100 * part / total, 1) in exact decimal arithmetic, as double."""
    return F.round(part * F.lit(Decimal("100.0")) / total, 1).cast("double")


def _stack(df: DataFrame, cols, value_type: str = "string") -> DataFrame:
    """(column, value) pairs for the given columns (values cast to ``value_type``)."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS {value_type})" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, value)")


def profile_overview(claims: DataFrame) -> DataFrame:
    return claims.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("Age").alias("min_age"), F.max("Age").alias("max_age"),
        avg_int1("Age").alias("avg_age"),
        F.min("BillingAmount").cast("double").alias("min_bill"),
        F.max("BillingAmount").cast("double").alias("max_bill"),
        avg_money().alias("avg_bill"),
        F.min("DateOfAdmission").alias("earliest"), F.max("DateOfAdmission").alias("latest"))


def profile_completeness(claims: DataFrame) -> DataFrame:
    """Per column: NULLs, empty-after-trim (text columns only), % complete (1 dp)."""
    aggs = [F.count(F.lit(1)).alias("_total")]
    for c in TYPED_COLUMNS:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"n_{c}"))
        if c in TEXT_COLUMNS:
            aggs.append(F.count_if(F.trim(F.col(c)) == "").alias(f"e_{c}"))
    wide = claims.agg(*aggs)
    parts = ", ".join(
        f"{i + 1}, '{c}', n_{c}, {f'e_{c}' if c in TEXT_COLUMNS else 'CAST(0 AS BIGINT)'}"
        for i, c in enumerate(TYPED_COLUMNS))
    long = wide.selectExpr("_total", f"stack({len(TYPED_COLUMNS)}, {parts}) AS (position, `column`, nulls, empties)")
    pct = F.when(F.col("_total") > 0,
                 _pct1(F.col("_total") - F.col("nulls") - F.col("empties"), F.col("_total"))) \
           .otherwise(F.lit(0.0))
    return long.select(F.col("position").cast("int").alias("position"), "column", "nulls", "empties",
                       pct.alias("pct_complete")).orderBy("position")


def profile_cardinality(claims: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column and the cardinality class.

    One pass: stack to (column, value), count rows per (column, value) with a
    partial aggregation, then per column the number of non-NULL groups is the
    distinct count and the sum of the group sizes is the row count.
    ``approx=True`` uses HyperLogLog (``approx_count_distinct``) instead.
    """
    pairs = _stack(claims, TYPED_COLUMNS)
    if approx:
        per = pairs.groupBy("column").agg(F.approx_count_distinct("value").alias("distinct_values"),
                                          F.count(F.lit(1)).alias("_total"))
    else:
        per = (pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_cnt"))
                    .groupBy("column").agg(F.count("value").alias("distinct_values"),
                                           F.sum("_cnt").alias("_total")))
    names = claims.sparkSession.createDataFrame(
        [(i + 1, c) for i, c in enumerate(TYPED_COLUMNS)], "position int, column string")
    j = names.join(per, "column", "left")
    d = F.coalesce(F.col("distinct_values"), F.lit(0))
    ratio = F.when(F.col("_total") > 0, d / F.col("_total")).otherwise(F.lit(0.0))
    cls = (F.when(ratio > 0.9, "High (likely unique)").when(ratio > 0.1, "Medium")
            .when(d <= 10, "Low (categorical)").otherwise("Low-Medium"))
    return j.select("position", "column", d.cast("bigint").alias("distinct_values"),
                    cls.alias("cardinality")).orderBy("position")


def profile_categories(claims: DataFrame, cols=CATEGORICALS) -> DataFrame:
    """Value counts and share (1 dp) of each categorical column, most frequent first."""
    counts = _stack(claims, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("column"))
    return (counts.select("column", "value", "n", _pct1(F.col("n"), total).alias("pct"))
                  .orderBy("column", F.col("n").desc(), "value"))


def billing_moments(claims: DataFrame) -> DataFrame:
    b = F.col("BillingAmount")
    return claims.agg(avg_money().alias("mean"),
                      F.round(F.stddev_pop(b.cast("double")), 2).alias("stddev"),
                      F.min(b).cast("double").alias("min_val"),
                      F.max(b).cast("double").alias("max_val"))


def profile_billing(claims: DataFrame) -> DataFrame:
    return billing_moments(claims)


# Offsets of the five order statistics (0-based row after ORDER BY ... OFFSET k).
def _profile_offsets(n):
    return [("p25", F.expr("_n div 4")), ("p50", F.expr("_n div 2")), ("p75", F.expr("(_n * 3) div 4")),
            ("p90", (n * F.lit(0.9)).cast("long")), ("p99", (n * F.lit(0.99)).cast("long"))]


def kth_values(df: DataFrame, col: str, offsets=_profile_offsets) -> DataFrame:
    """Value at 0-based offset k of the ascending order (NULLs first) over the whole table.

    Long form (percentile, offset, value); an empty table gives no rows.
    """
    # the whole table is one group: every join inside rank_lookup keeps an equality key
    found = rank_lookup(df.select(F.lit("all").alias("_scope"), col), ["_scope"], col,
                        lambda n: [(name, k + 1) for name, k in offsets(n)])
    return found.select(F.col("target").alias("percentile"), (F.col("k") - 1).alias("offset"),
                        F.col("value").cast("double").alias("value"))


def profile_percentiles(claims: DataFrame) -> DataFrame:
    return kth_values(claims, "BillingAmount").orderBy("offset")


def profile_outliers(claims: DataFrame) -> DataFrame:
    """Rows above mean + 2σ and mean + 3σ, with mean and σ rounded to cents first.

    The one-row moments are fetched, then the thresholds are literals in the filter,
    so parquet min/max statistics can skip row groups.
    """
    m = billing_moments(claims).first()
    if m is None or m["mean"] is None:
        mean, sd = 0.0, 0.0
    else:
        mean, sd = float(m["mean"]), float(m["stddev"] or 0.0)
    t2, t3 = mean + 2 * sd, mean + 3 * sd
    b = F.col("BillingAmount")

    def above(t: float):
        # b has 4 decimals, so b > t exactly when b > t floored to 4 decimals; a literal of
        # the column's own type keeps the predicate pushable into the parquet reader.
        g = Decimal(t).quantize(Decimal("0.0001"), rounding=ROUND_FLOOR)
        return b > F.lit(g).cast(MONEY)

    # rows above 3σ are a subset of those above 2σ: one filtered pass counts both
    return claims.where(above(t2)).agg(F.count(F.lit(1)).alias("outliers_2sd"),
                                       F.count_if(above(t3)).alias("outliers_3sd")).select(
        F.lit(mean).alias("mean"), F.lit(sd).alias("stddev"),
        F.round(F.lit(t2), 2).alias("threshold_2sd"), "outliers_2sd",
        F.round(F.lit(t3), 2).alias("threshold_3sd"), "outliers_3sd")


def profile_age_groups(claims: DataFrame) -> DataFrame:
    g = claims.groupBy(age_group().alias("AgeGroup")).agg(
        F.count(F.lit(1)).alias("n"), avg_money().alias("avg_billing"), F.min("Age").alias("_min_age"))
    return g.orderBy(F.col("_min_age").asc_nulls_first()).drop("_min_age")


def profile_los(claims: DataFrame) -> DataFrame:
    los = length_of_stay()
    f = claims.where(F.col("DischargeDate").isNotNull() & F.col("DateOfAdmission").isNotNull())
    return f.agg(avg_int1(los).alias("avg_stay"), F.min(los).alias("min_stay"),
                 F.max(los).alias("max_stay"), F.count_if(los == 0).alias("same_day"),
                 F.count_if(los > 30).alias("over_30_days"))


def quality_rules():
    """(name, violation condition) of the five checks; a NULL condition is no violation."""
    c = F.col
    return [
        ("No NULLs in key fields",
         c("Name").isNull() | c("Age").isNull() | c("BillingAmount").isNull()
         | c("InsuranceProvider").isNull() | c("MedicalCondition").isNull()),
        ("All billing amounts >= 0", c("BillingAmount") < 0),
        ("Discharge date >= admission date", c("DischargeDate") < c("DateOfAdmission")),
        ("Age in range 0-150", (c("Age") < 0) | (c("Age") > 150)),
        ("All categorical values valid",
         ~c("Gender").isin(GENDERS) | ~c("BloodType").isin(BLOOD_TYPES)
         | ~c("AdmissionType").isin(ADMISSION_TYPES)),
    ]


def quality_checks(claims: DataFrame) -> DataFrame:
    """The five checks in one pass → (check_id, check_name, violations, status)."""
    rules = quality_rules()
    wide = claims.agg(*[F.count_if(cond).alias(f"c{i}") for i, (_n, cond) in enumerate(rules)])
    parts = ", ".join(f"{i + 1}, '{name}', c{i}" for i, (name, _c) in enumerate(rules))
    long = wide.selectExpr(f"stack({len(rules)}, {parts}) AS (check_id, check_name, violations)")
    return long.select(F.col("check_id").cast("int").alias("check_id"), "check_name", "violations",
                       F.when(F.col("violations") == 0, "PASS").otherwise("FAIL").alias("status"))


def quality_score(checks: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("status") == "PASS")
    total = F.count(F.lit(1))
    return checks.agg(passed.alias("checks_passed"), total.alias("checks_total"),
                      F.round(passed * 100.0 / total, 0).cast("bigint").alias("score_pct"))
