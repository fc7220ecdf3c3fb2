"""Hypothesis tests and intervals from per-group sufficient statistics.

Everything starts with one ``groupBy(key).agg(count, avg, var_samp)`` — a
partial aggregation whatever the data size or skew — and continues on the
k-row result: pairs of groups, Welch's t, Cohen's d, one-way ANOVA and
confidence intervals.  The only Python is the distribution helper applied to
those few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.distributions import f_p_value, t_p_value, t_ppf

ALPHA = 0.05


def group_moments(df: DataFrame, key: str = "InsuranceProvider", value: str = "BillingAmount",
                  where: dict | None = None) -> DataFrame:
    """key, n, mean (exact average as double), var (sample; NULL when n = 1)."""
    for col, v in (where or {}).items():
        if v:
            df = df.filter(F.col(col) == F.lit(v))
    x = F.col(value)
    return (df.where(x.isNotNull()).groupBy(key)
              .agg(F.count(x).alias("n"), F.avg(x).cast("double").alias("mean"),
                   F.var_samp(x.cast("double")).alias("var")))


def moments_report(m: DataFrame, key: str = "InsuranceProvider") -> DataFrame:
    """N, mean, sample std dev (0 for a group of one), sorted by name."""
    return m.select(key, "n", F.round("mean", 4).alias("mean"),
                    F.round(F.coalesce(F.sqrt("var"), F.lit(0.0)), 4).alias("stddev")).orderBy(key)


def pairs(m: DataFrame, key: str = "InsuranceProvider") -> DataFrame:
    """Unordered pairs (a < b by name) of the k groups, as an equi-join.

    Each group gets its position i in name order (a window over k aggregated
    rows), lists the positions after it, and is joined to them by position —
    exactly k(k-1)/2 output rows, no nested-loop or cross join.
    """
    idx = (m.withColumn("_i", F.row_number().over(Window.orderBy(key)))
            .withColumn("_k", F.max("_i").over(Window.partitionBy())))
    left = idx.withColumn(
        "_j", F.explode(F.sequence(F.col("_i") + 1, F.greatest(F.col("_k"), F.col("_i") + 1))))
    left = left.where(F.col("_j") <= F.col("_k"))
    a = left.select(F.col(key).alias("a"), F.col("n").alias("n1"), F.col("mean").alias("m1"),
                    F.col("var").alias("v1"), "_j")
    b = idx.select(F.col(key).alias("b"), F.col("n").alias("n2"), F.col("mean").alias("m2"),
                   F.col("var").alias("v2"), F.col("_i").alias("_j"))
    return a.join(b, "_j").drop("_j")


def welch(m: DataFrame, key: str = "InsuranceProvider") -> DataFrame:
    """Welch's unequal-variance t-test for every pair of groups."""
    p = pairs(m, key)
    s1, s2 = F.col("v1") / F.col("n1"), F.col("v2") / F.col("n2")
    se2 = s1 + s2
    ok = se2 > 0
    t = F.when(ok, (F.col("m1") - F.col("m2")) / F.sqrt(se2))
    dof = F.when(ok, se2 * se2 / (s1 * s1 / (F.col("n1") - 1) + s2 * s2 / (F.col("n2") - 1)))
    r = p.select(F.col("a").alias("provider_a"), F.col("b").alias("provider_b"),
                 F.round(F.col("m1") - F.col("m2"), 2).alias("mean_diff"),
                 t.alias("_t"), dof.alias("_df"))
    r = r.withColumn("_p", t_p_value(F.col("_t"), F.col("_df")))
    return r.select("provider_a", "provider_b", "mean_diff",
                    F.round("_t", 4).alias("t_stat"), F.round("_df", 2).alias("df"),
                    F.round("_p", 6).alias("p_value"),
                    F.when(F.col("_p") < ALPHA, "SIGNIFICANT").otherwise("not sig.").alias("result"))


def welch_summary(w: DataFrame) -> DataFrame:
    return w.agg(F.count_if(F.col("result") == "SIGNIFICANT").alias("significant_pairs"),
                 F.count(F.lit(1)).alias("total_pairs"))


def confidence_intervals(m: DataFrame, key: str = "InsuranceProvider", level: float = 0.95) -> DataFrame:
    """mean ± t(1-α/2, n-1) · s/√n per group."""
    q = (1.0 + level) / 2.0
    se = F.sqrt(F.col("var") / F.col("n"))
    tq = t_ppf(F.lit(q), (F.col("n") - 1).cast("double"))
    margin = tq * se
    return m.select(key, "n", F.round("mean", 2).alias("mean"),
                    F.round(F.col("mean") - margin, 2).alias("ci_lower"),
                    F.round(F.col("mean") + margin, 2).alias("ci_upper"),
                    F.round(margin, 2).alias("margin")).orderBy(key)


def anova(m: DataFrame) -> DataFrame:
    """One-way ANOVA from group moments: F, p and the verdict at α = 0.05.

    The grand mean is a running total over the k group rows (an un-partitioned
    window over k aggregated rows, not over the data).
    """
    all_groups = Window.partitionBy()
    big_n = F.sum("n").over(all_groups)
    grand = F.sum(F.col("n") * F.col("mean")).over(all_groups) / big_n
    g = m.select("n", "mean", "var", big_n.alias("_total"), grand.alias("_grand"),
                 F.count(F.lit(1)).over(all_groups).alias("_k"))
    s = g.agg(F.sum(F.col("n") * (F.col("mean") - F.col("_grand")) ** 2).alias("ssb"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
              F.first("_total").alias("_total"), F.first("_k").alias("_k"))
    dfb, dfw = F.col("_k") - 1, F.col("_total") - F.col("_k")
    fstat = F.when((dfb > 0) & (dfw > 0) & (F.col("ssw") > 0),
                   (F.col("ssb") / dfb) / (F.col("ssw") / dfw))
    r = s.where(F.col("_k") >= 2).select(fstat.alias("_f"), dfb.cast("double").alias("_d1"),
                                        dfw.cast("double").alias("_d2"))
    r = r.withColumn("_p", f_p_value(F.col("_f"), F.col("_d1"), F.col("_d2")))
    return r.select(F.round("_f", 4).alias("f_stat"), F.round("_p", 6).alias("p_value"),
                    F.when(F.col("_p") < ALPHA, "SIGNIFICANT").otherwise("NOT SIGNIFICANT").alias("result"))


def cohens_d(m: DataFrame, key: str = "InsuranceProvider") -> DataFrame:
    """Effect size with the unweighted pooled deviation √((v1+v2)/2); 0 when that is 0."""
    p = pairs(m, key)
    pooled = F.sqrt((F.col("v1") + F.col("v2")) / 2)
    d = F.when(pooled > 0, (F.col("m1") - F.col("m2")) / pooled).when(pooled == 0, F.lit(0.0))
    ad = F.abs(F.col("_d"))
    label = (F.when(ad < 0.2, "negligible").when(ad < 0.5, "small").when(ad < 0.8, "medium")
              .when(ad.isNotNull(), "LARGE"))
    return (p.select(F.col("a").alias("provider_a"), F.col("b").alias("provider_b"), d.alias("_d"))
             .select("provider_a", "provider_b", F.round("_d", 4).alias("cohens_d"), label.alias("effect")))
