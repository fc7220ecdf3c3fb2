"""States of a load: small tables from which reports are made without reading the claims again.

A load stores, beside its claims, the moments of each group (n, mean, sum of squared deviations),
a distinct-count sketch of each column, the value counts of the columns with few values, and the
profile observed while staging was written.  States of several loads are merged, so a report over
many loads reads a few rows a load:

* moments merge pairwise by the usual rule (Chan et al.); deviations are taken from a mean of the
  same group, so no digits are lost to a large common offset;
* sketches are HyperLogLog (Apache DataSketches); merging sketches gives the sketch of all rows.
  With ``LG_K`` = 14 the standard error is 1.04 / sqrt(2^14) = 0.8 %, whatever the number of rows;
* columns whose domain is small (``FEW``) are counted exactly: (column, value, n) rows are combined
  on the map side, so only as many as there are values are shuffled;
* the profile is a set of ``observe`` metrics.  The observed rows must go to the write without an
  exchange in between: Spark counts a task of the last stage once, however often it ran.

Nulls are a group of their own in keys and aren't values; a group without values has no state; an
empty table gives sketches of nothing and no other states.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import avg_int1, avg_money, length_of_stay
from ..schema import TEXT_COLUMNS, TYPED_COLUMNS
from .profile import CATEGORICALS, quality_rules

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
FEW = [*CATEGORICALS, "Age"]
MOMENT_KEYS = ["InsuranceProvider", "MedicalCondition"]


# -- moments ----------------------------------------------------------------
def moment_states(df: DataFrame, keys: list[str] = MOMENT_KEYS, value: str = "BillingAmount") -> DataFrame:
    """(keys, n, mean, m2) of the values that are there; m2 is the sum of squared deviations."""
    x = F.col(value)
    return (df.where(x.isNotNull()).groupBy(*keys)
              .agg(F.count(x).alias("n"), F.avg(x).cast("double").alias("mean"),
                   (F.var_pop(x.cast("double")) * F.count(x)).alias("m2")))


def merge_moments(states: DataFrame, keys: list[str]) -> DataFrame:
    """One state a group from any number of them, (keys, n, mean, m2)."""
    at = states.groupBy(*keys).agg(F.min("mean").alias("_at"))
    same = None
    for k in keys:
        here = F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}"))
        same = here if same is None else same & here
    off = F.col("mean") - F.col("_at")
    both = states.alias("s").join(at.alias("r"), same).select(
        *[F.col(f"s.{k}").alias(k) for k in keys], "n", "m2", "_at", off.alias("_off"))
    n, first, second = F.sum("n"), F.sum(F.col("n") * F.col("_off")), F.sum(F.col("n") * F.col("_off") * F.col("_off"))
    return both.groupBy(*keys).agg(n.alias("n"), (F.min("_at") + first / n).alias("mean"),
                                   (F.sum("m2") + F.greatest(second - first * first / n, F.lit(0.0))).alias("m2"))


def moments_from(states: DataFrame, key: str = "InsuranceProvider", where: dict | None = None) -> DataFrame:
    """What ``statistics.group_moments`` gives, from states keyed by ``key`` and maybe more.

    ``where`` filters on keys of the states, as it would on the claims."""
    for col, v in (where or {}).items():
        if v:
            states = states.filter(F.col(col) == F.lit(v))
    n = F.col("n")
    return merge_moments(states, [key]).select(key, "n", "mean", F.when(n > 1, F.col("m2") / (n - 1)).alias("var"))


# -- distinct counts ----------------------------------------------------------
def _hashable(df: DataFrame, col: str) -> Column:
    """The column as a type that sketches take, equal values staying equal and others apart."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.DecimalType):
        return F.col(col).cast("string")
    return F.col(col)


def sketch_states(df: DataFrame, cols: list[str] = TYPED_COLUMNS, lg_k: int = LG_K) -> DataFrame:
    """(column, rows, sketch): one aggregate of one sketch a column, no rows multiplied."""
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.hll_sketch_agg(_hashable(df, c), lg_k).alias(f"_s{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', _rows, _s{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {parts}) AS (`column`, `rows`, sketch)")


def value_states(df: DataFrame, cols: list[str] = FEW) -> DataFrame:
    """(column, value, n) of columns with few values; the null value has a row too."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    return (df.selectExpr(f"stack({len(cols)}, {pairs}) AS (`column`, value)")
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))


def cardinality_from(sketches: DataFrame, values: DataFrame, cols: list[str] = TYPED_COLUMNS) -> DataFrame:
    """Distinct non-null values of each column over all loads given, and the cardinality class.

    ``exact`` tells columns counted by value from those estimated from sketches."""
    merged = sketches.groupBy("column").agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_about"), F.sum("rows").alias("_rows"))
    # counted once a value, in whichever loads it stands
    counted = (values.groupBy("column", "value").agg(F.sum("n").alias("n"))
                     .groupBy("column").agg(F.count("value").alias("_counted")))
    names = sketches.sparkSession.createDataFrame([(i + 1, c) for i, c in enumerate(cols)], "position int, column string")
    d = F.coalesce("_counted", "_about", F.lit(0)).cast("bigint")
    ratio = F.when(F.col("_rows") > 0, d / F.col("_rows")).otherwise(F.lit(0.0))
    kind = (F.when(ratio > 0.9, "High (likely unique)").when(ratio > 0.1, "Medium")
             .when(d <= 10, "Low (categorical)").otherwise("Low-Medium"))
    return names.join(merged, "column", "left").join(counted, "column", "left").select(
        "position", "column", d.alias("distinct_values"), F.col("_counted").isNotNull().alias("exact"),
        kind.alias("cardinality")).orderBy("position")


def categories_from(values: DataFrame, cols: list[str] = CATEGORICALS) -> DataFrame:
    """(column, value, n) over all loads given."""
    return (values.where(F.col("column").isin(cols)).groupBy("column", "value").agg(F.sum("n").alias("n"))
                  .orderBy("column", F.col("n").desc(), "value"))


# -- the observed profile -------------------------------------------------------
REPORT_SCHEMA = "section string, item string, metric string, number double, day date"


def _metrics() -> list[tuple[str, str, str, Column]]:
    """(section, item, metric, aggregate) of everything one pass over staging can tell."""
    b, los, c = F.col("BillingAmount"), length_of_stay(), F.col
    out = [("overview", "all", name, agg) for name, agg in [
        ("total_records", F.count(F.lit(1))), ("min_age", F.min("Age")), ("max_age", F.max("Age")),
        ("avg_age", avg_int1("Age")), ("min_bill", F.min(b)), ("max_bill", F.max(b)), ("avg_bill", avg_money()),
        ("earliest", F.min("DateOfAdmission")), ("latest", F.max("DateOfAdmission"))]]
    for col in TYPED_COLUMNS:
        empty = F.count_if(F.trim(c(col)) == "") if col in TEXT_COLUMNS else F.count_if(F.lit(False))
        out += [("completeness", col, "nulls", F.count_if(c(col).isNull())), ("completeness", col, "empties", empty)]
    out += [("billing", "BillingAmount", name, agg) for name, agg in [
        ("mean", avg_money()), ("stddev", F.round(F.stddev_pop(b.cast("double")), 2)),
        ("min_val", F.min(b)), ("max_val", F.max(b))]]
    out += [("stay", "all", name, agg) for name, agg in [
        ("avg_stay", avg_int1(los)), ("min_stay", F.min(los)), ("max_stay", F.max(los)),
        ("same_day", F.count_if(los == 0)), ("over_30_days", F.count_if(los > 30))]]
    out += [("quality", name, "violations", F.count_if(cond)) for name, cond in quality_rules()]
    return out


class ObservedProfile:
    """The profile of rows, gathered while they pass to an action.

    ``rows`` are the observed rows; once they have been written, ``report`` is the profile in long
    form, without a scan.  Asked for before, ``report`` waits for the action."""

    def __init__(self, rows: DataFrame):
        self._spark, self._seen = rows.sparkSession, Observation()
        self.rows = rows.observe(self._seen, *[agg.alias(f"m{i}") for i, (*_, agg) in enumerate(_metrics())])

    def report(self) -> DataFrame:
        got, lines = self._seen.get, []
        for i, (section, item, metric, _) in enumerate(_metrics()):
            v = got.get(f"m{i}")
            day = v if isinstance(v, dt.date) else None
            lines.append((section, item, metric, None if v is None or day else float(v), day))
        return report_of(self._spark, lines)


def report_of(spark: SparkSession, lines: list[tuple]) -> DataFrame:
    return spark.createDataFrame(lines, REPORT_SCHEMA)


def quality_score_from(report: DataFrame) -> DataFrame:
    """Checks passed, checks made and the score in percent, from a profile in long form."""
    q = report.where(F.col("section") == "quality")
    passed, total = F.count_if(F.col("number") == 0), F.count(F.lit(1))
    return q.agg(passed.alias("checks_passed"), total.alias("checks_total"),
                 F.round(passed * 100.0 / total, 0).cast("bigint").alias("score_pct"))
