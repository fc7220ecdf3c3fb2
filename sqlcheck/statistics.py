"""Oracle SQL for the statistics: moments, Welch (p by Simpson's rule over the t
density), Cohen's d and ANOVA (p by Simpson's rule over the F density)."""

from .common import avg8, with_claims

N_STEPS = 20000  # even


def moments(key):
    return f"""
mo AS (
  SELECT {key} AS g, COUNT(BillingAmount) AS n,
         CAST({avg8('BillingAmount')} AS DOUBLE) / 100000000 AS mean,
         var_samp(CAST(BillingAmount AS DOUBLE)) AS var,
         {avg8('BillingAmount')} AS mean8
  FROM claims WHERE BillingAmount IS NOT NULL {{where}} GROUP BY {key}
)"""


def _simpson(upper: str, log_density: str, tag: str, at_zero: str | None = None) -> str:
    """Integral of exp(log_density(x)) over [0, upper] per row of `{tag}_in`."""
    return f"""
{tag}_grid AS (
  SELECT i.id, i.upper, r.range AS k, i.upper * r.range / {N_STEPS} AS x, i.*
  FROM {tag}_in i, range(0, {N_STEPS} + 1) r
),
{tag}_int AS (
  SELECT id, ANY_VALUE(upper) / {N_STEPS} / 3 * SUM(
           CASE WHEN k = 0 OR k = {N_STEPS} THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
           * CASE WHEN x = 0 THEN {at_zero or f"exp({log_density})"} ELSE exp({log_density}) END) AS area
  FROM {tag}_grid GROUP BY id
)"""


WELCH = """
pr AS (
  SELECT a.g AS provider_a, b.g AS provider_b, a.n AS n1, b.n AS n2, a.mean AS m1, b.mean AS m2,
         a.var AS v1, b.var AS v2
  FROM mo a JOIN mo b ON a.g < b.g
),
wt AS (
  SELECT *, v1 / n1 + v2 / n2 AS se2 FROM pr
),
w AS (
  SELECT *, CASE WHEN se2 > 0 THEN (m1 - m2) / sqrt(se2) END AS t,
         CASE WHEN se2 > 0 THEN se2 * se2 / ((v1 / n1) * (v1 / n1) / (n1 - 1) + (v2 / n2) * (v2 / n2) / (n2 - 1)) END AS dof
  FROM wt
),
t_in AS (SELECT provider_a || '|' || provider_b AS id, abs(t) AS upper, dof FROM w WHERE t IS NOT NULL),""" + _simpson(
    "upper",
    "lgamma((dof + 1) / 2) - lgamma(dof / 2) - 0.5 * ln(dof * pi()) - (dof + 1) / 2 * ln(1 + x * x / dof)",
    "t") + """,
welch AS (
  SELECT w.provider_a, w.provider_b, round(m1 - m2, 2) AS mean_diff, round(t, 4) AS t_stat,
         round(dof, 2) AS df, round(greatest(0.0, 1 - 2 * ti.area), 6) AS p_value,
         CASE WHEN 1 - 2 * ti.area < 0.05 THEN 'SIGNIFICANT' ELSE 'not sig.' END AS result
  FROM w LEFT JOIN t_int ti ON ti.id = w.provider_a || '|' || w.provider_b
)"""

ANOVA = """
ag AS (
  SELECT SUM(n) AS big_n, COUNT(*) AS k, SUM(n * mean) / SUM(n) AS gm FROM mo
),
an AS (
  SELECT SUM(mo.n * (mo.mean - ag.gm) * (mo.mean - ag.gm)) AS ssb,
         SUM((mo.n - 1) * COALESCE(mo.var, 0)) AS ssw, ANY_VALUE(ag.big_n) AS big_n, ANY_VALUE(ag.k) AS k
  FROM mo, ag
),
fs AS (
  SELECT (ssb / (k - 1)) / (ssw / (big_n - k)) AS f, CAST(k - 1 AS DOUBLE) AS d1,
         CAST(big_n - k AS DOUBLE) AS d2 FROM an WHERE k >= 2
),
f_in AS (SELECT 'x' AS id, f AS upper, d1, d2 FROM fs),""" + _simpson(
    "upper",
    "(d1 / 2) * ln(d1 / d2) + (d1 / 2 - 1) * ln(x) - ((d1 + d2) / 2) * ln(1 + d1 * x / d2)"
    " - (lgamma(d1 / 2) + lgamma(d2 / 2) - lgamma((d1 + d2) / 2))",
    "f", at_zero="CASE WHEN d1 > 2 THEN 0.0 WHEN d1 = 2 THEN 1.0 END")

ORACLE = {}
_P = moments("InsuranceProvider").replace("{where}", "")
_C = moments("MedicalCondition").replace("{where}", "")
_PD = moments("InsuranceProvider").replace("{where}", "AND MedicalCondition = 'Diabetes'")

ORACLE["q_group_moments"] = with_claims(_P, view=False) + """
SELECT g AS InsuranceProvider, n, CAST(SIGN(mean8) * ((2 * ABS(mean8) + 10000) // 20000) AS DOUBLE) / 10000 AS mean,
       round(COALESCE(sqrt(var), 0.0), 4) AS stddev
FROM mo"""
ORACLE["q_welch"] = with_claims(_P, WELCH, view=False) + "SELECT * FROM welch"
ORACLE["q_welch_condition_filtered"] = with_claims(_PD, WELCH, view=False) + "SELECT * FROM welch"
ORACLE["q_welch_summary"] = with_claims(_P, WELCH, view=False) + """
SELECT COUNT(*) FILTER (WHERE result = 'SIGNIFICANT') AS significant_pairs, COUNT(*) AS total_pairs FROM welch"""
ORACLE["q_cohens_d"] = with_claims(_P, view=False) + """
SELECT a.g AS provider_a, b.g AS provider_b,
       round(CASE WHEN sqrt((a.var + b.var) / 2) > 0 THEN (a.mean - b.mean) / sqrt((a.var + b.var) / 2)
                  WHEN sqrt((a.var + b.var) / 2) = 0 THEN 0.0 END, 4) AS cohens_d,
       CASE WHEN abs((a.mean - b.mean) / sqrt((a.var + b.var) / 2)) < 0.2 THEN 'negligible'
            WHEN abs((a.mean - b.mean) / sqrt((a.var + b.var) / 2)) < 0.5 THEN 'small'
            WHEN abs((a.mean - b.mean) / sqrt((a.var + b.var) / 2)) < 0.8 THEN 'medium'
            ELSE 'LARGE' END AS effect
FROM mo a JOIN mo b ON a.g < b.g"""
_ANOVA_OUT = """
SELECT round(fs.f, 4) AS f_stat, round(greatest(0.0, 1 - fi.area), 6) AS p_value,
       CASE WHEN 1 - fi.area < 0.05 THEN 'SIGNIFICANT' ELSE 'NOT SIGNIFICANT' END AS result
FROM fs, f_int fi"""
ORACLE["q_anova_provider"] = with_claims(_P, ANOVA, view=False) + _ANOVA_OUT
ORACLE["q_anova_condition"] = with_claims(_C, ANOVA, view=False) + _ANOVA_OUT


# 95 % CI: t(0.975, n-1) by the Cornish-Fisher expansion of the t quantile around the normal
# quantile z (terms to 1/df^4; error far below the 2-decimal rounding for df in the hundreds).
Z975 = "CAST(1.959963984540054 AS DOUBLE)"


def _t975(df: str) -> str:
    z = Z975
    return (f"({z} + ({z}^3 + {z}) / 4 / {df} + (5*{z}^5 + 16*{z}^3 + 3*{z}) / 96 / ({df})^2"
            f" + (3*{z}^7 + 19*{z}^5 + 17*{z}^3 - 15*{z}) / 384 / ({df})^3"
            f" + (79*{z}^9 + 776*{z}^7 + 1482*{z}^5 - 1920*{z}^3 - 945*{z}) / 92160 / ({df})^4)")


def _ci(key: str) -> str:
    m = f"({_t975('(n - 1)')} * sqrt(var / n))"
    return f"""
SELECT g AS {key}, n, round(mean, 2) AS mean, round(mean - {m}, 2) AS ci_lower,
       round(mean + {m}, 2) AS ci_upper, round({m}, 2) AS margin
FROM mo"""


ORACLE["q_confidence_intervals"] = with_claims(_P, view=False) + _ci("InsuranceProvider")
ORACLE["q_condition_ci"] = with_claims(_C, view=False) + _ci("MedicalCondition")

# The same answers from merged states.
for _q in ("q_group_moments", "q_welch", "q_anova_condition"):
    ORACLE[f"{_q}_stored"] = ORACLE[_q]
ORACLE["q_welch_condition_stored"] = ORACLE["q_welch_condition_filtered"]
