"""Oracle SQL for the exploratory summaries and dashboard calculations."""

from .common import _half_up, avg2, avg8, cpd_avg2, with_claims

ORACLE = {}


def dec_round(expr: str, scale: int, digits: int = 6) -> str:
    """Half-up rounding of a decimal with at most ``digits`` decimals, as double."""
    s = f"CAST(({expr}) * {10 ** digits} AS HUGEINT)"
    return f"(CAST({_half_up(s, str(10 ** (digits - scale)))} AS DOUBLE) / {10 ** scale})"


def interp(src: str, g: str, x: str, ps, tag: str) -> str:
    """CTE ``{tag}`` with g, n and one exact interpolated quantile column per (name, p)."""
    cols = []
    for name, p in ps:
        h = f"((n - 1) * {p})"
        cols.append(f"MAX(CASE WHEN rn = FLOOR({h}) + 1 THEN {x} END) AS {name}_lo")
        cols.append(f"MAX(CASE WHEN rn = LEAST(FLOOR({h}) + 2, n) THEN {x} END) AS {name}_hi")
        cols.append(f"ANY_VALUE({h} - FLOOR({h})) AS {name}_f")
    outs = ", ".join(f"{n}_lo + {n}_f * ({n}_hi - {n}_lo) AS {n}" for n, _ in ps)
    return f"""
{tag}_r AS (
  SELECT {g} AS g, {x}, ROW_NUMBER() OVER (PARTITION BY {g} ORDER BY {x}) AS rn,
         COUNT(*) OVER (PARTITION BY {g}) AS n
  FROM {src} WHERE {x} IS NOT NULL
),
{tag}_w AS (SELECT g, ANY_VALUE(n) AS n, {", ".join(cols)} FROM {tag}_r GROUP BY g),
{tag} AS (SELECT g, n, {outs} FROM {tag}_w)"""


ORACLE["q_provider_stats"] = with_claims(interp("claims", "InsuranceProvider", "BillingAmount",
                                                [("median", "0.5")], "med"), view=False) + f"""
SELECT c.InsuranceProvider, {avg2('c.BillingAmount')} AS mean,
       {dec_round('ANY_VALUE(m.median)', 2)} AS median,
       round(stddev_samp(CAST(c.BillingAmount AS DOUBLE)), 2) AS std
FROM claims c LEFT JOIN med m ON m.g = c.InsuranceProvider
GROUP BY c.InsuranceProvider"""

_LONG = """
lng AS (
  SELECT 'Age' AS col, CAST(Age AS DECIMAL(22,4)) AS value FROM v WHERE Age IS NOT NULL
  UNION ALL SELECT 'BillingAmount', CAST(BillingAmount AS DECIMAL(22,4)) FROM v WHERE BillingAmount IS NOT NULL
  UNION ALL SELECT 'LengthOfStay', CAST(LengthOfStay AS DECIMAL(22,4)) FROM v WHERE LengthOfStay IS NOT NULL
)"""
ORACLE["q_describe"] = with_claims(_LONG, interp("lng", "col", "value",
                                                 [("p25", "0.25"), ("p50", "0.50"), ("p75", "0.75")], "qq")) + f"""
SELECT l.col AS "column", COUNT(l.value) AS count, {avg2('l.value')} AS mean,
       round(stddev_samp(CAST(l.value AS DOUBLE)), 2) AS std,
       {dec_round('MIN(l.value)', 2)} AS min,
       {dec_round('ANY_VALUE(q.p25)', 2)} AS p25, {dec_round('ANY_VALUE(q.p50)', 2)} AS p50,
       {dec_round('ANY_VALUE(q.p75)', 2)} AS p75, {dec_round('MAX(l.value)', 2)} AS max
FROM lng l LEFT JOIN qq q ON q.g = l.col GROUP BY l.col"""

_CONDS = ["Diabetes", "Asthma", "Obesity", "Arthritis", "Hypertension", "Cancer"]
ORACLE["q_provider_condition_matrix"] = with_claims() + "SELECT InsuranceProvider, " + ", ".join(
    f"CAST({_half_up(avg8(f'CASE WHEN MedicalCondition = {chr(39)}{c}{chr(39)} THEN BillingAmount END'), '100000000')} AS DOUBLE) AS {c}"
    for c in _CONDS) + " FROM v GROUP BY InsuranceProvider"

ORACLE["q_los_by_condition"] = with_claims() + f"""
SELECT MedicalCondition,
       CAST({_half_up('(CAST(SUM(LengthOfStay) AS HUGEINT) * 10000)', 'COUNT(LengthOfStay)')} AS DOUBLE) / 10000 AS avg_los
FROM v GROUP BY MedicalCondition"""

ORACLE["q_cost_per_day_by_provider"] = with_claims() + f"""
SELECT InsuranceProvider, {cpd_avg2()} AS cost_per_day FROM v GROUP BY InsuranceProvider"""

_FLAG = f"""
st AS (SELECT MedicalCondition, CAST({avg8('BillingAmount')} AS DOUBLE) / 100000000 AS m,
              stddev_samp(CAST(BillingAmount AS DOUBLE)) AS s
       FROM v GROUP BY MedicalCondition),
fl AS (SELECT v.*, COALESCE(v.BillingAmount > st.m + 2 * st.s, false) AS IsOutlier
       FROM v LEFT JOIN st ON v.MedicalCondition = st.MedicalCondition)"""
ORACLE["q_flag_outliers"] = with_claims(_FLAG) + """
SELECT MedicalCondition, InsuranceProvider, DateOfAdmission, CAST(BillingAmount AS DOUBLE) AS BillingAmount,
       IsOutlier FROM fl"""
ORACLE["q_outlier_share"] = with_claims(_FLAG) + f"""
SELECT MedicalCondition, COUNT(BillingAmount) AS total, COUNT(*) FILTER (WHERE IsOutlier) AS outliers,
       printf('%.1f%%', CAST({_half_up('(CAST(COUNT(*) FILTER (WHERE IsOutlier) AS HUGEINT) * 1000)', 'COUNT(BillingAmount)')} AS DOUBLE) / 10) AS outlier_pct,
       {avg2('CASE WHEN IsOutlier THEN BillingAmount END')} AS avg_outlier_bill
FROM fl GROUP BY MedicalCondition"""

_VC = ["MedicalCondition", "InsuranceProvider", "AdmissionType", "Medication", "TestResults", "Gender",
       "BloodType"]
ORACLE["q_value_counts"] = with_claims(view=False) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM claims "
    f"WHERE {c} IS NOT NULL GROUP BY {c}" for c in _VC)

ORACLE["q_age_bins"] = with_claims("""
b AS (SELECT * FROM (VALUES (0, '0-1', 0, 2), (1, '2-5', 2, 6), (2, '6-12', 6, 13), (3, '13-18', 13, 19),
      (4, '19-30', 19, 31), (5, '31-45', 31, 46), (6, '46-60', 46, 61), (7, '61-80', 61, 81),
      (8, '81+', 81, 151)) t(band, AgeGroup, lo, hi))""", view=False) + """
SELECT b.band, b.AgeGroup, COUNT(c.Age) AS n
FROM b LEFT JOIN claims c ON c.Age >= b.lo AND c.Age < b.hi
GROUP BY b.band, b.AgeGroup"""


def _hist(src: str, col: str, bins: int):
    return f"""
mm AS (SELECT MIN(CAST({col} AS DOUBLE)) AS lo, MAX(CAST({col} AS DOUBLE)) AS hi FROM {src}),
mm2 AS (SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM mm),
cnt AS (SELECT CAST(least(floor((CAST({col} AS DOUBLE) - mm2.lo) * ({bins} / (mm2.hi - mm2.lo))), {bins - 1}) AS BIGINT) AS bin,
               COUNT(*) AS n
        FROM {src}, mm2 WHERE {col} IS NOT NULL GROUP BY 1),
grid AS (SELECT range AS bin FROM range(0, {bins}))""", f"""
SELECT grid.bin, mm2.lo + grid.bin * ((mm2.hi - mm2.lo) / {bins}) AS lower,
       mm2.lo + (grid.bin + 1) * ((mm2.hi - mm2.lo) / {bins}) AS upper,
       COALESCE(cnt.n, 0) AS n
FROM grid CROSS JOIN mm2 LEFT JOIN cnt ON cnt.bin = grid.bin"""


_h = _hist("claims", "BillingAmount", 60)
ORACLE["q_histogram"] = with_claims(_h[0], view=False) + _h[1]
_h = _hist("claims", "Age", 40)
ORACLE["q_histogram_age"] = with_claims(_h[0], view=False) + _h[1]
_h = _hist("v", "LengthOfStay", 30)
ORACLE["q_histogram_los"] = with_claims(_h[0]) + _h[1]


def _box(key: str) -> str:
    return with_claims(interp("claims", key, "BillingAmount",
                              [("q1", "0.25"), ("median", "0.50"), ("q3", "0.75")], "qt") + f""",
fen AS (SELECT g, n, q1, median, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM qt),
wh AS (SELECT f.g, MIN(CASE WHEN c.BillingAmount >= f.lo THEN c.BillingAmount END) AS whislo,
              MAX(CASE WHEN c.BillingAmount <= f.hi THEN c.BillingAmount END) AS whishi
       FROM claims c JOIN fen f ON c.{key} = f.g WHERE c.BillingAmount IS NOT NULL GROUP BY f.g),
fli AS (SELECT w.g, COUNT(*) FILTER (WHERE c.BillingAmount < w.whislo OR c.BillingAmount > w.whishi) AS fliers
        FROM claims c JOIN wh w ON c.{key} = w.g WHERE c.BillingAmount IS NOT NULL GROUP BY w.g)""",
                       view=False) + f"""
SELECT f.g AS {key}, f.n, {dec_round('f.q1', 4)} AS q1, {dec_round('f.median', 4)} AS median,
       {dec_round('f.q3', 4)} AS q3, {dec_round('f.iqr', 4)} AS iqr, {dec_round('LEAST(w.whislo, f.q1)', 4)} AS whislo,
       {dec_round('GREATEST(w.whishi, f.q3)', 4)} AS whishi, x.fliers
FROM fen f JOIN wh w ON w.g = f.g JOIN fli x ON x.g = f.g"""


ORACLE["q_boxplot"] = _box("MedicalCondition")
ORACLE["q_boxplot_insurer"] = _box("InsuranceProvider")

_SUMMARY = f"""
bs AS (SELECT AgeGroup, MedicalCondition, {avg2()} AS avg_billing FROM v GROUP BY AgeGroup, MedicalCondition)"""
ORACLE["q_condition_mean_of_means"] = with_claims(_SUMMARY) + """
SELECT MedicalCondition,
       CAST((2 * SUM(CAST(round(avg_billing * 100) AS BIGINT)) + 100 * COUNT(*)) // (200 * COUNT(*)) AS BIGINT) AS mean_of_means
FROM bs GROUP BY MedicalCondition"""

_COMPARE = f"""
pc AS (SELECT InsuranceProvider, AgeGroup, {avg2()} AS avg_billing FROM v
       WHERE MedicalCondition = 'Diabetes' GROUP BY InsuranceProvider, AgeGroup),
best AS (SELECT InsuranceProvider AS insurer, MIN(avg_billing) AS best_avg FROM pc GROUP BY InsuranceProvider),
bw AS (SELECT *, MIN(best_avg) OVER () AS lo, MAX(best_avg) OVER () AS hi,
              ROW_NUMBER() OVER (ORDER BY best_avg, insurer) AS position, COUNT(*) OVER () AS k FROM best)"""
ORACLE["q_provider_best"] = with_claims(_COMPARE) + """
SELECT insurer, best_avg, CAST(position AS BIGINT) AS position,
       CASE WHEN position = 1 THEN 'Cheapest' WHEN position = k THEN 'Most Exp.' END AS badge,
       CAST(floor((best_avg - lo) / (CASE WHEN hi - lo <> 0 THEN hi - lo ELSE 1.0 END) * 100 + 0.5) AS BIGINT) AS relative_pct,
       100 - CAST(floor((best_avg - lo) / (CASE WHEN hi - lo <> 0 THEN hi - lo ELSE 1.0 END) * 100 + 0.5) AS BIGINT) AS bar_pct
FROM bw"""

ORACLE["q_enriched"] = with_claims() + """
SELECT Age, Gender, BloodType, MedicalCondition, DateOfAdmission, Hospital, InsuranceProvider,
       CAST(BillingAmount AS DOUBLE) AS BillingAmount, RoomNumber, AdmissionType, DischargeDate, Medication,
       TestResults, LengthOfStay, AgeGroup
FROM v"""
ORACLE["q_age_group"] = with_claims() + """
SELECT AgeGroup, COUNT(*) AS n, MIN(Age) AS min_age, MAX(Age) AS max_age FROM v GROUP BY AgeGroup"""
