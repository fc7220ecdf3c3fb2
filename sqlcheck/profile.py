"""Oracle SQL for the profile sections (over the permissive load)."""

from .common import AGE_GROUP, avg1_int, avg2, pct1, with_claims
from .validation import RAW, TYPED, VALIDATED_TYPES

STG = """
stg AS (
  SELECT Name, Age, Gender, BloodType, MedicalCondition, DateOfAdmission, Doctor, Hospital,
         InsuranceProvider, BillingAmount_d AS BillingAmount, RoomNumber, AdmissionType, DischargeDate,
         Medication, TestResults
  FROM val WHERE len(errs) = 0
)"""

COLS = ["Name", "Age", "Gender", "BloodType", "MedicalCondition", "DateOfAdmission", "Doctor",
        "Hospital", "InsuranceProvider", "BillingAmount", "RoomNumber", "AdmissionType",
        "DischargeDate", "Medication", "TestResults"]
TEXT = ["Name", "Gender", "BloodType", "MedicalCondition", "Doctor", "Hospital", "InsuranceProvider",
        "AdmissionType", "Medication", "TestResults"]


def w(*ctes):
    return with_claims(RAW, TYPED, VALIDATED_TYPES, STG, *ctes, view=False)


ORACLE = {}
ORACLE["q_profile_overview"] = w() + f"""
SELECT COUNT(*) AS total_records, MIN(Age) AS min_age, MAX(Age) AS max_age,
       {avg1_int('Age')} AS avg_age,
       CAST(MIN(BillingAmount) AS DOUBLE) AS min_bill, CAST(MAX(BillingAmount) AS DOUBLE) AS max_bill,
       {avg2()} AS avg_bill, MIN(DateOfAdmission) AS earliest, MAX(DateOfAdmission) AS latest
FROM stg"""

_parts = []
for i, c in enumerate(COLS):
    e = f"COUNT(*) FILTER (WHERE trim({c}) = '')" if c in TEXT else "CAST(0 AS BIGINT)"
    _parts.append(f"SELECT {i + 1} AS position, '{c}' AS \"column\", "
                  f"COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, {e} AS empties, COUNT(*) AS total FROM stg")
ORACLE["q_profile_completeness"] = w("c AS (" + " UNION ALL ".join(_parts) + ")") + f"""
SELECT position, "column", nulls, empties,
       CASE WHEN total > 0 THEN {pct1('(total - nulls - empties)', 'total')} ELSE 0.0 END AS pct_complete
FROM c"""

_parts = [f"SELECT {i + 1} AS position, '{c}' AS \"column\", COUNT(DISTINCT {c}) AS d FROM stg"
          for i, c in enumerate(COLS)]
ORACLE["q_profile_cardinality"] = w("c AS (" + " UNION ALL ".join(_parts) + "), tot AS (SELECT COUNT(*) AS n FROM stg)") + """
SELECT position, "column", d AS distinct_values,
       CASE WHEN (CASE WHEN n > 0 THEN d / n ELSE 0.0 END) > 0.9 THEN 'High (likely unique)'
            WHEN (CASE WHEN n > 0 THEN d / n ELSE 0.0 END) > 0.1 THEN 'Medium'
            WHEN d <= 10 THEN 'Low (categorical)' ELSE 'Low-Medium' END AS cardinality
FROM c, tot"""

_parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM stg GROUP BY {c}"
          for c in ["Gender", "BloodType", "MedicalCondition", "AdmissionType", "InsuranceProvider",
                    "TestResults"]]
ORACLE["q_profile_categories"] = w("c AS (" + " UNION ALL ".join(_parts) + ")") + f"""
SELECT "column", value, n, {pct1('n', 'SUM(n) OVER (PARTITION BY "column")')} AS pct FROM c"""

ORACLE["q_profile_billing"] = w() + f"""
SELECT {avg2()} AS mean, round(stddev_pop(CAST(BillingAmount AS DOUBLE)), 2) AS stddev,
       CAST(MIN(BillingAmount) AS DOUBLE) AS min_val, CAST(MAX(BillingAmount) AS DOUBLE) AS max_val
FROM stg"""

ORACLE["q_profile_percentiles"] = w("""
o AS (SELECT BillingAmount, ROW_NUMBER() OVER (ORDER BY BillingAmount NULLS FIRST) - 1 AS rn FROM stg),
tot AS (SELECT COUNT(*) AS n FROM stg),
k AS (SELECT 'p25' AS percentile, n // 4 AS k FROM tot UNION ALL SELECT 'p50', n // 2 FROM tot
      UNION ALL SELECT 'p75', (n * 3) // 4 FROM tot
      UNION ALL SELECT 'p90', CAST(trunc(n * CAST(0.9 AS DOUBLE)) AS BIGINT) FROM tot
      UNION ALL SELECT 'p99', CAST(trunc(n * CAST(0.99 AS DOUBLE)) AS BIGINT) FROM tot)""") + """
SELECT k.percentile, k.k AS "offset", CAST(o.BillingAmount AS DOUBLE) AS value
FROM k JOIN o ON o.rn = k.k"""

ORACLE["q_profile_outliers"] = w(f"""
m AS (SELECT {avg2()} AS mean, round(stddev_pop(CAST(BillingAmount AS DOUBLE)), 2) AS sd FROM stg)""") + """
SELECT ANY_VALUE(mean) AS mean, ANY_VALUE(sd) AS stddev,
       round(ANY_VALUE(mean + 2 * sd), 2) AS threshold_2sd,
       COUNT(*) FILTER (WHERE CAST(BillingAmount AS DOUBLE) > mean + 2 * sd) AS outliers_2sd,
       round(ANY_VALUE(mean + 3 * sd), 2) AS threshold_3sd,
       COUNT(*) FILTER (WHERE CAST(BillingAmount AS DOUBLE) > mean + 3 * sd) AS outliers_3sd
FROM stg, m"""

ORACLE["q_profile_age_groups"] = w() + f"""
SELECT {AGE_GROUP.format(a='Age')} AS AgeGroup, COUNT(*) AS n, {avg2()} AS avg_billing
FROM stg GROUP BY 1"""

_LOS = "CAST(datediff('day', DateOfAdmission, DischargeDate) AS INTEGER)"
ORACLE["q_profile_los"] = w() + f"""
SELECT {avg1_int(_LOS)} AS avg_stay, MIN({_LOS}) AS min_stay, MAX({_LOS}) AS max_stay,
       COUNT(*) FILTER (WHERE {_LOS} = 0) AS same_day, COUNT(*) FILTER (WHERE {_LOS} > 30) AS over_30_days
FROM stg WHERE DischargeDate IS NOT NULL AND DateOfAdmission IS NOT NULL"""

_CHECKS = [
    ("No NULLs in key fields", "Name IS NULL OR Age IS NULL OR BillingAmount IS NULL "
     "OR InsuranceProvider IS NULL OR MedicalCondition IS NULL"),
    ("All billing amounts >= 0", "BillingAmount < 0"),
    ("Discharge date >= admission date", "DischargeDate < DateOfAdmission"),
    ("Age in range 0-150", "Age < 0 OR Age > 150"),
    ("All categorical values valid", "Gender NOT IN ('Male', 'Female') OR BloodType NOT IN "
     "('A+','A-','B+','B-','AB+','AB-','O+','O-') OR AdmissionType NOT IN ('Elective', 'Emergency', 'Urgent')"),
]
CHECKS = "checks AS (" + " UNION ALL ".join(
    f"SELECT {i + 1} AS check_id, '{n}' AS check_name, COUNT(*) FILTER (WHERE {c}) AS violations FROM stg"
    for i, (n, c) in enumerate(_CHECKS)) + ")"
ORACLE["q_quality_checks"] = w(CHECKS) + """
SELECT check_id, check_name, violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM checks"""
ORACLE["q_quality_score"] = w(CHECKS) + """
SELECT COUNT(*) FILTER (WHERE violations = 0) AS checks_passed, COUNT(*) AS checks_total,
       CAST(round(COUNT(*) FILTER (WHERE violations = 0) * 100.0 / COUNT(*), 0) AS BIGINT) AS score_pct
FROM checks"""

ORACLE["q_profile_cardinality_stored"] = f"""
SELECT position, "column", "column" IN ('Age','Gender','BloodType','MedicalCondition','AdmissionType','InsuranceProvider','TestResults') AS exact,
       CASE WHEN exact THEN distinct_values END AS distinct_values, cardinality
FROM ({ORACLE["q_profile_cardinality"]})"""


def _lines(section, item, names, query):
    """One line a metric of a one-row query."""
    listed = ", ".join(f"'{n}'" for n in names)
    numbers = ", ".join("CAST(NULL AS DOUBLE)" if n in ("earliest", "latest") else f"CAST({n} AS DOUBLE)" for n in names)
    days = ", ".join(n if n in ("earliest", "latest") else "CAST(NULL AS DATE)" for n in names)
    return (f"SELECT '{section}' AS section, '{item}' AS item, unnest([{listed}]) AS metric, "
            f"unnest([{numbers}]) AS number, unnest([{days}]) AS day FROM ({ORACLE[query]})")


ORACLE["q_profile_report"] = " UNION ALL ".join([
    _lines("overview", "all", ["total_records", "min_age", "max_age", "avg_age", "min_bill", "max_bill", "avg_bill",
                               "earliest", "latest"], "q_profile_overview"),
    f"""SELECT 'completeness', "column", unnest(['nulls', 'empties']), unnest([CAST(nulls AS DOUBLE), CAST(empties AS DOUBLE)]),
        CAST(NULL AS DATE) FROM ({ORACLE["q_profile_completeness"]})""",
    _lines("billing", "BillingAmount", ["mean", "stddev", "min_val", "max_val"], "q_profile_billing"),
    _lines("stay", "all", ["avg_stay", "min_stay", "max_stay", "same_day", "over_30_days"], "q_profile_los"),
    f"""SELECT 'quality', check_name, 'violations', CAST(violations AS DOUBLE), CAST(NULL AS DATE)
        FROM ({ORACLE["q_quality_checks"]})"""])
