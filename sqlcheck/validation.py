"""Oracle SQL for the validator family (claims_raw faults, messages, summaries)."""

from .common import with_claims

RAW = """
raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS claim_id,
    CASE WHEN l_partkey % 3 = 0 THEN '  ' || Name || '  ' ELSE Name END AS "Name",
    CASE WHEN l_orderkey % 97 = 0 THEN '-1' WHEN l_orderkey % 97 = 1 THEN '151'
         WHEN l_orderkey % 97 = 2 THEN 'abc' ELSE CAST(Age AS VARCHAR) END AS "Age",
    CASE WHEN l_partkey % 89 = 0 THEN 'Other' ELSE Gender END AS "Gender",
    CASE WHEN l_suppkey % 83 = 0 THEN 'X+' ELSE BloodType END AS "Blood Type",
    MedicalCondition AS "Medical Condition",
    CASE WHEN l_orderkey % 73 = 0 THEN '01/15/2023' ELSE CAST(DateOfAdmission AS VARCHAR) END
      AS "Date of Admission",
    Doctor AS "Doctor", Hospital AS "Hospital", InsuranceProvider AS "Insurance Provider",
    CASE WHEN l_partkey % 79 = 0 THEN 'free' WHEN l_partkey % 79 = 1 THEN '-100'
         ELSE CAST(BillingAmount AS VARCHAR) END AS "Billing Amount",
    CAST(RoomNumber AS VARCHAR) AS "Room Number", AdmissionType AS "Admission Type",
    CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS "Discharge Date",
    Medication AS "Medication", TestResults AS "Test Results"
  FROM claims
)"""


def _strip(c):
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def _date(c):
    return (f"CASE WHEN regexp_matches({c}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}$') "
            f"THEN CAST(TRY_STRPTIME({c}, '%Y-%m-%d') AS DATE) END")


TYPED = f"""
t AS (
  SELECT raw.*,
    {_strip('"Name"')} AS t_Name,
    TRY_CAST("Age" AS INTEGER) AS t_Age,
    {_strip('"Gender"')} AS t_Gender,
    {_strip('"Blood Type"')} AS t_BloodType,
    {_strip('"Medical Condition"')} AS t_MedicalCondition,
    {_date('"Date of Admission"')} AS t_DateOfAdmission,
    {_strip('"Doctor"')} AS t_Doctor,
    {_strip('"Hospital"')} AS t_Hospital,
    {_strip('"Insurance Provider"')} AS t_InsuranceProvider,
    TRY_CAST("Billing Amount" AS DECIMAL(18,4)) AS t_BillingAmount,
    TRY_CAST("Room Number" AS INTEGER) AS t_RoomNumber,
    {_strip('"Admission Type"')} AS t_AdmissionType,
    {_date('"Discharge Date"')} AS t_DischargeDate,
    {_strip('"Medication"')} AS t_Medication,
    {_strip('"Test Results"')} AS t_TestResults
  FROM raw
)"""


def _q(c):
    return f"'''' || COALESCE({c}, 'None') || ''''"


def _dom(col, values, label):
    vs = ", ".join(f"'{v}'" for v in values)
    return f"CASE WHEN t_{col} IS NULL OR t_{col} NOT IN ({vs}) THEN PRE || 'Invalid {label} ' || {_q('t_' + col)} END"


FULL_MSGS = [
    f"""CASE WHEN t_Age IS NULL THEN PRE || 'Invalid age ' || {_q('"Age"')} END""",
    """CASE WHEN t_Age IS NOT NULL AND (t_Age < 0 OR t_Age > 150)
         THEN PRE || 'Age ' || CAST(t_Age AS VARCHAR) || ' out of range 0-150' END""",
    _dom("Gender", ["Male", "Female"], "gender"),
    _dom("BloodType", ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"], "blood type"),
    _dom("MedicalCondition", ["Diabetes", "Asthma", "Obesity", "Arthritis", "Hypertension", "Cancer"],
         "medical condition"),
    _dom("AdmissionType", ["Elective", "Emergency", "Urgent"], "admission type"),
    _dom("TestResults", ["Normal", "Abnormal", "Inconclusive"], "test results"),
    f"""CASE WHEN t_BillingAmount IS NULL THEN PRE || 'Invalid billing amount ' || {_q('"Billing Amount"')} END""",
    """CASE WHEN t_BillingAmount < 0
         THEN PRE || 'Negative billing amount ' || CAST(CAST(t_BillingAmount AS DOUBLE) AS VARCHAR) END""",
    f"""CASE WHEN t_DateOfAdmission IS NULL THEN PRE || 'Invalid admission date ' || {_q('"Date of Admission"')} END""",
    f"""CASE WHEN t_DischargeDate IS NULL THEN PRE || 'Invalid discharge date ' || {_q('"Discharge Date"')} END""",
    """CASE WHEN t_DischargeDate < t_DateOfAdmission THEN PRE || 'Discharge date before admission date' END""",
    f"""CASE WHEN t_RoomNumber IS NULL THEN PRE || 'Invalid room number ' || {_q('"Room Number"')} END""",
]

TYPES_MSG = f"""CASE WHEN t_Age IS NULL THEN PRE || 'invalid literal for int() with base 10: ' || {_q('"Age"')}
  WHEN t_BillingAmount IS NULL THEN PRE || 'could not convert string to float: ' || {_q('"Billing Amount"')}
  WHEN t_RoomNumber IS NULL THEN PRE || 'invalid literal for int() with base 10: ' || {_q('"Room Number"')} END"""


def _validated(msgs, name="val"):
    ms = [m.replace("PRE", "('Line ' || claim_id || ': ')") for m in msgs]
    cols = ",\n    ".join(f"{m} AS m{i}" for i, m in enumerate(ms))
    return f"""
{name}_m AS (
  SELECT t.*, {cols}
  FROM t
),
{name} AS (
  SELECT claim_id, t_Name AS Name, t_Age AS Age, t_Gender AS Gender, t_BloodType AS BloodType,
    t_MedicalCondition AS MedicalCondition, t_DateOfAdmission AS DateOfAdmission, t_Doctor AS Doctor,
    t_Hospital AS Hospital, t_InsuranceProvider AS InsuranceProvider, t_BillingAmount AS BillingAmount_d,
    t_RoomNumber AS RoomNumber, t_AdmissionType AS AdmissionType, t_DischargeDate AS DischargeDate,
    t_Medication AS Medication, t_TestResults AS TestResults,
    list_filter([{", ".join(f"m{i}" for i in range(len(ms)))}], lambda x: x IS NOT NULL) AS errs
  FROM {name}_m
)"""


VALIDATED_FULL = _validated(FULL_MSGS)
VALIDATED_TYPES = _validated([TYPES_MSG])

OUT_COLS = """claim_id, Name, Age, Gender, BloodType, MedicalCondition, DateOfAdmission, Doctor, Hospital,
  InsuranceProvider, RoomNumber, AdmissionType, DischargeDate, Medication, TestResults,
  CAST(BillingAmount_d AS DOUBLE) AS BillingAmount,
  array_to_string(errs, '; ') AS errors, CAST(len(errs) AS BIGINT) AS error_count"""

ORACLE = {}
ORACLE["q_validate"] = with_claims(RAW, TYPED, VALIDATED_FULL, view=False) + f"SELECT {OUT_COLS} FROM val"
ORACLE["q_validate_permissive"] = (with_claims(RAW, TYPED, VALIDATED_TYPES, view=False)
                                   + f"SELECT {OUT_COLS} FROM val")
ORACLE["q_rejects"] = with_claims(RAW, TYPED, VALIDATED_FULL, view=False) + """
SELECT claim_id, array_to_string(errs, '; ') AS errors, CAST(len(errs) AS BIGINT) AS error_count
FROM val WHERE len(errs) > 0"""
_SUMMARY = """
SELECT COUNT(*) AS rows_read, COUNT(*) FILTER (WHERE len(errs) = 0) AS valid,
       COUNT(*) FILTER (WHERE len(errs) > 0) AS rejected,
       CAST(COALESCE(SUM(len(errs)), 0) AS BIGINT) AS error_count
FROM val"""
ORACLE["q_reject_summary"] = with_claims(RAW, TYPED, VALIDATED_FULL, view=False) + _SUMMARY
ORACLE["q_csv_reject_summary"] = ORACLE["q_reject_summary"]
ORACLE["q_first_errors"] = with_claims(RAW, TYPED, VALIDATED_FULL, view=False) + """
SELECT claim_id, CAST(pos AS BIGINT) AS pos, message FROM (
  SELECT claim_id, generate_subscripts(errs, 1) - 1 AS pos, unnest(errs) AS message FROM val)
ORDER BY claim_id, pos, message LIMIT 10"""

_AUDIT_RULES = [
    ("patient_name_not_null", "Name IS NULL"),
    ("patient_age_range", "NOT (Age BETWEEN 0 AND 150)"),
    ("patient_gender_domain", "NOT (Gender IN ('Male', 'Female'))"),
    ("patient_blood_type_domain", "NOT (BloodType IN ('A+','A-','B+','B-','AB+','AB-','O+','O-'))"),
    ("doctor_name_not_null", "Doctor IS NULL"),
    ("hospital_name_not_null", "Hospital IS NULL"),
    ("insurer_name_not_null", "InsuranceProvider IS NULL"),
    ("medication_name_not_null", "Medication IS NULL"),
    ("admission_type_domain", "NOT (AdmissionType IN ('Elective', 'Emergency', 'Urgent'))"),
    ("billing_non_negative", "NOT (BillingAmount_d >= 0)"),
    ("condition_domain",
     "NOT (MedicalCondition IN ('Diabetes','Asthma','Obesity','Arthritis','Hypertension','Cancer'))"),
    ("test_results_domain", "NOT (TestResults IN ('Normal', 'Abnormal', 'Inconclusive'))"),
    ("discharge_after_admission", "NOT (DischargeDate IS NULL OR DischargeDate >= DateOfAdmission)"),
]
ORACLE["q_constraint_audit"] = with_claims(RAW, TYPED, VALIDATED_TYPES, view=False) + " UNION ALL ".join(
    f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {c}) AS violations FROM val WHERE len(errs) = 0"
    for n, c in _AUDIT_RULES)
