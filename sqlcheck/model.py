"""Oracle SQL for the star schema."""

from .common import with_claims

DIMS = """
d_doctor AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name) AS BIGINT) AS DoctorID, Name
             FROM (SELECT DISTINCT Doctor AS Name FROM claims WHERE Doctor IS NOT NULL)),
d_hospital AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name) AS BIGINT) AS HospitalID, Name
             FROM (SELECT DISTINCT Hospital AS Name FROM claims WHERE Hospital IS NOT NULL)),
d_insurer AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name) AS BIGINT) AS InsuranceID, Name
             FROM (SELECT DISTINCT InsuranceProvider AS Name FROM claims WHERE InsuranceProvider IS NOT NULL)),
d_medication AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name) AS BIGINT) AS MedicationID, Name
             FROM (SELECT DISTINCT Medication AS Name FROM claims WHERE Medication IS NOT NULL)),
d_patient AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name NULLS FIRST, Age NULLS FIRST,
                 Gender NULLS FIRST, BloodType NULLS FIRST) AS BIGINT) AS PatientID, Name, Age, Gender, BloodType
             FROM (SELECT DISTINCT Name, Age, Gender, BloodType FROM claims WHERE Name IS NOT NULL)),
fact0 AS (
  SELECT p.PatientID, d.DoctorID, h.HospitalID, i.InsuranceID, m.MedicationID,
         s.DateOfAdmission, s.RoomNumber, s.AdmissionType, s.DischargeDate, s.BillingAmount,
         s.MedicalCondition, s.TestResults
  FROM claims s
  JOIN d_patient p ON p.Name = s.Name AND p.Age = s.Age AND p.Gender = s.Gender AND p.BloodType = s.BloodType
  JOIN d_doctor d ON d.Name = s.Doctor
  JOIN d_hospital h ON h.Name = s.Hospital
  JOIN d_insurer i ON i.Name = s.InsuranceProvider
  JOIN d_medication m ON m.Name = s.Medication
),
fact AS (
  SELECT CAST(ROW_NUMBER() OVER (ORDER BY PatientID, DoctorID, HospitalID, InsuranceID, MedicationID,
           DateOfAdmission NULLS FIRST, RoomNumber NULLS FIRST, AdmissionType NULLS FIRST,
           DischargeDate NULLS FIRST, BillingAmount NULLS FIRST, MedicalCondition NULLS FIRST,
           TestResults NULLS FIRST) AS BIGINT) AS AdmissionID, *
  FROM fact0
)"""

ORACLE = {}
ORACLE["q_dim_doctor"] = with_claims(DIMS, view=False) + "SELECT DoctorID, Name FROM d_doctor"
ORACLE["q_dim_hospital"] = with_claims(DIMS, view=False) + "SELECT HospitalID, Name FROM d_hospital"
ORACLE["q_dim_insurer"] = with_claims(DIMS, view=False) + "SELECT InsuranceID, Name FROM d_insurer"
ORACLE["q_dim_medication"] = with_claims(DIMS, view=False) + "SELECT MedicationID, Name FROM d_medication"
ORACLE["q_dim_patient"] = with_claims(DIMS, view=False) + \
    "SELECT PatientID, Name, Age, Gender, BloodType FROM d_patient"
ORACLE["q_dim_test"] = with_claims(view=False) + """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY Name NULLS FIRST) AS BIGINT) AS TestID, Name
FROM (SELECT DISTINCT TestResults AS Name FROM claims)"""
ORACLE["q_admission_distinct"] = with_claims(view=False) + """
SELECT DISTINCT DateOfAdmission, RoomNumber, AdmissionType, DischargeDate,
       CAST(BillingAmount AS DOUBLE) AS BillingAmount
FROM claims"""
ORACLE["q_fact"] = with_claims(DIMS, view=False) + """
SELECT AdmissionID, PatientID, DoctorID, HospitalID, InsuranceID, MedicationID, DateOfAdmission,
       RoomNumber, AdmissionType, DischargeDate, CAST(BillingAmount AS DOUBLE) AS BillingAmount,
       MedicalCondition, TestResults
FROM fact"""
ORACLE["q_fk_audit"] = with_claims(DIMS, view=False) + """
SELECT 'PatientID' AS fk, COUNT(*) FILTER (WHERE PatientID NOT IN (SELECT PatientID FROM d_patient)) AS orphans FROM fact
UNION ALL SELECT 'DoctorID', COUNT(*) FILTER (WHERE DoctorID NOT IN (SELECT DoctorID FROM d_doctor)) FROM fact
UNION ALL SELECT 'HospitalID', COUNT(*) FILTER (WHERE HospitalID NOT IN (SELECT HospitalID FROM d_hospital)) FROM fact
UNION ALL SELECT 'InsuranceID', COUNT(*) FILTER (WHERE InsuranceID NOT IN (SELECT InsuranceID FROM d_insurer)) FROM fact
UNION ALL SELECT 'MedicationID', COUNT(*) FILTER (WHERE MedicationID NOT IN (SELECT MedicationID FROM d_medication)) FROM fact"""

_EARLY = "DateOfAdmission < DATE '1995-02-01'"


def _grown(key: str, cols: str) -> str:
    """Members of the early claims first, in order, then the others, in order."""
    order = ", ".join(f"{c} NULLS FIRST" for c in cols.split(", "))
    return f"""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY NOT early, {order}) AS BIGINT) AS {key}, {cols}
FROM (SELECT {cols}, coalesce(bool_or({_EARLY}), false) AS early FROM c WHERE Name IS NOT NULL GROUP BY {cols})"""


ORACLE["q_dim_patient_incremental"] = with_claims("c AS (SELECT * FROM claims)", view=False) + \
    _grown("PatientID", "Name, Age, Gender, BloodType")
ORACLE["q_dim_doctor_incremental"] = with_claims("c AS (SELECT Doctor AS Name, DateOfAdmission FROM claims)", view=False) + \
    _grown("DoctorID", "Name")


def _unseen(fk: str, table: str, src: str) -> str:
    return (f"SELECT '{fk}' AS fk, COUNT(*) FILTER (WHERE {fk} NOT IN (SELECT {fk} FROM {table} "
            f"WHERE Name IN (SELECT {src} FROM claims WHERE {_EARLY}))) AS orphans FROM fact")


ORACLE["q_fk_audit_stale"] = with_claims(DIMS, view=False) + " UNION ALL ".join([
    f"""
SELECT 'PatientID' AS fk, COUNT(*) FILTER (WHERE PatientID NOT IN (
  SELECT PatientID FROM d_patient p JOIN (SELECT DISTINCT Name, Age, Gender, BloodType FROM claims WHERE {_EARLY}) e
  ON p.Name = e.Name AND p.Age = e.Age AND p.Gender = e.Gender AND p.BloodType = e.BloodType)) AS orphans FROM fact""",
    _unseen("DoctorID", "d_doctor", "Doctor"), _unseen("HospitalID", "d_hospital", "Hospital"),
    _unseen("InsuranceID", "d_insurer", "InsuranceProvider"), _unseen("MedicationID", "d_medication", "Medication")])

ORACLE["q_strict_admission_distinct"] = ORACLE["q_admission_distinct"]  # the same rows, through CSV
