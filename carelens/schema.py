"""Declared schemas and value domains of the claims data."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# CSV header, in order:
EXPECTED_COLUMNS = [
    "Name", "Age", "Gender", "Blood Type", "Medical Condition", "Date of Admission",
    "Doctor", "Hospital", "Insurance Provider", "Billing Amount", "Room Number",
    "Admission Type", "Discharge Date", "Medication", "Test Results",
]
# Domains of the constrained fields:
GENDERS = ["Male", "Female"]
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
ADMISSION_TYPES = ["Elective", "Emergency", "Urgent"]
CONDITIONS = ["Diabetes", "Asthma", "Obesity", "Arthritis", "Hypertension", "Cancer"]
TEST_RESULTS = ["Normal", "Abnormal", "Inconclusive"]
# Age bands (label, lowest age, highest age); ages above 80 are '81+', NULL or negative 'Unknown'.
AGE_BANDS = [
    ("0-1", 0, 1), ("2-5", 2, 5), ("6-12", 6, 12), ("13-18", 13, 18), ("19-30", 19, 30),
    ("31-45", 31, 45), ("46-60", 46, 60), ("61-80", 61, 80),
]
OLDEST_BAND = ("81+", 81)
UNKNOWN_BAND = "Unknown"
AGE_MIN, AGE_MAX = 0, 150
# ---------------------------------------------------------------------------

# Typed (staging) column names in CSV order.
TYPED_COLUMNS = [c.replace(" of ", "Of").replace(" ", "") for c in EXPECTED_COLUMNS]
CSV_TO_TYPED = dict(zip(EXPECTED_COLUMNS, TYPED_COLUMNS))

MONEY = T.DecimalType(18, 4)

# Raw CSV read: every field is a string, names as in the header.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in EXPECTED_COLUMNS])

_TYPES = {
    "Age": T.IntegerType(),
    "DateOfAdmission": T.DateType(),
    "BillingAmount": MONEY,
    "RoomNumber": T.IntegerType(),
    "DischargeDate": T.DateType(),
}

# Staging table (all nullable, like the reference's flat table).
CLAIMS_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.StringType()), True) for c in TYPED_COLUMNS]
)

TEXT_COLUMNS = [c for c in TYPED_COLUMNS if c not in _TYPES]
