import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from carelens.session import get_spark
    s = get_spark("local[4]", app="carelens-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="carelens-test-")


RAW_ROW = {
    "Name": "Ines Falk", "Age": "62", "Gender": "Female", "Blood Type": "AB-",
    "Medical Condition": "Arthritis", "Date of Admission": "2021-06-03", "Doctor": "M. Osei",
    "Hospital": "North Bay", "Insurance Provider": "Cigna", "Billing Amount": "1840.25",
    "Room Number": "317", "Admission Type": "Urgent", "Discharge Date": "2021-06-09",
    "Medication": "Paracetamol", "Test Results": "Inconclusive",
}


@pytest.fixture()
def raw_rows(spark):
    """Build a raw (all-string) claims DataFrame from dict overrides of a valid row."""
    from carelens.schema import EXPECTED_COLUMNS

    def make(*overrides):
        rows = []
        for i, o in enumerate(overrides):
            r = dict(RAW_ROW)
            r.update(o)
            rows.append(tuple([str(i + 2)] + [r[c] for c in EXPECTED_COLUMNS]))
        schema = "claim_id string, " + ", ".join(f"`{c}` string" for c in EXPECTED_COLUMNS)
        return spark.createDataFrame(rows, schema)
    return make
