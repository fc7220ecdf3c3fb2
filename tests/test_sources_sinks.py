"""Sinks round trip, strict CSV read, collation option."""

import pytest

from carelens.operators import model, ranking
from carelens.operators.view import enriched
from carelens.sources import files, sinks
from carelens.sources.adapter import claims, load_claims

SF = "/root/testdata/sf0.001"


def test_staging_and_star_round_trip(spark, tmp_dir):
    c = claims(spark, SF)
    sinks.write_staging(c, f"{tmp_dir}/staging", partition_by="MedicalCondition")
    back = load_claims(spark, f"{tmp_dir}/staging")
    assert back.count() == c.count()
    dims = model.dimensions(c)
    fact = model.build_fact(c, dims)
    load = sinks.write_star({**dims, "Admission": fact}, f"{tmp_dir}/star")
    assert sinks.current_load(spark, f"{tmp_dir}/star") == load
    assert spark.read.parquet(f"{load}/Admission").count() == c.count()
    r = ranking.cheapest_insurer(enriched(back))
    sinks.write_ranking(r, f"{tmp_dir}/ranking")
    sinks.save_report(ranking.ranking_summary(r), f"{tmp_dir}/report", fmt="csv")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/report").count() == 1


def test_strict_read_fails_fast(spark, tmp_dir):
    from .test_validate import HEADER
    p = f"{tmp_dir}/strict.csv"
    with open(p, "w") as f:
        f.write(HEADER + "A,45,Female,O+,Diabetes,2023-01-15,D,H,M,100.5,101,Elective,2023-01-20,Aspirin,Normal\n")
    assert files.read_strict(spark, p).count() == 1
    with open(p, "a") as f:
        f.write("B,abc,Male,A+,Asthma,2023-02-01,D,H,M,20,102,Urgent,2023-02-03,Lipitor,Normal\n")
    with pytest.raises(Exception):
        files.read_strict(spark, p).collect()


def test_case_insensitive_dimension(spark):
    df = spark.createDataFrame([("Dr. Smith",), ("DR. SMITH",), ("Dr. Jones",)], "Doctor string")
    assert model.dimension(df, "Doctor", "DoctorID").count() == 3
    assert model.dimension(df, "Doctor", "DoctorID", collation="UNICODE_CI_AI").count() == 2


def test_every_file_must_carry_the_header(spark, tmp_dir):
    import os

    from .test_validate import HEADER
    row = "A,45,Female,O+,Diabetes,2023-01-15,DOC,HOSP,M,100.5,101,Elective,2023-01-20,Aspirin,Normal\n"
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as f:
        f.write(HEADER + row * 50)
    assert files.read_raw_csv(spark, f"{tmp_dir}/in").count() == 50
    with open(f"{tmp_dir}/in/b.csv", "w") as f:
        f.write(HEADER.replace("Doctor,Hospital", "Hospital,Doctor") + row)
    with pytest.raises(Exception):
        files.read_raw_csv(spark, f"{tmp_dir}/in").collect()


def test_fk_audit_counts_orphans(spark):
    keys = ["PatientID", "DoctorID", "HospitalID", "InsuranceID", "MedicationID"]
    fact = spark.createDataFrame([(1, 1, 1, 1, 1), (2, 9, 1, 1, 1), (9, 9, 1, None, 1)], ", ".join(f"{k} long" for k in keys))
    dims = {n: spark.createDataFrame([(1,), (2,)], f"{k} long") for n, k in zip(["Patient", *model.NAME_DIMENSIONS], keys)}
    got = {r.fk: r.orphans for r in model.fk_audit(fact, dims).collect()}
    assert got == {"PatientID": 1, "DoctorID": 2, "HospitalID": 0, "InsuranceID": 1, "MedicationID": 0}


def test_csv_fields_as_a_dict_reader_gives_them(spark, tmp_dir):
    from carelens.schema import EXPECTED_COLUMNS
    from carelens.sources.files import read_raw_csv
    row = ['"Ann ""Bo"", Jr"', "45", "Female", "O+", "Diabetes", "2023-01-15", "", "H", "Aetna", "1", "101", "Elective", "2023-01-25", "", "Normal"]
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write(",".join(EXPECTED_COLUMNS) + "\n" + ",".join(row) + "\n" + ",".join(row[:9]) + "\n")
    whole, short = sorted(read_raw_csv(spark, tmp_dir).collect(), key=lambda r: r["Test Results"] is None)
    assert (whole["Name"], whole["Doctor"], whole["Medication"], whole["Test Results"]) == ('Ann "Bo", Jr', "", "", "Normal")
    assert short["Test Results"] is None


def test_whiskers_never_end_inside_the_box(spark):
    from carelens.operators.eda import boxplot_stats
    df = spark.createDataFrame([("a", x) for x in (0, 0, 0, 100)], "g string, x int").selectExpr("g", "cast(x as decimal(18,4)) x")
    r = boxplot_stats(df, "g", "x").first()
    assert float(r["whishi"]) == 25 and float(r["whislo"]) == 0 and r["fliers"] == 1


def test_edges_of_age_and_amount(raw_rows):
    from carelens.operators.validate import first_errors, validate
    bad = validate(raw_rows({"Age": "99999999999"}, {"Billing Amount": "-0.00001"}, *[{"Age": "x"}] * 10))
    got = [(r["claim_id"], r["message"]) for r in first_errors(bad).collect()]
    assert got[0][1].endswith("Age 99999999999 out of range 0-150") and "Negative billing amount" in got[1][1]
    assert [c for c, _ in got] == [str(i) for i in range(2, 12)]
