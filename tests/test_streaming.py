"""Incremental ingest: each landed file is processed once; summaries add up."""

from carelens.streaming.ingest import ingest_summary, run_ingest

from .test_validate import HEADER  # noqa: F401  (same header as the CSV tests)

GOOD = ("A,45,Female,O+,Diabetes,2023-01-15,Dr. X,H,Medicare,100.5,101,Elective,2023-01-20,"
        "Aspirin,Normal\n")
BAD = ("B,abc,Male,A+,Asthma,2023-02-01,Dr. Y,H,Aetna,20,102,Urgent,2023-02-03,Lipitor,Pending\n")


def test_available_now_ingest_is_incremental(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    import os
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write(HEADER + GOOD + BAD)
    args = (spark, landing, f"{tmp_dir}/staging", f"{tmp_dir}/rejects", f"{tmp_dir}/ckpt")
    run_ingest(*args)
    s = ingest_summary(spark, f"{tmp_dir}/staging", f"{tmp_dir}/rejects").collect()[0]
    assert (s.rows_read, s.valid, s.rejected, s.error_count) == (2, 1, 1, 2)
    with open(f"{landing}/b.csv", "w") as f:
        f.write(HEADER + GOOD)
    run_ingest(*args)  # only the new file is read
    s = ingest_summary(spark, f"{tmp_dir}/staging", f"{tmp_dir}/rejects").collect()[0]
    assert (s.rows_read, s.valid, s.rejected) == (3, 2, 1)
    run_ingest(*args)  # nothing new: unchanged
    assert ingest_summary(spark, f"{tmp_dir}/staging", f"{tmp_dir}/rejects").collect()[0].rows_read == 3
