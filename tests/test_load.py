"""The CSV → staging → star schema → ranking job."""

import pytest

from carelens.plans.load import NoValidRows, run_load
from carelens.sources import snapshots

from .test_validate import HEADER

GOOD = "A{i},45,Female,O+,Diabetes,2023-01-15,Dr. X,H,Medicare,{b},101,Elective,2023-01-20,Aspirin,Normal\n"
BAD = "B,abc,Male,A+,Asthma,2023-02-01,Dr. Y,H,Aetna,20,102,Urgent,2023-02-03,Lipitor,Pending\n"


def test_load_writes_every_table(spark, tmp_dir):
    p = f"{tmp_dir}/in.csv"
    with open(p, "w") as f:
        f.write(HEADER + "".join(GOOD.format(i=i, b=100 + i) for i in range(5)) + BAD)
    s = run_load(spark, p, f"{tmp_dir}/out").collect()[0]
    assert (s.rows_read, s.valid, s.rejected, s.error_count) == (6, 5, 1, 2)
    assert s.messages == ["Line 7: Invalid age 'abc'", "Line 7: Invalid test results 'Pending'"]
    made = snapshots.current(spark, f"{tmp_dir}/out")
    assert [made.read(spark, t).count() for t in ("staging", "Admission", "Patient", "Doctor")] == [5, 5, 5, 1]
    r = made.read(spark, "ranking").collect()
    assert len(r) == 1 and r[0].InsuranceProvider == "Medicare" and r[0].ClaimCount == 5
    rej = made.read(spark, "rejected").collect()
    assert rej[0].errors == "Line 7: Invalid age 'abc'; Line 7: Invalid test results 'Pending'"


def test_a_load_that_dies_leaves_the_last_one_whole(spark, tmp_dir, monkeypatch):
    p, root = f"{tmp_dir}/in.csv", f"{tmp_dir}/out"
    with open(p, "w") as f:
        f.write(HEADER + GOOD.format(i=1, b=100))
    run_load(spark, p, root)
    first = snapshots.current(spark, root)
    with open(p, "a") as f:
        f.write("".join(GOOD.format(i=i, b=100 + i) for i in range(2, 4)))
    write = snapshots.Load.write

    def dying(after):
        def some(self, *a, **k):
            if len(self.tables) == after:
                raise OSError("lost")
            return write(self, *a, **k)
        return some

    for after in (0, 1, 5, 9, 12):
        monkeypatch.setattr(snapshots.Load, "write", dying(after))
        if after == 12:  # everything written, the commit lost
            monkeypatch.setattr(snapshots, "_rename", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_load(spark, p, root)
        monkeypatch.undo()
        now = snapshots.current(spark, root)
        assert now == first and {t: now.read(spark, t).count() for t in ("staging", "Admission", "Patient")} == {"staging": 1, "Admission": 1, "Patient": 1}
    assert run_load(spark, p, root).first().valid == 3
    now = snapshots.current(spark, root)
    assert now.number == 2 and now.read(spark, "Admission").count() == 3
    assert snapshots.at(spark, root, 1).read(spark, "Admission").count() == 1


def test_two_loads_at_once_take_two_numbers(spark, tmp_dir, monkeypatch):
    one, two = (snapshots.begin(spark, f"{tmp_dir}/both") for _ in range(2))
    for k, load in enumerate((one, two)):
        load.write("t", spark.range(k + 1))
    numbers = snapshots._numbers
    stale = iter([[]])  # the second load does not see the first one's commit at once
    assert one.commit().number == 1
    monkeypatch.setattr(snapshots, "_numbers", lambda *a: next(stale, numbers(*a)))
    assert two.commit().number == 2
    monkeypatch.undo()
    assert snapshots.current(spark, f"{tmp_dir}/both").read(spark, "t").count() == 2


def test_load_stops_without_valid_rows(spark, tmp_dir):
    p = f"{tmp_dir}/bad.csv"
    with open(p, "w") as f:
        f.write(HEADER + BAD)
    with pytest.raises(NoValidRows, match="Line 2: Invalid age 'abc'"):
        run_load(spark, p, f"{tmp_dir}/out")


def test_keys_survive_a_reload(spark, tmp_dir):
    p, root = f"{tmp_dir}/in.csv", f"{tmp_dir}/out"
    line = "{n},45,Female,O+,Diabetes,2023-01-15,{d},H,Medicare,10,101,Elective,2023-01-20,Aspirin,Normal\n"

    def load(names, **how):
        with open(p, "w") as f:
            f.write(HEADER + "".join(line.format(n=n, d=f"Dr. {n}") for n in names))
        run_load(spark, p, root, **how)
        made = snapshots.current(spark, root)
        return [{r.Name: r[key] for r in made.read(spark, t).collect()} for t, key in (("Patient", "PatientID"), ("Doctor", "DoctorID"))], made

    first, _ = load([f"N{i:02d}" for i in range(10, 30)], keep_keys=True)  # nothing committed yet
    assert first[0] == {f"N{i:02d}": i - 9 for i in range(10, 30)}
    second, made = load(["A", "N10", "N20", "Z"], keep_keys=True)
    for old, new in zip(first, second):
        assert {n: new[n] for n in old} == old and sorted(new[n] for n in new if n not in old) == [21, 22]
    assert second[0]["A"] == 21 and second[0]["Z"] == 22
    ids = {r.PatientID for r in made.read(spark, "Admission").collect()}
    assert ids == {second[0][n] for n in ("A", "N10", "N20", "Z")}
    third, _ = load(["N10"], keep_keys=True)
    assert third == second
    again, _ = load(["N20", "N10"])  # without: numbered anew
    assert again[0] == {"N10": 1, "N20": 2}
