"""Hand-sized cases: ties, stays of 0 days, HAVING limits, known outliers, NULLs."""

import datetime
from decimal import Decimal

from carelens.operators import advanced, billing, eda, profile, ranking, serving
from carelens.operators.view import enriched
from carelens.schema import CLAIMS_SCHEMA


def claims_df(spark, rows):
    """rows: dicts over the staging columns (missing ones take defaults)."""
    base = dict(Name="P", Age=40, Gender="Male", BloodType="O+", MedicalCondition="Diabetes",
                DateOfAdmission=datetime.date(2023, 1, 1), Doctor="D", Hospital="H",
                InsuranceProvider="I1", BillingAmount=Decimal("100.0000"), RoomNumber=101,
                AdmissionType="Elective", DischargeDate=datetime.date(2023, 1, 3), Medication="Aspirin",
                TestResults="Normal")
    out = []
    for r in rows:
        b = dict(base)
        b.update(r)
        if isinstance(b["BillingAmount"], (int, float, str)):
            b["BillingAmount"] = Decimal(str(b["BillingAmount"]))
        out.append(tuple(b[f.name] for f in CLAIMS_SCHEMA.fields))
    return spark.createDataFrame(out, CLAIMS_SCHEMA)


def test_cheapest_insurer_ties_on_rounded_average(spark):
    # I1 averages 100.004, I2 100.001: equal after rounding to cents → both rank 1
    rows = [dict(InsuranceProvider="I1", BillingAmount="100.0040"),
            dict(InsuranceProvider="I2", BillingAmount="100.0010"),
            dict(InsuranceProvider="I3", BillingAmount="200")]
    r = ranking.cheapest_insurer(enriched(claims_df(spark, rows))).collect()
    assert sorted(x.InsuranceProvider for x in r) == ["I1", "I2"]
    assert all(x.ProviderRank == 1 and x.AvgBillingAmount == 100.0 for x in r)


def test_efficiency_rank_uses_unrounded_cost_per_day(spark):
    rows = ([dict(InsuranceProvider="I1", BillingAmount="100.0040")] * 10
            + [dict(InsuranceProvider="I2", BillingAmount="100.0010")] * 10
            + [dict(InsuranceProvider="I3", BillingAmount="50")] * 9)  # below HAVING claims >= 10
    r = {x.InsuranceProvider: x for x in advanced.cost_efficiency(enriched(claims_df(spark, rows))).collect()}
    assert set(r) == {"I1", "I2"}
    assert r["I1"].cost_per_day == r["I2"].cost_per_day == 50.0
    assert (r["I2"].efficiency_rank, r["I1"].efficiency_rank) == (1, 2)


def test_same_day_stay_has_no_cost_per_day(spark):
    rows = [dict(DischargeDate=datetime.date(2023, 1, 1)), dict(BillingAmount="300")]
    r = billing.length_of_stay(enriched(claims_df(spark, rows))).collect()[0]
    assert r.ClaimCount == 2 and r.AvgStayDays == 1.0 and r.AvgCostPerDay == 150.0


def test_outliers_known(spark):
    rows = [dict(BillingAmount="100")] * 20 + [dict(BillingAmount="10000")]
    v = enriched(claims_df(spark, rows))
    r = advanced.outlier_summary(v).collect()[0]
    assert r.outlier_count == 1 and r.avg_outlier_bill == 10000.0
    assert advanced.outlier_summary(v, condition="Asthma").count() == 0
    share = eda.outlier_share(v).collect()[0]
    assert (share.total, share.outliers, share.outlier_pct) == (21, 1, "4.8%")


def test_market_share_rank_has_gaps(spark):
    rows = ([dict(InsuranceProvider="A")] * 2 + [dict(InsuranceProvider="B")] * 2
            + [dict(InsuranceProvider="C")])
    r = {x.InsuranceProvider: x for x in advanced.market_share(enriched(claims_df(spark, rows))).collect()}
    assert (r["A"].share_rank, r["B"].share_rank, r["C"].share_rank) == (1, 1, 3)
    assert (r["A"].market_share_pct, r["C"].market_share_pct) == (40.0, 20.0)


def test_readmission_two_levels(spark):
    rows = [dict(Name="a")] * 3 + [dict(Name="b")] * 2 + [dict(Name="c")]
    r = advanced.readmission(claims_df(spark, rows)).collect()[0]
    assert (r.patients_with_readmissions, r.avg_admissions_per_patient, r.max_admissions) == (2, 2.5, 3)


def test_cost_matrix_premium_from_unrounded_averages(spark):
    rows = [dict(AdmissionType="Emergency", BillingAmount="100.006"),
            dict(AdmissionType="Elective", BillingAmount="100.001")]
    r = advanced.cost_matrix(enriched(claims_df(spark, rows))).collect()[0]
    assert r.emergency_avg == 100.01 and r.elective_avg == 100.0 and r.emergency_premium == 0.01
    assert r.urgent_avg is None


def test_monthly_trend_first_month_null(spark):
    rows = [dict(DateOfAdmission=datetime.date(2023, 1, 5), DischargeDate=datetime.date(2023, 1, 6)),
            dict(DateOfAdmission=datetime.date(2023, 2, 5), DischargeDate=datetime.date(2023, 2, 6),
                 BillingAmount="150")]
    r = advanced.monthly_trend(enriched(claims_df(spark, rows))).collect()
    assert [x.admission_month for x in r] == ["2023-01", "2023-02"]
    assert r[0].month_over_month_change is None and r[1].month_over_month_change == 50.0


def test_provider_compare_zero_stddev_is_null(spark):
    rows = [dict(InsuranceProvider="A")] * 3 + [dict(InsuranceProvider="B", BillingAmount="1"),
                                                dict(InsuranceProvider="B", BillingAmount="3")]
    r = {x.InsuranceProvider: x for x in billing.provider_compare(enriched(claims_df(spark, rows)),
                                                                   "Diabetes").collect()}
    assert r["A"].stddev_billing is None and r["B"].stddev_billing == 1.0
    best = {x.insurer: x for x in serving.provider_best(billing.provider_compare(
        enriched(claims_df(spark, rows)), "Diabetes")).collect()}
    assert best["B"].badge == "Cheapest" and best["A"].badge == "Most Exp."
    assert (best["B"].relative_pct, best["A"].bar_pct) == (0, 0)


def test_profile_quality_and_empty_counts(spark):
    rows = [dict(BillingAmount="-5"), dict(Gender="Other"), dict(Name="  ")]
    c = claims_df(spark, rows)
    checks = {r.check_name: r for r in profile.quality_checks(c).collect()}
    assert checks["All billing amounts >= 0"].violations == 1
    assert checks["All categorical values valid"].status == "FAIL"
    assert profile.quality_score(profile.quality_checks(c)).collect()[0].checks_passed == 3
    comp = {r.column: r for r in profile.profile_completeness(c).collect()}
    assert comp["Name"].empties == 1 and comp["Name"].pct_complete == 66.7


def test_histogram_includes_empty_bins(spark):
    rows = [dict(Age=0), dict(Age=10), dict(Age=10)]
    h = eda.histogram(claims_df(spark, rows), "Age", 5).collect()
    assert [r.n for r in h] == [1, 0, 0, 0, 2]


def test_recommend_hits_ties_and_misses(spark):
    rows = [dict(Age=40, InsuranceProvider="I1", BillingAmount="100"),
            dict(Age=40, InsuranceProvider="I2", BillingAmount="100"),
            dict(Age=40, InsuranceProvider="I3", BillingAmount="300")]
    r = ranking.cheapest_insurer(enriched(claims_df(spark, rows)))
    profiles = spark.createDataFrame(
        [(1, 35, "O+", "Diabetes", "Aspirin"), (2, 0, "O+", "Diabetes", "Aspirin"),
         (3, 40, "A+", "Diabetes", "Aspirin")],
        "profile_id long, age int, blood_type string, condition string, medication string")
    hits = ranking.recommend(r, profiles).collect()
    assert sorted((h.profile_id, h.insurer, h.rank) for h in hits) == [(1, "I1", 1), (1, "I2", 1)]
    misses = ranking.unmatched_profiles(r, profiles).collect()
    assert sorted((m.profile_id, m.age_group) for m in misses) == [(2, "0-1"), (3, "31-45")]


def test_stored_lookup_reads_only_the_bands_asked_for(spark, tmp_dir):
    """The scan of a stored ranking is pruned at run time by the profiles' age bands."""
    from pyspark.sql import functions as F

    from carelens.operators import ranking

    bands = ["0-1", "19-30", "31-45", "61-80", "81+", "Unknown"]
    rows = [(b, "O+", "Asthma", "Aspirin", f"I{k}", 10.0 * k, 1.0, 99.0, 3, 1) for b in bands for k in (2, 1)]
    path = f"{tmp_dir}/ranking"
    spark.createDataFrame(rows, "AgeGroup string, BloodType string, MedicalCondition string, Medication string, InsuranceProvider string, "
                          "AvgBillingAmount double, MinBillingAmount double, MaxBillingAmount double, ClaimCount long, ProviderRank long"
                          ).write.partitionBy("AgeGroup").parquet(path)
    asked = [(1, 25, "O+", "Asthma"), (2, 40, "O+", "Gout"), (3, None, "O+", "Asthma"), (4, -5, "O+", "Asthma"), (5, 200, "O+", "Asthma"), (6, 150, "O+", "Asthma")]
    spark.createDataFrame([(*a, "Aspirin") for a in asked], "profile_id long, age int, blood_type string, condition string, medication string").write.parquet(f"{tmp_dir}/p")
    p = spark.read.parquet(f"{tmp_dir}/p")
    got = ranking.recommend_stored(spark.read.parquet(path), p)
    assert [(r.profile_id, r.age_group, r.insurer) for r in got.collect()] == [
        (1, "19-30", "I1"), (1, "19-30", "I2"), (6, "81+", "I1"), (6, "81+", "I2")]
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    none = ranking.unmatched_profiles_stored(spark.read.parquet(path), p)
    assert sorted(r.profile_id for r in none.collect()) == [2, 3, 4, 5]
    read = ranking._wanted_bands(spark.read.parquet(path), p)
    assert {r.AgeGroup for r in read.collect()} == {"19-30", "31-45", "81+"}
