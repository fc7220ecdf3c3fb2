"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query starts from the claims adapter over the given tables, so its work
grows with them.  Parameters (a condition, an age band) are the operators'
own filters, never row caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import billing, ranking
from ..operators.view import enriched
from ..sources.adapter import claims, profiles

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(claims(spark, sf_dir))


def ranking_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.cheapest_insurer(view(spark, sf_dir))


# -- ranking --------------------------------------------------------------
register("q_cheapest_insurer")(ranking_table)
register("q_ranking_summary")(lambda s, d: ranking.ranking_summary(ranking_table(s, d)))
register("q_conditions")(lambda s, d: ranking.distinct_values(ranking_table(s, d), "MedicalCondition"))
register("q_insurers")(lambda s, d: ranking.distinct_values(ranking_table(s, d), "InsuranceProvider"))
register("q_top_recommendations")(lambda s, d: ranking.top_recommendations(ranking_table(s, d), 10))
register("q_ranking_count")(lambda s, d: ranking.ranking_count(ranking_table(s, d)))
register("q_recommend")(lambda s, d: ranking.recommend(ranking_table(s, d), profiles(s, d)))
register("q_recommend_unmatched")(
    lambda s, d: ranking.unmatched_profiles(ranking_table(s, d), profiles(s, d)))

# -- billing summaries ----------------------------------------------------
register("q_billing_by_age_condition")(lambda s, d: billing.billing_by_age_condition(view(s, d)))
register("q_cost_by_condition_insurer")(lambda s, d: billing.cost_by_condition_insurer(view(s, d)))
register("q_length_of_stay")(lambda s, d: billing.length_of_stay(view(s, d)))
register("q_billing_summary")(lambda s, d: billing.billing_summary(view(s, d)))
register("q_billing_summary_filtered")(
    lambda s, d: billing.billing_summary(view(s, d), condition="Diabetes", age_group="31-45"))
register("q_provider_compare")(lambda s, d: billing.provider_compare(view(s, d), "Diabetes"))

# -- advanced analytics ---------------------------------------------------
from ..operators import advanced  # noqa: E402
from ..sources.adapter import claims as _claims  # noqa: E402

register("q_billing_percentiles")(lambda s, d: advanced.order_stat_percentiles(view(s, d)))
register("q_market_share")(lambda s, d: advanced.market_share(view(s, d)))
register("q_outlier_summary")(lambda s, d: advanced.outlier_summary(view(s, d)))
register("q_cost_efficiency")(lambda s, d: advanced.cost_efficiency(view(s, d)))
register("q_readmission")(lambda s, d: advanced.readmission(_claims(s, d)))
register("q_monthly_trend")(lambda s, d: advanced.monthly_trend(view(s, d)))
register("q_cost_matrix")(lambda s, d: advanced.cost_matrix(view(s, d)))

# -- validation and ingest ------------------------------------------------
import uuid  # noqa: E402

from ..operators import validate as val  # noqa: E402
from ..session import ensure_checkpoint_dir  # noqa: E402
from ..schema import CSV_TO_TYPED  # noqa: E402
from ..sources import files, snapshots  # noqa: E402
from ..sources.adapter import claims_raw  # noqa: E402


def _validated(s, d, level="full"):
    return val.validate(claims_raw(s, d), level=level)


register("q_validate")(lambda s, d: val.as_strings(_validated(s, d)))
register("q_validate_permissive")(lambda s, d: val.as_strings(_validated(s, d, "types")))
register("q_rejects")(
    lambda s, d: val.as_strings(val.split(_validated(s, d))[1]).select("claim_id", "errors", "error_count"))
register("q_reject_summary")(lambda s, d: val.reject_summary(_validated(s, d)))
register("q_first_errors")(
    lambda s, d: val.first_errors(_validated(s, d)).select(
        "claim_id", F.col("pos").cast("bigint").alias("pos"), "message"))
register("q_constraint_audit")(
    lambda s, d: val.constraint_audit(val.split(_validated(s, d, "types"))[0]))


def _shared_folder(s) -> str:
    """The cluster's shared checkpoint folder (where these queries stage their files)."""
    root = ensure_checkpoint_dir(s)
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    return root.rstrip("/")


@register("q_csv_reject_summary")
def _csv_reject_summary(s, d):
    """Round trip through CSV: write the raw claims with the expected header into the
    shared checkpoint folder, read them back with the declared string schema, number
    the lines in file order, validate and summarise."""
    path = f"{_shared_folder(s)}/csv-{uuid.uuid4().hex[:12]}"
    files.write_raw_csv(claims_raw(s, d), path)
    return val.reject_summary(val.validate(files.read_numbered_csv(s, path), record_col="line"))


from ..operators import model  # noqa: E402


@register("q_strict_admission_distinct")
def _strict_admission_distinct(s, d):
    """The legacy load: the claims as CSV, read strictly (typed, the first bad field stops it)."""
    path = f"{_shared_folder(s)}/strict-{uuid.uuid4().hex[:12]}"
    c = _claims(s, d)
    files.write_raw_csv(c.select(*[F.col(t).cast("string").alias(h) for h, t in CSV_TO_TYPED.items()]), path)
    return model.admission_distinct(files.read_strict(s, path)).withColumn(
        "BillingAmount", F.col("BillingAmount").cast("double"))


# -- the ranking as a load stores it --------------------------------------
def _stored_ranking(s, d):
    """Written as the ``ranking`` of a load and read through its commit."""
    root = f"{_shared_folder(s)}/ranking-{uuid.uuid4().hex[:12]}"
    load = snapshots.begin(s, root)
    load.write("ranking", ranking_table(s, d), "AgeGroup")
    load.commit()
    return snapshots.current(s, root).read(s, "ranking")


register("q_ranking_stored")(lambda s, d: _stored_ranking(s, d).select(*ranking_table(s, d).columns))
register("q_recommend_stored")(lambda s, d: ranking.recommend_stored(_stored_ranking(s, d), profiles(s, d)))
register("q_recommend_unmatched_stored")(
    lambda s, d: ranking.unmatched_profiles_stored(_stored_ranking(s, d), profiles(s, d)))


# -- star schema ----------------------------------------------------------

for _dim, (_key, _src) in model.NAME_DIMENSIONS.items():
    _qname = {"Doctor": "q_dim_doctor", "Hospital": "q_dim_hospital",
              "InsuranceProvider": "q_dim_insurer", "Medication": "q_dim_medication"}[_dim]
    register(_qname)(lambda s, d, _src=_src, _key=_key: model.dimension(_claims(s, d), _src, _key))
register("q_dim_patient")(lambda s, d: model.patients(_claims(s, d)))
register("q_dim_test")(lambda s, d: model.test_dimension(_claims(s, d)))
register("q_admission_distinct")(
    lambda s, d: model.admission_distinct(_claims(s, d)).withColumn(
        "BillingAmount", F.col("BillingAmount").cast("double")))


def _star(s, d):
    """The claims as staging and the dimensions keyed from it, written as tables of a load and read back:
    the tables are joined once, and the joins of the fact see the sizes of what is stored."""
    load = snapshots.begin(s, f"{_shared_folder(s)}/star-{uuid.uuid4().hex[:12]}")
    c = load.write("staging", _claims(s, d))
    return c, {name: load.write(name, rows) for name, rows in model.dimensions(c).items()}


def _fact(s, d, with_id=True):
    c, dims = _star(s, d)
    return model.build_fact(c, dims, with_id), dims


register("q_fact")(lambda s, d: _fact(s, d)[0].withColumn(
    "BillingAmount", F.col("BillingAmount").cast("double")))
register("q_fk_audit")(lambda s, d: model.fk_audit(*_fact(s, d, with_id=False)))



EARLY = "1995-02-01"  # claims admitted before stand for a first load


def _early(c):
    return c.where(F.col("DateOfAdmission") < F.lit(EARLY).cast("date"))


@register("q_dim_patient_incremental")
def _dim_patient_incremental(s, d):
    """Patients of a first load keep their keys when the other claims arrive."""
    c = _claims(s, d)
    return model.extend(model.patients(_early(c)), c.where(F.col("Name").isNotNull()), model.PATIENT_KEYS, "PatientID")


@register("q_dim_doctor_incremental")
def _dim_doctor_incremental(s, d):
    c = _claims(s, d)
    rows = c.select(F.col("Doctor").alias("Name")).where(F.col("Name").isNotNull())
    return model.extend(model.dimension(_early(c), "Doctor", "DoctorID"), rows, ["Name"], "DoctorID")


@register("q_fk_audit_stale")
def _fk_audit_stale(s, d):
    """The fact of all claims against dimensions that still lack the members of later claims."""
    c, dims = _star(s, d)
    early = _early(c)
    stale = {n: dims[n].join(early.select(F.col(src).alias("Name")).distinct(), "Name", "left_semi")
             for n, (_k, src) in model.NAME_DIMENSIONS.items()}
    stale["Patient"] = dims["Patient"].join(early.select(*model.PATIENT_KEYS).distinct(), model.PATIENT_KEYS, "left_semi")
    return model.fk_audit(model.build_fact(c, dims, with_id=False), stale)


# -- data profile (over the permissive load, as the profiler reads staging) ----
from ..operators import profile as prof  # noqa: E402


def staging_loose(s, d):
    """Staging as loaded with validation skipped: rows whose numbers parse."""
    return val.split(val.validate(claims_raw(s, d), level="types"))[0].drop("claim_id")


register("q_profile_overview")(lambda s, d: prof.profile_overview(staging_loose(s, d)))
register("q_profile_completeness")(lambda s, d: prof.profile_completeness(staging_loose(s, d)))
register("q_profile_cardinality")(lambda s, d: prof.profile_cardinality(staging_loose(s, d)))
register("q_profile_categories")(lambda s, d: prof.profile_categories(staging_loose(s, d)))
register("q_profile_billing")(lambda s, d: prof.profile_billing(staging_loose(s, d)))
register("q_profile_percentiles")(lambda s, d: prof.profile_percentiles(staging_loose(s, d)))
register("q_profile_outliers")(lambda s, d: prof.profile_outliers(staging_loose(s, d)))
register("q_profile_age_groups")(lambda s, d: prof.profile_age_groups(staging_loose(s, d)))
register("q_profile_los")(lambda s, d: prof.profile_los(staging_loose(s, d)))
register("q_quality_checks")(lambda s, d: prof.quality_checks(staging_loose(s, d)))
register("q_quality_score")(lambda s, d: prof.quality_score(prof.quality_checks(staging_loose(s, d))))

# -- states: reports without a scan of the claims ------------------------------
from ..operators import states as sts  # noqa: E402


@register("q_profile_report")
def _profile_report(s, d):
    """Staging is written to the shared folder and its profile observed on the way."""
    seen = sts.ObservedProfile(staging_loose(s, d))
    seen.rows.write.parquet(f"{_shared_folder(s)}/staging-{uuid.uuid4().hex[:12]}")
    return seen.report()


def _by_year(df):
    """The claims of a year stand for a load; claims without a date for one more."""
    return df.withColumn("load", F.year("DateOfAdmission"))


def _moment_states(s, d):
    return sts.moment_states(_by_year(_claims(s, d)), ["load", *sts.MOMENT_KEYS])


@register("q_profile_cardinality_stored")
def _profile_cardinality_stored(s, d):
    """Exact counts of the columns with few values and the class of every column, from states."""
    loose = staging_loose(s, d)
    r = sts.cardinality_from(sts.sketch_states(loose), sts.value_states(loose))
    return r.select("position", "column", "exact", F.when(F.col("exact"), F.col("distinct_values")).alias("distinct_values"),
                    "cardinality")


# -- statistics -------------------------------------------------------------
from ..operators import statistics as st  # noqa: E402


def _moments(s, d, key="InsuranceProvider"):
    return st.group_moments(_claims(s, d), key)


register("q_group_moments")(lambda s, d: st.moments_report(_moments(s, d)))
register("q_welch")(lambda s, d: st.welch(_moments(s, d)))
register("q_welch_summary")(lambda s, d: st.welch_summary(st.welch(_moments(s, d))))
register("q_confidence_intervals")(lambda s, d: st.confidence_intervals(_moments(s, d)))
register("q_anova_provider")(lambda s, d: st.anova(_moments(s, d)))
register("q_cohens_d")(lambda s, d: st.cohens_d(_moments(s, d)))
register("q_anova_condition")(lambda s, d: st.anova(_moments(s, d, "MedicalCondition")))
register("q_condition_ci")(
    lambda s, d: st.confidence_intervals(_moments(s, d, "MedicalCondition"), "MedicalCondition"))
register("q_welch_condition_filtered")(
    lambda s, d: st.welch(st.group_moments(_claims(s, d), "InsuranceProvider",
                                           where={"MedicalCondition": "Diabetes"})))

register("q_group_moments_stored")(lambda s, d: st.moments_report(sts.moments_from(_moment_states(s, d))))
register("q_welch_stored")(lambda s, d: st.welch(sts.moments_from(_moment_states(s, d))))
register("q_welch_condition_stored")(
    lambda s, d: st.welch(sts.moments_from(_moment_states(s, d), where={"MedicalCondition": "Diabetes"})))
register("q_anova_condition_stored")(
    lambda s, d: st.anova(sts.moments_from(_moment_states(s, d), "MedicalCondition")))

# -- exploratory analysis and dashboard calculations ----------------------
from ..operators import eda, serving  # noqa: E402

register("q_provider_stats")(lambda s, d: eda.group_stats(_claims(s, d)))
register("q_describe")(lambda s, d: eda.describe(view(s, d)))
register("q_provider_condition_matrix")(lambda s, d: eda.provider_condition_matrix(view(s, d)))
register("q_los_by_condition")(lambda s, d: eda.los_by_condition(view(s, d)))
register("q_cost_per_day_by_provider")(lambda s, d: eda.cost_per_day_by_provider(view(s, d)))
register("q_flag_outliers")(lambda s, d: eda.flag_outliers(view(s, d)).select(
    "MedicalCondition", "InsuranceProvider", "DateOfAdmission",
    F.col("BillingAmount").cast("double").alias("BillingAmount"), "IsOutlier"))
register("q_outlier_share")(lambda s, d: eda.outlier_share(view(s, d)))
register("q_value_counts")(lambda s, d: eda.value_counts(_claims(s, d)))
register("q_age_bins")(lambda s, d: eda.age_bins(_claims(s, d)))
register("q_histogram")(lambda s, d: eda.histogram(_claims(s, d), "BillingAmount", 60))
register("q_histogram_age")(lambda s, d: eda.histogram(_claims(s, d), "Age", 40))
register("q_histogram_los")(lambda s, d: eda.histogram(view(s, d), "LengthOfStay", 30))
register("q_boxplot")(lambda s, d: eda.boxplot_stats(_claims(s, d), "MedicalCondition"))
register("q_boxplot_insurer")(lambda s, d: eda.boxplot_stats(_claims(s, d), "InsuranceProvider"))
register("q_condition_mean_of_means")(
    lambda s, d: serving.condition_mean_of_means(billing.billing_summary(view(s, d))))
register("q_provider_best")(
    lambda s, d: serving.provider_best(billing.provider_compare(view(s, d), "Diabetes")))
register("q_enriched")(lambda s, d: view(s, d).withColumn(
    "BillingAmount", F.col("BillingAmount").cast("double")))
register("q_age_group")(lambda s, d: view(s, d).groupBy("AgeGroup").agg(
    F.count(F.lit(1)).alias("n"), F.min("Age").alias("min_age"), F.max("Age").alias("max_age")))


@register("q_stream_reject_summary")
def _stream_reject_summary(s, d):
    """Incremental load: the raw claims land as CSV files in the shared checkpoint folder,
    a Structured Streaming query (available-now trigger) validates them into staging and
    rejects, and the summary is computed from what it wrote."""
    from ..streaming.ingest import ingest_summary, run_ingest
    root = f"{_shared_folder(s)}/stream-{uuid.uuid4().hex[:12]}"
    files.write_raw_csv(claims_raw(s, d), f"{root}/landing")
    run_ingest(s, f"{root}/landing", f"{root}/staging", f"{root}/rejects", f"{root}/_checkpoint")
    return ingest_summary(s, f"{root}/staging", f"{root}/rejects")
