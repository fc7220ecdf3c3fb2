"""Cheapest-insurer ranking and the lookups served from it.

Plan shape of ``cheapest_insurer``: partial hash aggregate on the executors →
shuffle of at most (#groups × #tasks) partial rows → final aggregate → a second,
tiny shuffle on the 4 demographic keys for ``dense_rank``.  Spark inserts a
``WindowGroupLimit`` before that shuffle, so only rank-1 candidates move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import age_group_of_profile, avg_int1, money
from ..schema import AGE_MAX, AGE_MIN

DEMOGRAPHIC_KEYS = ["AgeGroup", "BloodType", "MedicalCondition", "Medication"]
RANKING_KEYS = DEMOGRAPHIC_KEYS + ["InsuranceProvider"]


def provider_aggregates(v: DataFrame) -> DataFrame:
    """Per demographic group and insurer: rounded avg/min/max billing (decimal) and count."""
    b = F.col("BillingAmount")
    return v.groupBy(*RANKING_KEYS).agg(
        F.round(F.avg(b), 2).alias("AvgBillingAmount"),
        F.round(F.min(b), 2).alias("MinBillingAmount"),
        F.round(F.max(b), 2).alias("MaxBillingAmount"),
        F.count(F.lit(1)).alias("ClaimCount"),
    )


def cheapest_insurer(v: DataFrame) -> DataFrame:
    """All insurers whose *rounded* average is the lowest of their group (ties kept)."""
    w = Window.partitionBy(*DEMOGRAPHIC_KEYS).orderBy(F.col("AvgBillingAmount").asc())
    ranked = provider_aggregates(v).withColumn("ProviderRank", F.dense_rank().over(w))
    return ranked.filter(F.col("ProviderRank") == 1).select(
        *RANKING_KEYS,
        money("AvgBillingAmount").alias("AvgBillingAmount"),
        money("MinBillingAmount").alias("MinBillingAmount"),
        money("MaxBillingAmount").alias("MaxBillingAmount"),
        F.col("ClaimCount").cast("bigint").alias("ClaimCount"),
        F.col("ProviderRank").cast("bigint").alias("ProviderRank"),
    )


def ranking_summary(ranking: DataFrame) -> DataFrame:
    """Rows, distinct demographic groups (separator-less CONCAT, NULL not counted), avg claims."""
    key = F.concat(*[F.col(k) for k in DEMOGRAPHIC_KEYS])
    return ranking.agg(
        F.count(F.lit(1)).alias("TotalRecommendations"),
        F.count_distinct(key).alias("UniqueDemographicGroups"),
        avg_int1("ClaimCount").alias("AvgClaimsPerRecommendation"),
    )


def distinct_values(ranking: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of one ranking column (what the lookup lists offer)."""
    return ranking.select(col).distinct().orderBy(col)


def top_recommendations(ranking: DataFrame, n: int = 10) -> DataFrame:
    """First n rows by AgeGroup, MedicalCondition (remaining keys break ties)."""
    order = ["AgeGroup", "MedicalCondition", "BloodType", "Medication", "InsuranceProvider"]
    return (ranking.select(*RANKING_KEYS, "AvgBillingAmount", "ClaimCount")
                   .orderBy(*order).limit(n))


def ranking_count(ranking: DataFrame) -> DataFrame:
    return ranking.agg(F.count(F.lit(1)).alias("ranking_rows"))


def _profiles_keyed(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("age_group", age_group_of_profile("age"))


def recommend(ranking: DataFrame, profiles: DataFrame) -> DataFrame:
    """Batch lookup: every ranking row matching a profile's (age band, blood, condition, medication).

    An equi-join on four keys; AQE turns it into a broadcast join at run time when
    the ranking side turns out small and keeps the sort-merge join otherwise.  The rows of
    a profile stand together, best rank first, the cheaper first among equals.
    """
    p = _profiles_keyed(profiles)
    r = ranking.select(
        F.col("AgeGroup").alias("age_group"), F.col("BloodType").alias("blood_type"),
        F.col("MedicalCondition").alias("condition"), F.col("Medication").alias("medication"),
        F.col("InsuranceProvider").alias("insurer"), F.col("AvgBillingAmount").alias("avg_billing"),
        F.col("MinBillingAmount").alias("min_billing"), F.col("MaxBillingAmount").alias("max_billing"),
        F.col("ClaimCount").alias("claim_count"), F.col("ProviderRank").alias("rank"))
    keys = ["age_group", "blood_type", "condition", "medication"]
    return p.join(r, keys, "inner").select(
        "profile_id", "age", *keys, "insurer", "avg_billing", "min_billing", "max_billing",
        "claim_count", "rank").orderBy("profile_id", "rank", "avg_billing", "insurer")


def unmatched_profiles(ranking: DataFrame, profiles: DataFrame) -> DataFrame:
    """Profiles with no recommendation (the 'not found' outcome), with the keys searched."""
    p = _profiles_keyed(profiles)
    r = ranking.select(
        F.col("AgeGroup").alias("age_group"), F.col("BloodType").alias("blood_type"),
        F.col("MedicalCondition").alias("condition"), F.col("Medication").alias("medication"))
    keys = ["age_group", "blood_type", "condition", "medication"]
    return p.join(r.distinct(), keys, "left_anti").select("profile_id", "age", *keys)


def _wanted_bands(stored: DataFrame, profiles: DataFrame) -> DataFrame:
    """The rows of a ranking stored in one folder per age band whose band a profile asks for.

    The bands asked for are at most as many as there are bands (``schema.AGE_BANDS`` and the oldest),
    which bounds the broadcast; the scan takes them as a dynamic partition filter, so folders of
    other bands are not read, however many profiles there are."""
    bands = (profiles.where(F.col("age").between(AGE_MIN, AGE_MAX))
             .select(age_group_of_profile("age").alias("_band")).distinct())
    return stored.join(F.broadcast(bands), F.col("AgeGroup") == F.col("_band"), "left_semi")


def recommend_stored(stored: DataFrame, profiles: DataFrame) -> DataFrame:
    """``recommend`` over a stored ranking, reading the age bands of the profiles only."""
    return recommend(_wanted_bands(stored, profiles), profiles)


def unmatched_profiles_stored(stored: DataFrame, profiles: DataFrame) -> DataFrame:
    """``unmatched_profiles`` over a stored ranking; profiles without a band match nothing either way."""
    return unmatched_profiles(_wanted_bands(stored, profiles), profiles)
