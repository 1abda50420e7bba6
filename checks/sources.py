"""Loaders, sinks and static tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.common import Check, canonical, compose, view
from checks.prepare import SPLIT
from palate.functions.numbers import micros
from palate.operators.cohort import temporal_split
from palate.operators.descriptive import city_summary
from palate.operators.features import checkin_stats, cohort_users, tip_counts
from palate.session import scratch_path
from palate.sources import jsonl
from palate.sources.artifacts import read_artifact, read_report, write_artifact, write_report
from palate.sources.schemas import REVIEW


AS_OF_TIPS = "2024-01-15"


def _as_json(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = scratch_path(spark, name)
    view(spark, sf_dir, name).write.json(path)
    return path


def scan_jsonl(spark, sf_dir):
    raw = jsonl.scan_jsonl(spark, _as_json(spark, sf_dir, "raw_reviews"), REVIEW)
    return raw.select("review_id", "user_id", "business_id", "stars", "date", F.md5("text").alias("text_md5"),
                      "useful", "funny", "cool")


def scan_jsonl_first(spark, sf_dir):
    return jsonl.scan_jsonl(spark, _as_json(spark, sf_dir, "raw_reviews"), REVIEW, 100, "review_id").select("review_id", "user_id", "stars")


def load_reviews_first(spark, sf_dir):
    return canonical(jsonl.load_reviews(spark, _as_json(spark, sf_dir, "raw_reviews"), 100).select("review_id", "stars"))


def checkin_stats_as_of(spark, sf_dir):
    stats = checkin_stats(view(spark, sf_dir, "checkins"), F.lit("2020-01-31").cast("timestamp"))
    return canonical(stats.withColumn("last_checkin", micros(F.col("last_checkin"))))


def tip_counts_as_of(spark, sf_dir):
    tips = view(spark, sf_dir, "tips")
    return canonical(tip_counts(tips, F.lit(AS_OF_TIPS).cast("timestamp")))


def load_business(spark, sf_dir):
    df = jsonl.load_businesses(spark, _as_json(spark, sf_dir, "raw_businesses"))
    return canonical(df.drop("attributes", "hours"))


def load_reviews(spark, sf_dir):
    df = jsonl.load_reviews(spark, _as_json(spark, sf_dir, "raw_reviews"))
    return canonical(df.withColumns({"date": micros(F.col("date")), "text": F.md5("text")}))


def load_users(spark, sf_dir):
    df = jsonl.load_users(spark, _as_json(spark, sf_dir, "raw_users"))
    return canonical(df.select("user_id", "name", "review_count", micros(F.col("signup_date")).alias("signup_us"),
                               "fans", "average_stars", "is_elite", "compliment_hot", "compliment_photos"))


def load_tips(spark, sf_dir):
    df = jsonl.load_tips(spark, _as_json(spark, sf_dir, "raw_tips"))
    return canonical(df.withColumn("date", micros(F.col("date"))))


def load_checkins(spark, sf_dir):
    return jsonl.load_checkins(spark, _as_json(spark, sf_dir, "checkins"))


def run_cohort_users(spark, sf_dir):
    users = cohort_users(view(spark, sf_dir, "users"), view(spark, sf_dir, "interactions"))
    return canonical(users.select(
        "user_id", micros(F.col("signup_date")).alias("signup_us"), "is_elite", "fans", "total_compliments"
    ))


def run_checkin_stats(spark, sf_dir):
    df = checkin_stats(view(spark, sf_dir, "checkins"))
    return canonical(df.withColumn("last_checkin", micros(F.col("last_checkin"))))


def run_tip_counts(spark, sf_dir):
    return canonical(tip_counts(view(spark, sf_dir, "tips")))


def parquet_artifacts(spark, sf_dir):
    path = scratch_path(spark, "interactions")
    write_artifact(temporal_split(view(spark, sf_dir, "interactions")), path, ("split",))
    return _dated(read_artifact(spark, path))


def _dated(df: DataFrame) -> DataFrame:
    return canonical(df.withColumn("date", F.col("date").cast("date")))


def report_csv(spark, sf_dir):
    path = write_report(city_summary(view(spark, sf_dir, "businesses")), scratch_path(spark, "city_summary"))
    return canonical(read_report(
        spark, path, "city string, business_count long, avg_stars double, total_reviews double"
    ))


CHECKS = {
    "scan_jsonl": Check(scan_jsonl, compose(
        "SELECT review_id, user_id, business_id, stars, date, md5(text) AS text_md5, useful, funny, cool FROM raw_reviews",
        ["raw_reviews"])),
    "scan_jsonl_first": Check(scan_jsonl_first, compose(
        "SELECT review_id, user_id, stars FROM raw_reviews ORDER BY review_id LIMIT 100", ["raw_reviews"])),
    "load_reviews_first": Check(load_reviews_first, compose(
        "SELECT review_id, TRY_CAST(stars AS DOUBLE) AS stars FROM raw_reviews ORDER BY review_id LIMIT 100", ["raw_reviews"])),
    "checkin_stats_as_of": Check(checkin_stats_as_of, compose("""
        SELECT business_id, CAST(len(kept) AS BIGINT) AS checkin_count, epoch_us(CAST(kept[-1] AS TIMESTAMP)) AS last_checkin
        FROM (SELECT business_id, [x FOR x IN string_split(coalesce(date, ''), ', ')
                IF coalesce(TRY_CAST(x AS TIMESTAMP) <= TIMESTAMP '2020-01-31', false)] AS kept FROM checkins)""", ["checkins"])),
    "tip_counts_as_of": Check(tip_counts_as_of, compose(
        f"SELECT business_id, count(*) AS tip_count FROM tips WHERE date <= TIMESTAMP '{AS_OF_TIPS}' GROUP BY business_id", ["tips"])),
    "load_business": Check(load_business, compose("""
        SELECT business_id, name, city, state, TRY_CAST(stars AS DOUBLE) AS stars,
               TRY_CAST(review_count AS DOUBLE) AS review_count, TRY_CAST(is_open AS DOUBLE) AS is_open, categories,
               TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude
        FROM raw_businesses""", ["raw_businesses"])),
    "load_reviews": Check(load_reviews, compose("""
        SELECT review_id, user_id, business_id, TRY_CAST(stars AS DOUBLE) AS stars,
               epoch_us(TRY_CAST(date AS TIMESTAMP)) AS date, md5(text) AS text,
               TRY_CAST(useful AS DOUBLE) AS useful, TRY_CAST(funny AS DOUBLE) AS funny, TRY_CAST(cool AS DOUBLE) AS cool
        FROM raw_reviews""", ["raw_reviews"])),
    "load_users": Check(load_users, compose("""
        SELECT user_id, name, TRY_CAST(review_count AS DOUBLE) AS review_count,
               epoch_us(TRY_CAST(signup_date AS TIMESTAMP)) AS signup_us, TRY_CAST(fans AS DOUBLE) AS fans,
               TRY_CAST(average_stars AS DOUBLE) AS average_stars, TRY_CAST(compliment_hot AS DOUBLE) AS compliment_hot,
               TRY_CAST(compliment_photos AS DOUBLE) AS compliment_photos,
               coalesce(trim(elite) NOT IN ('', 'nan'), false) AS is_elite
        FROM raw_users""", ["raw_users"])),
    "load_tips": Check(load_tips, compose("""
        SELECT user_id, business_id, text, epoch_us(TRY_CAST(date AS TIMESTAMP)) AS date,
               TRY_CAST(compliment_count AS DOUBLE) AS compliment_count
        FROM raw_tips""", ["raw_tips"])),
    "load_checkins": Check(load_checkins, compose(
        "SELECT CAST(business_id AS VARCHAR) AS business_id, date FROM checkins", ["checkins"])),
    "cohort_users": Check(run_cohort_users, compose("""
        SELECT user_id, epoch_us(signup_date) AS signup_us, coalesce(trim(elite) NOT IN ('', 'nan'), false) AS is_elite, fans,
               coalesce(compliment_hot, 0) + coalesce(compliment_cool, 0) AS total_compliments
        FROM users WHERE user_id IN (SELECT user_id FROM interactions)""", ["users", "interactions"])),
    "checkin_stats": Check(run_checkin_stats, compose("""
        SELECT business_id, CASE WHEN coalesce(date, '') = '' THEN 0 ELSE len(string_split(date, ', ')) END::BIGINT AS checkin_count,
               epoch_us(TRY_CAST(string_split(date, ', ')[-1] AS TIMESTAMP)) AS last_checkin
        FROM checkins""", ["checkins"])),
    "tip_counts": Check(run_tip_counts, compose(
        "SELECT business_id, count(*) AS tip_count FROM tips GROUP BY business_id", ["tips"])),
    "parquet_artifacts": Check(parquet_artifacts, compose(SPLIT, ["split_interactions"])),
    "report_csv": Check(report_csv, compose("""
        SELECT city, count(business_id) AS business_count, round_even(avg(stars), 2) AS avg_stars,
               round_even(sum(review_count), 2) AS total_reviews
        FROM businesses GROUP BY city ORDER BY business_count DESC, city LIMIT 20""", ["businesses"],
        ["avg_stars", "total_reviews"])),
}
