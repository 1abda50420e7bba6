"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Check, canonical, compose, view
from checks.views import CTES
from palate.functions.text import WHITESPACE_CLASS
from palate.operators import descriptive as d
from palate.sources.jsonl import is_elite

_STOP = ", ".join(f"'{w}'" for w in d.STOPWORDS)


def _on(name, make):
    return lambda spark, sf_dir: canonical(make(view(spark, sf_dir, name)))


def _users(spark, sf_dir):
    return view(spark, sf_dir, "users").withColumn("is_elite", is_elite(F.col("elite")))


def top_reviewed_businesses(spark, sf_dir):
    return canonical(d.top_reviewed_businesses(view(spark, sf_dir, "interactions"), view(spark, sf_dir, "businesses")))


def elite_vs_regular(spark, sf_dir):
    return canonical(d.elite_vs_regular(_users(spark, sf_dir)))


def overview_kpis(spark, sf_dir):
    return canonical(d.overview_kpis(
        view(spark, sf_dir, "businesses"), view(spark, sf_dir, "interactions"), view(spark, sf_dir, "users")))


def over_time(freq):
    return lambda spark, sf_dir: canonical(d.reviews_over_time(view(spark, sf_dir, "interactions"), freq))


def over_time_sql(unit, step):
    extra = {
        "counts": (("interactions",), f"""
            SELECT CAST(date_trunc('{unit}', date) AS DATE) AS period, count(*) AS n FROM interactions GROUP BY 1"""),
        "spine": (("counts",), f"""
            SELECT CAST(unnest(generate_series(min(period), max(period), INTERVAL {step})) AS DATE) AS period FROM counts"""),
    }
    return compose(f"""
        SELECT CAST(period + INTERVAL {step} - INTERVAL 1 DAY AS DATE) AS period_end, coalesce(n, 0) AS n
        FROM spine LEFT JOIN counts USING (period)""", ["spine"], extra=extra)


def geo_center(spark, sf_dir):
    return canonical(d.geo_center(d.geo_sample(view(spark, sf_dir, "businesses"), 500)))


CTES["status"] = (("businesses",), """
    SELECT CASE is_open WHEN 1 THEN 'Open' WHEN 0 THEN 'Closed' END AS status, count(*) AS n
    FROM businesses WHERE is_open IN (0, 1) GROUP BY 1""")


def geo_sql(n):
    return f"""SELECT business_id, name, city, state, stars, review_count, latitude, longitude FROM businesses
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY md5(business_id::VARCHAR || '|42'), business_id {"" if n == "ALL" else f"LIMIT {n}"}"""


CHECKS = {
    "top_categories": Check(_on("businesses", d.top_categories), compose("""
        SELECT category, count(*) AS n
        FROM (SELECT trim(unnest(string_split(categories, ', '))) AS category FROM businesses WHERE categories IS NOT NULL)
        GROUP BY category ORDER BY n DESC, category LIMIT 20""", ["businesses"])),
    "rating_distribution": Check(_on("businesses", d.rating_distribution), compose(
        "SELECT round_even(stars, 1) AS stars, count(*) AS n FROM businesses WHERE stars IS NOT NULL GROUP BY 1",
        ["businesses"], ["stars"])),
    "city_summary": Check(_on("businesses", d.city_summary), compose("""
        SELECT city, count(business_id) AS business_count, round_even(avg(stars), 2) AS avg_stars,
               round_even(sum(review_count), 2) AS total_reviews
        FROM businesses GROUP BY city ORDER BY business_count DESC, city LIMIT 20""", ["businesses"],
        ["avg_stars", "total_reviews"])),
    "open_vs_closed": Check(_on("businesses", d.open_vs_closed), compose("SELECT * FROM status", ["status"])),
    "share_open": Check(_on("businesses", d.share_open), compose(
        "SELECT status, n, n * 100.0 / sum(n) OVER () AS pct FROM status", ["status"], ["pct"])),
    "price_range_dist": Check(_on("businesses", d.price_range_dist), compose("""
        SELECT price, count(business_id) AS n
        FROM (VALUES ('$', '1', '1.0'), ('$$', '2', '2.0'), ('$$$', '3', '3.0'), ('$$$$', '4', '4.0')) l(price, a, b)
        LEFT JOIN businesses ON trim(attr_price, '''" ') IN (a, b) GROUP BY price""", ["businesses"])),
    "reviews_over_time": Check(over_time("ME"), over_time_sql("month", "1 MONTH")),
    "reviews_over_time_quarterly": Check(over_time("QE"), over_time_sql("quarter", "3 MONTH")),
    "reviews_over_time_yearly": Check(over_time("YE"), over_time_sql("year", "12 MONTH")),
    "review_length_stats": Check(_on("reviews", d.review_length_stats), compose("""
        SELECT stars, round_even(avg(length(text)), 1) AS avg_chars, round_even(median(length(text)), 1) AS median_chars,
               count(text) AS n_reviews FROM reviews GROUP BY stars""", ["reviews"], ["avg_chars", "median_chars"])),
    "voting_by_stars": Check(_on("reviews", d.voting_by_stars), compose("""
        SELECT stars, round_even(avg(useful), 3) AS useful, round_even(avg(funny), 3) AS funny, round_even(avg(cool), 3) AS cool
        FROM reviews GROUP BY stars""", ["reviews"], ["useful", "funny", "cool"])),
    "top_reviewed_businesses": Check(top_reviewed_businesses, compose("""
        SELECT t.business_id, t.review_count, name, city, stars
        FROM (SELECT business_id, count(*) AS review_count FROM interactions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15) t
        LEFT JOIN businesses b USING (business_id)""", ["interactions", "businesses"])),
    "user_activity_bins": Check(_on("users", d.user_activity_bins), compose("""
        SELECT CAST(bin AS BIGINT) AS bin, tier, count(user_id) AS n
        FROM (VALUES (1, 0, 1, '1'), (2, 1, 10, '2–10'), (3, 10, 50, '11–50'), (4, 50, 100, '51–100'),
                     (5, 100, 500, '101–500'), (6, 500, 1e18, '500+')) l(bin, low, high, tier)
        LEFT JOIN users ON review_count > low AND review_count <= high GROUP BY bin, tier""", ["users"])),
    "elite_vs_regular": Check(elite_vs_regular, compose("""
        SELECT CASE WHEN coalesce(trim(elite) NOT IN ('', 'nan'), false) THEN 'Elite' ELSE 'Regular' END AS user_type,
               count(user_id) AS n, round_even(avg(review_count), 2) AS avg_reviews,
               round_even(avg(average_stars), 2) AS avg_stars, round_even(avg(fans), 2) AS avg_fans
        FROM users GROUP BY 1""", ["users"], ["avg_reviews", "avg_stars", "avg_fans"])),
    "signup_cohorts": Check(_on("users", d.signup_cohorts), compose(
        "SELECT year(signup_date) AS year, count(*) AS n FROM users WHERE signup_date IS NOT NULL GROUP BY 1", ["users"])),
    "word_freq_by_stars": Check(_on("reviews", d.word_freq_by_stars), compose(f"""
        SELECT stars, word, n, place FROM (
          SELECT stars, word, count(*) AS n, row_number() OVER (PARTITION BY stars ORDER BY count(*) DESC, word) AS place
          FROM (SELECT stars, unnest(regexp_split_to_array(
                  regexp_replace(lower(text), '[^a-z{WHITESPACE_CLASS}]', '', 'g'), '[{WHITESPACE_CLASS}]+')) AS word FROM reviews)
          WHERE length(word) > 2 AND word NOT IN ({_STOP}) GROUP BY stars, word) WHERE place <= 50""", ["reviews"])),
    "polarity": Check(_on("reviews", d.polarity), compose("""
        SELECT CASE WHEN stars >= 4 THEN 'positive' WHEN stars <= 2 THEN 'negative' ELSE 'neutral' END AS polarity, count(*) AS n
        FROM reviews GROUP BY 1""", ["reviews"])),
    "overview_kpis": Check(overview_kpis, compose("""
        SELECT (SELECT count(*) FROM businesses) AS n_businesses, (SELECT count(*) FROM interactions) AS n_reviews,
               (SELECT count(*) FROM users) AS n_users, (SELECT count(DISTINCT city) FROM businesses) AS n_cities""",
        ["businesses", "interactions", "users"])),
    "state_summary": Check(_on("businesses", d.state_summary), compose("""
        SELECT state, count(business_id) AS n, avg(stars) AS avg_stars FROM businesses
        GROUP BY state ORDER BY n DESC, state LIMIT 30""", ["businesses"], ["avg_stars"])),
    "geo_sample": Check(_on("businesses", lambda df: d.geo_sample(df, 500)), compose(geo_sql(500), ["businesses"])),
    "geo_located": Check(_on("businesses", d.geo_sample), compose(geo_sql("ALL"), ["businesses"])),
    "geo_center": Check(geo_center, compose(
        f"SELECT avg(latitude) AS latitude, avg(longitude) AS longitude FROM ({geo_sql(500)})", ["businesses"],
        ["latitude", "longitude"])),
}
