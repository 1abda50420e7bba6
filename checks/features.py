"""Feature tables over a history window."""

from __future__ import annotations

from pyspark.sql import functions as F

import checks.prepare  # noqa: F401  (its CTEs)
from checks.common import Check, canonical, compose, view
from checks.views import CTES
from palate.operators import features as f
from palate.operators.cohort import temporal_split
from palate.session import cut_lineage

AMENITY_SQL = {
    "b_takeout": "attr_takeout", "b_delivery": "attr_delivery", "b_groups": "attr_groups",
    "b_reservations": "attr_reservations", "b_cards": "attr_cards",
}

CTES["enriched"] = (("businesses",), """
    SELECT *, coalesce(TRY_CAST(trunc(TRY_CAST(trim(attr_price, '''" ') AS DOUBLE)) AS INTEGER), -1) AS price_range,
           CASE WHEN coalesce(categories, '') = '' THEN 'Unknown'
                ELSE coalesce(list_filter(parts, lambda c: c NOT IN ('Restaurants', 'Food'))[1], parts[1]) END AS primary_category
    FROM (SELECT *, list_transform(string_split(categories, ','), lambda c: trim(c)) AS parts FROM businesses)""")
CTES["elite_users"] = (("users",), """
    SELECT user_id, signup_date, coalesce(trim(elite) NOT IN ('', 'nan'), false) AS is_elite, fans,
           coalesce(compliment_hot, 0) + coalesce(compliment_cool, 0) AS total_compliments FROM users""")
CTES["checkin_counts"] = (("checkins",), """
    SELECT business_id, CASE WHEN coalesce(date, '') = '' THEN 0 ELSE len(string_split(date, ', ')) END AS checkin_count
    FROM checkins""")
CTES["tip_totals"] = (("tips",), "SELECT business_id, count(*) AS tip_count FROM tips GROUP BY business_id")


def days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def user_sql(history: str) -> str:
    return f"""
    WITH visits AS (SELECT h.*, b.review_count AS rc, b.stars AS gs, CASE WHEN b.price_range > 0 THEN b.price_range END AS price,
                           b.city, b.primary_category FROM {history} h LEFT JOIN enriched b USING (business_id)),
    acts AS (SELECT user_id, count(*) AS n, avg(stars) AS avg_stars, coalesce(stddev_samp(stars), 0) AS std_stars,
                    avg(CASE WHEN stars >= 4 THEN 1.0 ELSE 0.0 END) AS pct, avg(review_len) AS len,
                    count(DISTINCT business_id) AS nb, avg(rc) AS pop, avg(gs) AS gs, avg(price) AS price,
                    {days('max(date)', 'min(date)')} AS active
             FROM visits GROUP BY user_id),
    cities AS (SELECT user_id, city FROM (SELECT user_id, city, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, city) AS p
               FROM visits WHERE city IS NOT NULL GROUP BY user_id, city) WHERE p = 1),
    cats AS (SELECT user_id, primary_category FROM (SELECT user_id, primary_category,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, primary_category) AS p
               FROM visits WHERE primary_category IS NOT NULL GROUP BY user_id, primary_category) WHERE p = 1)
    SELECT a.user_id, n AS u_n_reviews, avg_stars AS u_avg_stars, std_stars AS u_std_stars, pct AS u_pct_positive,
           len AS u_avg_review_len, nb AS u_n_distinct_biz, pop AS u_avg_biz_pop, gs AS u_avg_biz_stars,
           coalesce(price, (SELECT quantile_cont(price, 0.5) FROM acts)) AS u_avg_price, active AS u_active_days,
           n / (active / 30.0 + 1.0) AS u_reviews_per_month, coalesce(c.city, 'Unknown') AS u_modal_city,
           coalesce(k.primary_category, 'Unknown') AS u_top_cat,
           CASE WHEN signup_date IS NOT NULL THEN greatest({days(f'(SELECT max(date) FROM {history})', 'signup_date')}, 0) END AS u_account_age_days,
           coalesce(CAST(is_elite AS INTEGER), 0) AS u_is_elite, coalesce(fans, 0) AS u_fans,
           coalesce(total_compliments, 0) AS u_total_compliments
    FROM acts a LEFT JOIN cities c USING (user_id) LEFT JOIN cats k USING (user_id) LEFT JOIN elite_users u USING (user_id)"""


def business_sql(history: str) -> str:
    amenities = ", ".join(
        f"CASE WHEN lower(trim({column})) = 'true' THEN 1 ELSE 0 END::BIGINT AS {name}" for name, column in AMENITY_SQL.items()
    )
    return f"""
    WITH acts AS (SELECT business_id, count(*) AS n, avg(stars) AS avg_stars, coalesce(stddev_samp(stars), 0) AS std_stars,
                    avg(CASE WHEN stars >= 4 THEN 1.0 ELSE 0.0 END) AS pct, avg(review_len) AS len, avg(useful) AS useful,
                    {days(f'(SELECT max(date) FROM {history})', 'min(date)')} AS age
             FROM {history} GROUP BY business_id)
    SELECT a.business_id, n AS b_n_reviews, avg_stars AS b_avg_stars, std_stars AS b_std_stars, pct AS b_pct_positive,
           len AS b_avg_review_len, useful AS b_useful_per_rev, age AS b_age_days, n / (age / 30.0 + 1.0) AS b_reviews_per_month,
           stars AS b_global_stars, review_count AS b_global_review_count, coalesce(is_open, 0) AS b_is_open,
           CAST(price_range AS BIGINT) AS b_price_range,
           coalesce(len(list_filter(parts, lambda c: c <> '')), 0) AS b_n_categories,
           city AS b_city, primary_category AS b_primary_category, {amenities},
           coalesce(checkin_count, 0) AS b_checkin_count, coalesce(checkin_count, 0) / (age / 30.0 + 1.0) AS b_checkin_per_month,
           coalesce(tip_count, 0) AS b_tip_count,
           (rank() OVER (ORDER BY n) - 1 + (count(*) OVER (PARTITION BY n) + 1) / 2.0) / count(*) OVER () AS b_pop_percentile
    FROM acts a LEFT JOIN enriched USING (business_id) LEFT JOIN checkin_counts USING (business_id)
    LEFT JOIN tip_totals USING (business_id)"""


USER_DOUBLES = ["u_avg_stars", "u_std_stars", "u_pct_positive", "u_avg_review_len", "u_avg_biz_pop", "u_avg_biz_stars",
                "u_avg_price", "u_reviews_per_month", "u_is_elite", "u_fans", "u_total_compliments"]
BUSINESS_DOUBLES = ["b_avg_stars", "b_std_stars", "b_pct_positive", "b_avg_review_len", "b_useful_per_rev",
                    "b_reviews_per_month", "b_global_stars", "b_global_review_count", "b_is_open", "b_checkin_count",
                    "b_checkin_per_month", "b_tip_count", "b_pop_percentile"]

USER_NEEDS = ("enriched", "elite_users")
BUSINESS_NEEDS = ("enriched", "checkin_counts", "tip_totals")
CTES["history"] = (("split_interactions",), "SELECT * FROM split_interactions WHERE split IN ('train', 'valid')")
CTES["test_rows"] = (("split_interactions",), "SELECT * FROM split_interactions WHERE split = 'test'")
CTES["event_history"] = (("split_events",), "SELECT * FROM split_events WHERE split IN ('train', 'valid')")
CTES["event_test"] = (("split_events",), "SELECT * FROM split_events WHERE split = 'test'")
CTES["uf"] = (("history", *USER_NEEDS), user_sql("history"))
CTES["bf"] = (("history", *BUSINESS_NEEDS), business_sql("history"))
CTES["event_uf"] = (("event_history", *USER_NEEDS), user_sql("event_history"))
CTES["event_bf"] = (("event_history", *BUSINESS_NEEDS), business_sql("event_history"))


def split_windows(spark, sf_dir, source="interactions"):
    """(history, test) of the chronological split, kept as the preparation step keeps it."""
    rows = cut_lineage(temporal_split(view(spark, sf_dir, source)))
    return rows.where(F.col("split").isin("train", "valid")), rows.where(F.col("split") == "test")


def tables(spark, sf_dir, history, targets=None):
    places = f.enrich_businesses(view(spark, sf_dir, "businesses"))
    users = f.cohort_users(view(spark, sf_dir, "users"), history)
    stamps = f.checkin_stats(view(spark, sf_dir, "checkins"))
    tips = f.tip_counts(view(spark, sf_dir, "tips"))
    return f.user_features(history, places, users, only=targets), f.business_features(history, places, stamps, tips)


def _features(which, source):
    def run(spark, sf_dir):
        history, _ = split_windows(spark, sf_dir, source)
        return canonical(tables(spark, sf_dir, history)[which])

    return run


def enrich_businesses(spark, sf_dir):
    df = f.enrich_businesses(view(spark, sf_dir, "businesses"))
    return canonical(df.select("business_id", "price_range", "primary_category"))


def pop_percentile(spark, sf_dir):
    counts = view(spark, sf_dir, "interactions").groupBy("business_id").agg(F.count(F.lit(1)).alias("b_n_reviews"))
    return canonical(f.pop_percentile(counts))


CROSS_SQL = """u_avg_stars - b_avg_stars AS star_gap,
    CASE WHEN b_price_range > 0 THEN coalesce(abs(u_avg_price - b_price_range), 0) ELSE 0 END AS price_gap,
    CAST(coalesce(b_city = u_modal_city, false) AS BIGINT) AS same_city,
    CAST(coalesce(b_primary_category = u_top_cat, false) AS BIGINT) AS same_top_cat"""


def cross_features(spark, sf_dir):
    history, test = split_windows(spark, sf_dir)
    users, places = tables(spark, sf_dir, history)
    pairs = test.select("user_id", "business_id").distinct().join(users, "user_id").join(places, "business_id")
    return canonical(f.cross_features(pairs).select(
        "user_id", "business_id", "star_gap", "price_gap", "same_city", "same_top_cat"))


CHECKS = {
    "enrich_businesses": Check(enrich_businesses, compose(
        "SELECT business_id, CAST(price_range AS BIGINT) AS price_range, primary_category FROM enriched", ["enriched"])),
    "user_features": Check(_features(0, "interactions"), compose("SELECT * FROM uf", ["uf"], USER_DOUBLES)),
    "user_features_events": Check(_features(0, "event_interactions"), compose("SELECT * FROM event_uf", ["event_uf"], USER_DOUBLES)),
    "business_features": Check(_features(1, "interactions"), compose("SELECT * FROM bf", ["bf"], BUSINESS_DOUBLES)),
    "business_features_events": Check(_features(1, "event_interactions"), compose("SELECT * FROM event_bf", ["event_bf"], BUSINESS_DOUBLES)),
    "pop_percentile": Check(pop_percentile, compose("""
        SELECT business_id, n AS b_n_reviews,
               (rank() OVER (ORDER BY n) - 1 + (count(*) OVER (PARTITION BY n) + 1) / 2.0) / count(*) OVER () AS b_pop_percentile
        FROM (SELECT business_id, count(*) AS n FROM interactions GROUP BY business_id)""", ["interactions"], ["b_pop_percentile"])),
    "cross_features": Check(cross_features, compose(f"""
        SELECT user_id, business_id, {CROSS_SQL}
        FROM (SELECT DISTINCT user_id, business_id FROM test_rows) JOIN uf USING (user_id) JOIN bf USING (business_id)""",
        ["test_rows", "uf", "bf"], ["star_gap", "price_gap"])),
}
