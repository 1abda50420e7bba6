"""Taste profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Check, canonical, compose, view
import checks.features  # noqa: F401  (its CTEs)
from checks.search import _top_sql
from checks.views import CTES
from palate.operators import taste as t
from palate.session import cut_lineage


def mean_vector_sql(rows: str, key: str) -> str:
    """Normalised mean of `vec` per key."""
    return f"""
    SELECT {key}, list_transform(m, lambda x: x / norm) AS vec FROM (
      SELECT {key}, m, sqrt(list_dot_product(m, m)) AS norm FROM (
        SELECT {key}, list(a ORDER BY i) AS m FROM (
          SELECT {key}, i, avg(x) AS a FROM (
            SELECT {key}, unnest(vec::DOUBLE[]) AS x, generate_subscripts(vec, 1) AS i FROM {rows}) GROUP BY 1, 2)
        GROUP BY 1)) WHERE norm > 0"""


def liked_sql(source: str) -> str:
    return f"""SELECT * EXCLUDE (any_liked) FROM (SELECT *, max(CASE WHEN stars >= 4 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS any_liked
               FROM {source}) WHERE stars >= 4 OR any_liked = 0"""


CTES["liked_rows"] = (("interactions",), liked_sql("interactions"))
CTES["liked_events"] = (("event_interactions",), liked_sql("event_interactions"))
CTES["biz_rows"] = (("review_vectors",), "SELECT business_id, embedding AS vec FROM review_vectors")
CTES["biz_vectors"] = (("biz_rows",), mean_vector_sql("biz_rows", "business_id"))
CTES["taste_rows"] = (("liked_events", "biz_vectors"), """
    SELECT user_id, vec FROM (SELECT DISTINCT user_id, business_id FROM liked_events) JOIN biz_vectors USING (business_id)""")
CTES["taste_vectors"] = (("taste_rows",), mean_vector_sql("taste_rows", "user_id"))
CTES["taste_scores"] = (("taste_vectors", "biz_vectors", "event_interactions"), """
    SELECT user_id, business_id, round(list_dot_product(t.vec, b.vec), 9) AS match FROM taste_vectors t, biz_vectors b
    WHERE (user_id, business_id) NOT IN (SELECT DISTINCT user_id, business_id FROM event_interactions)""")
CTES["liked_visits"] = (("liked_rows", "enriched"), """
    SELECT user_id, l.business_id, l.stars, name, city, categories,
           TRY_CAST(trunc(TRY_CAST(trim(attr_price, '''" ') AS DOUBLE)) AS INTEGER) AS price
    FROM liked_rows l JOIN enriched b USING (business_id) WHERE name IS NOT NULL""")


def _top(value: str, n: int, rows: str, out: str) -> str:
    return f"""SELECT user_id, string_agg({value}, '|' ORDER BY p) AS {out} FROM (
        SELECT user_id, {value}, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {value}) AS p
        FROM {rows} GROUP BY user_id, {value}) WHERE p <= {n} GROUP BY user_id"""


CTES["visit_labels"] = (("liked_visits",), """
    SELECT * FROM (SELECT user_id, trim(unnest(string_split(categories, ','))) AS category FROM liked_visits)
    WHERE category NOT IN ('Restaurants', 'Food', 'Nightlife', 'Bars', 'Event Planning & Services', '')""")
CTES["stats"] = (("interactions", "liked_rows", "liked_visits", "visit_labels", "businesses"), f"""
    WITH acts AS (SELECT user_id, count(*) AS n_reviews, round_even(avg(stars), 2) AS avg_stars FROM interactions GROUP BY 1),
    cats AS ({_top('category', 5, 'visit_labels', 'top_categories')}),
    cities AS ({_top('city', 3, '(SELECT * FROM liked_visits WHERE city IS NOT NULL)', 'top_cities')}),
    prices AS (SELECT user_id, price FROM (SELECT user_id, price, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, price) AS p
               FROM liked_visits WHERE price IS NOT NULL GROUP BY 1, 2) WHERE p = 1),
    favs AS (SELECT user_id, string_agg(name, '|' ORDER BY p) AS favorites FROM (
               SELECT user_id, business_id, row_number() OVER (PARTITION BY user_id ORDER BY max(stars) DESC, business_id) AS p
               FROM liked_rows GROUP BY 1, 2) JOIN businesses USING (business_id) WHERE p <= 5 AND name IS NOT NULL GROUP BY 1)
    SELECT user_id, n_reviews, avg_stars, coalesce(top_categories, '') AS top_categories,
           coalesce(repeat('$', price), 'n/a') AS price_pref, coalesce(top_cities, '') AS top_cities, coalesce(favorites, '') AS favorites
    FROM acts LEFT JOIN cats USING (user_id) LEFT JOIN cities USING (user_id) LEFT JOIN prices USING (user_id) LEFT JOIN favs USING (user_id)""")


def _exploded(df, key):
    return canonical(df.select(key, F.posexplode("vec").alias("i", "x")))


def _business_vectors(spark, sf_dir):
    return cut_lineage(t.business_vectors(view(spark, sf_dir, "review_vectors")))


def liked(spark, sf_dir):
    rows = t.liked(view(spark, sf_dir, "interactions"))
    return canonical(rows.withColumn("date", F.col("date").cast("date")))


def business_vectors(spark, sf_dir):
    return _exploded(_business_vectors(spark, sf_dir), "business_id")


def taste_vector(spark, sf_dir):
    tastes = t.taste_vector(view(spark, sf_dir, "event_interactions"), _business_vectors(spark, sf_dir))
    return _exploded(tastes, "user_id")


def recommend_by_taste(spark, sf_dir):
    return canonical(t.recommend_by_taste(
        view(spark, sf_dir, "event_interactions"), _business_vectors(spark, sf_dir), view(spark, sf_dir, "businesses")))


def _stats(spark, sf_dir):
    return t.profile_stats(view(spark, sf_dir, "interactions"), view(spark, sf_dir, "businesses"))


def profile_stats(spark, sf_dir):
    joined = {c: F.array_join(c, "|") for c in ("top_categories", "top_cities", "favorites")}
    return canonical(_stats(spark, sf_dir).withColumns(joined))


def profile_text(spark, sf_dir):
    return t.profile_text(_stats(spark, sf_dir))


CHECKS = {
    "liked": Check(liked, compose(
        "SELECT user_id, business_id, stars, CAST(date AS DATE) AS date, review_len, useful FROM liked_rows", ["liked_rows"])),
    "business_vectors": Check(business_vectors, compose(
        "SELECT business_id, generate_subscripts(vec, 1) - 1 AS i, unnest(vec) AS x FROM biz_vectors", ["biz_vectors"], ["x"])),
    "taste_vector": Check(taste_vector, compose(
        "SELECT user_id, generate_subscripts(vec, 1) - 1 AS i, unnest(vec) AS x FROM taste_vectors", ["taste_vectors"], ["x"])),
    "recommend_by_taste": Check(recommend_by_taste, compose("""
        SELECT user_id, rank, business_id, name, city, stars, categories, match
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY match DESC, business_id) AS rank FROM taste_scores)
        LEFT JOIN businesses USING (business_id) WHERE rank <= 10""", ["taste_scores", "businesses"], ["match"])),
    "profile_stats": Check(profile_stats, compose("SELECT * FROM stats", ["stats"], ["avg_stars"])),
    "profile_text": Check(profile_text, compose("""
        SELECT user_id, 'You''re ' || CASE WHEN avg_stars < 3.5 THEN 'a tough grader' WHEN avg_stars >= 4.2 THEN 'an enthusiastic regular'
                ELSE 'a balanced reviewer' END || ' who has reviewed ' || n_reviews || ' places, averaging ' || avg_stars::VARCHAR
               || '★. You gravitate toward ' || CASE WHEN top_categories = '' THEN 'a wide range of places'
                  ELSE array_to_string(string_split(top_categories, '|')[1:3], ', ') END
               || ', usually around ' || price_pref || ' in ' || CASE WHEN top_cities = '' THEN 'your area'
                  ELSE array_to_string(string_split(top_cities, '|')[1:2], ' and ') END || '.'
               || CASE WHEN favorites = '' THEN '' ELSE ' Your go-to spots include ' ||
                  array_to_string(string_split(favorites, '|')[1:3], '; ') || '.' END AS profile
        FROM stats""", ["stats"])),
}
