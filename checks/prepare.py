"""Cohort preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Check, canonical, compose, view
from checks.views import CTES
from palate.config import Settings
from palate.functions.numbers import micros
from palate.operators import cohort
from palate.plans.prepare import prepare_cohort

KCORE_USER, KCORE_ITEM = 20, 25
KCORE_PASSES = 10

SPLIT = """SELECT user_id, business_id, stars, CAST(date AS DATE) AS date, review_len, useful, split FROM split_interactions"""


def split_sql(source: str) -> str:
    """Chronological split of a table that has a `date`."""
    return f"""
    SELECT s.*, CASE WHEN epoch_us(date) <= a THEN 'train' WHEN epoch_us(date) <= b THEN 'valid' ELSE 'test' END AS split
    FROM {source} s, (SELECT quantile_cont(epoch_us(date), 0.70) AS a, quantile_cont(epoch_us(date), 0.85) AS b FROM {source})"""


def kcore_ctes(source: str, min_user: int, min_item: int, prefix: str) -> dict:
    """The fixpoint unrolled; the last CTE is `<prefix>_core`."""
    ctes, before = {}, source
    for i in range(KCORE_PASSES):
        users, items = f"{prefix}_u{i}", f"{prefix}_i{i}"
        ctes[users] = ((before,), f"SELECT * FROM {before} WHERE user_id IN "
                       f"(SELECT user_id FROM {before} GROUP BY user_id HAVING count(*) >= {min_user})")
        ctes[items] = ((users,), f"SELECT * FROM {users} WHERE business_id IN "
                       f"(SELECT business_id FROM {users} GROUP BY business_id HAVING count(*) >= {min_item})")
        before = items
    ctes[f"{prefix}_core"] = ((before,), f"SELECT * FROM {before}")
    return ctes


DINING = "categories LIKE '%Restaurants%' OR categories LIKE '%Food%'"
CTES["split_interactions"] = (("interactions",), split_sql("interactions"))
CTES["split_events"] = (("event_interactions",), split_sql("event_interactions"))
CTES["dining"] = (("businesses",), f"SELECT * FROM businesses WHERE {DINING}")
CTES["busy_cities"] = (("dining",), "SELECT city, count(*) AS n_businesses FROM dining GROUP BY city ORDER BY 2 DESC, 1 LIMIT 5")
CTES["selected"] = (("dining", "busy_cities"), "SELECT * FROM dining WHERE city IN (SELECT city FROM busy_cities)")
CTES["cohort_rows"] = (("order_reviews", "selected"), """
    SELECT user_id, business_id, stars, date, CAST(length(text) AS BIGINT) AS review_len, useful
    FROM order_reviews WHERE business_id IN (SELECT business_id FROM selected)""")
CTES.update(kcore_ctes("interactions", KCORE_USER, KCORE_ITEM, "k"))
CTES.update(kcore_ctes("cohort_rows", 5, 10, "c"))
CTES["cohort_split"] = (("c_core",), split_sql("c_core"))

BUSINESS_COLUMNS = "business_id, name, city, state, stars, review_count, categories"
_business_columns = BUSINESS_COLUMNS.split(", ")


def dining_filter(spark, sf_dir):
    return canonical(cohort.dining_filter(view(spark, sf_dir, "businesses")).select(*_business_columns))


def select_businesses(spark, sf_dir):
    chosen = cohort.select_businesses(view(spark, sf_dir, "businesses"), cities=("NATION_0", "NATION_7", "NATION_13"))
    return canonical(chosen.select(*_business_columns))


def auto_cities(spark, sf_dir):
    return canonical(cohort.auto_cities(cohort.dining_filter(view(spark, sf_dir, "businesses"))))


def cohort_reviews(spark, sf_dir):
    chosen = cohort.select_businesses(view(spark, sf_dir, "businesses"))
    rows = cohort.cohort_reviews(view(spark, sf_dir, "order_reviews"), chosen)
    return canonical(rows.withColumn("date", F.col("date").cast("date")))


def kcore(spark, sf_dir):
    core = cohort.kcore(view(spark, sf_dir, "interactions"), KCORE_USER, KCORE_ITEM)
    return canonical(core.withColumn("date", F.col("date").cast("date")))


def temporal_split(spark, sf_dir):
    split = cohort.temporal_split(view(spark, sf_dir, "interactions"))
    return canonical(split.withColumn("date", F.col("date").cast("date")))


def temporal_split_events(spark, sf_dir):
    split = cohort.temporal_split(view(spark, sf_dir, "event_interactions"))
    return canonical(split.select("user_id", "business_id", "stars", micros(F.col("date")).cast("long").alias("instant"), "review_len", "useful", "split"))


def surviving_businesses(spark, sf_dir):
    core = cohort.kcore(view(spark, sf_dir, "interactions"), KCORE_USER, KCORE_ITEM)
    return canonical(cohort.surviving_businesses(view(spark, sf_dir, "businesses"), core).select(*_business_columns))


def _cohort(spark, sf_dir):
    return prepare_cohort(view(spark, sf_dir, "businesses"), view(spark, sf_dir, "order_reviews"), Settings(cities=None))


def run_prepare_cohort(spark, sf_dir):
    return canonical(_cohort(spark, sf_dir).interactions.withColumn("date", F.col("date").cast("date")))


def prepare_cohort_businesses(spark, sf_dir):
    return canonical(_cohort(spark, sf_dir).businesses.select(*_business_columns))


def split_counts(spark, sf_dir):
    return canonical(cohort.split_counts(cohort.temporal_split(view(spark, sf_dir, "interactions"))))


_ROWS = "SELECT user_id, business_id, stars, CAST(date AS DATE) AS date, review_len, useful"
_BY_KCORE = f"{BUSINESS_COLUMNS} FROM businesses WHERE business_id IN"

CHECKS = {
    "dining_filter": Check(dining_filter, compose(f"SELECT {BUSINESS_COLUMNS} FROM dining", ["dining"])),
    "select_businesses": Check(select_businesses, compose(
        f"SELECT {BUSINESS_COLUMNS} FROM dining WHERE city IN ('NATION_0', 'NATION_7', 'NATION_13')", ["dining"])),
    "auto_cities": Check(auto_cities, compose("SELECT * FROM busy_cities", ["busy_cities"])),
    "cohort_reviews": Check(cohort_reviews, compose(f"{_ROWS} FROM cohort_rows", ["cohort_rows"])),
    "kcore": Check(kcore, compose(f"{_ROWS} FROM k_core", ["k_core"])),
    "temporal_split": Check(temporal_split, compose(SPLIT, ["split_interactions"])),
    "temporal_split_events": Check(temporal_split_events, compose(
        "SELECT user_id, business_id, stars, epoch_us(date) AS instant, review_len, useful, split FROM split_events", ["split_events"], ["stars"])),
    "surviving_businesses": Check(surviving_businesses, compose(
        f"SELECT {_BY_KCORE} (SELECT business_id FROM k_core)", ["businesses", "k_core"])),
    "prepare_cohort": Check(run_prepare_cohort, compose(f"{_ROWS}, split FROM cohort_split", ["cohort_split"])),
    "prepare_cohort_businesses": Check(prepare_cohort_businesses, compose(
        f"SELECT {BUSINESS_COLUMNS} FROM selected WHERE business_id IN (SELECT business_id FROM c_core)",
        ["selected", "c_core"])),
    "split_counts": Check(split_counts, compose("""
        SELECT split, count(*) AS n_rows, count(DISTINCT user_id) AS n_users, count(DISTINCT business_id) AS n_businesses
        FROM split_interactions GROUP BY split""", ["split_interactions"])),
}
