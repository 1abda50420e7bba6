"""The descriptive report: every statistic as its own lazy DataFrame over shared inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from palate.operators import descriptive as d
from palate.sources.artifacts import write_report


def descriptive_report(businesses: DataFrame, reviews: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    return {
        "top_categories": d.top_categories(businesses),
        "rating_distribution": d.rating_distribution(businesses),
        "city_summary": d.city_summary(businesses),
        "open_vs_closed": d.open_vs_closed(businesses),
        "share_open": d.share_open(businesses),
        "price_range_dist": d.price_range_dist(businesses),
        "state_summary": d.state_summary(businesses),
        "geo_sample": d.geo_sample(businesses),
        "reviews_over_time": d.reviews_over_time(reviews),
        "review_length_stats": d.review_length_stats(reviews),
        "voting_by_stars": d.voting_by_stars(reviews),
        "top_reviewed_businesses": d.top_reviewed_businesses(reviews, businesses),
        "word_freq_by_stars": d.word_freq_by_stars(reviews, n=80),
        "polarity": d.polarity(reviews),
        "user_activity_bins": d.user_activity_bins(users),
        "elite_vs_regular": d.elite_vs_regular(users),
        "signup_cohorts": d.signup_cohorts(users),
        "overview_kpis": d.overview_kpis(businesses, reviews, users),
    }


def write_descriptive_report(report: dict[str, DataFrame], folder: str) -> None:
    for name, table in report.items():
        write_report(table, f"{folder}/{name}")
