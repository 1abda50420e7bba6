"""Cohort preparation end to end: businesses and split interactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from palate.config import Settings
from palate.operators.cohort import cohort_reviews, kcore, select_businesses, surviving_businesses, temporal_split
from palate.sources.artifacts import write_artifact


@dataclass(frozen=True)
class Cohort:
    businesses: DataFrame
    interactions: DataFrame  # with split


def prepare_cohort(businesses: DataFrame, reviews: DataFrame, settings: Settings = Settings()) -> Cohort:
    """`reviews` carries the text; only its length is kept."""
    chosen = select_businesses(businesses, settings.cities, settings.n_auto_cities, settings.dining)
    return prune_and_split(chosen, cohort_reviews(reviews, chosen), settings)


def prune_and_split(businesses: DataFrame, interactions: DataFrame, settings: Settings = Settings()) -> Cohort:
    """k-core, chronological split and surviving businesses of an already projected interaction table."""
    core = kcore(interactions, settings.min_user_reviews, settings.min_business_reviews)
    split = temporal_split(core, settings.train_frac, settings.valid_frac)
    return Cohort(surviving_businesses(businesses, core), split)


def write_cohort(cohort: Cohort, folder: str) -> tuple[str, str]:
    """Interactions go out partitioned by split, so later steps read only the splits they need."""
    return (
        write_artifact(cohort.businesses, f"{folder}/businesses"),
        write_artifact(cohort.interactions, f"{folder}/interactions", partition_by=("split",)),
    )
