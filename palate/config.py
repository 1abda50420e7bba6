"""All knobs in one frozen dataclass; every operator takes them as plain arguments."""

from __future__ import annotations

from dataclasses import dataclass

# Cohort metros, dining categories, star gains.
CITIES = ("Philadelphia", "Tampa", "Indianapolis", "Nashville", "New Orleans")
DINING_CATEGORIES = ("Restaurants", "Food")
STAR_TO_GAIN = {1.0: 0, 2.0: 0, 3.0: 1, 4.0: 2, 5.0: 3}


@dataclass(frozen=True)
class Settings:
    """Defaults are fixed values of the task; a sample size of None keeps every row."""

    seed: int = 42

    # cohort; cities=None picks the busiest metros from the data
    cities: tuple[str, ...] | None = CITIES
    n_auto_cities: int = 5
    dining: tuple[str, ...] = DINING_CATEGORIES
    min_user_reviews: int = 5
    min_business_reviews: int = 10
    train_frac: float = 0.70
    valid_frac: float = 0.15
    positive_stars: float = 4.0
    as_of: str | None = None  # check-ins and tips after this instant are unknown to the features

    # candidate generation
    als_factors: int = 96
    als_iterations: int = 20
    als_regularization: float = 0.05
    als_alpha: float = 12.0
    n_candidates: int = 100

    # reranking
    eval_k: int = 10
    rank_train_users: int = 20_000
    rank_eval_users: int | None = None
    fit_share: float = 0.85
    rank_rounds: int = 600
    rank_learning_rate: float = 0.05
    rank_max_leaves: int = 63
    rank_max_depth: int | None = None
    rank_min_rows: int = 100
    rank_row_share: float = 0.8
    rank_column_share: float = 0.8
    rank_l2: float = 1.0
    rank_patience: int = 40
    rank_truncation: int | None = 30
    attribution_rows: int | None = None
    demo_users: int | None = None

    # review corpus and vector search
    min_chars: int = 40
    max_chars: int | None = None  # whole texts; 1500 gives the short-text corpus
    per_business_reviews: int | None = None
    corpus_reviews: int | None = None
    n_pairs: int = 25_000
    eval_share: float = 0.15
    eval_queries: int | None = None
    search_pool: int | None = None
    snippet_chars: int = 160
    encoder: str = "learnt"  # or "hashed": term frequencies in as many buckets as the dimension
    encoder_dim: int = 256
    adapt_epochs: int = 3  # contrastive passes after the closed form
