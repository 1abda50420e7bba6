"""Two-stage recommender: train on the past, label from the next window, compare on the last one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from palate.config import Settings
from palate.operators.als import AlsFactors, als_candidates, als_fit, als_score_pairs
from palate.operators.candidates import (
    demo_recs, fit_stop_split, inject_positives, rank_als, rank_popularity, ranking_frame, relevance, target_users,
)
from palate.operators.evaluate import comparison_table, evaluate_rankings, method_lift
from palate.operators.features import (
    business_features, checkin_stats, cohort_users, enrich_businesses, tip_counts, user_features,
)
from palate.operators.rerank import RankerModel, feature_importance, rank_ltr, ranker_attribution, train_ranker
from palate.plans.stages import Stages
from palate.session import keep_table
from palate.sources.artifacts import write_artifact, write_report

POPULARITY, COLLABORATIVE, TWO_STAGE = "popularity", "als", "two-stage"
STATIC = ("businesses", "users", "checkins", "tips")
# the settings that a stage reads
ALS_KNOBS = ("als_factors", "als_iterations", "als_regularization", "als_alpha", "seed")
FRAME_KNOBS = ("n_candidates", "as_of", "positive_stars")
RANKER_KNOBS = (
    "rank_rounds", "rank_learning_rate", "rank_max_leaves", "rank_max_depth", "rank_min_rows", "rank_row_share",
    "rank_column_share", "rank_l2", "rank_patience", "rank_truncation", "eval_k", "seed",
)


@dataclass(frozen=True)
class Recommender:
    model: RankerModel
    test_frame: DataFrame
    results: dict[str, DataFrame]
    comparison: DataFrame
    lift: DataFrame
    demo: DataFrame
    importance: DataFrame
    attribution: DataFrame
    ran: tuple[str, ...]  # stages that this run computed


@dataclass(frozen=True)
class StaticTables:
    """Whole-dump tables: businesses as loaded, users, check-ins (business_id, date list) and tips."""

    businesses: DataFrame
    users: DataFrame
    checkins: DataFrame
    tips: DataFrame


def feature_tables(
    history: DataFrame, static: StaticTables, targets: DataFrame | None = None, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """User features (of the targets, if given) and features of every business in the window."""
    cut = None if settings.as_of is None else F.lit(settings.as_of).cast("timestamp")
    businesses = enrich_businesses(static.businesses)
    users = cohort_users(static.users, history if targets is None else targets)
    return (
        user_features(history, businesses, users, positive=settings.positive_stars, only=targets),
        business_features(
            history, businesses, checkin_stats(static.checkins, cut), tip_counts(static.tips, cut), settings.positive_stars),
    )


def als_frame(
    factors: AlsFactors, targets: DataFrame, history: DataFrame, labels: DataFrame, static: StaticTables, settings: Settings, inject: bool
) -> DataFrame:
    """Ranking frame of ALS candidates, with the label positives added when `inject` is set (training)."""
    candidates = als_candidates(factors, targets, history, settings.n_candidates)
    if inject:
        candidates = keep_table(candidates, "candidates")
        positives = als_score_pairs(factors, relevance(labels, targets))
        candidates = inject_positives(candidates, positives, settings.n_candidates)
    return ranking_frame(candidates, labels, *feature_tables(history, static, targets, settings))


def fit_factors(history: DataFrame, settings: Settings) -> AlsFactors:
    return als_fit(
        history, settings.als_factors, settings.als_iterations, settings.als_regularization, settings.als_alpha, settings.seed)


def fit_ranker(frame: DataFrame, settings: Settings) -> RankerModel:
    """`frame` carries `part`: fit or stop."""
    return train_ranker(
        frame.where(F.col("part") == "fit").drop("part"),
        frame.where(F.col("part") == "stop").drop("part"),
        rounds=settings.rank_rounds, learning_rate=settings.rank_learning_rate, max_leaves=settings.rank_max_leaves,
        max_depth=settings.rank_max_depth, min_rows=settings.rank_min_rows, row_share=settings.rank_row_share,
        column_share=settings.rank_column_share, l2=settings.rank_l2, patience=settings.rank_patience,
        truncation=settings.rank_truncation, k=settings.eval_k, seed=settings.seed,
    )


def train_recommender(
    interactions: DataFrame, static: StaticTables, settings: Settings = Settings(), folder: str | None = None
) -> Recommender:
    """`interactions` carries `split`; the final comparison uses train + valid history and test labels.

    With a folder, every stage is kept there under the fingerprint of its inputs and settings: a run that was cut off goes
    on after the last finished stage, and a changed setting repeats only the stages that read it.
    """
    split = F.col("split")
    train, valid, test = (interactions.where(split == name) for name in ("train", "valid", "test"))
    history = interactions.where(split.isin("train", "valid"))
    tables = {name: getattr(static, name) for name in STATIC}
    stages = Stages(interactions.sparkSession, settings, folder, interactions=interactions, **tables)

    def factors(name: str, window: DataFrame) -> AlsFactors:
        def build() -> list[DataFrame]:
            fitted = fit_factors(window, settings)
            return [fitted.users, fitted.items]

        return AlsFactors(*stages.tables(name, ["users", "items"], build, ["interactions"], ALS_KNOBS))

    # features and candidates from train, labels from valid
    parts = stages.table(
        "fit_targets",
        lambda: fit_stop_split(target_users(valid, train, settings.rank_train_users, settings.seed), settings.fit_share, settings.seed),
        ["interactions"], ["rank_train_users", "fit_share", "seed"])
    fitted = factors("fit_factors", train)
    fit_frame = stages.table(
        "fit_frame",
        lambda: als_frame(fitted, parts.select("user_id"), train, valid, static, settings, inject=True).join(parts, "user_id"),
        ["interactions", *STATIC, "fit_targets", "fit_factors"], FRAME_KNOBS)
    if folder is None:
        model = fit_ranker(fit_frame, settings)
    else:
        path = stages.run(
            "ranker", lambda path: fit_ranker(fit_frame, settings).save(stages.spark, f"{path}/model"), ["fit_frame"], RANKER_KNOBS)
        model = RankerModel.load(stages.spark, f"{path}/model")

    targets = stages.table(
        "test_targets", lambda: target_users(test, history, settings.rank_eval_users, settings.seed), ["interactions"], ["rank_eval_users", "seed"])
    known = factors("test_factors", history)
    frame = stages.table(
        "test_frame", lambda: als_frame(known, targets, history, test, static, settings, inject=False),
        ["interactions", *STATIC, "test_targets", "test_factors"], FRAME_KNOBS)
    relevant = relevance(test, targets)
    ranked = ["test_frame"] if folder is None else ["test_frame", "ranker"]
    n_rows = frame.count()
    rankings = {
        POPULARITY: rank_popularity(frame, n_rows),
        COLLABORATIVE: rank_als(frame, n_rows),
        TWO_STAGE: stages.table("two_stage_ranks", lambda: rank_ltr(frame, model), ranked),
    }
    results = {
        name: stages.table(
            f"result_{name}", lambda ranks=ranks: evaluate_rankings(ranks, relevant, settings.eval_k),
            ["interactions", "test_targets", "two_stage_ranks" if name == TWO_STAGE else "test_frame"], ["eval_k"])
        for name, ranks in rankings.items()}
    return Recommender(
        model=model,
        test_frame=frame,
        results=results,
        comparison=comparison_table(results),
        lift=method_lift(results, TWO_STAGE, COLLABORATIVE),
        demo=demo_recs(rankings[TWO_STAGE], relevant, static.businesses, settings.demo_users, settings.eval_k),
        importance=feature_importance(model, frame),
        attribution=ranker_attribution(model, frame, settings.attribution_rows, settings.seed),
        ran=tuple(stages.ran),
    )


def write_recommender(done: Recommender, folder: str) -> None:
    write_artifact(done.test_frame, f"{folder}/test_frame")
    write_artifact(done.demo, f"{folder}/demo_recs")
    write_artifact(done.lift, f"{folder}/lift")
    done.model.save(done.test_frame.sparkSession, f"{folder}/model")
    write_artifact(done.comparison, f"{folder}/comparison")
    write_report(done.comparison, f"{folder}/recsys_metrics")
    write_report(done.importance, f"{folder}/feature_importance")
    write_report(done.attribution, f"{folder}/attribution")
