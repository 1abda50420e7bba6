"""ALS, reranker and the whole recommender with default settings: iterative fits, checked by rows here and by tests."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from checks.common import Check, canonical, view
from checks.features import split_windows
from palate.config import Settings
from palate.operators import als, candidates as c
from palate.operators.cohort import temporal_split
from palate.operators.rerank import RankerModel, feature_importance as importance_of, rank_ltr as rank_by_model, ranker_attribution as attribution_of
from palate.plans import train
from palate.plans.stages import is_finished, mark_finished
from palate.session import cut_lineage, keep_table, shared_dir
from palate.sources.artifacts import read_artifact

DEFAULTS = Settings()


def _static(spark, sf_dir):
    return train.StaticTables(
        view(spark, sf_dir, "businesses"), view(spark, sf_dir, "users"), view(spark, sf_dir, "checkins"), view(spark, sf_dir, "tips"))


def _folder(spark, sf_dir) -> str:
    """The artifacts of a training run over these tables: whichever key comes first writes them, the others read."""
    name = hashlib.md5(f"{spark.sparkContext.applicationId}|{sf_dir}".encode()).hexdigest()
    folder = f"{shared_dir(spark)}/recommender-{name}"
    if not is_finished(spark, folder):
        rows = keep_table(temporal_split(view(spark, sf_dir, "interactions")), "split")
        train.write_recommender(train.train_recommender(rows, _static(spark, sf_dir), DEFAULTS, f"{folder}/stages"), folder)
        mark_finished(spark, folder)
    return folder


def _table(name):
    return lambda spark, sf_dir: canonical(read_artifact(spark, f"{_folder(spark, sf_dir)}/{name}"))


def _model(spark, sf_dir):
    return RankerModel.load(spark, f"{_folder(spark, sf_dir)}/model")


def _frame(spark, sf_dir):
    return read_artifact(spark, f"{_folder(spark, sf_dir)}/test_frame")


def _fit(history):
    return als.als_fit(history, DEFAULTS.als_factors, DEFAULTS.als_iterations, DEFAULTS.als_regularization, DEFAULTS.als_alpha)


def als_fit(spark, sf_dir):
    factors = _fit(view(spark, sf_dir, "interactions"))
    return factors.users.select(F.col("user_id").alias("id"), F.lit("user").alias("side"), "vec").unionByName(
        factors.items.select(F.col("business_id").alias("id"), F.lit("business").alias("side"), "vec"))


def _candidates(spark, sf_dir):
    history, test = split_windows(spark, sf_dir)
    targets = cut_lineage(c.target_users(test, history))
    factors = _fit(history)
    return factors, test, targets, als.als_candidates(factors, targets, history, DEFAULTS.n_candidates)


def als_candidates(spark, sf_dir):
    return canonical(_candidates(spark, sf_dir)[3])


def als_score_pairs(spark, sf_dir):
    history, test = split_windows(spark, sf_dir)
    return canonical(als.als_score_pairs(_fit(history), test.select("user_id", "business_id").distinct()))


def inject_positives(spark, sf_dir):
    factors, test, targets, found = _candidates(spark, sf_dir)
    positives = als.als_score_pairs(factors, c.relevance(test, targets))
    return canonical(c.inject_positives(keep_table(found, "candidates"), positives, DEFAULTS.n_candidates))


CHECKS = {
    "als_fit": Check(als_fit),
    "als_candidates": Check(als_candidates),
    "als_score_pairs": Check(als_score_pairs),
    "inject_positives": Check(inject_positives),
    "train_recommender": Check(_table("comparison")),
    "train_ranker": Check(_table("model/history")),  # early-stop NDCG per boosting round
    "ranking_frame_als": Check(_table("test_frame")),
    "rank_als_two_stage": Check(lambda spark, sf_dir: canonical(c.rank_als(_frame(spark, sf_dir)))),
    "rank_ltr": Check(lambda spark, sf_dir: canonical(rank_by_model(_frame(spark, sf_dir), _model(spark, sf_dir)))),
    "feature_importance": Check(lambda spark, sf_dir: importance_of(_model(spark, sf_dir), _frame(spark, sf_dir))),
    "ranker_attribution": Check(lambda spark, sf_dir: attribution_of(_model(spark, sf_dir), _frame(spark, sf_dir))),
    "method_lift_two_stage": Check(_table("lift")),
    "demo_recs_two_stage": Check(_table("demo_recs")),
}
