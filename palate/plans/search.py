"""Search build: corpus, split, encode, evaluate, adapt from same-business pairs, evaluate, persist; then text queries."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from palate.config import Settings
from palate.operators.corpus import build_corpus, eval_query_ids, mine_pairs, retrieval_split
from palate.operators.encode import TextEncoder, adapted_matrix, fit_encoder, load_encoder, save_encoder
from palate.operators.transform import apply_adaptation
from palate.operators.wordvec import WordEncoder, fit_word_encoder
from palate.operators.search import eval_retrieval, retrieval_lift, search_businesses, search_reviews
from palate.session import keep_table
from palate.sources.artifacts import write_artifact


@dataclass(frozen=True)
class SearchIndex:
    vectors: DataFrame  # review_id, business_id, embedding (adapted) and the corpus columns given
    report: DataFrame
    encoder: TextEncoder | WordEncoder | None  # puts a text into the space of `vectors`; None if the vectors were given

    def reviews(self, texts: DataFrame, businesses: DataFrame, k: int = 10) -> DataFrame:
        """Free text (query_id, text) to the k nearest reviews with their businesses."""
        return search_reviews(self.encoder.encode(texts), self.vectors, businesses, k)

    def businesses(self, texts: DataFrame, businesses: DataFrame, settings: Settings = Settings()) -> DataFrame:
        """Free text (query_id, text) to the nearest businesses, each with a snippet of its best review."""
        return search_businesses(
            self.encoder.encode(texts), self.vectors, businesses, settings.eval_k, settings.search_pool, settings.snippet_chars)


def corpus_of(reviews: DataFrame, businesses: DataFrame | None, settings: Settings = Settings()) -> DataFrame:
    """The review corpus of a search run, kept once."""
    return keep_table(build_corpus(
        reviews, businesses, settings.min_chars, settings.max_chars, settings.per_business_reviews, settings.corpus_reviews, settings.seed), "corpus")


def build_search(corpus: DataFrame, settings: Settings = Settings(), folder: str | None = None) -> SearchIndex:
    """`corpus` either has an `embedding` column already, or a `text` column to encode.

    With a folder the vectors and the encoder are written there (`open_search` reads them back).
    """
    encoder = None
    if "embedding" not in corpus.columns:
        fit = fit_word_encoder if settings.encoder == "learnt" else fit_encoder
        encoder = fit(corpus, dim=settings.encoder_dim)
        corpus = encoder.encode(corpus)
    base = keep_table(corpus, "vectors")
    split = keep_table(retrieval_split(base, settings.eval_share, settings.seed), "split")
    queries = keep_table(eval_query_ids(base, split, settings.eval_queries, settings.seed), "queries")
    pairs = mine_pairs(base, split.where(F.col("role") == "train"), settings.n_pairs, settings.seed)
    matrix = adapted_matrix(base, keep_table(pairs, "pairs"), epochs=settings.adapt_epochs)
    adapted = apply_adaptation(base, matrix)
    if encoder is not None:
        encoder = replace(encoder, matrix=matrix)
    if folder is None:
        adapted = keep_table(adapted, "adapted")
    else:
        adapted = base.sparkSession.read.parquet(write_artifact(adapted, f"{folder}/vectors"))
        if encoder is not None:
            save_encoder(encoder, f"{folder}/encoder")
    report = retrieval_lift(
        eval_retrieval(base, queries, settings.eval_k), eval_retrieval(adapted, queries, settings.eval_k)
    )
    return SearchIndex(adapted, report, encoder)


def open_search(vectors: DataFrame, folder: str) -> SearchIndex:
    """An index from vectors read back and the encoder saved beside them; it has no report."""
    return SearchIndex(vectors, vectors.limit(0), load_encoder(f"{folder}/encoder"))
