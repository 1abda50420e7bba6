"""Text to unit vectors, and adaptation of vectors from same-business pairs."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from palate.operators.contrast import EPOCHS, contrastive_matrix
from palate.operators.transform import apply_adaptation
from palate.operators.wordvec import WordEncoder

# Ridge on the within-business covariance, as a share of its mean variance.
RIDGE = 1e-2


@dataclass(frozen=True)
class TextEncoder:
    """Hashed term frequencies weighted by IDF, L2-normalised, then the adaptation if there is one; no vocabulary on
    the driver."""

    model: PipelineModel
    matrix: np.ndarray | None = None  # adaptation applied after the base encoding

    def save(self, folder: str) -> str:
        self.model.write().overwrite().save(f"{folder}/pipeline")
        spark = SparkSession.getActiveSession()
        rows = [] if self.matrix is None else [(i, row.tolist()) for i, row in enumerate(self.matrix)]
        spark.createDataFrame(rows, "row long, line array<double>").coalesce(1).write.mode("overwrite").parquet(f"{folder}/matrix")
        return folder

    @classmethod
    def load(cls, folder: str) -> TextEncoder:
        spark = SparkSession.getActiveSession()
        lines = spark.read.parquet(f"{folder}/matrix").orderBy("row").collect()  # dim rows
        return cls(PipelineModel.load(f"{folder}/pipeline"), np.array([r.line for r in lines]) if lines else None)

    def encode(self, texts: DataFrame, column: str = "text", out: str = "embedding") -> DataFrame:
        encoded = self.model.transform(texts.withColumn("_text", F.coalesce(F.col(column), F.lit(""))))
        encoded = encoded.withColumn(out, vector_to_array("_unit", "float32")).drop(
            "_text", "_tokens", "_tf", "_weighted", "_unit"
        )
        return encoded if self.matrix is None else apply_adaptation(encoded, self.matrix, out)


def fit_encoder(texts: DataFrame, column: str = "text", dim: int = 1024, min_docs: int = 1) -> TextEncoder:
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_tokens", pattern=r"(?U)[^\p{L}\p{N}]+", minTokenLength=2),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_weighted", minDocFreq=min_docs),
        Normalizer(inputCol="_weighted", outputCol="_unit", p=2.0),
    ]
    source = texts.select(F.coalesce(F.col(column), F.lit("")).alias("_text"))
    return TextEncoder(Pipeline(stages=stages).fit(source))


def pair_covariance(pairs: DataFrame, vectors: DataFrame) -> np.ndarray:
    """Mean outer product of pair differences (halved): within-business covariance, d x d.

    Each task multiplies its own batches into one d x d sum; Spark adds those up row by row, and only the
    d x d total reaches the driver.
    """
    side = vectors.select("review_id", "embedding")
    differences = (
        pairs.join(side.select(F.col("review_id").alias("anchor_id"), F.col("embedding").alias("a")), "anchor_id")
        .join(side.select(F.col("review_id").alias("positive_id"), F.col("embedding").alias("b")), "positive_id")
        .select(F.zip_with("a", "b", lambda x, y: x.cast("double") - y.cast("double")).alias("diff"))
    )

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = None, 0
        for batch in batches:
            if batch.empty:
                continue
            block = np.stack(batch["diff"].to_numpy())
            product = block.T @ block
            total = product if total is None else total + product
            count += len(block)
        if total is not None:
            yield pd.DataFrame({"row": np.arange(len(total)), "n": count, "line": list(total)})

    sums = differences.mapInPandas(partial, "row int, n long, line array<double>")
    lines = (
        sums.groupBy("row")
        .agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("line")).alias("line"))
        .orderBy("row").collect()  # d rows of d numbers
    )
    if not lines:
        raise ValueError("no pairs to adapt from")
    return np.stack([row.line.toArray() for row in lines]) / (2.0 * lines[0].n)


def adaptation_matrix(covariance: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Relevant component analysis: inverse square root of the within-business covariance."""
    values, directions = np.linalg.eigh(covariance + ridge * np.trace(covariance) / len(covariance) * np.eye(len(covariance)))
    return (directions / np.sqrt(values)) @ directions.T


def adapted_matrix(vectors: DataFrame, pairs: DataFrame, ridge: float = RIDGE, epochs: int = EPOCHS) -> np.ndarray:
    """The closed form of the pairs' covariance, moved on by `epochs` of contrastive steps."""
    start = adaptation_matrix(pair_covariance(pairs, vectors), ridge)
    return contrastive_matrix(vectors, pairs, start, epochs) if epochs else start


def adapt_embeddings(vectors: DataFrame, pairs: DataFrame, ridge: float = RIDGE, epochs: int = EPOCHS) -> DataFrame:
    """Vectors moved so that reviews of one business come closer together than to others."""
    return apply_adaptation(vectors, adapted_matrix(vectors, pairs, ridge, epochs))


def load_encoder(folder: str) -> TextEncoder | WordEncoder:
    """Whichever encoder was saved there."""
    kind = SparkSession.getActiveSession().read.text(f"{folder}/kind").first()[0]
    return (WordEncoder if kind == "WordEncoder" else TextEncoder).load(folder)


def save_encoder(encoder: TextEncoder | WordEncoder, folder: str) -> str:
    encoder.save(folder)
    SparkSession.getActiveSession().createDataFrame([(type(encoder).__name__,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/kind")
    return folder
