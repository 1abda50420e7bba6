"""A linear map over a column of vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def apply_adaptation(vectors: DataFrame, matrix: np.ndarray, column: str = "embedding") -> DataFrame:
    """Multiply every vector by the matrix and renormalise, batch by batch in place."""
    def transform(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not batch.empty:
                moved = np.stack(batch[column].to_numpy()).astype(np.float64) @ matrix
                norms = np.linalg.norm(moved, axis=1, keepdims=True)
                moved = np.divide(moved, norms, out=np.zeros_like(moved), where=norms > 0)
                batch = batch.assign(**{column: list(moved.astype(np.float32))})
            yield batch

    return vectors.mapInPandas(transform, vectors.schema)
