"""Integer vectors from tables of embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cityflow.llm.common import col

#: Components are held within this bound, so that sums over products of a few thousand of them fit a long.
LARGEST = 1 << 25


def whole(vector_col: str) -> Column:
    """Whether a vector is there with all its components, each finite."""
    finite = F.forall(col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(col(vector_col).isNotNull() & finite, F.lit(False))


def integers(vector_col: str, scale: int) -> Column:
    """Components as floor(scale * x), x as double."""
    held = lambda x: F.least(F.greatest(x, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
    return F.transform(col(vector_col), lambda x: F.floor(held(x.cast("double") * F.lit(float(scale)))).cast("int"))


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Vectors of a batch as rows of a matrix; those with fewer components end in zeros."""
    sizes = np.asarray(pa.compute.list_value_length(vectors).to_numpy(zero_copy_only=False), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    made = np.zeros((len(sizes), dims), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    made[rows, places] = flat
    return made
