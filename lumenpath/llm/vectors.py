"""Embedding columns as integer vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenpath.llm.common import prepare

#: Steps of the integer grid between 0 and 1.
SCALE = 64
#: Scaled components lie below this: squared distances of 64 components then fit into a long.
MOST = 1 << 27


def is_finite(vector: Column) -> Column:
    """Whether an array is there and all its entries are finite numbers."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def on_grid(vector: Column) -> Column:
    """``floor(SCALE * x)`` of every entry as int; an entry of MOST / SCALE or more is an error, since its square would not be exact."""
    bound = F.raise_error(F.lit(f"a component is {MOST // SCALE} or more, beyond exact integers")).cast("int")
    return F.transform(vector, lambda x: F.when(F.abs(x) < MOST // SCALE, F.floor(x * SCALE).cast("int")).otherwise(bound))


def grid_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int | None = None) -> DataFrame:
    """``vec_id, x``: rows with a finite vector (of ``dims`` entries if that is given) as integers; other columns are left."""
    prepare(df.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    kept = df.where(is_finite(vector) if dims is None else (F.size(vector_col) == dims) & is_finite(vector))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), on_grid(vector).alias("x"))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """The rows of an Arrow list column, all ``dims`` long, as int64."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)
