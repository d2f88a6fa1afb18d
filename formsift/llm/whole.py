"""Vectors scaled to whole numbers, and exact products of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A component must stay below this after scaling: whole-number sums of squares of 64 of them fit into 64 bits.
LARGEST = 1 << 27


def scaled(vector: str, scale: int) -> Column:
    """floor(scale * x) of every component x as a double; an error for one that leaves the allowed range."""
    return F.expr(
        f"transform(transform(`{vector}`, x -> floor({scale} * cast(x AS double))), x -> if(abs(x) < {LARGEST}, x, "
        f"raise_error('a component is {LARGEST} or more after scaling: scores would not be exact')))"
    )


def finite(vector: str) -> Column:
    """True for a vector without null or non-finite components; false for a null or empty one."""
    v = f"transform(`{vector}`, x -> cast(x AS double))"
    return F.expr(
        f"coalesce(size(`{vector}`), -1) > 0 AND "
        f"forall({v}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column whose lists all have `width` whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), width)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: through doubles where every sum fits into them exactly."""
    largest = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if largest < 1 << 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if largest < 1 << 63:
        return a @ b.T
    raise OverflowError("an inner product may leave 64 bits")
