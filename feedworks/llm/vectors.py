"""What the vector operators share: which vectors take part, and their numbers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(column: str) -> Column:
    """Not null, not empty, and no component null, NaN or infinite."""
    ok = F.forall(F.col(column), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(F.col(column)) > 0) & ok, F.lit(False))


def matrix(rows) -> np.ndarray:
    """Rows of equal length as doubles."""
    return np.stack([np.asarray(r, np.float64) for r in rows])


def blob(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
