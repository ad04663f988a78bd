"""Vectors as whole numbers, and lists of numbers as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(raw: Column) -> Column:
    """Whether an array of doubles is there and all its components are finite."""
    inf = F.lit(float("inf"))
    return raw.isNotNull() & F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf))


def floored(raw: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component, as doubles: a long would not hold a huge one."""
    huge = lambda x: F.abs(x * scale) >= 2.0**53  # noqa: E731  a whole number already
    return F.transform(
        raw, lambda x: F.when(huge(x), x * scale).otherwise(F.floor(x * scale).cast("double"))
    )


def matrix(vecs: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Lists as rows of equal length, padded with 0 or cut to ``width``."""
    if isinstance(vecs, pa.ChunkedArray):
        vecs = vecs.combine_chunks()
    offsets = vecs.offsets.to_numpy()
    lengths = np.diff(offsets)
    flat = vecs.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]] if len(vecs) else []
    wide = int(lengths.max(initial=0))
    out = np.zeros((len(lengths), wide))
    out[np.arange(wide) < lengths[:, None]] = flat
    if width is None or width == wide:
        return out
    return out[:, :width] if width < wide else np.pad(out, ((0, 0), (0, width - wide)))
