"""Perceptual hashes of grey images and their distance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _cosines(size: int) -> np.ndarray:
    k = np.arange(size)
    return np.cos(np.pi * np.outer(k, 2 * k + 1) / (2 * size))


def perceptual_hash(grey: Column, size: int = 32, kept: int = 8) -> Column:
    """64-bit hash of size x size grey values (a flat array): which of the lowest kept x kept frequencies, the constant
    one left out of the median, lie above their median. Null for null or for arrays of another length."""

    @F.pandas_udf("long")
    def hashed(images: pd.Series) -> pd.Series:
        basis = _cosines(size)[:kept]

        def one(pixels: np.ndarray | None) -> int | None:
            if pixels is None or len(pixels) != size * size:
                return None
            low = (basis @ np.asarray(pixels, float).reshape(size, size) @ basis.T).ravel()
            bits = np.packbits(low > np.median(low[1:]))
            return int(bits.view(">i8")[0])

        return pd.Series([one(p) for p in images], dtype="Int64")

    return hashed(grey)


def hash_distance(a: Column, b: Column) -> Column:
    """Share of the 64 bits that differ."""
    return F.bit_count(a.bitwiseXOR(b)) / 64
