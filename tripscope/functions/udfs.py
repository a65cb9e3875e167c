"""The one user-defined function: haversine as an Arrow-batched UDF.

It exists to compare with the built-in expression (the default); NumPy
works on whole Arrow batches, never row by row.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tripscope.functions.columns import EARTH_RADIUS_KM


@lru_cache(maxsize=8)
def haversine_arrow_udf(radius: float = EARTH_RADIUS_KM):
    @F.arrow_udf("double")
    def haversine(lat1: pa.Array, lon1: pa.Array, lat2: pa.Array, lon2: pa.Array) -> pa.Array:
        inputs = (lat1, lon1, lat2, lon2)
        p1, l1, p2, l2 = (np.radians(x.to_numpy(zero_copy_only=False).astype("float64")) for x in inputs)
        a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((l2 - l1) / 2) ** 2
        out = radius * (2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a)))
        # NULL for a missing input only: a NaN coordinate gives NaN, as the
        # built-in does.
        missing = np.any([x.is_null().to_numpy(zero_copy_only=False) for x in inputs], axis=0)
        return pa.array(out, pa.float64(), mask=missing)

    return haversine
