"""Vector arithmetic over ``array<float>`` columns, in Arrow batches.

Spark has no dot product or norm for arrays. Higher-order functions can express
both but run interpreted, one boxed element at a time: scoring 200,000 vectors of
384 floats took 5 s that way and 0.2 s as NumPy over Arrow batches. The functions
below nest their helpers so that executors need no copy of this package.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unit(column: str | Column) -> Column:
    """The vector divided by its L2 norm, as doubles; a zero vector stays as it is."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def scale(vectors):
        import numpy as np
        import pyarrow as pa

        lengths = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy(zero_copy_only=False).astype("float64")
        lengths = np.where(vectors.is_null().to_numpy(zero_copy_only=False), 0, lengths)
        rows = np.repeat(np.arange(len(vectors)), lengths)
        norms = np.sqrt(np.bincount(rows, weights=values * values, minlength=len(vectors)))
        norms[norms == 0] = 1.0
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(values / norms[rows]), mask=vectors.is_null()
        )

    return scale(column)
