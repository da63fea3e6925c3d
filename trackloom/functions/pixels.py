"""How far two images differ, as Column expressions over arrays of their samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The least quality of a frame that was encoded again.
LEAST_PSNR = 24.0


def mse(a: Column, b: Column) -> Column:
    """Mean squared difference; null where the images differ in size or have no samples."""
    squares = F.aggregate(F.zip_with(a, b, lambda x, y: (x - y).cast("double") * (x - y).cast("double")), F.lit(0.0), lambda s, x: s + x)
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), squares / F.size(a))


def psnr(error: Column, peak: float = 255.0) -> Column:
    """Decibels from the mean squared error; infinite for equal images."""
    return F.when(error == 0, F.lit(float("inf"))).otherwise(10 * F.log10(F.lit(peak * peak) / error))
