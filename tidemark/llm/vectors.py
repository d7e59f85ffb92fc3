"""Float vectors as the whole numbers that the vector operators compare exactly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components become floor(SCALE * x); beyond REACH a product of two would no longer fit 63 bits.
SCALE, REACH = 256, 1 << 31


def whole(vector: str | Column) -> Column:
    """``floor(256 * x)`` of every component, x as double; raises for a component that has no exact product in 64 bits."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    far = F.exists(scaled, lambda x: (x > REACH) | (x < -REACH))
    return F.when(far, F.raise_error(F.lit("a component is too large for exact products"))).otherwise(scaled)


def usable(vector: str | Column) -> Column:
    """True for a vector that is not null and has no null, infinite or undefined component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(~bad, F.lit(False))
