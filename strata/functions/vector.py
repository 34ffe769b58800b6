"""Vector expressions over ARRAY<FLOAT|DOUBLE>, evaluated in DOUBLE on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine; null if a norm is zero (never a division error)."""
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))


def normalised(a: Column) -> Column:
    """Unit vector; a zero vector is divided by one."""
    size = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(size == 0, F.lit(1.0)).otherwise(size))


def padded(a: Column, size: int) -> Column:
    """Zeros on the right up to size, which leaves cosines alone; a longer vector is an error, never cut."""
    short = F.concat(a, F.array_repeat(F.lit(0.0).cast("float"), F.greatest(F.lit(size) - F.size(a), F.lit(0))))
    return F.when(F.size(a) <= size, short).otherwise(F.raise_error(F.lit(f"vector longer than {size}")).cast("array<float>"))


def literal(a: Column) -> Column:
    """[f1,f2,...] as text."""
    return F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("string")), ","), F.lit("]"))
