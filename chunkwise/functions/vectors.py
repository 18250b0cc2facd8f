"""Vector functions over ``array<float>`` / ``array<double>`` columns.

Arithmetic is done in double (P6: vectors are stored as float32). Division by a
zero norm gives null through ``try_divide`` instead of an ANSI error, and a null
distance means "no hit".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double_vector(v: str | Column) -> Column:
    return _c(v).cast("array<double>")


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def dot(a: str | Column, b: str | Column) -> Column:
    return _sum(F.zip_with(to_double_vector(a), to_double_vector(b), lambda x, y: x * y))


def l2_norm(a: str | Column) -> Column:
    return F.sqrt(_sum(F.transform(to_double_vector(a), lambda x: x * x)))


def cosine_similarity(a: str | Column, b: str | Column) -> Column:
    """dot / sqrt(|a|^2 |b|^2); null for a zero vector or a length mismatch."""
    aa, bb = dot(a, a), dot(b, b)
    same = F.size(_c(a)) == F.size(_c(b))
    return F.when(same, F.try_divide(dot(a, b), F.sqrt(aa * bb)))


def cosine_distance(a: str | Column, b: str | Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def l2sq_distance(a: str | Column, b: str | Column) -> Column:
    same = F.size(_c(a)) == F.size(_c(b))
    diff = F.zip_with(to_double_vector(a), to_double_vector(b), lambda x, y: (x - y) * (x - y))
    return F.when(same, _sum(diff))
