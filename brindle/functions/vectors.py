"""Distances between array<float> columns, in double precision; null where lengths differ or a cosine has a zero vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(a: Column, b: Column, f) -> Column:
    total = F.aggregate(F.zip_with(a, b, lambda x, y: f(x.cast("double"), y.cast("double"))), F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(a) == F.size(b), total)


def dot(a: Column, b: Column) -> Column:
    return _sum(a, b, lambda x, y: x * y)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(_sum(a, b, lambda x, y: (x - y) * (x - y)))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def inner_product(a: Column, b: Column) -> Column:
    return dot(a, b)


METRICS = {"cosine": cosine_distance, "l2": l2, "ip": inner_product}


def literal(vector) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])
