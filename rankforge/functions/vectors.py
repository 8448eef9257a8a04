"""Vector expressions over ``array<double>`` columns (FN-10), all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-8


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def once(value: Column, f) -> Column:
    """``f(value)`` with the value worked out once a row; inside the lambda of an array function Spark works an
    expression out anew for every entry."""
    return F.transform(F.array(value), f)[0]


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda acc, v: acc + v))


def cosine(a: Column | str, b: Column | str, eps: float = EPS) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))


def l2_normalize(a: Column | str, eps: float = EPS) -> Column:
    return once(norm(a), lambda n: F.transform(_c(a), lambda x: x / (n + F.lit(eps))))


def relu(a: Column | str) -> Column:
    return F.transform(_c(a), lambda x: F.greatest(x, F.lit(0.0)))


def scale(a: Column | str, s: Column | float) -> Column:
    sc = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x * sc)


def axpy(a: Column | str, b: Column | str, alpha: float) -> Column:
    """a - alpha * b, element-wise."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x - F.lit(float(alpha)) * y)


def clip(x: Column | str, lo: float, hi: float) -> Column:
    return F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))


def nan_guard(x: Column | str, fill: float = 0.0) -> Column:
    return F.coalesce(F.nanvl(_c(x), F.lit(fill)), F.lit(fill))


def concat_vectors(*parts: Column | str) -> Column:
    return F.concat(*[_c(p) for p in parts])
