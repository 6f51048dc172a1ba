"""Small symmetric systems as column expressions.

A matrix is an array of rows, each row an array of doubles; a symmetric matrix and a triangular
factor keep only the part up to the diagonal, so row i has i + 1 entries. All functions build column
expressions: the systems of many keys are solved where their sums are, without Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A pivot below this share of its diagonal entry counts as zero: the column is a combination of earlier ones and is left out.
SINGULAR = 1e-10


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def dot(a: Column, b: Column) -> Column:
    """Sum of products; what one of the arrays has more is left out."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, v: total + F.coalesce(v, F.lit(0.0)))


def fixed_dot(a: Column, b: Column, size: int) -> Column:
    """:func:`dot` of arrays of known size, spelled out so that it is compiled."""
    total = F.lit(0.0)
    for i in range(size):
        total = total + F.get(a, F.lit(i)) * F.get(b, F.lit(i))
    return total


def doubles() -> Column:
    return F.array().cast("array<double>")


def factor(matrix: Column, ridge: Column | None = None) -> Column:
    """Cholesky factor of a symmetric matrix, with ``ridge`` added to its diagonal.

    The first m rows are the factor of the first m columns, so that one factor serves all nested models.
    A column that depends on earlier ones gets an infinite pivot, and with it the coefficient 0.
    """

    def row(done: Column, own: Column, i: Column) -> Column:
        head = F.aggregate(done, doubles(), lambda r, above: F.array_append(r, (F.get(own, F.size(r)) - dot(r, above)) / F.get(above, F.size(r))))
        size = F.get(own, i) if ridge is None else F.get(own, i) + F.get(ridge, i)
        rest = lambda r: size - dot(r, r)
        pivot = lambda r: let(rest(r), lambda d: F.when(d > size * SINGULAR, F.sqrt(d)).otherwise(F.lit(float("inf"))))
        return let(head, lambda r: F.array_append(r, pivot(r)))

    start = F.array().cast("array<array<double>>")
    return F.aggregate(matrix, start, lambda done, own: F.array_append(done, row(done, own, F.size(done))))


def forward(lower: Column, right: Column) -> Column:
    """z with L z = right. The squares of z are what each column explains beyond the earlier ones."""
    return F.aggregate(lower, doubles(), lambda z, own: F.array_append(z, (F.get(right, F.size(z)) - dot(z, own)) / F.get(own, F.size(z))))


def backward(lower: Column, z: Column) -> Column:
    """b with L' b = z; of a longer z only the first rows count."""
    start = F.struct(z.alias("rest"), doubles().alias("b"))

    def step(at: Column, own: Column) -> Column:
        n = F.size(own) - 1
        found = F.get(at["rest"], n) / F.get(own, n)
        return let(
            found,
            lambda b: F.struct(
                F.zip_with(F.slice(at["rest"], F.lit(1), n), F.slice(own, F.lit(1), n), lambda r, v: r - v * b).alias("rest"),
                F.array_prepend(at["b"], b).alias("b"),
            ),
        )

    return F.aggregate(F.reverse(lower), start, step)["b"]


def durbin_levinson(r: Column) -> Column:
    """Partial autocorrelations of lags 1, 2, … from autocorrelations r[0] = 1, r[1], …; once nothing is left to explain they are 0."""
    start = F.struct(doubles().alias("phi"), F.lit(1.0).alias("error"), doubles().alias("out"))

    def step(at: Column, own: Column, k: Column) -> Column:
        seen = dot(at["phi"], F.reverse(F.slice(r, F.lit(2), k)))
        found = F.when(at["error"] > 1e-12, (own - seen) / at["error"]).otherwise(0.0)
        return let(found, lambda last: F.struct(
            F.array_append(F.zip_with(at["phi"], F.reverse(at["phi"]), lambda a, b: a - last * b), last).alias("phi"),
            (at["error"] * (1 - last * last)).alias("error"), F.array_append(at["out"], last).alias("out"),
        ))

    later = F.transform(F.slice(r, F.lit(2), F.size(r)), lambda v, i: F.struct(v.alias("v"), i.alias("k")))
    return F.aggregate(later, start, lambda at, p: step(at, p["v"], p["k"]))["out"]
