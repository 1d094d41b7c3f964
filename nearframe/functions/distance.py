"""Distance expressions (FN-1 Euclidean, FN-2 squared Euclidean).

Both are plain Catalyst expressions, so they stay inside whole-stage codegen.
The sum runs left to right over the dimensions, the same order a sequential
loop uses, so two engines that evaluate IEEE doubles produce the same bits.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def squared_euclidean(a: Sequence[ColumnLike], b: Sequence[ColumnLike]) -> Column:
    """sum_j (a_j - b_j)^2 over equally long lists of scalar columns."""
    if len(a) != len(b):
        raise ValueError(f"dimension mismatch: {len(a)} vs {len(b)}")
    if not a:
        raise ValueError("at least one feature is required")
    if all(isinstance(c, str) for c in list(a) + list(b)):
        # Named columns: one SQL expression, parsed once by the JVM, instead of
        # four gateway calls per dimension. ``+`` is left-associative, so the
        # summation order is the same as below.
        sq = [f"(({quote(x)} - {quote(y)}) * ({quote(x)} - {quote(y)}))" for x, y in zip(a, b)]
        return F.expr(" + ".join(sq))
    terms = []
    for x, y in zip(a, b):
        diff = _col(x) - _col(y)
        terms.append(diff * diff)
    return reduce(operator.add, terms)


def euclidean(a: Sequence[ColumnLike], b: Sequence[ColumnLike]) -> Column:
    """sqrt(sum_j (a_j - b_j)^2) over equally long lists of scalar columns."""
    return F.sqrt(squared_euclidean(a, b))


def array_squared_euclidean(a: ColumnLike, b: ColumnLike) -> Column:
    """Squared distance of two array columns of any (equal) width.

    Uses higher-order functions, which are interpreted rather than
    code-generated; prefer the unrolled form when the width is known.
    """
    pairs = F.zip_with(_col(a), _col(b), lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.aggregate(pairs, F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def array_euclidean(a: ColumnLike, b: ColumnLike) -> Column:
    return F.sqrt(array_squared_euclidean(a, b))


def is_finite(c: ColumnLike) -> Column:
    """True for a finite double; false for null, NaN and +-infinity.

    Spark orders NaN above every number, so NaN < inf is false.
    """
    c = _col(c)
    return (c > F.lit(float("-inf"))) & (c < F.lit(float("inf")))


def all_finite(cols: Sequence[ColumnLike]) -> Column:
    return reduce(operator.and_, [F.coalesce(is_finite(c), F.lit(False)) for c in cols])
