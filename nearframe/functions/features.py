"""Turn user feature specs into a fixed list of double columns.

A feature spec is either the name of one array or ML vector column (all rows the
same width) or a list of scalar numeric columns. All are unrolled into scalar
double columns ``<prefix>0 .. <prefix>{d-1}`` so the distance expression
code-generates (SURVEY §4: unrolled columns beat higher-order functions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .distance import all_finite, quote

FeatureSpec = str | Sequence[str]

# Per-row flag set by ``with_features``: every feature is a finite number.
VALID = "__valid"


def is_array_spec(df: DataFrame, features: FeatureSpec) -> bool:
    if isinstance(features, str):
        dtype = df.schema[features].dataType
        if not isinstance(dtype, T.ArrayType):
            return False
        return True
    return False


def is_vector_spec(df: DataFrame, features: FeatureSpec) -> bool:
    """A column of ML vectors, dense or sparse, as a vector assembler makes them."""
    return isinstance(features, str) and df.schema[features].dataType.typeName() == "vectorudt"


def vectors_to_arrays(df: DataFrame, features: FeatureSpec) -> DataFrame:
    """``df`` with an ML vector column as ``array<double>``; others unchanged."""
    if not is_vector_spec(df, features):
        return df
    from pyspark.ml.functions import vector_to_array

    return df.withColumn(features, F.when(F.col(features).isNotNull(), vector_to_array(features)))


def feature_width(df: DataFrame, features: FeatureSpec, dim: int | None = None) -> int:
    """Width of the feature vector.

    For an array column without ``dim`` the width of the first row is read
    (a one-row job); every row is then asserted to have that width when the
    columns are built, so a mismatch fails the job instead of being padded.
    """
    if isinstance(features, str):
        if not is_array_spec(df, features):
            return 1
        if dim is not None:
            return int(dim)
        row = df.select(F.size(features).alias("n")).where(F.col(features).isNotNull()).first()
        if row is None:
            raise ValueError(f"cannot infer the width of {features!r} from an empty table")
        return int(row["n"])
    return len(features)


def checked_vector(df: DataFrame, features: str, dim: int) -> Column:
    """The array column, failing the job on a row of another width (C10)."""
    arr = F.col(features)
    err = F.raise_error(F.lit(f"feature column {features!r}: every row must have width {dim}"))
    return F.when(arr.isNull() | (F.size(arr) == F.lit(dim)), arr).otherwise(err.cast(df.schema[features].dataType))


def with_features(df: DataFrame, keep: list[Column], features: FeatureSpec, prefix: str, dim: int) -> DataFrame:
    """``df`` projected to ``keep`` plus scalar doubles ``prefix0..``.

    An array is width-checked once in its own projection, then read with
    ``get`` (no per-element bounds-error code), which keeps a 64-wide
    projection well inside the 64 KB codegen method limit.
    """
    if isinstance(features, str) and is_array_spec(df, features):
        vec = f"__{prefix}vec"
        staged = df.select(*keep, checked_vector(df, features, dim).alias(vec))
        kept = [c for c in staged.columns if c != vec]
        # SQL text: one parse on the JVM instead of gateway calls per element
        v = quote(vec)
        elems = [f"CAST(get({v}, {i}) AS DOUBLE) AS {quote(prefix + str(i))}" for i in range(dim)]
        fin = "CAST(x AS DOUBLE) > CAST('-Infinity' AS DOUBLE) AND CAST(x AS DOUBLE) < CAST('Infinity' AS DOUBLE)"
        ok = f"coalesce(forall({v}, x -> {fin}), false) AS {quote(VALID)}"
        return staged.selectExpr(*[quote(c) for c in kept], *elems, ok)
    cols = feature_columns(df, features, prefix, dim)
    names_ = [features] if isinstance(features, str) else list(features)
    return df.select(*keep, *cols, all_finite([F.col(c).cast("double") for c in names_]).alias(VALID))


def feature_columns(df: DataFrame, features: FeatureSpec, prefix: str, dim: int) -> list[Column]:
    """Scalar double columns ``prefix0..`` for a list of scalar columns."""
    if isinstance(features, str) and is_array_spec(df, features):
        raise TypeError("array features: use with_features")
    names = [features] if isinstance(features, str) else list(features)
    if len(names) != dim:
        raise ValueError(f"expected {dim} feature columns, got {len(names)}")
    return [F.col(c).cast("double").alias(f"{prefix}{i}") for i, c in enumerate(names)]


def names(prefix: str, dim: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(dim)]
