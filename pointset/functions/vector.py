"""Column expressions over ``ARRAY<DOUBLE>`` vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIM = "dim"
# Above this many dimensions arithmetic is no longer written out per element:
# the generated method would exceed what the JVM compiles to machine code, and
# array functions are then several times faster.
UNROLL_LIMIT = 32


def tag_dim(column: Column, name: str, dim: int) -> Column:
    """Name a vector column and record its length in the column metadata."""
    return column.alias(name, metadata={DIM: int(dim)})


def dim_of(df: DataFrame, column: str = "x") -> int:
    """Length of the vectors: from the metadata, else from one row."""
    known = df.schema[column].metadata.get(DIM)
    if known is not None:
        return int(known)
    row = df.select(F.size(column)).head()
    if row is None:
        raise ValueError("cannot tell the dimensionality of an empty table")
    return int(row[0])


def sq_dist(a: Column, b: Column, dim: int | None = None) -> Column:
    """Squared Euclidean distance of two vector columns.

    With a known, moderate ``dim`` the sum is written out, which stays inside
    whole-stage codegen; otherwise array functions are used.
    """
    if dim is not None and 0 < dim <= UNROLL_LIMIT:
        gaps = [a[j] - b[j] for j in range(dim)]
        return reduce(lambda s, t: s + t, [g * g for g in gaps])
    squares = F.zip_with(a, b, lambda p, q: (p - q) * (p - q))
    return F.aggregate(squares, F.lit(0.0), lambda s, t: s + t)


def vector_literal(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
