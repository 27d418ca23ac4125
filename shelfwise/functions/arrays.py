"""Array, vector and identifier functions."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

__all__ = [
    "array_to_vector", "vector_to_array", "to_array", "intersect_keep_dup",
    "fill_slots", "append_missing", "typed_id", "feature_columns",
]


def to_array(value: Column | str) -> Column:
    """One value as a one-element array; null gives ``[null]``."""
    return F.array(value)


def intersect_keep_dup(left: Column | str, right: Column | str) -> Column:
    """Elements of ``left`` found in ``right``, repeats of ``left`` kept.

    Null when either side is null or is the empty marker ``['']``.
    """
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    blank = F.array(F.lit(""))
    usable = left.isNotNull() & right.isNotNull() & (left != blank) & (right != blank)
    shared = F.filter(left, lambda x: F.exists(right, lambda y: y.eqNullSafe(x)))
    return F.when(usable, shared)


def fill_slots(values: Column, fallback: Column, size: int) -> Column:
    """``size`` slots; an empty slot takes the fallback of the same position."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.coalesce(F.get(values, i), F.get(fallback, i)),
    )


def append_missing(values: Column, fallback: Column, size: int) -> Column:
    """``size`` slots; fallback values not yet present are appended in order."""
    extra = F.coalesce(F.array_except(fallback, values), F.slice(values, 1, 0))
    padded = F.slice(F.concat(values, extra), 1, size)
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.get(padded, i))


def typed_id(value: Column | str, dtype: DataType) -> Column:
    """A text id in the type of the id column it will meet.

    Casting the text side keeps the big table's id as stored, so its bucketing and
    statistics stay usable. Text that is not the exact spelling gives null.
    """
    value = F.col(value) if isinstance(value, str) else value
    if dtype.simpleString() == "string":
        return value
    cast = value.try_cast(dtype)
    return F.when(cast.cast("string") == value, cast)


def feature_columns(df: DataFrame, prefix: str = "f") -> DataFrame:
    """Only the columns whose names start with ``prefix``."""
    return df.select(*[c for c in df.columns if c.startswith(prefix)])
