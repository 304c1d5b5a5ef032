"""Equality joins of a large left side with a lookup relation.

By default Spark chooses: adaptive execution broadcasts the right side when its shuffled size proves
small, and otherwise splits skewed partitions of a left, inner or semi join. Nothing runs while the
plan is built. A caller can name a broadcast limit, which is then checked by one aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024


def _width(field: T.StructField) -> str:
    name = "`" + field.name.replace("`", "``") + "`"
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = f"octet_length({name})"
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        size = f"8 * size({name})"
    elif isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        size = f"octet_length(to_json(struct({name})))"
    else:
        size = "8"
    return f"coalesce({size}, 0) + 8"


def row_bytes(df: DataFrame) -> Column:
    """Exact payload size of a row of ``df``."""
    return F.expr(f"cast({' + '.join(_width(f) for f in df.schema.fields)} as bigint)")


def measured_bytes(df: DataFrame) -> int:
    """Exact payload size of ``df``: one distributed aggregate, one row comes back."""
    return int(df.select(F.sum(row_bytes(df))).first()[0] or 0)


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return measured_bytes(df) <= (BROADCAST_BYTES if limit is None else limit)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    condition: Column | None = None,
    limit: int | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Join on equally named ``keys``; ``how`` is left, inner, left_semi or left_anti.

    ``condition`` may add range terms over columns whose names occur on one side only. ``limit``
    measures the right side and broadcasts it up to so many bytes; ``small`` carries a size check
    the caller already made. Without either the choice is Spark's.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    for k in keys:
        mine, theirs = left.schema[k].dataType, right.schema[k].dataType
        if mine != theirs:
            # A silent cast could make keys equal that are not.
            raise TypeError(f"key {k} is {mine.simpleString()} and {theirs.simpleString()}")
    if small is None and limit is not None:
        small = fits_broadcast(right, limit)
    right = _renamed(right, keys)
    if small is not None:
        right = F.broadcast(right) if small else right.hint("merge")
    return _join(left, right, keys, how, condition)


def _renamed(right: DataFrame, keys: list[str]) -> DataFrame:
    return right.withColumnsRenamed({k: f"__right_{k}" for k in keys})


def _join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, condition: Column | None
) -> DataFrame:
    on = [F.col(f"`{k}`") == F.col(f"`__right_{k}`") for k in keys]
    if condition is not None:
        on.append(condition)
    joined = left.join(right, on, how)
    return joined.drop(*[f"__right_{k}" for k in keys]) if how in ("left", "inner") else joined
