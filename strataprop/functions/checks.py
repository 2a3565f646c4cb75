"""Argument checks. They look at names and types only and start no Spark job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_dataframe(value, name: str) -> None:
    if not isinstance(value, DataFrame):
        raise TypeError(f"{name} must be a Spark DataFrame, not {type(value).__name__}")


def require_columns(df: DataFrame, columns: Iterable[str], name: str = "input") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} has no column {', '.join(map(repr, missing))}")


def require_numeric(df: DataFrame, columns: Iterable[str], name: str = "input") -> None:
    columns = list(columns)
    require_columns(df, columns, name)
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"{name} needs numeric columns; not numeric: {', '.join(wrong)}")


def require_choice(value: str, choices: Iterable[str], name: str) -> None:
    choices = tuple(choices)
    if value not in choices:
        raise ValueError(f"{name} must be one of {', '.join(choices)}, not {value!r}")


def require_unit_interval(value: float, name: str) -> None:
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        raise TypeError(f"{name} must be a number, not {type(value).__name__}")
    if not 0 <= value <= 1:
        raise ValueError(f"{name} must lie between 0 and 1, not {value}")


def require_disjoint(left: DataFrame, right: DataFrame, on: Iterable[str], name: str) -> None:
    """Columns other than the join key may not appear on both sides."""
    shared = (set(left.columns) & set(right.columns)) - set(on)
    if shared:
        raise ValueError(f"{name} repeats columns of the left side: {', '.join(sorted(shared))}")
