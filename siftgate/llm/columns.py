"""Column expressions shared by the text operators. Words are runs of characters other than \\x20 and \\x09-\\x0D."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once a row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def whole(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def scalar(df: DataFrame) -> Column:
    """The one value of a one-row table as a scalar subquery: evaluated once, then a literal in every task."""
    return df.scalar()
