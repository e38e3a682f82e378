"""Null, NaN, blank and number handling shared by every check."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Every character a Unicode-aware strip removes.
WHITE_SPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
               "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")

# Decimal syntax accepted as a number. Guards the cast, which alone would accept '1.5f'.
NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"


@dataclass(frozen=True)
class Field:
    """A column together with its type, as a check builder sees it."""

    name: str
    dtype: T.DataType

    @property
    def col(self) -> Column:
        return F.col(self.name)

    @property
    def is_string(self) -> bool:
        return isinstance(self.dtype, (T.StringType, T.VarcharType, T.CharType))

    @property
    def is_float(self) -> bool:
        return isinstance(self.dtype, (T.FloatType, T.DoubleType))

    @property
    def present(self) -> Column:
        return present(self.col, self.dtype)

    @property
    def number(self) -> Column:
        return to_number(self.col, self.dtype)

    @property
    def text(self) -> Column:
        return self.col if self.is_string else self.col.cast("string")


def present(col: Column, dtype: T.DataType) -> Column:
    """Not null and, for text, not blank. Float NaN is missing. Never null itself."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.coalesce(not_blank(col), F.lit(False))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def not_blank(col: Column) -> Column:
    """A text that starts with a visible ASCII character is settled by two byte comparisons."""
    return ((col >= "!") & (col < "\x7f")) | (strip(col) != "")


def to_number(col: Column, dtype: T.DataType) -> Column:
    """Double value, or null where the content is not a plain number."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.when(col.rlike(NUMERIC_TEXT), col.try_cast("double"))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col.cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    return F.lit(None).cast("double")


def to_instant(col: Column, dtype: T.DataType) -> Column:
    """Timestamp, or null where text does not parse."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return F.try_to_timestamp(F.trim(col))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    return F.lit(None).cast("timestamp")


def null_normalise(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every float column (one projection, no shuffle)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.select(*[
        F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`")
        for c in df.columns
    ])


def sort_struct(keys: list[str]) -> Column:
    """Struct that orders by the keys ascending with nulls last (structs put nulls first)."""
    parts = []
    for i, k in enumerate(keys):
        parts += [F.col(k).isNull().alias(f"n{i}"), F.col(k).alias(f"k{i}")]
    return F.struct(*parts) if parts else F.struct(F.lit(0).alias("k0"))


def count_where(condition: Column) -> Column:
    """Rows that satisfy a condition. Unlike count_if it leaves no helper projection behind, so equal
    aggregates stay recognisable and their shuffle is reused."""
    return F.count(F.when(condition, F.lit(1)))


def ascending(keys: list[str]) -> list[Column]:
    return [F.col(k).asc_nulls_last() for k in keys]
