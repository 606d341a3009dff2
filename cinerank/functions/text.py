"""Column expressions for delimited text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Every character up to and including the blank counts as white space at the ends of a field.
_EDGE_SPACE = r"^[\x00-\x20]+|[\x00-\x20]+$"
_INTEGER = r"^[+-]?[0-9]+\z"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_SPACE, "")


def to_int(c: Column) -> Column:
    """32-bit integer or null. Surrounding white space is not accepted."""
    return F.when(c.rlike(_INTEGER), c.try_cast("int"))


def to_double(c: Column) -> Column:
    """A finite number or null."""
    number = c.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def contains_ignore_case(haystack: Column, needle: Column) -> Column:
    return F.contains(F.lower(haystack), F.lower(needle))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df.select`` with the guarantee that each expression is evaluated once per row, whatever later filters refer
    to: the optimizer does not copy expressions out of a generator."""
    return df.select(F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))
