"""Scalar rules shared by sources and operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that a CSV reader of the data takes as missing.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# Fixed value: white space that is taken off at both ends of a text.
WHITE_SPACE = (
    "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: what counts as a number in text (no hex, no underscores, no type suffix).
NUMBER_PATTERN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def null_words(text: Column) -> Column:
    return F.when(text.isin(*NULL_WORDS), None).otherwise(text)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    trimmed = strip(text.cast("string"))
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def to_period(text: Column) -> Column:
    """Text to an integer period; fractions and non-numbers become null."""
    number = to_number(text)
    return F.when(number == F.floor(number), number.try_cast("int"))


def safe_ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def normalize(text: Column, how: str) -> Column:
    """``none`` compares as is, ``strip`` trims, ``strip_upper`` trims and ignores case."""
    if how == "none":
        return text
    if how == "strip":
        return strip(text)
    if how == "strip_upper":
        return F.upper(strip(text))
    raise ValueError(f"unknown normalization: {how}")


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def not_blank(text: Column) -> Column:
    """The text itself, or null if it has nothing but white space."""
    return F.when(F.length(strip(text)) > 0, text)


def label_of(meta: Column) -> Column:
    """Label of a coded value: its name, else English, else the first non-blank name."""
    names = meta["names"]
    others = F.filter(F.map_values(names), lambda n: not_blank(n).isNotNull())
    return F.coalesce(
        not_blank(meta["name"]),
        not_blank(F.try_element_at(names, F.lit("en"))),
        not_blank(F.try_element_at(names, F.lit("en-US"))),
        F.get(others, F.lit(0)),
    )


def split_periods(text: Column) -> Column:
    """``"2001, 2004"`` to an array of integers; parts that are no integers are left out."""
    parts = F.transform(F.split(text, ","), lambda p: strip(p).try_cast("int"))
    return F.filter(parts, lambda p: p.isNotNull())
