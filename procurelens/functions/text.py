"""Text cleaning and display expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character plus the four ASCII separators.
_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def strip(text: Column) -> Column:
    """Remove white space of every kind from both ends."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def trim_spaces(text: Column) -> Column:
    """Remove plain spaces from both ends."""
    return F.trim(text)


def is_padded(text: Column) -> Column:
    """True for text that begins or ends with a space."""
    return text.startswith(" ") | text.endswith(" ")


def show_spaces(text: Column) -> Column:
    """Replace each space by a bullet so that it can be seen."""
    return F.replace(text, F.lit(" "), F.lit("•"))


def bracketed(text: Column) -> Column:
    return F.concat(F.lit(">"), text, F.lit("<"))


def within(text: Column, limit: int) -> Column:
    """The text itself; an error when it is longer than ``limit`` characters."""
    return F.when(
        F.char_length(text) > limit,
        F.raise_error(F.concat(F.lit(f"text longer than {limit} characters: "), text)),
    ).otherwise(text)


#: Money units (fixed values): least amount and letter.
_UNITS = [(1e6, "M"), (1e3, "K")]


def _two_places(value: Column) -> Column:
    """A positive double as text with two decimals, its exact value rounded and true halves to even.

    A cast to decimal takes the shortest text of the double, which rounds alike unless it ends in a
    half of the last place. There the side on which the double lies decides: ``value * 200`` against
    that half is exact when the double is split in two parts of few bits.
    """
    short = value.try_cast("decimal(38,16)")
    up = F.round(short, 2)
    high = value.cast("float").cast("double")
    side = (high * 200 - (short * 200).cast("double")) + (value - high) * 200
    halves = up - short == F.expr("0.005BD")
    exact = F.when(~halves | (side > 0), up).when(side < 0, up - F.expr("0.01BD")).otherwise(F.bround(short, 2))
    return exact.cast("decimal(38,2)").cast("string")


def money_label(amount: Column) -> Column:
    """Short money text: millions as ``1.23M``, thousands as ``1.23K``, the rest (every
    negative amount too) as the plain number. Amounts of 10**22 and more have no label."""
    amount = amount.cast("double")
    label = F.when(F.isnan(amount), None)
    for least, letter in _UNITS:
        label = label.when(amount >= least, F.concat(_two_places(amount / least), F.lit(letter)))
    return label.otherwise(F.regexp_replace(amount.try_cast("decimal(38,16)").cast("string"), r"(\.\d+?)0+$", "$1"))
