"""Text to integer with the accepted forms of Python's int().

Surrounding blanks, a sign, leading zeros and single underscores between digits are accepted;
fractions, exponents, other bases and empty text are not. Blanks are space, tab, line feed,
vertical tab, form feed and carriage return; digits and blanks must be ASCII. A well-formed integer
that is used and does not fit its type (38 digits, 64 bits for seconds) raises, as a sum beyond it
does; one that is only checked may have any length.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER = "decimal(38,0)"

# Fixed value: the accepted integer form. Possessive, because it can never match by giving back.
INTEGER_FORM = r"\A\s*+[+-]?+[0-9]++(?:_[0-9]++)*+\s*+\z"


def _digits(text: Column) -> Column:
    return F.when(text.contains("_"), F.replace(text, F.lit("_"), F.lit(""))).otherwise(text)


def _parse(text: Column, kind: str) -> Column:
    # The cast alone takes too much (1.5, 1e5), so it only sees text of the right form. It trims the
    # blanks itself, and in ANSI mode raises on what does not fit.
    return F.when(text.rlike(INTEGER_FORM), _digits(text).cast(kind))


def to_integer(text: Column) -> Column:
    """Integer as decimal(38,0), NULL where the text is not one; more than 38 digits raise."""
    return _parse(text, INTEGER)


def to_epoch(text: Column) -> Column:
    """Epoch seconds as bigint, NULL where the text is not an integer; more than 64 bits raise."""
    return _parse(text, "bigint")


def is_integer(text: Column) -> Column:
    """Whether the text is an integer, of any length."""
    return F.coalesce(text.rlike(INTEGER_FORM), F.lit(False))


def fitting(text: Column, kind: str) -> Column:
    """Integer of the given type, NULL where the text is not one or does not fit the type."""
    return F.when(text.rlike(INTEGER_FORM), _digits(text).try_cast(kind))
