"""Tolerant number parsing and the substitution-rate arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerant_int(text: Column) -> Column:
    """Integer value of ``text``, or null when it is not one.

    Surrounding blanks, a sign and single underscores between digits are accepted. The form
    is tested first: a cast that fails costs far more than the test.
    """
    number = F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint")
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+(?:_[0-9]+)*\s*\z"), number)


def joined_digits(text: Column) -> Column:
    """All digits of ``text`` read as one number; null when there are none."""
    return F.nullif(F.regexp_replace(text, "[^0-9]", ""), F.lit("")).try_cast("bigint")


def jukes_cantor(p: Column) -> Column:
    """Jukes-Cantor distance of a difference proportion; null from 0.75 on, where it diverges."""
    return F.when(p < 0.75, F.lit(-0.75) * F.ln(1 - (4 * p / 3)))
