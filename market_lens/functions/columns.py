"""Column helpers shared by the scalar functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_containing(text: ColumnOrName, words: Iterable[tuple[str, list[str]]], default: Column | None = None) -> Column:
    """Label of the first entry of ``words`` that has a word contained in ``text``."""
    text = col(text)
    branches = None
    for label, needles in words:
        hit = text.contains(needles[0])
        for needle in needles[1:]:
            hit = hit | text.contains(needle)
        branches = F.when(hit, F.lit(label)) if branches is None else branches.when(hit, F.lit(label))
    return branches if default is None else branches.otherwise(default)


def band(value: ColumnOrName, bands: list[tuple[float | None, str]]) -> Column:
    """Label of the half-open band that holds ``value``; a missing value has no band."""
    value = col(value)
    labels = F.when(value.isNull(), F.lit(None).cast("string"))
    for upper, label in bands:
        labels = labels.otherwise(F.lit(label)) if upper is None else labels.when(value < upper, F.lit(label))
    return labels


_NUMBER = r"(?i)^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf(?:inity)?)\s*$"


def to_number(c: ColumnOrName) -> Column:
    """The value as a double; text that is no plain number (``12d``, ``0x1p3``), and NaN, become null."""
    value = col(c)
    plain = F.when(value.cast("string").rlike(_NUMBER), value)
    return F.nanvl(plain.try_cast("double"), F.lit(None).cast("double"))


def round_half_even(c: ColumnOrName, digits: int = 1) -> Column:
    scale = 10.0**digits
    return F.rint(col(c) * scale) / scale


def non_empty(c: ColumnOrName) -> Column:
    """Null for the empty text. Names its argument once, so a long expression is not copied."""
    return F.get(F.array_remove(F.array(col(c)), ""), F.lit(0))


def evaluated_once(**columns: Column) -> Column:
    """The columns as the output of a one-row generator, for use in a ``select``.

    A later filter on a plain computed column is pushed below it together with a copy of
    its expression, which is then evaluated twice. A generator's output is not copied.
    """
    return F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])))
