"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RULES = {
    "trim": F.trim,
    "lower": lambda c: F.lower(F.trim(c)),
    "upper": lambda c: F.upper(F.trim(c)),
}


def cleaned(column: str, rule: str | None) -> Column:
    """``column`` under its own name, cleaned by ``rule`` (``trim``, ``lower`` or ``upper``; the
    latter two also trim). Only blanks are trimmed; tabs and line ends stay."""
    value = F.col(column)
    return value if rule is None else _RULES[rule](value).alias(column)
