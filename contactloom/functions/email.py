"""Address checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import fixed_values as V
from contactloom.functions.scalar import column, like_any


def invalid_email(c: Column | str) -> Column:
    """The rule as it takes effect: NULL or empty, an inner space, a closing dot, two or more
    at-signs, no dot at all, or exactly '.@'.  A missing at-sign is not caught, and a text of
    blanks only passes (its trimmed form is NULL, so every comparison is unknown)."""
    raw = F.nullif(column(c), F.lit(""))
    text = F.nullif(F.trim(raw), F.lit(""))
    ats = F.length(text) - F.length(F.replace(text, F.lit("@"), F.lit("")))
    faults = (text.contains(" ") | text.endswith(".") | (ats > 1)
              | ~text.contains(".") | (raw == ".@"))
    return raw.isNull() | F.coalesce(faults, F.lit(False))


def blocked_domain(c: Column | str, patterns: Sequence[str] = tuple(V.BLOCKED_DOMAINS)) -> Column:
    return like_any(F.upper(column(c)), patterns)
