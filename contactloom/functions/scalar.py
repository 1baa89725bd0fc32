"""Text, date, number and predicate helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_date(d: date | str | Column) -> Column:
    return d if isinstance(d, Column) else F.lit(str(d)).cast("date")


# ---- predicates ------------------------------------------------------------------------------


def folded(c: Column | str) -> Column:
    """Trimmed and upper-cased, the form in which free-typed keys are compared."""
    return F.upper(F.trim(column(c)))


def ci_eq(c: Column | str, value: str) -> Column:
    return folded(c) == value.upper()


def like_any(c: Column | str, patterns: Sequence[str]) -> Column:
    return reduce(or_, [column(c).like(p) for p in patterns])


def like_escape(c: Column | str, pattern: str, escape: str = "!") -> Column:
    return F.like(column(c), F.lit(pattern), F.lit(escape))


def present(c: Column | str, sentinel: str = "-1") -> Column:
    """Neither NULL nor the sentinel."""
    c = column(c)
    return c.isNotNull() & (c != sentinel)


def any_slot_equals(cols: Sequence[Column | str], value: str) -> Column:
    return reduce(or_, [F.upper(column(c)) == value for c in cols])


def record_state_policy(state: Column | str, extract_date: Column, cutoff: str,
                        first_run: Sequence[str], later_runs: Sequence[str]) -> Column:
    """States to extract: the first run takes few, later runs more, a missing date none."""
    state, day = column(state), as_date(cutoff)
    return (state.isin(list(first_run)) & (extract_date == day)) | (
        state.isin(list(later_runs)) & (extract_date > day))


def open_ended(end: Column | str) -> Column:
    """Definition rows that never expire carry an end date in a year ending in 99."""
    return F.date_format(column(end), "yy") == "99"


def activity_bounds(ts: Column | str, low: date | str, before: date | Column | None = None) -> Column:
    day = F.to_date(column(ts))
    cond = day >= as_date(low)
    return cond if before is None else cond & (column(ts) < as_date(before))


# ---- text ------------------------------------------------------------------------------------


def blank_to_null(c: Column | str, tokens: Sequence[str] = ("", "-")) -> Column:
    c = column(c)
    return F.when(c.isin(list(tokens)), None).otherwise(c)


def sentinel_to_null(c: Column | str, tokens: Sequence[str] = ("-1", "", "-", "NA")) -> Column:
    return blank_to_null(c, tokens)


def percent_text(c: Column | str) -> Column:
    return F.concat(F.round(column(c)).cast("long").cast("string"), F.lit("%"))


def glue(*cols: Column | str, null_as_empty: bool = False) -> Column:
    """Concatenate.  ``null_as_empty`` is for data whose home dialect ignores NULL operands."""
    parts = [column(c) for c in cols]
    if null_as_empty:
        parts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(*parts)


def tail(c: Column | str, n: int, whole_only: bool = False) -> Column:
    """Last ``n`` characters; with ``whole_only`` a shorter text gives NULL instead of itself."""
    c = column(c)
    last = F.right(c, F.lit(n))
    return F.when(F.length(c) >= n, last) if whole_only else last


def before_comma(c: Column | str) -> Column:
    """Text before the first comma; texts without one, or starting with one, stay whole."""
    c = column(c)
    return F.when(F.instr(c, ",") > 1, F.substring_index(c, ",", 1)).otherwise(c)


def after_bar(c: Column | str) -> Column:
    """Everything right of the first '|'."""
    c = column(c)
    return F.right(c, F.length(c) - F.instr(c, "|"))


def first_token(c: Column | str, separator: str = "_") -> Column:
    return F.regexp_substr(column(c), F.lit(f"[^{separator}]+"))


def slot_lookup(wanted: str, slots: Sequence[tuple[str, str]], default: str = "UNKNOWN") -> Column:
    """Value of the first slot whose name is ``wanted``, even when that value is NULL."""
    out = None
    for name, value in slots:
        hit = F.upper(F.col(name)) == wanted
        out = F.when(hit, F.col(value)) if out is None else out.when(hit, F.col(value))
    return out.otherwise(default)


def label_code(c: Column | str, labels: Mapping[str, str]) -> Column:
    """Simple CASE over a small fixed mapping; anything else is NULL."""
    c, out = column(c), None
    for key, label in labels.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return out


# ---- dates and numbers -----------------------------------------------------------------------


def month_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("month", column(c)))


def week_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("week", column(c)))


def quarter_start(c: Column | str) -> Column:
    return F.to_date(F.date_trunc("quarter", column(c)))


def friday_of_week(c: Column | str) -> Column:
    """Friday of the Monday-based week; a weekend day belongs to the Friday before it."""
    return F.date_add(week_start(c), 4)


def to_second(c: Column | str) -> Column:
    return F.date_trunc("second", column(c))


def day_number(c: Column | str) -> Column:
    return F.date_format(column(c), "yyyyMMdd").cast("int")


def day_from_digits(c: Column | str) -> Column:
    """First eight digits read as yyyyMMdd; the rest of the text is time of day."""
    return F.to_date(F.try_to_timestamp(F.substring(column(c), 1, 8), F.lit("yyyyMMdd")))


def age_years(born: Column | str, as_of: date | Column) -> Column:
    return F.floor(F.datediff(as_date(as_of), column(born)) / F.lit(365.2425)).cast("int")


def whole_number(c: Column | str) -> Column:
    return column(c).try_cast("bigint")


def never_when(cond: Column, otherwise: Column | str, never: str) -> Column:
    return F.when(cond, F.lit(never).cast("timestamp")).otherwise(column(otherwise).cast("timestamp"))


def yes_no(cond: Column) -> Column:
    return F.when(cond, "Y").otherwise("N")


def flag_letter(c: Column | str) -> Column:
    """'1' in the definition tables becomes Y; everything else, NULL included, N."""
    return yes_no(column(c) == "1")
