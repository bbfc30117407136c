"""Date scalars (F7-F12, F19) on an explicit ``as_of`` date, never the clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import col_
from .text import strip

# --- fixed values: Spanish month names, in calendar order ----------------
SPANISH_MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio",
                  "agosto", "septiembre", "octubre", "noviembre", "diciembre")
DAY_MONTH = r"^(\d+)\s+de\s+([a-záéíóúñ]+)"
# ---------------------------------------------------------------------------

ISO_SECONDS = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"


def lit_date(d: dt.date | str) -> Column:
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def to_date_(c) -> Column:
    """``DATE(x)`` for timestamps and ISO strings."""
    return F.to_date(col_(c))


def year_(c) -> Column:
    """``EXTRACT(YEAR FROM x)`` (F8)."""
    return F.year(col_(c))


def months_back(as_of: dt.date, n: int) -> Column:
    """``DATE_SUB(as_of, INTERVAL n MONTH)``: end-of-month clamps (08-31 -> 02-28)."""
    return F.add_months(lit_date(as_of), -n)


def days_back(as_of: dt.date, n: int) -> Column:
    return F.date_sub(lit_date(as_of), n)


def iso(c) -> Column:
    """A date as ``yyyy-MM-dd`` (F10: calendar strings)."""
    return F.date_format(F.to_date(col_(c)), "yyyy-MM-dd")


def tomorrow(c) -> Column:
    return iso(F.date_add(col_(c), 1))


def yesterday(c) -> Column:
    return iso(F.date_sub(col_(c), 1))


def month_start(c) -> Column:
    return iso(F.trunc(col_(c), "MM"))


def business_lookback_days(as_of_col) -> Column:
    """Monday looks back 3 days, every other day 1 (F11, ``weekday`` Mon=0)."""
    return F.when(F.weekday(col_(as_of_col)) == 0, F.lit(3)).otherwise(F.lit(1))


def is_weekend(as_of_col) -> Column:
    return F.weekday(col_(as_of_col)) >= 5


def utc_to_local_hhmm(c, offset_hours: int = -5) -> Column:
    """UTC ISO text -> ``hh:mm AM/PM`` at ``offset_hours``.

    '' when null or without ``T``; when the first 19 characters do not parse,
    the first 5 characters after the first ``T``.  The time carries no zone, so
    the session's zone and its clock changes do not matter.
    """
    c = col_(c)
    head = F.substring(c, 1, 19)
    ts = F.when(head.rlike(ISO_SECONDS), head.try_cast("timestamp_ntz"))
    local = ts + F.make_dt_interval(hours=F.lit(offset_hours))
    hour, minute = F.hour(local), F.minute(local)
    text = F.format_string("%02d:%02d %s", (hour + 11) % 12 + 1, minute, F.when(hour < 12, "AM").otherwise("PM"))
    fallback = F.substring(F.split_part(c, F.lit("T"), F.lit(2)), 1, 5)
    return (F.when(c.isNull() | ~c.contains("T"), F.lit(""))
            .otherwise(F.coalesce(F.when(local.isNotNull(), text), fallback)))


def _sorted_letters(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def spanish_day_month(c, as_of: dt.date, future_slack_days: int = 2) -> Column:
    """'23 de abril' -> date in ``as_of``'s year, or the year before when it
    would land more than ``future_slack_days`` after ``as_of`` (F19).

    Month names with a typo still match when they use the same letters
    ('abirl'); the twelve names have distinct letter multisets, so the match
    is unique.  Impossible days give null (also 29 Feb rolled into a
    non-leap year).
    """
    low = strip(F.lower(col_(c)))
    day = F.regexp_extract(low, DAY_MONTH, 1).try_cast("int")
    name = F.nullif(F.regexp_extract(low, DAY_MONTH, 2), F.lit(""))
    names = F.array(*[F.lit(m) for m in SPANISH_MONTHS])
    keys = F.array(*[F.lit("".join(sorted(m))) for m in SPANISH_MONTHS])
    month = F.coalesce(F.nullif(F.array_position(names, name), F.lit(0)),
                       F.nullif(F.array_position(keys, _sorted_letters(name)), F.lit(0)))

    def mk(year: int) -> Column:
        txt = F.format_string("%04d-%02d-%02d", F.lit(year), month, day)
        return F.try_to_date(txt, "yyyy-MM-dd")

    this_year = mk(as_of.year)
    limit = lit_date(as_of + dt.timedelta(days=future_slack_days))
    return F.when(this_year > limit, mk(as_of.year - 1)).otherwise(this_year)
