"""DuckDB SQL fragments restating the scalar functions, for oracle queries."""

from __future__ import annotations

import datetime as dt

from ..functions.dates import DAY_MONTH, SPANISH_MONTHS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def clean(e: str) -> str:
    return f"CASE WHEN ({e}) IS NULL OR ({e}) IN ('nan', 'None') THEN '' ELSE ({e}) END"


def title(e: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({e}), '(\\pL+|\\PL+)'), "
            f"lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || w[2:]), '')")


def title_or_blank(e: str) -> str:
    return f"CASE WHEN ({e}) IS NULL OR ({e}) = '' THEN '' ELSE {title(e)} END"


def falsy(*es: str) -> str:
    return "COALESCE(" + ", ".join(f"NULLIF({e}, '')" for e in es) + ", '')"


def nonblank(*es: str, default: str | None = None) -> str:
    parts = [f"NULLIF({e}, '')" for e in es]
    if default is not None:
        parts.append(q(default))
    return "COALESCE(" + ", ".join(parts) + ")"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')"


def hora(e: str, offset: int = -5) -> str:
    ts = f"try_strptime(substring({e}, 1, 19), '%Y-%m-%dT%H:%M:%S')"
    return (f"CASE WHEN ({e}) IS NULL OR NOT contains({e}, 'T') THEN '' ELSE "
            f"COALESCE(strftime({ts} + INTERVAL ({offset}) HOUR, '%I:%M %p'), "
            f"substring(split_part({e}, 'T', 2), 1, 5)) END")


def date_text(e: str) -> str:
    return f"COALESCE(strftime(CAST({e} AS DATE), '%Y-%m-%d'), '')"


def dlit(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def spanish_date(e: str, as_of: dt.date, slack: int = 2) -> str:
    low = strip(f"lower({e})")
    pat = q(DAY_MONTH)
    day = f"TRY_CAST(regexp_extract({low}, {pat}, 1) AS INTEGER)"
    name = f"NULLIF(regexp_extract({low}, {pat}, 2), '')"
    names = "[" + ", ".join(q(m) for m in SPANISH_MONTHS) + "]"
    keys = "[" + ", ".join(q("".join(sorted(m))) for m in SPANISH_MONTHS) + "]"
    month = (f"COALESCE(NULLIF(list_position({names}, {name}), 0), "
             f"NULLIF(list_position({keys}, array_to_string(list_sort(string_split({name}, '')), '')), 0))")

    def mk(y: int) -> str:
        return f"CAST(try_strptime(printf('%04d-%02d-%02d', {y}, {month}, {day}), '%Y-%m-%d') AS DATE)"

    lim = dlit(as_of + dt.timedelta(days=slack))
    return f"(CASE WHEN {mk(as_of.year)} > {lim} THEN {mk(as_of.year - 1)} ELSE {mk(as_of.year)} END)"


def not_contains(e: str, needles) -> str:
    return " AND ".join(f"NOT contains(lower(COALESCE({e}, '')), {q(n)})" for n in needles) or "TRUE"
