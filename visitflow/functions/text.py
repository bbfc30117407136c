"""Text scalars (F3-F6, F13-F18, F20-F23), all native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import col_

# --- fixed values: patterns of mail subjects and report sentences -----------
SUBJECT_KEY_IN_PARENTHESES = r"\((\d{8,})\)"
SUBJECT_KEY = r"(\d{8,})"
REPORT_DATE = r"reporte del registro fotogr.fico del (\d+ de \w+)"
# ---------------------------------------------------------------------------

# Python's str.isspace() set: Unicode White_Space plus the separators U+001C-U+001F.
# Spark's trim() strips U+0020 only.
_EDGE_WS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(c) -> Column:
    """Python ``str.strip()``."""
    return F.regexp_replace(col_(c), _EDGE_WS, "")


def lower_trim(c) -> Column:
    """``LOWER(TRIM(x))`` key normalisation."""
    return F.lower(strip(c))


def blank_to_null(c) -> Column:
    """``NULLIF(x, '')``."""
    return F.nullif(col_(c), F.lit(""))


def coalesce_nonblank(*cols, default=None) -> Column:
    """``COALESCE(NULLIF(a,''), NULLIF(b,''), default)``."""
    parts = [blank_to_null(c) for c in cols]
    if default is not None:
        parts.append(F.lit(default))
    return F.coalesce(*parts)


def falsy_chain(*cols) -> Column:
    """Python ``a or b or ''``: skips nulls *and* empty strings."""
    return coalesce_nonblank(*cols, default="")


def clean(c) -> Column:
    """null, '', 'nan', 'None' -> '' (F14)."""
    c = col_(c).cast("string")
    return F.when(c.isNull() | c.isin("nan", "None"), F.lit("")).otherwise(c)


def py_title(c) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of
    letters, lower-case the rest.  ``initcap`` alone treats only spaces as word
    breaks ("D.C." -> "D.c."), so split into letter / non-letter runs first."""
    runs = F.regexp_extract_all(F.lower(col_(c)), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def title_or_blank(c) -> Column:
    """``x.title() if x else ''``."""
    c = col_(c)
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(py_title(c))


def iso_date_part(c) -> Column:
    """Part of an ISO timestamp string before ``T``."""
    return F.split_part(col_(c), F.lit("T"), F.lit(1))


def has_at(c) -> Column:
    return F.coalesce(col_(c).contains("@"), F.lit(False))


def starts_http(c) -> Column:
    return F.coalesce(F.lower(col_(c)).startswith("http"), F.lit(False))


def all_digits(c) -> Column:
    """Python ``str.isdigit()`` on non-empty text (ASCII digits)."""
    return F.coalesce(col_(c).rlike(r"^[0-9]+$"), F.lit(False))


def is_si(c) -> Column:
    """``x.upper().strip() == 'SI'``."""
    return F.coalesce(F.upper(strip(c)) == F.lit("SI"), F.lit(False))


def not_contains_ci(c, needles) -> Column:
    """``LOWER(COALESCE(x,'')) NOT LIKE '%n%'`` for every needle."""
    low = F.lower(F.coalesce(col_(c), F.lit("")))
    cond = F.lit(True)
    for n in needles:
        cond = cond & ~low.contains(n)
    return cond


def prefix_kind(c, width: int = 3) -> Column:
    """First ``width`` characters, e.g. ``'ps:'``."""
    return F.substring(col_(c), 1, width)


def prefix_value(c, width: int = 3) -> Column:
    """Text after the prefix."""
    return F.substr(col_(c), F.lit(width + 1))


def subject_key(c) -> Column:
    """Key in a mail subject: 8+ digits in parentheses, else any 8+ digit run."""
    c = col_(c)
    return F.coalesce(blank_to_null(F.regexp_extract(c, SUBJECT_KEY_IN_PARENTHESES, 1)),
                      blank_to_null(F.regexp_extract(c, SUBJECT_KEY, 1)))


def report_date_text(c) -> Column:
    """Day and month of the report sentence; ``(?U)`` so ``\\w`` covers
    accented letters like Python does (F17)."""
    return F.regexp_extract(col_(c), "(?U)" + REPORT_DATE, 1)


def zero_default(c) -> Column:
    """``int(x or 0)``."""
    return F.coalesce(col_(c).cast("bigint"), F.lit(0).cast("bigint"))
