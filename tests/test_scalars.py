"""Scalar functions against small pure-Python restatements of the behaviour."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitflow.functions import dates, text
from visitflow.functions.dates import SPANISH_MONTHS


def py_hhmm(s):
    if not s or "T" not in str(s):
        return ""
    try:
        t = dt.datetime.strptime(str(s)[:19], "%Y-%m-%dT%H:%M:%S") - dt.timedelta(hours=5)
        return t.strftime("%I:%M %p")
    except ValueError:
        return str(s).split("T")[1][:5]


def py_clean(v):
    v = str(v) if v else ""
    return "" if v in ("nan", "None") else v


def py_report_date(s, today):
    if not s:
        return None
    m = re.match(r"(\d+)\s+de\s+([a-záéíóúñ]+)", s.lower().strip())
    if not m:
        return None
    day, name = int(m.group(1)), m.group(2)
    months = {n: i + 1 for i, n in enumerate(SPANISH_MONTHS)}
    num = months.get(name)
    if not num:
        key = "".join(sorted(name))
        num = next((i for n, i in months.items() if "".join(sorted(n)) == key), None)
    if not num:
        return None
    try:
        cand = dt.date(today.year, num, day)
    except ValueError:
        return None
    if cand > today + dt.timedelta(days=2):
        try:
            cand = dt.date(today.year - 1, num, day)
        except ValueError:
            return None
    return cand


def one_col(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_utc_to_local_all_branches(spark):
    vals = ["2026-04-24T20:00:00.000Z", "2026-04-24T9:00:00.000Z", "", None, "2026-04-24T03:05:00",
            "2026-04-24", "2026-04-24T9:00:00", "xT12345678", "2026-04-24T00:30:00"]
    assert one_col(spark, vals, dates.utc_to_local_hhmm) == [py_hhmm(v) for v in vals]


def test_title_matches_python(spark):
    vals = ["BOGOTÁ D.C.", "jamundí", "d'arc 3rd-avenue", "NATION_3", "4-NOT SPECIFIED", "", "ñandú  sur", "äußere"]
    assert one_col(spark, vals, text.py_title) == [v.title() for v in vals]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="abcXYZ áÉñ.-_'3 ", max_size=12), min_size=1, max_size=8))
def test_title_property(spark, vals):
    assert one_col(spark, vals, text.py_title) == [v.title() for v in vals]


def test_clean_and_falsy(spark):
    df = spark.createDataFrame([("nan", ""), ("None", "b"), (None, None), ("a", "b"), ("", "b")], "a string, b string")
    got = [tuple(r) for r in df.select(text.clean("a"), text.falsy_chain("a", "b")).collect()]
    exp = [(py_clean(a), a or b or "") for a, b in [("nan", ""), ("None", "b"), (None, None), ("a", "b"), ("", "b")]]
    assert got == exp


def test_lower_trim_unicode_spaces(spark):
    vals = [" Agent@Example.com ", "\tA@B.co ", "x"]
    assert one_col(spark, vals, text.lower_trim) == [v.strip().lower() for v in vals]


def test_spanish_dates(spark):
    today = dt.date(2026, 4, 23)
    vals = ["23 de abril", "23 de abirl", "30 de diciembre", "31 de febrero", "25 de abril", "26 de abril",
            "", None, "29 de febrero", " 5  DE Mayo extra", "1 de enero", "x de mayo", "12 de mayoo"]
    got = one_col(spark, vals, lambda c: dates.spanish_day_month(c, today))
    assert got == [py_report_date(v, today) for v in vals]


def test_spanish_date_leap_rollback(spark):
    # 29 Feb in a leap year that lands in the future rolls back into a non-leap year -> null
    today = dt.date(2028, 2, 1)
    assert one_col(spark, ["29 de febrero"], lambda c: dates.spanish_day_month(c, today)) == [None]


def test_subject_key(spark):
    vals = ["Fotos cliente (12345678)", "Fotos cliente 87654321", "Fotos cliente 1234567",
            "Fotos 11111111 cliente (22222222)", None]

    def py(s):
        if s is None:
            return None
        m = re.search(r"\((\d{8,})\)", s) or re.search(r"(\d{8,})", s)
        return m.group(1) if m else None

    assert one_col(spark, vals, text.subject_key) == [py(v) for v in vals]


def test_report_date_text_unicode_word(spark):
    html = ["<p>reporte del registro fotográfico del 23 de añil</p>", "<p>reporte del registro fotografico del 5 de mayo</p>",
            "<p>nada</p>"]
    assert one_col(spark, html, text.report_date_text) == ["23 de añil", "5 de mayo", ""]


def test_prefix_split_and_si(spark):
    vals = ["ps:listo", "ps:", "wa", " si ", "SI", "Cliente no estaba"]
    assert one_col(spark, vals, text.prefix_kind) == [v[:3] for v in vals]
    assert one_col(spark, vals, text.prefix_value) == [v[3:] for v in vals]
    assert one_col(spark, vals, text.is_si) == [v.upper().strip() == "SI" for v in vals]


def test_business_lookback(spark):
    days = [dt.date(2026, 4, 27), dt.date(2026, 4, 23), dt.date(2026, 4, 25)]  # Mon, Thu, Sat
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [tuple(r) for r in df.select(dates.business_lookback_days("d"), dates.is_weekend("d")).collect()]
    assert got == [(3, False), (1, False), (1, True)]


def test_add_months_clamps(spark):
    df = spark.createDataFrame([(dt.date(2026, 8, 31),)], "d date")
    assert df.select(F.add_months("d", -6)).first()[0] == dt.date(2026, 2, 28)


_MONTHISH = st.sampled_from(list(SPANISH_MONTHS) + ["abirl", "mayoo", "dicimebre", "ferbero", "xyz", "ABRIL", "Mayo"])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 35), _MONTHISH, st.sampled_from([" de ", "  de ", " DE ", " del "])),
                min_size=1, max_size=10),
       st.dates(min_value=dt.date(2020, 1, 1), max_value=dt.date(2030, 12, 31)))
def test_spanish_dates_property(spark, parts, today):
    vals = [f"{d}{sep}{m}" for d, m, sep in parts]
    got = one_col(spark, vals, lambda c: dates.spanish_day_month(c, today))
    assert got == [py_report_date(v, today) for v in vals]


_NUM = st.integers(0, 62)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 12), st.integers(1, 31), st.integers(0, 25), _NUM, _NUM,
                          st.booleans(), st.sampled_from(["T", " ", "t"]), st.sampled_from(["", ".000Z", "Z", "x"])),
                min_size=1, max_size=12))
def test_utc_to_local_property(spark, parts):
    vals = []
    for mo, d, h, mi, s, pad, sep, tail in parts:
        f = (lambda n: f"{n:02d}") if pad else str
        vals.append(f"2026-{f(mo)}-{f(d)}{sep}{f(h)}:{f(mi)}:{f(s)}{tail}")
    assert one_col(spark, vals, dates.utc_to_local_hhmm) == [py_hhmm(v) for v in vals]


_WS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0        　"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=_WS + "aZé@.", max_size=10), min_size=1, max_size=10))
def test_strip_matches_python(spark, vals):
    assert one_col(spark, vals, text.strip) == [v.strip() for v in vals]


def test_local_time_in_a_zone_with_clock_changes(spark):
    vals = ["2026-03-08T05:00:00.000Z", "2026-03-08T07:30:00", "2026-11-01T05:30:00", "2026-03-08T12:00:00"]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one_col(spark, vals, dates.utc_to_local_hhmm) == [py_hhmm(v) for v in vals]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_strings(spark):
    df = spark.createDataFrame([(dt.date(2026, 2, 28),)], "d date")
    assert tuple(df.select(dates.iso("d"), dates.tomorrow("d"), dates.yesterday("d"), dates.month_start("d")).first()) == (
        "2026-02-28", "2026-03-01", "2026-02-27", "2026-02-01")
