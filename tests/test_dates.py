"""Free-text dates (FIXTURES section 6, our policy column)."""

import datetime as dt

from newsloom.functions import dates as D

REF = dt.date(2026, 12, 1)
CASES = [
    ("2024-03-05", dt.date(2024, 3, 5)),
    ("March 5, 2024 | By X", dt.date(2024, 3, 5)),
    ("12/25/2024", dt.date(2024, 12, 25)),
    ("25/12/2024", dt.date(2024, 12, 25)),
    ("2024.03.05", dt.date(2024, 3, 5)),
    ("2024/3/5 18:00 更新", dt.date(2024, 3, 5)),
    ("2024-03-05T23:30:00+09:00", dt.date(2024, 3, 5)),
    ("2024年3月5日", dt.date(2024, 3, 5)),
    ("2024年03月05日 10時30分", dt.date(2024, 3, 5)),
    ("２０２４-０３-０５", dt.date(2024, 3, 5)),
    ("Posted 5 Mar", dt.date(2026, 3, 5)),
    ("3 hours ago", dt.date(2026, 12, 1)),
    ("Friday", dt.date(2026, 12, 4)),
    ("", None), (" ", None), ("No date", None),
    ("2024-13-45", None),
    ("March 5, 2024 updated 2024-03-09", dt.date(2024, 3, 5)),
    ("12024-03-05", None), ("v2024.1.15.2", None), ("2024-03-051", None),
    ("2 days ago", dt.date(2026, 11, 29)), ("yesterday", dt.date(2026, 11, 30)),
    ("3月5日", dt.date(2026, 3, 5)), ("updated 10:30", dt.date(2026, 12, 1)),
    ("March 45, 2024 then 2024-03-07 10:00", dt.date(2024, 3, 7)),
    # one mechanism for all orders of the fields
    *[(s, dt.date(2024, 3, 5)) for s in (
        "5 Mar '24", "Mar 5, 24", "5 Mar 24", "2024 Mar 5", "March 5th of 2024", "令和6年3月5日", "20240305", "20240305T101500Z",
        "20240305101500", "3/5/24", "05-Mar-2024", "2024-Mar-05", "Tue Mar  5 10:15:00 2024", "Tuesday, 5 March 2024 10:00 GMT",
        "Chapter 7 March 5, 2024", "'24 Mar 5", "Sale ends 2024/02/30, from 2024/03/05")],
    ("10:15 Mar 5", dt.date(2026, 3, 5)), ("2024-03", dt.date(2024, 3, 1)), ("March 2024", dt.date(2024, 3, 1)),
    ("2024年3月", dt.date(2024, 3, 1)), ("05-03-2024", dt.date(2024, 5, 3)), ("5.3.2024", dt.date(2024, 5, 3)),
    ("may the 5 2024", dt.date(2024, 5, 5)), ("平成元年1月8日", dt.date(1989, 1, 8)), ("Sept. 3, 2021", dt.date(2021, 9, 3)),
    ("99-01-15", dt.date(1999, 1, 15)), ("31.12.99", dt.date(1999, 12, 31)), ("1 Jan 80", dt.date(1980, 1, 1)),
    ("1 Jan 70", dt.date(2070, 1, 1)), ("25/12", dt.date(2026, 12, 25)), ("3 weeks ago", dt.date(2026, 11, 10)),
    ("2 months ago", dt.date(2026, 10, 1)), ("10月3日(木) 12:00", dt.date(2026, 10, 3)), ("Friday, 10:00", dt.date(2026, 12, 4)),
    # no dates: words that only begin like a month, bare numbers, versions
    *[(s, None) for s in ("decide 5 2024", "marching 5 2024", "3 comments", "id 12345678", "1.5", "2024", "May", "Feb 30, 2024", "1.2.3.4")],
]


def test_resolve_day(spark):
    df = spark.createDataFrame([(s,) for s, _ in CASES], "s string")
    got = dict(df.select("s", D.resolve_day("s", REF).alias("d")).collect())
    for s, want in CASES:
        assert got[s] == want, s


def test_iso_pattern_rejects_trailing_newline(spark):
    df = spark.createDataFrame([("2024-03-05\n",), ("2024-03-05",), ("２０２４-０３-０５",)], "s string")
    got = dict(df.select("s", D.is_iso_day("s").alias("x")).collect())
    assert got == {"2024-03-05\n": False, "2024-03-05": True, "２０２４-０３-０５": False}


def test_bad_day_flag(spark):
    df = spark.createDataFrame([("2024-13-45",), ("2024-01-01",)], "s string")
    assert dict(df.select("s", D.bad_day("s").alias("b")).collect()) == {"2024-13-45": True, "2024-01-01": False}


def test_no_reference_day_no_clock(spark):
    """Without a reference day a partial date is NULL, a complete one is not."""
    df = spark.createDataFrame([("3 hours ago",), ("Posted 5 Mar",), ("5 Mar 2024",)], "s string")
    got = dict(df.select("s", D.resolve_day("s", None).alias("d")).collect())
    assert got == {"3 hours ago": None, "Posted 5 Mar": None, "5 Mar 2024": dt.date(2024, 3, 5)}


def test_agrees_with_the_usual_fuzzy_parser(spark):
    """Every day of two years in forms with and without a year, against the
    parser that the deviations of the other cases are stated for."""
    from dateutil import parser
    forms = ["%d %b '%y", "%b %d, %y", "%Y %b %d", "%B %dth of %Y", "%Y%m%d", "%Y%m%dT%H%M%SZ", "%m/%d/%y", "%m-%d-%Y", "%m.%d.%Y",
             "%d-%b-%Y", "%Y-%b-%d", "%a %b %d %H:%M:%S %Y", "%A, %d %B %Y %H:%M GMT", "%b %d", "%d %B", "%Y-%m", "%B %Y", "%m/%d"]
    day, texts = dt.datetime(2024, 1, 1, 10, 15), set()
    for i in range(731):
        texts |= {day.strftime(forms[i % len(forms)]), day.strftime(forms[(i * 7 + 3) % len(forms)])}
        day += dt.timedelta(days=1)
    texts = sorted(texts)
    df = spark.createDataFrame([(s,) for s in texts], "s string").repartition(4)
    got = dict(df.select("s", D.resolve_day("s", REF).alias("d")).collect())

    def usual(s):
        try:
            return parser.parse(s, fuzzy=True, default=dt.datetime(2026, 12, 1)).date()
        except ValueError:
            return None
    wrong = {s: (got[s], usual(s)) for s in texts if got[s] != usual(s)}
    assert not wrong, dict(list(wrong.items())[:10])
