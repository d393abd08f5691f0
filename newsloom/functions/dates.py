"""Date resolution for article pages, in built-in expressions only.

Precedence: first ``<time>`` text, then the first date ``<meta>``, then the
first element with a date-like class. An exact ``YYYY-MM-DD`` string is taken
as is (an impossible day becomes NULL and is flagged ``bad_date``, the article
is kept). Other text is read by a small grammar. It becomes typed tokens (month
name, year, number, day, weekday, chains of numbers, relative words, clock
times), and a fold over them fills the fields of the date that is being read,
so that forms with the year first, last or missing, with names, units or
separators, all share one mechanism:

- four digits, ``'24``, ``2024年`` and eras (``令和6年``) are years; ordinals
  and ``5日`` are days; other numbers of one or two digits are the day, then
  the year (of the century around ``ref_date``);
- chains are year first, or month first as the reference reads them unless
  the first number can't be a month; longer or odd chains are no dates;
- ``of``, ``the``, weekdays and clock times may stand between the fields, any
  other word ends the date.

The complete date that comes first counts, and one that is no calendar day is
passed over; without one, the partial or relative date that comes first is
filled up from an explicit ``ref_date``, clock times alone coming last. No
clock is read: without ``ref_date`` those are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"

_FULLWIDTH = "０１２３４５６７８９"
_ASCII = "0123456789"

def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def first_present(*cols) -> Column:
    """First value that is neither NULL nor empty (whitespace counts as present)."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols])


def is_iso_day(col) -> Column:
    """Exact ``YYYY-MM-DD`` (ASCII digits, nothing after, not even a newline)."""
    return F.coalesce(_c(col).rlike(ISO_DAY), F.lit(False))


def _ymd(y, m, d) -> Column:
    """The day, null where it isn't one."""
    part = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.try_to_date(F.concat_ws("-", F.lpad(part(y).cast("string"), 4, "0"), part(m).cast("string"), part(d).cast("string")), "yyyy-M-d")


def ascii_digits(col) -> Column:
    return F.translate(_c(col), _FULLWIDTH, _ASCII)


# English month and weekday names and their abbreviations, and
# the year before the first one of Japanese eras.
MONTHS = {name: i for i, names in enumerate((
    "jan january", "feb february", "mar march", "apr april", "may", "jun june", "jul july", "aug august",
    "sep sept september", "oct october", "nov november", "dec december"), start=1) for name in names.split()}
WEEKDAYS = {name: i for i, names in enumerate((
    "mon monday", "tue tues tuesday", "wed wednesday", "thu thur thurs thursday", "fri friday", "sat saturday",
    "sun sunday")) for name in names.split()}
ERAS = {"令和": 2018, "平成": 1988, "昭和": 1925, "大正": 1911, "明治": 1867}
UNITS = ("second", "minute", "hour", "day", "week", "month", "year")

_CHAIN = r"[0-9]+(?:[-/.][0-9]+)+"
_ERA = "(?:" + "|".join(ERAS) + r")\s*(?:[0-9]{1,2}|元)\s*年"
_AGO = r"[0-9]{1,3}\s+(?:" + "|".join(UNITS) + r")s?\s+ago\b"
_TOKEN = "|".join((
    r"[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?", _CHAIN, _AGO, _ERA, r"[0-9]+\s*[年月日]",
    r"(?<![0-9\p{L}])['’][0-9]{2}(?![0-9])", r"[0-9]+(?:st|nd|rd|th)\b", r"[0-9]+", r"just now\b", r"[\p{L}\p{M}]+"))


def _lookup(names: dict[str, int], word: Column) -> Column:
    """Number of a name, null for other words."""
    return F.get(F.array(*[F.lit(n) for n in names.values()]),
                 F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), word), F.lit(0)).cast("int") - 1)


_FIELDS = ("a", "b", "c")


def _token(kind: str, *values: Column, short: Column | None = None) -> Column:
    """A typed token: ``kind``, up to three numbers, and whether its year has
    two digits only."""
    numbers = [*values, *[F.lit(None)] * (3 - len(values))]
    return F.struct(F.lit(kind).alias("kind"), *[v.cast("int").alias(f) for v, f in zip(numbers, _FIELDS)],
                    (F.lit(False) if short is None else F.coalesce(short, F.lit(False))).alias("short"))


def _chain_token(word: Column, stop: Column) -> Column:
    """Two or three numbers with separators; ``stop`` if they are no date."""
    parts = F.split(word, "[-/.]")
    at = lambda i: F.get(parts, F.lit(i))
    size = lambda i: F.char_length(at(i))
    number = lambda i: F.when(size(i) <= 4, F.try_to_number(at(i), F.lit("9999"))).cast("int")
    x, y, z = number(0), number(1), number(2)
    low = lambda *i: F.forall(F.array(*[size(k) for k in i]), lambda n: n <= 2)
    three = (F.when((size(0) == 4) & low(1, 2), _token("full", x, y, z))
              .when(low(0, 1) & size(2).isin(2, 4) & (x > 31) & (size(2) == 2), _token("full", x, y, z, short=F.lit(True)))
              .when(low(0, 1) & size(2).isin(2, 4) & (x > 12), _token("full", z, y, x, short=size(2) == 2))
              .when(low(0, 1) & size(2).isin(2, 4), _token("full", z, x, y, short=size(2) == 2))
              .otherwise(stop))
    two = (F.when((size(0) == 4) & low(1) & ~F.contains(word, F.lit(".")), _token("pair", x, y))
            .when(low(0, 1) & F.contains(word, F.lit("/")) & (x > 12), _token("pair", F.lit(None), y, x))
            .when(low(0, 1) & F.contains(word, F.lit("/")), _token("pair", F.lit(None), x, y))
            .when(low(0) & (size(1) == 4) & ~F.contains(word, F.lit(".")), _token("pair", y, x))
            .otherwise(stop))
    return F.when(F.size(parts) == 3, three).when(F.size(parts) == 2, two).otherwise(stop)


def _typed(word: Column) -> Column:
    """The token that a piece of text is."""
    stop = _token("stop")
    digits = F.regexp_extract(word, "[0-9]+", 0)
    number = F.when(F.char_length(digits).between(1, 4), F.try_to_number(digits, F.lit("9999"))).cast("int")
    size = F.char_length(digits)
    era = F.coalesce(*[F.when(F.startswith(word, F.lit(name)), F.lit(year)) for name, year in ERAS.items()])
    unit = F.regexp_extract(word, "(" + "|".join(UNITS) + ")", 1)
    ends = lambda x: F.endswith(word, F.lit(x))
    is_word = size == 0
    month, weekday = _lookup(MONTHS, word), _lookup(WEEKDAYS, word)
    return (F.when(F.contains(word, F.lit(":")), _token("clock"))
             .when(word.rlike("^" + _CHAIN + r"\z"), _chain_token(word, stop))
             .when(ends("ago") & ~is_word, _token("ago", number, F.array_position(F.array(*[F.lit(u) for u in UNITS]), unit)))
             .when(era.isNotNull() & ends("年"), _token("year", era + F.coalesce(number, F.lit(1))))
             .when(is_word & month.isNotNull(), _token("month", month))
             .when(is_word & weekday.isNotNull(), _token("weekday", weekday))
             .when(word == "yesterday", _token("ago", F.lit(1), F.lit(4)))
             .when(word.isin("today", "just now"), _token("ago", F.lit(0), F.lit(4)))
             .when(word.isin("of", "the"), _token("fill"))
             .when(is_word, stop)
             .when(ends("年"), F.when(size == 4, _token("year", number)).otherwise(stop))
             .when(ends("月"), F.when(size <= 2, _token("month", number)).otherwise(stop))
             .when(ends("日") | word.rlike("[a-z]"), F.when(size <= 2, _token("day", number)).otherwise(stop))
             .when(word.rlike("^['’]"), _token("year", number, short=F.lit(True)))
             .when(size == 4, _token("year", number))
             .when(size <= 2, _token("number", number))
             .when(size.isin(8, 12, 14), _token("full", *[F.try_to_number(F.substring(digits, i, n), F.lit("9999")).cast("int")
                                                          for i, n in ((1, 4), (5, 2), (7, 2))]))
             .otherwise(stop))


# The fold's state: the fields of the date being read (``soft``: a second
# number, a year unless a definite one follows), the first complete date, the
# first partial one (``how`` it is filled up) and whether a clock time was seen.
_STATE = {"y": "int", "short": "boolean", "m": "int", "d": "int", "soft": "int", "w": "int",
          "cy": "int", "cshort": "boolean", "cm": "int", "cd": "int",
          "how": "string", "py": "int", "pshort": "boolean", "pm": "int", "pd": "int", "clock": "boolean"}
_OPEN = ("y", "m", "d", "soft", "w")


def _state(acc: Column | None, **changes) -> Column:
    cols = []
    for name, kind in _STATE.items():
        if name in changes or acc is None:
            value = changes.get(name)
            cols.append((value if isinstance(value, Column) else F.lit(value)).cast(kind).alias(name))
        else:
            cols.append(acc[name].alias(name))
    return F.struct(*cols)


_EMPTY = {name: None for name in _OPEN} | {"short": False}


def _use(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _taken(acc: Column, year: Column, short: Column, month: Column, day: Column) -> Column:
    """A date was read to its end: it is the result if it is a day."""
    ok = _ymd(F.when(short, year + 2000).otherwise(year), month, day).isNotNull()
    return _state(acc, **_EMPTY, cy=F.when(ok, year), cshort=short, cm=F.when(ok, month), cd=F.when(ok, day))


def _close(acc: Column) -> Column:
    """The date being read ends here: with a second number it is complete,
    else it may be the first partial one."""
    by_soft = acc["m"].isNotNull() & acc["d"].isNotNull() & acc["soft"].isNotNull()
    how = F.coalesce(acc["how"], F.when(acc["m"].isNotNull() & acc["d"].isNotNull(), "md"),
                     F.when(acc["m"].isNotNull() & acc["y"].isNotNull(), "ym"), F.when(acc["w"].isNotNull(), "w"))
    first = lambda old, new: F.when(acc["how"].isNotNull(), acc[old]).otherwise(new)
    ended = _state(acc, **_EMPTY, how=how, py=first("py", acc["y"]), pshort=first("pshort", acc["short"]),
                   pm=first("pm", acc["m"]), pd=first("pd", F.when(how == "w", acc["w"]).otherwise(acc["d"])))
    return F.when(by_soft, _taken(acc, acc["soft"], F.lit(True), acc["m"], acc["d"])).otherwise(ended)


def _step(acc: Column, t: Column) -> Column:
    """One token. A token whose field is filled, or one that stands for itself,
    ends the date being read and begins the next one."""
    a, kind = t["a"], t["kind"]
    fits = lambda s: s["d"].isNull() & a.between(1, 31)
    late = lambda s: s["d"].isNull() & s["m"].isNotNull() & s["y"].isNull() & (a > 31)
    second = lambda s: s["d"].isNotNull() & s["m"].isNotNull() & s["y"].isNull() & s["soft"].isNull()
    ends = (kind.isin("stop", "pair", "full", "ago") | ((kind == "year") & acc["y"].isNotNull())
            | ((kind == "month") & acc["m"].isNotNull()) | ((kind == "day") & acc["d"].isNotNull())
            | ((kind == "number") & ~(fits(acc) | late(acc) | second(acc))))

    def filled(n: Column) -> Column:
        year, pair, number, full = kind == "year", kind == "pair", kind == "number", kind == "full"
        keep = lambda name, *cases: _cases(cases, n[name])
        ago = (kind == "ago") & n["how"].isNull()
        return _state(
            n, y=keep("y", (year | pair | full | (number & late(n)), a)),
            short=keep("short", (year | full, t["short"]), (number & late(n), F.lit(True))),
            m=keep("m", (kind == "month", a), (pair | full, t["b"])),
            d=keep("d", (year & n["soft"].isNotNull(), n["soft"]), ((kind == "day") | (number & fits(n)), a), (pair | full, t["c"])),
            soft=keep("soft", (year, F.lit(None).cast("int")), (number & second(n), a)),
            w=keep("w", ((kind == "weekday") & n["w"].isNull(), a)),
            how=keep("how", (ago, kind)), pm=keep("pm", (ago, t["b"])), pd=keep("pd", (ago, a)),
            clock=n["clock"] | (kind == "clock"))

    def whole(r: Column) -> Column:
        there = r["cm"].isNull() & r["y"].isNotNull() & r["m"].isNotNull() & r["d"].isNotNull()
        return F.when(there, _taken(r, r["y"], r["short"], r["m"], r["d"])).otherwise(r)

    read = _use(F.when(ends, _close(acc)).otherwise(acc), lambda n: _use(filled(n), whole))
    return F.when(acc["cm"].isNotNull(), acc).otherwise(read)


def _cases(cases, otherwise: Column) -> Column:
    out = F.when(*cases[0])
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def date_fields(text: Column) -> Column:
    """The fold's last state over a text (digits in ASCII)."""
    typed = F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), 0), _typed)
    return F.aggregate(F.concat(typed, F.array(_token("stop"))), _state(None, short=False, cshort=False, pshort=False, clock=False), _step)


def _full_year(y: Column, short: Column, ref: Column | None) -> Column:
    """Years of two digits: of the hundred years around the reference day,
    from 1969 to 2068 without one."""
    fixed = F.when(y < 69, y + 2000).otherwise(y + 1900)
    if ref is None:
        return F.when(short, fixed).otherwise(y)
    now = F.year(ref)
    near = now - now % 100 + y
    near = F.when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)
    return F.when(short, F.when(ref.isNull(), fixed).otherwise(near)).otherwise(y)


def _complete_day(s: Column, ref: Column | None) -> Column:
    return F.when(s["cm"].isNotNull(), _ymd(_full_year(s["cy"], s["cshort"], ref), s["cm"], s["cd"]))


def _partial(s: Column, ref: Column) -> Column:
    """A partial date filled up from ``ref``; a day that the month doesn't
    have becomes its last one."""
    n = s["pd"]
    unit = F.element_at(F.array(*[F.lit(u) for u in UNITS]), s["pm"])
    first = _ymd(_full_year(s["py"], s["pshort"], ref), s["pm"], F.lit(1))
    ago = (F.when(unit.isin("second", "minute", "hour"), ref).when(unit == "day", F.date_sub(ref, n))
            .when(unit == "week", F.date_sub(ref, n * 7)).when(unit == "month", F.add_months(ref, -n))
            .otherwise(F.add_months(ref, -12 * n)))
    weekday = F.date_add(ref, F.pmod(n - F.weekday(ref), F.lit(7)))
    day = (F.when(s["how"] == "md", _ymd(F.year(ref), s["pm"], n))
            .when(s["how"] == "ym", F.least(F.date_add(first, F.day(ref) - 1), F.last_day(first)))
            .when(s["how"] == "w", weekday).when(s["how"] == "ago", ago).when(s["clock"], ref))
    return F.when(ref.isNotNull(), day)


# What a date takes at least: a digit, a weekday or a relative word.
_SOME = r"(?i)[0-9]|\b(?:" + "|".join(sorted({n[:3] for n in WEEKDAYS})) + r")|yesterday|today|just now|元"
# Dates that most texts begin with, as the grammar reads them: year first, or
# a month name first, and what may not follow.
_PLAIN = (r"^\s*(?:[0-9]{4}[-/.][0-9]{1,2}[-/.][0-9]{1,2}(?![0-9]|[-/.][0-9])|[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日)")
_NAMED = r"(?i)^\s*(?:" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")\.?\s+[0-9]{1,2},?\s+[0-9]{4}(?![0-9\p{L}]|[-/.:][0-9])"


def _leading_day(text: Column) -> Column:
    """Day of a plain complete date at the beginning; NULL sends the text
    through the grammar, which gives the same where this gives one."""
    numbers = F.translate(F.regexp_extract(text, _PLAIN, 0), "/.年月日 \t\n\x0b\f\r", "----")
    named = _use(F.split(F.lower(F.btrim(F.regexp_extract(text, _NAMED, 0))), "[^a-z0-9]+"),
                 lambda p: _ymd(F.get(p, F.lit(2)), _lookup(MONTHS, F.get(p, F.lit(0))), F.get(p, F.lit(1))))
    return F.coalesce(F.try_to_date(F.nullif(numbers, F.lit("")), "yyyy-M-d"), named)


def _read(text: Column, of) -> Column:
    """``of`` the grammar's last state, for texts that can hold a date."""
    return F.when(text.rlike(_SOME), _use(date_fields(text), of))


def native_day(col, normalised: bool = False) -> Column:
    """Calendar day of the first complete date in free text; NULL without
    one. Pass ``normalised=True`` for a column already through
    :func:`ascii_digits` (staged as its own column, it is computed once)."""
    text = _c(col) if normalised else ascii_digits(col)
    return F.coalesce(_leading_day(text), _read(text, lambda s: _complete_day(s, None)))


def partial_day(col, ref: Column) -> Column:
    """Day of the first partial or relative date in (normalised) text, filled
    up from ``ref``; NULL without ``ref``. Hours and minutes ago are the
    reference day; a weekday is the next one, the reference day included."""
    return _read(_c(col), lambda s: _partial(s, ref))


def free_text_day(col, ref_date, normalised=None) -> Column:
    """Complete date first, else a partial or relative one, from one fold.
    ``normalised``: the same text already through :func:`ascii_digits`."""
    text = normalised if normalised is not None else ascii_digits(col)
    ref = ref_date if isinstance(ref_date, Column) else F.lit(None if ref_date is None else str(ref_date)).cast("date")
    return F.coalesce(_leading_day(text), _read(text, lambda s: F.coalesce(_complete_day(s, ref), _partial(s, ref))))


def resolve_day(raw, ref_date, normalised=None) -> Column:
    """Day from the raw date text chosen by precedence."""
    r = _c(raw)
    return F.when(is_iso_day(r), F.try_to_date(r, "yyyy-MM-dd")) \
            .otherwise(free_text_day(r, ref_date, normalised))


def bad_day(raw) -> Column:
    """Exact pattern but impossible calendar day (e.g. ``2024-13-45``)."""
    r = _c(raw)
    return is_iso_day(r) & F.try_to_date(r, "yyyy-MM-dd").isNull()


def page_date_text(fields: Column) -> Column:
    """Raw date text by precedence from a parsed page struct."""
    return first_present(fields["time_text"], fields["meta_date"], fields["class_text"])
