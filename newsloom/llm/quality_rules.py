"""Quality rules: a table of thresholds compiled into one projection.

Each document is measured (lengths, symbols, stop words, lines, repeated
stretches) and each rule of a table bounds the percentage of one measure in
another. Measures and rules are built-in expressions over a row's own text:
no user function, no join, no shuffle; the work is linear in the text but for
a sort of the windows of documents that repeat some.

Words are runs of anything but ASCII white space; lines are split at ``\\n``
and count when they hold a word. A null text has no words and fails, as an
empty one does; rows are independent, so repeated rows and null ids are rows
like others, and an empty table gives an empty result. Columns other than
``doc_id``, ``text`` and ``lang`` are not read by :func:`judge`;
:func:`keep_good` returns all columns of its input unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window of the repetition measure.
WINDOW = 8

# The most frequent function words of the languages that the
# stop-word rule knows.
STOP_WORDS = {
    "en": "the of and to a in is that it for was on with as be by are this at from",
    "de": "der die und in den von zu das sich mit des auf für ist im nicht dem ein eine als",
    "fr": "de la le et les en des un du une que est pour par dans avec qui pas sur au",
    "es": "de la que el en y los las se del un por con no una su para es al lo",
}


class Rule(NamedTuple):
    """``low`` and ``high``: whole percentages of ``part`` in ``whole``
    (both measures), inclusive; None where the rule has no such end.
    ``langs``: languages it holds for (None: all)."""

    name: str
    part: str
    whole: str
    low: int | None
    high: int | None
    langs: tuple[str, ...] | None = None


#: The default table. Percentages are compared in whole numbers, so that a
#: document on a bound is decided alike everywhere.
RULES = (
    Rule("too_few_words", "n_words", "one", 20 * 100, None),
    Rule("repeated_stretches", "n_repeat_words", "n_words", None, 30),
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 25),
    Rule("stop_words", "n_stop_words", "n_words", 1, None, tuple(STOP_WORDS)),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90),
    Rule("cut_lines", "n_cut_lines", "n_lines", None, 30),
)
#: Rules of the table that every caller's table has.
BASE = ("too_few_words", "repeated_stretches")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_stop_words", "n_lines", "n_bullet_lines", "n_cut_lines")


def _minus(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def _with(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _neighbours(items: Column) -> Column:
    n = F.size(items) - 1
    return F.arrays_zip(F.slice(items, F.lit(1), n).alias("a"), F.slice(items, F.lit(2), n).alias("b"))


def _covered(places: Column) -> Column:
    """Words covered by windows at ``places`` (ascending): each covers up to
    the next one, the last its whole length."""
    gaps = F.transform(_neighbours(places), lambda p: F.least(p["b"] - p["a"], F.lit(WINDOW)))
    return F.aggregate(gaps, F.lit(WINDOW), lambda s, g: s + g)


def _windows(words: Column, n_windows: Column) -> Column:
    """Structs of the words of every window, in order."""
    return F.arrays_zip(*[F.slice(words, F.lit(i + 1), n_windows).alias(f"w{i}") for i in range(WINDOW)])


def _joined(hashes: Column, by: int) -> Column:
    """Hashes of windows twice as long: each joined with the one ``by``
    places on."""
    n = F.greatest(F.size(hashes) - by, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(by + 1), n), lambda a, b: F.xxhash64(a, b))


def _distinct(items: Column) -> Column:
    return F.size(F.array_distinct(items)) == F.size(items)


def _repeated(words: Column, halves: Column) -> Column:
    """Words covered by the windows that occur at least twice. Equal windows
    have equal hashes, and so have their halves (``halves``: hashes of the
    windows of half the length), so distinct hashes settle most documents;
    the windows of the others are sorted and compared in full with their
    neighbour."""
    n_windows = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    windows = F.transform(_windows(words, n_windows), lambda w, i: F.struct(
        F.xxhash64(w).alias("hash"), w.alias("words"), i.alias("at")))

    def equal(ordered: Column) -> Column:
        return F.filter(_neighbours(ordered), lambda p: (p["a"]["hash"] == p["b"]["hash"])
                        & (p["a"]["words"] == p["b"]["words"]))

    def covered(pairs: Column) -> Column:
        places = F.sort_array(F.array_distinct(F.concat(pairs["a"]["at"], pairs["b"]["at"])))
        # Without a place, only hashes collided.
        return _with(places, lambda at: F.when(F.size(at) > 0, _covered(at)).otherwise(0))

    full = _with(F.sort_array(windows), lambda ordered: _with(equal(ordered), covered))
    whole = _with(_joined(halves, WINDOW // 2), lambda h: F.when(_distinct(h), F.lit(0)).otherwise(full))
    return F.when(_distinct(halves), F.lit(0)).otherwise(whole)


def _stop_words(words: Column, lang: Column | None) -> Column:
    def among(listed) -> Column:
        return F.size(F.filter(words, lambda w: F.lower(w).isin(listed)))

    found = among(sorted({w for ws in STOP_WORDS.values() for w in ws.split()}))
    if lang is not None:
        for code, listed in STOP_WORDS.items():
            found = F.when(lang == code, among(listed.split())).otherwise(found)
    return found


def measure(docs: DataFrame, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """``docs`` with a struct ``_measures`` of long :data:`MEASURES`.

    Arrays that later steps read more than once are columns of their own;
    functions over arrays read nothing but their elements, so nothing is
    computed once an element."""
    own_lang = F.col(lang) if lang and lang in docs.columns else None
    t = F.coalesce(F.col(text), F.lit(""))
    step = docs.withColumn("_q_text", t)
    step = step.withColumn("_q_words", F.filter(F.split("_q_text", SPACE), lambda w: w != ""))
    step = step.withColumn("_q_lines", F.filter(F.split("_q_text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != ""))
    n = F.size("_q_words")
    step = step.withColumn("_q_halves", F.transform("_q_words", lambda w: F.xxhash64(w)))
    for by in (1, 2):
        step = step.withColumn("_q_halves", _joined(F.col("_q_halves"), by))
    words, lines = F.col("_q_words"), F.col("_q_lines")
    solid = F.char_length(_minus(F.col("_q_text"), BLANKS))
    values = {
        "n_words": n,
        "word_chars": solid,
        "n_symbols": F.char_length("_q_text") - F.char_length(_minus(F.col("_q_text"), SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated(words, F.col("_q_halves")),
        "n_stop_words": _stop_words(words, own_lang),
        "n_lines": F.size(lines),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^ *[-*\x{2022}]"))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|\x{2026}) *\z"))),
    }
    packed = F.struct(*[values[m].cast("long").alias(m) for m in MEASURES])
    return step.withColumn("_measures", packed).drop("_q_text", "_q_words", "_q_lines", "_q_halves")


def compile_rules(measures: Column, lang: Column | None = None, rules: Sequence[Rule] = RULES) -> Column:
    """Names of the rules a document breaks, in the table's order: the whole
    table as one expression over the measures. A rule on a percentage of
    nothing is not broken."""
    unknown = {m for r in rules for m in (r.part, r.whole)} - {*MEASURES, "one"}
    if unknown:
        raise ValueError(f"no such measures: {sorted(unknown)}")
    broken = []
    for r in rules:
        part, whole = (F.lit(1) if m == "one" else measures[m] for m in (r.part, r.whole))
        out = F.lit(False)
        if r.low is not None:
            out = out | (part * 100 < whole * r.low)
        if r.high is not None:
            out = out | (part * 100 > whole * r.high)
        if r.langs is not None and lang is not None:
            out = out & F.coalesce(lang.isin(*r.langs), F.lit(False))
        broken.append(F.when(out, F.lit(r.name)))
    return F.array_compact(F.array(*broken))


def _judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    lang = F.col("lang") if "lang" in docs.columns else None
    return measure(docs).withColumn("_broken", compile_rules(F.col("_measures"), lang, rules))


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the measures, ``broken``
    (names of the rules it breaks), ``base_failed`` and ``kept``."""
    read = [c for c in ("doc_id", "text", "lang") if c in docs.columns]
    base = F.array(*[F.lit(r.name) for r in rules if r.name in BASE]).cast("array<string>")
    return _judged(docs.select(*read), rules).select(
        "doc_id", *[F.col("_measures")[m].alias(m) for m in MEASURES], F.col("_broken").alias("broken"),
        F.arrays_overlap("_broken", base).alias("base_failed"), (F.size("_broken") == 0).alias("kept"))


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that break no rule, with all their columns."""
    return _judged(docs, rules).filter(F.size("_broken") == 0).select(*docs.columns)
