"""Text helpers: whitespace squeeze, tag lists, tag clean-up, topic tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip() removes (the reference strips with it),
# generated from the same rule; the highest is U+3000.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# The same set as one regular-expression class (Java and RE2 syntax).
UNICODE_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in WHITESPACE) + "]"


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def strip_unicode(col) -> Column:
    """Strip every Unicode whitespace character from both ends (a character
    set trim, no regular expression)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def squeeze(col) -> Column:
    """Remove every LF, TAB, CR and ASCII space, then strip the ends.
    Interior U+3000 and U+00A0 stay (as in the reference)."""
    return strip_unicode(F.translate(_c(col), "\n\t\r ", ""))


def split_tags(col) -> Column:
    """Tag list from model text: split on ASCII comma, strip, drop empties.
    Order and duplicates are kept; '、' and '，' do not split."""
    return F.filter(F.transform(F.split(_c(col), ","), strip_unicode), lambda t: t != F.lit(""))


# Clean-up rules the reference asks its tag generator to follow
# (year suffix dropped; legal-entity and industry suffixes removed from brand
# names), as ordered (pattern, replacement) pairs.
TAG_CLEANUP_RULES = (
    (r"^([0-9]{4})年$", "$1"),
    (r"^株式会社\s*(.+)$", "$1"),
    (r"^(.+?)\s*株式会社$", "$1"),
    (r"^(.+?)自動車$", "$1"),
)


def clean_tags(col, rules=TAG_CLEANUP_RULES, distinct: bool = False) -> Column:
    """Apply the ordered clean-up rules to every tag."""
    def one(t: Column) -> Column:
        for pat, rep in rules:
            t = F.regexp_replace(t, pat, rep)
        return t
    out = F.transform(_c(col), one)
    return F.array_distinct(out) if distinct else out


# The topic tag the reference requires on semiconductor
# articles, and the words that mark such an article.
TOPIC_RULES = (("半導体", "半導体"), ("semiconductor", "半導体"))


def topic_tags(tags, text, rules=TOPIC_RULES) -> Column:
    """Append each rule's tag when its keyword occurs in the text
    (case-insensitive) and the tag is not already present."""
    return with_topics(F.coalesce(_c(tags), F.array().cast("array<string>")), topic_hits(text, rules))


def with_topics(tags, hits) -> Column:
    """``tags`` and those of ``hits`` they lack. The hits are one array that
    is appended once, so the plan grows with the number of rules only."""
    return F.concat(tags, F.array_except(hits, F.array_append(tags, F.lit(None).cast("string"))))


def topic_hits(text, rules=TOPIC_RULES) -> Column:
    """Tags of the rules whose keyword occurs in the text, in rule order
    (null for the others)."""
    low = F.lower(_c(text))
    if not rules:
        return F.array().cast("array<string>")
    return F.array(*[F.when(F.contains(low, F.lit(k.lower())), F.lit(t)) for k, t in rules])
