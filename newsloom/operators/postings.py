"""Three-character postings for contains-search on titles and tags.

A posting says that a gram occurs in an article's title or in one of its
tags. A contains-pattern's literal parts of three characters and more give the
grams its hits must have, so the articles that have them all are candidates,
which the search predicate itself then decides. Grams of different tags, or of
tags an article no longer has, only make a candidate too many. Patterns
without such a part have no candidates here; they are searched by the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.patterns import literal_parts

SIZE = 3
TITLE, TAG = "title", "tag"


def grams(text: Column) -> Column:
    """Distinct grams of a text, in lower case as the search compares it."""
    def of(low: Column) -> Column:
        last = F.char_length(low) - (SIZE - 1)
        return F.when(last >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(low, i, F.lit(SIZE)))))

    # The lower-cased text is one element, so it is made once a text.
    return F.coalesce(F.element_at(F.transform(F.array(F.lower(text)), of), 1), F.array().cast("array<string>"))


def postings(rows: DataFrame, keep: tuple[str, ...] = ("month",), fields: tuple[str, ...] = (TITLE, TAG)) -> DataFrame:
    """``(gram, field, id, *keep)`` of articles."""
    tags = F.coalesce(F.array_compact("tags"), F.array().cast("array<string>"))
    found = {TITLE: grams(F.col("title")), TAG: F.array_distinct(F.flatten(F.transform(tags, grams)))}
    parts = [rows.select("id", *keep, F.lit(f).alias("field"), F.explode(found[f]).alias("gram")) for f in fields]
    return reduce(DataFrame.unionByName, parts).select("gram", "field", "id", *keep)


def pattern_grams(spark, text: str, literal: bool = False) -> list[str]:
    """Grams that every hit of a contains-pattern has (empty: none known)."""
    parts = [p for p in literal_parts(text, literal) if len(p) >= SIZE]
    if not parts:
        return []
    row = spark.range(1).select(F.array_distinct(F.concat(*[grams(F.lit(p)) for p in parts])).alias("g")).first()
    return sorted(row["g"])


def candidates(index: DataFrame, wanted: list[str], fields: tuple[str, ...], keep: tuple[str, ...] = ("month",)) -> DataFrame:
    """``(id, *keep)`` of the articles that have all of ``wanted`` in one of
    ``fields``. Only postings of those grams are read (buckets are pruned)."""
    hits = index.filter(F.col("gram").isin(wanted) & F.col("field").isin(list(fields)))
    return (hits.groupBy("id", *keep, "field").agg(F.size(F.collect_set("gram")).alias("n"))
            .filter(F.col("n") == len(wanted)).select("id", *keep).distinct())
