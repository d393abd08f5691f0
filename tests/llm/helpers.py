"""Small inputs with the awkward cases every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars int, kept string, _row int, component_id int"


def docs_frame(spark, rows):
    """(doc_id, text, source) rows with the other columns of documents and
    some whose names clash with the operators' own."""
    full = [(i, t, "en", s, len(t or ""), "x", 1, 2) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def words(rng: random.Random, n: int, vocabulary: int = 5000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def awkward(rng: random.Random):
    """Null, empty, blank, short, long, repeated and tied rows."""
    long_text = " ".join(words(rng, 20_000))
    return [(1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r ", None), (4, "one two", "b"), (5, "one  two", "b"),
            (6, long_text, "c"), (7, long_text + " ", "c"), (8, "same text here now ok", "a"),
            (8, "same text here now ok", "a"), (9, "ünï cödé     text \U0001f600", "b"),
            (None, "one two", "a"), (None, None, None)]
