"""Contains-pattern handling for user search text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ESCAPE = "\\"
_ESCAPABLE = "%_\\"


def normalise_like(pattern: str) -> str:
    """Rewrite a LIKE pattern so Spark accepts it with the same meaning.

    With ``\\`` as escape character, ``\\x`` for an ordinary ``x`` means a
    literal ``x`` in standard SQL engines, while Spark rejects it. Keep
    ``\\%``, ``\\_`` and ``\\\\``; drop the backslash before anything else; a
    trailing lone backslash is dropped. Runs on the driver over one string.
    """
    out = []
    i = 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == ESCAPE:
            if i + 1 < len(pattern):
                nxt = pattern[i + 1]
                out.append(ESCAPE + nxt if nxt in _ESCAPABLE else nxt)
            i += 2
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def contains_pattern(text: str) -> str:
    """``%text%`` with user wildcards kept active."""
    return normalise_like(f"%{text}%")


def icontains(col: Column, text: str, literal: bool = False) -> Column:
    """Case-insensitive contains. ``literal=True`` treats ``%``/``_`` as text."""
    if literal:
        return F.contains(F.lower(col), F.lower(F.lit(text)))
    return col.ilike(contains_pattern(text))


def literal_parts(text: str, literal: bool = False) -> list[str]:
    """Parts of user search text that a hit contains as they are: the text
    between wildcards, without escapes."""
    if literal:
        return [text]
    parts, part, chars = [], [], iter(normalise_like(text))
    for ch in chars:
        if ch == ESCAPE:
            part.append(next(chars))
        elif ch in "%_":
            parts.append("".join(part))
            part = []
        else:
            part.append(ch)
    return [*parts, "".join(part)]
