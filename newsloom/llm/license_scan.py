"""License scan by ordered signature rules, in built-in expressions only.

A cheap pattern lets only texts with some licence vocabulary through. Those
are reduced to their words, every rule whose keyword occurs is matched, and
overlapping detections are resolved: one that lies inside another of the
same or a better priority is suppressed. Three base phrases are reported
with all their places and are never suppressed.
"""

from __future__ import annotations

import json
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters between words (texts are lower-cased A-Z first).
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words counted in the text as it stands.
COUNTED = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Priorities, best first: whole notices, names with a version, names, hints.
NOTICE, VERSIONED, NAMED, HINT = 1, 2, 3, 4
STRENGTH = {NOTICE: 1.0, VERSIONED: 0.9, NAMED: 0.7, HINT: 0.4}


class Rule(NamedTuple):
    """``pattern`` is matched on words joined by single spaces, at word
    boundaries, where ``keyword`` occurs."""
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False


#: The base phrases and their labels.
BASE = (
    Rule("mit", NAMED, "under the mit license", "under the mit license", True),
    Rule("apache-2", VERSIONED, "apache license version 2", "apache license version 2", True),
    Rule("cc-by-nc", NAMED, "cc by nc", "cc by nc", True),
)

# Names as they stand after lower-casing, words only.
_NOTICES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("zlib", "in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("gpl", "this (?:program|library) is free software you can redistribute it and or modify it under the terms of"),
    ("gpl", "you should have received a copy of the gnu general public license"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license"),
    ("agpl", "you should have received a copy of the gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1.0", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related"),
    ("proprietary", "unauthorized copying of this (?:file|software|document) via any medium is strictly prohibited"),
    ("proprietary", "this (?:software|document|file) is proprietary and confidential"),
)

_GNU = (
    ("gpl", "general public license", ("1", "2", "3")),
    ("lgpl", "(?:lesser|library) general public license", ("2", "2 1", "3")),
    ("agpl", "affero general public license", ("1", "3")),
    ("gfdl", "free documentation license", ("1 1", "1 2", "1 3")),
)

#: (label stem, name, acronym as in a licence identifier, versions)
_FAMILIES = (
    ("apache", "apache (?:software )?license", "apache", ("1 0", "1 1", "2 0")),
    ("mpl", "mozilla public license", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", "epl", ("1 0", "2 0")),
    ("eupl", "european union public licen[cs]e", "eupl", ("1 0", "1 1", "1 2")),
    ("cddl", "common development and distribution license", "cddl", ("1 0", "1 1")),
    ("cpl", "common public license", "cpl", ("1 0",)),
    ("osl", "open software license", "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic free license", "afl", ("1 2", "2 0", "2 1", "3 0")),
    ("artistic", "artistic license", "artistic", ("1 0", "2 0")),
    ("bsl", "boost software license", "bsl", ("1 0",)),
    ("busl", "business source license", "busl", ("1 1",)),
    ("ofl", "(?:sil )?open font license", "ofl", ("1 0", "1 1")),
    ("odbl", "open (?:data commons open )?database license", "odbl", ("1 0",)),
    ("lppl", "latex project public license", "lppl", ("1 0", "1 2", "1 3c")),
    ("sspl", "server side public license", "sspl", ("1",)),
    ("cecill", "cecill(?: free software license)?", "cecill", ("1 0", "2 0", "2 1")),
    ("psf", "python (?:software foundation )?license", "python", ("2 0",)),
    ("php", "php license", "php", ("3 0", "3 01")),
    ("zpl", "zope public license", "zpl", ("2 0", "2 1")),
    ("elastic", "elastic license", "elastic", ("1 0", "2 0")),
)

_SIMPLE = (
    ("mit", "mit"), ("x11", "x11"), ("isc", "isc"), ("zlib", "zlib"), ("unlicense", "unlicense"), ("wtfpl", "wtfpl"),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)"), ("0bsd", "0bsd"), ("bsd", "bsd"),
    ("ncsa", "(?:ncsa|university of illinois)"), ("postgresql", "postgresql"), ("openssl", "openssl"),
    ("ms-pl", "(?:ms pl|microsoft public)"), ("ms-rl", "(?:ms rl|microsoft reciprocal)"), ("ruby", "ruby"),
    ("beerware", "beerware"), ("hpnd", "hpnd"), ("curl", "curl"),
)

_CC = {"by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
       "by nc": "attribution non ?commercial", "by nc sa": "attribution non ?commercial share ?alike",
       "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")


def _stem(text: str) -> str:
    return text.replace(" ", ".")


def _required(pattern: str) -> str:
    """The longest literal part that every match of ``pattern`` contains,
    other than the bare word licen(c/s)e."""
    parts = re.split(r"\(\?:[^()]*\)\??|\[[^]]*\]|[^ ]\?", pattern)
    return max((p.strip() for p in parts if p.strip() not in ("license", "licen", "e", "licence")), key=len)


def rules() -> list[Rule]:
    """All rules in order; earlier ones win ties."""
    out = [*BASE]
    for label, text in _NOTICES:
        out.append(Rule(label, NOTICE, max(re.split(r"\(\?:[^()]*\)(?:\{[^}]*\})?", text), key=len).strip(), text))
    for stem, name, versions in _GNU:
        key = name.replace("(?:lesser|library) ", "")
        issued = "(?: as published by the free software foundation)?(?: either)?"
        for v in versions:
            label = f"{stem}-{_stem(v) if ' ' in v else v + '.0'}"
            number = v if " " in v else f"{v}(?: 0)?"
            out += [
                Rule(f"{label}-or-later", VERSIONED, key,
                     f"(?:gnu )?{name}{issued} (?:version |v ?){number} (?:of the license )?or (?:at your option )?(?:any )?later(?: version)?"),
                Rule(label, VERSIONED, key, f"(?:gnu )?{name}{issued} (?:version |v ?){number}(?: only)?"),
                Rule(f"{label}-or-later", VERSIONED, stem, f"{stem} ?v?(?:ersion)? ?{number} or (?:any )?later(?: version)?"),
                Rule(label, VERSIONED, stem, f"{stem} ?v?(?:ersion)? ?{number}(?: only)?"),
                Rule(label, VERSIONED, "gnu org", f"gnu org (?:licenses|copyleft) (?:old licenses )?{stem} {number}(?: html| txt)?"),
            ]
        out += [Rule(stem, NAMED, key, f"(?:gnu )?{name}"), Rule(stem, HINT, stem, stem)]
    for stem, name, acronym, versions in _FAMILIES:
        key = _required(name)
        for v in versions:
            label = f"{stem}-{_stem(v)}"
            number = v if not v.endswith(" 0") else f"{v[:-2]}(?: 0)?"
            out += [
                Rule(label, VERSIONED, key, f"{name} (?:version |v ?)?{number}"),
                Rule(label, VERSIONED, "spdx", f"spdx license identifier {acronym} {v}"),
                Rule(label, VERSIONED, "licen", f"licen[cs]ed? (?:under )?(?:the )?{acronym} ?v? ?{number}"),
                Rule(label, VERSIONED, "licenses", f"org licenses {acronym} {v}"),
            ]
        out.append(Rule(stem, NAMED, key, name))
    for label, name in _SIMPLE:
        key = "licen"
        out += [
            Rule(label, NAMED, key, f"(?:the )?{name} (?:style )?(?:open source )?licen[cs]e"),
            Rule(label, NAMED, "spdx", f"spdx license identifier {name}"),
            Rule(label, NAMED, key, f"licen[cs]ed (?:under|with) (?:the )?{name}"),
            Rule(label, NAMED, "opensource org", f"opensource org licenses? {name}"),
        ]
    for element, long in _CC.items():
        stem = f"cc-{element.replace(' ', '-')}"
        for v in _CC_VERSIONS:
            label = f"{stem}-{_stem(v)}"
            number = f"{v[0]}(?: 0)?" if v.endswith(" 0") else v
            out += [
                Rule(label, VERSIONED, f"cc {element}", f"cc {element} (?:version |v ?)?{number}(?: international| unported| generic)?"),
                Rule(label, VERSIONED, "creative commons",
                     f"creative commons {long}(?: public)?(?: licen[cs]e)? (?:version |v ?)?{number}"
                     "(?: international| unported| generic)?"),
                Rule(label, VERSIONED, "creativecommons org", f"creativecommons org licenses {element} {v}"),
            ]
        out += [Rule(stem, NAMED, f"cc {element}", f"cc {element}"),
                Rule(stem, NAMED, "creative commons", f"creative commons {long}")]
    out += [
        Rule("cc0-1.0", VERSIONED, "cc0", "cc0(?: 1 0)?(?: universal)?"),
        Rule("cc0-1.0", VERSIONED, "creativecommons org", "creativecommons org publicdomain zero 1 0"),
        Rule("cc", HINT, "creative commons", "creative commons(?: licen[cs]e)?"),
        Rule("public-domain", NAMED, "public domain", "(?:released into|in|dedicated to) the public domain"),
        Rule("proprietary", HINT, "all rights reserved", "all rights reserved"),
        Rule("free-software", HINT, "free software foundation", "free software foundation"),
    ]
    return out


#: Texts without any of this can match no rule (checked in the tests). ``~``
#: stands for a break between words.
GATE = "(?i)" + "|".join((
    "licen[cs]", "gpl", "gfdl", "spdx", "cc0", "cecill", "copyleft", "creative(?:~)?commons", "cc~by", "permission",
    "redistribut", "public~domain", "rights~reserved", "free~software", "unencumbered", "endorse",
    "advertising~materials", "held~liable", "proprietary", "unauthorized", "source~code~form", "waived",
    "contents~of", "the~accompanying~materials",
)).replace("~", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _occurrences(words: Column, pattern: Column) -> Column:
    """Array of (start, stop) in words, of the pattern's places in turn.
    Every word, and so every place, begins with a space."""
    spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
    hits = F.regexp_extract_all(words, pattern, F.lit(0))
    gaps = F.split(words, pattern, -1)
    steps = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(
        spaces(g).alias("before"), spaces(h).alias("inside")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))
    walked = F.aggregate(steps, zero, lambda a, s: F.struct(
        (a["at"] + s["before"] + s["inside"]).alias("at"),
        F.concat(a["out"], F.array(F.struct((a["at"] + s["before"]).alias("start"),
                                            (a["at"] + s["before"] + s["inside"]).alias("stop")))).alias("out")))
    return walked["out"]


def detections(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per detection, and one with nulls for a document without any:
    ``_row, doc_id, n_words, label, priority, base, start, stop, kept``."""
    known = [r._asdict() | {"order": i, "pattern": f" (?:{r.pattern})(?= )"} for i, r in enumerate(rules())]
    table = F.from_json(F.lit(json.dumps(known)), "array<struct<label:string,priority:int,keyword:string,"
                                                  "pattern:string,base:boolean,order:int>>")
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"),
        F.regexp_count(t, F.lit(COUNTED)).cast("long").alias("n_words"),
        F.when(t.rlike(GATE), F.regexp_replace(F.concat(F.lit(" "), F.translate(t, UPPER, LOWER), F.lit(" ")), BREAK, " ")).alias("_words"))
    matched = rows.withColumn("_rule", F.explode_outer(F.when(
        F.col("_words").isNotNull(), F.filter(table, lambda r: (F.instr(F.col("_words"), r["keyword"]) > 0)
                                               & F.regexp_like(F.col("_words"), r["pattern"])))))
    placed = matched.select("_row", "doc_id", "n_words", "_rule.label", "_rule.priority", "_rule.base", "_rule.order",
                            F.explode_outer(_occurrences(F.col("_words"), F.col("_rule.pattern"))).alias("_at"))
    found = placed.select("*", "_at.start", "_at.stop").drop("_at")
    # Sorted by start, longest first, a detection lies inside an earlier one
    # exactly if an earlier stop is not before its own.
    earlier = (Window.partitionBy("_row").orderBy("start", F.desc("stop"), "priority", "order")
               .rowsBetween(Window.unboundedPreceding, -1))
    reach = F.coalesce(*[F.when(F.col("priority") == p, F.max(F.when(F.col("priority") <= p, F.col("stop"))).over(earlier))
                         for p in STRENGTH])
    return found.withColumn("kept", F.col("start").isNotNull() & (
        F.col("base") | F.coalesce(reach < F.col("stop"), F.lit(True))))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, n_detections``.

    Places are word numbers from 0. The labels are distinct, sorted and
    comma-joined; without any they are the empty string and the score is 0.
    The score is the strength of the best detection kept. A null text counts
    as empty; rows repeating an id are scanned one by one; an empty table
    gives an empty result; other columns are not read.
    """
    strength = F.coalesce(*[F.when(F.col("priority") == p, F.lit(s)) for p, s in STRENGTH.items()])
    base = F.col("base") & F.col("start").isNotNull()
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return detections(docs, id_col, text).groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("kept"), F.col("label"))).alias("labels"),
        F.coalesce(F.max(F.when(F.col("kept"), strength)), F.lit(0.0)).alias("score"),
        F.count(F.when(F.col("kept"), 1)).alias("n_detections")).drop("_row")
