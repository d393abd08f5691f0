"""Feed catalogue and landed feed documents.

The catalogue is configuration: ``sources -> name -> feeds[] -> {url,
category}`` in file order. Landed feed documents are files named
``<feed_key>.<run_id>.xml`` where ``feed_key`` is :func:`feed_key` of the
feed url and ``run_id`` sorts in fetch order. RSS 2.0, RSS 1.0 (RDF) and
Atom share one ``from_xml`` schema.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CATALOGUE_TYPE = T.StructType([
    T.StructField("sources", T.ArrayType(T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("feeds", T.ArrayType(T.StructType([
            T.StructField("url", T.StringType()),
            T.StructField("category", T.StringType()),
        ]))),
    ]))),
])

FEED_SCHEMA = ("channel struct<item: array<struct<title: string, link: string>>>, "
               "item array<struct<title: string, link: string>>, "
               "entry array<struct<title: string, link: array<struct<_href: string, _rel: string>>>>, "
               "_corrupt_record string")
_XML_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

#: Root element of a feed, and one whole entry of a damaged one.
FEED_ROOT = r"(?i)<(?:rss|rdf:RDF|feed)[\s>]"
WHOLE_ENTRY = r"(?s)<(item|entry)[\s>].*?</\1\s*>"

NO_TITLE = "No Title"  # fixed value: title given to an entry without one


def load_config(path: str) -> dict:
    """Read the catalogue file on the driver (YAML, or JSON if PyYAML is
    missing)."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    try:
        import yaml
        return yaml.safe_load(text) or {}
    except ImportError:
        import json
        return json.loads(text)


def feed_key(url: Column) -> Column:
    return F.sha1(url)


def catalogue(spark: SparkSession, config: dict) -> DataFrame:
    """``(source, source_pos, feed_url, feed_pos, category, feed_key)``.
    A source without feeds gives no rows; a missing category is 'unknown'."""
    sources = config.get("sources") or {}
    packed = [{"source": name,
               "feeds": [{"url": f.get("url"), "category": f.get("category")}
                         for f in ((cfg or {}).get("feeds") or [])]}
              for name, cfg in sources.items()]
    return flatten_catalogue(spark.createDataFrame([(packed,)], _CATALOGUE_TYPE))


def flatten_catalogue(nested: DataFrame) -> DataFrame:
    """Catalogue rows of nested ``sources`` (array of ``source`` and its
    ``feeds``, in file order), from configuration or landed as a table."""
    s = nested.select(F.posexplode("sources").alias("source_pos", "s"))
    f = s.select("source_pos", F.col("s.source").alias("source"),
                 F.posexplode(F.col("s.feeds")).alias("feed_pos", "f"))
    return f.select(
        "source", "source_pos", F.col("f.url").alias("feed_url"), "feed_pos",
        F.coalesce(F.col("f.category"), F.lit("unknown")).alias("category"),
        feed_key(F.col("f.url")).alias("feed_key"))


def landed_feed_name(key: Column) -> Column:
    """Feed key of a landed file's name; NULL where the name has none."""
    return F.nullif(F.regexp_extract(key, r"^([0-9a-f]{40})\.", 1), F.lit(""))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """``(feed_key, run_id, body)`` from landed feed files."""
    raw = spark.read.text(path, wholetext=True)
    return from_files(raw.select(F.col("_metadata.file_name").alias("file_name"), "value"))


def from_files(df: DataFrame) -> DataFrame:
    """``(file_name, value)`` rows to ``(feed_key, run_id, body)``."""
    return df.select(
        landed_feed_name(F.col("file_name")).alias("feed_key"),
        F.regexp_extract("file_name", r"^[0-9a-f]{40}\.(.*)\.xml$", 1).alias("run_id"),
        F.col("value").alias("body"))


def _entity_table() -> Column:
    """Named HTML entities and their characters."""
    names = sorted(html.entities.name2codepoint.items())
    return F.map_from_arrays(F.array(*[F.lit(n) for n, _ in names]), F.array(*[F.lit(chr(c)) for _, c in names]))


def _repair(text: Column) -> Column:
    """Named HTML entities as characters and every other bare ampersand
    escaped; what XML itself knows stays."""
    table = _entity_table()

    def one(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        return (F.when(i == 0, p)
                .when(p.rlike(r"^(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);"), F.concat(F.lit("&"), p))
                .otherwise(F.coalesce(
                    F.concat(F.try_element_at(table, F.nullif(name, F.lit(""))), F.regexp_replace(p, "^[A-Za-z0-9]+;", "")),
                    F.concat(F.lit("&amp;"), p))))
    return F.array_join(F.transform(F.split(text, "&", -1), one), "")


def xml_ready(body: Column) -> Column:
    """A feed document an XML reader takes although its writer was careless:
    ampersands repaired, CDATA sections as escaped text."""
    def one(p: Column, i: Column) -> Column:
        raw = F.substring_index(p, "]]>", 1)
        rest = F.substr(p, F.length(raw) + 4)
        escaped = F.replace(F.replace(raw, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(i == 0, _repair(p)).otherwise(F.concat(escaped, _repair(rest)))
    return F.array_join(F.transform(F.split(body, r"<!\[CDATA\[", -1), one), "")


def _salvaged(xml: Column) -> Column:
    """The whole entries of a damaged document as a document of their own;
    NULL where it has none."""
    found = F.regexp_extract_all(xml, F.lit(WHOLE_ENTRY), F.lit(0))
    items = F.filter(found, lambda e: e.rlike(r"^<item"))
    atoms = F.filter(found, lambda e: e.rlike(r"^<entry"))
    doc = F.concat(F.lit("<rss><channel>"), F.array_join(items, ""), F.lit("</channel>"),
                   F.array_join(atoms, ""), F.lit("</rss>"))
    return F.when(F.size(found) > 0, doc)


def _atom_as_item(e: Column) -> Column:
    alt = F.filter(e["link"], lambda l: l["_rel"].isNull() | (l["_rel"] == "alternate"))
    return F.struct(e["title"].alias("title"), F.get(alt, 0)["_href"].alias("link"))


def entries(landed: DataFrame) -> DataFrame:
    """One row per feed entry: ``(feed_key, run_id, entry_pos, title,
    link, feed_ok)``; a document that is not a readable feed gives one row
    with ``feed_ok`` FALSE and NULL entry fields. A feed without entries is
    readable and gives no row. Bare ampersands and HTML entities are
    repaired; of a document that is damaged beyond that, its whole entries
    are read."""
    doc = landed.select("feed_key", "run_id", F.col("body").rlike(FEED_ROOT).alias("_root"),
                        xml_ready(F.col("body")).alias("_xml"))
    doc = doc.withColumn("_x", F.from_xml("_xml", FEED_SCHEMA, _XML_OPTIONS))
    bad = F.col("_x").isNull() | F.col("_x._corrupt_record").isNotNull()
    doc = doc.withColumn("_again", F.when(bad & F.col("_root"), _salvaged(F.col("_xml")))) \
             .withColumn("_y", F.from_xml("_again", FEED_SCHEMA, _XML_OPTIONS))
    whole = F.col("_root") & ~bad
    saved = F.col("_again").isNotNull() & F.col("_y._corrupt_record").isNull()
    items = F.coalesce(*[c for x in ("_x", "_y") for c in (
        F.col(f"{x}.channel.item"), F.col(f"{x}.item"), F.transform(F.col(f"{x}.entry"), _atom_as_item))],
        F.array().cast("array<struct<title:string,link:string>>"))
    docs = doc.select("feed_key", "run_id",
                      F.when(F.coalesce(whole | saved, F.lit(False)), items).alias("_items"))
    # One pass: posexplode_outer keeps unreadable documents as one NULL row;
    # the NULL row of a readable but empty feed is dropped.
    rows = docs.select("feed_key", "run_id", F.col("_items").isNotNull().alias("feed_ok"),
                       F.posexplode_outer("_items").alias("entry_pos", "_e"))
    rows = rows.filter(~F.col("feed_ok") | F.col("entry_pos").isNotNull())
    return rows.select("feed_key", "run_id", "entry_pos", F.col("_e.title").alias("title"),
                       F.col("_e.link").alias("link"), "feed_ok")


def has_link() -> Column:
    return F.coalesce(F.col("link") != F.lit(""), F.lit(False))


def title_or_default() -> Column:
    """Missing title becomes 'No Title'; an empty title stays empty."""
    return F.coalesce(F.col("title"), F.lit(NO_TITLE))
