"""Surrogates for personal data, in built-in expressions only.

Detected entities (mail addresses, phone, card, account and social security
numbers, network addresses, credentials, titled names) are replaced by
keyed surrogates of the same type, script and format; names keep their
gender. All occurrences of an entity, in whatever spelling, get the same
surrogate (coreference); different entities never share one, and no
surrogate is an entity that occurs itself: the table of entities is checked
for collisions and the losers are drawn again.

Texts without an entity pass straight through. Of the others only the
entities are shuffled; a text moves once, to be put together again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import materialise

#: Titles that announce a name, by the gender they state.
TITLES = {"m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "господин"),
          "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа")}
#: Given names by script and gender.
GIVEN = {
    "latin_m": ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leon", "Marco", "Oscar"),
    "latin_f": ("Alma", "Bella", "Clara", "Diana", "Emma", "Flora", "Helen", "Irene", "Julia", "Laura", "Marta", "Olga"),
    "cyrillic_m": ("Антон", "Борис", "Виктор", "Денис", "Иван", "Максим", "Павел", "Сергей"),
    "cyrillic_f": ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"),
}
#: Syllables surnames are made of.
SYLLABLES = {"latin": ("ba", "de", "fi", "go", "ha", "ki", "lo", "mu", "na", "pe", "ri", "so", "ta", "ve", "wi", "zo"),
             "cyrillic": ("ба", "ве", "го", "де", "зи", "ка", "ло", "ми", "на", "пе", "ри", "со", "та", "фе", "ша", "ю")}

_NAME = r"\p{Lu}[\p{Ll}\p{M}'’-]+"
_ALL_TITLES = "|".join(t for ts in TITLES.values() for t in ts)
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_IP = rf"(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)"
_IP6 = r"(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"
_CARD = r"\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\d-])"
_LOCAL = r"\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"
_SSN = r"\d{3}-\d{2}-\d{4}(?![\d-])"
#: After a blank, a group that begins one of these is no part of the number before it.
_OWN = rf"(?! (?:{_IP}|{_IP6}|{_LOCAL}|{_SSN}))"
#: Announced credentials; the credential word may end a longer name (client_secret).
_ANNOUNCED = (r"(?<=(?i:token|secret|password|passwd|pwd|api.?key|access.?key)[\"']{0,1}\s{0,3}[:=]\s{0,3}[\"']{0,1})"
              r"[A-Za-z0-9_\-/+=.]{8,}")

#: (type, pattern), in order: at a place the first that matches counts.
PATTERNS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"),
    ("secret", _ANNOUNCED),
    ("secret", r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}|xox[abp]-[A-Za-z0-9-]{10,})"),
    ("iban", rf"\b[A-Z]{{2}}\d{{2}}(?:{_OWN} ?[A-Z0-9]{{4}}){{3,7}}(?:{_OWN} ?[A-Z0-9]{{1,3}})?\b"),
    ("ip", rf"(?<![\d.]){_IP}"),
    ("ip6", rf"(?<![0-9A-Fa-f:]){_IP6}"),
    ("card", rf"(?<![\d.-]){_CARD}"),
    # a number of +1 has ten digits, whatever follows
    ("phone", r"(?<![\d\p{L}])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"),
    ("phone", rf"(?<![\d\p{{L}}])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:{_OWN}(?! {_CARD})[ .-]?\d{{2,4}}){{2,4}}(?!\d)"),
    ("phone", r"(?<![\d\p{L}])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"),
    ("phone", rf"(?<![\d.-]){_LOCAL}"),
    ("ssn", rf"(?<![\d-]){_SSN}"),
    ("person", rf"(?<![\p{{L}}\p{{N}}])(?:{_ALL_TITLES})\.? {_NAME}(?: {_NAME})?"),
)
TYPES = tuple(dict.fromkeys(t for t, _ in PATTERNS))
ANY = "|".join(p for _, p in PATTERNS)
#: What a text needs to be looked at: an @, four digits close to each other, the
#: head of an account number, a group of an address, a credential's name or form,
#: or a title. Every pattern implies one of them.
GATE = (r"[0-9](?:[ ().+/-]{0,2}[0-9]){3}|@|[A-Z]{2}[0-9]{2}|:[0-9A-Fa-f]{1,4}:|(?i:token|secret|passw|pwd|api.?key|access.?key)"
        rf"|AKIA|gh[pousr]_|sk-|xox|(?:{_ALL_TITLES})\.? ")
ROUNDS = 12


def kind_of(entity: Column) -> Column:
    """Type of a matched entity; the first pattern that fits the whole of it.
    A credential found by its announcement fits none and is the rest."""
    out = F.lit("secret")
    for name, pattern in reversed(PATTERNS):
        if pattern != _ANNOUNCED:
            out = F.when(entity.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(out)
    return out


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _bare_name(c: Column) -> Column:
    return F.regexp_replace(c, rf"^(?:{_ALL_TITLES})\.? ", "")


def _gender(c: Column) -> Column:
    return F.when(c.rlike(rf"^(?:{'|'.join(TITLES['f'])})\.? "), F.lit("f")).otherwise(F.lit("m"))


def canonical(kind: Column, entity: Column) -> Column:
    """What the spellings of one entity have in common. A name's gender is
    part of it, so that both bearers of a surname stay two people."""
    return (F.when(kind.isin("phone", "card", "ssn"), _digits(entity))
            .when(kind == "email", F.lower(entity))
            .when(kind == "ip6", F.lower(entity))
            .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
            .when(kind == "person", F.concat(_gender(entity), F.lit(":"), _bare_name(entity)))
            .otherwise(entity))


def _numbers(hex_: Column) -> Column:
    """A hex digest as numbers 0..255."""
    return F.transform(F.regexp_extract_all(hex_, F.lit(".."), F.lit(0)), lambda h: F.conv(h, 16, 10).cast("int"))


def _spelled(like: Column, numbers: Column) -> Column:
    """Characters of the same class as those of ``like``, chosen by
    ``numbers`` (as many as characters, repeated if need be)."""
    chars = F.split(like, "")
    chars = F.filter(chars, lambda c: c != "")
    many = F.flatten(F.array_repeat(numbers, F.ceil(F.length(like) / 60).cast("int") + 1))
    pick = lambda alphabet, n: F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))

    def one(c, n):
        low, up = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        clow, cup = "абвгдежзиклмнопрстуфхцчшэюя", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"
        glow, gup = "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"
        return (F.when(c.rlike("[0-9]"), pick("0123456789", n))
                .when(c.rlike("[a-z]"), pick(low, n)).when(c.rlike("[A-Z]"), pick(up, n))
                .when(c.rlike(r"[\p{IsCyrillic}&&\p{Lu}]"), pick(cup, n)).when(c.rlike(r"\p{IsCyrillic}"), pick(clow, n))
                .when(c.rlike(r"[\p{IsGreek}&&\p{Lu}]"), pick(gup, n)).when(c.rlike(r"\p{IsGreek}"), pick(glow, n))
                .when(c.rlike(r"\p{Lu}"), pick(up, n)).when(c.rlike(r"\p{L}"), pick(low, n)).otherwise(c))
    return F.array_join(F.zip_with(chars, F.slice(many, 1, F.size(chars)), one), "")


def _member(values: Column, size: int):
    return lambda n: F.element_at(values, n % size + 1)


def _luhn(digits: Column, last: bool) -> Column:
    """Luhn sum of the digits; without ``last``, of digits that get one more."""
    backwards = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    offset = 0 if last else 1
    return F.aggregate(
        F.transform(backwards, lambda c, i: F.when((i + offset) % 2 == 1, F.when(
            c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def _draw(kind: Column, entity: Column, attempt: Column, numbers: Column, domain: Column) -> Column:
    """The surrogate of a canonical entity. From the fourth attempt on it may
    be longer, numbers from the seventh, so that short formats don't run out."""
    more = F.when(attempt >= 3, _spelled(F.repeat(F.lit("0"), F.least(attempt - 1, F.lit(9))), F.reverse(numbers))).otherwise("")
    spelled = _spelled(entity, numbers)
    first = F.element_at(numbers, -1) % 9 + 1
    number = F.concat(first.cast("string"), F.substr(spelled, F.lit(2)))
    body = F.substr(F.concat(F.substr(entity, F.lit(1), F.lit(1)), F.substr(spelled, F.lit(2))), F.lit(1), F.length(entity) - 1)
    card = F.when(_luhn(entity, True) % 10 == 0,
                  F.concat(body, ((10 - _luhn(body, False) % 10) % 10).cast("string"))).otherwise(
        F.concat(F.substr(entity, F.lit(1), F.lit(1)), F.substr(spelled, F.lit(2))))
    wide = F.when(attempt >= 6, more).otherwise("")
    byte = lambda i: F.element_at(numbers, i)
    ip = F.concat_ws(".", (byte(1) % 223 + 1).cast("string"), *[byte(i).cast("string") for i in (2, 3)],
                     (byte(4) % 254 + 1).cast("string"))
    name = F.substring_index(entity, ":", -1)
    script = F.when(name.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    sex = F.substring_index(entity, ":", 1)
    given = surname = None
    for s, syllables in SYLLABLES.items():
        parts = F.array(*[F.lit(x) for x in syllables])
        own = F.initcap(F.array_join(F.transform(F.slice(numbers, 5, F.least(F.lit(3) + F.floor(attempt / 2), F.lit(20)).cast("int")),
                                                 _member(parts, len(syllables))), ""))
        surname = F.when(script == s, own) if surname is None else surname.when(script == s, own)
        for g in ("m", "f"):
            pool = F.array(*[F.lit(x) for x in GIVEN[f"{s}_{g}"]])
            hit = (script == s) & (sex == g)
            one = F.element_at(pool, F.element_at(numbers, 1) % len(GIVEN[f"{s}_{g}"]) + 1)
            given = F.when(hit, one) if given is None else given.when(hit, one)
    person = F.concat(sex, F.lit(":"), F.when(F.instr(name, " ") > 0, F.concat_ws(" ", given, surname)).otherwise(surname))
    mail = F.concat(_spelled(F.substring_index(entity, "@", 1), numbers), more, F.lit("@"), domain)
    return (F.when(kind == "email", mail).when(kind.isin("phone", "ssn"), F.concat(number, wide))
            .when(kind == "card", F.concat(card, wide))
            .when(kind == "ip", ip).when(kind == "person", person)
            .when(kind == "ip6", F.array_join(F.transform(
                F.split(F.regexp_replace(F.sha2(F.concat_ws("|", entity, attempt.cast("string"), F.element_at(numbers, 7).cast("string")), 256),
                                         "^(.{4})(.{4})(.{4})(.{4})(.{4})(.{4})(.{4})(.{4}).*", "$1:$2:$3:$4:$5:$6:$7:$8"), ":"), lambda x: x), ":"))
            .when(kind == "iban", F.concat(F.substr(entity, F.lit(1), F.lit(2)), F.substr(spelled, F.lit(3)), wide))
            .otherwise(F.concat(spelled, F.when(kind == "secret", more).otherwise(""))))


def surrogate_table(entities: DataFrame, key: str, rounds: int = ROUNDS) -> DataFrame:
    """``kind, entity, surrogate`` for the distinct ``entities`` (kind,
    entity): one surrogate each; as they are seen in a text, none is shared,
    not even between kinds, and none is itself an entity.

    Every round draws for the entities still open, by a keyed digest of
    kind, entity and round; of those that draw the same, and of those that
    draw a taken surrogate, one or none stays and the others go on.
    """
    all_ = materialise(entities.distinct())
    open_, done = all_, None
    for attempt in range(rounds):
        digest = F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "entity", F.lit(str(attempt))), 512)
        site = F.substring_index("entity", "@", -1)
        hidden = F.sha2(F.concat_ws("\u0001", F.lit(key), F.lit("domain"), site), 256)
        # The digests are written down first: inside a lambda they would be
        # computed again for every character.
        drawn = materialise(open_.withColumn("_numbers", _numbers(digest)).withColumn("_domain", F.concat(
            F.translate(F.substr(hidden, F.lit(1), F.lit(12)), "0123456789", "ghijklmnop"), F.lit(".example."),
            F.substring_index(site, ".", -1))))
        drawn = materialise(drawn.select("kind", "entity", _draw(
            F.col("kind"), F.col("entity"), F.lit(attempt), F.col("_numbers"), F.col("_domain")).alias("surrogate")))
        seen = lambda c: F.when(F.col("kind") == "person", F.substring_index(c, ":", -1)).otherwise(F.col(c)).alias("_seen")
        winner = drawn.groupBy(seen("surrogate")).agg(F.min(F.struct("kind", "entity", "surrogate")).alias("_first"))
        free = winner.join(all_.select(seen("entity")), "_seen", "left_anti")
        if done is not None:
            free = free.join(done.select(seen("surrogate")), "_seen", "left_anti")
        won = free.select("_first.*")
        done = materialise(won if done is None else done.unionByName(won))
        open_ = materialise(all_.join(done, ["kind", "entity"], "left_anti"))
        if not open_.limit(1).count():
            return done
    raise RuntimeError(f"surrogates still collide after {rounds} rounds")


def _render(kind: Column, found: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this occurrence: digits take the
    places of digits (of a longer number the rest follows), a name keeps its
    title."""
    places = F.filter(F.split(found, ""), lambda c: c != "")
    start = F.struct(F.lit("").alias("out"), surrogate.alias("left"))
    dealt = F.aggregate(places, start, lambda a, c: F.struct(
        F.concat(a["out"], F.when(c.rlike("[0-9]"), F.substr(a["left"], F.lit(1), F.lit(1))).otherwise(c)).alias("out"),
        F.when(c.rlike("[0-9]"), F.substr(a["left"], F.lit(2))).otherwise(a["left"]).alias("left")))
    title = F.regexp_extract(found, rf"^(?:{_ALL_TITLES})\.? ", 0)
    blanks = F.aggregate(places, start, lambda a, c: F.struct(
        F.concat(a["out"], F.when(c != " ", F.substr(a["left"], F.lit(1), F.lit(1))).otherwise(c)).alias("out"),
        F.when(c != " ", F.substr(a["left"], F.lit(2))).otherwise(a["left"]).alias("left")))
    # The folds are one element each, so they are made once an occurrence.
    joined = lambda x: F.element_at(F.transform(F.array(x), lambda v: F.concat(v["out"], v["left"])), 1)
    return (F.when(kind.isin("phone", "card", "ssn"), joined(dealt)).when(kind == "iban", joined(blanks))
            .when(kind == "person", F.concat(title, F.substring_index(surrogate, ":", -1))).otherwise(surrogate))


def replace_private(docs: DataFrame, key: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text, n_entities, kinds,
    entities``; the text with surrogates, the number of replaced places, the
    sorted types, and the places as (kind, surrogate as written) in order.

    A null text stays null and an empty one empty, without entities. Rows
    repeating an id are rewritten one by one, alike. An empty table gives an
    empty result; other columns are not read. ``key`` decides all
    surrogates: the same key and entities give the same ones again.
    """
    t = F.col(text)
    rows = docs.select(F.col(id_col).alias("doc_id"), t.alias("text"), F.when(
        t.rlike(GATE), F.regexp_extract_all(t, F.lit(ANY), F.lit(0))).alias("_found"))
    none = F.coalesce(F.size("_found"), F.lit(0)) <= 0
    found = materialise(rows.filter(~none).withColumn("_row", F.monotonically_increasing_id()))
    places = found.select("_row", F.posexplode("_found").alias("_at", "_entity"))
    places = places.withColumn("kind", kind_of(F.col("_entity")))
    places = materialise(places.withColumn("entity", canonical(F.col("kind"), F.col("_entity"))))
    table = surrogate_table(places.select("kind", "entity"), key)
    # a hot entity is a plain join key, which adaptive execution splits
    written = places.join(table, ["kind", "entity"]).select(
        "_row", F.struct("_at", "kind", _render(F.col("kind"), F.col("_entity"), F.col("surrogate")).alias("surrogate")).alias("_e"))
    per_row = written.groupBy("_row").agg(F.array_sort(F.collect_list("_e")).alias("_es"))
    whole = found.join(per_row, "_row").withColumn("_new", F.transform("_es", lambda e: e["surrogate"])) \
                 .withColumn("_gaps", F.split("text", ANY, -1))
    built = F.array_join(F.zip_with("_gaps", "_new", lambda g, n: F.concat(g, F.coalesce(n, F.lit("")))), "")
    entity_type = "array<struct<kind:string,surrogate:string>>"
    done = whole.select(
        "doc_id", built.alias("text"), F.size("_es").cast("long").alias("n_entities"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("_es", lambda e: e["kind"]))), ",").alias("kinds"),
        F.transform("_es", lambda e: F.struct(e["kind"].alias("kind"), e["surrogate"].alias("surrogate"))).alias("entities"))
    clean = rows.filter(none).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"),
                                     F.lit("").alias("kinds"), F.array().cast(entity_type).alias("entities"))
    return clean.unionByName(done)
