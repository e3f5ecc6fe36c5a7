"""PII surrogates: keyed, type-consistent replacements with collision checks [native]."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import let, materialize, text_or_empty

#: Titles that announce a person's name, by gender (of no gender: academic ones).
TITLES_M = ["Mr", "Herr", "Monsieur", "Señor", "Господин"]
TITLES_F = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Dra", "Госпожа"]
TITLES_N = ["Dr", "Prof", "Doctor", "Professor", "Доктор", "Профессор"]
TITLE = "(?:" + "|".join(TITLES_M + TITLES_F + TITLES_N) + ")"
#: A word of a name (Smith, McDonald, O'Brien, d'Arc, Anne-Marie, SMITH), initials, and words between.
WORD = r"(?:d['’])?(?=\p{Lu}(?:[\p{L}\p{M}]|['’]\p{Lu}))\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{Lu}[\p{L}\p{M}]*+)*+"
INITIALS = r"\p{Lu}\.(?:-?\p{Lu}\.)*+"
PARTICLE = r"(?:de|del|della|da|di|do|dos|das|du|van|von|der|den|ter|zu|la|le|el|al|bin|ibn|y)"
_NAME = rf"(?:(?:{INITIALS}|{PARTICLE}) )*+{WORD}"

_GROUP = "[0-9A-Fa-f]{1,4}"
#: National phone numbers, (555) 123-4567, 01 23 45 67 89, 0171 1234567, 020 7946 0958, (030) 123 4567, 912 34 56 78.
_NATIONAL = [r"(?:1[ .-])?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", r"0[1-9](?:[ .-]?[0-9]{2}){4}",
             r"\(0[0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", r"0[1-9][0-9]{1,3}[ .-][0-9]{3,4}[ .-][0-9]{3,4}",
             r"0[1-9][0-9]{1,4}[ /.-][0-9]{5,8}", r"0[1-9][0-9]{8,9}", r"[6-9][0-9]{2}(?:[ .-][0-9]{2}){3}"]

#: Patterns of the entity kinds (Java regular expressions). Every pattern
#: begins where no longer run of its characters does, so matching is linear.
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    # with "::" only global, local and link-local addresses: a[1::2] and Face::add are code
    "ipv6": rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?=(?:[23][0-9A-Fa-f]{{3}}|[Ff][CcDdEe][0-9A-Fa-f]{{2}}):)"
            rf"(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}})(?![0-9A-Za-z:])",
    "phone": r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?:\+|(?<![0-9A-Za-z])00(?=[1-9]))[0-9]{1,3}(?:[ .-]?\([0-9]{1,4}\))?(?:[ ./-]?[0-9]){6,12}(?![0-9])"
             r"|(?<![\p{L}0-9])(?<![0-9][.,/-])(?:" + "|".join(_NATIONAL) + r")(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "person": rf"(?<!\p{{L}})(?:{TITLE}\.? )++{_NAME}(?: {_NAME}){{0,3}}+",
}
ANY = "|".join(f"(?:{p})" for p in KINDS.values())
#: A text without any of these holds no entity; spares the long pattern.
HINT = r"@|[0-9]{3}|[0-9]\.[0-9]|[0-9]{2}[ /-][0-9]{2}|[0-9a-fA-F]{32}|[0-9a-fA-F]:[0-9a-fA-F:]|" + TITLE

#: Syllables and endings of generated names, by script.
SYLLABLES = {
    "latin": ["ba", "de", "ki", "lo", "mu", "na", "pe", "ri", "so", "tu", "va", "we", "zi", "go", "hu", "ja"],
    "cyrillic": ["ба", "де", "ки", "ло", "му", "на", "пе", "ри", "со", "ту", "ва", "зе", "жи", "го", "ху", "ша"],
}
ENDINGS = {"given_m": {"latin": "n", "cyrillic": "н"}, "given_f": {"latin": "na", "cyrillic": "на"},
           "given_n": {"latin": "l", "cyrillic": "л"},
           "family": {"latin": "r", "cyrillic": "р"}}
MAX_ATTEMPTS = 60
#: Draws in a value's own format before the format grows.
GROW_AFTER = 6


def _chars(s: Column) -> Column:
    return F.split(s, "")


def _letters(digest: Column) -> Column:
    """Some 70 lower-case letters, all 26 alike, of a digest."""
    return F.regexp_replace(F.lower(F.base64(F.unhex(digest))), "[^a-z]", "")


def _reshape(value: Column, digest: Column) -> Column:
    """``value`` with each ASCII digit and letter replaced by one of its class, after the digest."""
    digits = F.translate(digest, "abcdef", "258147")

    def drawn(letters):
        def one(c, i):
            letter = F.substring(letters, i % F.length(letters) + 1, F.lit(1))
            return (F.when(c.between("0", "9"), F.substring(digits, i % F.lit(128) + 1, F.lit(1))).when(c.between("a", "z"), letter)
                    .when(c.between("A", "Z"), F.upper(letter)).otherwise(c))
        return F.array_join(F.transform(_chars(value), one), "")

    return let(_letters(digest), drawn)


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    def step(c, i):
        v = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(v > 9, v - 9).otherwise(v)
    return F.aggregate(F.transform(F.reverse(_chars(digits)), step), F.lit(0), lambda a, v: a + v) % 10


def _byte(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")


def _name(kind: str, value: Column, digest: Column, attempt: Column) -> Column:
    def build(script):
        table = F.array(*[F.lit(x) for x in SYLLABLES[script]])
        n = len(SYLLABLES[script])
        some = [F.get(table, _byte(digest, i) % n) for i in range(3)]
        # one more syllable for each draw: the names of some draw outnumber any corpus
        more = F.array_join(F.transform(F.sequence(F.lit(3), attempt + 2), lambda i: F.get(
            table, F.conv(F.substring(digest, 2 * i + 1, F.lit(2)), 16, 10).cast("int") % n)), "")
        return F.concat(*some, F.when(attempt > 0, more).otherwise(""), F.lit(ENDINGS[kind][script]))
    return F.initcap(F.when(value.rlike(r"\p{IsCyrillic}"), build("cyrillic")).otherwise(build("latin")))


def surrogate(kind: Column, value: Column, key: str, attempt: Column) -> Column:
    """The keyed surrogate of one entity; another for each ``attempt``."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string")), 512)

    def card(d):
        drawn = _reshape(value, d)
        body = F.substring(drawn, F.lit(1), F.length(drawn) - 1)
        sum_ = _luhn(F.concat(F.regexp_replace(body, "[^0-9]", ""), F.lit("0")))
        valid = _luhn(F.regexp_replace(value, "[^0-9]", "")) == 0
        check = (10 - sum_) % 10
        return F.concat(body, F.when(valid, check).otherwise((check + 1 + _byte(d, 63) % 9) % 10).cast("string"))

    def hexadecimal(d):
        return F.array_join(F.transform(_chars(value), lambda c, i: F.when(
            c.between("A", "F"), F.upper(F.substring(d, i % F.lit(128) + 1, F.lit(1))))
            .otherwise(F.substring(d, i % F.lit(128) + 1, F.lit(1)))), "")

    def ipv6(d):  # keeps the first group; a draw after the first has all eight groups
        first = F.substring_index(value, ":", 1)
        drawn = F.array_join(F.transform(_chars(value), lambda c, i: F.when(c == ":", c).otherwise(
            F.substring(d, i % F.lit(128) + 1, F.lit(1)))), "")
        return F.concat(first, F.when(attempt > 0, F.concat(*[F.concat(F.lit(":"), F.substring(d, 4 * i + 1, 4)) for i in range(7)]))
                        .otherwise(F.substring(drawn, F.length(first) + 1, F.length(value))))

    def secret(d):  # upper case stays upper case
        return F.when(value.rlike("[A-F]"), F.upper(hexadecimal(d))).otherwise(hexadecimal(d))

    # a format whose surrogates all seem taken grows: by a letter a draw for an address, and by a digit (an
    # IPv4 address becomes a longer one) for what has GROW_AFTER draws behind it
    extra = F.greatest(F.lit(0), attempt - GROW_AFTER)

    def more(d, alphabet="digits"):
        some = F.translate(d, "abcdef", "258147") if alphabet == "digits" else d
        return F.substring(some, F.lit(65), extra)

    def email(d):
        tld = F.substring_index(value, ".", -1)
        return F.concat(F.substring(_letters(d), F.lit(41), attempt), _reshape(F.substring(value, F.lit(1), F.length(value) - F.length(tld)), d), tld)

    def ip(d):
        v4 = F.concat_ws(".", (_byte(d, 0) % 223 + 1).cast("string"), *[_byte(d, i).cast("string") for i in (1, 2, 3)])
        v6 = F.concat(F.lit("2001:db8"), *[F.concat(F.lit(":"), F.substring(d, 4 * i + 1, 4)) for i in range(6)])
        return F.when(extra > 0, v6).otherwise(v4)

    def draw(d):
        code = F.regexp_extract(value, r"^(?:(?:\+|00)[0-9]{1,3}|\(?0)", 0)
        ssn = F.concat(_reshape(value, d), F.when(extra > 0, F.concat(F.lit("-"), more(d))).otherwise(""))
        return (F.when(kind == "email", email(d))
                .when(kind == "secret", F.concat(secret(d), F.when(value.rlike("[A-F]"), F.upper(more(d, "hex"))).otherwise(more(d, "hex"))))
                .when(kind == "ip", ip(d))
                .when(kind == "ipv6", ipv6(d))
                .when(kind == "phone", F.concat(code, _reshape(F.substring(value, F.length(code) + 1, F.length(value)), d), more(d)))
                .when(kind == "iban", F.concat(F.substring(value, 1, 2), _reshape(F.substring(value, F.lit(3), F.length(value)), d), more(d)))
                .when(kind == "card", F.concat(more(d), card(d)))
                .when(kind == "ssn", ssn)
                .when(kind == "given_m", _name("given_m", value, d, attempt)).when(kind == "given_f", _name("given_f", value, d, attempt))
                .when(kind == "given_n", _name("given_n", value, d, attempt))
                .when(kind == "family", _name("family", value, d, attempt))
                .otherwise(F.concat(_reshape(value, d), more(d))))

    return let(digest, draw)


def _kind(match: Column) -> Column:
    out = None
    for name, pattern in KINDS.items():
        test = match.rlike(f"^(?:{pattern})$")
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def _titles(match: Column) -> Column:
    """The titles of a person's match, with the blank after them."""
    return F.regexp_extract(match, rf"^(?:{TITLE}\.? )+", 0)


def entity_parts(match: Column) -> Column:
    """The parts of a match, (kind, value): the match itself, or all words of a person's name
    (the first of several is given, by the titles' gender, a lone one and all others are family
    names; initials and particles have kinds of their own, see :func:`is_entity`)."""
    def part(kind, value):
        return F.struct(kind.alias("kind"), value.alias("value"))

    def has(titles):
        return _titles(match).rlike("(?:^| )(?:" + "|".join(titles) + r")\.? ")

    given = F.when(has(TITLES_M), "given_m").when(has(TITLES_F), "given_f").otherwise("given_n")

    def kinds(words):
        plain = F.transform(words, lambda w: F.when(w.rlike(rf"^{INITIALS}$"), "initials").when(w.rlike(rf"^{PARTICLE}$"), "particle").otherwise("family"))
        def place(at):  # of the first whole word; the last word is always whole
            return F.zip_with(words, F.transform(at, lambda k, i: F.when(
                (i + 1 == F.array_position(at, "family")) & (i + 1 < F.size(at)), given).otherwise(k)), lambda w, k: part(k, w))
        return let(plain, place)

    name = F.split(F.substring(match, F.length(_titles(match)) + 1, F.length(match)), " ")
    return let(_kind(match), lambda k: F.when(k == "person", let(name, kinds)).otherwise(F.array(part(k, match))))


def is_entity(part: Column) -> Column:
    """Whether a part has a surrogate of its own: not a particle, and not initials, of which there are too few."""
    return ~part["kind"].isin("initials", "particle")


def new_initials(value: Column, key: str) -> Column:
    """Initials with each letter replaced by the next one of a keyed order of its alphabet."""
    def order(letters):
        return "".join(sorted(letters, key=lambda c: hashlib.sha256(f"{key}\x1f{c}".encode()).digest()))
    orders = [order(x) for x in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝŁŚŠŻŽ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯ")]
    return F.translate(value, "".join(orders), "".join(o[1:] + o[0] for o in orders))


def matches(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def collisions(entities: DataFrame, key: str) -> DataFrame:
    """Entities (kind, value) whose first surrogate isn't theirs alone, with one that is.

    A surrogate counts as taken if another entity of the kind has it (the least value keeps it)
    or if it is itself an entity of the kind in the corpus. Who loses draws again, until nobody
    does; names and addresses grow with each draw, other formats after ``GROW_AFTER``, so none runs out."""
    t = entities.withColumn("attempt", F.lit(0))
    for turn in range(MAX_ATTEMPTS):
        t = materialize(t.withColumn("surrogate", surrogate(F.col("kind"), F.col("value"), key, F.col("attempt"))), "surrogates")
        shared = (t.groupBy("kind", "surrogate").agg(F.min(F.struct(F.col("attempt") == 0, "value")).alias("_keeps"), F.count(F.lit(1)).alias("_n"))
                  .where("_n > 1").drop("_n"))
        known = entities.select("kind", F.col("value").alias("surrogate"), F.lit(True).alias("_known"))
        lost = (t.join(shared, ["kind", "surrogate"], "left").join(known, ["kind", "surrogate"], "left")
                .where(F.coalesce("_known", F.lit(False)) | (F.col("_keeps.value") != F.col("value"))).select("kind", "value"))
        lost = materialize(lost, "collisions")
        if not lost.limit(1).count():
            return t.where("attempt > 0").select("kind", "value", "surrogate")
        again = lost.withColumn("_again", F.lit(1))
        t = (t.drop("surrogate").join(again, ["kind", "value"], "left")
             .select("kind", "value", (F.col("attempt") + F.coalesce("_again", F.lit(0))).alias("attempt")))
    raise ValueError(f"entities outnumber the surrogates of their format after {MAX_ATTEMPTS} draws")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Documents with every detected entity replaced: adds n_entities, replaces text, keeps all
    other columns.

    Kinds: e-mail, hexadecimal secrets, IBAN, IPv4 and IPv6, phone (international and national),
    SSN, card numbers, and names after a title. A surrogate depends on the key, kind and value alone, so an entity has the same one in
    every document (coreference; a name's words are replaced one by one, so "Mr. A B" and "Mr. B"
    agree). It has the format of the value: classes and case of characters, separators, an
    e-mail's top-level domain, a phone's country code or leading 0, the validity of a card's check digit,
    a given name's gender and a name's script. All distinct entities of the corpus are checked:
    no two have the same surrogate and none is another entity; losers draw again. Only where
    that happened are the texts joined with the exceptions (by a hash of the text).

    Null texts stay null, empty ones empty, with 0 entities. Equal rows stay equal. An empty
    table gives no rows. Initials follow a keyed order of the alphabet; particles (von, de la) stay.
    Names without a title aren't detected, nor what the README lists.
    """
    docs = docs.drop("n_entities")
    found = docs.select(F.explode(F.array_distinct(matches(F.col("text")))).alias("_match"))
    entities = materialize(found.groupBy("_match").agg(F.lit(1).alias("_one")).select(F.explode(entity_parts(F.col("_match"))).alias("_e"))
                           .where(is_entity(F.col("_e"))).select("_e.kind", "_e.value").distinct(), "entities")
    exceptions = materialize(collisions(entities, key), "surrogate-exceptions")

    def plain(e):
        return surrogate(e["kind"], e["value"], key, F.lit(0))

    one, columns = plain, docs.columns
    docs = docs.select("text", F.struct(*[c for c in columns if c != "text"]).alias("_rest"))
    if exceptions.limit(1).count():
        h = F.sha2(text_or_empty(), 256)
        inside = (docs.select(h.alias("_h"), F.explode(F.array_distinct(F.flatten(F.transform(matches(F.col("text")), entity_parts)))).alias("_e"))
                  .select("_h", "_e.kind", "_e.value").distinct())
        maps = (inside.join(exceptions, ["kind", "value"]).groupBy("_h")
                .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "value"), "surrogate"))).alias("_map")))
        docs = docs.withColumn("_h", h).join(maps, "_h", "left").drop("_h")

        def one(e):
            return F.coalesce(F.element_at(F.col("_map"), F.concat_ws("\x1f", e["kind"], e["value"])), plain(e))

    def word(e):
        return F.when(e["kind"] == "initials", new_initials(e["value"], key)).when(e["kind"] == "particle", e["value"]).otherwise(one(e))

    def new(match):
        return F.concat(_titles(match), F.array_join(F.transform(entity_parts(match), word), " "))

    m = docs.withColumn("_matches", matches(F.col("text")))
    between = F.split("text", ANY, -1)
    text = F.when(F.size("_matches") == 0, F.col("text")).otherwise(F.array_join(
        F.zip_with(between, F.concat(F.transform("_matches", new), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""))
    return m.select(*[text.alias("text") if c == "text" else F.col("_rest").getField(c).alias(c) for c in columns],
                    F.when(F.col("text").isNull(), 0).otherwise(F.size("_matches")).alias("n_entities"))
