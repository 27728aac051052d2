"""Personal data replaced by keyed surrogates.

E-mail addresses, telephone, card, bank-account (IBAN) and social-security numbers, IP addresses and titled
names are found by one pattern. In it, repeated groups are bounded or possessive: Java's matcher calls
itself for each turn of any other, and a long enough text would overflow the stack. The distinct entities of the whole corpus form a dictionary: an entity's
surrogate comes from a SHA-256 stream keyed by a secret, the entity's kind and its canonical form
(so the formats of one number agree, and every mention in every document gets the same surrogate),
and is written in the mention's own format. Surrogates that meet another entity's surrogate, or an
entity of the corpus, are drawn again until all are distinct. Only documents with entities and the
dictionary are shuffled; all others pass straight through.
"""

from __future__ import annotations

from functools import reduce
from itertools import count
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfarer.llm.common import stored

KEY = "wayfarer-surrogates"  # a deployment passes its own secret
SHAPE = 320  # characters of an address whose shape its surrogate has
KEPT_DRAWS = 12  # draws in the entity's own format; each later one is a place longer

MALE_TITLES = ("Mr", "Sir", "Herr", "Señor", "Sr", "Monsieur", "Господин", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Sra", "Madame", "Mme", "Госпожа", "г-жа")
NEUTRAL_TITLES = ("Dr", "Prof")

_LETTERS = "A-Za-z0-9\u00C0-\u024F\u0370-\u03FF\u0400-\u04FF"  # of addresses: Latin, Greek, Cyrillic
EMAIL = rf"(?<![{_LETTERS}._%+-])[{_LETTERS}._%+-]++@[{_LETTERS}-]+(?:\.[{_LETTERS}-]+)++"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
IP = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"
IP6 = (rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]{{0,35}}[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|::(?:{_HEX}:){{0,5}}{_HEX}"
       rf"|(?:{_HEX}:){{2,7}}:)(?![0-9A-Za-z:])")
IBAN = r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9]))[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_SEP = r"(?:[ .\u00A0\u202F-]|[ .\u00A0\u202F-]?\(|\)[ .\u00A0\u202F-]?)?"  # between two digits of a number
_DATE = r"[0-9]{2}[./-][0-9]{2}[./-](?:[0-9]{4}|[0-9]{2})(?![0-9]|[./-][0-9])"
PHONE = (r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
         rf"|\+\(?[0-9](?:{_SEP}[0-9]){{6,14}}(?![0-9])"
         r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
         r"|(?<![0-9.-])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
# national forms: with a leading 0 (00 before a country code), or groups of a nine-digit number
LOCAL = (rf"(?<![0-9A-Za-z.,+/-])(?!{_DATE})\(?00?[1-9](?:/?{_SEP}[0-9]){{5,13}}(?![0-9])"
         r"|(?<![0-9.,-])[6-9][0-9]{2} (?:[0-9]{3} [0-9]{3}|[0-9]{2} [0-9]{2} [0-9]{2})(?![0-9])")
SSN = r"(?<![0-9-])[0-9]{3}(?:-[0-9]{2}-|[ ][0-9]{2}[ ])[0-9]{4}(?![0-9-])"
CARD = (r"(?<![0-9])(?:3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}"
        r"|[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{1,7})(?![0-9])")
_TITLES = "|".join(t for title in MALE_TITLES + FEMALE_TITLES + NEUTRAL_TITLES for t in dict.fromkeys((title, title.upper())))
# A name is up to six words: capitalised ones with any letters, apostrophes and hyphens in them, initials, and
# between them the small words that names have.
PARTICLES = ("de", "la", "las", "los", "del", "della", "di", "da", "dos", "du", "von", "der", "den", "van", "zu", "le", "el", "al", "bin", "ibn", "y")
_SMALL = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}"
_WORD = r"\p{Lu}(?:[\p{L}'\u2019-]*\p{L})?(?![\p{L}.])|\p{Lu}\.|\p{Lu}(?:[\p{L}'\u2019-]*\p{L})"
NAME = rf"(?<!\p{{L}})(?:{_TITLES})\.? {_SMALL}(?:{_WORD})(?: {_SMALL}(?:{_WORD})){{0,5}}"
ENTITY = f"{EMAIL}|{IBAN}|{IP6}|{IP}|{PHONE}|{SSN}|{CARD}|{LOCAL}|{NAME}"

KINDS = ("email", "ip", "phone", "ssn", "card", "iban", "name")

# Syllables of surrogate names by script, and endings by gender.
LATIN = ("ba", "de", "fi", "go", "ka", "le", "mi", "no", "pa", "re", "si", "to", "va", "wi", "ze", "lu")
CYRILLIC = ("ба", "ве", "ги", "до", "ка", "ле", "ми", "но", "па", "ре", "си", "то", "ва", "ли", "зе", "лу")
ENDINGS = {"latin": {"male": "n", "female": "na", "none": "l"}, "cyrillic": {"male": "н", "female": "на", "none": "ль"}}


def kind_of(mention: Column) -> Column:
    digits = F.length(F.regexp_replace(mention, "[^0-9]", ""))
    return (F.when(mention.contains("@"), "email")
            .when(mention.rlike(rf"^(?:{IP}|{IP6})$"), "ip")
            .when(mention.rlike(rf"^(?:{IBAN})$"), "iban")
            .when(mention.rlike(r"\p{L}"), "name")
            .when(mention.rlike(rf"^(?:{SSN})$"), "ssn")
            .when(mention.rlike(r"^(?:[+(]|00)") | (digits < 13), "phone")
            .otherwise("card"))


def canonical(kind: Column, mention: Column) -> Column:
    """Equal for the mentions of one entity: digits alone for numbers, lower case without a title else."""
    return (F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
            .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
            .when(kind == "name", F.lower(F.regexp_replace(mention, rf"^(?:{_TITLES})\.? ", "")))
            .otherwise(F.lower(mention)))


def _byte(stream: Column, i: Column) -> Column:
    """Byte ``i`` of a hex stream of 128 bytes, read in a ring."""
    at = (F.pmod(i, F.lit(128)) * 2 + 1).cast("int")
    return F.conv(F.substr(stream, at, F.lit(2)), 16, 10).cast("int")


def _stream(seed: Column) -> Column:
    return F.concat(*[F.sha2(F.concat_ws("|", seed, F.lit(str(i))), 256) for i in range(4)])


def _chars(shape: Column, stream: Column) -> Column:
    """Each letter and digit of ``shape`` replaced by one of its class, case and script."""
    latin, upper = F.lit("abcdefghijklmnopqrstuvwxyz"), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    cyr = F.lit("абвгдежзиклмнопрстуфхцчшщэюя")

    def pick(letters: Column, h: Column) -> Column:
        return F.substr(letters, F.pmod(h, F.length(letters)).cast("int") + 1, F.lit(1))

    def one(c: Column, i: Column) -> Column:
        h = _byte(stream, i)
        return (F.when(c.rlike("[0-9]"), F.pmod(h, F.lit(10)).cast("string"))
                .when(c.rlike("[a-z]"), pick(latin, h)).when(c.rlike("[A-Z]"), pick(upper, h))
                .when(c.rlike(r"\p{IsCyrillic}"), F.when(c.rlike(r"\p{Lu}"), F.upper(pick(cyr, h))).otherwise(pick(cyr, h)))
                .when(c.rlike(r"\p{Lu}"), pick(upper, h)).when(c.rlike(r"\p{L}"), pick(latin, h))
                .otherwise(c))

    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _name(canon: Column, gender: Column, seed: Column, draw: Column) -> Column:
    """Each word becomes a name of its own script, an initial an initial, and a small word stays; a given name
    (all words but the last of several) ends as its gender does, so a surname alone and with a given name agree. Four syllables, and one more
    with each draw, so there are names enough for any number of entities."""
    words = F.split(canon, " ")

    def one(w: Column, i: Column) -> Column:
        role = F.when((F.size(words) > 1) & (i < F.size(words) - 1), gender).otherwise("none")
        stream = _stream(F.concat_ws("|", seed, F.lit("word"), role, w))
        script = F.when(w.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")

        def made(table: tuple[str, ...], endings: dict[str, str]) -> Column:
            pool = F.array(*[F.lit(s) for s in table])
            syllables = F.array_join(F.transform(F.sequence(F.lit(0), draw + 3), lambda k: F.element_at(
                pool, F.pmod(_byte(stream, k), F.lit(len(table))).cast("int") + 1)), "")
            end = F.when(role == "male", endings["male"]).when(role == "female", endings["female"]).otherwise(endings["none"])
            return F.initcap(F.concat(syllables, end))

        whole = F.when(script == "cyrillic", made(CYRILLIC, ENDINGS["cyrillic"])).otherwise(made(LATIN, ENDINGS["latin"]))
        return F.when(w.isin(*PARTICLES), w).when(w.rlike(r"^\p{L}\.$"), F.concat(F.substr(whole, F.lit(1), F.lit(1)), F.lit("."))).otherwise(whole)

    return F.array_join(F.transform(words, one), " ")


def _luhn_sum(digits: Column) -> Column:
    """The sum that is a multiple of ten for the digits of a card: from the right, every second one doubled."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)


def _luhn(made: Column, canon: Column) -> Column:
    """``made`` with a last digit that makes it pass the cards' check, where ``canon`` passes it."""
    head = F.substr(made, F.lit(1), F.length(made) - 1)
    last = F.pmod(-_luhn_sum(F.concat(head, F.lit("0"))), F.lit(10)).cast("string")
    return F.when(_luhn_sum(canon) % 10 == 0, F.concat(head, last)).otherwise(made)


def draw(entities: DataFrame, key: str) -> DataFrame:
    """``entities`` (kind, canon, gender, draw) with the canonical form of their surrogates, ``made``."""
    seed = F.concat_ws("|", F.lit(key), "kind", F.when(F.col("kind") != "name", F.col("canon")).otherwise(""), F.col("draw").cast("string"))
    entities = entities.withColumn("_seed", seed).withColumn("_stream", _stream(F.col("_seed")))
    seed, stream = F.col("_seed"), F.col("_stream")
    extra = F.greatest(F.lit(0), F.col("draw") - (KEPT_DRAWS - 1))
    octets = F.array_join(F.transform(F.sequence(F.lit(0), extra + 3), lambda i: (F.pmod(_byte(stream, i), F.lit(254)) + 1).cast("string")), ".")
    at = F.instr("canon", "@")
    last_dot = F.length("canon") - F.instr(F.reverse("canon"), ".") + 1  # the top-level domain stays
    # a surrogate has the shape of the first SHAPE characters: longer ones are no real addresses
    email = F.concat(_chars(F.substr("canon", F.lit(1), F.least(last_dot - 1, F.lit(SHAPE))), stream), F.substr("canon", last_dot))
    email = F.concat(_chars(F.repeat(F.lit("x"), extra), F.reverse(stream)), email)
    groups = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substr(stream, (i * 4 + 1).cast("int"), F.lit(4))), ":")
    iban = F.concat(F.substr("canon", F.lit(1), F.lit(2)), _chars(F.concat(F.substr("canon", F.lit(3)), F.repeat(F.lit("0"), extra)), stream))
    made = (F.when((F.col("kind") == "ip") & F.col("canon").contains(":"), groups).when(F.col("kind") == "ip", octets)
            .when(F.col("kind") == "iban", iban)
            .when(F.col("kind") == "card", _luhn(_chars(F.concat(F.col("canon"), F.repeat(F.lit("0"), extra)), stream), F.col("canon")))
            .when(F.col("kind") == "name", _name(F.col("canon"), F.col("gender"), seed, F.col("draw")))
            .when((F.col("kind") == "email") & (at > 0), email)
            .otherwise(_chars(F.concat(F.col("canon"), F.repeat(F.lit("0"), extra)), stream)))
    return entities.withColumn("made", made).drop("_seed", "_stream")


def surrogates(entities: DataFrame, key: str, name: str = "surrogates") -> DataFrame:
    """(kind, canon, made): distinct surrogates of distinct entities, none of them an entity itself.
    Each round draws again for the entities that met another; few or none after the first. Names grow
    with each draw, the others once ``KEPT_DRAWS`` in their own format have met others, so rounds end."""
    entities = stored(entities.withColumn("draw", F.lit(0)), f"{name}-entities")
    real = entities.select("kind", F.col("canon").alias("made"))
    done, open_ = None, stored(draw(entities, key), f"{name}-0")
    for turn in count(1):
        firsts = open_.groupBy("kind", F.lower("made").alias("low")).agg(F.min("canon").alias("canon"))
        good = open_.join(firsts.select("kind", "canon"), ["kind", "canon"], "left_semi")
        good = good.join(real, (good.kind == real.kind) & (F.lower(good.made) == real.made), "left_anti")
        if done is not None:
            taken = done.select("kind", F.lower("made").alias("low"))
            good = good.join(taken, (good.kind == taken.kind) & (F.lower(good.made) == taken.low), "left_anti")
        good = good.select("kind", "canon", "made")
        done = stored(good if done is None else done.unionByName(good), f"{name}-done-{turn}")
        left = open_.join(done, ["kind", "canon"], "left_anti")
        if left.isEmpty():
            return done
        open_ = stored(draw(left.drop("made").withColumn("draw", F.lit(turn)), key), f"{name}-{turn}")


def written(mention: Column, kind: Column, made: Column) -> Column:
    """The surrogate in the mention's format: digits take their places, those of a longer number follow; a
    name keeps its title."""
    digits = F.regexp_replace(made, "[^0-9]", "")

    def place(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]"), F.substr(digits, before, F.lit(1))).otherwise(c)

    places = F.length(F.regexp_replace(mention, "[^0-9]", ""))
    number = F.concat(F.array_join(F.transform(F.split(mention, ""), place), ""), F.substr(digits, places + 1))
    title = F.regexp_extract(mention, rf"^(?:{_TITLES})\.? ", 0)
    loud = (mention == F.upper(mention)) & (F.length(F.regexp_replace(mention, r"[^\p{L}]", "")) > 3)
    spaced = F.trim(F.regexp_replace(made, "(.{4})", "$1 "))
    return (F.when(kind.isin("phone", "card", "ssn"), number)
            .when(kind == "iban", F.when(mention.contains(" "), spaced).otherwise(made))
            .when(kind == "name", F.concat(title, F.when(loud, F.upper(made)).otherwise(made)))
            .when((kind == "email") & (mention == F.upper(mention)), F.upper(made)).otherwise(made))


def gender_of(mention: Column) -> Column:
    def titled(titles: tuple[str, ...]) -> Column:
        return mention.rlike(rf"^(?:{'|'.join([*titles, *(t.upper() for t in titles)])})\.? ")

    return F.when(titled(MALE_TITLES), "male").when(titled(FEMALE_TITLES), "female").otherwise("none")


def pseudonymise(docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``text_col`` with every entity replaced, and for each kind
    the number of mentions (n_email, n_ip, n_phone, n_ssn, n_card, n_iban, n_name). Any 13 to 19 digits count as a
    card; the surrogate passes the cards' check digit where the mention does.

    The surrogate of an entity is the same in all documents and depends on ``key`` and the corpus's
    other entities only when two draws meet. Different entities have different surrogates, and no
    surrogate is an entity of the corpus. NULL stays NULL and empty text empty, both without
    mentions; repeated rows give equal rows; an empty table gives an empty result. Names are
    found by their titles only. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # every entity has a digit, an @ or a title; most texts have none, which is quickly seen
    hint = reduce(or_, [F.col("_text").contains(t) for t in _TITLES.split("|")], F.col("_text").rlike("[0-9@:]"))
    some = F.coalesce(hint & F.col("_text").rlike(ENTITY), F.lit(False))
    dirty = stored(rows.where(some).select("_id", "_text", F.regexp_extract_all("_text", F.lit(ENTITY), F.lit(0)).alias("_hits"))
                   .withColumn("_row", F.monotonically_increasing_id()), "texts-with-entities")
    mentions = dirty.select(F.explode(F.array_distinct("_hits")).alias("mention")).distinct()
    kind = kind_of(F.col("mention"))
    mentions = stored(mentions.select("mention", kind.alias("kind"), canonical(kind, F.col("mention")).alias("canon"),
                                      F.when(kind == "name", gender_of(F.col("mention"))).otherwise("none").alias("gender")), "mentions")
    entities = mentions.groupBy("kind", "canon").agg(F.min("gender").alias("gender"))
    made = mentions.join(surrogates(entities, key), ["kind", "canon"])
    dictionary = stored(made.select("mention", "kind", written(F.col("mention"), F.col("kind"), F.col("made")).alias("said")), "dictionary")
    per_row = (dirty.select("_row", F.explode(F.array_distinct("_hits")).alias("mention")).join(dictionary, "mention")
               .groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("mention", F.struct("said", "kind")))).alias("_map")))
    full = dirty.join(per_row, "_row").withColumn("_new", F.transform("_hits", lambda h: F.element_at("_map", h)))
    said = F.array_join(F.transform(F.split("_text", ENTITY, -1), lambda gap, i: F.concat(
        gap, F.coalesce(F.get("_new", i)["said"], F.lit("")))), "")
    kinds = F.transform("_new", lambda m: m["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    replaced = full.select(F.col("_id").alias(id_col), said.alias(text_col), *counts)
    clean = rows.where(~some).select(F.col("_id").alias(id_col), F.col("_text").alias(text_col),
                                     *[F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS])
    return clean.unionByName(replaced)
