"""Personal data replaced by keyed surrogates of the same type and format.

Found are e-mail addresses, IPv4 addresses, payment cards (with a valid check digit), telephone
numbers, US social security numbers, access keys, values after words like ``password =`` to the end of
their characters, and all capitalised words after a title, with initials between them; the last one is
the family name. Every value has a canonical form (digits of a number, lower case of
an address or name), and the surrogate depends on key, type and canonical form alone, so one value
has one surrogate in all documents. It is written in the format found: digits for digits, letters of
the same case, separators where they were, a card with a valid check digit, a name in its script with
an ending of its title's gender.

Surrogates are held against each other and against all values found: a value whose surrogate is taken
or is a real value is drawn anew, until all are distinct; a made-up name gets one syllable more each
time, so the number of names has no limit.

Everything is DataFrame functions. Only documents with a finding are shuffled.

Cases: a null or empty text stays; repeated rows and copies get the same text; an empty table gives an
empty result; all columns are kept; a column ``n_entities`` is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variloom.llm.tables import settle, spare

#: Titles by gender.
TITLES = {"m": ["Mr", "Herr", "Sr", "Señor", "Monsieur", "Sir", "г-н", "Кύριος", "κ"],
          "f": ["Mrs", "Ms", "Miss", "Frau", "Sra", "Señora", "Mme", "Madame", "г-жа", "κα"]}
_WORD = r"(?:\p{Lu}\.? )*+\p{Lu}[\p{L}'’-]++"
_TITLE = "|".join(t for titles in TITLES.values() for t in titles)
#: One alternative for each type, tried in this order at every place; each begins with a cheap test.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,24}",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9+(]|[0-9][ .-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-][0-9]{3,4}[ .-][0-9]{4}(?![ .-]?[0-9])|(?<![0-9])\+[0-9]{8,15}(?![0-9])",
    "key": r"(?<![A-Za-z0-9])A[KS]IA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?<![a-z])(?:password|passwd|token|secret|api_key|apikey))\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9+/_.-]{6,}+",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? {_WORD}(?: {_WORD})*+",
}
#: Syllables of made-up names by script, and endings by gender (s: family name).
SYLLABLES = {"latin": ["bel", "car", "dor", "fen", "gal", "hol", "jor", "kal", "lin", "mar", "nel", "pol", "ros", "sel", "tam", "val"],
             "cyrillic": ["бел", "вор", "гал", "дан", "жан", "зар", "кол", "лин", "мар", "нел", "пол", "рос", "сел", "там", "фед", "юр"],
             "greek": ["βελ", "γαλ", "δορ", "ζαν", "θελ", "καλ", "λιν", "μαρ", "νελ", "ξεν", "πολ", "ροσ", "σελ", "ταμ", "φεν", "χαρ"]}
ENDINGS = {"latin": {"m": "on", "f": "ina", "s": "er"}, "cyrillic": {"m": "ан", "f": "ина", "s": "ов"}, "greek": {"m": "ος", "f": "ινα", "s": "ου"}}
ROUNDS = 24

_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Groups of digits in which a card is written among other numbers.
GROUPS = ["[0-9]{13,19}", "[0-9]{4}([ -]?)[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}", "[0-9]{4}([ -]?)[0-9]{4}\\2[0-9]{4}\\2[0-9]{4}\\2[0-9]{3}", "[0-9]{4}([ -]?)[0-9]{6}\\2[0-9]{4,5}"]
#: A text without any of these has no finding.
_QUICK = rf"@|[0-9][ -]?[0-9][ -]?[0-9]|[0-9]\.[0-9]|A[KS]IA|(?i:password|passwd|token|secret|api_?key)|(?:{_TITLE})\.? "


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of a digit string's digits, every second from the right doubled."""
    flipped = F.split(F.reverse(digits), "")
    values = F.transform(F.filter(flipped, lambda x: x != ""), lambda x, i: F.when(i % 2 == 1, x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)).otherwise(x.cast("int")))
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def _cards(body: Column) -> Column:
    """The valid cards of a text as written, longest first.

    Each stretch of up to 19 digits is tried from its first digit, and from there up to each separator; the usual
    groups are tried at every number. Only one of a few lengths that passes the check digit is taken for a card.
    """
    stretches = F.regexp_extract_all(body, F.lit(PATTERNS["card"]), F.lit(0))
    starts = F.flatten(F.transform(stretches, lambda x: F.array(*[F.regexp_extract(x, rf"^[0-9](?:[ -]?[0-9]){{{n - 1}}}(?![0-9])", 0) for n in range(19, 12, -1)])))
    grouped = [F.regexp_extract_all(body, F.lit(rf"(?<![0-9])(?=({g})(?![0-9]))"), F.lit(1)) for g in GROUPS]
    valid = F.filter(F.array_distinct(F.concat(starts, *grouped)), lambda x: (x != "") & (_luhn(_digits(x)) % 10 == 0))
    return F.transform(F.sort_array(F.transform(valid, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))), asc=False), lambda s: s["x"])


def _pattern(body: Column) -> Column:
    """All patterns, with the text's own valid cards in place of the one for cards: other digits are left to the other types."""
    own = F.when(body.rlike(PATTERNS["card"]), F.array_join(_cards(body), "|"))
    parts = [F.concat(F.lit("(?:(?<![0-9])(?:"), own, F.lit(")(?![0-9]))")) if name == "card" else F.lit(f"(?:{p})") for name, p in PATTERNS.items()]
    some = F.concat(*[x for p in parts for x in (F.lit("|"), p)][1:])
    return F.when(own != "", some).otherwise("|".join(f"(?:{p})" for name, p in PATTERNS.items() if name != "card"))


def _type(match: Column) -> Column:
    """The type of a finding; null for a number like a card that is none."""
    kind = F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        kind = F.when(match.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    return F.when((kind == "card") & (_luhn(_digits(match)) % 10 != 0), None).otherwise(kind)


def _units(kind: Column, match: Column) -> Column:
    """The values inside a finding: ``kind`` (with gender and script for names), ``canon`` and the text before and of it."""
    digits = _digits(match)
    national = F.when((F.length(digits) == 11) & digits.startswith("1"), F.substr(digits, F.lit(2))).otherwise(digits)
    secret = F.regexp_extract(match, r"^(?s)(.*?[=:]\s{0,3}[\"']?)([A-Za-z0-9+/_.-]+)$", 2)
    canon = (F.when(kind == "email", F.lower(match)).when(kind == "phone", national).when(kind.isin("ssn", "card"), digits)
             .when(kind == "secret", secret).otherwise(match))
    shown = F.when(kind == "secret", secret).otherwise(match)
    before = F.substr(match, F.lit(1), F.length(match) - F.length(shown))
    single = F.array(F.struct(kind.alias("kind"), canon.alias("canon"), before.alias("before"), shown.alias("shown")))
    words = F.split(match, " ")
    gender = F.when(F.regexp_replace(words[0], r"\.$", "").isin(TITLES["m"]), F.lit("m")).otherwise(F.lit("f"))
    last = F.size(words) - 1
    named = F.transform(F.slice(words, F.lit(2), last), lambda w, i: F.struct(
        F.concat(F.lit("name-"), F.when(i + 1 < last, gender).otherwise("s"), F.lit("-"), _script(w)).alias("kind"), F.lower(w).alias("canon"),
        F.when(i == 0, F.concat(words[0], F.lit(" "))).otherwise(F.lit(" ")).alias("before"), w.alias("shown")))
    return F.when(kind == "name", named).otherwise(single)


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")


def _nibbles(seed: Column) -> Column:
    return F.sha2(seed, 512)


def _spelled(hexes: Column, letters: str) -> Column:
    """Hex digits as letters or digits of an alphabet of sixteen."""
    return F.translate(hexes, "0123456789abcdef", letters)


def _draw(kind: Column, canon: Column, key: str, attempt: Column) -> Column:
    """The canonical surrogate: a pure function of its arguments."""
    hexes = _nibbles(F.concat_ws("\u0001", F.lit(key), kind, canon, attempt.cast("string")))
    more = F.concat(hexes, _nibbles(F.concat(hexes, F.lit("+"))))
    numbers = _spelled(more, "0123456789358149")
    size = F.length(canon)
    at = lambda k: F.substr(more, F.lit(k), F.lit(2))
    octet = lambda k: (F.conv(at(k), 16, 10).cast("int") % 254 + 1).cast("string")
    card = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(numbers, F.lit(2), size - 2))
    check = ((10 - _luhn(F.concat(card, F.lit("0"))) % 10) % 10).cast("string")
    alike = F.array_join(F.transform(F.split(canon, ""), lambda c, i: _like(c, F.substr(more, i % 256 + 1, F.lit(1)))), "")
    local = F.substring_index(canon, "@", 1)
    mail = F.concat(F.array_join(F.transform(F.split(local, ""), lambda c, i: _like(c, F.substr(more, i % 128 + 1, F.lit(1)))), ""), F.lit("@"),
                    _spelled(F.substr(more, F.lit(140), F.lit(8)), "bcdfghjklmnprstv"), F.lit(".example"))
    out = (F.when(kind == "email", mail).when(kind == "ip", F.concat_ws(".", F.lit("10"), octet(1), octet(3), octet(5)))
           .when(kind.isin("phone", "ssn"), F.substr(numbers, F.lit(1), size)).when(kind == "card", F.concat(card, check))
           .when(kind == "key", F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.upper(F.substr(more, F.lit(1), F.lit(16)))))
           .when(kind == "secret", alike))
    for script, syllables in SYLLABLES.items():
        parts = F.array(*[F.lit(s) for s in syllables])
        # one syllable more at every redraw, so that any number of names finds room
        stem = F.array_join(F.transform(F.sequence(F.lit(1), attempt + 4), lambda k: F.element_at(parts, F.conv(F.substr(more, k, F.lit(1)), 16, 10).cast("int") + 1)), "")
        for gender, ending in ENDINGS[script].items():
            out = F.when(kind == f"name-{gender}-{script}", F.concat(stem, F.lit(ending))).otherwise(out)
    return out


def _like(c: Column, hexed: Column) -> Column:
    """A character of the same class."""
    return (F.when(c.rlike("[0-9]"), _spelled(hexed, "0123456789358149")).when(c.rlike("[a-z]"), _spelled(hexed, "abcdefghijklmnop"))
            .when(c.rlike("[A-Z]"), _spelled(hexed, "ABCDEFGHIJKLMNOP")).otherwise(c))


def _render(kind: Column, shown: Column, drawn: Column) -> Column:
    """A canonical surrogate in the format of the value it stands for."""
    places = F.length(_digits(shown))
    # the canonical digits fill the value's digits from the right; a country code stays
    filled = F.concat(F.substr(_digits(shown), F.lit(1), places - F.length(drawn)), drawn)
    chars = F.split(shown, "")
    step = F.aggregate(chars, F.struct(F.lit(0).alias("i"), F.lit("").alias("s")), lambda s, c: F.struct(
        (s["i"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).alias("i"),
        F.concat(s["s"], F.when(c.rlike("[0-9]"), F.substr(filled, s["i"] + 1, F.lit(1))).otherwise(c)).alias("s")))
    upper = (shown == F.upper(shown)) & (F.length(F.regexp_replace(shown, r"\.$", "")) > 1)
    cased = F.when(upper, F.upper(drawn)).when(kind.startswith("name"), F.initcap(drawn)).when(F.substr(shown, F.lit(1), F.lit(1)).rlike("[A-Z]"), F.initcap(drawn)).otherwise(drawn)
    return F.when(kind.isin("phone", "ssn", "card"), step["s"]).when(kind.isin("email") | kind.startswith("name"), cased).otherwise(drawn)


def surrogates(values: DataFrame, key: str) -> DataFrame:
    """``kind``, ``canon`` and a distinct ``drawn`` for every distinct (``kind``, ``canon``)."""
    done = settle(values.select("kind", "canon").distinct(), "values")
    real = done.select(F.col("kind").alias("real_kind"), F.col("canon").alias("real"))
    done = settle(done.withColumn("attempt", F.lit(0)).withColumn("drawn", _draw(F.col("kind"), F.col("canon"), key, F.lit(0))), "drawn")
    for _ in range(ROUNDS):
        first = done.groupBy("kind", "drawn").agg(F.min(F.struct("attempt", "canon")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
        family = F.substring_index("kind", "-", 1)
        taken = (done.join(first, ["kind", "drawn"], "left")
                 .join(real.select(F.substring_index("real_kind", "-", 1).alias("real_kind"), "real").distinct(), (family == F.col("real_kind")) & (F.col("drawn") == F.col("real")), "left"))
        taken = taken.withColumn("again", F.coalesce(F.struct("attempt", "canon") != F.col("first"), F.lit(False)) | F.col("real").isNotNull())
        if taken.where("again").limit(1).count() == 0:
            return done.select("kind", "canon", "drawn")
        attempt = F.col("attempt") + F.col("again").cast("int")
        done = settle(taken.select("kind", "canon", attempt.alias("attempt"), F.when(F.col("again"), _draw(F.col("kind"), F.col("canon"), key, attempt)).otherwise(F.col("drawn")).alias("drawn")), "drawn")
    raise ValueError("a type has too few possible values to keep surrogates distinct")


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_entities``, the number of values replaced in it."""
    names = [c for c in docs.columns if c.lower() != "n_entities"]
    body = F.col(f"`{text}`")
    mark, mine = spare(docs, "has_entities"), spare(docs, "entity_key")
    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn(mark, F.coalesce(body.rlike(_QUICK) & body.rlike(_ANY), F.lit(False)))
    clean = rows.where(~F.col(mark)).drop(mark).withColumn("n_entities", F.lit(0).cast("long"))
    some = rows.where(mark).drop(mark).withColumn(mine, F.md5(body.cast("binary")))
    matches = some.select(F.col(mine).alias("key"), body.alias("body"), _pattern(body).alias("finder"))
    found = F.regexp_extract_all("body", "finder", F.lit(0))
    matches = matches.select("key", F.posexplode(found).alias("pos", "match")).distinct().withColumn("kind", _type(F.col("match")))
    units = matches.select("key", "pos", "match", F.posexplode_outer(F.when(F.col("kind").isNotNull(), _units(F.col("kind"), F.col("match")))).alias("unit", "u"))
    units = settle(units.select("key", "pos", "match", "unit", "u.*"), "entities")
    drawn = surrogates(units.where("kind is not null"), key)
    shown = units.join(drawn, ["kind", "canon"], "left").select(
        "key", "pos", "unit", F.when(F.col("drawn").isNull(), F.col("match")).otherwise(F.concat("before", _render(F.col("kind"), F.col("shown"), F.col("drawn")))).alias("new"),
        F.col("drawn").isNotNull().cast("long").alias("one"))
    new = shown.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", "unit", "new"))).alias("new"), F.sum("one").alias("n_entities"))
    # the text is what lies between the findings, with the new values in turn
    between, new_ = spare(docs, "between"), spare(docs, "new")
    per = F.transform(F.sequence(F.lit(0), F.size(between) - 1), lambda i: F.concat(
        F.element_at(between, (i + 1).cast("int")), F.array_join(F.transform(F.filter(new_, lambda x: x["pos"] == i), lambda x: x["new"]), "")))
    done = some.withColumn(between, F.split(body, _pattern(body), -1)).join(new.select(F.col("key").alias(mine), F.col("new").alias(new_), "n_entities"), mine, "left")
    changed = done.select(*[(F.when(F.col(new_).isNull(), body).otherwise(F.array_join(per, "")) if c == text else F.col(f"`{c}`")).alias(c) for c in names],
                          F.coalesce("n_entities", F.lit(0)).alias("n_entities"))
    return clean.unionByName(changed)
