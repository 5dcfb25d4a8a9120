"""Surrogates for personal data, by DataFrame functions alone.

Detected are mail addresses, IPv4 addresses, phone numbers (with a country code, a bracketed area code, or three
groups over hyphens or dots), US social security numbers, card numbers, secrets (hexadecimal of 32, 40 or 64 digits,
access keys with the usual prefixes, values with a digit after `password=` and the like), and names after a form of
address. A card has 13 to 19 digits in one piece, or groups of 4-4-4-4, 4-4-4-4-3 or 4-6-5 digits over one kind of
separator, the first digits of an issuer, and passes the Luhn check; groups in a longer row of numbers are none. Not
detected: IPv6 addresses, account numbers (IBAN), postal addresses, national phone numbers in other layouts, and names
without a form of address.

Replacements are drawn from a key and a value's normal form: the digits of a number, lower case for a mail address or
a name. Layout and case are put on afterwards, so that one value in two layouts stays one value. They keep type, script
and format, a card its Luhn sum, a given name its gender. The distinct values are a table; candidates that two values
share, or that equal some original, are drawn anew until all differ, so that distinct values stay distinct.

Within a text a name's word has one meaning: it is a surname if it is the last of several words after a title there,
else a given name if it is an earlier one, else (a lone word) a surname. A given name's gender comes from any
title of the text that shows it. Later in the text the bare word goes along, as it was written, unless it is a single
letter, a common word (COMMON_WORDS) or written in lower case in the same text as well; earlier ones stay.

Results for odd input: null texts stay null; texts without entities stay as they are; a null id is carried; repeated
rows are rewritten alike; an empty table gives an empty result; texts of any length are read whole, no pattern
recurses with their length; host names of more than 127 labels are no mail address; other columns, whatever their
names, are carried (n_chars follows the text).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.sources.tables import staged

# Key of the registered queries; real runs pass their own.
DEMO_KEY = "larder-demo"

# Forms of address by gender.
ADDRESS = {
    "m": ["Mr", "Sir", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Don", "Signor", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Doña",
          "Signora", "госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Doktor", "Docteur", "Doctor", "доктор"],
}
# Given names drawn first, by script and gender, and the syllables of surnames and of later draws.
GIVEN = {
    "latin": {"m": "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karim Leon Martin Noel Oscar Paul".split(),
              "f": "Anna Berta Clara Diana Elena Flora Greta Helga Irene Julia Karin Laura Maria Nora Olga Paula".split(),
              "n": "Alex Robin Kim Sascha Noa Charlie Dominique Jordan Andrea Camille Jessie Luca Mika Ari Sam Toni".split()},
    "cyrillic": {"m": "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Олег Павел Роман Семён Тимур Фёдор".split(),
                 "f": "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Кира Лидия Мария Нина Ольга Полина Раиса Софья".split(),
                 "n": "Саша Женя Валя Слава".split()},
    "greek": {"m": "Ανδρέας Γιώργος Δημήτρης Κώστας Λουκάς Μάρκος Νίκος Πέτρος".split(),
              "f": "Άννα Ελένη Ζωή Ειρήνη Καίτη Μαρία Νίκη Σοφία".split(),
              "n": "Άλεξ Νίκη".split()},
}
SYLLABLES = {
    "latin": "ba de fi go hu ka le mi no pu ra se ti vo wa ze".split(),
    "cyrillic": "ба ве га до жу за ки ло ми но пу ра се ти фо ха".split(),
    "greek": "βα γε δι ζο θα κε λι μο να πε ρι σο τα φι χο ψα".split(),
}
# Endings that keep a drawn given name in its gender.
ENDINGS = {
    "latin": {"m": ["an", "or", "us", "ard"], "f": ["a", "ina", "ia", "ella"], "n": ["is", "en", "y", "el"]},
    "cyrillic": {"m": ["ан", "ор", "ислав", "им"], "f": ["а", "ина", "ия", "ана"], "n": ["и", "о", "е", "ю"]},
    "greek": {"m": ["ος", "ης", "ας", "ων"], "f": ["α", "η", "ία", "ώ"], "n": ["ι", "ο", "υ", "ε"]},
}

# Words that are names and something else; alone they are not taken for a name met before.
COMMON_WORDS = (
    "April Art August Banks Bill Black Brown Cash Chase Cook Cross Day Dean Drew Faith Fields Frank Grace Grant Gray Green "
    "Hill Hope Hunter Ivy Jack June King Lane Long Mark May Miles Page Park Pat Price Prince Rich Rob Rose Rush Short "
    "Skip Stone Sue Summer Sun Sunday Wade Ward White Will Winter Wood Woods Young").split()

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_NAME = r"\p{Lu}[\p{L}\p{M}'’-]*"
# A title as listed, in capitals, or in small letters before a full stop.
TITLES = sorted({form for some in ADDRESS.values() for t in some for form in (t, t.upper())}, key=lambda t: (-len(t), t))
LOWER_TITLES = "prof mlle mrs sra mme mr ms dr sr".split()
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+-]*@(?:[A-Za-z0-9-]+\.){1,127}[A-Za-z]{2,}"
HEX = r"(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32}|[0-9A-F]{64}|[0-9A-F]{40}|[0-9A-F]{32})"
SECRET = rf"(?<![0-9A-Za-z]){HEX}(?![0-9A-Za-z])"
ACCESS_KEY = r"(?<![0-9A-Za-z])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk[-_][0-9A-Za-z_-]{16,64})(?![0-9A-Za-z])"
ASSIGNMENT = r"(?i:password|passwd|pwd|secret|token|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?"
ASSIGNED = rf"(?=[pPsStTaA]){ASSIGNMENT}(?=[^\s\"']{{0,127}}[0-9])[0-9A-Za-z+/_.~-]{{8,128}}(?![0-9A-Za-z+/_~-])"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])" \
        r"|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])" \
        r"|(?<![0-9.-])[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.)[0-9]{4}(?![0-9]|[.-][0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# First digits of the card issuers.
ISSUER = "(?=4|5[0-8]|2[2-7]|3[04-9]|6[02-57])"
# Groups over one separator, with less than two more groups before them and less than three after them.
_GROUPED = "|".join(
    rf"{ISSUER}(?<![0-9]{s}[0-9]{{1,9}}{s})[0-9]{{4}}{s}(?:[0-9]{{4}}{s}[0-9]{{4}}{s}[0-9]{{4}}(?:{s}[0-9]{{3}}(?![0-9]))?"
    rf"|[0-9]{{6}}{s}[0-9]{{4,5}})(?![0-9])(?!(?:{s}[0-9]{{1,9}}){{3}})" for s in (" ", "-"))
CARD = rf"(?=[2-6])(?<![0-9])(?:{ISSUER}[0-9]{{13,19}}(?![0-9])|{_GROUPED})"
# The first letters come first: a look at one character spares most places the rest of a pattern.
_CAPITAL = "".join(sorted({t[0] for t in [*TITLES, *LOWER_TITLES]}))
_TITLE = rf"(?=[{_CAPITAL}])(?<![\p{{L}}\p{{M}}])(?:(?:{'|'.join(TITLES)})\.?|(?:{'|'.join(LOWER_TITLES)})\.)\s"
PERSON = rf"{_TITLE}\s{{0,2}}{_NAME}(?: {{1,2}}{_NAME}){{0,2}}"
PATTERN = "|".join([EMAIL, ASSIGNED, SECRET, ACCESS_KEY, IPV4, PHONE, SSN, CARD, PERSON])


def may_hold(text: Column) -> Column:
    """A cheap test that every text with an entity passes: names have a title, keys a prefix, all others a digit."""
    return text.rlike(rf"[0-9@]|AKIA|ASIA|gh[pousr]_|sk[-_]|{_TITLE}")


def _literals(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn_sum(digits: Column) -> Column:
    """Luhn sum of a text of digits; the last digit counts once."""
    numbers = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    weighed = F.transform(numbers, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(weighed, F.lit(0), lambda a, b: a + b)


def kind_of(value: Column) -> Column:
    """Kind of a match of PATTERN; null for numbers that are no card."""
    is_hex, assigned = value.rlike(f"^{HEX}$"), value.rlike(f"^{ASSIGNMENT}")
    return (F.when(assigned, F.when(_assigned_value(value).rlike(f"^{HEX}$"), "secret").otherwise("password"))
            .when(value.contains("@"), "email").when(is_hex, "secret")
            .when(value.rlike("^(?:AKIA|ASIA|gh[pousr]_|sk[-_])"), "key")
            .when(value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "ipv4")
            .when(value.rlike(r"^[+(]|^[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}$"), "phone")
            .when(value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn").when(value.rlike(r"^\p{L}"), "person")
            .when(_luhn_sum(_digits(value)) % 10 == 0, "card"))


def _assigned_value(value: Column) -> Column:
    return F.regexp_replace(value, f"^{ASSIGNMENT}", "")


def normal_form(kind: Column, match: Column) -> Column:
    """What makes a match the same value as another one: its replacement is drawn from this."""
    value = _assigned_value(match)
    national = F.when(match.startswith("+"), F.lit("")).when(F.length(_digits(match)) == 10, "1").otherwise("")
    return (F.when(kind == "card", _digits(match)).when(kind == "phone", F.concat(F.lit("+"), national, _digits(match)))
            .when(kind.isin("email", "secret"), F.lower(value)).otherwise(value))


def dressed(kind: Column, match: Column, surrogate: Column) -> Column:
    """A normal form's surrogate in the layout and case of a match."""
    digits = _digits(surrogate)
    phone = digits.substr(F.length(digits) - F.length(_digits(match)) + 1, F.length(digits))
    local = F.length(F.substring_index(match, "@", 1))
    mail = F.array_join(F.transform(F.split(surrogate, ""), lambda c, i: F.when(
        (i < local) & match.substr(i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    prefix = F.regexp_extract(match, f"^(?:{ASSIGNMENT})?", 0)
    value = _assigned_value(match)
    hexed = F.when(value.rlike("[A-F]"), F.upper(surrogate)).otherwise(surrogate)
    return (F.when(kind == "card", _placed(match, surrogate)).when(kind == "phone", _placed(match, phone))
            .when(kind == "email", mail).when(kind == "secret", F.concat(prefix, hexed))
            .when(kind == "password", F.concat(prefix, surrogate)).otherwise(surrogate))


def _drawn(key: str, *parts: Column) -> Column:
    """Bytes drawn from the key and the parts, as an array of ints long enough for the longest part."""
    blocks = F.sequence(F.lit(0), (F.greatest(*(F.length(p) for p in parts)) / 32).cast("int"))
    text = F.array_join(F.transform(blocks, lambda i: F.sha2(
        F.concat_ws("\x1f", F.lit(key), *parts, i.cast("string")), 256)), "")
    pairs = F.split(F.rtrim(F.regexp_replace(text, "(..)", "$1 ")), " ")
    return F.transform(pairs, lambda h: F.conv(h, 16, 10).cast("int"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _from(values: list[str], number: Column) -> Column:
    return F.element_at(_literals(values), (number % len(values)).cast("int") + 1)


def _alike(value: Column, drawn: Column) -> Column:
    """Letters for letters of their script and case, digits for digits, everything else kept."""
    alphabets = {"[a-z]": "abcdefghijklmnopqrstuvwxyz", "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "[0-9]": "0123456789",
                 r"[\p{IsCyrillic}&&\p{Ll}]": "абвгдежзиклмнопрстуфхцчшэюя",
                 r"[\p{IsGreek}&&\p{Ll}]": "αβγδεζηθικλμνξοπρστυφχψω",
                 r"\p{Ll}": "abcdefghijklmnopqrstuvwxyz", r"\p{Lu}": "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}

    def one(char: Column, at: Column) -> Column:
        found = None
        for pattern, letters in alphabets.items():
            letter = F.lit(letters).substr((drawn[at] % len(letters)) + 1, F.lit(1))
            found = F.when(char.rlike(pattern), letter) if found is None else found.when(char.rlike(pattern), letter)
        return found.otherwise(char)

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _email(value: Column, drawn: Column) -> Column:
    """Same shape; the domain before the last label ends in the reserved name `example`."""
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    labels = F.split(domain, r"\.")
    inner = F.array_join(F.slice(labels, 1, F.greatest(F.size(labels) - 2, F.lit(0))), ".")
    shift = F.length(local)
    tail = F.slice(drawn, shift + 1, F.greatest(F.size(drawn) - shift, F.lit(1)))
    return F.concat(_alike(local, drawn), F.lit("@"), F.when(F.length(inner) > 0, F.concat(_alike(inner, tail), F.lit(".")))
                    .otherwise(F.lit("")), F.lit("example."), F.element_at(labels, -1))


def _hex(value: Column, drawn: Column) -> Column:
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.lower(F.hex(drawn[i] % 16))), "")


def _ipv4(drawn: Column, attempt: Column) -> Column:
    """An address of the private block 10/8; after three draws, of any block, as the private one may be full."""
    first = F.when(attempt < 3, F.lit(10)).otherwise(drawn[3] % 223 + 1)
    return F.concat_ws(".", first.cast("string"), *(drawn[i].cast("string") for i in range(3)))


def _placed(value: Column, digits: Column) -> Column:
    """`digits` in the places of the value's digits."""
    nth = lambda i: F.length(_digits(value.substr(F.lit(1), i + 1)))
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.when(
        c.rlike("[0-9]"), digits.substr(nth(i), F.lit(1))).otherwise(c)), "")


# Country codes of one or two digits; all others have three.
SHORT_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def _phone(value: Column, drawn: Column) -> Column:
    """The country code stays; North American numbers get the fictional exchange 555."""
    code = F.regexp_extract(value, rf"^\+(?:{SHORT_CODES}|[0-9]{{3}})", 0)
    new = _alike(value.substr(F.length(code) + 1, F.length(value)), drawn)
    return F.concat(code, F.when((code == "+1") & (F.length(new) == 10), F.regexp_replace(new, "[0-9]{3}([0-9]{4})$", "555$1"))
                    .otherwise(new))


def _key(value: Column, drawn: Column) -> Column:
    """The prefix stays."""
    prefix = F.regexp_extract(value, "^(?:AKIA|ASIA|gh[pousr]_|sk[-_])", 0)
    return F.concat(prefix, _alike(value.substr(F.length(prefix) + 1, F.length(value)), drawn))


def _card(value: Column, drawn: Column) -> Column:
    digits = _digits(value)
    payload = F.concat(digits.substr(1, 1), _alike(digits.substr(F.lit(2), F.length(digits) - 2), drawn))
    check = (10 - _luhn_sum(F.concat(payload, F.lit("0"))) % 10) % 10
    return _placed(value, F.concat(payload, check.cast("string")))


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _word(value: Column, kind: Column, drawn: Column, attempt: Column) -> Column:
    """A name's word in small letters: kind is given_<gender> or surname."""
    found = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        stem = F.array_join(F.transform(F.sequence(F.lit(4), F.lit(6) + attempt), lambda i: _from(syllables, drawn[i % 32])), "")
        word = stem
        for gender, endings in ENDINGS[script].items():
            later = F.concat(F.array_join(F.transform(F.sequence(F.lit(4), F.lit(4) + attempt),
                                                      lambda i: _from(syllables, drawn[i % 32])), ""), _from(endings, drawn[2]))
            given = F.when(attempt == 0, _from(GIVEN[script][gender], drawn[1])).otherwise(later)
            word = F.when(kind == f"given_{gender}", given).otherwise(word)
        found = F.when(_script(value) == script, word).otherwise(found)
    return F.lower(found)


def surrogate(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """Candidate replacement of a value at an attempt."""

    def candidate(drawn: Column) -> Column:
        return (F.when(kind == "email", _email(value, drawn)).when(kind == "secret", _hex(value, drawn))
                .when(kind == "ipv4", _ipv4(drawn, attempt)).when(kind == "phone", _phone(value, drawn))
                .when(kind == "key", _key(value, drawn)).when(kind == "password", _alike(value, drawn))
                .when(kind == "ssn", F.concat(F.lit("9"), _alike(value.substr(F.lit(2), F.length(value)), drawn)))
                .when(kind == "card", _card(value, drawn)).otherwise(_word(value, kind, drawn, attempt)))

    return _let(_drawn(key, kind, value, attempt.cast("string")), candidate)


def assign(values: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): no surrogate twice, none equal to an original.

    Each round keeps the smallest value of those that drew the same, and draws anew for the others."""
    originals = staged(values, "entities")
    pending = originals.withColumn("attempt", F.lit(0))
    done: list[DataFrame] = []
    while True:
        drawn = staged(pending.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("value"), F.col("attempt"))),
                       "drawn")
        first = drawn.groupBy("surrogate").agg(F.min(F.struct("value", "kind")).alias("first"))
        taken = originals.select(F.col("value").alias("surrogate"))
        for earlier in done:
            taken = taken.unionByName(earlier.select("surrogate"))
        first = first.join(taken, "surrogate", "left_anti")
        judged = staged(drawn.join(first, "surrogate", "left").withColumn(
            "won", F.coalesce(F.col("first") == F.struct("value", "kind"), F.lit(False))).drop("first"), "judged")
        done.append(judged.filter("won").select("kind", "value", "surrogate"))
        pending = judged.filter("not won").select("kind", "value", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _gender(title: Column) -> Column:
    plain = F.lower(F.regexp_replace(title, r"\.$", ""))
    return F.when(plain.isin([t.lower() for t in ADDRESS["m"]]), "m") \
        .when(plain.isin([t.lower() for t in ADDRESS["f"]]), "f").otherwise("n")


def _cased(value: Column, surrogate: Column) -> Column:
    """A name's surrogate in capitals if the name is, else with one capital."""
    return F.when((F.length(value) > 1) & (value == F.upper(value)), F.upper(surrogate)).otherwise(F.initcap(surrogate))


def _name_words(people: DataFrame) -> DataFrame:
    """key, pos, place, value, name (folded), last and gender of every word of the names in matches (key, pos, match)."""
    tokens = people.select("key", "pos", F.split("match", r"\s+").alias("tokens"))
    return tokens.select("key", "pos", _gender(F.col("tokens")[0]).alias("gender"), F.size("tokens").alias("size"),
                         F.posexplode(F.slice("tokens", 2, F.size("tokens"))).alias("place", "value")) \
        .select("key", "pos", "place", "value", F.lower("value").alias("name"), "gender", (F.col("size") > 2).alias("full"),
                (F.col("place") == F.col("size") - 2).alias("last"))


def _meanings(words: DataFrame) -> DataFrame:
    """One kind per text and name: surname, or given_<gender> with the gender that some title of the text shows."""
    given = ~(F.col("full") & F.col("last"))

    def shown(gender: str) -> Column:
        return F.bool_or(given & (F.col("gender") == gender))

    return words.groupBy("key", "name").agg(
        F.bool_or(F.col("full") & F.col("last")).alias("surname"), F.bool_or(F.col("full") & ~F.col("last")).alias("given"),
        shown("m").alias("m"), shown("f").alias("f"),
    ).select("key", "name", F.when(F.col("surname") | ~F.col("given"), "surname").when(F.col("m") & ~F.col("f"), "given_m")
             .when(F.col("f") & ~F.col("m"), "given_f").otherwise("given_n").alias("kind"))


def surrogates(found: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Of matches (key, pos, match): (key, pos, new) for every entity, what takes its place in the text `key`; and (key, names)
    for every text with names: (pos, value, surrogate) of each word of its names, where it comes first."""
    matches = staged(found.select("match").distinct().withColumn("kind", kind_of(F.col("match")))
                     .filter(F.col("kind").isNotNull())
                     .withColumn("value", normal_form(F.col("kind"), F.col("match"))), "matches")
    people = found.join(matches.filter("kind = 'person'").select("match"), "match")
    words = staged(_name_words(people), "name_words")
    meanings = staged(_meanings(words), "meanings")
    values = matches.filter("kind <> 'person'").select("kind", "value").unionByName(
        meanings.select("kind", F.col("name").alias("value"))).distinct()
    table = staged(assign(values, key), "surrogates")
    # Written, so that a value in very many texts is split over tasks where these rows meet it.
    plain = staged(matches.join(table, ["kind", "value"]).select(
        "match", dressed(F.col("kind"), F.col("match"), F.col("surrogate")).alias("new")), "plain")
    named = staged(meanings.join(table.withColumnRenamed("value", "name"), ["kind", "name"]).drop("kind"), "named")
    replaced = staged(words.join(named, ["key", "name"]).select(
        "key", "pos", "place", "value", _cased(F.col("value"), F.col("surrogate")).alias("surrogate")), "replaced_words")
    names = replaced.groupBy("key", "pos").agg(F.sort_array(F.collect_list(F.struct("place", "surrogate"))).alias("words"))
    spelt = people.join(names, ["key", "pos"]).select("key", "pos", _respelt(F.col("match"), F.col("words")).alias("new"))
    first = replaced.groupBy("key", "value").agg(F.min("pos").alias("pos"), F.first("surrogate").alias("surrogate"))
    listed = first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "value", "surrogate"))).alias("names"))
    return found.join(plain, "match").select("key", "pos", "new").unionByName(spelt), listed


def _respelt(match: Column, words: Column) -> Column:
    """A match with its name's words replaced; the title and all white space stay."""
    tokens = F.regexp_extract_all(match, F.lit(r"\s+|\S+"), 0)
    return F.array_join(F.transform(tokens, lambda t, i: F.when(
        (i > 1) & (i % 2 == 0), words[((i - 2) / 2).cast("int")]["surrogate"]).otherwise(t)), "")


def _alone(word: Column) -> Column:
    """Pattern of a word that stands alone."""
    return F.concat(F.lit(r"(?<![\p{L}\p{M}])\Q"), word, F.lit(r"\E(?![\p{L}\p{M}])"))


def _bare(between: Column, names: Column, key: Column) -> Column:
    """The pieces between a text's matches, where each name word that stands alone after its first mention is replaced.

    The pieces are joined by a mark that no name can match, so that a word takes one pass over what follows it. No
    surrogate is an original, so one pass after the other never meets its own output."""
    mark = F.concat(F.lit("\ue000"), key, F.lit("\ue001"))

    def replaced(text: Column, word: Column) -> Column:
        before = F.call_function("substring_index", text, mark, word["pos"] + 1)
        after = text.substr(F.length(before) + 1, F.length(text))
        return F.concat(before, F.regexp_replace(after, _alone(word["value"]), word["surrogate"]))

    return F.split(F.aggregate(names, F.call_function("array_join", between, mark), replaced), mark, -1)


def _goes_along(word: Column, text: Column) -> Column:
    """Whether a bare word of a text may be taken for the name."""
    common = F.lower(word).isin([w.lower() for w in COMMON_WORDS])
    return word.rlike(r"\p{L}.*\p{L}") & ~common & ~F.rlike(text, _alone(F.lower(word)))


def rewrite(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """`docs` with a struct `row` of its columns, the new `text`, and `n_replaced`, the number of entities replaced.

    Matches are found once, in the texts that pass ``may_hold``; only these texts are shuffled."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    may = F.coalesce(may_hold(docs["text"]), F.lit(False))
    some = docs.filter(may).select(row, F.sha2(docs["text"], 256).alias("key"))
    found = staged(
        docs.filter(may).select(F.sha2(docs["text"], 256).alias("key"),
                                F.regexp_extract_all(docs["text"], F.lit(PATTERN), 0).alias("matches"))
        .filter(F.size("matches") > 0).groupBy("key").agg(F.first("matches").alias("matches"))
        .select("key", F.posexplode("matches").alias("pos", "match")), "found")
    entities, people = surrogates(found, key)
    # One entry per match of one text, in order; what is no entity after all keeps itself.
    entry = F.struct("pos", F.coalesce("new", "match").alias("new"), F.col("new").isNotNull().alias("is_entity"))
    lists = staged(found.join(entities, ["key", "pos"], "left").groupBy("key").agg(
        F.sort_array(F.collect_list(entry)).alias("all")).filter(F.exists("all", lambda e: e["is_entity"]))
        .join(people, "key", "left"), "lists")
    joined = some.join(lists, "key", "left").withColumn("old", F.col("row.text"))
    between = F.split(F.col("old"), PATTERN, -1)
    names = F.filter("names", lambda w: _goes_along(w["value"], F.col("old")))
    left = _let(names, lambda some: F.when(F.size(some) > 0, _bare(between, some, F.col("key"))).otherwise(between))
    text = F.array_join(F.zip_with(left, F.col("all.new"), lambda t, n: F.concat(t, F.coalesce(n, F.lit("")))), "")
    counted = F.size(F.filter("all", lambda e: e["is_entity"])).cast("long")
    changed = joined.select("row", F.when(F.col("all").isNull(), F.col("old")).otherwise(text).alias("text"),
                            F.when(F.col("all").isNull(), F.lit(0)).otherwise(counted).cast("long").alias("n_replaced"))
    same = docs.filter(~may).select(row, docs["text"].alias("text"), F.lit(0).cast("long").alias("n_replaced"))
    return same.unionByName(changed)


def replace(docs: DataFrame, key: str = DEMO_KEY) -> DataFrame:
    """`docs` with personal data replaced, in the columns it came in."""
    done = rewrite(docs, key)

    def kept(name: str) -> Column:
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            return F.length("text").cast(docs.schema[name].dataType).alias(name)
        return F.col("row").getField(name).alias(name)

    return done.select(*[kept(c) for c in docs.columns])
