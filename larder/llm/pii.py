"""Personal data replaced by surrogates, with column functions and joins only.

Every distinct value found gets one surrogate of its type and format, drawn from a keyed digest.
Surrogates are checked against each other and against all real values of the corpus; the loser of
a collision draws again. Values are therefore told apart after the replacement exactly as before,
and one value has the same surrogate wherever and however it is written.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.shared import Stored

# Forms of address and given names by gender, names by script.
_TITLES = {
    "m": ("Mr", "Mister", "Herr", "Monsieur", "Señor", "господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "госпожа"),
}
_GIVEN = {
    "m": (
        "James", "John", "Robert", "Michael", "William", "David", "Richard", "Thomas", "Charles", "Daniel",
        "Hans", "Peter", "Klaus", "Jürgen", "Wolfgang", "Pierre", "Jean", "Jacques", "François", "Carlos",
        "José", "Miguel", "Javier", "Иван", "Алексей", "Дмитрий", "Сергей",
    ),
    "f": (
        "Mary", "Patricia", "Jennifer", "Linda", "Elizabeth", "Susan", "Sarah", "Karen", "Emma", "Anna",
        "Maria", "Julia", "Petra", "Ursula", "Marie", "Claire", "Camille", "Carmen", "Lucía", "Isabel",
        "Елена", "Ольга", "Мария", "Наталья",
    ),
}
# Syllables of surrogate names by script, and the endings of given names by gender.
_SYLLABLES = {
    "latin": "ba de ki lo mar nel or pa ri sa tel u van wes ya zo".split(),
    "cyrillic": "ба де ки ло мар нел ор па ри са тел у ван вес я зо".split(),
}
_ENDINGS = {("latin", "m"): "ron", ("latin", "f"): "lia", ("cyrillic", "m"): "рон", ("cyrillic", "f"): "лия", ("latin", ""): "", ("cyrillic", ""): ""}

#: For surrogates: letters and symbols of secrets, and the attempts that keep a value's format.
_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
_SYMBOLS = "!#$%&*+-/=?^_~"
_KEPT = 8

_NAME = r"\p{Lu}[\p{L}'’-]+"
# An address starts where its letters do and has no more labels than a host may have, so that a
# long text without spaces is gone through once and without deep recursion.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,}+"
_SECRET = r"(?:password|passwd|pwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[^\s\"']{6,}"
_ACCESS = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_PHONE = (
    r"(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)"
    r"|(?<![\d(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?!\d))"
)
_CARD = r"(?<!\d)(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)"


def _word(words: dict[str, tuple[str, ...]]) -> str:
    """Any of the words where a word starts; their first letters are looked at before all else."""
    every = [w for group in words.values() for w in group]
    return rf"(?<!\p{{L}})(?=[{''.join(sorted({w[0] for w in every}))}])(?:{'|'.join(every)})"


_TITLED = rf"{_word(_TITLES)}\.? {_NAME}(?: {_NAME})?"
_NAMED = rf"{_word(_GIVEN)} {_NAME}"
#: In the order in which they are tried at a place.
_KINDS = (
    ("email", _EMAIL), ("secret", f"(?i:{_SECRET})"), ("access", _ACCESS), ("ip", _IP), ("ssn", _SSN),
    ("phone", _PHONE), ("card", _CARD), ("person", f"(?:{_TITLED}|{_NAMED})"),
)
_ANY = "|".join(p for _, p in _KINDS)
#: What every match contains, to pass over most texts quickly.
_HINT = rf"[@0-9]|(?=[PpTtSsAa])(?i:passw|pwd|token|secret|api.?key)|{_TITLED}|{_NAMED}"


def _one_of(names) -> str:
    return rf"^(?:{'|'.join(names)})$"


def _typed(raw: DataFrame) -> DataFrame:
    """``kind`` of each value ``raw``; null if it only looks like one."""
    kind = reduce(lambda other, k: F.when(F.col("raw").rlike(f"^(?:{k[1]})$"), F.lit(k[0])).otherwise(other), _KINDS[::-1], F.lit(None))
    digits = F.regexp_replace("raw", r"\D", "")
    valid = (F.col("kind") != "card") | _luhn_valid(digits)
    return raw.withColumn("kind", kind).withColumn("kind", F.when(valid, F.col("kind")))


def _luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a text of digits, from the right."""
    backwards = F.split(F.reverse(digits), "")

    def weigh(total, x):
        value = x["d"].cast("int") * (1 + x["i"] % 2)
        return total + F.when(value > 9, value - 9).otherwise(value)

    numbered = F.transform(F.filter(backwards, lambda c: c != ""), lambda c, i: F.struct(c.alias("d"), i.alias("i")))
    return F.aggregate(numbered, F.lit(0), weigh)


def _luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits) % 10 == 0


def _units(typed: DataFrame) -> DataFrame:
    """The parts of each value that get a surrogate: ``unit`` (what it is: the kind, for names
    with gender and script), ``canon`` (its one spelling) and ``place`` in the value."""
    raw, kind = F.col("raw"), F.col("kind")
    digits = F.regexp_replace(raw, r"\D", "")
    canon = (
        F.when(kind == "email", F.lower(raw))
        .when(kind.isin("ssn", "card"), digits)
        .when(kind == "phone", F.concat(F.when(raw.startswith("+"), F.lit("+")).otherwise(F.lit("")), digits))
        .when(kind == "secret", F.regexp_extract(raw, r"^.*?[=:]\s*[\"']?(.*)$", 1))
        .otherwise(raw)
    )
    plain = typed.where("kind is not null and kind <> 'person'").select("raw", "kind", kind.alias("unit"), canon.alias("canon"), F.lit(0).alias("place"))
    words = F.split(raw, " ")
    titled = words[0].rlike(_one_of([rf"{t}\.?" for g in _TITLES.values() for t in g]))
    title_gender = F.when(words[0].rlike(_one_of([rf"{t}\.?" for t in _TITLES["f"]])), F.lit("f")).otherwise(F.lit("m"))
    names = typed.where("kind = 'person'").select(
        "raw", "kind", F.when(titled, title_gender).alias("title_gender"), F.posexplode(words).alias("place", "canon"), F.size(words).alias("n")
    ).where("title_gender is null or place > 0")
    by_name = reduce(lambda other, g: F.when(F.col("canon").rlike(_one_of(_GIVEN[g])), F.lit(g)).otherwise(other), ("m", "f"), F.lit(None))
    given = by_name.isNotNull() | ((F.col("place") == 1) & (F.col("n") == 3) & F.col("title_gender").isNotNull())
    script = F.when(F.col("canon").rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    gender = F.when(given & (F.col("place") < F.col("n") - 1), F.coalesce(by_name, "title_gender")).otherwise(F.lit(""))
    people = names.select("raw", "kind", F.concat_ws(":", F.lit("name"), script, gender).alias("unit"), "canon", "place")
    return plain.unionByName(people)


# --- surrogates ----------------------------------------------------------------------------


def _draw(digest: Column, i: Column | int, below: Column | int) -> Column:
    """The i-th number of a digest, from 0 to ``below``."""
    place = (F.lit(i) if isinstance(i, int) else i) % 64 * 4 + 1
    return F.conv(F.substr(digest, place, F.lit(4)), 16, 10).cast("int") % below


def _scrambled(value: Column, digest: Column, symbols: str = "") -> Column:
    """Digits for digits, letters for letters of the same case (Cyrillic for Cyrillic, else Latin),
    all else as it is; lower-case hex for lower-case hex. A value that has neither digits nor
    letters gets some of ``symbols``, if given."""
    is_hex = value.rlike(r"^[0-9a-f]+$") & value.rlike(r"[a-f]")
    bare = ~value.rlike(r"[\p{L}\p{M}\p{N}]")

    def letter(alphabet: str, i: Column) -> Column:
        return F.substr(F.lit(alphabet), _draw(digest, i, len(alphabet)) + 1, F.lit(1))

    def other(c: Column, i: Column) -> Column:
        return (
            F.when(is_hex, letter("0123456789abcdef", i))
            .when(c.rlike("[0-9]"), letter("0123456789", i))
            .when(c.rlike("[A-Z]"), letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
            .when(c.rlike("[a-z]"), letter("abcdefghijklmnopqrstuvwxyz", i))
            .when(c.rlike(r"(?=\p{IsCyrillic})\p{Lu}"), letter(_CYRILLIC.upper(), i))
            .when(c.rlike(r"(?=\p{IsCyrillic})\p{L}"), letter(_CYRILLIC, i))
            .when(c.rlike(r"\p{N}"), letter("0123456789", i))
            .when(c.rlike(r"\p{Lu}"), letter("ABCDEFGHIJKLMNOPQRSTUVWXYZ", i))
            .when(c.rlike(r"[\p{L}\p{M}]"), letter("abcdefghijklmnopqrstuvwxyz", i))
            .when(bare, letter(symbols, i) if symbols else c)
            .otherwise(c)
        )

    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), other), "")


def _surrogate(key: str) -> Column:
    """The surrogate of ``canon`` at ``attempt``, by ``unit``.

    The first attempts keep the format. From ``_KEPT`` on, the format gets wider with every
    attempt (one more digit or letter; octets of any length, later more octets), so that a free
    surrogate always exists.
    """
    unit, canon, attempt = F.col("unit"), F.col("canon"), F.col("attempt")
    seed = F.concat_ws("\x1f", F.lit(key), unit, canon, attempt.cast("string"))
    digest = F.concat(F.sha2(F.concat(seed, F.lit("\x1f1")), 512), F.sha2(F.concat(seed, F.lit("\x1f2")), 512))
    host = F.regexp_extract(canon, r"@(.*)$", 1)
    top = F.when(host.rlike(r"\.(?:com|net|org)$"), F.regexp_extract(host, r"\.([a-z]+)$", 1)).otherwise(F.lit("com"))
    label = F.regexp_extract(host, r"^([^.]*)", 1)
    of_host = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("host"), host), 512)  # addresses at one host stay together
    wide = F.concat(F.sha2(F.concat(seed, F.lit("\x1f3")), 512), F.sha2(F.concat(seed, F.lit("\x1f4")), 512))

    def more(alphabet: str) -> Column:
        drawn = F.transform(
            F.sequence(F.lit(_KEPT), attempt),
            lambda i: F.substr(F.lit(alphabet), _draw(wide, i - _KEPT, len(alphabet)) + 1, F.lit(1)),
        )
        return F.when(attempt >= _KEPT, F.array_join(drawn, "")).otherwise(F.lit(""))

    email = F.concat(
        _scrambled(F.regexp_extract(canon, r"^([^@]*)", 1), digest), more(_LETTERS), F.lit("@"),
        _scrambled(label, F.concat(of_host, F.reverse(of_host))), F.lit(".example."), top,
    )

    def number(n: int, start: int) -> Column:
        return F.concat(*(_draw(digest, start + k, 10).cast("string") for k in range(n)))

    length = F.length(canon)
    # Ten digits: an area code and, in the first attempts, the exchange that is kept for fiction.
    ten = F.concat((_draw(digest, 0, 8) + 2).cast("string"), number(2, 1), F.when(attempt < 8, F.lit("555")).otherwise(number(3, 3)), number(4, 6))
    phone = F.when(length >= 11, F.concat(F.substr(canon, F.lit(1), length - 10), ten)).when(length == 10, ten).otherwise(_scrambled(canon, digest))
    body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), _scrambled(F.substr(canon, F.lit(2), length - 2), digest), more("0123456789"))
    check = (F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10
    octets = F.transform(
        F.split(canon, r"\."),
        lambda o, i: F.when(F.length(o) == 3, 100 + _draw(digest, i, 156)).when(F.length(o) == 2, 10 + _draw(digest, i, 90)).otherwise(1 + _draw(digest, i, 9)).cast("string"),
    )
    free_octets = F.transform(
        F.sequence(F.lit(0), 3 + F.floor((attempt - _KEPT) / 4).cast("int")), lambda i: _draw(digest, i, 256).cast("string")
    )
    chosen = (
        F.when(unit == "email", email)
        .when(unit == "phone", F.concat(phone, more("0123456789")))
        .when(unit == "card", F.concat(body, check.cast("string")))
        .when((unit == "ip") & (attempt >= _KEPT), F.array_join(free_octets, "."))
        .when(unit == "ip", F.array_join(octets, "."))
        .when(unit == "access", F.concat(F.substr(canon, F.lit(1), F.lit(4)), _scrambled(F.substr(canon, F.lit(5), length), digest), more(_LETTERS.upper())))
        .when(unit == "ssn", F.concat(_scrambled(canon, digest), more("0123456789")))
    )
    for (script, gender), ending in _ENDINGS.items():
        parts = F.array(*(F.lit(s) for s in _SYLLABLES[script]))
        # Two syllables and an ending, or three; one more for every four attempts.
        n = (2 if gender else 3) + F.floor(attempt / 4)
        name = F.array_join(F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.get(parts, _draw(digest, i, len(_SYLLABLES[script])))), "")
        chosen = chosen.when(unit == f"name:{script}:{gender}", F.initcap(F.concat(name, F.lit(ending))))
    return chosen.otherwise(F.concat(_scrambled(canon, digest, _SYMBOLS), more(_LETTERS)))


def surrogates(units: DataFrame, key: str, stored: Stored) -> DataFrame:
    """``unit``, ``canon`` and ``surrogate`` of every distinct pair of ``units``.

    The first draw of each value is checked: where a real value of the corpus is met, or another
    value has drawn the same (the one of the lower attempt, then of the smaller spelling, keeps
    it), the value draws again, until no collision is left; its format widens if it has too few
    surrogates (``_surrogate``). Names are compared across genders.
    """
    family = F.when(F.col("unit").startswith("name:"), F.lit("name")).otherwise(F.col("unit"))
    real = stored.write(units.select("unit", "canon").distinct().withColumn("family", family))
    current = stored.write(real.withColumn("attempt", F.lit(0)).withColumn("surrogate", _surrogate(key)))
    known = real.select("family", F.col("canon").alias("surrogate"), F.lit(True).alias("is_real")).distinct()
    while True:
        winners = current.groupBy("family", "surrogate").agg(F.min(F.struct("attempt", "canon", "unit")).alias("winner"))
        lost = (F.col("winner.canon") != F.col("canon")) | (F.col("winner.unit") != F.col("unit")) | F.coalesce("is_real", F.lit(False))
        judged = current.join(winners, ["family", "surrogate"]).join(known, ["family", "surrogate"], "left").withColumn("lost", lost)
        judged = stored.write(judged.select("unit", "canon", "family", "attempt", "surrogate", "lost"))
        stored.drop(current)
        if not judged.where("lost").limit(1).count():
            return judged.select("unit", "canon", "surrogate")
        again = judged.withColumn("attempt", F.col("attempt") + F.col("lost").cast("int"))
        current = stored.write(again.withColumn("surrogate", F.when(F.col("lost"), _surrogate(key)).otherwise(F.col("surrogate"))).drop("lost"))
        stored.drop(judged)


def _written(raw: Column, kind: Column, found: Column) -> Column:
    """The surrogates of the parts of ``raw``, written as it is: ``found`` is an array of
    (place, canon, surrogate) by place."""
    one = found[0]["surrogate"]
    digits = F.regexp_replace(one, r"\D", "")
    # One digit after another goes to the places of digits, those of a wider format to the end.
    filled = F.aggregate(
        F.filter(F.split(raw, ""), lambda c: c != ""),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("next")),
        lambda done, c: F.when(
            c.rlike("[0-9]"),
            F.struct(F.concat(done["text"], F.substr(digits, done["next"], F.lit(1))).alias("text"), (done["next"] + 1).alias("next")),
        ).otherwise(F.struct(F.concat(done["text"], c).alias("text"), done["next"].alias("next"))),
        lambda done: F.concat(done["text"], F.substr(digits, done["next"], F.length(digits))),
    )
    names = F.array_join(
        F.transform(
            F.split(raw, " "),
            lambda w, i: F.coalesce(F.get(F.filter(found, lambda x: x["place"] == i), F.lit(0))["surrogate"], w),
        ),
        " ",
    )
    return (
        F.when(kind.isin("phone", "ssn", "card"), filled)
        .when(kind == "person", names)
        .when(kind == "secret", F.concat(F.regexp_extract(raw, r"^(.*?[=:]\s*[\"']?)", 1), one))
        .when((kind == "email") & (raw == F.upper(raw)), F.upper(one))
        .otherwise(one)
    )


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) with personal data replaced.

    Returns ``doc_id``, ``text``, ``n_replaced`` and ``kinds``, the sorted types replaced. Found
    are mail addresses, phone, card (with a valid check digit) and social security numbers, IP
    addresses, access keys, values of passwords and tokens, and persons: a form of address or a
    known given name, then capitalised names. The parts of a person's name are replaced wherever
    they stand alone in the same text, too. Types, formats, scripts, the gender of given names
    and the validity of check digits are kept; mail addresses move to domains kept for examples.
    All else in a text stays as it is. A null text stays null. Rows with a null or repeated id
    stay. A format that has too few surrogates for its values gets wider. The same ``key`` over the same table gives the same surrogates, another key others.
    Without rows the result is empty.
    """
    stored = Stored(docs.sparkSession, "pii")
    text = F.col("text")
    read = docs.select("doc_id", "text")
    # Most texts hold nothing. They pass by; the others are stored with what was found in them.
    has = F.coalesce(text.rlike(_HINT) & text.rlike(_ANY), F.lit(False))
    found = stored.write(
        read.where(has).select("doc_id", "text", F.unhex(F.md5("text")).alias("text_key"), F.regexp_extract_all("text", F.lit(_ANY), F.lit(0)).alias("_raw"))
    )
    hits = found.select("text_key", "_raw").dropDuplicates(["text_key"])
    occurrences = stored.write(hits.select("text_key", F.posexplode("_raw").alias("pos", "raw")))
    units = stored.write(_units(_typed(occurrences.select("raw").distinct())))
    chosen = surrogates(units.select("unit", "canon"), key, stored)
    written = (
        units.join(chosen, ["unit", "canon"])
        .groupBy("raw", "kind")
        .agg(F.sort_array(F.collect_list(F.struct("place", "canon", "surrogate"))).alias("found"))
        .withColumn("written", _written(F.col("raw"), F.col("kind"), F.col("found")))
        .select("raw", "kind", "written", F.when(F.col("kind") == "person", F.col("found")).alias("names"))
    )
    per_text = (
        occurrences.join(stored.write(written), "raw", "left")
        .groupBy("text_key")
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", F.coalesce("written", "raw").alias("written")))).alias("written"),
            F.array_distinct(F.flatten(F.collect_list("names"))).alias("names"),
            F.sort_array(F.collect_set("kind")).alias("kinds"),
            F.count("kind").alias("n_replaced"),
        )
    )
    # By a shuffle at every size, whose sides are stored, so that a text with very many copies can
    # be split.
    joined = found.select("doc_id", "text", "text_key").join(stored.write(per_text).hint("merge"), "text_key")
    pieces = F.transform(F.split("text", _ANY, -1), lambda piece: _names_replaced(piece, F.col("names")))
    replaced = F.array_join(
        F.flatten(F.transform(pieces, lambda p, i: F.array(p, F.coalesce(F.get(F.col("written"), i)["written"], F.lit(""))))), ""
    )
    clean = read.where(~has).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_replaced"), F.array().cast("array<string>").alias("kinds")
    )
    return clean.unionByName(joined.select("doc_id", replaced.alias("text"), F.col("n_replaced").cast("long").alias("n_replaced"), "kinds"))


def _names_replaced(piece: Column, names: Column) -> Column:
    """``piece`` with the known names of its text replaced where they are whole words."""
    return F.aggregate(
        F.coalesce(names, F.array()),
        piece,
        lambda text, name: F.regexp_replace(
            text, F.concat(F.lit(r"(?<![\p{L}'’-])\Q"), name["canon"], F.lit(r"\E(?![\p{L}’-])")), name["surrogate"]
        ),
    )
