"""Personal data replaced by surrogates, in DataFrame functions only.

Detected entities get keyed replacements of their own type and format: digits for
digits, letters for letters, names of the same script and of the gender that the
title tells. One table holds every distinct entity of the corpus; surrogates that
meet each other or a real value are drawn again, so different entities stay
different and one entity is the same wherever it stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinloom.llm.common import fresh_name, remove, written

MOST_DRAWS = 100
FORMAT_DRAWS = 4  # draws in the value's own format; later ones have a keyed tail besides

# Titles before names by gender, syllables and endings of surrogate names by script.
_TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "госпожа", "г-жа"],
    "m": ["Mr", "Herr", "Señor", "Sr", "Monsieur", "господин", "г-н"],
    "n": ["Dr", "Prof", "доктор"],
}
_SYLLABLES = {
    "latin": "ba be bi bo da de do fa ga ka ke la le li lo ma me mi na ne ni no pa ra re ro sa se ta te va vi".split(),
    "cyrillic": "ба бе би бо да де до фа га ка ке ла ле ли ло ма ме ми на не ни но па ра ре ро са се та те ва ви".split(),
    "greek": "βα βε βι βο δα δε δο φα γα κα κε λα λε λι λο μα με μι να νε νι νο πα ρα ρε ρο σα σε τα τε ζα ζι".split(),
    "armenian": "բա բե բի բո դա դե դո ֆա գա կա կե լա լե լի լո մա մե մի նա նե նի նո պա րա րե րո սա սե տա տե վա վի".split(),
}
_ENDINGS = {
    "latin": {"f": "na", "m": "ron", "n": "rin", "s": "stel"},
    "cyrillic": {"f": "на", "m": "рон", "n": "рин", "s": "стел"},
    "greek": {"f": "να", "m": "ρον", "n": "ριν", "s": "στελ"},
    "armenian": {"f": "նա", "m": "րոն", "n": "րին", "s": "ստել"},
}
# Names of any other script are made of their own letters, which keeps the script.

_TITLE = "(?:" + "|".join(t for titles in _TITLES.values() for t in titles) + ")"
_NOT_IN_WORD = r"(?<![\p{L}\d])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# In this order; the first that fits at a place counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": _NOT_IN_WORD + r"(?:AKIA[0-9A-Z]{16}|gh[a-z]_[0-9A-Za-z]{20,}|sk-[0-9A-Za-z_-]{16,})"
    r"|(?i:(?<![a-z])(?:password|passwd|pwd|secret|token|api[_-]?key) ?[=:] ?[\"']?)[^\s,;\"']{6,}",
    "iban": _NOT_IN_WORD + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "ip": r"(?<![\p{L}\d.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\.?\d)",
    "card": _NOT_IN_WORD + r"(?:(?:\d{4}[ -]){3}\d{4}|[3-6]\d{12,18})(?![\p{L}\d])",
    "ssn": r"(?<![\p{L}\d-])\d{3}-\d{2}-\d{4}(?![\p{L}\d-])",
    # Seven to fifteen digits behind a plus; else groups of a country's own writing.
    "phone": r"(?<![\p{L}\d.+])(?:\+\d(?:(?:[ .-]?\(|\)?[ ./-]|\))?\d){6,14}(?![\p{L}\d])|(?:\d[ -]?)?\(\d{2,5}\)[ .-]?\d{2,4}(?:[ .-]\d{2,4}){1,3}"
    r"|0\d(?:(?: \d\d){4}|(?:\.\d\d){4}|(?:-\d\d){4})|0\d{2,4}[ /-]\d{5,8}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}"
    r"|\+\d{1,3}(?:[ .-]\d{2,4}){2,4}|\+\d{7,15})(?![\p{L}\d])",
    "name": r"(?<![\p{L}\d-])" + _TITLE + r"\.? \p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)?(?![\p{L}\d])",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _type_of(match: Column) -> Column:
    kind = F.lit("name")
    for name in reversed([n for n in PATTERNS if n != "name"]):
        # Look-behinds see nothing before a match that stands alone, as they did in its text.
        kind = F.when(match.rlike(f"^(?:{PATTERNS[name]})$"), F.lit(name)).otherwise(kind)
    return kind


def _parts(match: Column) -> Column:
    """(kind, value) of what a match is made of: the words of a name, else the match whole."""
    title = F.regexp_extract(match, f"^{_TITLE}", 0)
    gender = F.lit("n")
    for sex in ("f", "m"):
        gender = F.when(title.isin(_TITLES[sex]), F.lit(sex)).otherwise(gender)
    names = F.split(F.regexp_replace(match, rf"^{_TITLE}\.? ", ""), " ")

    def name(word: Column, place: Column) -> Column:
        script = F.lit("other")
        for known in _SYLLABLES:
            script = F.when(word.rlike(rf"^\p{{Is{known.capitalize()}}}"), F.lit(known)).otherwise(script)
        # A name alone may be a first or a last name: "l" until the corpus tells.
        role = F.when(F.size(names) == 1, F.concat(F.lit("l"), gender))
        role = role.when(place == F.size(names) - 1, F.lit("s")).otherwise(gender)
        return F.struct(F.concat(F.lit("name:"), script, F.lit(":"), role).alias("kind"), word.alias("value"))

    kind = _type_of(match)
    return F.when(kind == "name", F.transform(names, name)).otherwise(
        F.array(F.struct(kind.alias("kind"), match.alias("value")))
    )


def _numbers(seed: Column, count: Column) -> Column:
    """Hex digits drawn from the seed, at least two for each of ``count`` characters."""
    return F.array_join(F.transform(F.sequence(F.lit(0), F.floor(count / 32).cast("int")), lambda b: F.sha2(F.concat(seed, F.lit("|"), b.cast("string")), 256)), "")


def _drawn(numbers: Column, place: Column, alphabet: str) -> Column:
    value = F.conv(F.substr(numbers, place * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return F.substr(F.lit(alphabet), value % len(alphabet) + 1, F.lit(1))


_SMALL = "abcdefghijklmnopqrstuvwxyz"


def _scrambled(value: Column, seed: Column, small: str = _SMALL) -> Column:
    """Every ASCII digit and letter another one of its class; all else stays."""
    numbers = _numbers(seed, F.char_length(value))

    def drawn(c: Column, i: Column) -> Column:
        return (
            F.when(c.between("0", "9"), _drawn(numbers, i, "0123456789"))
            .when(c.between("a", "z"), _drawn(numbers, i, small))
            .when(c.between("A", "Z"), _drawn(numbers, i, _SMALL.upper()))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), drawn), "")


def _check_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits, counted from its end."""
    places = F.transform(
        F.reverse(F.split(digits, "")),
        lambda c, i: F.when(i % 2 == 1, F.floor(c.cast("int") * 2 / 10).cast("int") + c.cast("int") * 2 % 10).otherwise(c.cast("int")),
    )
    return F.aggregate(places, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0)))


def _syllables(seed: Column, draw: Column, choices: list[str]) -> Column:
    """Three syllables, and one more with every third draw, so there are always names left."""
    count = F.lit(3) + F.floor(draw / 3).cast("int")
    numbers = _numbers(seed, count)
    syllables = F.array(*[F.lit(c) for c in choices])

    def chosen(i: Column) -> Column:
        return F.element_at(syllables, F.conv(F.substr(numbers, i * 2 + 1, F.lit(2)), 16, 10).cast("int") % len(choices) + 1)

    return F.array_join(F.transform(F.sequence(F.lit(0), count - 1), chosen), "")


def _surrogate(kind: Column, value: Column, key: str, draw: Column) -> Column:
    seed = F.concat(F.lit(key + "|"), kind, F.lit("|"), value, F.lit("|"), draw.cast("string"))
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    ending = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
    host = domain.substr(F.lit(1), F.char_length(domain) - F.char_length(ending))
    # One domain has one replacement, whoever writes from it.
    email = F.concat(
        _scrambled(local, seed), F.lit("@"), _scrambled(host, F.concat(F.lit(key + "|domain|"), domain)), ending
    )
    head = F.regexp_extract(value, r"^(?:AKIA|gh[a-z]_|sk-|[A-Za-z_-]+ ?[=:] ?[\"']?)", 0)
    tail = value.substr(F.char_length(head) + 1, F.char_length(value))
    hexadecimal = tail.rlike("^[0-9a-f]+$")
    # Scrambling changes ASCII only; a tail without it, or with other letters, goes whole.
    plain = tail.rlike("[0-9A-Za-z]") & ~tail.rlike(r"[^\x00-\x7f]")
    fresh = F.substring(F.sha2(seed, 256), 1, 16)
    secret = F.concat(
        head,
        F.when(~plain | (draw >= FORMAT_DRAWS), fresh)
        .when(hexadecimal, _scrambled(tail, seed, "abcdef"))
        .otherwise(_scrambled(tail, seed)),
    )
    octets = _numbers(seed, F.lit(4))

    def octet(place: int, low: int, size: int) -> Column:
        return (F.conv(F.substring(octets, place * 4 + 1, 4), 16, 10).cast("int") % size + low).cast("string")

    ip = F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254))
    digits = F.regexp_replace(value, r"[^\d]", "")
    drawn = F.concat(F.substring(value, 1, 1), _scrambled(F.substr(value, F.lit(2), F.char_length(value)), seed))
    body = F.substr(drawn, F.lit(1), F.char_length(drawn) - 1)
    last = (10 - _check_sum(F.concat(F.regexp_replace(body, r"[^\d]", ""), F.lit("0"))) % 10) % 10
    card = F.when(_check_sum(digits) % 10 == 0, F.concat(body, last.cast("string"))).otherwise(drawn)
    code = F.regexp_extract(value, r"^\+\d{1,3}(?=[ .(-])", 0)
    phone = F.concat(code, _scrambled(value.substr(F.char_length(code) + 1, F.char_length(value)), seed))
    iban = F.concat(F.substring(value, 1, 2), _scrambled(value.substr(F.lit(3), F.char_length(value)), seed))
    # A format without (enough) other values gets longer, or another one of its type.
    more = F.lpad(F.conv(F.substring(fresh, 1, 15), 16, 10), 19, "0")
    late = draw >= FORMAT_DRAWS
    email = F.when(late, F.concat(F.substring_index(email, "@", 1), fresh, F.lit("@"), F.substring_index(email, "@", -1))).otherwise(email)
    ip = F.when(late, F.concat(F.lit("2001:db8"), *[F.concat(F.lit(":"), F.substring(fresh, 4 * i + 1, 4)) for i in range(4)], F.lit("::"))).otherwise(ip)
    card, phone, iban = (F.when(late, F.concat(x, more)).otherwise(x) for x in (card, phone, iban))
    other = F.when(late, F.concat(_scrambled(value, seed), F.lit("-"), more)).otherwise(_scrambled(value, seed))
    result = F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "ip", ip)
    result = result.when(kind == "card", card).when(kind == "phone", phone).when(kind == "iban", iban)
    for script, syllables in _SYLLABLES.items():
        made = _syllables(seed, draw, syllables)
        for role, tail in _ENDINGS[script].items():
            result = result.when(kind == f"name:{script}:{role}", F.initcap(F.concat(made, F.lit(tail))))
    letters = F.split(F.lower(value), "")
    numbers = _numbers(seed, F.lit(6) + draw)
    own = F.transform(
        F.sequence(F.lit(0), F.lit(5) + draw),
        lambda i: F.element_at(letters, F.conv(F.substr(numbers, i * 2 + 1, F.lit(2)), 16, 10).cast("int") % F.size(letters) + 1),
    )
    result = result.when(kind.startswith("name:other:"), F.initcap(F.array_join(own, "")))
    return result.otherwise(other)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of distinct entities (kind, value), all surrogates of a kind different.

    No surrogate is a value of its kind. Who collides is drawn again, later draws after
    earlier ones and then by value, until nobody does. After ``FORMAT_DRAWS`` draws a
    surrogate gets longer than its value, so a format with too few values never runs out.
    """
    current = written(entities.withColumn("draw", F.lit(0)))
    real = current.select("kind", F.col("value").alias("surrogate")).withColumn("real", F.lit(True))
    for _ in range(MOST_DRAWS):
        drawn = current.withColumn("surrogate", _surrogate(F.col("kind"), F.col("value"), key, F.col("draw")))
        place = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("draw", "value"))
        checked = written(
            drawn.join(real, ["kind", "surrogate"], "left")
            .select("kind", "value", "draw", "surrogate", ((place > 1) | F.col("real").isNotNull()).alias("again"))
        )
        if checked.where("again").isEmpty():
            return checked.select("kind", "value", "surrogate")
        following = written(checked.select("kind", "value", (F.col("draw") + F.col("again").cast("int")).alias("draw")))
        remove(checked)
        current = following
    raise ValueError(f"surrogates still meet after {MOST_DRAWS} draws")


def _entities(held: DataFrame, key: str) -> DataFrame:
    """(kind, value, surrogate) of the kinds and values in ``held``; a lone name shares that of the same full name.

    It is a last name if any document has it as the last of two, else a first name.
    """
    distinct = written(held.select("kind", "value").distinct())
    lone = F.col("kind").rlike("^name:.*:l.$")
    stem = F.regexp_replace("kind", "l?.$", "")
    last = distinct.where(F.col("kind").rlike("^name:.*:s$")).select(stem.alias("stem"), "value", F.lit(True).alias("last"))
    told = distinct.where(lone).withColumn("stem", stem).join(last, ["stem", "value"], "left").select(
        "kind", "value", F.concat("stem", F.when(F.col("last"), "s").otherwise(F.substring("kind", -1, 1))).alias("as")
    )
    told = written(distinct.where(~lone).select("kind", "value", F.col("kind").alias("as")).union(told))
    table = surrogates(told.select(F.col("as").alias("kind"), "value").distinct(), key)
    return told.join(table.select(F.col("kind").alias("as"), "value", "surrogate"), ["as", "value"]).select("kind", "value", "surrogate")


def replaced(documents: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """``documents`` with the entities of ``text`` replaced, and in column ``count`` how many.

    A name found behind a title is replaced in all its document, also without one.

    Rows without an entity stay untouched and never leave their partition. Null texts
    stay null with no entities; repeated rows get the same text; other columns are kept
    whatever their names. An empty table gives no rows.
    """
    columns = documents.columns
    rest = [F.col(f"`{c}`") for c in columns]
    tally = [] if count is None else [F.lit(0).cast("long").alias(count)]
    hits, row = fresh_name(documents, "__matches"), fresh_name(documents, "__row")
    found = F.coalesce(F.col("text").rlike(_ANY), F.lit(False))
    clean = documents.where(~found).select(*rest, *tally)
    marked = written(
        documents.where(found)
        .withColumn(hits, F.transform(F.regexp_extract_all("text", F.lit(_ANY), 0), lambda m: F.struct(m.alias("match"), _parts(m).alias("parts"))))
        .withColumn(row, F.monotonically_increasing_id())
    )
    held = marked.select(F.col(row).alias("row"), F.explode(F.array_distinct(F.flatten(F.col(f"`{hits}`.parts")))).alias("part")).select("row", "part.*")
    table = written(_entities(held, key))
    pairs = F.array_sort(F.collect_list(F.struct("value", "kind", "surrogate")))
    maps = held.join(table, ["kind", "value"]).groupBy("row").agg(pairs.alias("pairs"))
    names = F.filter("pairs", lambda p: p["kind"].startswith("name:"))
    maps = maps.select(
        F.col("row").alias(row),
        F.map_from_entries(F.transform("pairs", lambda p: F.struct(F.concat(p["kind"], F.lit("|"), p["value"]), p["surrogate"]))).alias(row + "t"),
        names.alias("names"),
    ).select(
        row, row + "t",
        F.map_from_entries(F.transform(
            F.filter("names", lambda p, i: (i == 0) | (F.get("names", i - 1)["value"] != p["value"])),
            lambda p: F.struct(p["value"], p["surrogate"]),
        )).alias(row + "b"),
    )
    joined = marked.join(maps, row)
    bare, cut = F.col(row + "b"), r"(?<=[\p{L}\d])(?![\p{L}\d])|(?<![\p{L}\d])(?=[\p{L}\d])"

    def new(match: Column) -> Column:
        head = F.regexp_extract(match["match"], rf"^{_TITLE}\.? ", 0)
        said = F.array_join(
            F.transform(match["parts"], lambda p: F.element_at(F.col(row + "t"), F.concat(p["kind"], F.lit("|"), p["value"]))), " "
        )
        return F.when(match["parts"][0]["kind"].startswith("name:"), F.concat(head, said)).otherwise(said)

    def again(piece: Column) -> Column:
        return F.array_join(F.transform(F.split(piece, cut, -1), lambda w: F.coalesce(F.element_at(bare, w), w)), "")

    # The names of a document are replaced without a title too.
    between = F.split("text", _ANY, -1)
    rest_of = F.when(F.size(bare) > 0, F.transform(between, again)).otherwise(between)
    joined = joined.withColumn(row + "r", rest_of)
    text = F.array_join(
        F.transform(row + "r", lambda piece, i: F.concat(piece, F.when(i < F.size(hits), new(F.get(hits, i))).otherwise(""))), ""
    )
    repeats = F.aggregate(
        between, F.lit(0), lambda n, piece: n + F.size(F.filter(F.split(piece, cut, -1), lambda w: F.element_at(bare, w).isNotNull()))
    )
    repeats = F.when(F.size(bare) > 0, repeats).otherwise(0)
    tally = [] if count is None else [(F.size(hits) + repeats).cast("long").alias(count)]
    return clean.union(joined.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in columns], *tally))
