"""Surrogates for personal data, in DataFrame operations only.

Detected entities get keyed replacements of their own type: digits keep their
layout, a phone number its country code or leading 0, a card its first digit and (where the
original has one) a valid check digit, an address of a private network its
prefix, an e-mail the shape of its local part, a name its gender and script.

Coreference: the replacement depends on the key and on the entity's normal form
only, so one entity reads the same everywhere. Distinctness: the replacements of
all distinct entities are compared with each other and with the originals; an
entity that would collide draws again until none does. A format can be full (all
65,536 addresses of 192.168 in one corpus): after ``REDRAWS`` draws a
replacement leaves its range or grows by one character a draw, so drawing
always ends. Texts without entities are passed through and never shuffled.

Defined results: null and empty texts stay as they are; texts and entities may
be of any length (a chain of more labels than a host name can have is no
host); repeated rows give one row each; input columns stay, except that columns named like an output
(``n_entities``, ``kinds``) are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corridor.llm.storage import materialise

# Given names by script and gender, and syllables of surnames by script.
GIVEN = {
    ("latin", "f"): ("Anna", "Maria", "Laura", "Julia", "Sarah", "Emma", "Clara", "Alice", "Helen", "Mary", "Linda",
                     "Susan", "Karen", "Nancy", "Lucia", "Carmen", "Marie", "Sophie", "Claire", "Ingrid"),
    ("latin", "m"): ("John", "James", "Robert", "Michael", "David", "Thomas", "Peter", "Daniel", "Carlos", "Pedro",
                     "Jean", "Pierre", "Hans", "Karl", "Paul", "Mark", "George", "Frank", "Henry", "Luis"),
    ("cyrillic", "f"): ("Анна", "Мария", "Елена", "Ольга", "Наталья", "Ирина", "Татьяна", "Светлана"),
    ("cyrillic", "m"): ("Иван", "Пётр", "Сергей", "Алексей", "Дмитрий", "Николай", "Андрей", "Михаил"),
}
SYLLABLES = {
    "latin": ("Bar", "Cal", "Den", "Fal", "Gor", "Hal", "Kel", "Lor", "Mar", "Nor", "Pel", "Ros", "Sal", "Tor", "Vel", "Wen"),
    "cyrillic": ("Бар", "Вол", "Гор", "Дор", "Зар", "Кал", "Лес", "Мор", "Нов", "Пол", "Рог", "Сол", "Тур", "Чер", "Шил", "Яр"),
}
# The patterns of each kind, tried in this order. A group repeats a bounded number of times only (a host
# name has at most 127 labels): the regex engine recurses once per round, and its stack is an executor's.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_SEVEN_DIGITS = r"(?<=" + r"\d[ .()-]{0,2}" * 6 + r"\d)"     # a number with a country code has seven digits at least
_GROUP = r"(?:\d{2,4}|\d(?=[ .-]?\d{2}))"                   # one digit counts as an early group before a longer one
# National numbers with the trunk prefix 0: pairs (no more of them around), area and two groups, area and subscriber.
_TRUNK = (r"(?<!\w)(?<!\d[.+/-])(?:(?<!\d )0[1-9](?:[ .-]\d{2}){4}(?! \d{2}(?!\d))|0[1-9]\d{0,3}[ -]\d{3,4}[ -]\d{4}"
          r"|0[1-9]\d{2,3}[ -]\d{3}[ -]\d{3}|0[1-9]\d{1,3}[ /-]\d{6,8})(?!\w|[./-]\d)")
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?"
             r"(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?){0,126}\.[A-Za-z]{2,}",
    "ip": rf"(?<!\d)(?<!\d\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?|(?: ?[A-Z0-9]{4}){2} ?[A-Z0-9]{3})"
            r"(?![A-Za-z0-9])",
    "ssn": r"(?<!\d)(?<!\d-)\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    "card": r"(?<!\d)(?<!\d[.-])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|3[47]\d{2}[ -]\d{6}[ -]\d{5})(?!\d)",
    "phone": rf"(?<![\w+])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?{_GROUP}[ .-]?{_GROUP}(?:[ .-]?\d{{2,4}}){{0,3}}(?!\d)"
             + _SEVEN_DIGITS +
             r"|(?<!\w)(?:1[.-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)"
             r"|(?<!\w)(?<!\d[.+-])(?:1[.-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\w|-\d)|" + _TRUNK,
    "name": r"(?<!\p{L})(?=\p{Lu}\p{Ll}+ \p{Lu})(?:" + "|".join(n for ns in GIVEN.values() for n in ns)
            + r") \p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?(?!\p{L})",
}
KINDS = tuple(PATTERNS)
REDRAWS = 6                # draws within the original's own format, before a replacement may grow


ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = r"[0-9@]|" + PATTERNS["name"]


def _kind(raw: Column) -> Column:
    """Which pattern an entity matched: the first whose whole match it is."""
    out = F.lit(None).cast("string")
    for kind in reversed(KINDS):
        out = F.when(raw.rlike(f"^(?:{PATTERNS[kind]})$"), kind).otherwise(out)
    return out


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, r"[^0-9]", "")


def _normal(kind: Column, raw: Column) -> Column:
    """The form under which two mentions are one entity."""
    country = F.regexp_extract(raw, r"^\+(\d{1,3})(?=[ .(-])", 1)
    # The 1 of a North American and the 0 of a national number stand where a country code does.
    prefix = F.regexp_extract(raw, r"^(?:1(?=(?:[.-]\d|[.-]?\()\d{2,3}\)?[ .-]?\d{3}[ .-]\d{4}$)|0(?=[1-9]))", 0)
    code = F.when(raw.startswith("+") & (country == ""), F.substring(raw, 2, 1)).when(country == "", prefix).otherwise(country)
    phone = F.concat(code, F.lit("|"), _digits(raw).substr(F.length(code) + 1, F.lit(40)))
    return (F.when(kind == "email", F.lower(raw)).when(kind.isin("ip", "name"), raw)
            .when(kind == "iban", F.replace(raw, F.lit(" "), F.lit(""))).when(kind == "phone", phone).otherwise(_digits(raw)))


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts], F.lit(key)), 256)


def _byte(hexed: Column, i: Column | int) -> Column:
    """Byte ``i`` (taken modulo 32) of a hash, as an integer."""
    i = F.lit(i) if isinstance(i, int) else i
    return F.conv(hexed.substr(F.pmod(i, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(hexed: Column, i: int, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _byte(hexed, i) % len(values) + 1)


def _by_char(text: Column, change) -> Column:
    """``change(character, place)`` over a short string."""
    return F.array_join(F.transform(F.split(text, ""), change), "")


def _reshape(text: Column, hexed: Column, keep: int = 0) -> Column:
    """Letters become letters of the same case, digits digits; the first ``keep`` characters and the rest stay."""
    def change(c: Column, i: Column) -> Column:
        b = _byte(hexed, i)
        return (F.when(i < keep, c).when(c.rlike("[0-9]"), (b % 10).cast("string"))
                .when(c.rlike("[a-z]"), F.char(b % 26 + 97)).when(c.rlike("[A-Z]"), F.char(b % 26 + 65)).otherwise(c))
    return _by_char(text, change)


def _luhn(digits: Column, doubled_from_right: int) -> Column:
    """Check sum; the digit at the right end is place 0, places of the given parity are doubled."""
    ds = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    return F.aggregate(F.transform(ds, lambda c, i: F.when(
        i % 2 == doubled_from_right, F.element_at(F.array(*[F.lit(sum(divmod(2 * d, 10))) for d in range(10)]),
                                                  c.cast("int") + 1)).otherwise(c.cast("int"))),
        F.lit(0), lambda a, b: a + b)


def _surrogate(key: str, kind: Column, norm: Column, attempt: Column) -> Column:
    """Replacement of a normal form, itself a normal form."""
    h = _hash(key, kind, norm, attempt)
    over = F.greatest(attempt - REDRAWS, F.lit(0))
    extra = lambda n, piece: F.array_join(F.transform(
        F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.when(n > 0, piece(_byte(h, 31 - i))).otherwise("")), "")
    longer = extra(attempt, lambda b: F.char(b % 26 + 97))
    digits = extra(over, lambda b: (b % 10).cast("string"))
    local, domain = F.substring_index(norm, "@", 1), F.substring_index(norm, "@", -1)
    d = _hash(key, F.lit("domain"), domain)
    email = F.concat(_reshape(local, h), longer, F.lit("@"), *[F.char(_byte(d, i) % 26 + 97) for i in range(8)],
                     F.lit(".example."), F.when(domain.rlike(r"\.(org|edu|gov)$"), "org").otherwise("net"))
    private = F.regexp_extract(norm, r"^(10\.|127\.|192\.168\.|169\.254\.|172\.(?:1[6-9]|2\d|3[01])\.)", 1)
    private = F.when((private != "") & (over > 0), "10.").otherwise(private)
    missing = 4 - F.size(F.split(private, r"\.")) + 1
    octets = F.array_join(F.slice(F.array(*[(_byte(h, i) % 254 + 1).cast("string") for i in range(4)]), F.lit(1), missing), ".")
    public = F.concat(F.element_at(F.array(*[F.lit(str(x)) for x in (11, 23, 45, 62, 81, 93, 104, 130, 141, 155, 163, 178, 194, 203, 212, 217)]),
                                   _byte(h, 9) % 16 + 1), F.lit("."),
                      F.array_join(F.array(*[(_byte(h, i) % 254 + 1).cast("string") for i in range(3)]), "."))
    wide = F.array_join(F.array(*[(_byte(h, i) % n + 1).cast("string") for i, n in enumerate((223, 254, 254, 254))]), ".")
    # The last resort, where nearly all IPv4 addresses occur: an address of the IPv6 documentation range.
    six = F.concat(F.lit("2001:db8:"), F.array_join(F.array(*[F.substring(h, 4 * i + 1, 4) for i in range(6)]), ":"))
    ip = (F.when(over > 2 * REDRAWS, six).when((over > REDRAWS) | ((private == "") & (over > 0)), wide)
          .when(private != "", F.concat(private, octets)).otherwise(public))
    # A national number keeps its length and starts with 2..9, as area codes do.
    rest = F.substring_index(norm, "|", -1)
    phone = F.concat(F.substring_index(norm, "|", 1), F.lit("|"), (_byte(h, 30) % 8 + 2).cast("string"),
                     _reshape(F.substring(rest, 2, 40), h))
    body = F.concat(F.substring(norm, 1, 1), _reshape(norm.substr(F.lit(2), F.length(norm) - 2), h))
    check = F.pmod(F.lit(10) - _luhn(body, 0) % 10, F.lit(10))
    valid = _luhn(norm, 1) % 10 == 0
    card = F.concat(body, F.when(valid, check.cast("string")).otherwise(
        F.pmod(check + 1 + _byte(h, 28) % 9, F.lit(10))).cast("string"))
    iban = _reshape(norm, h, keep=2)
    given, cyrillic = F.substring_index(norm, " ", 1), norm.rlike(r"^\p{IsCyrillic}")
    female = given.isin(*GIVEN["latin", "f"], *GIVEN["cyrillic", "f"])
    first = (F.when(cyrillic & female, _pick(h, 0, GIVEN["cyrillic", "f"])).when(cyrillic, _pick(h, 0, GIVEN["cyrillic", "m"]))
             .when(female, _pick(h, 0, GIVEN["latin", "f"])).otherwise(_pick(h, 0, GIVEN["latin", "m"])))
    stem = lambda script, i: F.concat(_pick(h, i, SYLLABLES[script]), F.lower(_pick(h, i + 1, SYLLABLES[script])))
    ending = F.when(female, "ова").otherwise("ов")
    twin = lambda one, other: F.when(attempt > 1, F.concat(one, F.lit("-"), other)).otherwise(one)
    more = lambda script: extra(over, lambda b: F.lower(F.element_at(
        F.array(*map(F.lit, SYLLABLES[script])), b % len(SYLLABLES[script]) + 1)))
    surname = F.when(cyrillic, twin(F.concat(stem("cyrillic", 1), more("cyrillic"), ending), F.concat(stem("cyrillic", 3), ending))
                     ).otherwise(twin(F.concat(stem("latin", 1), more("latin"), F.lit("ton")), F.concat(stem("latin", 3), F.lit("ley"))))
    name = F.concat(first, F.lit(" "), surname)
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "name", name).otherwise(F.concat(
        F.when(kind == "phone", phone).when(kind == "card", card).when(kind == "iban", iban).otherwise(_reshape(norm, h)),
        digits)))


def _lay_out(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the layout of this mention: its characters take the places of the original's.

    What a grown surrogate has more than the original follows at the end.
    """
    flat = F.replace(surrogate, F.lit("|"), F.lit(""))
    fills = lambda cls: F.aggregate(
        F.split(raw, ""), F.struct(F.lit(0).alias("i"), F.lit("").alias("out")),
        lambda s, c: F.when(c.rlike(cls), F.struct(
            (s["i"] + 1).alias("i"), F.concat(s["out"], flat.substr(s["i"] + 1, F.lit(1))).alias("out"))
        ).otherwise(F.struct(s["i"].alias("i"), F.concat(s["out"], c).alias("out"))),
        lambda s: F.concat(s["out"], flat.substr(s["i"] + 1, F.length(flat))))
    return (F.when(kind.isin("email", "ip", "name"), surrogate).when(kind == "iban", fills("[A-Z0-9]"))
            .otherwise(fills("[0-9]")))


def entities(text: Column) -> Column:
    """Array of (kind, norm, raw) of a text's entities, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda raw: F.struct(
        _kind(raw).alias("kind"), _normal(_kind(raw), raw).alias("norm"), raw.alias("raw")))


def surrogate_table(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) for the distinct (kind, norm) of ``found``, without collisions."""
    originals = materialise(found.select("kind", "norm").distinct(), "entities")
    state = originals.withColumn("attempt", F.lit(0))
    while True:
        drawn = materialise(state.withColumn("surrogate", _surrogate(key, F.col("kind"), F.col("norm"), F.col("attempt"))),
                            "surrogates")
        # The entity that drew first keeps a surrogate; among equals the smallest form does.
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "norm")).alias("first"))
        taken = originals.select(F.col("kind").alias("k"), F.col("norm").alias("taken"))
        judged = (drawn.join(first, ["kind", "surrogate"])
                  .join(taken, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("taken")), "left")
                  .withColumn("loses", F.col("taken").isNotNull() | (F.struct("attempt", "norm") != F.col("first"))))
        if judged.where("loses").isEmpty():
            return drawn.select("kind", "norm", "surrogate")
        state = judged.select("kind", "norm", (F.col("attempt") + F.col("loses").cast("int")).alias("attempt"))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", told: tuple[str, str] = ("n_entities", "kinds")) -> DataFrame:
    """``docs`` with surrogates in ``text``, plus two columns: the number of entities and the distinct kinds replaced.

    ``told`` names the two; columns of ``docs`` with these names are left out.
    """
    n_entities, kinds = told
    docs = docs.drop(*told)
    columns = docs.columns
    body = F.col(f"`{text}`")
    # rlike on the hint is a cheap first test; the full pattern only runs where it holds.
    has = F.coalesce(body.rlike(HINT) & body.rlike(ANY), F.lit(False))
    rows = docs.where(has).select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
                                  body.alias("body"), F.monotonically_increasing_id().alias("row_no"))
    rows = materialise(rows.select("row", "row_no", entities(F.col("body")).alias("found")), "with-entities")
    each = rows.select("row_no", F.posexplode("found").alias("place", "e")).select("row_no", "place", "e.*")
    table = surrogate_table(each, key)
    placed = each.join(table, ["kind", "norm"]).select(
        "row_no", "place", "kind", _lay_out(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new"))
    per_row = placed.groupBy("row_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "new"))), lambda x: x["new"]).alias("news"),
        F.array_sort(F.collect_set("kind")).alias("kinds"))
    plain = F.split(F.col(f"row.`{text}`"), ANY, -1)
    woven = F.array_join(F.transform(F.arrays_zip(plain.alias("p"), F.concat(F.col("news"), F.array(F.lit(""))).alias("n")),
                                     lambda x: F.concat(x["p"], x["n"])), "")
    changed = rows.join(per_row, "row_no").select(
        *[(woven if c == text else F.col(f"row.`{c}`")).alias(c) for c in columns],
        F.size("found").cast("long").alias(n_entities), F.col("kinds").alias(kinds))
    same = docs.where(~has).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias(n_entities),
                                   F.array().cast("array<string>").alias(kinds))
    return same.unionByName(changed)
