"""Format-preserving pseudonyms for personal data; DataFrame operations only.

Every value is a vector of small numbers, each below a radix of its own: the
digits and letters of a card, the octets of an address, the day of a date. A
Feistel network over the two halves of the vector permutes all vectors with the
same radices, so equal values get equal pseudonyms, different ones different
pseudonyms, and the pseudonym is a valid value of the same form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a candidate looks like, by kind, the first kind that fits counts.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9A-Za-z])",
    "date": r"(?<![0-9A-Za-z/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}[/.][0-9]{2}[/.][0-9]{4})(?![0-9A-Za-z/-])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9A-Za-z])"
    r"|(?<![0-9A-Za-z(+-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    "card": r"(?<![0-9A-Za-z.-])[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}(?:[ -]?[0-9]{1,7})(?![0-9A-Za-z])",
}
ANY = "|".join(PATTERNS.values())
#: A cheap look before the patterns: no value is without one of these characters.
HINT = "[0-9@]"
ROUNDS = 8
#: Dates from FIRST_DAY on for 400 years, 189 * 773 days, are permuted among themselves.
FIRST_DAY, DAY_RADICES = "1800-01-01", (189, 773)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _ints(chars: Column) -> Column:
    return F.transform(chars, lambda c: c.cast("int"))


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, modulo 10."""

    def part(c: Column, i: Column) -> Column:
        doubled = c.cast("int") * (i % 2 + 1)
        return F.floor(doubled / 10).cast("int") + doubled % 10

    return F.aggregate(F.transform(F.reverse(F.split(digits, "")), part), F.lit(0), lambda a, b: a + b) % 10


def _mod97(text: Column) -> Column:
    """Remainder of an account number's rearranged text, letters counting 10 to 35."""

    def step(rest: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        value = F.when(is_digit, c.cast("int")).otherwise(F.ascii(c) - 55)
        return (rest * F.when(is_digit, 10).otherwise(100) + value) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _turned(iban: Column) -> Column:
    return F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))


def _day(value: Column) -> Column:
    """The date meant, null if there is none: year first, else month first, else day first."""
    tail = F.substring(value, 7, 4)
    one, two = F.substring(value, 1, 2), F.substring(value, 4, 2)
    texts = [
        F.when(value.substr(5, 1) == "-", value),
        F.when(value.substr(5, 1) != "-", F.concat_ws("-", tail, one, two)),
        F.when(value.substr(5, 1) != "-", F.concat_ws("-", tail, two, one)),
    ]
    return F.coalesce(*[F.try_to_timestamp(t, F.lit("yyyy-MM-dd")).cast("date") for t in texts])


def _form(value: Column) -> Column:
    """How a date is written, as a pattern of its parts."""
    month_first = F.try_to_timestamp(
        F.concat_ws("-", F.substring(value, 7, 4), F.substring(value, 1, 2), F.substring(value, 4, 2)), F.lit("yyyy-MM-dd")
    ).isNotNull()
    return F.when(value.substr(5, 1) == "-", "%3$s-%1$s-%2$s").otherwise(
        F.concat(F.when(month_first, "%1$s").otherwise("%2$s"), value.substr(3, 1), F.when(month_first, "%2$s").otherwise("%1$s"), value.substr(6, 1), F.lit("%3$s"))
    )


def _kind(value: Column) -> Column:
    """The kind of a candidate that passes its kind's check, else null."""
    digits = _digits(value)
    octets = F.split(value, r"\.")
    valid = {
        "email": F.lit(True),
        "iban": _mod97(_turned(F.regexp_replace(value, " ", ""))) == 1,
        "ip": F.forall(octets, lambda o: (o.cast("int") <= 255) & (o.cast("int").cast("string") == o)),
        "date": F.coalesce(_day(value).between("1800-01-01", "2199-12-31"), F.lit(False)),
        "ssn": ~value.rlike("^(?:000|666|9)|-00-|-0000$"),
        "phone": F.length(digits).between(8, 15),
        "card": F.length(digits).between(13, 19) & (_luhn(digits) == 0),
    }
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(value.rlike(f"^(?:{pattern})$") & valid[kind], kind).otherwise(found)
    return found


def _free(kind: Column, chars: Column) -> Column:
    """Which characters of a text-like value change: not its punctuation, domain, prefix or check digits."""
    at = F.array_position(chars, "@")
    prefix = F.when(F.get(chars, F.lit(0)) == "+", F.size(F.split(F.regexp_extract(F.array_join(chars, ""), r"^\+[0-9]{1,3}?(?=[ .(-]|$)|^\+[0-9]", 0), ""))).otherwise(0)
    last = F.size(chars) - 1

    def free(c: Column, i: Column) -> Column:
        return c.rlike("[A-Za-z0-9]") & (
            F.when(kind == "email", i + 1 < at)
            .when(kind == "iban", i >= 4)
            .when(kind == "card", (i > 0) & (i < last))
            .otherwise(i >= prefix)
        )

    return F.transform(chars, free)


def _base(c: Column) -> Column:
    return F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97).otherwise(65)


def _vector(kind: Column, value: Column, chars: Column, free: Column) -> Column:
    """(values, radices) of a valid value."""
    moving = F.filter(F.arrays_zip(chars.alias("c"), free.alias("f")), lambda x: x["f"])
    letters = F.transform(moving, lambda x: F.struct(
        (F.ascii(x["c"]) - _base(x["c"])).alias("v"), F.when(x["c"].between("0", "9"), 10).otherwise(26).alias("radix")
    ))
    day = F.datediff(_day(value), F.lit(FIRST_DAY).cast("date"))
    area = F.substring(value, 1, 3).cast("int")
    parts = [(area - 1 - (area > 666).cast("int"), 898), (F.substring(value, 5, 2).cast("int") - 1, 99), (F.substring(value, 8, 4).cast("int") - 1, 9999)]

    def vector(pairs) -> Column:
        return F.array(*[F.struct(v.alias("v"), F.lit(r).alias("radix")) for v, r in pairs])

    return (
        F.when(kind == "ip", F.transform(F.split(value, r"\."), lambda o: F.struct(o.cast("int").alias("v"), F.lit(256).alias("radix"))))
        .when(kind == "date", vector([(F.floor(day / DAY_RADICES[1]).cast("int"), DAY_RADICES[0]), (day % DAY_RADICES[1], DAY_RADICES[1])]))
        .when(kind == "ssn", vector(parts))
        .otherwise(letters)
    )


def feistel(vector: Column, tweak: Column, key: str) -> Column:
    """The permuted numbers of a vector of (v, radix)."""
    half = F.floor(F.size(vector) / 2).cast("int")
    start = F.struct(
        F.slice(vector, F.lit(1), half).alias("l"), F.slice(vector, half + 1, F.size(vector) - half).alias("r")
    )

    def one(state: Column, turn: Column) -> Column:
        known = F.array_join(F.transform(state["r"], lambda x: x["v"].cast("string")), ",")
        noise = F.sha2(F.concat_ws("|", F.lit(key), tweak, turn.cast("string"), known), 256)

        def moved(stream: Column) -> Column:
            return F.transform(state["l"], lambda x, i: F.struct(
                ((x["v"] + F.conv(F.substr(stream, i % 16 * 4 + 1, F.lit(4)), 16, 10).cast("int")) % x["radix"]).alias("v"), x["radix"].alias("radix")
            ))

        return F.struct(state["r"].alias("l"), _let(noise, moved).alias("r"))

    turned = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, one)
    return F.transform(F.concat(turned["l"], turned["r"]), lambda x: x["v"])


def _written(kind: Column, value: Column, chars: Column, free: Column, new: Column) -> Column:
    """The pseudonym: the permuted numbers in the form of the value."""
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("i"))

    def put(done: Column, x: Column) -> Column:
        letter = F.char(_base(x["c"]) + F.get(new, done["i"]))
        return F.struct(
            F.concat(done["out"], F.when(x["f"], letter).otherwise(x["c"])).alias("out"),
            (done["i"] + x["f"].cast("int")).alias("i"),
        )

    text = F.aggregate(F.arrays_zip(chars.alias("c"), free.alias("f")), first, put)["out"]
    plain = F.regexp_replace(text, " ", "")
    check = F.lpad((98 - _mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0")
    without_last = F.substr(text, F.lit(1), F.length(text) - 1)
    luhn = ((10 - _luhn(F.concat(_digits(without_last), F.lit("0")))) % 10).cast("string")
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.get(new, F.lit(0)) * DAY_RADICES[1] + F.get(new, F.lit(1)))
    area = F.get(new, F.lit(0)) + 1
    ssn = F.format_string("%03d-%02d-%04d", area + (area >= 666).cast("int"), F.get(new, F.lit(1)) + 1, F.get(new, F.lit(2)) + 1)
    dated = F.replace(F.replace(F.replace(_form(value), F.lit("%1$s"), F.date_format(day, "MM")), F.lit("%2$s"), F.date_format(day, "dd")), F.lit("%3$s"), F.date_format(day, "yyyy"))
    return (
        F.when(kind == "ip", F.array_join(F.transform(new, lambda o: o.cast("string")), "."))
        .when(kind == "date", dated)
        .when(kind == "ssn", ssn)
        .when(kind == "iban", F.concat(F.substring(text, 1, 2), check, F.substr(text, F.lit(5))))
        .when(kind == "card", F.concat(without_last, luhn))
        .otherwise(text)
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """Texts with the personal data in them replaced by pseudonyms.

    Returns doc_id, text, found: the kinds of the replaced values in order.
    Kinds are mail addresses (the name before the @ changes), account numbers
    with right check digits, IPv4 addresses, calendar dates, social security
    numbers, telephone numbers (the country code stays) and card numbers with a
    right check digit. Numbers that fail their kind's check stay. The same value
    has the same pseudonym in every document and under every key another one; the
    separators of cards, accounts and telephones and the form of a date do not matter to it.

    A null text stays null and an empty one empty, with nothing found; repeated
    rows are treated alike; whole texts are read. Other columns are left out.
    """
    has = docs["text"].rlike(HINT)
    cut = docs.select(
        docs["doc_id"], docs["text"],
        F.when(has, F.split(docs["text"], ANY, -1)).alias("plain"),
        F.when(has, F.regexp_extract_all(docs["text"], F.lit(ANY), F.lit(0))).alias("values"),
    )

    def describe(v: Column) -> Column:
        chars = F.split(v, "")
        return _let(_kind(v), lambda kind: F.struct(kind.alias("kind"), v.alias("value"), chars.alias("chars"), _free(kind, chars).alias("free")))

    def permute(x: Column) -> Column:
        vector = _vector(x["kind"], x["value"], x["chars"], x["free"])
        new = _let(vector, lambda v: feistel(v, F.concat(x["kind"], F.size(v).cast("string")), key))
        return _let(new, lambda n: F.coalesce(_written(x["kind"], x["value"], x["chars"], x["free"], n), x["value"]))

    known = cut.withColumn("known", F.transform("values", describe))
    replaced = known.withColumn("new", F.transform("known", lambda x: F.when(x["kind"].isNull(), x["value"]).otherwise(permute(x))))
    joined = F.array_join(F.flatten(F.zip_with("plain", "new", lambda p, n: F.array(p, F.coalesce(n, F.lit(""))))), "")
    kinds = F.coalesce(F.filter(F.transform("known", lambda x: x["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return replaced.select("doc_id", F.when(F.size("values") > 0, joined).otherwise(F.col("text")).alias("text"), kinds.alias("found"))
