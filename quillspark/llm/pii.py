"""Personal data: validated numbers, dates and addresses become keyed pseudonyms of the same format.

Each kind has a Feistel network over exactly its valid values, so a pseudonym is valid too, two values never share
one, equal values stay linked in all documents, and the owner of the key can undo it. All is DataFrame functions:
a text is split at the matches, the matches are mapped, and both are joined again.

Kinds: payment cards (13 to 19 digits, Luhn), IBANs (mod 97, in one piece or groups of four), US social security numbers, North American phone
numbers, IPv4 addresses, dates (ISO, day first with points, month first with slashes) and e-mail local parts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: For queries and tests on public tables only; real data needs a key of its own.
KEY = "quill-demo-key"
ROUNDS = 8
#: Java patterns; of two that match at one place the first holds. None can match inside a longer run of its own characters.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){0,7}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
PHONE = r"(?<![0-9+])(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
DATE = r"(?<![0-9./-])(?:1[89]|20|21)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<![0-9./])[0-9]{2}(?<by>[./])[0-9]{2}\k<by>(?:1[89]|20|21)[0-9]{2}(?![0-9/]|\.[0-9])"
CARD = (
    r"(?<![0-9A-Za-z])(?<![0-9][.,])(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z])"
)
ANY = "|".join((EMAIL, IBAN, IP, SSN, PHONE, DATE, CARD))


def keyed(kind: str, key: str, round_: int, part: Column) -> Column:
    """64 hexadecimal digits that depend on the key, the kind, the round and the part."""
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|{round_}|"), part.cast("string")), 256)


def number_of(hexadecimal: Column, modulus: Column | int) -> Column:
    return F.conv(F.substring(hexadecimal, 1, 15), 16, 10).cast("bigint") % modulus


def feistel_number(value: Column, a: int, b: int, kind: str, key: str) -> Column:
    """A permutation of 0 .. a * b - 1: rounds add a keyed function of one part to the other, modulo its own size."""
    def step(i: int) -> Callable[[Column], Column]:
        if i % 2 == 0:
            return lambda p: F.struct(((p["l"] + number_of(keyed(kind, key, i, p["r"]), a)) % a).alias("l"), p["r"].alias("r"))
        return lambda p: F.struct(p["l"].alias("l"), ((p["r"] + number_of(keyed(kind, key, i, p["l"]), b)) % b).alias("r"))

    state = F.array(F.struct(F.floor(value / F.lit(b)).cast("bigint").alias("l"), (value % b).alias("r")))
    for i in range(ROUNDS):  # a transform of one element works its input out once
        state = F.transform(state, step(i))
    return F.get(F.transform(state, lambda p: p["l"] * b + p["r"]), F.lit(0))


def shifted(part: Column, stream: Column) -> Column:
    """Each digit or letter of part moved within its own class by a byte of the stream; other characters stay."""

    def moved(c: Column, i: Column) -> Column:
        by = F.conv(F.substring(stream, (i % 32) * 2 + 1, 2), 16, 10).cast("int")
        code = F.ascii(c)

        def within(low: int, high: int) -> Column:
            return F.char((code - low + by) % (high - low + 1) + low)

        return (
            F.when(code.between(48, 57), within(48, 57)).when(code.between(65, 90), within(65, 90)).when(code.between(97, 122), within(97, 122)).otherwise(c)
        )

    return F.array_join(F.transform(F.split(part, ""), moved), "")


def feistel_text(value: Column, kind: str, key: str) -> Column:
    """A permutation of the texts with the same classes of characters at the same places: halves take turns."""
    half = F.floor(F.length(value) / 2).cast("int")
    state = F.array(F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.length(value)).alias("r")))

    def step(i: int) -> Callable[[Column], Column]:
        if i % 2 == 0:
            return lambda p: F.struct(shifted(p["l"], keyed(kind, key, i, p["r"])).alias("l"), p["r"].alias("r"))
        return lambda p: F.struct(p["l"].alias("l"), shifted(p["r"], keyed(kind, key, i, p["l"])).alias("r"))

    for i in range(ROUNDS):
        state = F.transform(state, step(i))
    return F.get(F.transform(state, lambda p: F.concat(p["l"], p["r"])), F.lit(0))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refilled(shape: Column, filling: Column) -> Column:
    """shape with its digits replaced, in order, by those of filling."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(
        F.split(shape, ""), start,
        lambda s, c: F.when(
            c.rlike("[0-9]"), F.struct(F.concat(s["out"], F.substring(filling, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))
        ).otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: s["out"],
    )


def luhn_sum(number: Column) -> Column:
    """Luhn sum of a number to which a check digit is still to be appended."""
    return F.aggregate(
        F.transform(
            F.split(F.reverse(number), ""),
            lambda c, i: F.when(i % 2 == 0, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")),
        ),
        F.lit(0), lambda s, x: s + x,
    )


def check_digit(body: Column) -> Column:
    return ((10 - luhn_sum(body) % 10) % 10).cast("string")


def is_card(value: Column) -> Column:
    return bound(digits(value), lambda d: F.right(d, F.lit(1)) == check_digit(F.substring(d, F.lit(1), F.length(d) - 1)))


def card(value: Column, key: str) -> Column:
    def of(d: Column) -> Column:
        return bound(feistel_text(F.substring(d, F.lit(1), F.length(d) - 1), "card", key), lambda body: refilled(value, F.concat(body, check_digit(body))))

    return bound(digits(value), of)


def mod97(text: Column) -> Column:
    """Letters count as 10 to 35."""
    return F.aggregate(
        F.split(text, ""), F.lit(0),
        lambda s, c: F.when(F.ascii(c) >= 65, (s * 100 + F.ascii(c) - 55) % 97).otherwise((s * 10 + F.ascii(c) - 48) % 97),
    )


def is_iban(value: Column) -> Column:
    whole = F.replace(value, F.lit(" "), F.lit(""))
    return mod97(F.concat(F.substring(whole, F.lit(5), F.length(whole)), F.substring(whole, 1, 4))) == 1


def iban(value: Column, key: str) -> Column:
    """Printed in groups of four if it was."""
    whole = F.replace(value, F.lit(" "), F.lit(""))
    country = F.substring(whole, 1, 2)
    out = bound(
        feistel_text(F.substring(whole, F.lit(5), F.length(whole)), "iban", key),
        lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b),
    )
    return F.when(F.contains(value, F.lit(" ")), F.regexp_replace(out, "(.{4})(?=.)", "$1 ")).otherwise(out)


def ip(value: Column, key: str) -> Column:
    o = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    number = F.aggregate(o, F.lit(0).cast("bigint"), lambda s, x: s * 256 + x)
    return bound(
        feistel_number(number, 1 << 16, 1 << 16, "ip", key),
        lambda n: F.concat_ws(".", *[(F.floor(n / F.lit(1 << s)) % 256).cast("string") for s in (24, 16, 8, 0)]),
    )


def ssn(value: Column, key: str) -> Column:
    area, rest = F.substring(value, 1, 3).cast("bigint"), F.substring(value, 5, 2).cast("bigint") - 1
    area = F.when(area > 666, area - 2).otherwise(area - 1)
    number = (area * 99 + rest) * 9999 + F.substring(value, 8, 4).cast("bigint") - 1

    def shaped(n: Column) -> Column:
        a = F.floor(n / F.lit(99 * 9999)).cast("bigint")
        a = F.when(a >= 665, a + 2).otherwise(a + 1)
        g = F.floor(n / F.lit(9999)).cast("bigint") % 99 + 1
        return F.concat_ws("-", *[F.lpad(x.cast("string"), w, "0") for x, w in ((a, 3), (g, 2), (n % 9999 + 1, 4))])

    return bound(feistel_number(number, 898, 99 * 9999, "ssn", key), shaped)


def is_phone(value: Column) -> Column:
    """Area and exchange codes begin with 2 to 9."""
    return F.right(digits(value), F.lit(10)).rlike("^[2-9][0-9]{2}[2-9]")


def phone(value: Column, key: str) -> Column:
    """The ten digits of the national number, among those with valid codes; a country code in front stays."""
    d = F.right(digits(value), F.lit(10))
    # 800 area codes and a hundred of the exchange on the left, the rest of the exchange and the line on the right: 80000 each
    number = ((d.substr(1, 3).cast("bigint") - 200) * 800 + d.substr(4, 3).cast("bigint") - 200) * 10000 + d.substr(7, 4).cast("bigint")

    def shaped(n: Column) -> Column:
        codes = F.floor(n / F.lit(10000)).cast("bigint")
        return F.concat((F.floor(codes / F.lit(800)) + 200).cast("string"), (codes % 800 + 200).cast("string"), F.lpad((n % 10000).cast("string"), 4, "0"))

    out = bound(feistel_number(number, 80_000, 80_000, "phone", key), shaped)
    return F.concat(F.when(value.startswith("+1"), F.lit("+1")).otherwise(F.lit("")), bound(out, lambda o: refilled(F.regexp_replace(value, r"^\+1", ""), o)))


#: 400 years of the Gregorian calendar, 1800 to 2199, have 189 * 773 days.
FIRST_DAY, DAY_SIZES = "1800-01-01", (189, 773)


def parsed_date(value: Column) -> Column:
    iso = F.when(value.substr(5, 1) == "-", value)
    point = F.when(value.substr(3, 1) == ".", F.concat_ws("-", value.substr(7, 4), value.substr(4, 2), value.substr(1, 2)))
    slash = F.when(value.substr(3, 1) == "/", F.concat_ws("-", value.substr(7, 4), value.substr(1, 2), value.substr(4, 2)))
    return F.coalesce(iso, point, slash).try_cast("date")


def date(value: Column, key: str) -> Column:
    number = F.datediff(parsed_date(value), F.to_date(F.lit(FIRST_DAY))).cast("bigint")

    def shaped(n: Column) -> Column:
        day = F.date_add(F.to_date(F.lit(FIRST_DAY)), n.cast("int"))
        kind = F.when(value.substr(5, 1) == "-", F.date_format(day, "yyyy-MM-dd")).when(value.substr(3, 1) == ".", F.date_format(day, "dd.MM.yyyy"))
        return kind.otherwise(F.date_format(day, "MM/dd/yyyy"))

    return bound(feistel_number(number, *DAY_SIZES, "date", key), shaped)


def email(value: Column, key: str) -> Column:
    """The part before the @; one of one character moves by one at least within its class."""
    local = F.split(value, "@")[0]

    def next_(c: Column) -> Column:
        low, n = F.when(c.rlike("[0-9]"), 48).when(c.rlike("[A-Z]"), 65).otherwise(97), F.when(c.rlike("[0-9]"), 10).otherwise(26)
        by = number_of(keyed("email", key, 0, F.lit("")), n - 1) + 1
        return F.char((F.ascii(c) - low + by) % n + low)

    out = F.when(F.length(local) == 1, next_(local)).otherwise(feistel_text(local, "email", key))
    return F.concat(out, F.lit("@"), F.split(value, "@")[1])


def pseudonym(value: Column, key: str) -> Column:
    """(kind, out) of a match of ANY; kind is null, and out the value itself, if validation fails."""

    def case(kind: str, out: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), out.alias("out"))

    whole = lambda pattern: value.rlike(f"^(?:{pattern})$")
    return (
        F.when(F.instr(value, "@") > 0, case("email", email(value, key)))
        .when(whole(IBAN), F.when(is_iban(value), case("iban", iban(value, key))))
        .when(whole(IP), case("ip", ip(value, key)))
        .when(whole(SSN), case("ssn", ssn(value, key)))
        .when(whole(PHONE), F.when(is_phone(value), case("phone", phone(value, key))))
        .when(whole(DATE), F.when(parsed_date(value).isNotNull(), case("date", date(value, key))))
        .when(whole(CARD), F.when(is_card(value), case("card", card(value, key))))
    )


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, n_found and text of every row of docs, with personal data in the whole text replaced.

    A null text stays null and has none. Numbers that fail validation stay. A null doc_id, repeated rows and other
    columns (which are not read) make no difference; an empty table gives no rows, an empty text is empty. Very long
    texts are worked on whole. Equal values have equal pseudonyms in all rows. No shuffle takes place.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("found", F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0))))
    rows = rows.withColumn("mapped", F.when(F.size("found") > 0, F.transform("found", lambda v: F.struct(v.alias("v"), pseudonym(v, key).alias("p")))))
    spliced = F.array_join(
        F.zip_with(F.split("text", ANY, -1), F.col("mapped"), lambda gap, m: F.concat(gap, F.coalesce(m["p"]["out"], m["v"], F.lit("")))), ""
    )
    n = F.coalesce(F.size(F.filter("mapped", lambda m: m["p"].isNotNull())), F.lit(0))
    n = F.when(F.col("mapped").isNull(), F.lit(0)).otherwise(n)
    return rows.select("doc_id", n.cast("int").alias("n_found"), F.when(F.col("mapped").isNull(), F.col("text")).otherwise(spliced).alias("text"))
