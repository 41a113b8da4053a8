"""Text expressions. Python's Unicode classes are kept by (?U) and explicit classes, as Java's are ASCII by default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
PLACEHOLDER_TRIM = "№|наот_*!"
EMPTY_NUMBER = r"(?iu)№\s*_*$|№\s*_*от_*$|№\.*$|№\s?\.*от.*$|№\s*(на)?$"
CYRILLIC, SPACE = "[А-Яа-яЁё]", r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
UNKNOWN = "не определён"
#: The lower ends are Latin letters that look like Cyrillic ones, hence the code points.
MIXED_UPPER, MIXED_ANY = r"[\x{41}-\x{42F}]", r"[\x{61}-\x{44F}]"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def filled(text: Column) -> Column:
    """Null for an empty text."""
    return bound(text, lambda t: F.when(t != "", t))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def chars_of(text: Column, kind: str) -> Column:
    """The number of characters of a class, written [...]: what is left without the runs of others, as one match a character costs more."""
    return F.length(F.regexp_replace(text, f"[^{kind[1:]}+", ""))


def upper_count(text: Column) -> Column:
    return chars_of(text, r"[\p{Lu}]")


def is_upper(text: Column) -> Column:
    """More than half of the characters are capital letters (empty text: false)."""
    return upper_count(text) / (F.length(text) + F.lit(1e-6)) > 0.5


def char_shares(text: Column) -> dict[str, Column]:
    """Shares of Cyrillic, Latin, digit, space and other characters, to 5 digits; null for an empty text."""
    n = F.length(text)
    parts = {"is_cirillic": CYRILLIC, "is_latin": "[A-Za-z]", "is_number": "[0-9]", "is_space": SPACE}
    counts = {name: chars_of(text, p) for name, p in parts.items()}
    counts["is_other"] = n - sum(counts.values(), F.lit(0))
    return {name: F.round(F.try_divide(c.cast("double"), n), 5) for name, c in counts.items()}


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)\s+", " ")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """The number of words(), without a list of them."""
    return count_of(text, r"(?U)\S+")


def dot_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))


def space_ratio(text: Column) -> Column:
    return count_of(text, " ") / (count_of(text, CYRILLIC) + F.lit(1e-4))


def unspaced(text: Column) -> Column:
    """Without any space if there are at least 0.6 spaces for each Cyrillic letter (letter-spaced headings)."""
    return F.when(space_ratio(text) >= 0.6, F.replace(text, F.lit(" "), F.lit(""))).otherwise(text)


def stripped(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def subject(text: Column) -> Column:
    """The first sentence that begins with "О " or "Об ", if not over 200 characters; null otherwise."""
    found = F.regexp_extract(text, r"(?U)(\s|^)Об?\s[а-яА-Я]{3,100}.*", 0)
    return bound(found, lambda f: F.when((f != "") & (F.length(f) <= 200), stripped(F.translate(f, "_", " "))))


def outgoing_number(text: Column) -> Column:
    """The first "№" with the token behind it, or a lone one; null if there is none."""
    return filled(F.regexp_extract(text, r"№\s*\S+|№", 0))


def is_filled(number: Column) -> Column:
    """False if no letters or digits of a number follow the sign."""
    return ~F.trim(number).rlike(EMPTY_NUMBER)


def trimmed_number(number: Column) -> Column:
    return F.btrim(number, F.lit(PLACEHOLDER_TRIM))


def clean_number(number: Column) -> Column:
    """Without №, _ and », trimmed of spaces and long dashes; null if nothing is left."""
    out = F.btrim(F.trim(F.regexp_replace(number, "[№_»]", "")), F.lit("—"))
    return filled(F.trim(out))


def clean_name(text: Column) -> Column:
    """Lower case; anything but letters, digits, _, points and white space is a space, at the ends nothing. Nothing left: UNKNOWN."""
    clean = stripped(F.regexp_replace(F.lower(text), r"(?U)[^\w\s\.]", " "))
    return F.coalesce(filled(clean), F.lit(UNKNOWN))


def clean_signer(text: Column) -> Column:
    """A signer's name in both formats' common form; UNKNOWN if there is none."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(UNKNOWN)).otherwise(format_fullname(format_fio(text), False))


def filtered_words(text: Column) -> Column:
    """Words without anything but letters, digits, _ and points; what falls apart are several words."""
    return words(F.regexp_replace(text, r"(?U)[^\w\s\.]", " "))


def name_in(text: Column, found: Column | None = None) -> Column:
    """The first of the names `found` by a tagger, else the first surname with two initials in the text; null if there is none."""
    own = F.regexp_extract(text, r"[А-Я]\.[А-Я]\.\s{0,3}[А-Я][а-я]{2,30}|[А-Я][а-я]{2,30}\s{0,3}[А-Я]\.[А-Я]\.", 0)
    return filled(own) if found is None else F.coalesce(F.get(found, F.lit(0)), filled(own))


def comparable_names(a: Column, b: Column) -> tuple[Column, Column]:
    """Both as initials and surname if both have that form, else the longest word of each; texts a over 50 characters leave both as they are."""
    forms = F.struct(format_fullname(a).alias("a"), format_fullname(b).alias("b"))

    def compared(f: Column) -> Column:
        both = f["a"].rlike(INITIALS_FIRST) & f["b"].rlike(INITIALS_FIRST)
        return F.when(both, f).otherwise(F.struct(longest_token(f["a"]).alias("a"), longest_token(f["b"]).alias("b")))

    out = F.when(F.length(a) > 50, F.struct(a.alias("a"), b.alias("b"))).otherwise(bound(forms, compared))
    return out["a"], out["b"]


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^А-Яа-яA-Za-z]", "")


def split_fio(text: Column) -> list[Column]:
    """Surname, first and middle name or initial: parts between spaces and points, null where missing."""
    parts = F.filter(F.split(text, r"[ .]"), lambda p: p != "")
    return [F.get(parts, F.lit(i)) for i in range(3)]


def format_fio(text: Column) -> Column:
    """Tokens from the longest to the shortest, of equal ones the first: of three "Surname F.M.", of two "Surname f".

    Only single letters of three become initials; longer tokens stay whole and are joined without spaces. Digits and
    signs go. Texts of more than three tokens only lose these.
    """
    bare = F.regexp_replace(text, r"(?U)\d\.|\d", " ")

    def cleaned(bare: Column) -> Column:
        clean = bound(stripped(F.regexp_replace(bare, r"(?U)[^\w\s\.]", "")), lambda c: F.when(c != "", c).otherwise(bare))
        return F.regexp_replace(clean, r"(?U)\s+", " ")

    def ordered(row: Column) -> Column:
        tokens = F.filter(F.split(row, r"(?U)[\s\.]"), lambda t: t != "")
        order = F.transform(tokens, lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))
        return bound(F.transform(F.array_sort(order), lambda s: s["t"]), lambda t: joined(t, row))

    def joined(t: Column, row: Column) -> Column:
        first = F.concat(F.initcap(F.get(t, F.lit(0))), F.lit(" "))
        initial = lambda i: F.when(F.length(F.get(t, F.lit(i))) == 1, F.concat(F.upper(F.get(t, F.lit(i))), F.lit("."))).otherwise(F.get(t, F.lit(i)))
        return (
            F.when(F.size(t) == 3, F.concat(first, initial(1), initial(2))).when(F.size(t) == 2, F.concat(first, F.get(t, F.lit(1))))
            .when(F.size(t) == 1, F.get(t, F.lit(0))).otherwise(row)
        )

    return bound(bound(bare, cleaned), ordered)


INITIALS_FIRST = rf"\b{MIXED_UPPER}\.\s{{0,8}}[А-Я]\.\s{{0,8}}{MIXED_UPPER}{MIXED_ANY}{{2,34}}"


def format_fullname(text: Column, initials_first: bool = True) -> Column:
    """The first "F.M. Surname" or "Surname F.M." in the text, in the order wanted; texts without one stay.

    A name is found inside longer texts, too; the words around it are left out. A capital letter behind a small one
    begins a word. A surname behind initials goes on to the end of its word, beyond the letters of the pattern (ё).
    """
    front = rf"(?U)\b({MIXED_UPPER})\.\s{{0,8}}([А-Я])\.\s{{0,8}}({MIXED_UPPER}{MIXED_ANY}{{2,34}}\w*)"
    back = rf"(?U)\b([А-Я][а-я]{{2,34}})\s{{0,8}}({MIXED_UPPER})\.\s{{0,8}}([А-Я])\.?"
    shape = "%s.%s. %s" if initials_first else "%3$s %1$s.%2$s."
    one, other = (front, back) if initials_first else (back, front)

    def formatted(text: Column) -> Column:
        part = lambda pattern, i: F.regexp_extract(text, pattern, i)
        of = {front: F.format_string(shape, *[part(front, i) for i in (1, 2, 3)]), back: F.format_string(shape, *[part(back, i) for i in (2, 3, 1)])}
        return F.when(text.rlike(one), of[one]).when(text.rlike(other), of[other]).otherwise(text)

    return bound(F.regexp_replace(text, "([а-я])([А-Я])", "$1 $2"), formatted)


def without_placeholder(text: Column) -> Column:
    """Null for texts that begin with a placeholder of a name. Fixed values."""
    return F.when(~text.rlike(r"(?iu)^(подписант|руководитель|получатель|фамилия|фио)"), text)


def longest_token(text: Column) -> Column:
    """The longest token; of equal ones the first."""
    order = F.transform(words(text), lambda t, i: F.struct((-F.length(t)).alias("n"), i.alias("i"), t.alias("t")))
    return F.get(F.array_sort(order), F.lit(0))["t"]
