"""Scalar text functions as Columns; offsets and lengths are code points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def max_line_length(text: Column) -> Column:
    return F.array_max(F.transform(lines(text), F.char_length))


def mean_line_length(text: Column) -> Column:
    parts = lines(text)
    return (F.char_length(text) - F.size(parts) + 1) / F.size(parts)


#: Letters and numbers that Unicode 14 and 15 added, as hexadecimal ranges: older Java versions don't know them.
NEW_LETTERS = (
    "870-887 889-88E 8B5 8C8-8C9 C5D CDD 170D 171F 1B4C 2C2F 2C5F 9FFD-9FFF A7C0-A7C1 A7D0-A7D1 A7D3 A7D5-A7D9 A7F2-A7F4 "
    "10570-1057A 1057C-1058A 1058C-10592 10594-10595 10597-105A1 105A3-105B1 105B3-105B9 105BB-105BC 10780-10785 10787-107B0 "
    "107B2-107BA 10F70-10F81 11071-11072 11075 1123F-11240 11740-11746 11AB0-11ABF 11F02 11F04-11F10 11F12-11F33 12F90-12FF0 1342F "
    "13441-13446 16A70-16ABE 1AFF0-1AFF3 1AFF5-1AFFB 1AFFD-1AFFE 1B11F-1B122 1B132 1B155 1DF00-1DF1E 1DF25-1DF2A 1E030-1E06D "
    "1E290-1E2AD 1E4D0-1E4EB 1E7E0-1E7E6 1E7E8-1E7EB 1E7ED-1E7EE 1E7F0-1E7FE 2A6DE-2A6DF 2B735-2B739 31350-323AF"
)
NEW_NUMBERS = "11F50-11F59 16AC0-16AC9 1D2C0-1D2D3 1E4F0-1E4F9"


def outside(known: str, added: str) -> str:
    """A Java class of the characters that are neither of ``known`` nor in the ranges ``added``, which all lie from U+0870 on."""
    ranges = "".join("-".join(f"\\x{{{x}}}" for x in r.split("-")) for r in added.split())
    return f"[[^{known}]&&[\\x00-\\x{{86F}}[^{ranges}]]]"


NO_LETTER = outside(r"\p{L}", NEW_LETTERS)
NO_LETTER_OR_NUMBER = outside(r"\p{L}\p{N}", f"{NEW_LETTERS} {NEW_NUMBERS}")


def count_class(text: Column, java_class: str) -> Column:
    """Characters outside the complement ``java_class``, such as ``[^\\p{L}]`` for letters."""
    return F.char_length(F.regexp_replace(text, java_class, ""))


def alpha_count(text: Column) -> Column:
    return count_class(text, NO_LETTER)


def alnum_fraction(text: Column) -> Column:
    """Share of letters and numbers; null for an empty text."""
    return F.try_divide(count_class(text, NO_LETTER_OR_NUMBER), F.char_length(text))


def word_tokens(text: Column, unicode: bool = False) -> Column:
    """Split at every character that is no word character; empty tokens stay. ``unicode`` lowers case first."""
    return F.split(F.lower(text), r"(?U)\W", -1) if unicode else F.split(text, "[^A-Za-z_0-9]", -1)


def filled_tokens(text: Column) -> Column:
    return F.filter(word_tokens(text), lambda t: t != "")


def ngrams(tokens: Column, n: int, least: int | None = None) -> Column:
    """Word n-grams joined by one space; none when there are fewer than ``least`` (or n) tokens."""
    grams = lambda t: F.transform(F.sequence(F.lit(0), F.greatest(F.size(t) - n, F.lit(0))), lambda i: F.array_join(F.slice(t, i + 1, n), " "))
    return let(tokens, lambda t: F.when(F.size(t) >= max(n, least or n), grams(t)).otherwise(F.array().cast("array<string>")))


def sha1_hash32(value: Column) -> Column:
    """The first four SHA-1 bytes as a little-endian number."""
    digest = F.sha1(value.cast("binary"))
    return F.conv(F.concat(*(F.substring(digest, i, 2) for i in (7, 5, 3, 1))), 16, 10).cast("long")


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))


def clean_markdown(text: Column) -> Column:
    """Without tags, line breaks and hash signs."""
    return F.replace(F.replace(F.regexp_replace(text, "<.*?>", ""), F.lit("\n"), F.lit("")), F.lit("#"), F.lit(""))


def quoted_docstring(text: Column) -> Column:
    """What stands between the first pair of triple double quotes, else between triple single quotes.

    With two marks the text between them, with four that between the last two; null otherwise.
    """

    def between(mark: str) -> Column:
        parts = F.split(text, mark, -1)
        return F.when(F.size(parts) == 3, F.get(parts, F.lit(1))).when(F.size(parts) == 5, F.get(parts, F.lit(3)))

    return F.coalesce(between('"""'), between("'''"))


def before_marker(text: Column, *markers: str) -> Column:
    """The text before the first of ``markers`` that it holds."""
    for marker in markers:
        text = F.substring_index(text, marker, 1)
    return text


def extension(path: Column) -> Column:
    return F.substring_index(path, ".", -1)


def context(text: Column, start: Column, end: Column, width: int) -> Column:
    """``width`` characters on both sides of [start, end), cut at the ends of the text."""
    begin = F.greatest(start - width, F.lit(0))
    return F.substring(text, begin + 1, F.least(end + width, F.char_length(text)) - begin)


def stars_bucket(stars: Column) -> Column:
    return (
        F.when(stars.isNull() | (stars == 0), "0")
        .when(stars <= 10, "1-10")
        .when(stars <= 100, "10-100")
        .when(stars <= 1000, "100-1000")
        .otherwise("1000+")
    )


def language_format(language: Column) -> Column:
    """Dataset spelling of a language: C# and F# spelled out, else lower case with dashes for spaces."""
    return F.when(language == "C#", "c-sharp").when(language == "F#", "f-sharp").otherwise(F.replace(F.lower(language), F.lit(" "), F.lit("-")))


def occurrences(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    return ((F.char_length(text) - F.char_length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def literal_offsets(text: Column, needle: Column) -> Column:
    """Start offsets of all non-overlapping occurrences of a literal."""
    parts = F.split(text, F.concat(F.lit(r"\Q"), needle, F.lit(r"\E")), -1)
    heads = F.slice(parts, 1, F.size(parts) - 1)
    start = F.struct(F.array().cast("array<int>").alias("found"), F.lit(0).alias("at"))
    step = lambda acc, part: F.struct(
        F.concat(acc["found"], F.array(acc["at"] + F.char_length(part))).alias("found"), (acc["at"] + F.char_length(part) + F.char_length(needle)).alias("at")
    )
    return F.aggregate(heads, start, step, lambda acc: acc["found"])


IPV4_PART = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"{IPV4_PART}(?:\.{IPV4_PART}){{3}}"


def is_ipv4(value: Column) -> Column:
    return value.rlike(f"^{IPV4}$")


#: Private and reserved IPv4 ranges (address, prefix length): fixed values of the address registry.
PRIVATE_IPV4 = (
    ("0.0.0.0", 8), ("10.0.0.0", 8), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12), ("192.0.0.0", 29), ("192.0.0.170", 31),
    ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24), ("240.0.0.0", 4), ("255.255.255.255", 32),
)


def ipv4_number(value: Column) -> Column:
    parts = F.split(value, r"\.")
    return sum((F.get(parts, F.lit(i)).cast("long") * 256 ** (3 - i) for i in range(4)), F.lit(0).cast("long"))


def is_private_ipv4(value: Column) -> Column:
    """Whether an IPv4 address lies in a private or reserved range; false for what is no address."""
    number = F.when(is_ipv4(value), ipv4_number(value))
    found = F.lit(False)
    for address, length in PRIVATE_IPV4:
        low = sum(int(x) << 8 * (3 - i) for i, x in enumerate(address.split(".")))
        found = found | number.between(low, low + 2 ** (32 - length) - 1)
    return F.coalesce(found, F.lit(False))


#: Shape of an IPv6 address with at most one run of left-out groups.
IPV6_GROUP = "[0-9A-Fa-f]{1,4}"
IPV6 = rf"(?:(?:{IPV6_GROUP}:){{7}}{IPV6_GROUP}|(?=(?:[^:]*:){{2,8}}[^:]*$)(?:{IPV6_GROUP}(?::{IPV6_GROUP}){{0,6}})?::(?:{IPV6_GROUP}(?::{IPV6_GROUP}){{0,6}})?)"


def is_ipv6(value: Column) -> Column:
    return value.rlike(f"^{IPV6}$") & (F.size(F.filter(F.split(value, ":", -1), lambda g: g != "")) <= 8)


#: Private and reserved IPv6 ranges, and public ones inside of them (address, prefix length): fixed values of the address registry.
PRIVATE_IPV6 = (
    ("::1", 128), ("::", 128), ("::ffff:0:0", 96), ("64:ff9b:1::", 48), ("100::", 64), ("2001::", 23), ("2001:db8::", 32), ("2002::", 16),
    ("3fff::", 20), ("fc00::", 7), ("fe80::", 10),
)
PUBLIC_IPV6 = (("2001:1::1", 128), ("2001:1::2", 128), ("2001:3::", 32), ("2001:4:112::", 48), ("2001:20::", 28), ("2001:30::", 28))


def is_private_ipv6(value: Column) -> Column:
    """Whether an IPv6 address lies in a private or reserved range; false for what is no address."""
    import ipaddress

    halves = F.split(value, "::", -1)
    filled = lambda half: F.filter(F.split(F.coalesce(half, F.lit("")), ":", -1), lambda g: g != "")
    left, right = filled(F.get(halves, F.lit(0))), filled(F.get(halves, F.lit(1)))
    missing = F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0))
    padded = F.transform(F.concat(left, F.array_repeat(F.lit("0"), missing), right), lambda g: F.lpad(F.lower(g), 4, "0"))

    def within(digits: Column, ranges) -> Column:
        """Compares the first bits as hexadecimal text, which orders like the numbers."""
        found = F.lit(False)
        for address, length in ranges:
            low = int(ipaddress.IPv6Address(address))
            high = low | ((1 << (128 - length)) - 1)
            found = found | digits.between(f"{low:032x}", f"{high:032x}")
        return found

    whole = let(F.array_join(padded, ""), lambda d: within(d, PRIVATE_IPV6) & ~within(d, PUBLIC_IPV6))
    return F.coalesce(is_ipv6(value) & whole, F.lit(False))


def is_private_ip(value: Column) -> Column:
    return is_private_ipv4(value) | is_private_ipv6(value)


def first_item(values: Column) -> Column:
    """The first element of a list; null for an empty or null one."""
    return F.get(values, F.lit(0))


def json_list(value: Column, element: str = "string") -> Column:
    """A JSON array as a list; empty where it is null or can't be read."""
    return F.coalesce(F.from_json(value, f"array<{element}>"), F.array().cast(f"array<{element}>"))


def flat_licenses(column: Column) -> Column:
    """The plain list of a struct whose ``list`` holds structs with an ``item``."""
    return F.transform(column["list"], lambda x: x["item"])


def filled_size(size: Column, text: Column) -> Column:
    """The size that a row has, else the characters of its text."""
    return F.coalesce(size, F.char_length(text))
