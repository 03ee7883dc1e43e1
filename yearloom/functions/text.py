"""Scalar text functions: column expressions only, so that they stay in generated code.

Patterns are prefixed with U and d: classes cover Unicode, and only a line feed ends a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

#: What a rank note says before its number (a fixed value).
RANK = "country comparison to the world:"
#: Words of magnitude and what they multiply by (fixed values).
MAGNITUDES = {"thousand": 1e3, "million": 1e6, "billion": 1e9, "trillion": 1e12}
#: Named entities that strip_html decodes (fixed values); numeric ones are decoded by entity_codes().
ENTITIES = {"&nbsp;": " ", "&copy;": "©", "&middot;": "·", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&eacute;": "é", "&aacute;": "á", "&amp;": "&"}


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value made once, however often use names it; a plain expression is copied to each place."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(c: Column, pattern: str, group: int = 0, flags: str = "Ud") -> Column:
    """The group of the first match; null where nothing matches or the group is empty."""
    return F.get(F.filter(F.array(F.regexp_extract(c, f"(?{flags}){pattern}", group)), lambda x: x != ""), F.lit(0))


def swapped(c: Column, pattern: str, by: str, flags: str = "Ud") -> Column:
    return F.regexp_replace(c, f"(?{flags}){pattern}", by)


def stripped(c: Column) -> Column:
    """Without white space of any kind at either end; most texts have none, so the ends are looked at first."""
    ends = lambda x: F.concat(F.left(x, F.lit(1)), F.right(x, F.lit(1))).rlike(r"(?U)\s")
    return bound(c, lambda x: F.when(ends(x), swapped(x, r"^\s+|\s+$", "")).otherwise(x))


def number(c: Column) -> Column:
    """Digits with thousands commas as a double; null for anything else, even what a lenient cast would take."""
    bare = F.replace(stripped(c), F.lit(","), F.lit(""))
    return bound(bare, lambda x: F.when(x.rlike(r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"), x.try_cast("double")))


def magnitude(word: Column) -> Column:
    """The factor that a word of magnitude stands for; 1 for any other or none."""
    factors = F.create_map(*(F.lit(x) for pair in MAGNITUDES.items() for x in pair))
    return F.coalesce(F.try_element_at(factors, F.lower(F.coalesce(word, F.lit("")))), F.lit(1.0))


def normalized(content: Column) -> Column:
    """Content without rank notes, and with `label: | value` joined; null becomes empty."""
    ranked = lambda c: F.when(F.contains(c, F.lit(RANK)), swapped(c, rf"\s*\|?\s*{RANK}\s*\d+", "")).otherwise(c)
    joined = lambda c: F.when(F.contains(c, F.lit("|")), swapped(c, r":\s*\|\s*", ": ")).otherwise(c)
    return stripped(bound(bound(F.coalesce(content, F.lit("")), ranked), joined))


def rank(content: Column) -> Column:
    return bound(content, lambda c: F.when(F.contains(c, F.lit(RANK)), found(c, RANK + r"\s*(\d+)", 1).try_cast("int")))


def date_est(content: Column) -> Column:
    """`2024 est.` before `FY93` before a bare year, each in parentheses of its own."""
    patterns = (r"\((\d{4}\s*est\.?)\)", r"\((FY\d{2,4}/?(?:\d{2})?)\)", r"\((\d{4})\)")
    return bound(content, lambda c: F.when(F.contains(c, F.lit("(")), F.coalesce(*(found(c, p, 1) for p in patterns))))


def _piped(c: Column) -> Column:
    c = stripped(swapped(c, r"\s+", " "))
    c = swapped(c, r"(\s*\|\s*)+", " | ")
    return swapped(swapped(c, r"^\s*\|\s*", ""), r"\s*\|\s*$", "")


def html_to_pipe(html: Column) -> Column:
    """HTML as text: blocks end in a pipe, tags and named entities turn to blanks, runs of either shrink to one."""
    c = F.coalesce(html, F.lit(""))
    c = swapped(c, r"<br\s*/?\s*>\s*(?:<br\s*/?\s*>)?", " | ", "iUd")
    c = swapped(c, r"</p>\s*<p[^>]*>", " | ", "iUd")
    c = swapped(c, r"</div>\s*<div[^>]*>", " | ", "iUd")
    c = swapped(c, r"<[^>]+>", " ")
    return _piped(swapped(c, "&[a-zA-Z]+;", " "))


def unescaped(c: Column) -> Column:
    """Decodes ENTITIES and decimal or hexadecimal references; the ampersand last, so that nothing is decoded twice."""
    coded = lambda digits, base: F.conv(digits, base, 10).try_cast("long")
    parts = F.split(c, r"(?=&#[0-9]{1,6};)|(?=&#x[0-9A-Fa-f]{1,5};)")

    def decoded(p: Column) -> Column:
        decimal, hexed = F.regexp_extract(p, r"^&#([0-9]{1,6});", 1), F.regexp_extract(p, r"^&#x([0-9A-Fa-f]{1,5});", 1)
        point = F.when(decimal != "", coded(decimal, 10)).when(hexed != "", coded(hexed, 16))
        letter = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32BE")
        return F.when(point.isNotNull(), F.concat(letter, F.regexp_replace(p, "^&#x?[0-9A-Fa-f]+;", ""))).otherwise(p)

    c = F.array_join(F.transform(parts, decoded), "")
    for name, letter in ENTITIES.items():
        c = F.replace(c, F.lit(name), F.lit(letter))
    return c


def strip_html(html: Column) -> Column:
    """As html_to_pipe, but entities are decoded and blocks of divisions don't end in pipes."""
    c = F.coalesce(html, F.lit(""))
    c = swapped(c, r"<br\s*/?\s*>\s*(?:<br\s*/?\s*>)?", " | ", "iUd")
    c = swapped(c, r"</p>\s*<p[^>]*>", " | ", "iUd")
    return _piped(unescaped(swapped(c, r"<[^>]+>", " ")))


def escaped(c: Column) -> Column:
    """HTML-escaped but for quotes, without control characters; null becomes empty."""
    c = swapped(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def title_case(name: Column) -> Column:
    """Names in capitals only, with each run of letters capitalised; any other name as it is."""
    words = F.regexp_extract_all(name, F.lit(r"((?U)\p{L}+|\P{L}+)"), F.lit(1))
    titled = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substring(w, 2, 1 << 30)))), "")
    return F.when((name == F.upper(name)) & name.rlike(r"\p{L}"), titled).otherwise(name)


def formatted(value: Column, units: Column) -> Column:
    """A number with thousands commas and at most four decimals, then its units; null for null."""
    whole = value == F.floor(value)
    trimmed = F.regexp_replace(F.format_number(value, 4), r"\.?0+$", "")
    text = F.when(whole, F.format_number(value, 0)).otherwise(trimmed)
    return F.when(F.coalesce(units, F.lit("")) != "", F.concat(text, F.lit(" "), escaped(units))).otherwise(text)


def has_any(c: Column, words: list[str]) -> Column:
    """Whether one of a fixed list of words stands in the text."""
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))


def short_code(name: Column) -> Column:
    """The first two ASCII letters in lower case; of a name with fewer, its first two characters."""
    letters = F.regexp_replace(name, "[^a-zA-Z]", "")
    return F.lower(F.when(F.length(letters) >= 2, F.left(letters, F.lit(2))).otherwise(F.left(name, F.lit(2))))


def degrees(whole: Column, minutes: Column, side: Column) -> Column:
    """Degrees and minutes as a signed number of four decimals."""
    value = F.round(whole.cast("double") + minutes.cast("double") / 60, 4)
    return F.when(side.isin("S", "W"), -value).otherwise(value)
