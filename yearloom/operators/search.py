"""The terms of full-text search: lower-cased runs of letters and digits, without diacritics."""

from __future__ import annotations

from unicodedata import normalize

from pyspark.sql import Column, functions as F

#: Letters with diacritics and those that they are read as, of the Latin blocks; made from the letters' decompositions.
MARKED, PLAIN = zip(*((c, d[0]) for c in map(chr, range(0xC0, 0x250)) if len(d := normalize("NFD", c)) > 1 and d[0].isascii()))


def tokens(text: Column) -> Column:
    """The terms of a text in order."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "".join(MARKED), "".join(PLAIN))
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda t: t != "")
