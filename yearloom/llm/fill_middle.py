"""Fill-in-the-middle: a text is cut at two unit borders and its parts are put in another order.

Units are lines.  A border is told by a character and the one before it, so a text's bytes are parted into chunks that
overlap by one, and each counts its borders without knowing the others.  Prefix sums over the counts say which chunk owns
a cut, given as a number of units; only the two owning chunks are looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

SEED, FIM_PERCENT, SPM_PERCENT, CHUNK = 7, 100, 50, 1 << 16
#: Marks of prefix, suffix and middle; a text that has one stays plain.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(doc_id: str, seed: int = SEED) -> Column:
    """Four numbers below 2**32 that seed and id choose, as an array."""
    said = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    digits = F.sha2(said.cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)))


def _slice(data: Column, i: Column, chunk: int) -> tuple[Column, Column, Column]:
    """(start, size, letters) of the bytes before the positions of chunk i, one letter a byte: a border lies behind each
    line break in it."""
    start = F.greatest(i * chunk - 1, F.lit(0))
    size = F.greatest(F.least((i + 1) * chunk, F.octet_length(data)) - 1 - start, F.lit(0))
    return start, size, F.decode(F.substring(data, start + 1, size), "ISO-8859-1")


def border_counts(data: Column, chunk: int = CHUNK) -> Column:
    """How many borders lie inside a text up to the end of each chunk; empty for an empty text."""
    chunks = F.when(F.octet_length(data) > 0, F.sequence(F.lit(0), F.floor((F.octet_length(data) - 1) / chunk).cast("int")))

    def borders(i: Column) -> Column:
        _, size, letters = _slice(data, i, chunk)
        return size - F.length(F.replace(letters, F.lit("\n"), F.lit("")))

    counts = F.transform(chunks, borders)
    sums = F.aggregate(counts, F.array().cast("array<int>"), lambda s, n: F.concat(s, F.array(F.coalesce(F.try_element_at(s, F.lit(-1)), F.lit(0)) + n)))
    return F.coalesce(sums, F.array().cast("array<int>"))


def cut_at(data: Column, sums: Column, units: Column, n: Column, chunk: int = CHUNK) -> Column:
    """The byte behind so many units."""
    owner = F.size(F.filter(sums, lambda s: s < units))
    before = F.when(owner > 0, F.get(sums, owner - 1)).otherwise(0)
    start, _, letters = _slice(data, owner, chunk)
    inside = start + F.length(F.call_function("substring_index", letters, F.lit("\n"), units - before)) + 1
    return F.when(units == 0, 0).when(units == n, F.octet_length(data)).otherwise(inside).cast("int")


def joined(form: Column, prefix: Column, middle: Column, suffix: Column, text: Column) -> Column:
    p, s, m = (F.lit(x) for x in (PREFIX, SUFFIX, MIDDLE))
    return F.when(form == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(form == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(text)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    second = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX))
    # No mark lies across a border: each begins with the only < it has and ends with the only >.
    ends = F.struct(F.instr(body, second).alias("b"), F.instr(body, F.lit(MIDDLE)).alias("c"), body.alias("body"))

    def told(x: Column) -> Column:
        first = F.substr(x["body"], F.lit(1), x["b"] - 1)
        next_ = F.substr(x["body"], x["b"] + 3, x["c"] - x["b"] - 3)
        middle = F.substr(x["body"], x["c"] + 3)
        return F.when(form == "psm", F.concat(first, middle, next_)).otherwise(F.concat(next_, middle, first))

    return F.when(form == "plain", output).otherwise(F.get(F.transform(F.array(ends), told), F.lit(0)))


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, chunk: int = CHUNK) -> DataFrame:
    """docs with n (units), form, prefix_chars, middle_chars (code points; null if plain) and output.

    A null text counts as empty; an empty text, and one that has a mark, stays plain.  A null doc_id draws as one without
    digits, equal ids draw alike.  A text may be of any length that fits a row.  No row moves between tasks.  Columns of
    docs with the new names are replaced.
    """
    new = ("n", "form", "prefix_chars", "middle_chars", "output")
    old = [c for c in docs.columns if c.lower() not in new or c == doc_id]
    t, data, h, sums, n, form, a, b, cut = (fresh(docs, f"_{x}") for x in ("text", "data", "draw", "sums", "units", "form", "first", "last", "cut"))
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({t: body, data: body.cast("binary"), h: draws(doc_id, seed)})
    df = df.withColumn(sums, border_counts(F.col(data), chunk))
    df = df.withColumn(n, F.when(F.col(t) == "", 0).otherwise(F.try_element_at(sums, F.lit(-1)) + 1).cast("long"))
    marked = F.col(t).contains(PREFIX) | F.col(t).contains(SUFFIX) | F.col(t).contains(MIDDLE)
    plain = (F.col(t) == "") | marked | (F.get(h, F.lit(2)) % 100 >= fim_percent)
    df = df.withColumn(form, F.when(plain, "plain").when(F.get(h, F.lit(3)) % 100 < spm_percent, "spm").otherwise("psm"))
    ranks = [(F.get(h, F.lit(k)) % (F.col(n) + 1)).cast("int") for k in (0, 1)]
    cuts = [cut_at(F.col(data), F.col(sums), F.col(x), F.col(n), chunk) for x in (a, b)]
    df = df.withColumns({a: F.least(*ranks), b: F.greatest(*ranks)})
    df = df.withColumn(cut, F.when(F.col(form) != "plain", F.struct(cuts[0].alias("a"), cuts[1].alias("b"))))
    part = lambda start, length: F.decode(F.substring(data, start, length), "UTF-8")
    left, right, size = F.col(cut)["a"], F.col(cut)["b"], F.octet_length(data)
    df = df.withColumn(cut, F.when(F.col(form) != "plain", F.struct(part(F.lit(1), left).alias("p"), part(left + 1, right - left).alias("m"), part(right + 1, size - right).alias("s"))))
    out = joined(F.col(form), F.col(cut)["p"], F.col(cut)["m"], F.col(cut)["s"], F.col(t))
    chars = [F.length(F.col(cut)[x]).cast("long") for x in "pm"]
    return df.select(*old, F.col(n).alias("n"), F.col(form).alias("form"), chars[0].alias("prefix_chars"), chars[1].alias("middle_chars"), out.alias("output"))
