"""What changed between consecutive editions of a text, token by token.

Pairs are made by a window over each entity's editions and compared batch by batch.  The script is a shortest one: the
furthest-reaching paths from both ends meet in the middle, which splits the pair in two, so memory is linear in its
tokens and time grows with the tokens times the changes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window as W

from yearloom.functions import text as X

#: A token is a run of blanks or of anything else, so that tokens put together are the text.
TOKEN = r"[ \t\n\r\f]+|[^ \t\n\r\f]+"
SCRIPT = "array<struct<op:string,n:int,text:string>>"


def _middle(a: list, b: list) -> tuple[int, int, int, int]:
    """Where a shortest script's middle run of equal tokens begins and ends, (x, y) to (u, v)."""
    n, m = len(a), len(b)
    delta, odd, size = n - m, (n - m) % 2 == 1, n + m + 2
    forth, back = [0] * (2 * size + 1), [0] * (2 * size + 1)
    for d in range((n + m + 1) // 2 + 1):
        for k in range(-d, d + 1, 2):
            x = forth[size + k + 1] if k == -d or k != d and forth[size + k - 1] < forth[size + k + 1] else forth[size + k - 1] + 1
            y = x - k
            x0, y0 = x, y
            while x < n and y < m and a[x] == b[y]:
                x, y = x + 1, y + 1
            forth[size + k] = x
            # The other end's path on this diagonal went d - 1 steps.
            if odd and abs(delta - k) < d and x + back[size + delta - k] >= n:
                return x0, y0, x, y
        for k in range(-d, d + 1, 2):
            x = back[size + k + 1] if k == -d or k != d and back[size + k - 1] < back[size + k + 1] else back[size + k - 1] + 1
            y = x - k
            x0, y0 = x, y
            while x < n and y < m and a[n - 1 - x] == b[m - 1 - y]:
                x, y = x + 1, y + 1
            back[size + k] = x
            if not odd and abs(delta - k) <= d and x + forth[size + delta - k] >= n:
                return n - x, m - y, n - x0, m - y0
    raise AssertionError("two paths always meet")


def blocks(a: list, b: list) -> list[tuple[int, int, int]]:
    """Runs (i, j, n) of equal tokens that a shortest script keeps, in order.

    No script keeps tokens of one side only, so the paths are sought among those of both, and put back into their places.
    """
    both = set(a) & set(b)
    at, to = ([i for i, x in enumerate(side) if x in both] for side in (a, b))
    out: list[tuple[int, int, int]] = []
    for i, j, n in _blocks([a[i] for i in at], [b[j] for j in to]):
        for x, y in zip(at[i : i + n], to[j : j + n]):
            if out and out[-1][0] + out[-1][2] == x and out[-1][1] + out[-1][2] == y:
                out[-1] = (*out[-1][:2], out[-1][2] + 1)
            else:
                out.append((x, y, 1))
    return out


def _blocks(a: list, b: list) -> list[tuple[int, int, int]]:
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        start = 0
        while i + start < i_end and j + start < j_end and a[i + start] == b[j + start]:
            start += 1
        if start:
            found.append((i, j, start))
            i, j = i + start, j + start
        end = 0
        while i_end - end > i and j_end - end > j and a[i_end - 1 - end] == b[j_end - 1 - end]:
            end += 1
        if end:
            found.append((i_end - end, j_end - end, end))
            i_end, j_end = i_end - end, j_end - end
        if i == i_end or j == j_end:
            continue
        x, y, u, v = _middle(a[i:i_end], b[j:j_end])
        if u > x:
            found.append((i + x, j + y, u - x))
        # What lies before and behind the middle run; one of them is smaller than the whole, as something changes here.
        todo += [(i, i + x, j, j + y), (i + u, i_end, j + v, j_end)]
    return sorted(found)


def script(old: str, new: str) -> list[dict]:
    """Steps that make new of old: keep n tokens (=), leave n out (-), put n of text in (+)."""
    a, b = re.findall(TOKEN, old), re.findall(TOKEN, new)
    known: dict[str, int] = {}
    x, y = ([known.setdefault(t, len(known)) for t in side] for side in (a, b))
    steps, i, j, kept = [], 0, 0, 0
    for at, to, n in [*blocks(x, y), (len(a), len(b), 0)]:
        if at > i or to > j:
            if kept:
                steps.append({"op": "=", "n": kept, "text": None})
                kept = 0
            if at > i:
                steps.append({"op": "-", "n": at - i, "text": None})
            if to > j:
                steps.append({"op": "+", "n": to - j, "text": "".join(b[j:to])})
        i, j, kept = at + n, to + n, kept + n
    if kept:
        steps.append({"op": "=", "n": kept, "text": None})
    return steps


def compared(df: DataFrame, old: str, new: str) -> DataFrame:
    """df with script, the steps from old to new; a null text counts as empty, two equal ones are one step."""
    import pyarrow as pa
    from pyspark.sql import types as T

    schema = T.StructType([f for f in df.schema if f.name != "script"]).add("script", T.ArrayType(T.StructType.fromDDL("op string, n int, text string")))
    kind = pa.list_(pa.struct([("op", pa.string()), ("n", pa.int32()), ("text", pa.string())]))
    kept = [f.name for f in schema][:-1]
    at = [df.columns.index(c) for c in (old, new)]
    places = [df.columns.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                steps = [script(x or "", y or "") for x, y in zip(*(batch.column(i).to_pylist() for i in at))]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in places), pa.array(steps, kind)], names=[*kept, "script"])

    return df.mapInArrow(run, schema)


def consecutive(df: DataFrame, by: list[str], order: list[str], key: str, text: str) -> DataFrame:
    """(key, next_key, old, new): each row's text and that of the next edition of the same by."""
    w = W.partitionBy(*by).orderBy(*order)
    rows = df.select(F.col(key), F.lead(key).over(w).alias(f"next_{key}"), F.col(text).alias("old"), F.lead(text).over(w).alias("new"))
    return rows.where(F.col(f"next_{key}").isNotNull())


def rebuilt(old: Column, steps: Column) -> Column:
    """The later text, from the earlier one and its script."""
    # Cut into tokens once a row; as a plain expression it would be copied into the step, and cut for each step.
    cut = F.regexp_extract_all(F.coalesce(old, F.lit("")), F.lit(TOKEN), F.lit(0))
    return X.bound(cut, lambda tokens: _put_together(tokens, steps))


def _put_together(tokens: Column, steps: Column) -> Column:
    none = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, x: Column) -> Column:
        kept = F.array_join(F.slice(tokens, s["at"] + 1, x["n"]), "")
        at = F.when(x["op"] == "+", s["at"]).otherwise(s["at"] + x["n"])
        return F.struct(at.alias("at"), F.concat(s["out"], F.when(x["op"] == "=", kept).when(x["op"] == "+", x["text"]).otherwise("")).alias("out"))

    return F.aggregate(steps, none, step, lambda s: s["out"])


def tokens_of(steps: Column, *ops: str) -> Column:
    """How many tokens the steps of these kinds have."""
    return F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + F.when(x["op"].isin(*ops), x["n"]).otherwise(0))
