"""Benchmark decontamination: approximate occurrences of test items, found by the pigeonhole principle.

Texts are compared as lower-cased runs of letters and digits with single spaces between.  An item of n characters may
occur with floor(ERROR_RATE * n) edits; cut into one piece more than that, at least one piece occurs unchanged.  One
automaton finds all pieces of a block of items in a pass over each whole text, and Myers' bit-parallel distance verifies
the stretch around each hit.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from .common import appended, checkpoint, fresh

ERROR_RATE = 0.06
#: Characters of test items that a pass ships to its tasks, some; more items, more passes.  The driver holds one pass's.
BLOCK_CHARS = 2_000_000
JUNK = re.compile(r"[\W_]+")
WORD = re.compile(r"[^\W_]+")
LEAKS = "leaks array<struct<item_id:long,distance:int,start:int,end:int>>"


def normal(text: str) -> str:
    return JUNK.sub(" ", text.lower()).strip()


def origin(text: str) -> list[int]:
    """For each character of normal(text), its place in text.lower(); lower() keeps the length of all but a few letters."""
    places: list[int] = []
    for m in WORD.finditer(text.lower()):
        if places:
            places.append(m.start() - 1)
        places.extend(range(m.start(), m.end()))
    return places


def nearest(item: str, text: str, most: int) -> tuple[int, int] | None:
    """Least edit distance of item to a substring of text and where the first such substring ends; None above most."""
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(item)) - 1, 1 << len(item) - 1
    up, down, distance = full, 0, len(item)
    best: tuple[int, int] | None = (distance, 0) if distance <= most else None
    for at, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = eq | down
        d = ((((eq & up) + up) ^ up) | eq) & full
        d |= x & full
        rise = down | ~(d | up) & full
        fall = up & d
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up = (fall | ~(x | rise)) & full
        down = rise & x
        if distance <= most and (best is None or distance < best[0]):
            best = (distance, at)
    return best


def pieces(item: str, error_rate: float = ERROR_RATE) -> tuple[int, list[tuple[int, str]]]:
    """The number of edits allowed and that many pieces plus one, with their offsets."""
    most = int(error_rate * len(item))
    cuts = [len(item) * k // (most + 1) for k in range(most + 2)]
    return most, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    def __init__(self, items: list[tuple[int, str]], error_rate: float = ERROR_RATE):
        import ahocorasick

        self.items, spots = [], {}
        for item_id, text in items:
            if item := normal(text):
                most, parts = pieces(item, error_rate)
                for offset, piece in parts:
                    spots.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, item, most))
        self.automaton = ahocorasick.Automaton()
        for piece, where in spots.items():
            self.automaton.add_word(piece, (len(piece), where))
        if spots:
            self.automaton.make_automaton()

    def leaks(self, text: str) -> list[dict]:
        if not self.items:
            return []
        body = normal(text)
        stretches: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(body):
            for k, offset in where:
                _, item, most = self.items[k]
                start = end + 1 - length - offset
                a, b = max(0, start - most), min(len(body), start + len(item) + most)
                known = stretches.setdefault(k, [])
                if known and known[-1][1] >= a and known[-1][0] <= b:
                    known[-1] = [min(a, known[-1][0]), max(b, known[-1][1])]
                else:
                    known.append([a, b])
        out, places = [], None
        for k in sorted(stretches):
            item_id, item, most = self.items[k]
            found = None
            for a, b in stretches[k]:
                if b - a >= len(item) - most and (hit := nearest(item, body[a:b], most)) and (found is None or hit[0] < found[0]):
                    found = (hit[0], a + hit[1])
            if found:
                places = places or origin(text)
                start = places[max(0, found[1] - len(item))]
                out.append({"item_id": item_id, "distance": found[0], "start": start, "end": places[found[1] - 1] + 1 if found[1] else start})
        return out


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item: str = "text", error_rate: float = ERROR_RATE) -> DataFrame:
    """docs with leaks: each test item that occurs, at its least distance, and about where in the text.

    Null or empty texts and items match nothing; equal items, and rows that come twice, are reported each; an empty table
    of either gives no leaks.  A text may be of any length.  A column leaks of docs is replaced, others keep their names.
    """
    given = items.where(F.col(item).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col(item).alias("item"))
    blocks = -(-int(given.agg(F.sum(F.length("item"))).first()[0] or 0) // BLOCK_CHARS)
    if not blocks:
        return docs.drop(*(c for c in docs.columns if c.lower() == "leaks")).withColumn("leaks", F.array().cast(LEAKS.removeprefix("leaks ")))
    out = docs
    for b in range(blocks):
        block = [(r["item_id"], r["item"]) for r in given.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(blocks)) == b).orderBy("item_id", "item").collect()]

        def start(block=block):
            matcher = Matcher(block, error_rate)
            return lambda texts: [[matcher.leaks(t or "") for t in texts]]

        if b == 0:
            out = appended(out, LEAKS, start, text)
        else:
            # Written out, so that tasks hold one pass's automaton, and the driver and the plan one pass's items.
            out = checkpoint(out)
            more = fresh(out, "_leaks")
            out = appended(out, LEAKS.replace("leaks", more, 1), start, text)
            out = out.withColumn("leaks", F.array_sort(F.concat("leaks", more))).drop(more)
    return out
