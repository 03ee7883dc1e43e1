"""Names inside texts and texts inside names, without comparing every text with every name.

All names make one automaton that finds every name in a text in one pass over its letters; the texts of a batch make
another, which finds them in the names.  Names go to every task as long as they take NAMES_BYTES at most, which is checked;
beyond that they are dealt to parts of that size, and each part meets the texts in portions.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from .keys import fresh

#: Bytes of names that a task holds, and texts of a portion where names come in parts.
NAMES_BYTES, PORTION = 16_000_000, 100_000


def _automaton(words: list[str | None]):
    import ahocorasick

    found: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w:
            found.setdefault(w, []).append(i)
    made = ahocorasick.Automaton()
    for w, at in found.items():
        made.add_word(w, at)
    if found:
        made.make_automaton()
    return made if found else None


def _hits(texts: list[str | None], names: list[str], inside, both: bool) -> tuple[list[int], list[int]]:
    """Places of texts and of names that hold one another, by the automaton of names."""
    pairs = set()
    for i, t in enumerate(texts):
        if t and inside is not None:
            pairs.update((i, n) for _, at in inside.iter(t) for n in at)
    around = _automaton(texts) if both else None
    if around is not None:
        for n, name in enumerate(names):
            if name:
                pairs.update((i, n) for _, at in around.iter(name) for i in at)
    if not pairs:
        return [], []
    left, right = zip(*sorted(pairs))
    return list(left), list(right)


def containing(texts: DataFrame, text: str, names: DataFrame, name: str, both: bool = True, limit: int = NAMES_BYTES) -> DataFrame:
    """Rows of texts with the rows of names whose name stands in the text, or (both) the text in the name.

    Letters are compared as they are.  A null or empty text or name holds nothing and stands in nothing.  Equal rows come
    each with its own hits.  Columns of both tables are returned; their names must differ.
    """
    import pyarrow as pa
    from pyspark.sql import types as T

    clash = {c.lower() for c in texts.columns} & {c.lower() for c in names.columns}
    if clash:
        raise ValueError(f"columns of both tables: {sorted(clash)}")
    schema = T.StructType([*texts.schema, *names.schema])
    own, other, columns = texts.columns, names.columns, schema.names
    at, name_at = own.index(text), other.index(name)
    names = names.where(F.length(name) > 0)
    sized = names.agg(F.coalesce(F.sum(F.octet_length(name)), F.lit(0)).alias("n")).first()["n"]

    def joined(rows: pa.Table | pa.RecordBatch, known: pa.Table, inside) -> pa.Table:
        i, n = _hits(rows.column(at).to_pylist(), known.column(name_at).to_pylist(), inside, both)
        taken = [*rows.select(own).take(pa.array(i, pa.int64())).columns, *known.take(pa.array(n, pa.int64())).columns]
        return pa.table(taken, names=columns)

    if sized <= limit:
        known = names.toArrow()  # some limit of bytes at most

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            inside = _automaton(known.column(name_at).to_pylist())
            for batch in batches:
                yield from joined(batch, known, inside).to_batches()

        return texts.mapInArrow(run, schema)

    parts, portions = sized // limit + 1, texts.count() // PORTION + 1
    part, portion = fresh(texts, "_part"), fresh(texts, "_portion")
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    many = names.withColumns({part: F.pmod(F.xxhash64(name), F.lit(parts)), portion: F.explode(upto(portions))})
    asked = texts.withColumns({part: F.explode(upto(parts)), portion: F.pmod(F.xxhash64(*texts.columns), F.lit(portions))})

    def meet(rows: pa.Table, known: pa.Table) -> pa.Table:
        return joined(rows, known.select(other), _automaton(known.column(name).to_pylist()))

    return asked.groupBy(part, portion).cogroup(many.groupBy(part, portion)).applyInArrow(meet, schema)


#: Needles of one length that are looked for one by one, and places of a text that are hashed at once.
FEW, BLOCK = 8, 1 << 20


def inside(text: str, needles: list[str]) -> set[str]:
    """Which needles stand in the text.  Those of a length are told by hashes of all runs of that length, made in one pass;
    what a hash finds is compared, so time grows with the text times the lengths that occur, not the needles."""
    import numpy as np

    body, sizes, found = text.encode(), {}, set()
    for n in set(needles):
        sizes.setdefault(len(n.encode()), []).append(n)
    marks = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)
    base, back = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def powers(x: int, n: int) -> np.ndarray:
        out = np.full(n, x, np.uint64)
        out[:1] = 1
        return np.cumprod(out, dtype=np.uint64)

    for size, group in sizes.items():
        if size > len(body):
            continue
        if len(group) <= FEW or size == 0:
            found.update(n for n in group if n in text)
            continue
        span = min(BLOCK, len(body) - size + 1)
        forth, undo = powers(base, span + size - 1), powers(back, span)
        letters = np.frombuffer("".join(group).encode(), np.uint8).reshape(len(group), size)
        hashes = np.zeros(len(group), np.uint64)
        for j in range(size):
            hashes += marks[letters[:, j]] * forth[j]
        order = np.argsort(hashes)
        hashes, group = hashes[order], [group[i] for i in order]
        high = np.zeros(1 << 20, bool)
        high[hashes >> np.uint64(44)] = True
        seen = np.zeros(len(group), bool)
        for start in range(0, len(body) - size + 1, BLOCK):
            part = marks[np.frombuffer(body, np.uint8, min(span + size - 1, len(body) - start), start)]
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * forth[: len(part)], dtype=np.uint64)])
            runs = (sums[size:] - sums[:-size]) * undo[: len(part) - size + 1]
            at = np.flatnonzero(high[runs >> np.uint64(44)])
            place = np.minimum(np.searchsorted(hashes, runs[at]), len(group) - 1)
            same = hashes[place] == runs[at]
            hit, first = np.unique(place[same], return_index=True)
            for k, i in zip(hit.tolist(), (at[same][first] + start).tolist()):
                if not seen[k]:
                    # Another needle of the same hash, or a chance hit, is looked for as it is.
                    seen[k] = body[i : i + size] == group[k].encode() or group[k] in text
        found.update(g for g, ok in zip(group, seen) if ok)
        twins = np.flatnonzero(hashes[1:] == hashes[:-1])
        found.update(group[k + 1] for k in twins if group[k + 1] in text)
    return found


def called(masters: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(called, master_id): the names of entities and what else they are called, aliases(alias, master_id)."""
    names = masters.select(F.col("name").alias("called"), "master_id")
    if aliases is not None:
        names = names.unionByName(aliases.select(F.col("alias").alias("called"), "master_id"))
    return names


def best(asked: DataFrame, q: str, masters: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(q, master_id, tier) for each distinct string that names an entity: by its name or alias (1), by that behind an
    article (2), or one inside the other (3); within a tier the least id."""
    questions = asked.select(F.col(q).alias("q")).distinct()
    hits = containing(questions, "q", called(masters, aliases), "called")
    tier = F.when(F.col("q") == F.col("called"), 1).when(F.regexp_replace("q", "^the ", "") == F.col("called"), 2).otherwise(3)
    found = hits.groupBy("q").agg(F.min(F.struct(tier.alias("tier"), "master_id")).alias("best"))
    return found.select("q", "best.master_id", "best.tier")
