"""Toxicity: maximum-scoring segments of token log-odds, calibrated as extreme values.

Tokens get the log-odds of toxic against clean labelled text under an informative Dirichlet prior, that of their stem:
inflected words share the evidence of the letters they begin with, for as long as none tells otherwise (backing off in a
prefix tree, whose root is the labelled corpus as a whole).  A linear scan finds all maximal scoring segments of a document;
a segment of score S among n tokens has the expected number K * n * exp(-lambda * S) by chance, and those below E_VALUE are
significant.  Their summed significance maps to a probability by a logistic curve fitted on the labelled rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import appended, checkpoint, lowest

#: Labelled rows that a model learns from at most: those first by the hash of doc_id.
MAX_LABELLED = 20_000
#: A model holds the tokens and stems whose log-odds are so many deviations from those of the nearest stem that it holds, or
#: from 0, toxic or clean; other tokens share the rest.  PRIOR: words of prior, dealt as that stem deals them.
MIN_Z, PRIOR, E_VALUE = 3.5, 1.0, 0.01
#: Stems have so many code points.  A text counts for a stem by its different words, up to WORDS: words of one text are not
#: independent, and one long text would make its language look toxic.
LEAST_STEM, LONGEST_STEM, WORDS = 4, 24, 3
#: Minima of hashes by which copies among labelled texts are told, over runs of so many tokens.
SKETCHES, RUN = 8, 3
TOKEN = re.compile(r"[^\W\d_]+")
EULER = 0.5772156649015329


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]  # of telling tokens, and of telling stems, which end in *
    rest: float  # of any other token; below 0
    decay: float  # lambda
    scale: float  # K
    bias: float
    slope: float


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time: each stacked segment links to the nearest one
    before it whose left sum is smaller."""
    total, stack = 0.0, []
    for i, s in enumerate(scores):
        if s <= 0:
            total += s
            continue
        start, left = i, total
        total += s
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= total:
                stack.append((start, i + 1, left, total, j))
                break
            start, left = stack[j][0], stack[j][2]
            k = stack[j][4]
            del stack[j:]
            j = k
    return [(a, b, r - l) for a, b, l, r, _ in stack]


def stems(token: str) -> list[str]:
    """The stems of a token, shortest first, each with a * that no token has."""
    return [token[:k] + "*" for k in range(LEAST_STEM, min(len(token), LONGEST_STEM) + 1)]


def lookup(weights: dict[str, float]) -> Callable[[str], float | None]:
    """The weight of a token, or else of its longest stem that has one."""
    heads = {x[:LEAST_STEM] for x in weights}

    @lru_cache(1 << 17)
    def weight(token: str) -> float | None:
        if token[:LEAST_STEM] not in heads:
            return None
        if token in weights:
            return weights[token]
        return next((weights[x] for x in reversed(stems(token)) if x in weights), None)

    return weight


def telling(nodes: list[tuple[str, int, int]], share: float) -> list[tuple[str, float, int, int]]:
    """Of tokens and stems with their toxic and clean counts those to hold, each with its log-odds and the counts of the
    tokens that get them.  share: of toxic texts.  All that begin with the same LEAST_STEM code points come together.
    """
    counts = {x: (y1, y0) for x, y1, y0 in nodes}
    base, held = math.log(share / (1 - share)), {}
    # Stems with a longer one of the same counts: that says as much, and fits fewer words.
    idle = {x[:-2] + "*" for x, y in counts.items() if x[-1] == "*" and counts.get(x[:-2] + "*") == y}
    nearest = lambda x: next((s for s in reversed(stems(x.rstrip("*"))) if s in held), None)
    for x in sorted(counts, key=lambda x: (x[-1] != "*", len(x), x)):
        y1, y0 = counts[x]
        if x in idle or y1 + y0 < 2:
            continue
        log_odds, part = held.get(nearest(x), (0.0, share))
        a1, a0 = y1 + PRIOR * part, y0 + PRIOR * (1 - part)
        own = math.log(a1 / a0) - base
        if abs(own - log_odds) >= MIN_Z * math.sqrt(1 / a1 + 1 / a0):
            held[x] = own, a1 / (a1 + a0)
    sums = {x: [0, 0] for x in held}
    for x, (y1, y0) in counts.items():
        at = x if x in held else nearest(x)
        if x[-1] != "*" and at:
            sums[at][0] += y1
            sums[at][1] += y0
    return [(x, w, *sums[x]) for x, (w, _) in held.items()]


def segments(text: str, weight: Callable[[str], float | None], rest: float) -> tuple[list[tuple[int, int, float]], int]:
    """Maximal segments in tokens and the number of tokens.  A token tells once in a text.  Runs without telling tokens count
    as one step."""
    tokens = TOKEN.findall(text.lower())
    steps, spans, last, seen = [], [], 0, set()
    for i, token in enumerate(tokens):
        w = weight(token)
        if w is None or token in seen:
            continue
        seen.add(token)
        if i > last:
            steps.append(rest * (i - last))
            spans.append((last, i))
        steps.append(w)
        spans.append((i, i + 1))
        last = i + 1
    return [(spans[a][0], spans[b - 1][1], s) for a, b, s in maximal_segments(steps)], len(tokens)


def significance(found: list[tuple[int, int, float]], n: int, decay: float, scale: float) -> tuple[float, list]:
    """Sum of -log E over the significant segments, and these with their E."""
    kept = []
    for a, b, s in found:
        e = scale * n * math.exp(-min(decay * s, 700))
        if e <= E_VALUE:
            kept.append((a, b, s, e))
    return sum(-math.log(max(e, 1e-300)) for *_, e in kept), kept


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> Model:
    """A model of the labelled rows, or of MAX_LABELLED of them; rows with a null label or text teach nothing, nor do exact
    and near copies of a row of smaller id, whose words would all seem to tell what one text tells.

    Without toxic rows, or without others, the model has no tokens and scores all texts alike.
    """
    chosen = labels.where(F.col(doc_id).isNotNull() & F.col(toxic).isin(0, 1)).select(F.col(doc_id).alias("_id"), F.col(toxic).cast("int").alias("_toxic"))
    chosen = lowest(chosen, F.xxhash64("_id"), MAX_LABELLED, ["_id", "_toxic"])
    rows = docs.where(F.col(text).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id")  # MAX_LABELLED rows

    rows = checkpoint(rows)
    minima = appended(rows.select("_id", "_text"), "minima array<long>", lambda: lambda texts: [[sketch(t) for t in texts]], "_text")
    first = minima.select("_id", F.posexplode("minima").alias("k", "h")).groupBy("k", "h").agg(F.min("_id").alias("_id"))
    first = first.groupBy("_id").count().where(F.col("count") > SKETCHES // 2).select("_id")
    rows = checkpoint(rows.join(F.broadcast(first), "_id", "left_semi"))  # MAX_LABELLED rows
    n = {r["_toxic"]: float(r["count"]) for r in rows.groupBy("_toxic").count().collect()}
    if len(n) < 2:
        return Model({}, -1e-3, 1.0, 1e-6, 7.0 if 1 in n else -7.0, 0.0)
    share = n[1] / (n[1] + n[0])

    def tally():
        def call(texts, marks):
            return [[list(_counted(set(TOKEN.findall(t.lower()))).items()) for t in texts]]

        return call

    def hold():
        def call(groups):
            groups = [[(x["node"], x["y1"], x["y0"]) for x in g] for g in groups]
            return [[[{"node": x, "w": w, "y1": y1, "y0": y0} for x, w, y1, y0 in telling(g, share)] for g in groups]]

        return call

    words = appended(rows, "nodes array<struct<node:string,n:int>>", tally, "_text", "_toxic").select("_toxic", F.explode("nodes").alias("t"))
    counts = words.groupBy("t.node").agg(
        F.sum(F.when(F.col("_toxic") == 1, F.col("t.n")).otherwise(0)).alias("y1"), F.sum(F.when(F.col("_toxic") == 0, F.col("t.n")).otherwise(0)).alias("y0")
    )
    whole = lambda y: F.sum(F.when(~F.endswith("node", F.lit("*")), F.col(y)).otherwise(0)).alias(y)
    # Trees of tokens with the same first letters: no more than the words of MAX_LABELLED rows.
    trees = counts.groupBy(F.substring("node", 1, LEAST_STEM)).agg(whole("y1"), whole("y0"), F.collect_list(F.struct("node", "y1", "y0")).alias("nodes"))
    trees = appended(trees.select("y1", "y0", "nodes"), "held array<struct<node:string,w:double,y1:long,y0:long>>", hold, "nodes")
    found = trees.agg(F.sum("y1").alias("n1"), F.sum("y0").alias("n0"), F.sort_array(F.flatten(F.collect_list("held"))).alias("held")).first()
    n1, n0, top = float(found["n1"] or 0), float(found["n0"] or 0), found["held"] or []
    if not n1 or not n0:
        return Model({}, -1e-3, 1.0, 1e-6, -7.0 if n0 or not n1 else 7.0, 0.0)
    weights = {r["node"]: r["w"] for r in top}
    share1, share0 = sum(r["y1"] for r in top) / n1, sum(r["y0"] for r in top) / n0
    rest = min(-1e-3, math.log((1 - share1 + 1e-9) / (1 - share0 + 1e-9)))
    # lambda: the positive root of sum(p0 * exp(lambda * s)) = 1 over clean text.
    back = [((r["y0"] + 0.5) / (n0 + 0.5 * len(top)), r["w"]) for r in top]
    clean = 1 - sum(p for p, _ in back)
    low, high = 1e-3, 20.0
    for _ in range(60):
        mid = (low + high) / 2
        value = sum(p * math.exp(min(mid * w, 700)) for p, w in back) + clean * math.exp(mid * rest)
        low, high = (mid, high) if value < 1 else (low, mid)
    decay = low

    def best():
        weight = lookup(weights)

        def call(texts):
            found = [segments(t, weight, rest) for t in texts]
            return [[[float(s) for *_, s in f] for f, _ in found], [n for _, n in found]]

        return call

    fitted = appended(rows, "found array<double>, n int", best, "_text").select("_toxic", "found", "n").collect()  # MAX_LABELLED rows
    calm = [decay * max(r["found"], default=0.0) - math.log(max(r["n"], 1)) for r in fitted if r["_toxic"] == 0]
    scale = min(1.0, max(1e-6, math.exp(float(np.mean(calm)) - EULER))) if calm else 1e-3
    x = np.array([math.log1p(significance([(0, 0, s) for s in r["found"]], r["n"], decay, scale)[0]) for r in fitted])
    y = np.array([r["_toxic"] for r in fitted], float)
    bias, slope = _logistic(x, y)
    return Model(weights, rest, decay, scale, bias, slope)


def sketch(text: str) -> list[int]:
    """SKETCHES minima of hashes of the text's runs of RUN tokens; nothing of a text without tokens."""
    tokens = TOKEN.findall(text.lower())
    if not tokens:
        return []
    runs = {zlib.crc32(" ".join(tokens[i : i + RUN]).encode()) for i in range(max(1, len(tokens) - RUN + 1))}
    hashes = np.fromiter(runs, np.uint64, len(runs))
    odd = np.random.default_rng(7).integers(1 << 63, size=(SKETCHES, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return [int(x) for x in ((hashes * odd) >> np.uint64(16)).min(1)]


def _counted(tokens: set[str]) -> Counter[str]:
    """A text's tokens, once each, and its stems by their tokens, up to WORDS."""
    out = Counter(x for t in tokens for x in stems(t))
    return Counter({x: min(n, WORDS) for x, n in out.items()} | dict.fromkeys(tokens, 1))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps with a small ridge."""
    design, beta = np.stack([np.ones_like(x), x], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(2)
        beta = beta + np.linalg.solve(hessian, design.T @ (y - p) - 0.1 * beta)
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with toxic_score double (0 to 1) and toxic_passages: start and end in tokens, score and e_value of each.

    A null or empty text has no passages and the score of such texts.  Rows that come twice are scored twice, an empty table
    gives an empty one, and a text may be of any length.  Columns of these names are replaced, others keep theirs.
    """

    def start():
        weight = lookup(model.weights)

        def call(texts):
            scores, passages = [], []
            for t in texts:
                found, n = segments(t or "", weight, model.rest)
                total, kept = significance(found, n, model.decay, model.scale)
                scores.append(1 / (1 + math.exp(-max(-30, min(30, model.bias + model.slope * math.log1p(total))))))
                passages.append([{"start": a, "end": b, "score": s, "e_value": e} for a, b, s, e in kept])
            return [scores, passages]

        return call

    return appended(docs, "toxic_score double, toxic_passages array<struct<start:int,end:int,score:double,e_value:double>>", start, text)
