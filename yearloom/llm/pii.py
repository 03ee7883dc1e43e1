"""PII: a character-level bidirectional LSTM with CRF transitions, trained in numpy from labelled spans.

Patterns give the base spans of four kinds.  The tagger learns from them in a bounded sample of stretches, from the same
stretches with a span respelled (a phone number without its plus, a card number in dotted groups, an address with blanks
about its @), and from stretches where a number that is none of these stands instead; so it also tags what the patterns
miss.  Only stretches around digits and @ can hold a span of these kinds; each is cut into overlapping windows, the
windows' scores are averaged where they overlap, and one Viterbi path is decoded over the whole stretch.  A decoded span
is added where it overlaps no base span, passes its kind's check and is scored well clear of "no span".
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import appended, lowest

#: Kinds and patterns are fixed values.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SIGNS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
NOT_DIGIT = re.compile(r"[^0-9]")
#: The same matches in time that grows with the text: an ip begins where its run of digits does, an email is told by its @.
IP = re.compile(r"(?<![0-9])" + PATTERNS["ip"].pattern)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: What the tagger learns from at most: documents (those first by hash among those with a digit or @), stretches of each
#: (those first by hash) and characters of a stretch (from a place told by its hash).
MAX_SAMPLE, MAX_STRETCHES, MAX_LENGTH = 1_500, 8, 400
#: Characters beside a digit or @ that belong to its stretch, window length, and how far windows are apart.
BESIDE, WIDTH, STRIDE = 24, 64, 32
STRETCH = re.compile(r"[0-9@](?:[^0-9@]{0,48}[0-9@])*")
TAGS = ["O"] + [f"{b}-{k}" for k in KINDS for b in "BI"]
EMBED, HIDDEN, STEPS, BATCH, RATE = 12, 20, 1000, 32, 0.01
#: Windows of training for each kind as written, as many respelled, and as many without.
PER_KIND = 800
#: Mean margin of a span's emissions over "no span" below which it isn't added; held-out respelled spans are found alike
#: between 0 and 0.5.
MARGIN = 0.25


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: str, text: str) -> bool:
    if kind == "email":
        return "@" in text.strip("@")
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(int(p) <= 255 for p in parts)
    digits = NOT_DIGIT.sub("", text)
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def told(kind: int, text: str) -> int:
    """The kind of a decoded span: the number of digits tells a card from a phone number."""
    return kind if kind < 2 else 2 + (len(NOT_DIGIT.sub("", text)) < 16)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the email pattern."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:
        start, end = at, at + 1
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at)):
            out.append((start, m.end()))
            end = m.end()
        free = end
        at = text.find("@", end)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end): leftmost matches, those that fail their check dropped without another try."""
    out = [(0, a, b) for a, b in emails(text) if valid("email", text[a:b])]
    for k, kind in enumerate(KINDS):
        if k and SIGNS[kind] in text:
            pattern = IP if kind == "ip" else PATTERNS[kind]
            out += [(k, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return out


def code(text: str) -> np.ndarray:
    """Classes of characters: printable ASCII itself, other letters, other blanks, the rest; 0 pads."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    other = np.where(points < 32, 97, np.where((points >= 0xC0) & (points < 0x2000), 96, 98))
    return np.where((points >= 32) & (points < 127), points - 31, other).astype(np.int16)


CLASSES = 99


def stretches(text: str) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for m in STRETCH.finditer(text):
        a, b = max(0, m.start() - BESIDE), min(len(text), m.end() + BESIDE)
        if out and out[-1][1] >= a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def offsets(length: int) -> list[int]:
    return [*range(0, max(1, length - WIDTH), STRIDE), max(0, length - WIDTH)] if length > WIDTH else [0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tagger:
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 7) -> "Tagger":
        r, k = np.random.default_rng(seed), len(TAGS)
        draw = lambda *shape: (r.standard_normal(shape) * 0.2).astype(np.float32)
        w = {"embed": draw(CLASSES, EMBED), "out": draw(2 * HIDDEN, k), "bias": np.zeros(k, np.float32), "next": np.zeros((k, k), np.float32)}
        for side in "fb":
            w[f"x{side}"], w[f"h{side}"], w[f"c{side}"] = draw(EMBED, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN), np.zeros(4 * HIDDEN, np.float32)
            w[f"c{side}"][HIDDEN : 2 * HIDDEN] = 1
        return Tagger(w)

    def _run(self, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of both directions side by side; x is (rows, width, EMBED).  The second reads from the end."""
        w, n = self.weights, HIDDEN
        across, down, lift = (np.stack([w[k + "f"], w[k + "b"]]) for k in "xhc")
        drive = np.stack([x, x[:, ::-1]]) @ across[:, None] + lift[:, None, None]
        h = c = np.zeros((2, len(x), n), np.float32)
        states, tape = np.empty((2, len(x), x.shape[1], n), np.float32), []
        for t in range(x.shape[1]):
            z = drive[:, :, t] + h @ down
            s = sigmoid(z[..., : 3 * n])
            g = np.tanh(z[..., 3 * n :])
            old_c, old_h = c, h
            c = s[..., n : 2 * n] * c + s[..., :n] * g
            out = np.tanh(c)
            h = s[..., 2 * n :] * out
            states[:, :, t] = h
            if keep:
                tape.append((t, s, g, old_c, out, old_h))
        return np.concatenate([states[0], states[1, :, ::-1]], 2), tape

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        x = self.weights["embed"][ids]
        both, _ = self._run(x, False)
        return both @ self.weights["out"] + self.weights["bias"]

    def step(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of full windows and its gradients."""
        w, n = self.weights, HIDDEN
        rows, width = ids.shape
        x = w["embed"][ids]
        both, tape = self._run(x, True)
        e = (both @ w["out"] + w["bias"]).astype(np.float64)
        nxt = w["next"].astype(np.float64)
        # Forward and backward probabilities, each step scaled to sum to one.
        top = e.max(2, keepdims=True)
        likely, moves = np.exp(e - top), np.exp(nxt)
        alpha, beta, scale = np.empty_like(e), np.ones_like(e), np.empty((rows, width, 1))
        for t in range(width):
            alpha[:, t] = likely[:, t] * (alpha[:, t - 1] @ moves if t else 1)
            scale[:, t] = alpha[:, t].sum(1, keepdims=True)
            alpha[:, t] /= scale[:, t]
        dn = np.zeros_like(nxt)
        for t in range(width - 1, 0, -1):
            ahead = likely[:, t] * beta[:, t] / scale[:, t]
            beta[:, t - 1] = ahead @ moves.T
            dn += alpha[:, t - 1].T @ ahead
        dn *= moves
        whole = (np.log(scale) + top).sum((1, 2))
        at = np.arange(rows)[:, None], np.arange(width), tags
        loss = float((whole - e[at].sum(1) - nxt[tags[:, :-1], tags[:, 1:]].sum(1)).mean())
        de = alpha * beta
        de[at] -= 1
        np.add.at(dn, (tags[:, :-1], tags[:, 1:]), -1)
        de = (de / rows).astype(np.float32)
        grads = {"next": (dn / rows).astype(np.float32), "out": both.reshape(rows * width, -1).T @ de.reshape(rows * width, -1), "bias": de.sum((0, 1))}
        dboth = de @ w["out"].T
        own = np.stack([dboth[:, :, :n], dboth[:, ::-1, n:]])
        up = np.stack([w["hf"].T, w["hb"].T])
        dz_all = np.zeros((2, rows, width, 4 * n), np.float32)
        dw, dh, dc = np.zeros((2, n, 4 * n), np.float32), np.zeros((2, rows, n), np.float32), np.zeros((2, rows, n), np.float32)
        for t, s, g, old_c, out, old_h in reversed(tape):
            dh = dh + own[:, :, t]
            i, f, o = s[..., :n], s[..., n : 2 * n], s[..., 2 * n :]
            dc = dc + dh * o * (1 - out * out)
            dz = dz_all[:, :, t]
            dz[..., :n], dz[..., n : 2 * n], dz[..., 2 * n : 3 * n], dz[..., 3 * n :] = dc * g, dc * old_c, dh * out, dc * i * (1 - g * g)
            dz[..., : 3 * n] *= s * (1 - s)
            dw += old_h.transpose(0, 2, 1) @ dz
            dh, dc = dz @ up, dc * f
        dx = np.zeros_like(x)
        for k, side in enumerate("fb"):
            read = x if side == "f" else x[:, ::-1]
            flat = dz_all[k].reshape(rows * width, 4 * n)
            grads[f"h{side}"], grads[f"c{side}"] = dw[k], flat.sum(0)
            grads[f"x{side}"] = read.reshape(rows * width, -1).T @ flat
            back = (flat @ w[f"x{side}"].T).reshape(x.shape)
            dx += back if side == "f" else back[:, ::-1]
        grads["embed"] = np.zeros_like(w["embed"])
        np.add.at(grads["embed"], ids, dx)
        return loss, grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = STEPS, seed: int = 11) -> list[float]:
        """Adam over shuffled batches, at a rate that falls to 0; the mean loss of each epoch."""
        r, step, means, epochs = np.random.default_rng(seed), 0, [], -(-steps * BATCH // len(ids))
        total = epochs * -(-len(ids) // BATCH)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            order, losses = r.permutation(len(ids)), []
            for at in range(0, len(ids), BATCH):
                rows = order[at : at + BATCH]
                loss, grads = self.step(ids[rows], tags[rows])
                losses.append(loss)
                step += 1
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.weights[k] = self.weights[k] - RATE * (1 - step / (total + 1)) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            means.append(float(np.mean(losses)))
        return means

    def decode(self, texts: list[str]) -> list[list[tuple[int, int, int, float]]]:
        """(kind, start, end, margin) of the spans in each stretch of text."""
        coded = [code(t) for t in texts]
        windows = [(i, o) for i, c in enumerate(coded) for o in offsets(len(c))]
        total = [np.zeros((len(c), len(TAGS)), np.float32) for c in coded]
        times = [np.zeros((len(c), 1), np.float32) for c in coded]
        for at in range(0, len(windows), 2048):
            part = windows[at : at + 2048]
            ids = np.zeros((len(part), WIDTH), np.int16)
            for row, (i, o) in zip(ids, part):
                own = coded[i][o : o + WIDTH]
                row[: len(own)] = own
            for e, (i, o) in zip(self.emissions(ids), part):
                n = min(WIDTH, len(coded[i]) - o)
                total[i][o : o + n] += e[:n]
                times[i][o : o + n] += 1
        out: list[list[tuple[int, int, int, float]]] = [[] for _ in texts]
        order = sorted(range(len(texts)), key=lambda i: len(coded[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and end - at < 512 and (end - at + 1) * len(coded[order[end]]) <= 1 << 17:
                end += 1
            group, at = order[at:end], end
            width = len(coded[group[-1]])
            e = np.zeros((len(group), width, len(TAGS)), np.float32)
            for row, i in zip(e, group):
                row[: len(total[i])] = total[i] / times[i]
            for path, i in zip(self._paths(e, [len(coded[i]) for i in group]), group):
                score = total[i] / times[i]
                s = 0
                while s < len(path):
                    if path[s] == 0:
                        s += 1
                        continue
                    kind, stop = (path[s] - 1) // 2, s + 1
                    while stop < len(path) and path[stop] == 2 * kind + 2:
                        stop += 1
                    own = score[np.arange(s, stop), path[s:stop]] - score[s:stop, 0]
                    out[i].append((int(kind), s, stop, float(own.mean())))
                    s = stop
        return out

    def _paths(self, e: np.ndarray, lengths: list[int]) -> list[np.ndarray]:
        """Best tag paths; scores beyond a row's length don't count."""
        rows, width, _ = e.shape
        best, back = e[:, 0], np.zeros(e.shape, np.int8)
        lengths_ = np.array(lengths)
        for t in range(1, width):
            step = best[:, :, None] + self.weights["next"]
            back[:, t] = step.argmax(1)
            best = np.where((t < lengths_)[:, None], step.max(1) + e[:, t], best)
        paths = np.zeros((rows, width), np.int8)
        tag = best.argmax(1)
        for t in range(width - 1, -1, -1):
            inside = t < lengths_
            paths[inside, t] = tag[inside]
            tag = np.where(inside & (t > 0), back[np.arange(rows), t, tag], tag)
        return [p[:n] for p, n in zip(paths, lengths)]


def varied(kind: str, text: str, r: np.random.Generator) -> str:
    """Other data of the kind, as the patterns write it, so that not only the sample's names and numbers are learned."""
    n = lambda k: "".join(str(x) for x in r.integers(0, 10, k))
    word = lambda: "".join(chr(97 + x) for x in r.integers(0, 26, int(r.integers(2, 9))))
    if kind == "phone":
        mark = " -."[r.integers(3)]
        return f"+{r.integers(1, 99)}{mark}" + mark.join(n(int(k)) for k in r.integers(3, 5, 3))
    if kind == "card":
        mark = ("", " ", "-")[r.integers(3)]
        return mark.join(n(4) for _ in range(4))
    if kind == "ip":
        return ".".join(str(x) for x in r.integers(0, 256, 4))
    name = word() + (("." + word(), "_" + word(), n(2), "")[r.integers(4)])
    return f"{name}@{'.'.join(word() for _ in range(int(r.integers(1, 3))))}.{('com', 'org', 'net', 'de', 'io')[r.integers(5)]}"


def respelled(kind: str, text: str, r: np.random.Generator) -> str:
    """The same data as the patterns don't write it."""
    digits = NOT_DIGIT.sub("", text)
    pick = lambda *options: options[r.integers(len(options))]
    if kind == "phone":
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        if len(a) < 3:
            return "00" + digits
        if not r.integers(4):
            return "00" + " ".join((digits[:2], digits[2:4], digits[4:8], digits[8:12]))
        lead = pick("", "", "1 ", "0", "0044 ", "001-")
        return lead + pick(f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a[:2]} {a[2]}{b} {c}")
    if kind == "card":
        return pick(".", "/", "_", " - ", "  ", ". ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == "ip":
        return text.replace(".", pick(" . ", "[.]", "(.)", " .", ". "))
    at = pick(" @ ", "(@)", "[@]", " (@) ", " [@] ", "@ ", " @")
    name, _, domain = text.partition("@")
    return name + at + (domain.replace(".", " . ") if not r.integers(4) else domain)


def harmless(r: np.random.Generator) -> str:
    """A number, or an @, that is none of the kinds."""
    n = lambda k: "".join(str(x) for x in r.integers(0, 10, k))
    options = (
        lambda: n(int(r.integers(1, 16))),
        lambda: f"{n(1)}.{n(2)}",
        lambda: f"{r.integers(1900, 2100)}-{r.integers(10, 13)}-{r.integers(10, 29)}",
        lambda: f"{r.integers(1, 13)}:{n(2)}:{n(2)}",
        lambda: f"v{n(1)}.{n(2)}.{n(1)}",
        lambda: f"{n(1)},{n(3)},{n(3)}.{n(2)}",
        lambda: f"@user{n(2)}",
        lambda: f"{n(3)} @ ${n(1)}.{n(2)}",
        lambda: "".join("0123456789abcdef"[x] for x in r.integers(0, 16, 32)),
        lambda: " ".join(n(int(k)) for k in r.integers(1, 3, int(r.integers(2, 5)))),
    )
    return options[r.integers(len(options))]()


def examples(texts: list[str], seed: int = 5, per_kind: int = PER_KIND) -> tuple[np.ndarray, np.ndarray]:
    """Windows and tags: of each kind, spans as they stand, as many respelled, and as many with a harmless number instead;
    and stretches without spans."""
    r, ids, tags = np.random.default_rng(seed), [], []

    def window(text: str, spans: list[tuple[int, int, int]], near: int) -> None:
        a = max(0, min(near - int(r.integers(WIDTH)), len(text) - WIDTH))
        row, tag = np.zeros(WIDTH, np.int16), np.zeros(WIDTH, np.int64)
        own = code(text[a : a + WIDTH])
        row[: len(own)] = own
        for k, s, e in spans:
            s, e = s - a, e - a
            if s < WIDTH and e > 0:
                tag[max(s, 0) : e] = 2 * k + 2
                if s >= 0:
                    tag[s] = 2 * k + 1
        ids.append(row)
        tags.append(tag)

    # What stands before and after a span, each with the spans in it, and the spans themselves.
    heads, tails, bare = [], [], []
    known: list[list[str]] = [[] for _ in KINDS]
    for text in texts:
        spans = sorted(base_spans(text), key=lambda x: x[1])
        spans = [x for i, x in enumerate(spans) if not i or x[1] >= spans[i - 1][2]]
        cuts = [(s, e) for _, s, e in spans]
        if not spans and text:
            bare.append(text)
            if blanks := [i for i, c in enumerate(text) if c.isspace()]:
                at = blanks[r.integers(len(blanks))]
                cuts.append((at + 1, at))
        for s, e in cuts:
            heads.append((text[:s], [x for x in spans if x[2] <= s]))
            tails.append((text[e:], [(k, x - e, y - e) for k, x, y in spans if x >= e]))
        for k, s, e in spans:
            known[k].append(text[s:e])
    for k, found in enumerate(known):
        for i in r.integers(0, len(found), per_kind) if found else ():
            own = varied(KINDS[k], found[i], r) if r.integers(2) else found[i]
            for new, tagged in ((own, True), (respelled(KINDS[k], own, r), True), (harmless(r), False)):
                before, spans = heads[r.integers(len(heads))]
                after, more = tails[r.integers(len(tails))]
                end = len(before) + len(new)
                mine = [(k, len(before), end)] if tagged else []
                window(before + new + after, [*spans, *mine, *((q, x + end, y + end) for q, x, y in more)], (len(before) + end) // 2)
    for i in r.integers(0, len(bare), per_kind) if bare else ():
        window(bare[i], [], len(bare[i]) // 2)
    return np.array(ids).reshape(-1, WIDTH), np.array(tags).reshape(-1, WIDTH)


def sampled(text: str) -> list[str]:
    """Stretches of a whole text to learn from."""
    of = sorted(stretches(text), key=lambda x: (crc32(text[x[0] : x[0] + MAX_LENGTH].encode("utf-8", "surrogatepass")), x))
    out = []
    for a, b in of[:MAX_STRETCHES]:
        if b - a > MAX_LENGTH:
            a += crc32(text[a : a + MAX_LENGTH].encode("utf-8", "surrogatepass")) % (b - a - MAX_LENGTH)
        out.append(text[a : min(b, a + MAX_LENGTH)])
    return out


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Tagger:
    """A tagger of MAX_SAMPLE documents at most; without any document to learn from it tags nothing."""
    rows = docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("t"), F.xxhash64(doc_id, text).alias("h"))

    def start():
        # Stretches only: neither what is sorted nor what the driver gathers grows with the length of a text.
        def call(texts):
            return [[sampled(t) for t in texts]]

        return call

    sample = lowest(rows, F.col("h"), MAX_SAMPLE, ["parts"], lambda x: appended(x, "parts array<string>", start, "t").select("h", "parts"))
    texts = [x for r in sample.orderBy("h", "parts").collect() for x in r["parts"]]
    tagger = Tagger.fresh()
    ids, tags = examples(texts)
    if not len(ids) or not tags.any():
        tagger.weights["bias"][0] = 50
        return tagger
    tagger.fit(ids, tags)
    return tagger


def find(docs: DataFrame, tagger: Tagger, text: str = "text") -> DataFrame:
    """docs with pii: array of kind, start, end (code points, end exclusive) and added, whether the tagger found it.

    Base spans of different kinds may overlap; an added one overlaps no other.  They're ordered by kind, then start.  A
    null or empty text has none; a text may be of any length, in time that grows with it.  Repeated rows are returned as
    often as they come, an empty table gives an empty one.  A column pii of docs is replaced, others keep their names.
    """

    def start():
        def call(texts):
            bases = [base_spans(t or "") for t in texts]
            where = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t or "")]
            for (i, a, b), got in zip(where, tagger.decode([texts[i][a:b] for i, a, b in where])):
                for kind, s, e, margin in got:
                    s, e = s + a, e + a
                    own = texts[i][s:e]
                    s, e = s + len(own) - len(own.lstrip()), e - len(own) + len(own.rstrip())
                    kind = told(kind, texts[i][s:e])
                    fits = margin >= MARGIN and valid(KINDS[kind], texts[i][s:e])
                    # A span mustn't cut a word or number in two.
                    clear = not (s and texts[i][s - 1].isalnum()) and not texts[i][e : e + 1].isalnum()
                    if fits and clear and all(e <= x[1] or s >= x[2] for x in bases[i]):
                        bases[i].append((kind, s, e, True))
            return [[[{"kind": KINDS[x[0]], "start": x[1], "end": x[2], "added": len(x) > 3} for x in sorted(own)] for own in bases]]

        return call

    return appended(docs, "pii array<struct<kind:string,start:int,end:int,added:boolean>>", start, text)
