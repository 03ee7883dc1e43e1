"""Packing: token sequences of equal attention cost.

A piece of n tokens costs n + n * n / COST_SPLIT: the linear layers and its own attention square.  Within a block of
documents, whole sequences are cut from those longer than a sequence; the rests go, longest first, to the sequence of
lowest cost that has room, and what fits nowhere whole is cut to fill the room that is left.  The tail of a block becomes
sequences whose lengths are powers of two, which need no padding either.  Blocks are filled inside a Spark partition and
hold at most BLOCK_TOKENS tokens besides one document, so nothing moves between tasks and memory is bounded.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

SEQUENCE = 2048
#: Tokens at which a piece's attention costs as much as its linear layers.
COST_SPLIT = 4096
BLOCK_TOKENS = 1 << 20
END = 1
#: Distinct words whose ids a task remembers, twice: those met since, and as many before.
WORDS_KEPT = 150_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Texts and words of ASCII and Latin-1 letters: composed already, and split below as the tokenizer splits them.
PLAIN_TEXT = re.compile("[\n !-~À-ÖØ-öø-ÿ]*")
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]*")
PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9\n ]+")


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]


def encoder(path: str) -> Callable[[list[str]], list[np.ndarray]]:
    """Ids of whole texts, by the tokenizer in a file.

    Its pre-tokenizer parts a text at blanks, marks and digits.  A plain text is parted here, and each distinct part put
    together once by the vocabulary's merges; of any other text the distinct words are, those that aren't plain by the
    tokenizer as a whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merges, letters = tokenizer.model, dict(enumerate(byte_letters()))

    def part_ids(part: str) -> bytes:
        spelled = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
        return array("I", [t.id for t in merges.tokenize(spelled)]).tobytes()

    def word_ids(word: str) -> bytes:
        if "<|" in word or not PLAIN.fullmatch(word):
            return array("I", tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return b"".join([part_ids(part) for part in PARTS.findall(word.lower())])

    class Known(dict):
        """Ids of the units met last; those in use outlive those met once when the memory turns over."""

        def __init__(self, learn: Callable[[str], bytes]):
            self.learn, self.older = learn, {}

        def __missing__(self, unit: str) -> bytes:
            ids = self.older.get(unit)
            if ids is None:
                ids = self.learn(unit)
            if len(self) >= WORDS_KEPT:
                self.older = dict(self)
                self.clear()
            self[unit] = ids
            return ids

    parts, words = Known(part_ids), Known(word_ids)

    def encoded(text: str) -> np.ndarray:
        if PLAIN_TEXT.fullmatch(text) and "<|" not in text:
            units, known = PARTS.findall(text.lower()), parts
        else:
            units, known = [w for w in text.replace("\n", " ").split(" ") if w], words
        return np.frombuffer(b"".join(map(known.__getitem__, units)), "<u4")

    return lambda texts: [encoded(t) for t in texts]


def pack(sizes: list[int], capacity: int = SEQUENCE, slack: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece, for documents of these many tokens.

    Without slack every sequence but the block's tail is filled to capacity, and what fits nowhere whole is cut.  With it
    the block has so many more sequences, as a share, which leaves room (and padding) for documents to stay whole.  Ties go
    to the earlier document and the earlier sequence.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    rests: list[tuple[int, int, int]] = []
    sequence = 0
    for d, n in enumerate(sizes):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((d, start, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            rests.append((-(n % capacity), d, n - n % capacity))
    rests.sort()
    total = -sum(r[0] for r in rests)
    # The room to fill: full sequences, then the binary digits of what remains.
    room = [capacity] * (total // capacity + int(total // capacity * slack)) + [1 << b for b in range(capacity.bit_length())[::-1] if (total % capacity) >> b & 1]
    size, cost = room[:], [0.0] * len(room)
    order = [(0.0, k) for k in range(len(room))]
    heapq.heapify(order)

    def put(d: int, start: int, n: int, k: int) -> None:
        pieces.append((d, start, n, sequence + k, size[k] - room[k]))
        room[k] -= n
        cost[k] += n + n * n / COST_SPLIT
        if room[k]:
            heapq.heappush(order, (cost[k], k))

    for n, d, start in rests:
        n, passed = -n, []
        while order and room[order[0][1]] < n:
            passed.append(heapq.heappop(order))
        if order:
            k = heapq.heappop(order)[1]
            for x in passed:
                heapq.heappush(order, x)
            put(d, start, n, k)
            continue
        for at, (_, k) in enumerate(sorted(passed, key=lambda x: (-room[x[1]], x))):  # nowhere whole: fill the widest room first
            take = min(n, room[k])
            if take:
                put(d, start, take, k)
                start, n = start + take, n - take
            else:
                heapq.heappush(order, (cost[k], k))
    return pieces


def pack_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", slack: float = 0.0) -> DataFrame:
    """One row per piece of every document: where its ids lie in which sequence.

    Each partition of docs is packed by itself: its last block ends in sequences of powers of two, into which documents
    are cut, however few they are.  slack is that of pack().

    A document is its ids and the id 1; a null or empty text is that id alone, and a null doc_id stays null.  Equal rows are
    packed as often as they come; a text may be of any length, an empty table has no pieces.  Each id lies in exactly one
    piece; pieces of a sequence follow one another from offset 0.  Other columns of docs are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        first, sequences = TaskContext.get().partitionId() << 40, 0
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequences, held, ids, tokens
            rows = pack([len(t) for t in tokens], slack=slack)
            out = [
                (ids[d], s, n, zlib.crc32(tokens[d][s : s + n].tobytes()), len(tokens[d]), first + sequences + q, o) for d, s, n, q, o in rows
            ]
            sequences += 1 + max(q for *_, q, _ in rows)
            ids, tokens, held = [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                for i, own in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()])):
                    ids.append(i)
                    tokens.append(np.append(own, np.uint32(END)))
                    held += len(own) + 1
                    if held >= BLOCK_TOKENS:
                        yield flush()
        if ids:
            yield flush()

    return docs.select(doc_id, text).mapInArrow(run, SCHEMA)
