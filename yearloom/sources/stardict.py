"""Dictionary files as a Spark data source: .ifo, .idx, .syn and compressed bodies of one book each.

Writing: rows come sorted by book, kind and key, so a task writes its books as streams: bodies go to chunks of CHUNK bytes
that are compressed each by itself, words to the index, synonyms to theirs.  Files are written to a folder beside the
books and moved when all tasks are done; a book's .ifo comes last, and a book without one isn't there.

Reading: the table of chunks makes bodies addressable, so a book's entries are dealt to as many tasks as its bodies have
portions of SPLIT bytes, and a task decompresses no chunk but those of its own entries.

The format bounds a book: offsets have 32 bits, and the table of chunks fits a header field of 64 KB.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.window import Window as W

#: Bytes of a chunk, and the most chunks that the header's field can list (fixed values of the format).
CHUNK, MOST_CHUNKS = 58_315, (65_535 - 10) // 2
MAGIC = "StarDict's dict ifo file"
#: Bytes of bodies that a reading task takes, and rows of one batch.
SPLIT, ROWS = 32 << 20, 1_000
ENTRY, SYNONYM = 0, 1
WRITTEN = "book string, kind int, key string, word string, n long, body string"
READ = "book string, n long, headwords array<string>, body string"
PARTS = (".ifo", ".idx", ".syn", ".dict.dz")


def _store(folder: str):
    """A file system and the folder's path in it."""
    from pyarrow import fs

    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder if "://" in folder else folder.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), folder


class Chunks:
    """Writes bodies chunk by chunk; the header lists the chunks' sizes, so they wait in a file of their own."""

    def __init__(self, store, path: str):
        self.store, self.path = store, path
        self.out = store.open_output_stream(path + ".chunks", compression=None)
        self.packer = None
        self.held, self.sizes, self.size, self.crc = bytearray(), [], 0, 0

    def add(self, data: bytes) -> None:
        self.held += data
        self.size += len(data)
        self.crc = zlib.crc32(data, self.crc)
        while len(self.held) >= CHUNK:
            self._pack(bytes(self.held[:CHUNK]))
            del self.held[:CHUNK]

    def _pack(self, data: bytes) -> None:
        # A full flush ends the chunk at a byte and forgets what came before.
        packer = zlib.compressobj(9, zlib.DEFLATED, -15)
        packed = packer.compress(data) + packer.flush(zlib.Z_FULL_FLUSH)
        self.out.write(packed)
        self.sizes.append(len(packed))
        if len(self.sizes) > MOST_CHUNKS:
            raise ValueError(f"{self.path}: more bodies than one book can hold")

    def close(self) -> None:
        if self.held:
            self._pack(bytes(self.held))
        self.out.close()
        table = struct.pack(f"<HHH{len(self.sizes)}H", 1, CHUNK, len(self.sizes), *self.sizes)
        extra = b"RA" + struct.pack("<H", len(table)) + table
        with self.store.open_output_stream(self.path, compression=None) as out:
            out.write(b"\x1f\x8b\x08\x04" + bytes(4) + b"\x02\x03" + struct.pack("<H", len(extra)) + extra)
            with self.store.open_input_stream(self.path + ".chunks", compression=None) as packed:
                while block := packed.read(1 << 20):
                    out.write(block)
            out.write(b"\x03\x00" + struct.pack("<II", self.crc, self.size & 0xFFFFFFFF))
        self.store.delete_file(self.path + ".chunks")


class Bodies:
    """Random access to compressed bodies; keeps the chunk met last."""

    def __init__(self, store, path: str):
        self.file = store.open_input_file(path)
        head = self.file.read(12)
        (n,) = struct.unpack("<H", head[10:12])
        extra = self.file.read(n)
        _, self.chunk, count = struct.unpack("<HHH", extra[4:10])
        sizes = struct.unpack(f"<{count}H", extra[10 : 10 + 2 * count])
        self.starts = [12 + n]
        for s in sizes:
            self.starts.append(self.starts[-1] + s)
        self.kept, self.data, self.read = -1, b"", 0

    def at(self, offset: int, size: int) -> bytes:
        out = bytearray()
        while size > 0:
            k, start = divmod(offset, self.chunk)
            if k != self.kept:
                self.file.seek(self.starts[k])
                self.data = zlib.decompressobj(-15).decompress(self.file.read(self.starts[k + 1] - self.starts[k]))
                self.kept, self.read = k, self.read + 1
            part = self.data[start : start + size]
            out += part
            offset, size = offset + len(part), size - len(part)
            if not part:
                raise EOFError("the index points beyond the bodies")
        return bytes(out)


def _numbered_words(store, path: str, tail: int) -> Iterator[tuple[str, bytes]]:
    """(word, the tail bytes behind it) of an index or a list of synonyms, read as a stream."""
    with store.open_input_stream(path, compression=None) as file:
        held, at = b"", 0
        while True:
            end = held.find(b"\0", at)
            if end < 0 or end + tail >= len(held):
                more = file.read(1 << 20)
                if not more:
                    return
                held, at = held[at:] + more, 0
                continue
            yield held[at:end].decode(), held[end + 1 : end + 1 + tail]
            at = end + 1 + tail


def described(store, path: str) -> dict[str, str]:
    with store.open_input_stream(path, compression=None) as file:
        lines = file.read().decode().split("\n")
    return dict(x.split("=", 1) for x in lines[1:] if "=" in x)


def listed(folder: str) -> list[str]:
    """The books of a folder."""
    from pyarrow import fs

    store, path = _store(folder)
    files = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(unquote(f.base_name.removesuffix(".ifo")) for f in files if f.base_name.endswith(".ifo"))


@dataclass
class Portion(InputPartition):
    """Entries first..last of a book."""

    book: str
    first: int
    last: int


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class Reader(DataSourceReader):
    def __init__(self, folder: str, book: str | None, split: int):
        self.folder, self.book, self.split = folder, book, split

    def partitions(self) -> list[InputPartition]:
        store, path = _store(self.folder)
        out = []
        for book in [self.book] if self.book is not None else listed(self.folder):
            told = described(store, f"{path}/{quote(book, safe='')}.ifo")
            words, size = int(told["wordcount"]), int(told["bodysize"])
            parts = min(words, size // self.split + 1) or 1
            out += [Portion(book, words * k // parts, words * (k + 1) // parts) for k in range(parts)]
        return out

    def read(self, partition: Portion | None) -> Iterator:
        import pyarrow as pa

        if partition is None:  # no books
            return
        store, path = _store(self.folder)
        stem, first, last = f"{path}/{quote(partition.book, safe='')}", partition.first, partition.last
        synonyms: dict[int, list[str]] = {}
        for word, tail in _numbered_words(store, stem + ".syn", 4):
            n = int.from_bytes(tail)
            if first <= n < last:
                synonyms.setdefault(n, []).append(word)
        bodies, rows = Bodies(store, stem + ".dict.dz"), []

        def batch() -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.string(), pa.int64(), pa.list_(pa.string()), pa.string()))]
            return pa.RecordBatch.from_arrays(columns, names=["book", "n", "headwords", "body"])

        for n, (word, tail) in enumerate(_numbered_words(store, stem + ".idx", 8)):
            if n >= last:
                break
            if n >= first:
                body = bodies.at(int.from_bytes(tail[:4]), int.from_bytes(tail[4:]))
                rows.append((partition.book, n, [word, *synonyms.get(n, [])], body.decode()))
                if len(rows) == ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


class Writer(DataSourceArrowWriter):
    def __init__(self, folder: str, overwrite: bool):
        self.folder, self.overwrite, self.beside = folder, overwrite, f"_new-{uuid4().hex}"

    def write(self, iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        store, path = _store(self.folder)
        task = f"{path}/{self.beside}/{TaskContext.get().taskAttemptId()}"
        store.create_dir(task, recursive=True)
        names, book, files = [], None, None

        def finish() -> None:
            if book is not None:
                files.close()
                names.append(f"{TaskContext.get().taskAttemptId()}/{quote(book, safe='')}")

        for part in iterator:
            for b, kind, _, word, n, body in zip(*(c.to_pylist() for c in part.columns)):
                if b != book:
                    finish()
                    book, files = b, _Book(store, f"{task}/{quote(b, safe='')}", b)
                files.add(kind, word, n, body)
        finish()
        return Written(names)

    def commit(self, messages: list) -> None:
        store, path = _store(self.folder)
        new = [x for m in messages if m is not None for x in m.names]
        if self.overwrite:
            for book in listed(self.folder):
                for end in PARTS:
                    store.delete_file(f"{path}/{quote(book, safe='')}{end}")
        for end in (*PARTS[1:], PARTS[0]):
            for x in new:
                store.move(f"{path}/{self.beside}/{x}{end}", f"{path}/{x.split('/')[1]}{end}")
        self._clear(store, path)

    def abort(self, messages: list) -> None:
        self._clear(*_store(self.folder))

    def _clear(self, store, path: str) -> None:
        from pyarrow import fs

        if store.get_file_info(f"{path}/{self.beside}").type == fs.FileType.Directory:
            store.delete_dir(f"{path}/{self.beside}")


class _Book:
    """The files of a book as they are written."""

    def __init__(self, store, stem: str, name: str):
        self.store, self.stem, self.name = store, stem, name
        self.idx, self.syn = (store.open_output_stream(stem + x, compression=None) for x in (".idx", ".syn"))
        self.bodies = Chunks(store, stem + ".dict.dz")
        self.words = self.synonyms = self.idx_size = 0

    def add(self, kind: int, word: str, n: int, body: str | None) -> None:
        head = word.encode() + b"\0"
        if kind == SYNONYM:
            self.syn.write(head + n.to_bytes(4))
            self.synonyms += 1
            return
        data = (body or "").encode()
        self.idx.write(head + self.bodies.size.to_bytes(4) + len(data).to_bytes(4))
        self.idx_size += len(head) + 8
        self.bodies.add(data)
        self.words += 1

    def close(self) -> None:
        self.idx.close()
        self.syn.close()
        self.bodies.close()
        told = {"version": "2.4.2", "bookname": self.name, "wordcount": self.words, "synwordcount": self.synonyms, "idxfilesize": self.idx_size, "sametypesequence": "h", "bodysize": self.bodies.size}
        with self.store.open_output_stream(self.stem + ".ifo", compression=None) as out:
            out.write("\n".join([MAGIC, *(f"{k}={v}" for k, v in told.items()), ""]).encode())


class Source(DataSource):
    """Format stardict; options path, and for reading book (one book only) and split (bytes of bodies a task)."""

    @classmethod
    def name(cls) -> str:
        return "stardict"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"], self.options.get("book"), int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], overwrite)


def _known(spark: SparkSession) -> None:
    """Makes the format known to a session.  Formats are looked up in the active session of a thread, which a thread of the
    caller's own doesn't have."""
    spark.dataSource.register(Source)
    spark._jvm.org.apache.spark.sql.classic.SparkSession.setActiveSession(spark._jsparkSession)


def write(entries: DataFrame, folder: str, book: str = "book", mode: str = "overwrite") -> None:
    """Dictionaries of entries(book, headwords, body), a book's words in the byte order of their lower-cased form.

    The first headword is an entry's own, the others point to it.  Entries without headwords are left out, a null body is
    empty, and equal headwords stay.  A book is the work of one task, as the format makes it one stream of at most 2 GB;
    its synonyms are sorted beside its entries, so that a task holds one entry at a time.
    """
    _known(entries.sparkSession)
    usable = entries.where(F.size("headwords") > 0).select(F.col(book).cast("string").alias("book"), "headwords", "body").where("book IS NOT NULL").repartition("book")
    word = F.get("headwords", F.lit(0))
    n = F.row_number().over(W.partitionBy("book").orderBy(F.lower(word), word, "body")) - 1
    usable = usable.withColumn("n", n.cast("long"))

    def row(kind: int, w, body):
        return F.struct(F.lit(kind).alias("kind"), F.lower(w).alias("key"), w.alias("word"), F.col("n").alias("n"), body.alias("body"))

    others = F.slice("headwords", F.lit(2), F.size("headwords"))
    synonyms = F.transform(others, lambda w: row(SYNONYM, w, F.lit(None).cast("string")))
    rows = usable.select("book", F.inline(F.concat(F.array(row(ENTRY, word, F.col("body"))), synonyms)))
    rows.sortWithinPartitions("book", "kind", "key", "word", "n").select("book", "kind", "key", "word", "n", "body").write.format("stardict").mode(mode).option("path", folder).save()


def read(spark: SparkSession, folder: str, book: str | None = None, split: int = SPLIT) -> DataFrame:
    """(book, n, headwords, body) of the dictionaries in a folder, or of one book."""
    _known(spark)
    reader = spark.read.format("stardict").option("split", split)
    return (reader if book is None else reader.option("book", book)).load(folder)


def books(spark: SparkSession, folder: str) -> DataFrame:
    """(book, entries, synonyms, bytes, parts) of a folder: a row for each book, as its files are listed."""
    from pyarrow import fs

    store, path = _store(folder)
    rows = []
    for book in listed(folder):
        stem = f"{path}/{quote(book, safe='')}"
        told = described(store, stem + ".ifo")
        files = {x: store.get_file_info(stem + x) for x in PARTS}
        parts = [x[1:] for x, f in files.items() if f.type == fs.FileType.File and (f.size or x == ".syn")]
        rows.append((book, int(told["wordcount"]), int(told["synwordcount"]), sum(f.size or 0 for f in files.values()), sorted(parts)))
    return spark.createDataFrame(rows, "book string, entries long, synonyms long, bytes long, parts array<string>")


def body_at(folder: str, book: str, n: int) -> tuple[str, int]:
    """The n-th body of a book and how many chunks were decompressed for it."""
    store, path = _store(folder)
    stem = f"{path}/{quote(book, safe='')}"
    for k, (_, tail) in enumerate(_numbered_words(store, stem + ".idx", 8)):
        if k == n:
            bodies = Bodies(store, stem + ".dict.dz")
            return bodies.at(int.from_bytes(tail[:4]), int.from_bytes(tail[4:])).decode(), bodies.read
    raise IndexError(n)
