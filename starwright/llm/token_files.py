"""Token-ID files of independent zstandard frames with a trailing seek table.

One file holds the documents of one range of ids, in order:

* a frame for each document (more, of ``FRAME_IDS`` ids each, for a very long
  one) with its ids as little-endian unsigned 32-bit integers;
* a skippable frame with the index: for each document its id, whether the id is
  null, and how many frames it has;
* a skippable frame with the seek table: for each frame the compressed and the
  plain size and a checksum (low 32 bits of XXH64 of the plain bytes), then the
  number of frames, a flag byte and the magic number.

This is the public seekable zstandard format, so any zstandard reader can
decompress the whole file, and a reader of single documents seeks to their
frames alone.  A task writes its file under a name of its own attempt; only the
files that successful tasks report enter the manifest, so retried and
speculative attempts leave no double documents.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starwright.llm.common import map_batches

# Fixed values of the seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frames", "<u4")])

# Fixed value: the space byte in the vocabulary of a byte-level tokenizer.
SPACE_BYTE = "\u0120"

#: Chunks that go to the library as one string, at most, and characters of texts encoded
#: together (a longer text goes alone).
TOGETHER, CHARACTERS = 500, 8 << 20
#: Ids in a frame at most.
FRAME_IDS = 1 << 22
LEVEL = 3


def _file(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one open file; ``close`` adds index and seek table."""

    def __init__(self, out):
        self.out, self.pack = out, zstandard.ZstdCompressor(level=LEVEL).compress
        self.entries: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` is the document's ids as little-endian 32-bit integers."""
        frames = [ids[i:i + 4 * FRAME_IDS] for i in range(0, len(ids), 4 * FRAME_IDS)] or [b""]
        for plain in frames:
            packed = self.pack(plain)
            self.out.write(packed)
            checksum = xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF
            self.entries.append((len(packed), len(plain), checksum))
        self.docs.append((doc_id or 0, doc_id is None, len(frames)))

    def close(self) -> None:
        index = np.array(self.docs, INDEX).tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.entries, ENTRY).tobytes()
        footer = struct.pack("<IBI", len(self.entries), CHECKSUMS, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table) + len(footer)) + table + footer)


class Reader:
    """Reads single documents of one open random-access file."""

    def __init__(self, source):
        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        head = size - 9 - n * ENTRY.itemsize - 8
        magic, length = struct.unpack("<II", self._at(head, 8))
        if magic != SEEK_MAGIC or length != n * ENTRY.itemsize + 9:
            raise ValueError("broken seek table")
        self.entries = np.frombuffer(self._at(head + 8, n * ENTRY.itemsize), ENTRY)
        self.ends = np.cumsum(self.entries["packed"], dtype=np.int64)
        start = int(self.ends[-1]) if n else 0
        magic, length = struct.unpack("<II", self._at(start, 8))
        if magic != INDEX_MAGIC or start + 8 + length != head:
            raise ValueError("broken index")
        self.docs = np.frombuffer(self._at(start + 8, length), INDEX)
        self.last = np.cumsum(self.docs["frames"], dtype=np.int64)

    def _at(self, start: int, length: int) -> bytes:
        self.source.seek(start)
        data = self.source.read(length)
        if len(data) != length:
            raise ValueError("truncated file")
        return data

    def doc_id(self, k: int) -> int | None:
        return None if self.docs["null"][k] else int(self.docs["doc_id"][k])

    def ids(self, k: int) -> bytes:
        """The bytes of document ``k``, each of its frames checked."""
        parts = []
        for f in range(int(self.last[k]) - int(self.docs["frames"][k]), int(self.last[k])):
            packed, plain, checksum = (int(x) for x in self.entries[f])
            data = self.unpack(self._at(int(self.ends[f]) - packed, packed),
                               max_output_size=plain) if plain else b""
            if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {f}: wrong checksum")
            parts.append(data)
        return b"".join(parts)


class CachedEncoder:
    """Ids of a text as little-endian 32-bit integers by the tokenizers library,
    which encodes each distinct chunk before a space once while it is cached.

    Cutting at spaces gives the library's own ids because its pre-tokenizer
    always cuts there; see ``bpe.space_chunks``.  For the same reason the chunks
    of a text that aren't cached go to the library as one string: each begins
    with its only space, so the tokens that begin with a space part them.  A
    text with one of the vocabulary's special strings is encoded whole."""

    def __init__(self, vocabulary: str, entries: int = 600_000):
        from tokenizers import Tokenizer

        from starwright.llm.bpe import Cache, one_chunk, space_chunks

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache, self.chunks, self.one_chunk = Cache(entries), space_chunks, one_chunk
        tokens = self.tokenizer.get_vocab()
        self.first = np.zeros(max(tokens.values()) + 1, bool)
        self.first[[i for t, i in tokens.items() if t.startswith(SPACE_BYTE)]] = True

    def whole(self, text: str) -> bytes:
        found, = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, "<u4").tobytes()

    def joined(self, chunks: list[str]) -> list[bytes]:
        """The ids of chunks that begin with a space and something else behind it."""
        data = self.whole("".join(chunks))
        starts = (4 * np.flatnonzero(self.first[np.frombuffer(data, "<u4")])).tolist()
        return [data[a:b] for a, b in zip(starts, [*starts[1:], len(data)], strict=True)]

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        chunks, cache = self.chunks(text), self.cache
        found = [cache.young.get(c) or cache.kept(c) for c in chunks]
        new = {chunks[k]: b"" for k, x in enumerate(found) if x is None}
        plain = [c for c in new if c[0] == " " and not c[1:2].isspace() and c != " "]
        if " " in "".join([c[1:] for c in plain]):  # a text that stays one chunk
            plain = []
        new.update(zip(plain, self.joined(plain) if plain else [], strict=True))
        for chunk, ids in new.items():
            new[chunk] = ids = ids or self.whole(chunk)
            cache.keep(chunk, ids)
        return b"".join([new[c] if x is None else x for c, x in zip(chunks, found, strict=True)])

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; what the texts share is looked up once.  Their chunks go
        as numbers, so only distinct ones become Python strings."""
        alone = [any(s in t for s in self.special) or self.one_chunk(t) is not None
                 for t in texts]
        split = pc.split_pattern(pa.array(["" if x else t for x, t in zip(alone, texts,
                                           strict=True)], pa.large_string()), " ")
        ends = split.offsets.to_numpy()
        parts = split.flatten().dictionary_encode()
        number = parts.indices.to_numpy().astype(np.int64)
        heads = _strings(parts.take(pa.array(ends[:-1])).cast(pa.large_string()))
        number[ends[:-1]] = len(parts.dictionary) + np.arange(len(texts))   # no space before
        used = np.zeros(len(parts.dictionary) + len(texts), bool)
        used[number] = True
        chunks = [f" {c}" for c in _strings(parts.dictionary)] + heads
        found = self.looked_up(list(compress(chunks, used.tolist())))
        lengths = np.zeros(len(used), np.int64)
        lengths[used] = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        starts = np.cumsum(lengths) - lengths
        each = lengths[number]
        until = np.cumsum(each)
        made = ids[np.repeat(starts[number] - until + each, each) + np.arange(each.sum())]
        data, bounds = made.tobytes(), 4 * np.concatenate([[0], until])[ends]
        return [self.encode(t) if x else data[a:b] for x, t, a, b in
                zip(alone, texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def looked_up(self, chunks: list[str]) -> list[bytes]:
        """The ids of each of the chunks, an empty one's are none."""
        found = list(map(self.cache.young.get, chunks))
        lacking = [k for k, x in enumerate(found) if x is None]
        if self.cache.old:
            for k in lacking:
                found[k] = self.cache.old.get(chunks[k])
        plain = [k for k in lacking if found[k] is None and (c := chunks[k])[:1] == " "
                 and c != " " and not c[1].isspace() and " " not in c[1:]]
        for first in range(0, len(plain), TOGETHER):
            some = plain[first:first + TOGETHER]
            for k, ids in zip(some, self.joined([chunks[k] for k in some]), strict=True):
                found[k] = ids
        for k in lacking:
            found[k] = found[k] or (self.whole(chunks[k]) if chunks[k] else b"")
        self.cache.keep_all([(c, found[k]) for k in lacking if (c := chunks[k])])
        return found


@lru_cache(maxsize=1)
def cached_encoder(vocabulary: str) -> CachedEncoder:
    """One encoder for all tasks that a worker process runs, so the next task
    finds what the last one cached."""
    return CachedEncoder(vocabulary)


def _strings(column: pa.Array) -> list[str]:
    return column.to_numpy(zero_copy_only=False).tolist()


def _groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """The first and the last (not included) of texts that are encoded together."""
    first = size = 0
    for at, text in enumerate(texts):
        if at > first and size + len(text or "") > CHARACTERS:
            yield first, at
            first, size = at, 0
        size += len(text or "")
    if texts:
        yield first, len(texts)


def write_token_files(docs: DataFrame, folder: str, encoder: Callable[[], Callable[[str], bytes]],
                      end_id: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text", together: bool = False) -> DataFrame:
    """Writes all rows of ``docs`` in ascending ``id_col`` (nulls first, rows of
    one id by text) under ``folder`` and returns the manifest: ``part``,
    ``path``, ``docs``, ``ids`` and ``start``, the ids of all files before it.

    ``encoder()`` runs once per task and returns a function from a text to its
    ids' bytes, or with ``together`` from some texts to theirs.  A null text counts as empty; ``end_id`` is appended to each
    document.  Without documents there is no file.  The manifest has a row for
    each file, so it goes through the driver."""
    spark = docs.sparkSession
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode, writer, n = TaskContext.get().partitionId(), None, None, 0
        for batch in batches:
            keys, texts = (c.to_pylist() for c in batch.columns)
            if texts and writer is None:
                made = encoder()
                encode = made if together else lambda some: list(map(made, some))
                uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zst"
                system, path = _file(uri)
                system.create_dir(path.rpartition("/")[0], recursive=True)
                writer = Writer(system.open_output_stream(path, compression=None))
            for first, last in _groups(texts):
                some = encode([t or "" for t in texts[first:last]])
                for doc_id, ids in zip(keys[first:last], some, strict=True):
                    ids += end
                    writer.add(doc_id, ids)
                    n += len(ids) // 4
        if writer:
            writer.close()
            writer.out.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": uri, "docs": len(writer.docs), "ids": n}])

    ranged = (docs.select(F.col(id_col).cast("long").alias("id"),
                          F.col(text_col).cast("string").alias("text"))
              .repartitionByRange("id").sortWithinPartitions("id", "text"))
    files = sorted(ranged.mapInArrow(run, "part long, path string, docs long, ids long").collect())
    starts = np.cumsum([0, *(f.ids for f in files)]).tolist()
    return spark.createDataFrame([(*f, s) for f, s in zip(files, starts, strict=False)],
                                 "part long, path string, docs long, ids long, start long")


def read_token_files(manifest: DataFrame, schema: str,
                     result: Callable[[bytes], tuple],
                     wanted: Iterable[int] | None = None) -> DataFrame:
    """``doc_id``, ``start`` (ids before it in all files) and the columns of
    ``schema`` that ``result`` makes of a document's ids, for all documents or
    for the ``wanted`` ids; only their frames are read and decompressed."""
    spark: SparkSession = manifest.sparkSession
    chosen = None if wanted is None else frozenset(wanted)

    def start():
        def step(paths: list, starts: list) -> Iterator[list]:
            for uri, first in zip(paths, starts, strict=True):
                system, path = _file(uri)
                with system.open_input_file(path) as source:
                    reader = Reader(source)
                    plain = np.concatenate([[0], np.cumsum(reader.entries["plain"], dtype="i8")])
                    begins = plain[reader.last - reader.docs["frames"]] // 4 + first
                    rows = []
                    for k in range(len(reader.docs)):
                        if chosen is None or reader.doc_id(k) in chosen:
                            rows.append((reader.doc_id(k), int(begins[k]), *result(reader.ids(k))))
                        if len(rows) == 4096:
                            yield list(map(list, zip(*rows, strict=True)))
                            rows = []
                    if rows:
                        yield list(map(list, zip(*rows, strict=True)))
        return step

    n = max(1, min(manifest.count(), 4 * spark.sparkContext.defaultParallelism))
    return map_batches(manifest.select("path", "start").repartition(n),
                       f"doc_id long, start long, {schema}", start)
