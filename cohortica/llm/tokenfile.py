"""Token ids in binary files: one array of ids, and where documents end in Elias-Fano code.

A file holds, in ascending document order: the ids of all its documents one after
another (2 bytes each, 4 for vocabularies beyond 65,536), the documents' ends, the
document ids, and a short footer that says where those stand. Ends and document
ids are non-decreasing, so both are kept as Elias-Fano code: low bits as they are,
high bits in unary, with the place of every SAMPLE-th one. A document is found
by select on that code; no table of 64-bit offsets is stored or built.

Spark sorts the documents into ranges; each task writes one file as a stream and
gives one row about it. The table of these rows says which files count, so a task that
is run again, or twice, leaves at most a file that no row names.
"""

from __future__ import annotations

import atexit
import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm.bpe import byte_characters
from cohortica.llm.common import _remove, materialise, shared_dir, slices, text_of, texts_of, tidy

#: One position in so many is stored for select.
SAMPLE = 256
#: Ends a file, after the footer and its length.
MAGIC = b"EFIDS001"
#: Chunks that a worker remembers, each of CHUNK_CHARS at most; when full, the first ones stay.
REMEMBERED, CHUNK_CHARS = 400_000, 48
#: Texts go through the encoder in groups of about so many bytes; a reader holds ids of about so many bytes.
GROUP_BYTES = 1 << 21
FILES = "file int, path string, n_docs long, n_ids long, n_bytes long"


class EliasFano:
    """A non-decreasing sequence of n numbers up to u: about n * (2 + log2(u / n)) bits, and n / SAMPLE positions of 4 bytes."""

    HEAD = struct.Struct("<QQBQ")

    def __init__(self, packed: bytes):
        self.n, self.last, self.low_bits, high = self.HEAD.unpack_from(packed)
        at = self.HEAD.size
        low = (self.n * self.low_bits + 7) // 8
        self.low = np.frombuffer(packed, np.uint8, low, at)
        self.high = np.frombuffer(packed, np.uint8, high, at + low)
        self.samples = np.frombuffer(packed, "<u4", -(-self.n // SAMPLE), at + low + high)

    @classmethod
    def pack(cls, values: np.ndarray) -> bytes:
        """values: non-decreasing, uint64."""
        v = np.ascontiguousarray(values, np.uint64)
        n, last = len(v), int(v[-1]) if len(v) else 0
        bits = max(0, ((last + 1) // n).bit_length() - 1) if n else 0
        low = [np.packbits(((v[s : s + 65536, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8), bitorder="little") for s in range(0, n, 65536)] if bits else []
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        if len(unary) >= 1 << 32:
            raise ValueError("a file holds too many documents")
        unary[ones] = 1
        high = np.packbits(unary, bitorder="little")
        return b"".join([cls.HEAD.pack(n, last, bits, len(high)), *(x.tobytes() for x in low), high.tobytes(), ones[::SAMPLE].astype("<u4").tobytes()])

    def _ones(self, start: int, stop: int) -> np.ndarray:
        """Bit positions of the ones from number start to stop - 1, by the samples around them."""
        s, e = start // SAMPLE, -(-stop // SAMPLE)
        begin = int(self.samples[s])
        end = int(self.samples[e]) if e < len(self.samples) else 8 * len(self.high)
        found = np.flatnonzero(np.unpackbits(self.high[begin // 8 : -(-end // 8) + 1], bitorder="little")) + begin // 8 * 8
        found = found[found >= begin]
        return found[start - s * SAMPLE : stop - s * SAMPLE]

    def select(self, start: int, stop: int | None = None) -> np.ndarray:
        """The numbers start to stop - 1 of the sequence; one number if stop isn't given."""
        stop = start + 1 if stop is None else stop
        if not 0 <= start <= stop <= self.n:
            raise IndexError(f"{start} to {stop} of {self.n}")
        if start == stop:
            return np.zeros(0, np.uint64)
        out = (self._ones(start, stop) - np.arange(start, stop)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            a, b = start * self.low_bits, stop * self.low_bits
            bits = np.unpackbits(self.low[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a].reshape(-1, self.low_bits)
            for k in range(self.low_bits):
                out |= bits[:, k].astype(np.uint64) << np.uint64(k)
        return out

    def rank_of(self, value: int) -> int:
        """How many numbers are below value: a binary search by select."""
        a, b = 0, self.n
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if int(self.select(m)[0]) < value else (a, m)
        return a


class Chunks(dict):
    """Chunk -> ids as bytes; what isn't there is made, and remembered while there is room."""

    #: Letters in every version of Unicode, a blank before them or not: one piece, which the model can have without another cut.
    PLAIN = re.compile(" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    TAIL = ".,;:!?"

    def __init__(self, tokenizer, kind: np.dtype):
        super().__init__()
        self.tokenizer, self.kind = tokenizer, kind
        self.model, self.shown = tokenizer.model, dict(enumerate(byte_characters()))

    def __missing__(self, chunk: str) -> bytes:
        core = chunk.rstrip(self.TAIL)
        last = core[-1:]
        if len(core) < len(chunk) and last.isascii() and last.isalnum():  # a stop after an ASCII letter or number begins a piece of its own
            made = self[core] + self[chunk[len(core) :]]
        elif self.PLAIN.fullmatch(chunk):
            made = np.array([t.id for t in self.model.tokenize(chunk.encode().decode("latin-1").translate(self.shown))], self.kind).tobytes()
        else:
            made = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, self.kind).tobytes()
        if len(self) < REMEMBERED and len(chunk) <= CHUNK_CHARS:
            self[chunk] = made
        return made


class Encoder:
    """Texts to little-endian ids by the tokenizers library, as it encodes whole texts without adding special tokens.

    The library cuts a text before each run of blanks or line breaks that follows
    anything else, whatever stands around it, so such chunks can be encoded apart and
    remembered. Texts with other white space, or with a token that was added to
    the vocabulary, go to it whole, and so do all texts of tokenizers of another kind.
    """

    BLANK = r" \n\t\r"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        made = json.loads(self.tokenizer.to_str())
        cut = made["pre_tokenizer"] or {}
        byte_level = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and not made["normalizer"] and not made["post_processor"] and not made["truncation"] and not made["padding"]
        self.chunk = re.compile(f"[{self.BLANK}]*[^{self.BLANK}]+|[{self.BLANK}]+") if byte_level else None
        self.whole = re.compile("|".join([rf"[^\S{self.BLANK}]", *map(re.escape, sorted(t["content"] for t in made["added_tokens"]))]))
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = Chunks(self.tokenizer, self.kind)

    def encode_one(self, text: str) -> bytes:
        if self.chunk is None or self.whole.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()
        return b"".join(map(self.known.__getitem__, self.chunk.findall(text)))

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode_one, texts))


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One for each Python worker. The file must be installed where executors run, as the tokenizer package is."""
    return Encoder(path)


def file_system(path: str):
    """pyarrow's file system for a path or URI, and the path in it. Executors write with it, so its scheme must be one that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path) if "://" in path or path.startswith("file:") else os.path.abspath(path))


class Writer:
    """A file under way: add() documents in ascending order, null ids last, then close()."""

    def __init__(self, path: str, kind: np.dtype, end: int):
        where, at = file_system(path)
        self.out, self.kind, self.end = where.open_output_stream(at), kind, np.array([end], kind).tobytes()
        self.doc_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.nulls = 0

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        self.out.write(b"".join(chain.from_iterable((x, self.end) for x in ids)))
        given = [d for d in doc_ids if d is not None]
        self.nulls += len(doc_ids) - len(given)
        self.doc_ids.append(np.array(given, np.int64))
        self.counts.append(np.array([len(x) // self.kind.itemsize + 1 for x in ids], np.uint64))

    def close(self) -> tuple[int, int, int]:
        """Number of documents, ids and bytes."""
        ends, docs = np.cumsum(np.concatenate(self.counts), dtype=np.uint64), np.concatenate(self.doc_ids)
        first = int(docs[0]) if len(docs) else 0
        packed = EliasFano.pack(ends), EliasFano.pack(docs.view(np.uint64) - np.int64(first).view(np.uint64))
        foot = json.dumps({"docs": len(ends), "nulls": self.nulls, "ids": int(ends[-1]), "width": self.kind.itemsize, "first": first, "ends_bytes": len(packed[0]), "doc_ids_bytes": len(packed[1])}).encode()
        self.out.write(b"".join([*packed, foot, struct.pack("<I", len(foot)), MAGIC]))
        size = self.out.tell()
        self.out.close()
        return len(ends), int(ends[-1]), size


class Reader:
    """Documents of one file by number or by id."""

    def __init__(self, path: str):
        where, at = file_system(path)
        self.file = where.open_input_file(at)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        length = struct.unpack("<I", tail[:4])[0]
        self.foot = json.loads(self.file.read_at(length, size - 12 - length))
        self.kind = np.dtype(f"<u{self.foot['width']}")
        start = size - 12 - length - self.foot["ends_bytes"] - self.foot["doc_ids_bytes"]
        self.ends = EliasFano(self.file.read_at(self.foot["ends_bytes"], start))
        self.docs = EliasFano(self.file.read_at(self.foot["doc_ids_bytes"], start + self.foot["ends_bytes"]))

    def __len__(self) -> int:
        return self.foot["docs"]

    def bounds(self, start: int, stop: int) -> np.ndarray:
        """Where documents start to stop - 1 begin in the file's ids, and where the last one ends."""
        before = self.ends.select(start - 1) if start else np.zeros(1, np.uint64)
        return np.concatenate([before, self.ends.select(start, stop)]).astype(np.int64)

    def doc_ids(self, start: int, stop: int) -> list[int | None]:
        cut = min(stop, self.docs.n)
        given = (self.docs.select(start, cut) + np.int64(self.foot["first"]).view(np.uint64)).view(np.int64).tolist() if start < cut else []
        return given + [None] * (stop - start - len(given))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids number start to stop - 1 of the file."""
        w = self.kind.itemsize
        return np.frombuffer(self.file.read_at((stop - start) * w, start * w), self.kind)

    def document(self, number: int) -> np.ndarray:
        """The ids of a document, its end id last."""
        a, b = self.bounds(number, number + 1)
        return self.ids(int(a), int(b))

    def find(self, doc_id: int) -> int | None:
        """The number of the first document of this id, by a binary search over the coded ids."""
        at = self.docs.rank_of(max(0, doc_id - self.foot["first"])) if doc_id >= self.foot["first"] else self.docs.n
        return at if at < self.docs.n and self.doc_ids(at, at + 1) == [doc_id] else None

    def documents(self, size: int = GROUP_BYTES) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """Document ids, bounds and ids of runs of documents; a run has about `size` bytes of ids, one document at least."""
        at = 0
        while at < len(self):
            stop = min(len(self), at + 4096)
            bounds = self.bounds(at, stop)
            take = max(1, int(np.searchsorted(bounds, bounds[0] + size // self.kind.itemsize, "right")) - 1)
            stop = min(stop, at + take)
            bounds = bounds[: stop - at + 1]
            yield self.doc_ids(at, stop), bounds, self.ids(int(bounds[0]), int(bounds[-1]))
            at = stop


def write_files(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None, files: int | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes docs (key: an integer type) as files of ascending key into folder, and gives FILES, a row for each file, in that order of `file`.

    A null text is the empty one: its document is the end id alone. Null keys come
    last. Rows of one key are ordered by their text's hash, and repeated rows each
    have a place. Other columns are not looked at. An empty table gives no files.
    files: the number of ranges, the session's number of shuffle partitions if not
    given; a file holds its documents' bounds in memory while it is written. Without a
    folder, one in the shared folder is made and removed when the driver ends.
    """
    spark = docs.sparkSession
    if folder is None:
        folder = f"{shared_dir(spark)}/cohortica-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, folder)
    where, at = file_system(folder)
    where.create_dir(at, recursive=True)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        out, path = None, f"{folder}/ids-{part:06d}-{uuid.uuid4().hex}.bin"
        for b in slices(batches, GROUP_BYTES):
            out = out or Writer(path, enc.kind, end)
            out.add(b.column("k").to_pylist(), enc.encode(texts_of(b)))
        if out:
            yield pa.RecordBatch.from_pydict({"file": pa.array([part], pa.int32()), "path": [path], **{n: pa.array([v], pa.int64()) for n, v in zip(("n_docs", "n_ids", "n_bytes"), out.close(), strict=True)}})

    order = [F.col("k").asc_nulls_last(), F.xxhash64("text")]
    ranged = docs.select(F.col(key).cast("long").alias("k"), text_of(text).alias("text")).repartitionByRange(files, *order).sortWithinPartitions(*order)
    return materialise(ranged.mapInArrow(tidy(run), FILES))


def _placed(spark: SparkSession, files: DataFrame) -> DataFrame:
    """path, base (ids in all files before): a row and a task for each file; files are as many as their writer's ranges."""
    before, rows = 0, []
    for r in files.orderBy("file").select("path", "n_ids").collect():
        rows.append((r["path"], before))
        before += r["n_ids"]
    return spark.createDataFrame(rows, "path string, base long").repartition(max(1, len(rows)))


def read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), ids (array<int>, the end id last) of all documents of write_files's files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in ((p, s) for b in batches for p, s in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True)):
            for docs, bounds, ids in Reader(path).documents():
                lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(bounds[:-1] + base), lists], ["doc_id", "start", "ids"])

    return _placed(spark, files).mapInArrow(run, "doc_id long, start long, ids array<int>")


def digests(spark: SparkSession, files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit little-endian numbers) of all documents of the files, digested where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, base in ((p, s) for b in batches for p, s in zip(b.column("path").to_pylist(), b.column("base").to_pylist(), strict=True)):
            for docs, bounds, ids in Reader(path).documents():
                wide, at = memoryview(ids.astype("<u4").tobytes()), 4 * (bounds - bounds[0])
                crc = [zlib.crc32(wide[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(bounds[:-1] + base), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _placed(spark, files).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
