"""SPSS system files as a Spark data source: spark.read.format("spss").load(path).

Numbers are doubles, dates and times by their print format, strings without their
trailing blanks. A plain file is cut into partitions of whole cases; a compressed one can't be
entered midway, so it is one. Strings of more than 255 bytes are an error, not cut short.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the format: print formats of dates and of points in time, and seconds from 14 October 1582 to 1 January 1970.
DATES, TIMES, EPOCH = {20, 23, 24, 28, 29, 30, 38, 39}, {22, 41}, 12_219_379_200
#: Bytes of cases that a partition of a plain file, and a batch, hold.
PARTITION_BYTES, BATCH_BYTES = 64 << 20, 4 << 20


@dataclass
class Variable:
    """at: its place in a case, in units of eight bytes. width: of a string in bytes, 0 for a number. missing: values that its user called missing."""

    name: str
    width: int
    format: int
    at: int
    low: float | None = None
    high: float | None = None
    missing: list = field(default_factory=list)

    @property
    def type(self) -> T.DataType:
        return T.StringType() if self.width else T.DateType() if self.format in DATES else T.TimestampNTZType() if self.format in TIMES else T.DoubleType()


@dataclass
class Dictionary:
    variables: list[Variable]
    units: int
    order: str
    compression: int
    bias: float
    encoding: str
    start: int


def opened(path: str):
    """The file at a path or URI that executors can reach."""
    import os

    from pyarrow import fs

    system, where = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))
    return system.open_input_file(where)


def read_dictionary(f, encoding: str | None = None) -> Dictionary:
    """What stands before the cases."""
    head = f.read(176)
    if head[:4] not in (b"$FL2", b"$FL3"):
        raise ValueError("not an SPSS system file")
    order = "<" if struct.unpack("<i", head[64:68])[0] in (2, 3) else ">"
    whole = lambda n=1: struct.unpack(f"{order}{n}i", f.read(4 * n))
    compression, bias = struct.unpack(f"{order}i", head[72:76])[0], struct.unpack(f"{order}d", head[84:92])[0]
    found, units, names, charset = [], 0, {}, encoding
    while True:
        (kind,) = whole()
        if kind == 2:
            width, labelled, n_missing, shown, _ = whole(5)
            name = f.read(8)
            if labelled:
                f.read(-(-whole()[0] // 4) * 4)
            values = [f.read(8) for _ in range(abs(n_missing))]
            if width >= 0:
                v = Variable(name.decode("latin-1").rstrip(), width, shown >> 16 & 255, units)
                if width:
                    v.missing = [x[:width].rstrip(b" ") for x in values]
                else:
                    numbers = [struct.unpack(f"{order}d", x)[0] for x in values]
                    if n_missing < 0:  # a range, and perhaps one more value
                        (v.low, v.high), numbers = numbers[:2], numbers[2:]
                    v.missing = numbers
                found.append(v)
            units += 1
        elif kind == 3:
            for _ in range(whole()[0]):
                f.read(8)
                f.read((f.read(1)[0] + 8) // 8 * 8 - 1)
            if whole()[0] != 4:
                raise ValueError("value labels without their variables")
            f.read(4 * whole()[0])
        elif kind == 6:
            f.read(80 * whole()[0])
        elif kind == 7:
            what, size, count = whole(3)
            data = f.read(size * count)
            if what == 13:
                names = dict(pair.split(b"=", 1) for pair in data.split(b"\t") if b"=" in pair)
            elif what == 14 and data.strip(b"\0\t "):
                raise ValueError("strings of more than 255 bytes are not read")
            elif what == 20 and not encoding:
                charset = data.decode("ascii").strip("\0 ")
        elif kind == 999:
            whole()
            break
        else:
            raise ValueError(f"record {kind} in the dictionary")
    charset = charset or "cp1252"
    for v in found:
        v.name = names.get(v.name.encode("latin-1"), v.name.encode("latin-1")).decode(charset)
    return Dictionary(found, units, order, compression, bias, charset, f.tell())


def _unzipped(f, d: Dictionary) -> Iterator[bytes]:
    """The blocks of a file that is compressed twice, by the index at its end."""
    _, trailer, _ = struct.unpack(f"{d.order}3q", f.read(24))
    f.seek(trailer + 16)
    _, n = struct.unpack(f"{d.order}2i", f.read(8))
    index = [struct.unpack(f"{d.order}2q2i", f.read(24)) for _ in range(n)]
    for _, at, _, size in index:
        f.seek(at)
        yield zlib.decompress(f.read(size))


def _chunks(f, d: Dictionary) -> Iterator[bytes]:
    if d.compression == 2:
        yield from _unzipped(f, d)
    else:
        while data := f.read(BATCH_BYTES):
            yield data


def uncompressed(f, d: Dictionary) -> Iterator[bytes]:
    """Cases as in a plain file: eight codes stand before the values that they don't tell."""
    nothing = struct.pack(f"{d.order}d", -np.finfo(float).max)
    small = [struct.pack(f"{d.order}d", c - d.bias) for c in range(252)]
    held, out = b"", bytearray()
    for data in _chunks(f, d):
        held, at = held + data, 0
        while at + 8 <= len(held):
            codes = held[at : at + 8]
            end = at + 8 + 8 * codes.count(253)
            if end > len(held) and 252 not in codes:
                break  # the rest of these values is in the next chunk
            value = at + 8
            for c in codes:
                if c == 252:
                    yield bytes(out)
                    return
                if c == 253:
                    out += held[value : value + 8]
                    value += 8
                elif c:
                    out += b" " * 8 if c == 254 else nothing if c == 255 else small[c]
            at = end
            if len(out) >= BATCH_BYTES:
                yield bytes(out)
                out = bytearray()
        held = held[at:]
    yield bytes(out)


def columns_of(cases: np.ndarray, d: Dictionary, schema: T.StructType, user_missing: bool) -> pa.RecordBatch:
    """Arrow columns of cases, a matrix of bytes with a case a row."""
    by_name, arrays = {v.name: v for v in d.variables}, []
    for field_ in schema.fields:
        v = by_name[field_.name]
        if v.width:
            raw = np.ascontiguousarray(cases[:, 8 * v.at : 8 * v.at + v.width]).view(f"S{v.width}").ravel()
            texts = [x.rstrip(b" ") for x in raw.tolist()]
            arrays.append(pa.array([None if x in v.missing and not user_missing else x.decode(d.encoding, "replace") for x in texts], pa.string()))
            continue
        x = np.ascontiguousarray(cases[:, 8 * v.at : 8 * v.at + 8]).view(f"{d.order}f8").ravel().astype(float)
        gone = (x == -np.finfo(float).max) | np.isnan(x)
        if not user_missing:
            gone |= np.isin(x, v.missing) if v.missing else False
            gone |= (x >= v.low) & (x <= v.high) if v.low is not None else False
        if v.type == T.DoubleType():
            arrays.append(pa.array(x, mask=gone))
        else:
            micros = pa.array((np.where(gone, EPOCH, x) * 1e6).round().astype(np.int64) - EPOCH * 1_000_000, mask=gone).cast(pa.timestamp("us"))
            arrays.append(micros.cast(pa.date32(), safe=False) if v.type == T.DateType() else micros)
    return pa.RecordBatch.from_arrays(arrays, schema.names)


@dataclass
class Cases(InputPartition):
    """first, last (excluded): bytes of whole cases after the dictionary; None: to the end."""

    first: int
    last: int | None

    def __init__(self, first: int, last: int | None):
        super().__init__((first, last))
        self.first, self.last = first, last


class SpssReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, encoding: str | None, user_missing: bool):
        self.path, self.schema, self.encoding, self.user_missing = path, schema, encoding, user_missing

    def partitions(self) -> list[InputPartition]:
        with opened(self.path) as f:
            d = read_dictionary(f, self.encoding)
            size = f.size() - d.start
        if d.compression or not d.units:
            return [Cases(0, None)]
        case = 8 * d.units
        size, step = size // case * case, max(PARTITION_BYTES // case, 1) * case
        return [Cases(a, min(a + step, size)) for a in range(0, size, step)] or [Cases(0, 0)]

    def read(self, partition: Cases) -> Iterator[pa.RecordBatch]:
        with opened(self.path) as f:
            d = read_dictionary(f, self.encoding)
            case, held = 8 * d.units, b""
            if partition.last is None:
                data = uncompressed(f, d)
            else:
                f.seek(d.start + partition.first)
                step = max(BATCH_BYTES // case, 1) * case
                data = (f.read(min(step, partition.last - a)) for a in range(partition.first, partition.last, step))
            for part in data:
                held += part
                n = len(held) // case if case else 0
                if n:
                    yield columns_of(np.frombuffer(held[: n * case], np.uint8).reshape(n, case), d, self.schema, self.user_missing)
                    held = held[n * case :]


class SpssSource(DataSource):
    """Options: encoding (else the file's own), userMissing (true: values that the file's user called missing are kept; else they are null)."""

    @classmethod
    def name(cls) -> str:
        return "spss"

    def _encoding(self) -> str | None:
        return self.options.get("encoding")

    def schema(self) -> T.StructType:
        with opened(self.options["path"]) as f:
            return T.StructType([T.StructField(v.name, v.type) for v in read_dictionary(f, self._encoding()).variables])

    def reader(self, schema: T.StructType) -> SpssReader:
        return SpssReader(self.options["path"], schema, self._encoding(), self.options.get("userMissing", "false").lower() == "true")
