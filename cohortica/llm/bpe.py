"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file gives the vocabulary; bytes become characters by the usual
byte-to-character table, merges follow from the ranks. Texts are cut by the
pattern into pieces, and since a piece's ids depend on nothing else, each worker
encodes a piece once and looks it up afterwards. Decoding joins the bytes of the
ids: a character split over tokens comes together again there, and is replaced
by U+FFFD only if a caller decodes ids that end inside it.

The pattern names letters and numbers, and the module that matches it may know
another Unicode version than the reference encoder. What the two class apart is
found out once, on the driver, and stood in for while a text is cut.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortica.llm.common import slices, texts_of, tidy

#: Pieces that a worker remembers, each of PIECE_CHARS at most; the memory is emptied when full.
REMEMBERED, PIECE_CHARS = 150_000, 64
#: Texts go through the encoder in groups of about so many characters.
GROUP_CHARS = 1 << 20
#: Characters that every Unicode version classes as a letter, as a number, as neither.
STAND_INS = {"L": "\u00aa", "N": "\u00b2", "": "\uffff"}


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the rest from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


@lru_cache(maxsize=1)
def classed_apart() -> tuple[tuple[int, int, str], ...]:
    """Runs of code points (first, last) that the reference encoder and the regex module class apart as letters or numbers, with a stand-in that both class as the encoder does."""
    import tiktoken

    every = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    apart: dict[int, str] = {}
    for name in "LN":
        run = rf"\p{{{name}}}+"
        encoder = tiktoken.Encoding("class", pat_str=run, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        theirs, ours = set(encoder.decode(encoder.encode_ordinary(every))), set("".join(regex.findall(run, every)))
        apart |= {ord(c): STAND_INS[name] for c in theirs - ours}
        apart |= {ord(c): apart.get(ord(c), STAND_INS[""]) for c in ours - theirs}
    runs: list[tuple[int, int, str]] = []
    for c in sorted(apart):
        if runs and runs[-1][1:] == (c - 1, apart[c]):
            runs[-1] = (runs[-1][0], c, apart[c])
        else:
            runs.append((c, c, apart[c]))
    return tuple(runs)


class Codec:
    """Encodes and decodes by a rank file and a pattern, without special tokens.

    apart: what the pattern is to take for other characters, as classed_apart gives it.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, apart: tuple[tuple[int, int, str], ...] = ()):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, models, pre_tokenizers

        chars = byte_characters()
        shown = lambda x: "".join(chars[b] for b in x)
        merges = [(shown(x[:i]), shown(x[i:])) for x in sorted(ranks, key=ranks.get) for i in range(1, len(x)) if ranks.get(x[:i], 1 << 60) < ranks[x] and ranks.get(x[i:], 1 << 60) < ranks[x]]
        self.tokenizer = Tokenizer(models.BPE(vocab={shown(x): r for x, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.pattern = regex.compile(pattern)
        self.apart = re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b, _ in apart) + "]") if apart else None
        self.stand_ins = {c: x for a, b, x in apart for c in range(a, b + 1)}
        self.of_id = [b""] * (max(ranks.values()) + 1)
        for x, r in ranks.items():
            self.of_id[r] = x
        self.known: dict[str, tuple[int, ...]] = {}

    def pieces(self, text: str) -> list[str]:
        if self.apart is None or text.isascii() or not self.apart.search(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        out = []
        for group in _groups(texts):
            cut = [self.pieces(t) for t in group]
            known = self.known
            new = [p for p in dict.fromkeys(chain.from_iterable(cut)) if p not in known]
            made = {p: tuple(e.ids) for k in range(0, len(new), 4096) for p, e in zip(new[k : k + 4096], self.tokenizer.encode_batch_fast(new[k : k + 4096], add_special_tokens=False), strict=True)}
            known.update(made)
            out += [list(chain.from_iterable(map(known.__getitem__, c))) for c in cut]
            if len(known) > REMEMBERED:
                known.clear()
            else:
                for p in made:
                    if len(p) > PIECE_CHARS:
                        del known[p]
        return out

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.of_id.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def byte_offsets(self, ids: list[int]) -> list[int]:
        """Where each token begins in the UTF-8 text, and its end last."""
        return [0, *accumulate(len(self.of_id[i]) for i in ids)]

    def char_offsets(self, ids: list[int]) -> list[tuple[int, int]]:
        """First and last+1 code point that each token has bytes of; tokens inside one character share it."""
        out, chars = [], 0
        for i in ids:
            x = self.of_id[i]
            starts = sum(b & 0xC0 != 0x80 for b in x)
            out.append((chars - (bool(x) and x[0] & 0xC0 == 0x80), chars + starts))
            chars += starts
        return out


def _groups(texts: list[str]) -> Iterator[list[str]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= GROUP_CHARS:
            yield group
            group, size = [], 0
    if group:
        yield group


@lru_cache(maxsize=2)
def codec(ranks_path: str, pattern: str, apart: tuple[tuple[int, int, str], ...] = ()) -> Codec:
    """One for each Python worker. The file must be installed where executors run, as the tokenizer package is."""
    with open(ranks_path, "rb") as f:
        return Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern, apart)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """docs with ids (array<int>), decoded (binary) and, if asked for, byte_offsets (array<long>) and char_offsets.

    A null text counts as empty: no ids. Nulls elsewhere, repeated rows and
    further columns pass through; columns named as the new ones are replaced. An
    empty table gives an empty one. A pattern must match every character.
    """
    added = [("ids", T.ArrayType(T.IntegerType())), ("decoded", T.BinaryType())]
    if offsets:
        added += [("byte_offsets", T.ArrayType(T.LongType())), ("char_offsets", T.ArrayType(T.ArrayType(T.LongType())))]
    kept = docs.drop(*[n for n, _ in added])
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in added]])
    apart = classed_apart()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern, apart)
        for b in slices(batches, 2 * GROUP_CHARS):
            ids = c.encode(texts_of(b))
            cols = [pa.array(ids, pa.list_(pa.int32())), pa.array([c.decode_bytes(x) for x in ids], pa.binary())]
            if offsets:
                cols += [pa.array([c.byte_offsets(x) for x in ids], pa.list_(pa.int64())), pa.array([c.char_offsets(x) for x in ids], pa.list_(pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*b.schema.names, *[n for n, _ in added]])
        c.known.clear()  # a worker that waits for other work holds no pieces

    return kept.mapInArrow(tidy(run), schema)


def digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode_documents, digested where the ids are made."""
    apart = classed_apart()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(ranks_path, pattern, apart)
        number = list(map(str, range(len(c.of_id))))
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in slices(batches, 2 * GROUP_CHARS):
            ids = c.encode(texts_of(b))
            digested = [pa.array(map(len, ids), pa.int64()), pa.array([sha(",".join(map(number.__getitem__, x)).encode()) for x in ids], pa.string()), pa.array([sha(c.decode_bytes(x)) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *digested], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        c.known.clear()

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("n_tokens long, ids_sha256 string, decoded_sha256 string").fields])
    return docs.select("doc_id", "text").mapInArrow(tidy(run), schema)
