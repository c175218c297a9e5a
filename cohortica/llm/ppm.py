"""Language-model scoring by prediction by partial matching (PPM) over bytes.

A trie of byte contexts up to ORDER holds how often each byte follows each
context. A byte is coded at the longest context seen: an escape of weight d (the
number of distinct bytes seen there, method C) leads to the next shorter one,
where the bytes already ruled out by the longer context are excluded. Below
order 0 all bytes not yet excluded are equally likely.

Text is scored as its words, each followed by a blank, and one end mark, with
A-Z lower-cased, so the score is the log10 probability of the token sequence.

Pretrained: the trie is counted over the corpus in a pass with partial counts
in each task and a shuffle by context, then sent out in slices of bounded size:
as many passes over the texts as there are slices, each with one bounded
broadcast. A slice holds all orders of the contexts that end in its byte pairs,
so a position is scored in one slice only. Adaptive: a trie of each document's
own past.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.llm.common import materialise, slices, texts_of, tidy

#: Bytes of context.
ORDER = 5
#: Rows of a slice of the trie or of the word counts: 128 MB as two arrays of 64-bit numbers.
SLICE_ROWS = 1 << 23
#: Bytes of text that a task holds as numbers at once, and rows of counts that it gathers before it hands them on.
PART_BYTES, GATHERED = 1 << 20, 1 << 20

#: A context and a byte take 48 bits of a number, the index of a part the others.
PART_BITS = 16

END = b"\n"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def is_held_out(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo 7, is 2; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(7)) == 2


def parts(text: str) -> Iterator[list[bytes]]:
    """Words of a text, in lists of about PART_BYTES; the end mark last."""
    raw = text.encode().translate(_LOWER)
    start = 0
    while len(raw) - start > PART_BYTES:
        cut = raw.rfind(b" ", start, start + PART_BYTES)
        cut = cut if cut > start else raw.find(b" ", start + PART_BYTES)
        if cut < 0:
            break
        yield raw[start:cut].split()
        start = cut
    yield [*raw[start:].split(), END]


def _bytes_of(words: list[bytes]) -> bytes:
    return b" ".join(words[:-1]) + b" " * (len(words) > 1) + END if words and words[-1] == END else b"".join(w + b" " for w in words)


def _batches(rows: Iterator[tuple[int, str]]) -> Iterator[tuple[list[int], list[bytes], list[int], list[bytes]]]:
    """Runs of parts of about PART_BYTES: owners, context and bytes to be coded, word counts, words."""
    owners, coded, counts, words, size = [], [], [], [], 0
    for owner, text in rows:
        context = END * ORDER
        for w in parts(text):
            piece = _bytes_of(w)
            owners.append(owner)
            coded.append(context + piece)
            counts.append(len(w))
            words += w
            context = (context + piece)[-ORDER:]
            size += len(piece) + 1
            if size >= PART_BYTES or len(owners) == 1 << PART_BITS:
                yield owners, coded, counts, words
                owners, coded, counts, words, size = [], [], [], [], 0
    if owners:
        yield owners, coded, counts, words


def grams(coded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Context and byte of each coded position as one number, and the index of its part."""
    a = np.frombuffer(b"".join(coded), np.uint8)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    g = np.zeros(max(0, len(a) - ORDER), np.uint64)
    for j in range(ORDER + 1):
        g <<= np.uint64(8)
        g |= a[j : len(a) - ORDER + j]
    owner = np.repeat(np.arange(len(coded)), lengths)[: len(a)]
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    fits = np.ones(len(a), bool)
    for j in range(ORDER):
        fits[first + j] = False
    return g[fits[ORDER:]], owner[ORDER:][fits[ORDER:]]


def word_keys(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not sum(map(len, keys)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, c = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[at], np.add.reduceat(c, at)


def count(texts: DataFrame) -> DataFrame:
    """kind (0: context and byte, 1: hash of a word), key, n over all rows of texts (column text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[list, list]] = [([], []), ([], [])]
        rows = ((0, t) for b in slices(batches, PART_BYTES) for t in texts_of(b))
        for _, coded, _, words in _batches(rows):
            new = [np.unique(grams(coded)[0], return_counts=True), None]
            coded_words = pa.array(words, pa.binary()).dictionary_encode()
            new[1] = word_keys(coded_words.dictionary), np.bincount(coded_words.indices.to_numpy(), minlength=len(coded_words.dictionary))
            for kind in (0, 1):
                keys, n = held[kind]
                keys.append(new[kind][0])
                n.append(new[kind][1].astype(np.int64))
                if sum(map(len, keys)) > GATHERED:
                    k, c = _summed(keys, n)
                    if len(k) > GATHERED // 2:
                        yield from _rows(kind, k, c)
                        k, c = k[:0], c[:0]
                    held[kind] = [k], [c]
        for kind in (0, 1):
            yield from _rows(kind, *_summed(*held[kind]))

    return texts.select("text").mapInArrow(tidy(run), "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray, step: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(keys), step):
        k = keys[i : i + step].view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), kind, np.int32)), pa.array(k), pa.array(counts[i : i + step])], ["kind", "key", "n"])


@dataclass
class Slice:
    """Contexts by their last two bytes, or, of one pair that is too large, by the byte before them too."""

    pairs: list[int]
    thirds: list[int] | None = None

    def scores(self, g: np.ndarray) -> np.ndarray:
        """Which coded positions are this slice's."""
        mine = np.zeros(1 << 16, bool)
        mine[self.pairs] = True
        out = mine[((g >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64)]
        if self.thirds is not None:
            third = np.zeros(1 << 8, bool)
            third[self.thirds] = True
            out &= third[((g >> np.uint64(24)) & np.uint64(0xFF)).astype(np.int64)]
        return out

    def rows(self, tries: DataFrame) -> DataFrame:
        """The trie's rows that this slice needs."""
        if not self.pairs:
            return tries.where("false")
        mine = F.shiftright("key", 8).bitwiseAND(0xFFFF).between(self.pairs[0], self.pairs[-1])
        return tries.where(mine if self.thirds is None else mine & F.shiftright("key", 24).bitwiseAND(0xFF).between(self.thirds[0], self.thirds[-1]))


def _filled(sizes: list[tuple[int, int]], room: int) -> list[list[int]]:
    """Neighbours together as long as their rows fit the room; one that alone doesn't fit stands alone."""
    out, free = [], 0
    for key, n in sizes:
        if n > free or not out:
            out.append([])
            free = room
        out[-1].append(key)
        free -= n
    return out


def slices_of(tries: DataFrame) -> list[Slice]:
    """Slices of SLICE_ROWS rows of the trie (kind 0 of count()), but for what ends in the same three bytes, which is 2 ** 24 rows at most."""
    pair, third = F.shiftright("key", 8).bitwiseAND(0xFFFF), F.shiftright("key", 24).bitwiseAND(0xFF)
    sizes = [(r["pair"], r["rows"]) for r in tries.groupBy(pair.alias("pair")).agg(F.count("*").alias("rows")).orderBy("pair").collect()]  # 65,536 rows at most
    large = [p for p, n in sizes if n > SLICE_ROWS]
    inside: dict[int, list[tuple[int, int]]] = {p: [] for p in large}
    for i in range(0, len(large), 256):
        for r in tries.where(pair.isin(large[i : i + 256])).groupBy(pair.alias("pair"), third.alias("third")).agg(F.count("*").alias("rows")).orderBy("pair", "third").collect():
            inside[r["pair"]].append((r["third"], r["rows"]))
    out = []
    for pairs in _filled(sizes, SLICE_ROWS):
        out += [Slice(pairs, x) for x in _filled(inside[pairs[0]], SLICE_ROWS)] if pairs[0] in inside else [Slice(pairs)]
    return out


class Trie:
    """The tables of one slice. lowest: counts of all pairs of a byte and its follower, which every slice needs whole; second: of the one pair of bytes that a slice has a part of, and their follower."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, lowest: tuple[np.ndarray, np.ndarray] | None = None, second: tuple[np.ndarray, np.ndarray] | None = None):
        self.gram: list[tuple] = [()] * (ORDER + 1)
        self.context: list[tuple] = [()] * (ORDER + 1)
        for j in range(ORDER, -1, -1):
            low = np.uint64((1 << 8 * (j + 1)) - 1)
            source = lowest if lowest is not None and j <= 1 else second if second is not None and j == 2 else (keys, counts)
            k, c = _summed([source[0] & low], [source[1]])
            contexts = k >> np.uint64(8)
            at = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]])) if len(k) else np.zeros(0, np.int64)
            total = np.add.reduceat(c, at) if len(k) else c
            self.gram[j] = (k, c)
            self.context[j] = (contexts[at], total, np.diff(np.append(at, len(k))), at)
        self.shadow: list[np.ndarray] = [np.zeros(0)] * (ORDER + 1)  # of each context: what its bytes count in the next shorter one
        for j in range(1, ORDER + 1):
            k, at = self.gram[j][0], self.context[j][3]
            below = self.gram[j - 1]
            if len(k):
                where = np.searchsorted(below[0], k & np.uint64((1 << 8 * j) - 1))
                self.shadow[j] = np.add.reduceat(below[1][where], at)

    @staticmethod
    def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
        if not len(table):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
        return np.where(table[at] == keys, at, -1)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Of the probability of each byte after its context."""
        out = np.zeros(len(keys))
        rest = np.arange(len(keys))
        above = np.full(len(keys), -1)  # the context of the order before, if it was seen
        for j in range(ORDER, -1, -1):
            k = keys[rest] & np.uint64((1 << 8 * (j + 1)) - 1)
            names, total, distinct, _ = self.context[j]
            at = self._find(names, k >> np.uint64(8))
            seen = at >= 0
            n, d = np.zeros(len(rest)), np.zeros(len(rest))
            n[seen], d[seen] = total[at[seen]], distinct[at[seen]]
            ruled = seen & (above >= 0)
            if j < ORDER and ruled.any():
                n[ruled] -= self.shadow[j + 1][above[ruled]]
                d[ruled] -= self.context[j + 1][2][above[ruled]]
            hit = self._find(self.gram[j][0], k)
            found = hit >= 0
            c = np.ones(len(rest))
            c[found] = self.gram[j][1][hit[found]]
            escaped = seen & ~found & (d > 0)
            c[escaped] = d[escaped]
            paid = found | escaped
            out[rest[paid]] += np.log10(c[paid] / (n[paid] + d[paid]))
            above = np.where(seen, at, -1)[~found]
            rest = rest[~found]
        known = np.zeros(len(rest))
        known[above >= 0] = self.context[0][2][above[above >= 0]]
        out[rest] -= np.log10(256 - known)
        return out


def score_texts(rows: list[tuple[int, str]], trie: Trie, part_of: Slice | None, words: tuple[np.ndarray, np.ndarray], first: bool, n_rows: int) -> list[np.ndarray]:
    """score, n_tokens, n_known, sum of log10(c + 1), of each row; only positions that the slice scores (None: all)."""
    score, tokens, known, logs = np.zeros(n_rows), np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64), np.zeros(n_rows)
    for owners, coded, counts, toks in _batches(iter(rows)):
        owner = np.array(owners)
        g, part = grams(coded)
        if part_of is not None:
            mine = part_of.scores(g)
            g, part = g[mine], part[mine]
        key = np.sort((g << np.uint64(PART_BITS)) | part.astype(np.uint64))
        g, part = key >> np.uint64(PART_BITS), (key & np.uint64((1 << PART_BITS) - 1)).astype(np.int64)
        at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
        value = np.repeat(trie.log10(g[at]), np.diff(np.append(at, len(g))))
        np.add.at(score, owner, np.bincount(part, value, minlength=len(coded)))
        enc = pa.array(toks, pa.binary()).dictionary_encode()
        hit = Trie._find(words[0], word_keys(enc.dictionary))
        c = np.where(hit >= 0, words[1][np.maximum(hit, 0)] if len(words[1]) else 0, 0)
        ix = enc.indices.to_numpy()
        of = np.repeat(owner, counts)
        known += np.bincount(of, (c > 0)[ix], minlength=n_rows).astype(np.int64)
        logs += np.bincount(of, np.log10(c + 1.0)[ix], minlength=n_rows)
        if first:
            np.add.at(tokens, owner, np.array(counts))
    return [score, tokens, known, logs]


def score(docs: DataFrame, train: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row of docs; the trie learns the rows of train.

    A null text is the empty one: one end mark. Repeated rows are scored, and
    learned, as often as they occur; null ids are ids like others. With no rows
    to learn from, every byte has probability 1/256 and the base 1/(0 + 0 + 1).
    Empty docs give an empty table. Other columns are not read.
    """
    spark = docs.sparkSession
    counts = materialise(count(train))
    stats = {r["kind"]: r for r in counts.groupBy("kind").agg(F.count("*").alias("distinct"), F.sum("n").alias("total")).collect()}
    get = lambda kind, what: int(stats[kind][what]) if kind in stats else 0
    train_tokens, vocabulary = get(1, "total"), get(1, "distinct")
    tries, word_slices = counts.where("kind = 0"), max(1, math.ceil(get(1, "distinct") / SLICE_ROWS))
    bins = slices_of(tries) if get(0, "distinct") > SLICE_ROWS else []
    lowest = _arrays(_suffixes(tries, 2)) if bins else None
    passes = max(len(bins), word_slices, 1)
    made = []
    for p in range(passes):
        part_of = (bins[p] if p < len(bins) else Slice([])) if bins or p else None
        second = _arrays(_suffixes(Slice(part_of.pairs).rows(tries), 3)) if part_of is not None and part_of.thirds is not None else None
        gram_rows = tries if part_of is None else part_of.rows(tries)
        # a word is sent in one pass only, as its counts are summed over the passes: none is left for those beyond word_slices
        word_rows = counts.where("kind = 1").where(F.pmod("key", F.lit(word_slices)) == p)
        sent = spark.sparkContext.broadcast((_arrays(gram_rows.select("key", "n")), lowest, second, part_of, _arrays(word_rows.select("key", "n"))))
        one = _one_pass(docs.select("doc_id", "text"), sent, p == 0, keyed=passes > 1)
        if passes > 1:
            one = materialise(one)
            sent.destroy()
        made.append(one)
    if passes == 1:
        out = made[0]
    else:
        # a row is known by its id and its text's digests; equal rows have equal parts, and come out as often as they came in
        every = reduce(DataFrame.unionAll, made).groupBy("doc_id", "key").agg(*[F.sum(c).alias(c) for c in ("score", "n_tokens", "n_known", "logs")], F.count("*").alias("n"))
        times = F.col("n") / passes
        out = every.select("doc_id", *[(F.col(c) / times).cast("double" if c in ("score", "logs") else "long").alias(c) for c in ("score", "n_tokens", "n_known", "logs")], F.explode(F.sequence(F.lit(1), times.cast("int"))).alias("copy"))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), (F.col("logs") - F.col("n_tokens") * math.log10(train_tokens + vocabulary + 1)).alias("base_score"), "score")


def _suffixes(tries: DataFrame, length: int) -> DataFrame:
    """Counts of the trie's rows by their last bytes."""
    return tries.groupBy(F.col("key").bitwiseAND((1 << 8 * length) - 1).alias("key")).agg(F.sum("n").alias("n"))


def _arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """key and n of at most a slice's rows, by key."""
    got = rows.toArrow()
    k, n = got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(k)
    n = n[order]
    return k[order], n.astype(np.uint32) if len(n) and n.max() < 1 << 32 else n


def _one_pass(docs: DataFrame, sent, first: bool, keyed: bool) -> DataFrame:
    names = [*(["key"] if keyed else []), "score", "n_tokens", "n_known", "logs"]
    kinds = {"key": T.StringType(), "score": T.DoubleType(), "n_tokens": T.LongType(), "n_known": T.LongType(), "logs": T.DoubleType()}
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, kinds[n]) for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (keys, counts), lowest, second, part_of, words = sent.value
        trie = Trie(keys, counts, lowest, second)
        for b in slices(batches, PART_BYTES):
            texts = texts_of(b)
            cols = score_texts(list(enumerate(texts)), trie, part_of, words, first, len(texts))
            shown = [pa.array([xxhash.xxh3_128_hexdigest(t.encode()) for t in texts], pa.string())] if keyed else []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *shown, *map(pa.array, cols)], ["doc_id", *names])

    return docs.mapInArrow(tidy(run), schema)


class Contexts:
    """The same model as dictionaries, for text that is learned while it is read."""

    def __init__(self) -> None:
        self.seen: dict[bytes, dict[int, int]] = defaultdict(lambda: defaultdict(int))

    def log10(self, context: bytes, byte: int) -> float:
        out, excluded = 0.0, set()
        for j in range(min(ORDER, len(context)), -1, -1):
            there = self.seen.get(context[len(context) - j :])
            if not there:
                continue
            left = {b: n for b, n in there.items() if b not in excluded}
            n, d = sum(left.values()), len(left)
            if byte in left:
                return out + math.log10(left[byte] / (n + d))
            if d:
                out += math.log10(d / (n + d))
            excluded |= left.keys()
        return out - math.log10(256 - len(excluded))

    def learn(self, context: bytes, byte: int) -> None:
        for j in range(min(ORDER, len(context)) + 1):
            self.seen[context[len(context) - j :]][byte] += 1


def adaptive_log10(text: str) -> float:
    """The score of a text by what it has said so far alone."""
    model, context, out = Contexts(), END * ORDER, 0.0
    for w in parts(text):
        for byte in _bytes_of(w):
            out += model.log10(context, byte)
            model.learn(context, byte)
            context = (context + bytes([byte]))[-ORDER:]
    return out


def score_adaptive(docs: DataFrame) -> DataFrame:
    """doc_id, score: each document by itself; null and empty texts code the end mark only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([adaptive_log10(t or "") for t in b.column("text").to_pylist()])], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
