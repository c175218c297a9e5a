"""BagMinHash near-duplicates over multisets of word shingles.

A document is the multiset of its five-word shingles. Each shingle of weight w
runs Poisson processes over the discretised weights below w: one for [0, 1), one
for [1, 2), one for [2, 4) and so on, each of a rate as long as its interval;
the points of an interval that w ends in count only if they lie below w. A point
has a time and a register, and a register keeps its earliest time. Two
documents agree in a register with probability sum(min)/sum(max) of their
weights, the weighted Jaccard likeness. Points are made in order of time and
only as long as a register could still take them.

Registers are banded; documents that share a band are compared by their whole
multisets in two rounds. In the first each meets one document of the band, the
one that meets most others. The second looks at the bands whose documents are
not in one class by then: two of their documents can be as like as the threshold
only if they share a shingle that stands early in both, rare shingles first, and
enough stands behind it in both. Where copies of one text differ more from each
other than from that text, what stands early is what their edits made, which no
other has: they never meet, so pairs don't grow with the square of a group.
Classes are the connected components of the links found.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.llm.common import BROADCAST_ROWS, Scratch, materialise, slices, text_of, texts_of, tidy

WIDTH = 5
#: Registers are ROWS x BANDS. A pair at 0.8 shares no band with probability (1 - 0.8 ** 5) ** 30 < 1e-5.
ROWS, BANDS = 5, 30
REGISTERS = ROWS * BANDS
#: Bytes of text, and shingles, that a task holds as numbers at once.
PART_BYTES, PART_SHINGLES = 1 << 20, 1 << 18
#: The comparisons with one document are dealt to so many groups at most, each with one copy of its text.
SALTS = 1024
#: A shingle with at least one in so many of all rows is one of so many at most, and its count is sent to every task.
HOT_SHARE = 100_000

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all (murmur3's finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


#: A random number for each byte.
_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def _pieces(words: list[list[bytes]], width: int) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Documents, and words of each, of about PART_BYTES in all; a longer document comes in pieces that overlap by width - 1 words."""
    docs, runs, size = [], [], 0
    for d, all_words in enumerate(words):
        start = 0
        while True:
            end = min(len(all_words), start + PART_BYTES // 8)
            docs.append(d)
            runs.append(all_words[start:end])
            size += sum(map(len, runs[-1])) + len(runs[-1])
            if size >= PART_BYTES:
                yield docs, runs
                docs, runs, size = [], [], 0
            if end == len(all_words):
                break
            start = end - width + 1
    if docs:
        yield docs, runs


def _hashes(words: list[list[bytes]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """document, hash of each window of `width` words, or of all words where there are fewer: from prefix sums over all bytes at once."""
    raw = b" ".join([b" ".join(w) for w in words])
    a = np.frombuffer(raw, np.uint8)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[a] * _powers(_BASE, len(a)), dtype=np.uint64)])
    back = _powers(_INVERSE, len(a) + 1)
    counts = np.fromiter(map(len, words), np.int64, len(words))
    lengths = np.fromiter((len(x) for w in words for x in w), np.int64, int(counts.sum()))
    # an empty document leaves only its separator behind: count separators by document
    doc_of_word = np.repeat(np.arange(len(words)), counts)
    empties = np.cumsum(counts == 0)
    ends = np.cumsum(lengths + 1) - 1 + empties[doc_of_word] if len(lengths) else lengths
    starts = ends - lengths
    first = np.cumsum(counts) - counts
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(words)), made)
    at = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made) + np.repeat(first, made)
    last = at + np.repeat(np.minimum(np.maximum(counts, 1), width) - 1, made)
    h = _mix((sums[ends[last]] - sums[starts[at]]) * back[starts[at]] + (ends[last] - starts[at]).astype(np.uint64) * np.uint64(_ODD)) if len(at) else np.zeros(0, np.uint64)
    return doc, h


def shingles(texts: list[str], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """document, hash, weight: the distinct shingles of each document, by document and hash.

    A text of fewer words than a shingle has one of all its words, a text
    without words none.
    """
    docs, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for owners, runs in _pieces([t.encode().translate(_BLANK).split() for t in texts], width):
        doc, h = _hashes(runs, width)
        docs.append(np.array(owners, np.int64)[doc])
        found.append(h)
    doc, h = np.concatenate(docs), np.concatenate(found)
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.append(new, len(h)))


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _points(out: np.ndarray, doc: np.ndarray, h: np.ndarray, weight: np.ndarray, limit: np.ndarray, m: int) -> None:
    """Lowers the registers by the points of these shingles up to their documents' limits of time."""
    # intervals of weights: 0 is [0, 1), j is [2 ** (j - 1), 2 ** j)
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 2.0 ** (level - 1), 0.0)
    length = np.where(level > 0, low, 1.0)
    seed = _mix(h[of] + (level.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD))
    doc, most = doc[of], weight[of].astype(np.float64)
    time = np.zeros(len(of))
    step = 0
    while len(seed):
        step += 1
        x = _mix(seed + np.uint64(step * _ODD % (1 << 64)))
        time = time - np.log(_unit(x)) / length
        within = time <= limit[doc]
        seed, doc, low, length, most, time, x = (v[within] for v in (seed, doc, low, length, most, time, x))
        y = _mix(x ^ np.uint64(0x5851F42D4C957F2D))
        below = low + _unit(_mix(y ^ np.uint64(0x14057B7EF767814F))) * length < most
        register = ((y >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        np.minimum.at(out, doc[below] * m + register[below].astype(np.int64), time[below])


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, m: int = REGISTERS) -> np.ndarray:
    """n_docs x m earliest times; infinite for a document without shingles.

    By a document's limit all its registers have been hit with high
    probability; where one has not, the limit is raised and its points are made
    again, which are the same and some more.
    """
    out = np.full(n_docs * m, np.inf)
    total = np.bincount(doc, weight, minlength=n_docs)
    limit = np.where(total > 0, m * (np.log(m) + 3.0) / np.maximum(total, 1), 0.0)
    short = total > 0
    while short.any():
        mine = np.flatnonzero(short[doc])
        for i in range(0, len(mine), PART_SHINGLES):
            part = mine[i : i + PART_SHINGLES]
            _points(out, doc[part], h[part], weight[part], limit, m)
        short &= ~np.isfinite(out.reshape(n_docs, m)).all(axis=1)
        limit[short] *= 2
    return out.reshape(n_docs, m)


def _sketch_rows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in all, band keys (n x BANDS)."""
    doc, h, weight = shingles(texts)
    bits = _mix(signatures(doc, h, weight, len(texts)).view(np.uint64))
    keys = np.tile(_mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(texts), 1))  # keys of different bands never meet
    for r in range(ROWS):
        keys = _mix(keys * np.uint64(_ODD) + bits[:, r::ROWS])
    return np.bincount(doc, weight, minlength=len(texts)).astype(np.int64), keys


def text_key() -> Column:
    """128 bits that stand for a text; a null one is empty."""
    return F.md5(text_of())


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, n_shingles, bands of each row; a null text is the empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, PART_BYTES):
            n, keys = _sketch_rows(texts_of(b))
            bands = pa.FixedSizeListArray.from_arrays(pa.array(keys.view(np.int64).ravel()), BANDS).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_key"), pa.array(n), bands], ["doc_id", "text_key", "n_shingles", "bands"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *T._parse_datatype_string("text_key string, n_shingles long, bands array<long>").fields])
    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(tidy(run), schema)


def likeness(a: str, b: str) -> float:
    """Exact weighted Jaccard likeness of two texts."""
    doc, h, w = shingles([a, b])
    first = doc == 0
    return _likeness((h[first], w[first]), h[~first], w[~first])


def _likeness(one: tuple[np.ndarray, np.ndarray], h: np.ndarray, w: np.ndarray) -> float:
    """Of two multisets, each with its hashes in order."""
    if not len(one[0]) or not len(h):
        return 0.0
    at = np.minimum(np.searchsorted(one[0], h), len(one[0]) - 1)
    both = int(np.minimum(one[1][at], w)[one[0][at] == h].sum())
    return both / (int(one[1].sum()) + int(w.sum()) - both)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """uid, text: one row for each uid of wanted (text_key, uid). Only those texts are moved."""
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    return docs.select(text_key().alias("text_key"), text_of().alias("text")).join(side, "text_key").groupBy("uid").agg(F.min("text").alias("text"))


def verify(pairs: DataFrame, uids: DataFrame, docs: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """a, b of those pairs (materialised) whose whole multisets are as like as the threshold. uids: text_key, uid.

    Of a pair, the document with more pairs goes ahead: its text stands once
    before those of up to 1/SALTS of its partners, and a task holds that one and
    a slice of the others. So a text that many are compared with is neither sent
    with each pair nor met by all of them in one task.
    """
    degree = pairs.select(F.explode(F.array("a", "b")).alias("uid")).groupBy("uid").agg(F.count("*").alias("n"))
    ids = scratch.save(uids.join(degree, "uid").select("text_key", "uid", "n"))
    needed = scratch.save(_texts(docs, ids.select("text_key", "uid")))
    of = lambda end: ids.select(F.col("uid").alias(end), F.col("n").alias(f"n_{end}"))
    swap = F.struct("n_b", "b") > F.struct("n_a", "a")
    dealt = pairs.join(of("a"), "a").join(of("b"), "b").select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("head"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("other"))
    dealt = scratch.save(dealt.withColumn("salt", F.pmod(F.xxhash64("other"), F.lit(SALTS))))
    heads = dealt.select("head", "salt").distinct().join(needed.withColumnRenamed("uid", "head"), "head").select("head", "salt", F.lit(None).cast("long").alias("other"), "text")
    others = dealt.join(needed.withColumnRenamed("uid", "other"), "other").select("head", "salt", "other", "text")
    rows = heads.unionAll(others).repartition("head", "salt").sortWithinPartitions("head", "salt", F.col("other").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for b in slices(batches, PART_BYTES):
            doc, h, w = shingles(texts_of(b))
            cuts = np.searchsorted(doc, np.arange(b.num_rows + 1))
            like = []
            for i, other in enumerate(b.column("other").to_pylist()):
                mine = slice(cuts[i], cuts[i + 1])
                if other is None:
                    held = (h[mine].copy(), w[mine].copy())
                like.append(other is not None and _likeness(held, h[mine], w[mine]) >= threshold - 1e-12)
            kept = b.select(["head", "other"]).filter(pa.array(like, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, ["a", "b"])

    return rows.mapInArrow(tidy(run), "a long, b long")


def early_pairs(open_docs: DataFrame, uids: DataFrame, docs: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """a < b: all pairs of open_docs (uid, class, n_shingles) of different classes that a shared early shingle doesn't rule out.

    A document's shingles stand in the order of how many of these documents
    have them, rarest first. If two multisets of n and m shingles are as like as
    t, they share t / (1 + t) of n + m; so the first shingle that they share has
    as much at or behind it in both. Of a shingle, documents of its largest
    class are joined only with those of others.
    """
    held = scratch.save(open_docs)
    texts = _texts(docs, scratch.save(uids.join(held, "uid", "left_semi").select("text_key", "uid")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, PART_BYTES):
            doc, h, w = shingles(texts_of(b))
            yield pa.RecordBatch.from_arrays([b.column("uid").take(pa.array(doc)), pa.array(h.view(np.int64)), pa.array(w)], ["uid", "shingle", "weight"])

    tokens = scratch.save(texts.mapInArrow(tidy(run), "uid long, shingle long, weight long"))
    counts = scratch.save(tokens.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"))
    bound = max(2, tokens.count() // HOT_SHARE)
    often = F.coalesce("often", F.lit(1))
    hot, rest = counts.where(F.col("often") >= bound), counts.where(F.col("often") < bound)
    known = tokens.join(F.broadcast(hot.withColumnRenamed("often", "hot")), "shingle", "left")
    counted = known.where("hot is not null").select("uid", "shingle", "weight", F.col("hot").alias("often")).unionAll(known.where("hot is null").join(rest, "shingle", "left").select("uid", "shingle", "weight", often.alias("often")))
    before = Window.partitionBy("uid").orderBy("often", "shingle").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("weight").over(before), F.lit(0))).where("often > 1").join(held, "uid").withColumn("left", F.col("n_shingles") - F.col("before"))
    early = scratch.save(placed.where(F.col("left") >= F.col("n_shingles") * threshold - 1e-9).select("uid", "shingle", "class", "n_shingles", "left"))
    # of each shingle that more than one class has, its largest class
    by_class = early.groupBy("shingle", "class").agg(F.count("*").alias("n"))
    largest = by_class.groupBy("shingle").agg(F.max(F.struct("n", "class")).alias("most"), F.count("*").alias("classes")).where("classes > 1").select("shingle", F.col("most.class").alias("largest"))
    met = scratch.save(early.join(largest, "shingle"))
    x, y = met.where("class <> largest").alias("x"), met.alias("y")
    share = (F.col("x.n_shingles") + F.col("y.n_shingles")) * (threshold / (1 + threshold)) - 1e-9
    once = (F.col("y.class") == F.col("y.largest")) | (F.col("x.uid") < F.col("y.uid"))
    fits = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.class") != F.col("y.class")) & once & (F.least("x.left", "y.left") >= share)
    return x.join(y, fits).select(F.least("x.uid", "y.uid").alias("a"), F.greatest("x.uid", "y.uid").alias("b")).distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """key, class: the least key of each connected component, of all keys in links (a, b).

    Large-star and small-star steps in turn: each shuffles as many rows as there
    are links, and some ten of them suffice for millions of keys in a chain.
    """
    edges = scratch.save(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("key"), F.col("b").alias("class"))
    while True:
        around = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("b"), F.col("m")).where("b > m").distinct()
        small_least = large.groupBy("b").agg(F.min("m").alias("least"))
        small = large.join(small_least, "b").select(F.col("least").alias("a"), F.explode(F.array("b", "m")).alias("b")).where("a < b").distinct()
        new = scratch.save(small)
        # done when every key has one parent, and no parent is a child
        parents = new.groupBy("b").agg(F.count("*").alias("n"))
        if parents.where("n > 1").isEmpty() and new.select("a").join(parents.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            return new.select(F.col("b").alias("key"), F.col("a").alias("class")).unionAll(new.select(F.col("a").alias("key"), F.col("a").alias("class")).distinct())
        edges = new


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id, n_shingles, text_key, class, one row per row of docs. class_id: the least doc_id among all whose texts are linked.

    Texts are linked if they are equal or if their multisets of five-word
    shingles are as like as the threshold; links join into classes. Null texts
    are empty, and all texts without words that are equal form one class.
    Repeated rows share a class; null ids never name a class unless all its ids
    are null; ids may be of any type with an order. Other columns are not read.
    An empty table gives an empty one.
    """
    docs = docs.select("doc_id", "text")
    with Scratch(docs.sparkSession) as scratch:
        sketches = materialise(sketch(docs))
        # from here on one row per distinct text: copies never meet in a band
        distinct = sketches.groupBy("text_key").agg(F.min("doc_id").alias("least_id"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands"))
        texts = scratch.save(distinct.withColumn("uid", F.monotonically_increasing_id()))
        uids = texts.select("text_key", "uid")
        in_band = texts.where("n_shingles > 0").select("uid", "n_shingles", F.explode("bands").alias("key"))
        shared = in_band.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        together = scratch.save(in_band.join(shared, "key"))
        # a band's first partner is the document that meets most others over all its bands: what copies were made from, rather than one of them
        met = together.groupBy("uid").agg(F.sum("n").alias("met"))
        known = scratch.save(together.join(met, "uid").select("key", "uid", "met", "n_shingles"))
        centre = known.groupBy("key").agg(F.max(F.struct("met", "uid")).alias("c")).select("key", F.col("c.uid").alias("centre"))
        members = scratch.save(known.join(centre, "key").select("key", "centre", "uid", "n_shingles"))
        tested = scratch.save(members.where("centre <> uid").select(F.least("centre", "uid").alias("a"), F.greatest("centre", "uid").alias("b")).distinct())
        links = scratch.save(verify(tested, uids, docs, threshold, scratch))
        classes = scratch.save(components(links, scratch))
        # second round: the documents of bands that hold more than one class
        found = classes.withColumnRenamed("key", "uid")
        labelled = members.join(found, "uid", "left").withColumn("class", F.coalesce("class", "uid"))
        spread = labelled.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo < hi").select("key")
        open_docs = labelled.join(spread, "key", "left_semi").select("uid", "class", "n_shingles").distinct()
        pairs = scratch.save(early_pairs(open_docs, uids, docs, threshold, scratch).join(tested, ["a", "b"], "left_anti"))
        more = scratch.save(verify(pairs, uids, docs, threshold, scratch))
        if not more.isEmpty():
            classes = scratch.save(components(links.unionAll(more), scratch))
        named = texts.select("text_key", "least_id", "uid").join(classes.withColumnRenamed("key", "uid"), "uid", "left").withColumn("class", F.coalesce("class", "uid"))
        least = named.groupBy("class").agg(F.min("least_id").alias("class_id"))
        class_ids = materialise(named.join(least, "class").select("text_key", "class", "class_id"))
    return sketches.select("doc_id", "text_key", "n_shingles").join(class_ids, "text_key").select("doc_id", "class_id", "n_shingles", "text_key", "class")


def one_of_each(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of docs for each class, with all columns: of the texts that have the class's least doc_id, the one with the least key.

    Of rows that share id and text the one stays whose other columns, as JSON in
    the order of their names, come first; rows that are equal count as one.
    Other columns may have any names and hold anything.
    """
    found = near_duplicates(docs, threshold)
    first = found.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("text_key"))).alias("k"))
    keepers = materialise(first.select(F.col("k.doc_id").alias("id"), F.col("k.text_key").alias("key")))
    # the row is packed, so no column of it can clash; texts are told apart by their key
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_key().alias("key"), F.col("doc_id").alias("id"))
    joined = packed.join(keepers.withColumnRenamed("id", "kept").withColumnRenamed("key", "kept_key"), (F.col("key") == F.col("kept_key")) & F.col("id").eqNullSafe(F.col("kept")))
    rest = F.to_json(F.struct(*[F.col("row").getField(c).alias(f"c{i}") for i, c in enumerate(sorted(docs.columns)) if c != "text"]))
    order = Window.partitionBy("key", "id").orderBy(rest)
    return joined.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
