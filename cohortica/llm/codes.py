"""Compression of vectors to one byte for each part, by codebooks that weighted Lloyd rounds fit to the distinct integer parts.

Equal parts of one position become one row with a weight, so a vector that a
third of the table repeats costs as much as one that stands once; the rounds
then run over distinct values only, and one join brings codes and errors back to
the vectors. All numbers are integers: results don't depend on partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Scratch, join_by_weight, materialise
from cohortica.llm.integer_vectors import TOTALS, check_range, decimals, floor_means, greatest, integers, is_finite, matrix, totals_batch

#: Rows that meet all entries at a time, in a task.
ROWS_AT_ONCE = 2048


@dataclass(frozen=True)
class Codebooks:
    """entries: (part, entry, position within the part), int64."""

    entries: np.ndarray
    scale: int

    @property
    def sha256(self) -> str:
        return hashlib.sha256(decimals(self.entries.reshape(-1).tolist()).encode()).hexdigest()


def _nearest(values: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry (the lower one of equals) and exact squared distance of each row."""
    most = max(int(np.abs(values).max(initial=0)), int(np.abs(entries).max(initial=0)))
    # doubles hold these integers exactly, and multiply faster
    kind = np.float64 if 4 * values.shape[1] * most * most < 1 << 53 else np.int64
    v, c = values.astype(kind), entries.astype(kind)
    d = (v * v).sum(axis=1)[:, None] - 2 * (v @ c.T) + (c * c).sum(axis=1)[None, :]
    at = d.argmin(axis=1)
    return at, d[np.arange(len(v)), at].astype(np.int64)


def _assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of (part, value, weight) with parts, values, entries and errors."""
    for b in batches:
        for s in range(0, b.num_rows, ROWS_AT_ONCE):
            x = b.slice(s, ROWS_AT_ONCE)
            part, values = x.column("part").to_numpy(), matrix(x.column("value"), books.shape[2]).astype(np.int64)
            entry, error = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for p in np.unique(part):
                mine = part == p
                entry[mine], error[mine] = _nearest(values[mine], books[p])
            yield x, part, values, entry, error


def fit(distinct: DataFrame, seeds: np.ndarray, rounds: int, scale: int) -> Codebooks:
    """Weighted Lloyd from seeds (part, entry, position) over distinct (part, value, weight), one aggregate of at most a row a number each round."""
    books = seeds
    for _ in range(rounds):
        sent = distinct.sparkSession.sparkContext.broadcast(books)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            books = sent.value
            sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
            for x, part, values, entry, _ in _assigned(batches, books):
                weight = x.column("weight").to_numpy()
                np.add.at(sums, (part, entry), values * weight[:, None])
                np.add.at(counts, (part, entry), weight)
            yield totals_batch(sums, counts)

        books = floor_means(distinct.mapInArrow(run, TOTALS), books)
        sent.unpersist()
    return Codebooks(books, scale)


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks | None]:
    """key, label, code (two hex digits a part), error, label_error of each vector that is kept, and the codebooks.

    Dropped: null vectors and those with a null, NaN or infinite component. A
    component x counts as floor(scale * x). Codebooks begin as the parts of the
    vectors of the least keys, null ones last, ties by the vector's integers; with
    fewer vectors than entries they are shorter. The vectors' length is the one
    that most kept ones have (the longer of equals) and must be a multiple of
    parts; a vector of another length stays, with null code and error. Repeated
    rows each have a row. label_error is the error summed over equal labels, null
    ones together. Other columns are not looked at. An empty table, or one of
    which nothing is kept, gives no rows and no codebooks. entries: 256 at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    spark = vectors.sparkSession
    out_type = lambda d: d.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error")
    with Scratch(spark) as scratch:
        chosen = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")).where(is_finite(F.col("vector")))
        # the numbers of the rows are fixed by being written
        kept = scratch.save(chosen.select(F.monotonically_increasing_id().alias("row"), "key", "label", integers(F.col("vector"), scale).alias("ints")))
        usual = kept.groupBy(F.size("ints").alias("width")).count().orderBy(F.col("count").desc(), F.col("width").desc()).first()
        if usual is None:
            return out_type(kept.select("key", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")).limit(0)), None
        width = usual["width"]
        if width == 0 or width % parts:
            raise ValueError(f"vectors of {width} components can't be cut into {parts} equal parts")
        n, most = greatest(kept, "ints")
        check_range(n, most, width)
        kept = kept.withColumn("ints", F.col("ints").cast("array<int>"))
        fitting = kept.where(F.size("ints") == width)
        first = fitting.orderBy(F.col("key").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
        seeds = np.array([r["ints"] for r in first], np.int64).reshape(len(first), parts, width // parts).transpose(1, 0, 2)
        cut = F.array(*[F.slice("ints", 1 + p * (width // parts), width // parts) for p in range(parts)])
        pieces = fitting.select("row", F.posexplode(cut).alias("part", "value"))
        distinct = scratch.save(pieces.groupBy("part", "value").agg(F.count("*").alias("weight")))
        books = fit(distinct, seeds, rounds, scale)
        sent = spark.sparkContext.broadcast(books.entries)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, _, _, entry, error in _assigned(batches, sent.value):
                yield pa.RecordBatch.from_arrays([*x.columns, pa.array(entry.astype(np.int32)), pa.array(error)], [*x.schema.names, "entry", "piece_error"])

        coded = scratch.save(distinct.mapInArrow(run, "part int, value array<int>, weight long, entry int, piece_error long"))
        back = join_by_weight(pieces, coded, ["part", "value"], "weight", n * parts)
        digits = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "entry"))), lambda s: F.lower(F.lpad(F.hex(s["entry"]), 2, "0"))), "")
        whole = back.groupBy("row").agg(digits.alias("code"), F.sum("piece_error").alias("error"))
        made = scratch.save(kept.select("row", "key", "label").join(whole, "row", "left").drop("row"))
        by_label = scratch.save(made.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("weight")))
        return materialise(out_type(join_by_weight(made, by_label, ["label"], "weight", n))), books


def reconstruct(codes: DataFrame, books: Codebooks, code: str = "code", into: str = "vector") -> DataFrame:
    """codes with the vectors that they stand for, the middles of the integers' ranges divided by the scale; a null code gives null."""
    table = F.lit([[((e + 0.5) / books.scale).tolist() for e in p] for p in books.entries])
    index = lambda p: F.conv(F.substring(code, 2 * p + 1, 2), 16, 10).cast("int")
    parts = F.concat(*[table[p][index(p)] for p in range(len(books.entries))])
    return codes.withColumn(into, F.when(F.col(code).isNotNull(), parts))
