"""Exact integer k-means whose distances are screened by block norms.

Each vector is cut into blocks, and of each block its share along the diagonal and
the norm of the rest are kept. By Cauchy and Schwarz the distance of two such
short vectors is at most that of the whole ones, so a centroid whose bound is
above a distance already found needs no distance of its own. Those that remain
get exact integer distances, so screening never changes a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import Scratch, materialise
from cohortica.llm.integer_vectors import TOTALS, check_range, decimals, floor_means, greatest, integers, is_finite, matrix, totals_batch

#: Components of a block; the last one may be shorter.
BLOCK = 8
#: A bound counts only beyond this share of both norms: it is worked out in single precision, 2**-24 of a norm off at most.
SLACK = 1e-6


def block_norms(x: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Of each block of each row: its share along the diagonal, and the norm of the rest."""
    starts = np.arange(0, x.shape[1], block)
    size = np.diff([*starts, x.shape[1]])
    total = np.add.reduceat(x.astype(np.float64), starts, axis=1)
    along = total / np.sqrt(size)
    rest = np.sqrt(np.maximum(np.add.reduceat(x.astype(np.float64) ** 2, starts, axis=1) - along**2, 0))
    return np.concatenate([along, rest], axis=1).astype(np.float32)


def lower_bounds(short: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """At most the distance of each vector to each centre; both as block_norms gives them."""
    a, b = short.astype(np.float64), centres.astype(np.float64)
    aa, bb = (a * a).sum(axis=1), (b * b).sum(axis=1)
    return np.sqrt(np.maximum(aa[:, None] - 2 * a @ b.T + bb[None, :], 0)) - SLACK * (np.sqrt(aa)[:, None] + np.sqrt(bb)[None, :] + 1)


def nearest(x: np.ndarray, short: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of the nearest centre (the smaller one of equals), exact squared distance, and how many exact distances each row took."""
    bound = lower_bounds(short, block_norms(centres))
    at = np.arange(len(x))
    exact = lambda rows, c: ((x[rows] - c) ** 2).sum(axis=1)
    label = bound.argmin(axis=1)
    best = exact(at, centres[label])
    taken = np.ones(len(x), np.int32)
    first = label.copy()
    for j in range(len(centres)):
        open_ = np.flatnonzero((bound[:, j] <= np.sqrt(best)) & (first != j))
        d = exact(open_, centres[j])
        better = (d < best[open_]) | ((d == best[open_]) & (j < label[open_]))
        best[open_[better]], label[open_[better]] = d[better], j
        taken[open_] += 1
    return label, best, taken


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64) -> DataFrame:
    """key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256, exact_distances of each vector that is kept.

    Kept: vectors of exactly `width` components, none null, NaN or infinite; x
    counts as floor(scale * x). Centroids begin as the vectors whose keys have the
    least sha256 of '1:<key>', a null key last, equal ones by their integers; with
    fewer vectors than k there are fewer centroids. Each of the rounds ends with one
    small aggregate; an empty centroid stays. Repeated rows each have a row. Other
    columns are not looked at. A table of which nothing is kept gives no rows.
    """
    spark = vectors.sparkSession
    with Scratch(spark) as scratch:
        chosen = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector")).where(is_finite(F.col("vector")) & (F.size("vector") == width))
        whole = chosen.select("key", integers(F.col("vector"), scale).alias("ints"))
        n, most = greatest(whole, "ints")
        check_range(n, most, width)

        def shorten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                short = block_norms(matrix(b.column("ints"), width))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeListArray.from_arrays(short.reshape(-1), short.shape[1]).cast(pa.list_(pa.float32()))], [*b.schema.names, "short"])

        kind = whole.schema["key"].dataType.simpleString()
        kept = scratch.save(whole.withColumn("ints", F.col("ints").cast("array<int>")).mapInArrow(shorten, f"key {kind}, ints array<int>, short array<float>"))
        drawn = F.sha2(F.concat(F.lit("1:"), F.col("key").cast("string")), 256)
        first = kept.orderBy(drawn.asc_nulls_last(), "ints").limit(k).select("ints").collect()
        centres = np.array([r["ints"] for r in first], np.int64).reshape(1, len(first), width)

        def labelled(batches: Iterator[pa.RecordBatch], sent) -> Iterator[tuple]:
            for b in batches:
                x = matrix(b.column("ints"), width).astype(np.int64)
                yield b, x, *nearest(x, matrix(b.column("short"), 2 * -(-width // BLOCK)), sent.value[0])

        for _ in range(rounds if n else 0):
            sent = spark.sparkContext.broadcast(centres)

            def add(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
                sums, counts = np.zeros(sent.value.shape, np.int64), np.zeros(sent.value.shape[:2], np.int64)
                for _, x, label, _, _ in labelled(batches, sent):
                    np.add.at(sums[0], label, x)
                    counts[0] += np.bincount(label, minlength=counts.shape[1])
                yield totals_batch(sums, counts)

            centres = floor_means(kept.mapInArrow(add, TOTALS), centres)
            sent.unpersist()
        sent = spark.sparkContext.broadcast(centres)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b, _, label, best, taken in labelled(batches, sent):
                yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(label.astype(np.int32)), pa.array(best), pa.array(taken)], ["key", "cluster", "distance", "exact_distances"])

        made = materialise(kept.mapInArrow(run, f"key {kind}, cluster int, distance long, exact_distances int"))
    sums = {r["cluster"]: r["d"] for r in made.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row a centroid
    shas = [hashlib.sha256(decimals(c.tolist()).encode()).hexdigest() for c in centres[0]]
    of = lambda values, kind: F.lit(values or [None]).cast(f"array<{kind}>")[F.col("cluster")]
    return made.select(
        F.col("key").alias(key), "cluster", "distance", of([sums.get(i, 0) for i in range(len(shas))], "bigint").alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"),
        of(shas, "string").alias("centroid_sha256"), "exact_distances",
    )
