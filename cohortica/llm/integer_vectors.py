"""Vectors as exact integers, and centres that are floors of integer means: what the vector operators share."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a task adds up: a row for each centre and position that it met.
TOTALS = "part int, entry int, position int, total long, n long"


def is_finite(vector: Column) -> Column:
    """Neither null nor holding a null, NaN or infinite component."""
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: fits(x.cast("double")))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as array<long>."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def greatest(kept: DataFrame, ints: str) -> tuple[int, int]:
    """Number of rows and the largest absolute component of an integer column."""
    r = kept.agg(F.count("*").alias("n"), F.max(F.greatest(F.array_max(ints), -F.array_min(ints))).alias("m")).first()
    return r["n"], r["m"] or 0


def check_range(rows: int, most: int, width: int) -> None:
    """A 64-bit integer must hold each squared distance and each sum over all rows; raises otherwise, as a wrapped result would be wrong."""
    if most >= 1 << 29 or 4 * width * most * most * max(rows, 1) >= 1 << 63:
        raise OverflowError(f"components up to {most} of {rows} rows don't fit 64-bit sums of squared distances")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column without nulls whose lists have `width` numbers, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def totals_batch(sums: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """TOTALS of sums (part, entry, position) and counts (part, entry); entries that were met only."""
    part, entry = np.nonzero(counts)
    width = sums.shape[2]
    named = {"part": np.repeat(part, width).astype(np.int32), "entry": np.repeat(entry, width).astype(np.int32), "position": np.tile(np.arange(width, dtype=np.int32), len(part)), "total": sums[part, entry].reshape(-1), "n": np.repeat(counts[part, entry], width)}
    return pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in named.items()})


def floor_means(totals: DataFrame, centres: np.ndarray) -> np.ndarray:
    """centres (part, entry, position) with those that rows were put to replaced by floor(sum / count); at most one row a number reaches the driver."""
    moved = centres.copy()
    summed = totals.groupBy("part", "entry", "position").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    for r in summed.toLocalIterator():
        moved[r["part"], r["entry"], r["position"]] = int(r["total"]) // r["n"]
    return moved


def decimals(numbers: Iterable[int]) -> str:
    return ",".join(map(str, numbers))
