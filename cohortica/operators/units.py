"""Work that falls into independent units, such as (model, resample): each unit is a row, and rows are spread evenly over tasks.

A shuffle by a unit's key would let keys collide, and adaptive execution would
put so little data into one task; so units are numbered and dealt out by ranges of
their numbers. What a unit draws at random is a hash of the seed and the unit's own
numbers: results don't depend on partitions, retries or the order of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well-known 64-bit finaliser; its shifts and factors are fixed values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed(seed: int, *parts: int | np.ndarray) -> np.ndarray:
    """A 64-bit hash of the seed and of whole numbers; arrays are combined as numpy broadcasts them."""
    with np.errstate(over="ignore"):
        h = _mixed(np.atleast_1d(np.uint64(seed % (1 << 64))))
        for p in parts:
            h = _mixed(h * np.uint64(0x9E3779B97F4A7C15) + np.asarray(p).astype(np.int64).astype(np.uint64))
    return h


def uniform(seed: int, *parts: int | np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that the hash decides."""
    return ((hashed(seed, *parts) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def resample(seed: int, n: int, slots: int, *unit: int) -> np.ndarray:
    """Which of n rows stand in each slot of a resample with replacement."""
    return (hashed(seed, *unit, np.arange(slots)) % np.uint64(n)).astype(np.int64)


#: Each unit is a task of its own up to so many; more units share tasks evenly.
MOST_TASKS = 10_000


def run_units(spark: SparkSession, units: list[tuple], names: str, run: Callable[..., Iterator[tuple]], schema: str, finished: DataFrame | None = None) -> DataFrame:
    """The rows (schema) that run(*unit) gives for each of units (names: their columns' schema).

    finished: a table with the units' columns; a unit that stands there isn't run,
    so a run that was broken off goes on from what was written.
    """
    columns = [f.split(" ")[0] for f in names.split(", ")]
    if finished is not None and units:
        done = {tuple(r) for r in finished.select(*columns).distinct().collect()}  # no more than there are units
        units = [u for u in units if u not in done]
    if not units:
        return spark.createDataFrame([], schema)
    table = spark.createDataFrame([(i, *u) for i, u in enumerate(units)], f"unit long, {names}")
    wanted = [f.split(" ")[0] for f in schema.split(", ")]

    def task(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            for unit in frame.sort_values("unit")[columns].itertuples(index=False, name=None):
                yield pd.DataFrame(list(run(*unit)), columns=wanted)

    return table.repartitionByRange(min(len(units), MOST_TASKS), "unit").mapInPandas(task, schema)
