"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but blank, tab and the line breaks.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast only up to so many rows.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: Elements of a block of running().
RUN_BLOCK = 512


def running(values: Column, merge: Callable[[Column, Column], Column], zero: int) -> Column:
    """For each element of an array of ints, what merge (associative) makes of zero and all elements before it. values is named often: a column or a lambda's variable.

    An array can only grow by being copied, so elements are run through in blocks,
    and what comes before a block is run through over one value a block.
    """
    start = F.lit(zero).cast("int")
    both = lambda a, b: merge(a, b)

    def simple(x: Column, first: Column) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(x, F.struct(first.alias("at"), none.alias("out")), lambda acc, v: F.struct(merge(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    of_block = lambda f: F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN_BLOCK).cast("int")), lambda i: f(F.slice(values, i * RUN_BLOCK + 1, F.lit(RUN_BLOCK))))
    before = simple(of_block(lambda b: F.aggregate(b, start, both)), start)
    return F.when(F.size(values) <= RUN_BLOCK, simple(values, start)).otherwise(F.flatten(F.zip_with(of_block(lambda b: b), before, simple)))


#: Code points of a piece of cut_text.
TEXT_PIECE = 256


def cut_text(text: Column) -> Column:
    """The text in pieces of TEXT_PIECE code points, for text_between."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_PIECE}}}"), F.lit(0))


def text_between(pieces: Column, start: Column, end: Column) -> Column:
    """Code points start to end - 1 of a text that was cut: only the pieces that hold them are looked at, not all that stands before."""
    first = F.floor(start / TEXT_PIECE).cast("int")
    n = F.floor(end / TEXT_PIECE).cast("int") - first + 1
    return F.substr(F.array_join(F.slice(pieces, first + 1, n), ""), start - first * TEXT_PIECE + 1, end - start)


def unit_draw(*key: Column) -> Column:
    """A number in (0, 1) that the key alone decides."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / float(2**53)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names; one of our own only where driver and executors are one process, as in tests."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortica-"))
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cohortica-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends there, any executor may be lost.

    The folder is removed when the driver's Python ends.
    """
    out, path = _written(df)
    atexit.register(_remove, df.sparkSession, path)
    return out


class Scratch:
    """Materialised tables that are removed when the with block ends; what outlives it must have been materialised beside them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *error) -> None:
        for path in self.paths:
            _remove(self.spark, path)

    def save(self, df: DataFrame) -> DataFrame:
        out, path = _written(df)
        self.paths.append(path)
        return out


def _remove(spark: SparkSession, path: str) -> None:
    try:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session is gone: nothing can be removed any more
        pass


def broadcast_if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df with a broadcast hint if a count shows that it is small; df must be cheap to count (materialised)."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


#: A key with more than one in so many rows is hot; there are fewer than so many of them.
HOT_SHARE = 1024


def join_by_weight(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """rows joined to keyed, which has one row for each of the keys' values (nulls equal each other) and in `weight` how many of `total` rows have it.

    Hot values, fewer than HOT_SHARE of them, are broadcast, so that no task gets
    all rows of one; all others are joined by a shuffle. Both inputs are read
    twice: they must be cheap to read (materialised). weight isn't kept.
    """
    hot = F.col(weight) * HOT_SHARE > total
    added = [c for c in keyed.columns if c not in (*keys, weight)]
    side = lambda which: keyed.where(which).select(*[F.col(k).alias(f"__of_{k}") for k in keys], *added)
    same = [rows[k].eqNullSafe(F.col(f"__of_{k}")) for k in keys]
    drop = [f"__of_{k}" for k in keys]
    often = rows.join(F.broadcast(side(hot)), same).drop(*drop)
    seldom = rows.join(F.broadcast(side(hot).drop(*added)), same, "left_anti").join(side(~hot), same).drop(*drop)
    return often.unionByName(seldom)


def slices(batches: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in runs of about `most` bytes of text, one row at least: what a task holds as Python values doesn't follow a batch's length."""
    for b in batches:
        start, size = 0, 0
        for i, n in enumerate(pc.fill_null(pc.binary_length(b.column(column)), 0).to_pylist()):
            size += n + 1
            if size >= most:
                yield b.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < b.num_rows:
            yield b.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts, null ones as empty."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, which gives the memory that it has freed back to the system when a task ends: workers stay alive between tasks."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
            if trim:
                trim(0)

    return tidied
