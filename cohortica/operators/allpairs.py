"""What is summed up over all pairs of rows, without a table of the pairs.

Rows are dealt to blocks of bounded size, a row and a partition each, which are fixed once. Every two
blocks meet in a task of a Cartesian product, which reads them where they are fixed, and their
distances are made in pieces of some ten thousand pairs and summed up at once. The work is
quadratic, but a task holds two blocks; tasks grow in number, not in size, and what is
shuffled are rows (once, whatever the number of blocks) and sums. A pair is two rows of different
keys; rows without a key are in none. The term of a coordinate that a row lacks is left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortica.operators.distance import distance_correlation
from cohortica.operators.numbering import checkpointed

#: Rows of a block, on average at most; so many blocks even of fewer rows, if these fill so many of SMALL_ROWS; pairs of a piece, which stays in a core's cache.
BLOCK_ROWS, LEAST_BLOCKS, SMALL_ROWS, PIECE = 16_384, 12, 512, 1 << 15
#: A distance's bin is its bits but for the last so many: 14 of its digits are left, then 26.
COARSE, FINE = 38, 26
#: So many values at most are taken out of the bins that quartiles fall into; more are counted in finer bins first.
MOST_VALUES = 1_000_000

#: (method, columns)
Measure = tuple[str, Sequence[str]]


def _manhattan(a: np.ndarray, b: np.ndarray, whole: bool) -> np.ndarray:
    out, t = np.zeros((len(a), len(b))), np.empty((len(a), len(b)))
    for x, y in zip(a.T, np.ascontiguousarray(b.T), strict=True):
        np.subtract(x[:, None], y[None, :], out=t)
        np.abs(t, out=t)
        if not whole:
            t[np.isnan(t)] = 0.0
        out += t
    return out


def _euclidean(a: np.ndarray, b: np.ndarray, whole: bool) -> np.ndarray:
    """By products; for near rows, where products lose digits, by differences."""
    if not whole:
        t = a[:, None, :] - b[None, :, :]
        return np.sqrt(np.nansum(t * t, axis=2))
    size = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :]
    d = size - 2 * (a @ b.T)
    i, j = np.nonzero(d < 1e-4 * size)
    for at in range(0, len(i), 1024):
        t = a[i[at : at + 1024]] - b[j[at : at + 1024]]
        d[i[at : at + 1024], j[at : at + 1024]] = (t * t).sum(axis=1)
    return np.sqrt(np.maximum(d, 0, out=d), out=d)


class Met:
    """Two blocks, or a block and itself: ids, marks and coordinates of both."""

    def __init__(self, pair: tuple[int, int], blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], measures: list[tuple[str, list[int]]], ranges: np.ndarray):
        self.pair, self.same = pair, pair[0] == pair[1]
        self.ids, self.marks, parts = ([b[i] for b in blocks] for i in range(3))
        self.whole = all(bool(np.isfinite(x).all()) for x in parts)
        # products of small numbers keep more digits
        middle = sum(x.sum(axis=0) for x in parts) / sum(len(x) for x in parts) if self.whole else 0.0

        def of_method(m: str, x: np.ndarray) -> np.ndarray:
            if m == "gower":  # without a range a coordinate counts 0
                return np.where(ranges > 0, x / np.where(ranges > 0, ranges, 1), np.where(np.isnan(x), np.nan, 0.0))
            return x - middle if m == "euclidean" else x

        with np.errstate(divide="ignore", invalid="ignore"):
            self.sides = [(m, len(at), *(np.ascontiguousarray(of_method(m, x)[:, at]) for x in parts)) for m, at in measures]

    def pieces(self) -> Iterator[tuple[slice, np.ndarray | None, list[np.ndarray]]]:
        """Rows of the first block, which of their pairs count (None: all), and by measure their distances to all of the second."""
        n, m = len(self.ids[0]), len(self.ids[1])
        step = max(1, PIECE // max(m, 1))
        for at in range(0, n if m else 0, step):
            rows = slice(at, min(n, at + step))
            made = []
            for method, p, a, b in self.sides:
                d = (_euclidean if method == "euclidean" else _manhattan)(a[rows], b, self.whole)
                made.append(d / p if method == "gower" else d)
            yield rows, self.ids[0][rows, None] < self.ids[1][None, :] if self.same else None, made

    def values(self) -> Iterator[list[np.ndarray]]:
        """By measure, distances of the pairs that count."""
        for _, keep, made in self.pieces():
            made = [d.ravel() if keep is None else d[keep] for d in made]
            if len(made[0]):
                yield made


@dataclass
class Blocks:
    """Rows packed into blocks (block, rows: id, mark, x), a partition each, and fixed, so that several passes may read them; measures by numbers of coordinates, and ranges of these."""

    packed: DataFrame
    n: int
    rows: int
    measures: list[tuple[str, list[int]]]
    ranges: np.ndarray


def blocks_of(df: DataFrame, key: str, measures: Sequence[Measure], mark: str | None = None, rows: int | None = None) -> Blocks:
    """df's rows in blocks, shuffled twice (to be packed, and to partitions of their own) and written once."""
    if unknown := {m for m, _ in measures} - {"euclidean", "manhattan", "gower"}:
        raise ValueError(f"unknown distance: {', '.join(sorted(unknown))}")
    columns = sorted({c for _, cs in measures for c in cs})
    x = df.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), (F.col(mark) if mark else F.lit(0)).alias("mark"), F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in columns]).alias("x"))
    span = lambda i: F.nanvl(F.col("x")[i], F.lit(None).cast("double"))
    one = x.agg(F.count("*").alias("rows"), *[(F.max(span(i)) - F.min(span(i))).alias(f"r{i}") for i in range(len(columns))]).first()
    n = max(1, min(LEAST_BLOCKS, -(-one["rows"] // SMALL_ROWS)), -(-one["rows"] // (rows or BLOCK_ROWS)))
    packed = x.groupBy(F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("block")).agg(F.collect_list(F.struct("id", "mark", "x")).alias("rows"))
    ranges = np.array([one[f"r{i}"] or 0.0 for i in range(len(columns))])
    return Blocks(checkpointed(packed.repartitionById(n, "block")), n, one["rows"], [(m, [columns.index(c) for c in cs]) for m, cs in measures], ranges)


def over_blocks(blocks: Blocks, run: Callable[[Iterator[Met]], Iterator], schema: str) -> DataFrame:
    """The rows (frames of schema) that run gives for the pairs of blocks of a task; every two blocks, and each block and itself, are in one task."""
    kinds = to_arrow_schema(T.StructType.fromDDL(schema))
    # what a task needs of Blocks, without the table
    measures, ranges, width = blocks.measures, blocks.ranges, len(blocks.ranges)

    def unpacked(rows: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, marks, x = (rows.values.field(c) for c in ("id", "mark", "x"))
        return ids.to_numpy(zero_copy_only=False), marks.to_numpy(zero_copy_only=False), x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[Met]:
        for b in batches:
            for i, j, first, second in zip(*(b.column(c) for c in ("i", "j", "first", "second")), strict=True):
                yield Met((i.as_py(), j.as_py()), [unpacked(first), unpacked(second)], measures, ranges)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in run(met(batches)):
            yield pa.RecordBatch.from_pandas(frame, kinds, preserve_index=False)

    first = blocks.packed.select(F.col("block").alias("i"), F.col("rows").alias("first"))
    second = blocks.packed.select(F.col("block").alias("j"), F.col("rows").alias("second"))
    # in a circle of blocks each meets those of the half after it, so that as many fall to each
    off, n = F.pmod(F.col("j") - F.col("i"), F.lit(blocks.n)) * 2, blocks.n
    meet = (off < n) | ((off == n) & (F.col("i") < F.col("j")))
    # every two partitions are read where they are fixed: neither side is shuffled or broadcast; a task takes several, and sums them up
    tasks = max(3 * blocks.packed.sparkSession.sparkContext.defaultParallelism, n * n // 32)
    return first.hint("shuffle_replicate_nl").join(second, meet).coalesce(tasks).mapInArrow(task, schema)


def _bins(d: np.ndarray, shift: int) -> np.ndarray:
    return np.ascontiguousarray(d).view(np.int64) >> shift


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bins and counts of all parts, each bin once."""
    if not parts:
        return []
    bins, at = np.unique(np.concatenate([b for b, _ in parts]), return_inverse=True)
    return [(bins, np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64))]


def _counts(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = int(bins.min())
    if int(bins.max()) - low < 1 << 18:
        n = np.bincount(bins - low)
        at = np.flatnonzero(n)
        return at + low, n[at]
    return np.unique(bins, return_counts=True)


_SCHEMA = "what int, bin long, n long, v array<double>"


def _passed(blocks: Blocks, bin_of: Callable[[int, np.ndarray], np.ndarray] | None, moments: bool = False):
    """One pass over all pairs: rows what, bin, n, v. bin_of(measure, distances): bins to be counted; moments: of what = -1, a row for each task."""
    many = len(blocks.measures)

    def run(mets: Iterator[Met]) -> Iterator:
        import pandas as pd

        total, low, high, held, name = None, np.full(many, np.inf), np.full(many, -np.inf), [[] for _ in range(many)], 0
        for met in mets:
            name = met.pair[0] * (1 << 31) + met.pair[1]
            for made in met.values():
                if moments:
                    total, low, high = _moved(total, low, high, made)
                for m, d in enumerate(made if bin_of else []):
                    bins = bin_of(m, d)
                    if len(bins):
                        held[m].append(_counts(bins))
                    if len(held[m]) > 64:
                        held[m] = _summed(held[m])
        if total:
            yield pd.DataFrame({"what": [-1], "bin": [name], "n": [total[0]], "v": [np.concatenate([total[1], total[2].ravel(), low, high]).tolist()]})
        for m, parts in enumerate(held):
            for bins, n in _summed(parts):
                yield pd.DataFrame({"what": m, "bin": bins, "n": n, "v": None})

    made = over_blocks(blocks, run, _SCHEMA)
    # counts of bins are added up; of each task the moments have a bin of their own, named by the last two blocks
    return made.groupBy("what", "bin").agg(F.sum("n").alias("n"), F.first("v").alias("v")).toPandas().sort_values(["what", "bin"])


def _moved(total: tuple | None, low: np.ndarray, high: np.ndarray, made: list[np.ndarray]) -> tuple:
    """Number, means and products so far, least and greatest, with more pairs' distances."""
    v = np.vstack(made)
    mean, low, high = v.mean(axis=1), np.minimum(low, v.min(axis=1)), np.maximum(high, v.max(axis=1))
    v -= mean[:, None]
    return _joined(total, (v.shape[1], mean, v @ v.T)), low, high


def _joined(a: tuple | None, b: tuple) -> tuple:
    """Number, means and products of differences from them, of two parts together."""
    if a is None:
        return b
    n, off = a[0] + b[0], b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * (b[0] / n))


def _moments(found, many: int) -> tuple | None:
    """Number, means, products, least and greatest of all pairs."""
    total, low, high = None, np.full(many, np.inf), np.full(many, -np.inf)
    for n, v in found.loc[found["what"] < 0, ["n", "v"]].itertuples(index=False):
        v = np.asarray(v, float)
        total = _joined(total, (int(n), v[:many], v[many : many + many**2].reshape(many, many)))
        low, high = np.minimum(low, v[-2 * many : -many]), np.maximum(high, v[-many:])
    return total and (*total, low, high)


def _ratio(a: float, b: float) -> float | None:
    return float(a / b) if b else None


def spreads(df: DataFrame, key: str, measures: Sequence[Measure]) -> list[dict]:
    """Of each measure: n_pairs, minimum, mean, maximum, standard_deviation, coefficient_of_variation, relative_contrast of its distances of all pairs, in one pass for all."""
    return _spreads(_moments(_passed(blocks_of(df, key, measures), None, True), len(measures)), len(measures))


def _spreads(total: tuple | None, many: int) -> list[dict]:
    names = ("minimum", "mean", "maximum", "standard_deviation", "coefficient_of_variation", "relative_contrast")
    if total is None:
        return [{"n_pairs": 0} | dict.fromkeys(names) for _ in range(many)]
    n, mean, product, low, high = total
    sd = [float(np.sqrt(product[m, m] / (n - 1))) if n > 1 else None for m in range(many)]
    values = [(float(low[m]), float(mean[m]), float(high[m]), sd[m], None if sd[m] is None else _ratio(sd[m], mean[m]), _ratio(high[m] - low[m], high[m])) for m in range(many)]
    return [{"n_pairs": n} | dict(zip(names, v, strict=True)) for v in values]


def distribution(df: DataFrame, key: str, columns: Sequence[str], method: str) -> DataFrame:
    """What distance.distance_distribution gives, of all pairs of df's rows, in a pass for moments and bins and one or two for the quartiles, which are exact."""
    blocks = blocks_of(df, key, [(method, columns)])
    found = _passed(blocks, lambda m, d: _bins(d, COARSE), True)
    one = _spreads(_moments(found, 1), 1)[0]
    place = {"first_quartile": 0.25, "median": 0.5, "third_quartile": 0.75}
    told = dict.fromkeys(place)
    if n := one["n_pairs"]:
        wanted = sorted({f((n - 1) * p) for p in place.values() for f in (np.floor, np.ceil)})
        shift, first = COARSE, dict.fromkeys(wanted, 0)  # of each wanted place, how many stand before its bin
        within = None
        while True:
            bins, counts = (found.loc[found["what"] == 0, c].to_numpy(np.int64) for c in ("bin", "n"))
            chosen, inside = {}, {}
            for w in wanted:
                part = np.arange(len(bins)) if within is None else np.flatnonzero(bins >> (before - shift) == within[w])
                upto = first[w] + np.cumsum(counts[part])
                k = int(np.searchsorted(upto, w, side="right"))
                chosen[w], first[w] = int(bins[part[k]]), int(upto[k] - counts[part[k]])
                inside[chosen[w]] = int(counts[part[k]])
            if not shift:
                break
            within, before = chosen, shift
            shift = FINE if shift == COARSE and sum(inside.values()) > MOST_VALUES else 0
            held, old, new = np.array(sorted(inside), np.int64), before, shift
            found = _passed(blocks, lambda m, d, held=held, old=old, new=new: _bins(d[np.isin(_bins(d, old), held)], new))
        at = {w: float(np.array(b, np.int64).view(float)) for w, b in chosen.items()}
        for q, p in place.items():
            x = (n - 1) * p
            low, high = at[np.floor(x)], at[np.ceil(x)]
            told[q] = low if low == high else (np.ceil(x) - x) * low + (x - np.floor(x)) * high
    names = ("n_pairs", "minimum", "first_quartile", "median", "mean", "third_quartile", "maximum", "standard_deviation", "coefficient_of_variation", "relative_contrast")
    row = tuple(float(v) if isinstance(v := (one | told)[c], np.floating) else v for c in names)
    return df.sparkSession.createDataFrame([row], "n_pairs long, " + ", ".join(f"{c} double" for c in names[1:]))


def correlations(df: DataFrame, key: str, columns: Sequence[str], methods: Sequence[str]) -> DataFrame:
    """method_1, method_2, pearson, n_pairs of every two methods over all pairs, in one pass; pearson is null where a distance is the same for all."""
    methods = sorted(methods)
    total = _moments(_passed(blocks_of(df, key, [(m, columns) for m in methods]), None, True), len(methods))
    rows = [(a, b, _of(total, i, j), total[0] if total else 0) for i, a in enumerate(methods) for j, b in enumerate(methods) if i < j]
    return df.sparkSession.createDataFrame(rows, "method_1 string, method_2 string, pearson double, n_pairs long")


def _of(total: tuple | None, i: int, j: int) -> float | None:
    return total and _ratio(total[2][i, j], np.sqrt(total[2][i, i] * total[2][j, j]))


def values(df: DataFrame, key: str, columns: Sequence[str], methods: Sequence[str]) -> DataFrame:
    """A row for each pair with a column for each method: for what needs the pairs themselves, as ranks do."""

    def run(mets: Iterator[Met]) -> Iterator:
        import pandas as pd

        for held in ([np.vstack(made) for made in met.values()] for met in mets):
            if not held:
                continue
            yield pd.DataFrame(np.hstack(held).T, columns=list(methods))

    # smaller blocks, as a group gives a row for each of its pairs at once
    return over_blocks(blocks_of(df, key, [(m, columns) for m in methods], rows=BLOCK_ROWS // 16), run, ", ".join(f"{m} double" for m in methods))


#: Up to so many pairs are ranked in a table of their own. Of more, cells of distances are counted, at first so many of them.
FEW_PAIRS, CELLS = 4_000_000, (1 << 20, 1 << 22)
#: Cells are sent in parts of so many; ranks' spread is taken within so many groups of cells; pairs that are counted at once.
PART, GROUPS, AT_ONCE = 1 << 14, 1024, 1 << 21


def rank_correlation(df: DataFrame, key: str, columns: Sequence[str], a: str, b: str, digits: int = 5) -> DataFrame:
    """pearson, spearman, n_pairs of two distances over all pairs, as distance.distance_correlation gives them; spearman is sure to so many digits.

    Ranks of all pairs would need a shuffle of them all. Cells of equal width are counted instead, in one pass, and a second one sums up the products
    of the cells' mean ranks. How far the coefficient of the pairs' own ranks can be from that follows from the cells' counts
    (see _bounded): if both ends round alike, that is it; if not, there are more cells, and at last the table of pairs.
    """
    blocks = blocks_of(df, key, [(a, columns), (b, columns)])
    if blocks.rows * (blocks.rows - 1) // 2 > FEW_PAIRS:
        for cells in CELLS:
            found = _cells_ranked(blocks, cells)
            if found is None:
                break
            (n, pearson), (low, middle, high) = found
            if round(low, digits) == round(high, digits):
                return df.sparkSession.createDataFrame([(pearson, middle, n)], "pearson double, spearman double, n_pairs long")
    return distance_correlation(values(df, key, columns, (a, b)), a, b)


def _cell(d: np.ndarray, low: float, factor: float, cells: int) -> np.ndarray:
    """Grows with a distance; 0 is for distances of 0 alone, so that copies are no wide cell."""
    return np.where(d > 0, np.clip((d - low) * factor + 1, 1, cells - 1), 0).astype(np.int32)


def _gathered(mets: Iterator[Met]) -> Iterator[list[np.ndarray]]:
    """Distances of more pairs at once than a piece has, as what is done with them takes a pass over all cells."""
    held, n = [], 0
    for met in mets:
        for made in met.values():
            held.append(made)
            n += len(made[0])
            if n >= AT_ONCE:
                yield [np.concatenate(d) for d in zip(*held, strict=True)]
                held, n = [], 0
    if held:
        yield [np.concatenate(d) for d in zip(*held, strict=True)]


def _cells_ranked(blocks: Blocks, cells: int) -> tuple | None:
    """Number of pairs and Pearson's coefficient; least, middle and greatest that Spearman's can be. None if a distance is the same for all."""
    spark = blocks.packed.sparkSession
    # some pairs tell where distances lie, which decides how wide a cell is and nothing else; those beyond fall into the outer cells
    some = [r for (rows,) in blocks.packed.select(F.slice("rows", 1, 512)).limit(1).collect() for r in rows]
    own = (np.arange(len(some)), np.zeros(len(some)), np.array([r["x"] for r in some], float).reshape(len(some), -1))
    known = list(Met((0, 0), [own, own], blocks.measures, blocks.ranges).values())
    ends = []
    for d in (np.concatenate(v) for v in zip(*known, strict=True)):
        if not (d > 0).any():
            return None
        low, high = float(d[d > 0].min()), float(d.max())
        ends.append((low, (cells - 2) / ((high - low) or 1.0)))
    if not ends:
        return None

    def counted(mets: Iterator[Met]) -> Iterator:
        import pandas as pd

        total, low, high, counts, name = None, np.full(2, np.inf), np.full(2, -np.inf), np.zeros((2, cells), np.int64), 0

        def named() -> Iterator[Met]:
            nonlocal name
            for met in mets:
                name = met.pair[0] * (1 << 31) + met.pair[1]
                yield met

        for made in _gathered(named()):
            for m, d in enumerate(made):
                counts[m] += np.bincount(_cell(d, *ends[m], cells), minlength=cells)
            total, low, high = _moved(total, low, high, made)
        if total:
            yield pd.DataFrame({"what": [-1], "bin": [name], "n": [total[0]], "v": [np.concatenate([total[1], total[2].ravel(), low, high]).tolist()], "packed": [None]})
        for m in range(2):
            parts = {at // PART: counts[m, at : at + PART] for at in range(0, cells, PART)}
            for at, part in parts.items():
                if part.any():
                    yield pd.DataFrame({"what": [m], "bin": [at], "n": [int(part.sum())], "v": [None], "packed": [zlib.compress(part.tobytes(), 1)]})

    def added(key, frame):
        import pandas as pd

        part = np.sum([np.frombuffer(zlib.decompress(p), np.int64) for p in frame["packed"]], axis=0)
        return pd.DataFrame({"what": [key[0]], "bin": [key[1]], "n": [int(part.sum())], "v": [None], "packed": [zlib.compress(part.tobytes(), 1)]})

    schema = _SCHEMA + ", packed binary"
    made = checkpointed(over_blocks(blocks, counted, schema))  # a task's counts, read twice
    total = _moments(made.where("what < 0").select("what", "bin", "n", "v").toPandas().sort_values("bin"), 2)
    if total is None or not (total[2].diagonal() > 0).all():
        return None
    counts = np.zeros((2, cells), np.int64)
    for r in made.where("what >= 0").groupBy("what", "bin").applyInPandas(added, schema).collect():  # as many rows as there are parts
        counts[r["what"], r["bin"] * PART : (r["bin"] + 1) * PART] = np.frombuffer(zlib.decompress(r["packed"]), np.int64)
    n = total[0]
    # ranks from -0.5 to 0.5
    ranks = [((np.cumsum(c) - c + (c + 1) / 2) - (n + 1) / 2) / n for c in counts]
    held = spark.sparkContext.broadcast(ranks)

    def multiplied(mets: Iterator[Met]) -> Iterator:
        import pandas as pd

        product, sums, ranks = 0.0, np.zeros((2, 2, GROUPS)), held.value
        for made in _gathered(mets):
            cell = [_cell(d, *ends[m], cells) for m, d in enumerate(made)]
            r = [ranks[m][c] for m, c in enumerate(cell)]
            product += float(r[0] @ r[1])
            for m in range(2):
                group, other = cell[m] // (cells // GROUPS), r[1 - m]
                sums[m, 0] += np.bincount(group, other, GROUPS)
                sums[m, 1] += np.bincount(group, other * other, GROUPS)
        yield pd.DataFrame({"what": [-1], "bin": [0], "s": [product], "q": [0.0]})
        for m in range(2):
            yield pd.DataFrame({"what": m, "bin": np.arange(GROUPS), "s": sums[m, 0], "q": sums[m, 1]})

    told = over_blocks(blocks, multiplied, "what int, bin long, s double, q double").groupBy("what", "bin").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).toPandas()
    product, rest = float(told.loc[told["what"] < 0, "s"].sum()), []
    for m in range(2):
        of = told[told["what"] == m].sort_values("bin")
        inside = counts[m].reshape(GROUPS, -1).sum(axis=1)
        rest.append(float(np.maximum(of["q"].to_numpy() - of["s"].to_numpy() ** 2 / np.maximum(inside, 1), 0).sum()))
    held.unpersist()
    return (n, _of(total, 0, 1)), _bounded(counts, ranks, product, rest, n)


def _bounded(counts: np.ndarray, ranks: list[np.ndarray], product: float, rest: list[float], n: int) -> tuple[float, float, float]:
    """Least, middle and greatest that Spearman's coefficient can be.

    A pair's rank is its cell's mean rank and what it is off from that. These sum up to 0 in a cell, and their squares to (c^3 - c) / 12 at
    most (all of the cell's c pairs differ), and to 0 if all are equal, as in cell 0. So the products of what one rank is off and of the other's mean rank
    stay the same if the other is taken from its mean in any group of cells, and Cauchy's inequality bounds them. rest: squares of
    the other's mean ranks from those means.
    """
    c = counts[:, 1:].astype(float)
    off = (c * (c * c - 1)).sum(axis=1) / 12 / float(n) ** 2
    square = [float((k * r * r).sum()) for k, r in zip(counts, ranks, strict=True)]
    error = np.sqrt(off[0] * rest[0]) + np.sqrt(off[1] * rest[1]) + np.sqrt(off[0] * off[1]) + 1e-12 * n  # and what sums of doubles lose
    least, most = np.sqrt(square[0] * square[1]), np.sqrt((square[0] + off[0]) * (square[1] + off[1]))
    low, high = product - error, product + error
    return float(low / (most if low > 0 else least)), float(product / least), float(high / (least if high > 0 else most))


def silhouette(df: DataFrame, key: str, columns: Sequence[str], cluster: str = "cluster", method: str = "euclidean") -> DataFrame:
    """id, cluster, silhouette of all rows, from all pairs; the only one of a cluster has 0, and so has one without. Clusters are few; key: unique."""
    spark = df.sparkSession
    sizes = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(F.count("*").alias("n")).orderBy(cluster).collect()
    names, k = [r[0] for r in sizes], len(sizes)
    code = F.coalesce(F.array_position(F.lit(names), F.col(cluster)).cast("int") - 1, F.lit(-1)) if k else F.lit(-1)

    def run(mets: Iterator[Met]) -> Iterator:
        import pandas as pd

        for met in mets:
            member = [(m[:, None] == np.arange(k)).astype(float) for m in met.marks]
            sums = [np.zeros((len(i), k)) for i in met.ids]
            for rows, _, (d,) in met.pieces():
                sums[0][rows] += d @ member[1]
                if not met.same:
                    sums[1] += d.T @ member[0][rows]
            for side in range(1 if met.same else 2):
                if len(met.ids[side]):
                    yield pd.DataFrame({"id": met.ids[side], "own": met.marks[side].astype("int32"), "of": list(sums[side])})

    x = df.select(key, *columns, code.alias("__code"))
    kind = dict(df.dtypes)
    made = over_blocks(blocks_of(x, key, [(method, list(columns))], "__code"), run, f"id {kind[key]}, own int, of array<double>")
    each = made.select("id", "own", F.posexplode_outer("of").alias("i", "d")).groupBy("id", "own", "i").agg(F.sum("d").alias("d"))
    own = F.col("i") == F.col("own")
    n = F.create_map(*[z for i, r in enumerate(sizes) for z in (F.lit(i), F.lit(r["n"]))])[F.col("i")] - F.when(own, 1).otherwise(0) if k else F.lit(0)
    mean = F.try_divide("d", n.cast("double"))
    ab = each.groupBy("id", "own").agg(F.max(F.when(own, mean)).alias("a"), F.min(F.when((F.col("own") >= 0) & ~own, mean)).alias("b"))
    s = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    named = F.when(F.col("own") >= 0, F.get(F.lit(names), F.col("own"))) if k else F.lit(None)
    return ab.select("id", named.cast(kind[cluster]).alias(cluster), s.alias("silhouette"))
