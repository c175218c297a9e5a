"""Average linkage over all rows.

Two clusters that are each other's nearest are merged in any order of merges, so a round merges all such pairs at once. The mean
distance of two clusters' rows is not below the distance of their means, which leaves few pairs whose rows have to be met: clusters lie in
the cells of a tree that cuts the space of means, and look for the nearest in their own cell and in those that their nearest there reaches.
When few clusters are left, their mean distances are summed up over all rows, by sorted coordinates, and they are linked in one task.

Cells of rows can be summarised, too (grow): sums and sums of squares tell the mean squared distance of the rows of two cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.operators.cluster import average_linkage
from cohortica.operators.numbering import checkpointed, in_ranges, number_rows, spread
from cohortica.operators.units import run_units

DISTANCES = ("euclidean_squared", "manhattan", "gower")


@dataclass
class Cells:
    """A tree of cuts: node i parts rows by coordinate axis[i] at at[i] into left[i] (not above it) and left[i] + 1; a leaf has axis -1."""

    axis: list[int] = field(default_factory=lambda: [-1])
    at: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])

    def part(self, node: int, axis: int, at: float) -> None:
        self.axis[node], self.at[node], self.left[node] = axis, at, len(self.axis)
        self.axis += [-1, -1]
        self.at += [0.0, 0.0]
        self.left += [-1, -1]

    def leaf(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        axis, at, left = np.array(self.axis), np.array(self.at), np.array(self.left)
        node, rest = np.zeros(len(rows), int), np.arange(len(rows))
        while len(rest := rest[axis[node[rest]] >= 0]):
            here = node[rest]
            node[rest] = left[here] + (rows[rest, axis[here]] > at[here])
        return node


@dataclass
class Summaries:
    """Of each cell: its leaf, count, and by coordinate the mean, the mean square, the least and the greatest value."""

    leaf: np.ndarray
    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    low: np.ndarray
    high: np.ndarray


def summarise(x: DataFrame, columns: list[str], cells: Cells) -> Summaries:
    """One pass over all rows; each batch gives a row per cell that it meets, and these are added up by cell."""
    sent, p = x.sparkSession.sparkContext.broadcast(cells), len(columns)  # two nodes a cell at most

    def task(frames: Iterator) -> Iterator:
        import pandas as pd

        for f in frames:
            rows = f[columns].to_numpy(float)
            if not len(rows):
                continue
            leaf, group = np.unique(sent.value.leaf(rows), return_inverse=True)
            order = np.argsort(group, kind="stable")
            starts = np.searchsorted(group[order], np.arange(len(leaf)))
            by = lambda how, v: how.reduceat(v[order], starts, axis=0)  # noqa: E731, B023
            made = [by(np.add, rows), by(np.add, rows * rows), by(np.minimum, rows), by(np.maximum, rows)]
            yield pd.DataFrame({"leaf": leaf, "n": np.bincount(group), **{f"{name}{c}": m[:, c] for name, m in zip("sqlh", made, strict=True) for c in range(p)}})

    schema = ", ".join(["leaf int, n long", *[f"{name}{c} double" for name in "sqlh" for c in range(p)]])
    how = {"s": F.sum, "q": F.sum, "l": F.min, "h": F.max}
    totals = [F.array(*[f(f"{name}{c}") for c in range(p)]).alias(name) for name, f in how.items()]
    got = sorted(x.select(*columns).mapInPandas(task, schema).groupBy("leaf").agg(F.sum("n").alias("n"), *totals).collect())  # a row a cell
    n = np.array([r["n"] for r in got], float)
    of = lambda name: np.array([r[name] for r in got], float).reshape(len(got), p)
    return Summaries(np.array([r["leaf"] for r in got], int), n, of("s") / n[:, None], of("q") / n[:, None], of("l"), of("h"))


def grow(x: DataFrame, columns: list[str], most: int, by: np.ndarray) -> tuple[Cells, Summaries]:
    """Cells, no more than `most`, and their summaries. by: what each coordinate is divided by before sides are compared.

    A pass cuts the cells that reach at least a quarter as far as the furthest one does, those
    that reach furthest first; it ends when the number is reached or each cell is one point.
    """
    cells = Cells()
    found = summarise(x, columns, cells)
    while len(found.leaf) < most:
        sides = (found.high - found.low) / by
        reach = sides.max(axis=1)
        order = np.argsort(-reach, kind="stable")
        wide = order[(reach[order] > 0) & (reach[order] >= reach.max() / 4)][: most - len(found.leaf)]
        if not len(wide):
            break
        for i in wide:
            c = int(sides[i].argmax())
            low, high = found.low[i, c], found.high[i, c]
            middle = low / 2 + high / 2
            cells.part(int(found.leaf[i]), c, float(middle if low <= middle < high else low))
        found = summarise(x, columns, cells)
    return cells, found


def between(s: Summaries, distance: str) -> np.ndarray:
    """Mean distance of the rows of each two cells.

    The mean squared Euclidean distance is exact. Manhattan's and Gower's are the distance of
    the means, which by coordinate is exact for cells whose ranges there don't overlap.
    """
    if distance == "euclidean_squared":
        own = s.square.sum(axis=1)
        return np.maximum(own[:, None] + own[None, :] - 2 * s.mean @ s.mean.T, 0)
    d = np.zeros((len(s.n), len(s.n)))
    for c in range(s.mean.shape[1]):
        d += np.abs(s.mean[:, c][:, None] - s.mean[:, c][None, :])
    return d / s.mean.shape[1] if distance == "gower" else d


#: Clusters of a cell on average, cells at most, means from which cells are made; products of two clusters' numbers of rows up to which all their pairs are met; pairs at once.
CELL_CLUSTERS, MOST_CELLS, SEEN_MEANS, MET_ROWS, AT_ONCE = 200, 2000, 50_000, 4096, 1 << 20
#: Sorted values of a task, and of a stretch of it within which pairs are met, in sums over all rows.
RANGE_VALUES, STRETCH = 1 << 16, 32


def cells_of(means: np.ndarray, most: int) -> Cells:
    """Cells of about as many of the given means each, cut at the middle one of the widest side."""
    cells, open_ = Cells(), [(0, means)]
    while open_ and len(open_) < most:
        at, (node, m) = max(enumerate(open_), key=lambda e: len(e[1][1]))
        sides = m.max(axis=0) - m.min(axis=0) if len(m) > 1 else np.zeros(m.shape[1])
        c = int(sides.argmax())
        if not sides[c] > 0:
            break
        cut_at = float(np.partition(m[:, c], (len(m) - 1) // 2)[(len(m) - 1) // 2])
        if not (m[:, c] > cut_at).any():
            cut_at = float(m[m[:, c] < cut_at, c].max())
        cells.part(node, c, cut_at)
        left, above = cells.left[node], m[:, c] > cut_at
        open_[at] = (left, m[~above])
        open_.append((left + 1, m[above]))
    return cells


def _apart(a: np.ndarray, b: np.ndarray, squared: bool) -> np.ndarray:
    """Distance of each two rows of a and b."""
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T, strict=True):
        t = x[:, None] - y[None, :]
        out += t * t if squared else np.abs(t)
    return out


class Members:
    """Clusters of a frame: numbers, weights, means, and rows with their weights."""

    def __init__(self, f, p: int):
        self.cid, self.w = f["cid"].to_numpy(), f["w"].to_numpy(float)
        self.rows, self.c = [np.asarray(m, float).reshape(-1, p) for m in f["m"]], [np.asarray(c, float) for c in f["c"]]
        self.mean = np.array([(m * c[:, None]).sum(axis=0) / c.sum() for m, c in zip(self.rows, self.c, strict=True)]).reshape(-1, p)


def _summed(m: np.ndarray, c: np.ndarray, other: np.ndarray, oc: np.ndarray) -> float:
    """Weighed sum of |x - y| over the rows x of one cluster and y of another, from sorted coordinates."""
    total, n = 0.0, len(m)
    for i in range(m.shape[1]):
        v, w = np.concatenate([m[:, i], other[:, i]]), np.concatenate([c, oc])
        v = v - v[0]
        order = np.argsort(v, kind="stable")
        v, w, first = v[order], w[order], order < n
        a, b = np.where(first, w, 0.0), np.where(first, 0.0, w)
        total += float((a * (v * np.cumsum(b) - np.cumsum(b * v)) + b * (v * np.cumsum(a) - np.cumsum(a * v))).sum())
    return total


def mean_distances_of(a: Members, b: Members, i: np.ndarray, j: np.ndarray, squared: bool) -> np.ndarray:
    """Mean distance of the rows of a's clusters i and b's j, the same to the last bit whichever is given first."""
    out = np.zeros(len(i))
    swap = a.cid[i] > b.cid[j]
    size_a, size_b = np.array([len(m) for m in a.rows]), np.array([len(m) for m in b.rows])
    many = size_a[i] * size_b[j]
    for at in np.flatnonzero(many > MET_ROWS):
        one, two = (a.rows[i[at]], a.c[i[at]]), (b.rows[j[at]], b.c[j[at]])
        if swap[at]:
            one, two = two, one
        if squared:
            mean = [(m * c[:, None]).sum(axis=0) / c.sum() for m, c in (one, two)]
            around = [(((m - mu) ** 2).sum(axis=1) * c).sum() / c.sum() for (m, c), mu in zip((one, two), mean, strict=True)]
            out[at] = ((mean[0] - mean[1]) ** 2).sum() + around[0] + around[1]
        else:
            out[at] = _summed(*one, *two) / (one[1].sum() * two[1].sum())
    few = np.flatnonzero(many <= MET_ROWS)
    all_a, all_b = (np.concatenate(x.rows) if x.rows else np.zeros((0, 1)) for x in (a, b))
    c_a, c_b = (np.concatenate(x.c) if x.c else np.zeros(0) for x in (a, b))
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    upto, low = np.cumsum(many[few]), 0
    while low < len(few):
        high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + AT_ONCE, side="right")))
        part = few[low:high]
        which = np.repeat(np.arange(len(part)), many[part])
        place = np.arange(len(which)) - np.repeat(np.cumsum(many[part]) - many[part], many[part])
        # rows of the cluster of the lower number run slower, so that sums are made in one order
        inner = np.where(swap[part], size_a[i[part]], size_b[j[part]])[which]
        slow, fast, back = place // inner, place % inner, swap[part][which]
        x, y = start_a[i[part]][which] + np.where(back, fast, slow), start_b[j[part]][which] + np.where(back, slow, fast)
        t = all_a[x] - all_b[y]
        d = np.zeros(len(t))
        for z in t.T:
            d += z * z if squared else np.abs(z)
        out[part] = np.bincount(which, d * (c_a[x] * c_b[y]), len(part)) / (a.w[i[part]] * b.w[j[part]])
        low = high
    return out


def nearest_of(a: Members, b: Members, upto: np.ndarray, squared: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of each cluster of a the nearest one of b that isn't itself and no further than upto: its number (-1: none) and mean distance; ties by the pair's lower, then higher number."""
    number, best = np.full(len(a.cid), -1, np.int64), upto.astype(float).copy()
    for low in range(0, len(a.cid), step := max(1, (1 << 22) // max(len(b.cid), 1))):
        at = slice(low, low + step)
        least = _apart(a.mean[at], b.mean, squared)
        least[a.cid[at][:, None] == b.cid[None, :]] = np.inf
        if not len(b.cid):
            continue
        slack = lambda u: u * (1 + 1e-9) + 1e-300
        rows, seen = np.arange(low, low + len(least)), least.argmin(axis=1)
        has = least[np.arange(len(least)), seen] <= slack(best[at])
        first = np.full(len(least), np.inf)
        first[has] = mean_distances_of(a, b, rows[has], seen[has], squared)
        i, j = np.nonzero((least <= slack(np.minimum(first, best[at]))[:, None]) & np.isfinite(least))
        d = mean_distances_of(a, b, i + low, j, squared)
        one, two = a.cid[i + low], b.cid[j]
        order = np.lexsort((np.maximum(one, two), np.minimum(one, two), d, i))
        i, j, d = i[order], j[order], d[order]
        lead = np.flatnonzero(np.diff(i, prepend=-1))
        keep = lead[d[lead] <= best[at][i[lead]]]
        number[i[keep] + low], best[i[keep] + low] = b.cid[j[keep]], d[keep]
    return number, best


_FOUND = "cid long, other long, d double"


def nearest_clusters(clusters: DataFrame, n: int, p: int, squared: bool) -> DataFrame:
    """cid, other, d: of each of n clusters (cid, w, h, m, c) the nearest one and the mean distance of their rows."""
    spark = clusters.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    means = clusters.select("cid", F.transform(F.sequence(F.lit(0), F.lit(p - 1)), lambda i: F.col("mean")[i]).alias("mean"))
    seen = [r["mean"] for r in means.orderBy(F.xxhash64("cid")).limit(SEEN_MEANS).collect()] if n > CELL_CLUSTERS else [[0.0] * p]
    cells = spark.sparkContext.broadcast(cells_of(np.array(seen, float), max(1, min(MOST_CELLS, n // CELL_CLUSTERS))))

    def leaf(frames: Iterator) -> Iterator:
        for f in frames:
            yield f.assign(cell=cells.value.leaf(np.stack(f["mean"].to_numpy())).astype(np.int32)) if len(f) else f.assign(cell=np.zeros(0, np.int32))

    placed = checkpointed(clusters.mapInPandas(leaf, _CLUSTER + ", cell int").repartition(partitions, "cell"))
    ends = placed.groupBy("cell").agg(*[f(F.col("mean")[i]).alias(f"{name}{i}") for i in range(p) for name, f in (("l", F.min), ("h", F.max))]).orderBy("cell").collect()  # a row a cell
    boxes = spark.sparkContext.broadcast(tuple(np.array([[r[f"{name}{i}"] for i in range(p)] for r in ends]) for name in "lh") + (np.array([r["cell"] for r in ends]),))

    def own(f):
        import pandas as pd

        held = Members(f, p)
        other, d = nearest_of(held, held, np.full(len(held.cid), np.inf), squared)
        return pd.DataFrame({"cid": held.cid, "other": other, "d": d})

    inside = checkpointed(placed.groupBy("cell").applyInPandas(own, _FOUND))

    def reached(frames: Iterator) -> Iterator:
        low, high, number = boxes.value
        for f in frames:
            if not len(f):
                continue
            m, upto = np.stack(f["mean"].to_numpy()), f["d"].to_numpy()
            away = np.zeros((len(m), len(number)))
            for c in range(p):
                t = np.maximum(np.maximum(low[:, c][None, :] - m[:, c][:, None], m[:, c][:, None] - high[:, c][None, :]), 0)
                away += t * t if squared else t
            i, j = np.nonzero((away <= (upto * (1 + 1e-9) + 1e-300)[:, None]) & (f["cell"].to_numpy()[:, None] != number[None, :]))
            yield f.iloc[i].assign(cell=number[j].astype(np.int32))

    asking = placed.join(inside.select("cid", "d"), "cid").mapInPandas(reached, "cid long, w double, h double, m array<double>, c array<double>, mean array<double>, cell int, d double") if len(ends) > 1 else None
    if asking is None:
        return inside

    def across(a, b):
        import pandas as pd

        if not len(a) or not len(b):
            return pd.DataFrame({"cid": np.zeros(0, int), "other": np.zeros(0, int), "d": np.zeros(0)})
        one = Members(a, p)
        other, d = nearest_of(one, Members(b, p), a["d"].to_numpy(float), squared)
        return pd.DataFrame({"cid": one.cid, "other": other, "d": d})[other >= 0]

    outside = asking.groupBy("cell").cogroup(placed.groupBy("cell")).applyInPandas(across, _FOUND)
    by = F.struct("d", F.least("cid", "other").alias("low"), F.greatest("cid", "other").alias("high"))
    return inside.where("other >= 0").union(outside).groupBy("cid").agg(F.min_by(F.struct("other", "d"), by).alias("v")).select("cid", "v.*")


_CLUSTER = "cid long, w double, h double, m array<double>, c array<double>, mean array<double>"


def _with_mean(clusters: DataFrame, p: int) -> DataFrame:
    coordinate = lambda i: F.transform(F.sequence(F.lit(0), F.size("c") - 1), lambda j: F.col("m")[j * p + i])
    sums = [F.aggregate(F.zip_with(coordinate(i), F.col("c"), lambda x, w: x * w), F.lit(0.0), lambda s, x: s + x) for i in range(p)]
    return clusters.select("cid", "w", "h", "m", "c", F.array(*[s / F.col("w") for s in sums]).alias("mean"))


def merged(clusters: DataFrame, near: DataFrame, p: int) -> tuple[DataFrame, DataFrame]:
    """Clusters after all pairs that are each other's nearest are one, and the merges: gone, keep, h (not below those of its parts)."""
    pairs = near.groupBy(F.least("cid", "other").alias("keep"), F.greatest("cid", "other").alias("gone")).agg(F.count("*").alias("n"), F.max("d").alias("d")).where("n = 2")
    pairs = checkpointed(pairs.select("keep", "gone", "d"))
    to = pairs.select(F.col("gone").alias("cid"), "keep", "d").union(pairs.select(F.col("keep").alias("cid"), "keep", "d"))
    each = clusters.join(to, "cid", "left").select("cid", F.coalesce("keep", "cid").alias("keep"), "w", F.greatest("h", "d").alias("h"), "m", "c")
    parts = F.array_sort(F.collect_list(F.struct("cid", "m", "c")))
    made = each.groupBy("keep").agg(F.sum("w").alias("w"), F.max("h").alias("h"), parts.alias("of"))
    made = made.select(F.col("keep").alias("cid"), "w", "h", F.flatten("of.m").alias("m"), F.flatten("of.c").alias("c"))
    now = checkpointed(_with_mean(made, p))
    return now, pairs.join(now.select(F.col("cid").alias("keep"), "h"), "keep").select("gone", "keep", "h")


def mean_matrix(clusters: DataFrame, ids: list[int], weights: np.ndarray, p: int) -> np.ndarray:
    """Mean Manhattan distance of the rows of each two of a bounded number of clusters: sums over sorted coordinates, a task for each range of these."""
    spark, k = clusters.sparkSession, len(ids)
    number = spark.createDataFrame(list(zip(ids, range(k), strict=True)), "cid long, a int")
    point = F.explode(F.arrays_zip(F.sequence(F.lit(0), F.size("c") - 1).alias("j"), F.col("c").alias("c"))).alias("z")
    rows = clusters.join(F.broadcast(number), "cid").select("a", "m", point).select("a", F.col("z.c").alias("w"), F.slice("m", F.col("z.j") * p + 1, p).alias("x"))
    long = rows.select("a", "w", F.posexplode("x").alias("i", "v"))
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-long.count() // RANGE_VALUES))
    dealt = in_ranges(long, "i", "v", "a", "w", ranges=ranges)
    sums = dealt.groupBy("i", "range", "a").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("v")).alias("s")).toPandas()

    def stretched(frames: Iterator) -> Iterator:
        import pandas as pd

        frames = [f for f in frames if len(f)]
        if not frames:
            return
        total = np.zeros((k, k))
        for _, f in pd.concat(frames).groupby("i"):
            a, w, v = f["a"].to_numpy(), f["w"].to_numpy(), f["v"].to_numpy()
            v, of = v - v.mean(), np.arange(len(f)) // STRETCH
            for low in range(0, int(of[-1]) + 1, 1024):  # so many stretches at once, after what stands before them
                here = (of >= low) & (of < low + 1024)
                n, s = (np.bincount(a[here] * 1024 + of[here] - low, z[here], k * 1024).reshape(k, 1024) for z in (w, w * v))
                past_n, past_s = (np.bincount(a[of < low], z[of < low], k)[:, None] for z in (w, w * v))
                total += (np.cumsum(n, axis=1) - n + past_n) @ s.T - (np.cumsum(s, axis=1) - s + past_s) @ n.T
            for back in range(1, STRETCH):
                x, y = np.arange(len(v) - back), np.arange(back, len(v))
                x, y = x[of[x] == of[y]], y[of[x] == of[y]]
                np.add.at(total, (a[x], a[y]), w[x] * w[y] * (v[y] - v[x]))
        yield pd.DataFrame({"a": np.arange(k), "v": list(total)})

    def added(f):
        import pandas as pd

        return pd.DataFrame({"a": [int(f["a"].iloc[0])], "v": [np.sum(np.stack(f["v"].to_numpy()), axis=0)]})

    total = np.zeros((k, k))
    for r in dealt.select("i", "a", "w", "v").mapInPandas(stretched, "a int, v array<double>").groupBy("a").applyInPandas(added, "a int, v array<double>").collect():  # k rows of k sums
        total[r["a"]] = r["v"]
    for _, f in sums.groupby("i"):
        places = {r: at for at, r in enumerate(sorted(f["range"].unique()))}
        n, s = np.zeros((k, len(places))), np.zeros((k, len(places)))
        at = f["range"].map(places).to_numpy()
        n[f["a"], at], s[f["a"], at] = f["n"], f["s"]
        total += (np.cumsum(n, axis=1) - n) @ s.T - (np.cumsum(s, axis=1) - s) @ n.T
    return np.maximum(total + total.T, 0) / np.outer(weights, weights)


def average_linkage_rows(df: DataFrame, key: str, columns: list[str], k: int, distance: str = "manhattan", most: int = 2000) -> DataFrame:
    """key, cluster (1..k in order of the clusters' means) of all rows; columns without nulls.

    distance: manhattan, gower (coordinates divided by their ranges) or euclidean_squared.
    The clusters are those of plain average linkage of all rows, whatever their number; equal rows are one with their
    number, as they merge first at height 0. Fewer different rows than k give as many clusters. An empty table gives
    an empty one. Pairs that are each other's nearest merge in rounds over all rows' tasks until no more than `most` clusters are left;
    these are linked in one task, of `most` squared distances whatever the table's size. The rows of one cluster are a row of the rounds' tables.
    """
    if distance not in DISTANCES:
        raise ValueError(f"unknown distance: {distance}")
    spark, p, squared = df.sparkSession, len(columns), distance == "euclidean_squared"
    # fixed once: rows are read for the different ones and at the end, and their columns may be costly to make
    x = checkpointed(spread(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), key))
    ends = x.agg(F.count("*").alias("n"), *[f(c).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (("r", lambda c: F.max(c) - F.min(c)), ("m", F.median))]).first()
    if not ends["n"]:
        return df.select(key, F.lit(1).alias("cluster"))
    by = [(ends[f"r{i}"] or 1.0) * p if distance == "gower" else 1.0 for i in range(p)]
    points = checkpointed(number_rows(x.groupBy(*columns).agg(F.count("*").cast("double").alias("w")), *columns, name="pid"))
    coordinates = F.array(*[(F.col(c) - float(ends[f"m{i}"])) / float(by[i]) for i, c in enumerate(columns)])
    clusters = points.select(F.col("pid").alias("cid"), "w", F.lit(0.0).alias("h"), coordinates.alias("m"), F.array("w").alias("c"), coordinates.alias("mean"))
    n, merges = clusters.count(), []
    while n > most:
        clusters, made = merged(clusters, nearest_clusters(clusters, n, p, squared), p)
        merges.append(checkpointed(made))
        n = clusters.count()
    around = F.aggregate(F.zip_with(F.transform(F.sequence(F.lit(0), F.size("m") - 1), lambda j: F.col("m")[j] * F.col("m")[j]), F.flatten(F.transform("c", lambda w: F.array_repeat(w, p))), lambda q, w: q * w), F.lit(0.0), lambda s, q: s + q)
    left = clusters.select("cid", "w", "h", "mean", (around / F.col("w")).alias("q")).orderBy("cid").collect()  # `most` at most
    ids, w, mean = [r["cid"] for r in left], np.array([r["w"] for r in left]), np.array([r["mean"] for r in left], float)
    told = Summaries(np.array(ids), w, mean, np.array([[r["q"]] for r in left]), mean, mean)
    d = between(told, "euclidean_squared" if squared else "manhattan") if squared or not merges else mean_matrix(clusters, ids, w, p)
    held = spark.sparkContext.broadcast((d, w))

    def link(of: int) -> Iterator[tuple]:
        made = average_linkage(*held.value) if of > 1 else np.zeros((0, 3))
        yield of, made[:, 0].astype(int).tolist(), made[:, 1].astype(int).tolist(), made[:, 2].tolist()

    r = run_units(spark, [(len(ids),)], "of int", link, "of int, a array<int>, b array<int>, h array<double>").first()
    # the highest k - 1 merges of all are left out; a merge is no lower than those of its parts
    parent, height, told_merges = list(range(len(ids))), [z["h"] for z in left], []

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for at, (a, b, h) in enumerate(zip(r["a"], r["b"], r["h"], strict=True)):
        one, two = sorted((root(a), root(b)))
        parent[two], height[one] = one, max(h, height[one], height[two])
        told_merges.append((height[one], len(merges), at, a, b))
    for i, m in enumerate(merges):
        told_merges += [(z["h"], i, z["gone"], None, None) for z in m.orderBy(F.desc("h"), F.desc("gone")).limit(k - 1).collect()]
    told_merges.sort(key=lambda m: m[:3])
    out = set(m[:3] for m in told_merges[max(0, len(told_merges) - (k - 1)) :]) if k > 1 else set()
    apart = [gone for _, i, gone in out if i < len(merges)]
    parent = list(range(len(ids)))
    for _, i, at, a, b in told_merges:
        if i == len(merges) and (_, i, at) not in out:
            one, two = sorted((root(a), root(b)))
            parent[two] = one
    of_cluster = [(c, ids[root(i)]) for i, c in enumerate(ids)] + [(gone, gone) for gone in apart]
    now = points.select(*columns, F.col("pid").alias("cid"))
    for i, m in enumerate(merges):
        kept = m.where(~F.col("gone").isin(apart)) if apart else m
        now = now.join(kept.select(F.col("gone").alias("cid"), "keep"), "cid", "left").select(*columns, F.coalesce("keep", "cid").alias("cid"))
    now = now.join(F.broadcast(spark.createDataFrame(of_cluster, "cid long, of long")), "cid").select(*columns, "of")
    given = checkpointed(x.join(now, columns).select(key, *columns, "of"))
    means = sorted((tuple(z[1:]), z[0]) for z in given.groupBy("of").agg(*[F.avg(c) for c in columns]).collect())  # k rows
    name = spark.createDataFrame([(of, i + 1) for i, (_, of) in enumerate(means)], "of long, cluster int")
    return given.join(F.broadcast(name), "of").select(key, "cluster")
