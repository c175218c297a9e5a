"""Mean, spread and ends of Manhattan's and Gower's distances of all pairs of rows, without a pair.

Such a distance is a sum over coordinates, so its mean follows from each coordinate's mean |x - x'|, and its mean square from
the mean |x - x'| |y - y'| of every two coordinates. The latter is twice the sum of (x - x')(y - y') over the pairs in which both grow, less
that sum over all pairs. Pairs that grow are counted by ranges: those in different ranges of both coordinates from sums by ranges, the others
in a task of one range. The greatest distance is the widest span of the coordinates' sums under any signs; the least one is looked
for in cells no wider than a few times the least distance of some rows. So the work is that of sorting rows x columns values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortica.operators import allpairs
from cohortica.operators.distance import sample_rows
from cohortica.operators.numbering import checkpointed, spread

#: Rows of a range, on average at most; rows whose least distance bounds that of all; signs of more columns would be too many.
RANGE_ROWS, NEAR_ROWS, MOST_COLUMNS = 1 << 16, 2000, 8


def grown(u: np.ndarray, x: np.ndarray, y: np.ndarray) -> float:
    """Sum of (x' - x)(y' - y) over pairs with u < u' and y < y'. u: whole numbers that x doesn't fall in."""
    by_y, total = np.argsort(y, kind="stable"), 0.0
    for bit in range(int(u.max(initial=0)).bit_length()):
        # u < u' in the first bit in which they differ, once for each pair
        order = by_y[np.argsort(u[by_y] >> (bit + 1), kind="stable")]
        key, above = u[order] >> (bit + 1), (u[order] >> bit) & 1 == 1
        v = np.stack([np.ones(len(order)), x[order], y[order], x[order] * y[order]])
        upto = np.cumsum(np.where(above, 0.0, v), axis=1)
        starts = np.searchsorted(key, key[above])
        n, sx, sy, sxy = upto[:, above] - np.where(starts > 0, upto[:, starts - 1], 0.0)
        _, x_, y_, xy_ = v[:, above]
        total += float((xy_ * n - x_ * sy - y_ * sx + sxy).sum())
    return total


def _products(x: DataFrame, p: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all pairs: sums of |x - x'| by coordinate, and of |x - x'| |y - y'| by two coordinates. x: id, x0, x1, ... taken from their means."""
    names = [f"x{i}" for i in range(p)]
    many = -(-n // RANGE_ROWS)
    bounds = [np.array(b) for b in x.stat.approxQuantile(names, [i / many for i in range(1, many)], 0.1 / many)] if many > 1 else [np.zeros(0)] * p
    sent = x.sparkSession.sparkContext.broadcast(bounds)  # one for each range

    def placed(frames):
        for f in frames:
            dealt = (f["h"].to_numpy() & 0xFFFFFF) / float(1 << 24)
            for i, b in enumerate(sent.value):
                first, last = (np.searchsorted(b, f[f"x{i}"].to_numpy(), side) for side in ("left", "right"))
                f[f"r{i}"] = (first + np.floor(dealt * (last - first + 1))).astype(np.int32)  # equal ones are dealt to all ranges that they fill
            yield f.drop(columns="h")

    rows = x.select(*names, F.xxhash64("id").alias("h")).mapInPandas(placed, ", ".join([*[f"x{i} double" for i in range(p)], *[f"r{i} int" for i in range(p)]]))
    own = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(f"r{i}").alias("r")) for i in range(p)])).alias("of")
    long = rows.select("*", own).select("of.*", *names, *[f"r{i}" for i in range(p)])

    def within(key, f):
        import pandas as pd

        c, r = int(key[0]), int(key[1])
        f = f.sort_values([f"x{c}"], kind="stable")
        v, out = f[f"x{c}"].to_numpy(), []
        at = np.arange(len(v))
        out.append((c, c, r, -1, len(v), float((v * at - (np.cumsum(v) - v)).sum()), float(v.sum()), 0.0))
        for d in range(p):
            if d == c:
                continue
            w, range_ = f[f"x{d}"].to_numpy(), f[f"r{d}"].to_numpy().astype(np.int64)
            if d < c:  # pairs in one range of this coordinate, the later one, and in different ones of the other
                out.append((d, c, r, -1, 0, grown(range_, w, v), 0.0, 0.0))
                continue
            out.append((c, d, r, -1, 0, grown(at, v, w), 0.0, 0.0))
            sums = [np.bincount(range_, z) for z in (None, v, w, v * w)]
            out += [(c, d, r, int(s), int(sums[0][s]), *(float(z[s]) for z in sums[1:])) for s in np.flatnonzero(sums[0])]
        return pd.DataFrame(out, columns=["c", "d", "r", "s", "n", "x", "y", "xy"])

    tasks = min(10_000, p * many)
    found = long.repartition(tasks, "c", "r").groupBy("c", "r").applyInPandas(within, "c int, d int, r int, s int, n long, x double, y double, xy double")
    found = found.toPandas().sort_values(["c", "d", "r", "s"])  # a row for every two ranges of two coordinates
    one = x.agg(*[F.sum(c) for c in names], *[F.sum(F.col(names[i]) * F.col(names[j])) for i in range(p) for j in range(i, p)]).first()
    at = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(p) for j in range(i, p))}
    single, double = np.zeros(p), np.zeros((p, p))
    for i in range(p):
        f = found[(found["c"] == i) & (found["d"] == i)]
        m, s = f["n"].to_numpy(float), f["y"].to_numpy()
        single[i] = f["x"].sum() + (s * (np.cumsum(m) - m) - m * (np.cumsum(s) - s)).sum()
        for j in range(i, p):
            signed = n * one[p + at[i, j]] - one[i] * one[j]
            if i == j:
                double[i, i] = signed
                continue
            f = found[(found["c"] == i) & (found["d"] == j)]
            rising, cells = f.loc[f["s"] < 0, "x"].sum(), f[f["s"] >= 0]
            z = np.zeros((4, many, many))
            z[:, cells["r"], cells["s"]] = cells[["n", "x", "y", "xy"]].to_numpy(float).T
            before = np.zeros((4, many, many))
            before[:, 1:, 1:] = z.cumsum(axis=1).cumsum(axis=2)[:, :-1, :-1]
            rising += (z[3] * before[0] - z[1] * before[2] - z[2] * before[1] + z[0] * before[3]).sum()
            double[i, j] = double[j, i] = 2 * rising - signed
    return single, double


def _least(x: DataFrame, n: int, weights: dict[str, float]) -> float | None:
    """The least sum of weights times |x - x'| of all pairs; None if cells would be too small to be numbered."""
    use = [c for c, w in weights.items() if w]
    if not use or x.groupBy(*use).count().where("count > 1").limit(1).count():
        return 0.0
    y = x.select("id", *[(F.col(c) * w).alias(c) for c, w in weights.items() if w])
    some = sample_rows(y, "id", NEAR_ROWS).select(*use).toPandas().to_numpy(float)
    d = np.abs(some[:, None, 0] - some[None, :, 0])
    for i in range(1, len(use)):
        d += np.abs(some[:, None, i] - some[None, :, i])
    near = float(d[np.triu_indices(len(some), 1)].min())
    if n <= NEAR_ROWS or near == 0:
        return near
    half, side = near * (0.5 + 1e-9), 4 * near
    if float(y.agg(F.greatest(F.lit(0.0), *[F.max(F.abs(c)) for c in use])).first()[0]) / side > 1 << 50:
        return None
    # two rows that are no further apart than the nearest known ones share a cell that both reach, and each reaches few
    reach = lambda c: F.sequence(F.floor((F.col(c) - half) / side), F.floor((F.col(c) + half) / side))
    cells = reduce(lambda z, c: z.withColumn(f"__{c}", F.explode(reach(c))), use, y)
    keys = [f"__{c}" for c in use]
    met = cells.alias("a").join(cells.alias("b"), [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("a.id") < F.col("b.id")])
    nearer = met.agg(F.min(reduce(lambda s, c: s + F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")), use, F.lit(0.0)))).first()[0]
    return near if nearer is None else min(near, float(nearer))


def spreads(df: DataFrame, key: str, measures: Sequence[allpairs.Measure]) -> list[dict]:
    """What allpairs.spreads gives, of Manhattan's and Gower's distance over few columns that no row lacks; of others, and where keys repeat, it is asked instead."""
    columns = sorted({c for _, cs in measures for c in cs})
    known = df.where(F.col(key).isNotNull())
    one = known.agg(F.count("*").alias("n"), F.count_distinct(key).alias("keys"), *[f(F.col(c).cast("double")).alias(f"{name}{i}") for i, c in enumerate(columns) for name, f in (("m", F.avg), ("l", F.min), ("h", F.max), ("c", F.count))]).first()
    n, p = one["n"], len(columns)
    partly = any(0 < one[f"c{i}"] < n or not np.isfinite(one[f"m{i}"] or 0.0) for i in range(p))
    if {m for m, _ in measures} - {"manhattan", "gower"} or p > MOST_COLUMNS or partly or one["keys"] < n or n < 2:
        return allpairs.spreads(df, key, measures)
    x = known.select(F.col(key).alias("id"), *[F.coalesce(F.col(c).cast("double") - float(one[f"m{i}"] or 0.0), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(columns)])
    x = checkpointed(spread(x, "id"))  # read several times
    spans = {c: float(one[f"h{i}"] - one[f"l{i}"]) if one[f"c{i}"] else 0.0 for i, c in enumerate(columns)}
    weigh = lambda m, c, cs: 1.0 if m == "manhattan" else 1 / spans[c] / len(cs) if spans[c] else 0.0
    weights = [{f"x{columns.index(c)}": weigh(m, c, cs) for c in cs} for m, cs in measures]
    single, double = _products(x, p, n)
    signed = [[reduce(lambda s, z: s + z, [F.col(c) * (w * sign) for (c, w), sign in zip(of.items(), (1, *signs), strict=True)]) for signs in product((1, -1), repeat=len(of) - 1)] for of in weights]
    ends = x.agg(*[f(e).alias(f"{name}{i}_{j}") for i, es in enumerate(signed) for j, e in enumerate(es) for name, f in (("l", F.min), ("h", F.max))]).first()
    out, pairs = [], n * (n - 1) // 2
    for i, of in enumerate(weights):
        w = np.array([of.get(f"x{j}", 0.0) for j in range(p)])
        low = _least(x, n, of)
        if low is None:
            return allpairs.spreads(df, key, measures)
        high = max(ends[f"h{i}_{j}"] - ends[f"l{i}_{j}"] for j in range(len(signed[i])))
        mean = float(w @ single) / pairs
        square = max(float(w @ double @ w) - pairs * mean * mean, 0.0)
        out += allpairs._spreads((pairs, np.array([mean]), np.array([[square]]), np.array([low]), np.array([high])), 1)
    return out
