"""Clusterings: k-means and k-medoids over all rows; grids of models on a sample, whose result is carried to all rows.

Each of the many fits of a grid, of its resamples and of its reference sets is a
unit of its own (units.run_units), on a sample of bounded size that each task gets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica import config
from cohortica.operators import validity
from cohortica.operators.units import resample, run_units, uniform

S = config.SETTINGS


def _nearest(columns: list[str], centres: np.ndarray) -> Column:
    """The number of the nearest centre, from 1; the lower one on ties."""
    square = lambda c: reduce(lambda s, i: s + (F.col(columns[i]) - float(c[i])) * (F.col(columns[i]) - float(c[i])), range(len(columns)), F.lit(0.0))
    return F.array_min(F.array(*[F.struct(square(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres, 1)]))["i"]


def kmeans(df: DataFrame, key: str, columns: list[str], k: int, starts: int = S.kmeans_starts, steps: int = S.kmeans_steps, seed: int = S.seed, sample: int = S.sample_rows, tolerance: float = 1e-3) -> DataFrame:
    """key, cluster (1..k in order of the first centre coordinate) of all rows; columns without nulls.

    Every ten starts are a unit on a bounded sample, where they are cheap; the best of them
    then moves over all rows, one aggregate of k rows a step, until no centre moves further than the tolerance.
    """
    from cohortica.operators.distance import sample_rows
    from cohortica.operators.numbering import spread

    def start(first: int) -> Iterator[tuple]:
        labels, cost = kmeans_rows(sent.value, k, min(10, starts - first), np.random.default_rng([seed, k, first]))
        yield first, cost, labels.tolist()

    x = spread(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), key).persist()
    try:
        rows = sample_rows(x, key, sample, seed).toPandas().sort_values(key)[columns].to_numpy(float)
        sent = df.sparkSession.sparkContext.broadcast(rows)  # at most `sample` rows
        labels = np.array(run_units(df.sparkSession, [(i,) for i in range(0, starts, 10)], "first int", start, "first int, cost double, labels array<int>").orderBy("cost", "first").first()["labels"])
        centres = np.array([rows[labels == i].mean(axis=0) if (labels == i).any() else rows[i % len(rows)] for i in range(1, k + 1)])
        for _ in range(steps):
            moved = centres.copy()
            for r in x.groupBy(_nearest(columns, centres).alias("cluster")).agg(*[F.avg(c).alias(c) for c in columns]).collect():
                moved[r["cluster"] - 1] = [r[c] for c in columns]
            still = np.abs(moved - centres).max() <= tolerance
            centres = moved
            if still:
                break
    finally:
        x.unpersist()
    centres = centres[np.lexsort(centres.T[::-1])]
    return df.select(key, _nearest(columns, centres).alias("cluster"))


#: A batch of transfers is tried whole, as a half of it, a quarter and so on.
HALVINGS = 12


def hartigan_wong(df: DataFrame, key: str, columns: list[str], k: int, steps: int = S.kmeans_steps, seed: int = S.seed, **of_kmeans) -> DataFrame:
    """key, cluster of all rows: k-means after which no transfer of a single row to another cluster lowers the sum of squares.

    It begins where kmeans (whose settings follow) ends. Moving a row from a cluster
    of n to one of m rows changes the sum by m / (m + 1) of its squared distance there
    less n / (n - 1) of that here. All rows that would gain propose to move; since their
    gains hold for one move at a time, one aggregate tells what the sum of squares would be if
    all of them went, or the half, the quarter ... that a hash picks, and the
    best of these is made, or else the single best move. So each step lowers the sum; it
    ends when nothing is proposed, or after `steps`. Columns without nulls, key unique.
    """
    from cohortica.operators.numbering import checkpointed, spread

    # fixed once: each step reads it, and its columns may be costly to make
    x = checkpointed(spread(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), key))
    held = checkpointed(x.join(kmeans(x, key, columns, k, steps=steps, seed=seed, **of_kmeans), key).transform(spread, key))
    span = range(len(columns))
    for step in range(steps):
        clusters = {r["cluster"]: (r["n"], np.array(r["s"]), r["q"]) for r in held.groupBy("cluster").agg(F.count("*").alias("n"), F.array(*[F.sum(c) for c in columns]).alias("s"), F.sum(reduce(lambda a, c: a + F.col(c) * F.col(c), columns, F.lit(0.0))).alias("q")).collect()}  # k rows
        if len(clusters) < 2:
            break
        square = sum(q for *_, q in clusters.values())
        cost = lambda of: square - sum(float(t @ t) / n for n, t in of.values() if n)
        now = {c: (n, t) for c, (n, t, _) in clusters.items()}
        small = 1e-12 * max(square, 1e-300)
        d = {c: reduce(lambda a, i, m=t / n: a + (F.col(columns[i]) - float(m[i])) * (F.col(columns[i]) - float(m[i])), span, F.lit(0.0)) for c, (n, t) in now.items()}
        pick = lambda f: reduce(lambda out, c: F.when(F.col("cluster") == c, f(c)).otherwise(out), now, F.lit(None).cast("double"))
        # a cluster of one row keeps it
        here = pick(lambda c: d[c] * (now[c][0] / (now[c][0] - 1)) if now[c][0] > 1 else F.lit(None).cast("double"))
        there = F.array_min(F.filter(F.array(*[F.struct((d[c] * (now[c][0] / (now[c][0] + 1))).alias("d"), F.lit(c).alias("to")) for c in now]), lambda z: z["to"] != F.col("cluster")))
        # kept by a share of 2 ** -level at most
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(step), key), 11).cast("double") + 1) / float(1 << 53)
        level = F.least(F.floor(-F.log2(u)), F.lit(HALVINGS)).cast("int")
        proposed = held.select("*", here.alias("__here"), there.alias("__there")).withColumn("__gain", F.col("__here") - F.col("__there.d")).withColumn("__level", level)
        moves = proposed.where(F.col("__gain") > small)
        sums = moves.groupBy("__level", "cluster", F.col("__there.to").alias("to")).agg(F.count("*").alias("n"), F.array(*[F.sum(c) for c in columns]).alias("s"), F.max(F.struct("__gain", key)).alias("best")).collect()  # levels x k x k rows at most
        if not sums:
            break
        tried = {}
        for j in range(HALVINGS + 1):
            of = dict(now)
            for r in sums:
                if r["__level"] >= j:
                    for c, sign in ((r["cluster"], -1), (r["to"], 1)):
                        of[c] = (of[c][0] + sign * r["n"], of[c][1] + sign * np.array(r["s"]))
            if any(r["__level"] >= j for r in sums) and all(n > 0 for n, _ in of.values()):
                tried[j] = cost(of)
        j = min(tried, key=tried.get, default=None)
        if j is not None and tried[j] < cost(now) - small:
            goes = F.col("__level") >= j
        else:
            goes = F.col(key) == max((r["best"] for r in sums), key=lambda b: b["__gain"])[key]
        held = checkpointed(proposed.select(key, *columns, F.when((F.col("__gain") > small) & goes, F.col("__there.to")).otherwise(F.col("cluster")).alias("cluster")))
    return df.select(key).join(held.select(key, "cluster"), key)


def distance_matrix(x: np.ndarray, method: str) -> np.ndarray:
    if method == "gower":
        r = x.max(axis=0) - x.min(axis=0)
        x = x / np.where(r > 0, r, 1)
    out = np.zeros((len(x), len(x)))
    for c in range(x.shape[1]):
        d = x[:, c][:, None] - x[:, c][None, :]
        out += d * d if method == "euclidean" else np.abs(d)
    return np.sqrt(out) if method == "euclidean" else out / x.shape[1] if method == "gower" else out


def pam(d: np.ndarray, k: int, most_swaps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Medoids and labels 1..k: greedy build, then the best swap as long as one helps."""
    n = len(d)
    medoids = [int(d.sum(axis=1).argmin())]
    near = d[medoids[0]].copy()
    while len(medoids) < k:
        gain = np.maximum(near[None, :] - d, 0).sum(axis=1)
        gain[medoids] = -1
        medoids.append(int(gain.argmax()))
        near = np.minimum(near, d[medoids[-1]])
    for _ in range(most_swaps):
        to = d[medoids]
        order = np.argsort(to, axis=0, kind="stable")
        first = to[order[0], np.arange(n)]
        second = to[order[1], np.arange(n)] if k > 1 else np.full(n, np.inf)
        best = (0.0, -1, -1)
        for i in range(k):
            without = np.where(order[0] == i, second, first)
            change = np.minimum(without[None, :], d).sum(axis=1) - first.sum()
            change[medoids] = np.inf
            h = int(change.argmin())
            if change[h] < best[0] - 1e-12:
                best = (float(change[h]), i, h)
        if best[1] < 0:
            break
        medoids[best[1]] = best[2]
    medoids = sorted(medoids)
    return np.array(medoids), d[medoids].argmin(axis=0) + 1


def average_linkage(d: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """Merges (i, j, height) of rows, the lowest first, by nearest-neighbour chains in O(n^2); i and j are rows of the two clusters. sizes: how many rows each row stands for."""
    n = len(d)
    d = d.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, alive, made = np.ones(n) if sizes is None else sizes.astype(float), np.ones(n, bool), []
    chain: list[int] = []
    for _ in range(n - 1):
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            row = np.where(alive, d[a], np.inf)
            row[a] = np.inf
            b = int(row.argmin())
            if len(chain) > 1 and row[chain[-2]] <= row[b]:
                b = chain[-2]
                break
            chain.append(b)
        chain = chain[:-2]
        made.append((a, b, d[a, b]))
        merged = (size[a] * d[a] + size[b] * d[b]) / (size[a] + size[b])
        keep, gone = min(a, b), max(a, b)
        alive[gone] = False
        d[keep], d[:, keep] = merged, merged
        d[keep, keep] = np.inf
        size[keep] += size[gone]
    return np.array(sorted(made, key=lambda m: m[2]))


def cut(merges: np.ndarray, n: int, k: int) -> np.ndarray:
    """Labels 1..k in order of first row, after the n - k lowest merges."""
    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    for a, b, _ in merges[: n - k]:
        x, y = sorted((root(int(a)), root(int(b))))
        parent[y] = x
    names: dict[int, int] = {}
    return np.array([names.setdefault(root(i), len(names) + 1) for i in range(n)])


def mean_silhouette(d: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Of each row; 0 for one alone in its cluster."""
    groups = np.unique(labels)
    if len(groups) < 2:
        return np.zeros(len(d))
    member = labels[:, None] == groups[None, :]
    total, size = d @ member, member.sum(axis=0)
    own = member.argmax(axis=1)
    at = np.arange(len(d))
    a = total[at, own] / np.maximum(size[own] - 1, 1)
    other = np.where(member, np.inf, total / size)
    b = other.min(axis=1)
    return np.where(size[own] > 1, (b - a) / np.maximum(np.maximum(a, b), 1e-300), 0.0)


def scaled_columns(x: np.ndarray) -> np.ndarray:
    """Mean 0 and sample deviation 1; columns without spread are 0."""
    sd = x.std(axis=0, ddof=1)
    return (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1)


def fit_labels(x: np.ndarray, method: str, distance: str, k: int, starts: int = S.kmeans_starts, seed: int = S.seed) -> np.ndarray:
    """Labels 1..k of raw rows by one model of the grid: scaled first, but for gower."""
    x = x if distance == "gower" else scaled_columns(x)
    if method == "kmeans":
        return kmeans_rows(x, k, starts, np.random.default_rng(seed + k))[0]
    d = distance_matrix(x, distance)
    return pam(d, k)[1] if method == "pam" else cut(average_linkage(d), len(x), k)


def _sampled(df: DataFrame, key: str, sets: dict[str, list[str]], sample: int, seed: int) -> tuple[list, dict[str, np.ndarray]]:
    """Keys and columns of at most `sample` rows."""
    from cohortica.operators.distance import sample_rows

    every = sorted({c for cols in sets.values() for c in cols})
    frame = sample_rows(df.select(key, *every), key, sample, seed).toPandas().sort_values(key)
    return frame[key].tolist(), {c: frame[c].to_numpy(float) for c in every}


def model_grid(df: DataFrame, key: str, sets: dict[str, list[str]], methods: tuple[str, ...] = ("manhattan", "gower", "euclidean"), ks: tuple[int, ...] = S.k_values, sample: int = S.sample_rows, seed: int = S.seed, starts: int = S.kmeans_starts) -> DataFrame:
    """model_id, feature_set, method, distance, k, average_silhouette, minimum_silhouette, negative_share, elapsed_seconds, assignment (array of id, cluster).

    k-medoids and average linkage for each set, k and distance other than
    euclidean, k-means for euclidean, over a sample of at most `sample` rows. A
    unit is a set, a distance, a method and, but for trees, a k; one tree is cut for every k.
    """
    spark = df.sparkSession
    sent = spark.sparkContext.broadcast(_sampled(df, key, sets, sample, seed))  # at most `sample` rows
    units = [(s, m, name, of) for s in sets for m in methods for name in (("kmeans",) if m == "euclidean" else ("pam", "hierarchical")) for of in ([list(ks)] if name == "hierarchical" else [[k] for k in ks])]
    schema = "model_id string, feature_set string, method string, distance string, k int, average_silhouette double, minimum_silhouette double, negative_share double, elapsed_seconds double, assignment array<struct<id:string,cluster:int>>"

    def run(s: str, m: str, name: str, of: list[int]) -> Iterator[tuple]:
        import time

        ids, held = sent.value
        raw = np.column_stack([held[c] for c in sets[s]])
        d = distance_matrix(raw if m == "gower" else scaled_columns(raw), m)
        tree = average_linkage(d) if name == "hierarchical" else None
        for k in (int(k) for k in of if k < len(raw)):
            began = time.perf_counter()
            labels = cut(tree, len(ids), k) if name == "hierarchical" else pam(d, k)[1] if name == "pam" else fit_labels(raw, "kmeans", "euclidean", k, starts, seed)
            w = mean_silhouette(d, labels)
            yield f"{s}|{name}|{m}|{k}", s, name, m, k, w.mean(), w.min(), (w < 0).mean(), time.perf_counter() - began, [{"id": str(i), "cluster": int(c)} for i, c in zip(ids, labels, strict=True)]

    return run_units(spark, units, "feature_set string, distance string, method string, of array<int>", run, schema)


def validate_models(df: DataFrame, key: str, sets: dict[str, list[str]], models: DataFrame, s: config.Settings = S, sample: int = S.sample_rows, finished: DataFrame | None = None) -> DataFrame:
    """model_id, cluster, mean_jaccard, median_jaccard, minimum_jaccard, sd_jaccard, calinski_harabasz, davies_bouldin, gap, gap_standard_error: a row per cluster of each of models (model_id, feature_set, method, distance, k).

    Each fit is a unit: of every model to the grid's sample, of every model to each
    resample of it, scaled anew, and of k-means to each reference set of a feature set and k.
    finished: what an earlier call of resampled() wrote; its (model, round) units aren't run again.
    """
    spark = df.sparkSession
    chosen = [tuple(r) for r in models.select("model_id", "feature_set", "method", "distance", "k").collect()]  # at most validated_models
    sent = spark.sparkContext.broadcast(_sampled(df, key, sets, sample, s.seed))
    fitted = fit_models(spark, chosen, sets, sent, s).collect()
    # resamples start k-means fewer times: hundreds of fits replace the best of many
    matched = resampled(spark, chosen, sets, sent, {r["model_id"]: np.array(r["labels"]) for r in fitted}, s.bootstrap_rounds, s.resample_share, s.seed, finished)
    gaps = gap_of_sets(spark, sorted({(f, k) for _, f, _, _, k in chosen}), sets, sent, s.gap_rounds, s.seed)
    own = spark.createDataFrame([(r["model_id"], f, k, r["calinski_harabasz"], r["davies_bouldin"]) for r in fitted for m, f, _, _, k in chosen if m == r["model_id"]], "model_id string, feature_set string, k int, calinski_harabasz double, davies_bouldin double")
    shared = own.join(F.broadcast(gaps), ["feature_set", "k"]).drop("feature_set", "k")  # a row a model
    return jaccard_summary(matched).join(F.broadcast(shared), "model_id")


def fit_models(spark, chosen: list[tuple], sets: dict[str, list[str]], sent, s: config.Settings = S) -> DataFrame:
    """model_id, labels (1..k of the sent rows), calinski_harabasz, davies_bouldin of each of chosen (model_id, feature_set, method, distance, k)."""

    def run(model: str, f: str, method: str, distance: str, k: int) -> Iterator[tuple]:
        raw = np.column_stack([sent.value[1][c] for c in sets[f]])
        labels = fit_labels(raw, method, distance, k, s.kmeans_starts, s.seed)
        yield model, labels.tolist(), *separation(scaled_columns(raw), labels)

    return run_units(spark, chosen, MODEL_UNIT, run, "model_id string, labels array<int>, calinski_harabasz double, davies_bouldin double")


#: Columns that name a model's unit.
MODEL_UNIT = "model_id string, feature_set string, method string, distance string, k int"


def resampled(spark, chosen: list[tuple], sets: dict[str, list[str]], sent, labels: dict[str, np.ndarray], rounds: int = S.bootstrap_rounds, share: float = S.resample_share, seed: int = S.seed, finished: DataFrame | None = None) -> DataFrame:
    """model_id, round, cluster, jaccard: likeness of each reference cluster (labels) to its match in a refit to each resample with replacement.

    A unit is a model and a round, and the rows of a round are a hash of its number:
    every model meets the same ones, on any number of tasks. Units in finished
    (what this gave before) are taken from there.
    """

    def run(model: str, f: str, method: str, distance: str, k: int, b: int) -> Iterator[tuple]:
        raw, reference = np.column_stack([sent.value[1][c] for c in sets[f]]), labels[model]
        at = resample(seed, len(raw), int(share * len(raw)), b)
        new, old = fit_labels(raw[at], method, distance, k, 5, seed), reference[at]
        cells = [(int(x), int(y), float(((old == x) & (new == y)).sum() / ((old == x) | (new == y)).sum())) for x in np.unique(old) for y in np.unique(new)]
        found = validity.match_clusters(cells)
        for c in np.unique(reference):
            yield model, b, int(c), found.get(int(c), (None, 0.0))[1]

    units = [(*m, b) for m in chosen for b in range(rounds)]
    schema = "model_id string, round int, cluster int, jaccard double"
    if finished is None:
        return run_units(spark, units, f"{MODEL_UNIT}, round int", run, schema)
    of = {m[0]: m for m in chosen}
    done = spark.createDataFrame([(*of[r["model_id"]], r["round"]) for r in finished.select("model_id", "round").distinct().collect() if r["model_id"] in of], f"{MODEL_UNIT}, round int")
    return run_units(spark, units, f"{MODEL_UNIT}, round int", run, schema, done).unionByName(finished.select("model_id", "round", "cluster", "jaccard"))


def jaccard_summary(matched: DataFrame) -> DataFrame:
    """model_id, cluster, mean, median, minimum, sd of resampled()'s jaccard over rounds."""
    j = F.col("jaccard")
    return matched.groupBy("model_id", "cluster").agg(F.avg(j).alias("mean_jaccard"), F.percentile(j, 0.5).alias("median_jaccard"), F.min(j).alias("minimum_jaccard"), F.stddev_samp(j).alias("sd_jaccard"))


def gap_of_sets(spark, wanted: list[tuple[str, int]], sets: dict[str, list[str]], sent, rounds: int = S.gap_rounds, seed: int = S.seed, starts: int = 5) -> DataFrame:
    """feature_set, k, gap, gap_standard_error of k-means on the sent rows, scaled, for each of wanted (feature_set, k).

    A unit is a feature set, k and round: round -1 is the rows themselves, the others
    uniform sets over their ranges, each number a hash of round, row and column.
    """

    def run(f: str, k: int, b: int) -> Iterator[tuple]:
        x = scaled_columns(np.column_stack([sent.value[1][c] for c in sets[f]]))
        if b >= 0:
            u = uniform(seed, b, np.arange(x.shape[0])[:, None], np.arange(x.shape[1])[None, :])
            x = x.min(axis=0) + u * (x.max(axis=0) - x.min(axis=0))
        yield f, k, b, float(np.log(max(_kmeans_cost(x, min(k, len(x)), starts, np.random.default_rng([seed, k, b + 1])), 1e-300)))

    logs = run_units(spark, [(f, k, b) for f, k in wanted for b in range(-1, rounds)], "feature_set string, k int, round int", run, "feature_set string, k int, round int, log_cost double")
    log, n = F.col("log_cost"), F.count_if(F.col("round") >= 0)
    uniform_log = F.when(F.col("round") >= 0, log)
    made = logs.groupBy("feature_set", "k").agg((F.avg(uniform_log) - F.max(F.when(F.col("round") < 0, log))).alias("gap"), (F.sqrt(1 + 1 / n) * F.coalesce(F.stddev_samp(uniform_log), F.lit(0.0))).alias("gap_standard_error"))
    return made


def separation(x: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Calinski-Harabasz and Davies-Bouldin of a bounded sample."""
    names, n = np.unique(labels), len(x)
    centres = np.array([x[labels == c].mean(axis=0) for c in names])
    within = sum(((x[labels == c] - m) ** 2).sum() for c, m in zip(names, centres, strict=True))
    between = ((x - x.mean(axis=0)) ** 2).sum() - within
    spread = np.array([np.sqrt(((x[labels == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(names, centres, strict=True)])
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    worst = ((spread[:, None] + spread[None]) / np.maximum(apart, 1e-300)).max(axis=1)
    return float(between / max(len(names) - 1, 1) / max(within / max(n - len(names), 1), 1e-300)), float(worst.mean())


def carry_over(df: DataFrame, sample: DataFrame, key: str, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """A clustering of a sample (key, cluster) on all rows: each goes to the nearest centroid."""
    centres = validity.centroids(df.join(F.broadcast(sample), key), columns, cluster)
    return validity.nearest_centroid(df, centres, key, columns, cluster)


def bootstrap_stability(df: DataFrame, key: str, columns: list[str], method: str, distance: str, k: int, rounds: int = S.bootstrap_rounds, share: float = S.resample_share, sample: int = S.sample_rows, seed: int = S.seed) -> DataFrame:
    """cluster, mean_jaccard, median_jaccard, minimum_jaccard, sd_jaccard of one model on at most `sample` rows over refits to resamples."""
    spark, sets, model = df.sparkSession, {"all": columns}, [("model", "all", method, distance, k)]
    sent = spark.sparkContext.broadcast(_sampled(df, key, sets, sample, seed))
    labels = fit_models(spark, model, sets, sent).first()["labels"]
    return jaccard_summary(resampled(spark, model, sets, sent, {"model": np.array(labels)}, rounds, share, seed)).drop("model_id")


def gap_statistic(df: DataFrame, key: str, columns: list[str], ks: tuple[int, ...] = S.k_values, rounds: int = S.gap_rounds, sample: int = S.sample_rows, seed: int = S.seed) -> DataFrame:
    """k, gap, gap_standard_error of k-means on at most `sample` rows, scaled, against uniform sets over their ranges."""
    sets = {"all": columns}
    sent = df.sparkSession.sparkContext.broadcast(_sampled(df, key, sets, sample, seed))
    return gap_of_sets(df.sparkSession, [("all", k) for k in ks], sets, sent, rounds, seed).drop("feature_set")


def _to(rows: np.ndarray, points: np.ndarray, distance: str) -> np.ndarray:
    """Distances of rows to points; gower: both divided by the ranges before."""
    d = np.zeros((len(rows), len(points)))
    for c in range(rows.shape[1]):
        t = rows[:, c][:, None] - points[:, c][None, :]
        d += t * t if distance == "euclidean" else np.abs(t)
    return np.sqrt(d) if distance == "euclidean" else d / rows.shape[1] if distance == "gower" else d


def k_medoids(df: DataFrame, key: str, columns: list[str], k: int, distance: str = "manhattan", samples: int = 5, sample: int = 400, candidates: int = 64, patience: int = 3, most_swaps: int = 200, seed: int = S.seed) -> DataFrame:
    """key, cluster (1..k in order of the medoids' coordinates), distance to its medoid, of all rows; columns without nulls, key unique.

    Medoids begin as the best over all rows of those that k-medoids finds on several
    samples, a unit each. Then rows are drawn as candidates and the gain of each swap of
    a medoid for a candidate is summed over all rows in one job, each row with its nearest
    and second nearest medoid; the best swap is made as long as one helps, and
    new candidates are drawn until `patience` draws in a row have none that
    helps. A table of at most `sample` rows is its own sample and one of at most
    `candidates` rows its own draw: no swap of any row helps there at the end.
    """
    from cohortica.operators.distance import sample_rows
    from cohortica.operators.numbering import spread

    if distance not in ("euclidean", "manhattan", "gower"):
        raise ValueError(f"unknown distance: {distance}")
    spark = df.sparkSession
    x = spread(df.select(key, *[F.col(c).cast("double").alias(c) for c in columns]), key).persist()
    term = (lambda t: t * t) if distance == "euclidean" else F.abs
    total = lambda m: reduce(lambda s, i: s + term(F.col(columns[i]).cast("double") / float(by[i]) - float(m[i])), range(len(columns)), F.lit(0.0))
    whole = lambda d: F.sqrt(d) if distance == "euclidean" else d / len(columns) if distance == "gower" else d
    nearest = lambda points: F.array_min(F.array(*[F.struct(whole(total(m)).alias("d"), F.lit(i).alias("i")) for i, m in enumerate(points, 1)]))
    try:
        one = x.agg(F.count("*").alias("n"), *[(F.max(c) - F.min(c)).alias(c) for c in columns]).first()
        n, by = one["n"], np.array([one[c] or 1.0 if distance == "gower" else 1.0 for c in columns])
        if n == 0:
            return df.select(key, F.lit(1).alias("cluster"), F.lit(0.0).alias("distance"))
        k = min(k, n)
        drawn = lambda rows, s: sample_rows(x, key, rows, s).toPandas().sort_values(key)[columns].to_numpy(float) / by
        held = spark.sparkContext.broadcast([drawn(sample, seed + i) for i in range(samples if n > sample else 1)])

        def begin(i: int) -> Iterator[tuple]:
            rows = held.value[i]
            yield i, [rows[m].tolist() for m in pam(distance_matrix(rows, distance if distance != "gower" else "manhattan"), min(k, len(rows)))[0]]

        found = run_units(spark, [(i,) for i in range(len(held.value))], "sample int", begin, "sample int, medoids array<array<double>>").orderBy("sample").collect()
        sets = [np.array(r["medoids"]) for r in found]

        def summed(run, shape: tuple[int, int]) -> np.ndarray:
            """The sum over tasks of a small matrix that run makes of rows."""

            def task(frames: Iterator) -> Iterator:
                import pandas as pd

                total = np.zeros(shape)
                for f in frames:
                    if len(f):
                        total += run(f[columns].to_numpy(float) / by)
                yield pd.DataFrame({"i": np.repeat(np.arange(shape[0]), shape[1]), "j": np.tile(np.arange(shape[1]), shape[0]), "v": total.ravel()})

            out = np.zeros(shape)
            for r in x.select(*columns).mapInPandas(task, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
                out[r["i"], r["j"]] = r["v"]
            return out

        costs = summed(lambda rows: np.array([[_to(rows, m, distance).min(axis=1).sum() for m in sets]]), (1, len(sets)))[0]
        medoids, cost = sets[int(costs.argmin())], float(costs.min())

        def gains(rows: np.ndarray) -> np.ndarray:
            """Change of the cost by each swap (candidate, medoid); in the last row the cost itself."""
            to = _to(rows, medoids, distance)
            order = np.argsort(to, axis=1, kind="stable")
            at = np.arange(len(rows))
            near, first = order[:, 0], to[at, order[:, 0]]
            second = to[at, order[:, 1]] if k > 1 else np.full(len(rows), np.inf)
            d = _to(rows, pool, distance)
            any_ = np.minimum(d - first[:, None], 0)
            member = (near[:, None] == np.arange(len(medoids))).astype(float)
            # a row of the medoid that goes: the candidate or its second nearest; any other row: the candidate if nearer
            own = np.minimum(d, second[:, None]) - first[:, None] - any_
            return np.vstack([any_.sum(axis=0)[:, None] + own.T @ member, np.full((1, len(medoids)), first.sum())])

        def central() -> np.ndarray:
            """Of each cluster, the row nearest to its middle in every coordinate."""
            near = x.select(*columns, nearest(medoids)["i"].alias("__i"))
            middles = {r["__i"]: np.array(r["m"]) / by for r in near.groupBy("__i").agg(F.array(*[F.percentile_approx(c, 0.5) for c in columns]).alias("m")).collect()}
            off = reduce(lambda out, i: F.when(F.col("__i") == i, total(middles[i])).otherwise(out), middles, F.lit(0.0))
            return np.array([r["row"] for r in near.groupBy("__i").agg(F.min_by(F.array(*columns), off).alias("row")).collect()]) / by

        draw = tries = swaps = 0
        while tries < (patience if n > candidates else 1) and swaps < most_swaps:
            pool = drawn(candidates, seed + 1000 + draw)
            if n > candidates:
                pool = np.unique(np.vstack([pool, central(), *(sets if draw == 0 else [])]), axis=0)
            draw, helped = draw + 1, False
            while swaps < most_swaps:
                g = summed(gains, (len(pool) + 1, len(medoids)))
                c, m = np.unravel_index(int(g[:-1].argmin()), g[:-1].shape)
                if g[c, m] >= -1e-9 * max(cost, 1e-12):
                    break
                medoids, cost, helped, swaps = medoids.copy(), float(g[-1, 0] + g[c, m]), True, swaps + 1
                medoids[m] = pool[c]
            tries = 0 if helped else tries + 1
    finally:
        x.unpersist()
    medoids = medoids[np.lexsort(medoids.T[::-1])]
    return df.select(key, nearest(medoids).alias("__best")).select(key, F.col("__best.i").alias("cluster"), F.col("__best.d").alias("distance"))


def _kmeans_cost(x: np.ndarray, k: int, starts: int, rng: np.random.Generator, steps: int = 50) -> float:
    return kmeans_rows(x, k, starts, rng, steps)[1]


def kmeans_rows(x: np.ndarray, k: int, starts: int, rng: np.random.Generator, steps: int = 50) -> tuple[np.ndarray, float]:
    """Labels 1..k and cost of the best of several starts on a bounded sample; an empty cluster keeps its centre."""
    best, labels = np.inf, np.ones(len(x), int)
    square = (x**2).sum(axis=1)
    for _ in range(starts):
        c = x[rng.choice(len(x), k, replace=False)]
        for _ in range(steps):
            d = np.maximum(square[:, None] - 2 * x @ c.T + (c**2).sum(axis=1)[None, :], 0)
            label = d.argmin(axis=1)
            member = (label[:, None] == np.arange(k)).astype(float)
            size = member.sum(axis=0)
            new = np.where(size[:, None] > 0, member.T @ x / np.maximum(size, 1)[:, None], c)
            if np.allclose(new, c):
                break
            c = new
        cost = float(d.min(axis=1).sum())
        if cost < best:
            best, labels = cost, label + 1
    return labels, best
