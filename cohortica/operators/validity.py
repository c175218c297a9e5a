"""How good a segmentation is: sizes, separation, silhouette, agreement. All by aggregates over any number of rows."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.functions import stats


def cluster_sizes(a: DataFrame, cluster: str = "cluster", *model: str) -> DataFrame:
    """n_clusters, least and greatest size and share, size_ratio, balance, size_entropy; of each model if it is named."""
    return sizes_of(a.groupBy(*model, cluster).agg(F.count("*").alias("n")), *model)


def sizes_of(n: DataFrame, *model: str) -> DataFrame:
    """cluster_sizes from a row per cluster with its number n of rows."""
    s = n.withColumn("share", stats.share(F.col("n"), F.sum("n").over(Window.partitionBy(*model))))
    out = s.groupBy(*model).agg(F.count("*").alias("n_clusters"), F.min("n").alias("minimum_size"), F.max("n").alias("maximum_size"), F.min("share").alias("minimum_share"), F.max("share").alias("maximum_share"), stats.entropy_of_shares("share").alias("size_entropy"))
    return out.withColumn("size_ratio", F.col("maximum_size") / F.col("minimum_size")).withColumn("balance", 1 - (F.col("maximum_share") - F.col("minimum_share")))


def _total(cols: list[Column]) -> Column:
    return reduce(add, cols)


def moments(df: DataFrame, columns: list[str], *by: str) -> DataFrame:
    """by, n, s_ and q_ of each column: rows, sums and sums of squares, in one pass."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"s_{c}") for c in columns], *[F.sum(F.col(c).cast("double") * F.col(c)).alias(f"q_{c}") for c in columns])


def variance_separation(df: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """total_ss, within_ss, between_ss, between_ratio, calinski_harabasz, in one pass: sums and sums of squares by cluster, then over clusters."""
    return separation_of(moments(df, columns, cluster), columns)


def separation_of(by: DataFrame, columns: list[str], *model: str) -> DataFrame:
    """variance_separation from a row of moments per cluster; of each model if it is named."""
    within = _total([F.sum(F.col(f"q_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}") / F.col("n")) for c in columns])
    whole = _total([F.sum(f"q_{c}") - F.sum(f"s_{c}") * F.sum(f"s_{c}") / F.sum("n") for c in columns])
    one = by.groupBy(*model).agg(F.count("*").alias("k"), F.sum("n").alias("rows"), whole.alias("total_ss"), within.alias("within_ss")).withColumn("between_ss", F.col("total_ss") - F.col("within_ss"))
    ch = F.try_divide(F.try_divide(F.col("between_ss"), (F.col("k") - 1).cast("double")), F.try_divide(F.col("within_ss"), (F.col("rows") - F.col("k")).cast("double")))
    return one.select(*model, "total_ss", "within_ss", "between_ss", F.try_divide("between_ss", "total_ss").alias("between_ratio"), ch.alias("calinski_harabasz"))


def centroids(df: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns], F.count("*").alias("n"))


def _apart(columns: list[str], a: str, b: str) -> Column:
    return F.sqrt(_total([(F.col(f"{a}{c}") - F.col(f"{b}{c}")) * (F.col(f"{a}{c}") - F.col(f"{b}{c}")) for c in columns]))


def nearest_centroid(df: DataFrame, centres: DataFrame, key: str, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """key, cluster, distance: centres (a row per cluster, so a small table) go to each task; ties go to the least cluster."""
    c = F.broadcast(centres.select(F.col(cluster).alias("__k"), *[F.col(x).alias(f"__c_{x}") for x in columns]).agg(F.collect_list(F.struct("__k", *[f"__c_{x}" for x in columns])).alias("__all")))
    d = lambda z: F.sqrt(_total([(F.col(x) - z[f"__c_{x}"]) * (F.col(x) - z[f"__c_{x}"]) for x in columns]))
    best = F.array_min(F.transform("__all", lambda z: F.struct(d(z).alias("d"), z["__k"].alias("k"))))
    return df.join(c).select(key, best.alias("__b")).select(key, F.col("__b.k").alias(cluster), F.col("__b.d").alias("distance"))


def nearest_of_models(df: DataFrame, by: DataFrame, columns: list[str], models: list[str]) -> DataFrame:
    """model_id, cluster, near, n, away: of each model's clusters how many rows each centroid is the nearest to (ties go to the least
    cluster), and the sum of their distances to their own centroid. One pass for all models, without a key; nulls are no cluster.

    df has a column of clusters for each model; by: model_id, cluster and moments, a row per cluster, so a small table.
    """
    found = by.where("cluster is not null").select("model_id", "cluster", *[(F.col(f"s_{x}") / F.col("n")).alias(f"c_{x}") for x in columns]).collect()
    of = {m: sorted((r for r in found if r["model_id"] == m), key=lambda r: r["cluster"]) for m in models}
    names = [(m, r["cluster"]) for m in models for r in of[m]]
    first = {m: names.index((m, of[m][0]["cluster"])) for m in models if of[m]}
    centres = {m: np.array([r[2:] for r in of[m]], dtype=float) for m in first}
    own = [(F.array_position(F.lit([r["cluster"] for r in of[m]]), F.col(m)).cast("int") - 1).alias(f"o{i}") for i, m in enumerate(first)]
    schema = "cluster int, near int, n long, away double"
    empty = df.select(F.lit(0).alias("cluster"), F.lit(0).alias("near"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("away")).limit(0)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, out = [b.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(len(columns))], []
            for i, (m, at) in enumerate(first.items()):
                number = b.column(f"o{i}").fill_null(-1).to_numpy()
                c, k = centres[m], len(centres[m])
                d = np.sqrt(sum((x[j][:, None] - c[None, :, j]) ** 2 for j in range(len(columns))))
                has = np.flatnonzero(number >= 0)
                cell = number[has] * k + d[has].argmin(axis=1)
                n, away = np.bincount(cell, minlength=k * k), np.bincount(cell, weights=d[has, number[has]], minlength=k * k)
                out += [(at + z // k, at + z % k, n[z], away[z]) for z in np.flatnonzero(n)]
            cluster, near, n, away = (np.array([r[i] for r in out]) for i in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(cluster, pa.int32()), pa.array(near, pa.int32()), pa.array(n, pa.int64()), pa.array(away, pa.float64(), mask=np.isnan(away.astype(float)))], names=["cluster", "near", "n", "away"])

    cells = df.select(*own, *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)]).mapInArrow(counted, schema) if first else empty
    told = cells.groupBy("cluster", "near").agg(F.sum("n").alias("n"), F.sum("away").alias("away"))
    name = lambda c, i: F.lit([x[i] for x in names] or [""])[F.col(c)]
    return told.select(name("cluster", 0).alias("model_id"), name("cluster", 1).alias("cluster"), name("near", 1).alias("near"), "n", "away")


def davies_bouldin(df: DataFrame, columns: list[str], cluster: str = "cluster") -> DataFrame:
    """davies_bouldin: mean over clusters of the worst (s_i + s_j) / d_ij."""
    c = centroids(df, columns, cluster).select(F.col(cluster), *[F.col(x).alias(f"__c_{x}") for x in columns])
    spread = df.join(F.broadcast(c), cluster).groupBy(cluster).agg(F.avg(_apart(columns, "", "__c_")).alias("s"))
    return davies_bouldin_of(c.join(spread, cluster), columns, cluster)


def davies_bouldin_of(spread: DataFrame, columns: list[str], cluster: str = "cluster", *model: str) -> DataFrame:
    """davies_bouldin from a row per cluster: its centroid (__c_ of each column) and s, the mean distance to it; of each model if it is named."""
    left = spread.select(*model, F.col(cluster).alias("i"), F.col("s").alias("si"), *[F.col(f"__c_{x}").alias(f"a_{x}") for x in columns])
    right = spread.select(*[F.col(m).alias(f"__{m}") for m in model], F.col(cluster).alias("j"), F.col("s").alias("sj"), *[F.col(f"__c_{x}").alias(f"b_{x}") for x in columns])
    other = reduce(lambda a, b: a & b, [F.col(m) == F.col(f"__{m}") for m in model], F.col("i") != F.col("j"))
    worst = left.join(F.broadcast(right), other).groupBy(*model, "i").agg(F.max(F.try_divide(F.col("si") + F.col("sj"), _apart(columns, "a_", "b_"))).alias("r"))
    return worst.groupBy(*model).agg(F.avg("r").alias("davies_bouldin"))


def silhouette(pairs: DataFrame, assignment: DataFrame, cluster: str = "cluster") -> DataFrame:
    """id, cluster, silhouette from a table of distances (id_a < id_b, d) of a sample; the only one of a cluster has 0."""
    both = pairs.select(F.col("id_a").alias("id"), F.col("id_b").alias("other"), "d").unionAll(pairs.select(F.col("id_b").alias("id"), F.col("id_a").alias("other"), "d"))
    own = assignment.select("id", F.col(cluster).alias("own"))
    far = assignment.select(F.col("id").alias("other"), F.col(cluster).alias("theirs"))
    mean = both.join(far, "other").groupBy("id", "theirs").agg(F.avg("d").alias("m")).join(own, "id")
    ab = mean.groupBy("id", "own").agg(F.max(F.when(F.col("theirs") == F.col("own"), F.col("m"))).alias("a"), F.min(F.when(F.col("theirs") != F.col("own"), F.col("m"))).alias("b"))
    s = F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise(F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return ab.select("id", F.col("own").alias(cluster), s.alias("silhouette"))


def coordinate_sums(df: DataFrame, key: str, columns: list[str], clusterings: list[str], ranges: int | None = None) -> tuple[DataFrame, dict[str, dict], list[float]]:
    """id, o0, o1, ... (the number of the row's cluster in each clustering), coordinate, d0, d1, ... (the summed |x - y| in this
    coordinate to the rows y of each cluster of the first clustering, then of the next); size of each cluster; range of each column.

    The sum of |x - y| over a cluster's rows y follows from how many of them lie below x and what they add up to. So each
    coordinate's values are sorted once for all clusterings, in ranges, and every row gets its sums from the ranges before
    and from the rows before it in its own: no pair is made, and the work is that of sorting rows x columns values.
    Numeric columns without nulls. key: unique. Clusters are few: two running sums for each, and their totals by range
    (a row for each range and, where a coordinate begins within one, one more) go to each task.
    """
    from cohortica.operators.numbering import in_ranges

    sizes = {m: dict(sorted(tuple(r) for r in df.where(F.col(m).isNotNull()).groupBy(m).agg(F.count("*")).collect())) for m in clusterings}
    # values are taken from their mean, so that sums stay small
    one = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(columns)], *[(F.max(c) - F.min(c)).cast("double").alias(f"r{i}") for i, c in enumerate(columns)]).first()
    values = F.array(*[F.coalesce(F.col(c).cast("double") - float(one[f"m{i}"] or 0.0), F.lit(0.0)) for i, c in enumerate(columns)])
    known = [m for m in clusterings if sizes[m]]
    owns = [f"o{i}" for i in range(len(clusterings))]
    own = lambda m: F.array_position(F.lit(list(sizes[m])), F.col(m)).cast("int") - 1 if sizes[m] else F.lit(None).cast("int")
    placed = df.where(reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in known], F.lit(False)))
    long = placed.select(F.col(key).alias("id"), *[own(m).alias(o) for m, o in zip(clusterings, owns, strict=True)], F.posexplode(values).alias("coordinate", "v"))
    sorted_ = in_ranges(long, "coordinate", "v", "id", ranges=ranges)
    of = [(o, i) for m, o in zip(clusterings, owns, strict=True) for i in range(len(sizes[m]))]
    cells = sorted_.groupBy("range", "coordinate", *owns).agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    mine = [F.sum(F.when(F.col(o) == i, F.col(x)).otherwise(0.0)).alias(f"{x}{at}") for x in "ns" for at, (o, i) in enumerate(of)]
    k, starts, past = len(of), {}, {}
    for r in cells.groupBy("range", "coordinate").agg(F.sum("n"), *mine).orderBy("coordinate", "range").collect():
        before = past.get(r["coordinate"], np.zeros(2 * k))
        starts[r["range"], r["coordinate"]], past[r["coordinate"]] = before, before + np.array(r[3:], dtype=float)
    offsets = {o: at for at, (o, i) in reversed(list(enumerate(of)))}

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = None
        for b in batches:
            ranges_, coordinates, v = (b.column(c).to_numpy() for c in ("range", "coordinate", "v"))
            hot = np.zeros((len(v), k))
            for o, first in offsets.items():
                number = b.column(o).fill_null(-1).to_numpy()
                has = np.flatnonzero(number >= 0)
                hot[has, first + number[has]] = 1
            d = np.empty((len(v), k))
            edges = [0, *(np.flatnonzero(np.diff(coordinates)) + 1), len(v)]
            for low, high in zip(edges, edges[1:]):
                if low == high:
                    continue
                if place != (at := (int(ranges_[low]), int(coordinates[low]))):
                    place, (n, s), (all_n, all_s) = at, np.split(starts[at], 2), np.split(past[at[1]], 2)
                x = v[low:high, None]
                below, under = np.cumsum(hot[low:high], axis=0) + n, np.cumsum(hot[low:high] * x, axis=0) + s
                d[low:high] = x * below - under + (all_s - under) - x * (all_n - below)
                n, s = below[-1], under[-1]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", *owns, "coordinate")] + [pa.array(d[:, i]) for i in range(k)], names=["id", *owns, "coordinate", *[f"d{i}" for i in range(k)]])

    kinds = [f"id {sorted_.schema['id'].dataType.simpleString()}", *[f"{o} int" for o in owns], "coordinate int", *[f"d{i} double" for i in range(k)]]
    spans = [float(one[f"r{i}"] or 0.0) for i in range(len(columns))]
    return sorted_.mapInArrow(running, ", ".join(kinds)), sizes, spans


Measure = tuple[list[str], str, str]  # columns, distance, clustering


def _sums(df: DataFrame, key: str, measures: list[Measure], ranges: int | None = None) -> tuple[DataFrame, list[tuple[str, list[str], dict]]]:
    """A row for each key: its own clusters' numbers and its summed distances; of each measure the columns of both, and the sizes of its clusters.

    Gower divides by each column's range, one without range counts 0.
    """
    for _, method, _ in measures:
        if method not in ("manhattan", "gower"):
            raise ValueError(f"no sum over coordinates: {method}")
    columns, clusterings = (list(dict.fromkeys(x)) for x in ((c for cols, _, _ in measures for c in cols), (m for *_, m in measures)))
    each, sizes, spans = coordinate_sums(df, key, columns, clusterings, ranges)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if len(columns) <= n:
        each = each.repartition(n, "id")  # a range holds few rows of one key, so summing before the shuffle would only fill memory
    first = {m: sum(len(sizes[x]) for x in clusterings[:i]) for i, m in enumerate(clusterings)}
    sums, found = [], []
    for j, (cols, method, m) in enumerate(measures):
        weight = [0.0 if c not in cols else 1.0 if method == "manhattan" else 1.0 / span / len(cols) if span else 0.0 for c, span in zip(columns, spans, strict=True)]
        of = lambda i: F.col(f"d{i}") if set(weight) == {1.0} else F.col(f"d{i}") * F.lit(weight)[F.col("coordinate")]  # noqa: B023, E731
        names = [f"t{j}_{i}" for i in range(len(sizes[m]))]
        sums += [F.sum(of(first[m] + i)).alias(name) for i, name in enumerate(names)]
        found.append((f"o{clusterings.index(m)}", names, sizes[m]))
    owns = [f"o{i}" for i in range(len(clusterings))]
    return (each.groupBy("id", *owns).agg(*sums) if sums else each.select("id", *owns).limit(0)), found


def distance_sums(df: DataFrame, key: str, columns: list[str], method: str, cluster: str = "cluster", ranges: int | None = None) -> tuple[DataFrame, list]:
    """id, own (the number of its cluster), of (array: the summed distance to all rows of each cluster), and the clusters in order. Manhattan and Gower distances are sums over coordinates: see coordinate_sums."""
    sums, [(own, names, sizes)] = _sums(df, key, [(columns, method, cluster)], ranges)
    return sums.select("id", F.col(own).alias("own"), F.array(*names).cast("array<double>").alias("of")), list(sizes)


def mean_distances(df: DataFrame, key: str, columns: list[str], method: str, cluster: str = "cluster", ranges: int | None = None) -> DataFrame:
    """id, own cluster, other, mean_distance of each row to the rows of each cluster, itself left out in its own; null where that leaves none."""
    sums, clusters = distance_sums(df, key, columns, method, cluster, ranges)
    kind = df.schema[cluster].dataType
    if not clusters:
        return sums.select("id", F.lit(None).cast(kind).alias("own"), F.lit(None).cast(kind).alias("other"), F.lit(0.0).alias("mean_distance"))
    sizes = {r[cluster]: r["n"] for r in df.groupBy(cluster).agg(F.count("*").alias("n")).collect()}
    size, name = F.lit([sizes[c] for c in clusters]), F.lit(clusters)
    n = size[F.col("i")] - F.when(F.col("i") == F.col("own"), 1).otherwise(0)
    return sums.select("id", "own", F.posexplode("of").alias("i", "d")).select("id", name[F.col("own")].cast(kind).alias("own"), name[F.col("i")].cast(kind).alias("other"), F.try_divide(F.greatest("d", F.lit(0.0)), n.cast("double")).alias("mean_distance"))


def _silhouette(own: str, names: list[str], sizes: dict) -> Column:
    """Of a row of _sums; the only one of a cluster has 0, and so have all of a single cluster. Null without a cluster."""
    at = F.col(own)
    mean = [F.try_divide(F.greatest(F.col(name), F.lit(0.0)), F.lit(float(n)) - F.when(at == i, 1.0).otherwise(0.0)) for i, (name, n) in enumerate(zip(names, sizes.values(), strict=True))]
    a, b = F.coalesce(*[F.when(at == i, x) for i, x in enumerate(mean)]), F.array_min(F.array(*[F.when(at != i, x) for i, x in enumerate(mean)]))
    s = F.when(a.isNull() | b.isNull(), 0.0).otherwise(F.coalesce(F.try_divide(b - a, F.greatest(a, b)), F.lit(0.0)))
    return F.when(at.isNotNull(), s)


def silhouette_by_coordinates(df: DataFrame, key: str, columns: list[str], method: str, cluster: str = "cluster", ranges: int | None = None) -> DataFrame:
    """id, cluster, silhouette of all rows by Manhattan or Gower distance, without pairs; the only one of a cluster has 0, and so have all of a single cluster."""
    sums, [(own, names, sizes)] = _sums(df, key, [(columns, method, cluster)], ranges)
    kind = df.schema[cluster].dataType
    if not sizes:
        return sums.select("id", F.lit(None).cast(kind).alias(cluster), F.lit(0.0).alias("silhouette"))
    return sums.select("id", F.lit(list(sizes))[F.col(own)].cast(kind).alias(cluster), _silhouette(own, names, sizes).alias("silhouette"))


def average_silhouettes(df: DataFrame, key: str, measures: list[Measure], ranges: int | None = None) -> DataFrame:
    """measure (its place in the list), average_silhouette: mean over all rows of each measure (columns, distance, clustering), from one sorting for all."""
    sums, found = _sums(df, key, measures, ranges)
    means = [F.avg(_silhouette(*x)) if x[2] else F.max(F.lit(None).cast("double")) for x in found]
    return sums.agg(F.array(*means).alias("all")).select(F.posexplode("all").alias("measure", "average_silhouette"))


def silhouette_summary(s: DataFrame) -> DataFrame:
    return s.agg(F.avg("silhouette").alias("average_silhouette"), F.min("silhouette").alias("minimum_silhouette"), F.avg(F.when(F.col("silhouette") < 0, 1.0).otherwise(0.0)).alias("negative_share"))


def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, n of the rows that have both."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"))


def jaccard(df: DataFrame, a: str, b: str) -> DataFrame:
    """a, b, jaccard of each pair of clusters that share rows."""
    return jaccard_of(contingency(df, a, b), a, b)


def jaccard_of(t: DataFrame, a: str, b: str, *model: str) -> DataFrame:
    """jaccard from a table of how many rows n each pair of clusters shares; of each model if it is named."""
    n_a, n_b = F.sum("n").over(Window.partitionBy(*model, a)), F.sum("n").over(Window.partitionBy(*model, b))
    return t.select(*model, a, b, (F.col("n") / (n_a + n_b - F.col("n"))).alias("jaccard"))


def match_clusters(rows: list[tuple[object, object, float]]) -> dict[object, tuple[object, float]]:
    """Reference cluster -> (cluster, jaccard), in order of the reference, each cluster once; without partner jaccard 0."""
    out, taken = {}, set()
    for ref in sorted({r[0] for r in rows}):
        free = [(j, c) for r, c, j in rows if r == ref and c not in taken]
        if free:
            j, c = max(free, key=lambda x: (x[0], str(x[1])))
            taken.add(c)
            out[ref] = (c, j)
        else:
            out[ref] = (None, 0.0)
    return out


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """n_compared, adjusted_rand_index of two labels of the same rows."""
    t = contingency(df, a, b)
    pairs = lambda d: d.agg(F.sum(stats.pairs_of(F.col("n"))).alias("p"))
    cells = t.agg(F.sum("n").alias("n"), F.sum(stats.pairs_of(F.col("n"))).alias("cells"))
    rows = pairs(t.groupBy(a).agg(F.sum("n").alias("n"))).withColumnRenamed("p", "rows")
    cols = pairs(t.groupBy(b).agg(F.sum("n").alias("n"))).withColumnRenamed("p", "cols")
    one = cells.join(rows).join(cols)
    expected = F.try_divide(F.col("rows") * F.col("cols"), stats.pairs_of(F.col("n")))
    top, bottom = F.col("cells") - expected, (F.col("rows") + F.col("cols")) / 2 - expected
    return one.select(F.col("n").alias("n_compared"), F.when(F.col("n") >= 2, F.when(bottom == 0, 1.0).otherwise(F.try_divide(top, bottom))).alias("adjusted_rand_index"))


def pairwise_adjusted_rand(assignments: DataFrame) -> DataFrame:
    """model_1, model_2, n_compared, adjusted_rand_index of all ordered pairs of models. assignments: model_id, id, cluster.

    One join on id and one contingency table for all pairs; models are tens.
    """
    x = assignments.select("id", F.col("model_id").alias("model_1"), F.col("cluster").alias("a"))
    y = assignments.select("id", F.col("model_id").alias("model_2"), F.col("cluster").alias("b"))
    return _rand_of(x.join(y, "id").groupBy("model_1", "model_2", "a", "b").agg(F.count("*").alias("n")))


def adjusted_rand_of_columns(df: DataFrame, models: list[str]) -> DataFrame:
    """pairwise_adjusted_rand of models that are columns of clusters: rows are counted by all of them first, so none is joined with itself."""
    counted = df.groupBy(*models).agg(F.count("*").alias("n"))
    side = lambda name, cluster: F.explode(F.array(*[F.struct(F.lit(m).alias(name), F.col(m).cast("string").alias(cluster)) for m in models]))
    pairs = counted.select("*", side("model_1", "a").alias("x")).select("*", side("model_2", "b").alias("y"))
    return _rand_of(pairs.select("x.*", "y.*", "n").groupBy("model_1", "model_2", "a", "b").agg(F.sum("n").alias("n")))


def _rand_of(t: DataFrame) -> DataFrame:
    key = ["model_1", "model_2"]
    cells = t.groupBy(*key).agg(F.sum("n").alias("n_compared"), F.sum(stats.pairs_of(F.col("n"))).alias("cells"))
    side = lambda c: t.groupBy(*key, c).agg(F.sum("n").alias("n")).groupBy(*key).agg(F.sum(stats.pairs_of(F.col("n"))).alias(f"p_{c}"))
    one = cells.join(side("a"), key).join(side("b"), key)
    expected = F.try_divide(F.col("p_a") * F.col("p_b"), stats.pairs_of(F.col("n_compared")))
    bottom = (F.col("p_a") + F.col("p_b")) / 2 - expected
    return one.select(*key, "n_compared", F.when(F.col("n_compared") >= 2, F.when(bottom == 0, 1.0).otherwise(F.try_divide(F.col("cells") - expected, bottom))).alias("adjusted_rand_index"))


def gap(log_within: float, log_within_uniform: list[float]) -> tuple[float, float]:
    """Gap statistic and its standard error from the log within-sums of uniform reference sets."""
    b = len(log_within_uniform)
    mean = sum(log_within_uniform) / b
    sd = math.sqrt(sum((x - mean) ** 2 for x in log_within_uniform) / (b - 1)) if b > 1 else 0.0
    return mean - log_within, math.sqrt(1 + 1 / b) * sd
