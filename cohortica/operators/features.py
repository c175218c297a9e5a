"""Feature quality, redundancy, principal components, scores and feature sets.

Aggregates over rows run in Spark; what is as large as the number of features
(some tens) is worked on in the driver with numpy.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats
from cohortica.operators import audit
from cohortica.operators.units import uniform

S = config.SETTINGS


def quality_metrics(df: DataFrame, columns: list[str], s: config.Settings = S) -> DataFrame:
    """variable, n_missing, pct_missing, n_unique, standard_deviation, entropy, three passes, initial_pass, exclusion_reason."""
    counts = audit.variable_counts(df, columns).select("variable", "n_missing", "pct_missing", "n_unique")
    sd = audit.long_form(df, columns).groupBy("variable").agg(F.stddev_samp("value").alias("standard_deviation"))
    out = counts.join(sd, "variable").join(audit.entropy(df, columns).select("variable", "entropy"), "variable", "left")
    out = out.withColumn("missingness_pass", F.col("pct_missing") <= s.segmentation_missing_pct).withColumn("uniqueness_pass", F.col("n_unique") >= s.least_unique).withColumn("variance_pass", F.coalesce(F.col("standard_deviation") > s.least_sd, F.lit(False)))
    reason = F.when(~F.col("missingness_pass"), "Missingness above threshold").when(~F.col("uniqueness_pass"), "Insufficient unique values").when(~F.col("variance_pass"), "Zero or near-zero variance")
    return out.withColumn("initial_pass", F.col("missingness_pass") & F.col("uniqueness_pass") & F.col("variance_pass")).withColumn("exclusion_reason", reason)


def screen_features(df: DataFrame, columns: list[str], s: config.Settings = S) -> DataFrame:
    """variable, pct_missing, n_unique, retained: few enough missing values and more than one value."""
    c = audit.variable_counts(df, columns)
    return c.select("variable", "pct_missing", "n_unique", ((F.col("pct_missing") <= s.segmentation_missing_pct) & (F.col("n_unique") > 1)).alias("retained"))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable_1, variable_2, correlation, absolute_correlation of all pairs, by one aggregate; null where a side has no spread."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    # corr raises on no spread under ANSI, so it is built from sums of products
    sums = df.agg(*[F.covar_pop(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns])
    rows = [F.struct(F.lit(min(a, b)).alias("variable_1"), F.lit(max(a, b)).alias("variable_2"), F.try_divide(F.col(f"c{i}"), F.col(f"s_{a}") * F.col(f"s_{b}")).alias("correlation")) for i, (a, b) in enumerate(pairs)]
    return sums.select(F.explode(F.array(*rows)).alias("v")).select("v.*").withColumn("absolute_correlation", F.abs("correlation"))


def high_correlations(pairs: DataFrame, least: float = S.high_correlation) -> DataFrame:
    return pairs.where(F.col("absolute_correlation") >= least).orderBy(F.col("absolute_correlation").desc(), "variable_1", "variable_2")


def remove_redundant(quality: dict[str, dict], groups: dict[str, str], pairs: Sequence[tuple[str, str, float]], least_per_group: int = S.least_per_group) -> list[tuple[str, str]]:
    """(removed, kept) for each correlated pair, strongest first, of which both are still there.

    The last of a group is protected; otherwise the one with more missing values
    goes, then the one with less entropy, then with less spread, then the second.
    """
    left, out = set(quality), []
    for a, b, _ in sorted(pairs, key=lambda p: (-p[2], p[0], p[1])):
        if a not in left or b not in left:
            continue
        size = Counter(groups[v] for v in left)
        guarded_a, guarded_b = size[groups[a]] <= least_per_group, size[groups[b]] <= least_per_group
        if guarded_a != guarded_b:
            loser = b if guarded_a else a
        else:
            value = lambda v: (-quality[v]["pct_missing"], -np.inf if quality[v]["entropy"] is None else quality[v]["entropy"], -np.inf if quality[v]["standard_deviation"] is None else quality[v]["standard_deviation"])
            loser = a if value(a) < value(b) else b
        left.discard(loser)
        out.append((loser, b if loser == a else a))
    return out


def restore_groups(kept: set[str], quality: dict[str, dict], groups: dict[str, str]) -> set[str]:
    """For each group that lost all its variables, the best that passed: least missing, most entropy, most spread, then by name."""
    out = set(kept)
    for g in sorted({groups[v] for v in quality} - {groups[v] for v in kept}):
        best = min((v for v in quality if groups[v] == g), key=lambda v: (quality[v]["pct_missing"], -(quality[v]["entropy"] or 0), -(quality[v]["standard_deviation"] or 0), v))
        out.add(best)
    return out


def gramian(df: DataFrame, columns: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and covariance (sample) of columns without nulls, by one aggregate."""
    p = len(columns)
    aggs = [F.count("*").alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)], *[F.covar_samp(columns[i], columns[j]).alias(f"c{i}_{j}") for i in range(p) for j in range(i, p)]]
    r = df.agg(*aggs).first()
    cov = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)])
    return r["n"], np.array([r[f"m{i}"] or 0.0 for i in range(p)]), cov


def principal_components(cov: np.ndarray, scaled: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Variances, largest first, and loadings as columns, each with its largest entry positive."""
    if scaled:
        sd = np.sqrt(np.diag(cov))
        cov = cov / np.outer(sd, sd)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)
    values, vectors = np.maximum(values[order], 0), vectors[:, order]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])


def pca_variance(df: DataFrame, columns: list[str]) -> DataFrame:
    """component, variance, proportion, cumulative of the scaled columns."""
    values, _ = principal_components(gramian(df, columns)[2])
    total = values.sum()
    rows = [(i + 1, float(v), float(v / total), float(values[: i + 1].sum() / total)) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "component int, variance double, proportion double, cumulative double")


def pca_loadings(df: DataFrame, columns: list[str], top: int = 20) -> DataFrame:
    """component, variable, loading, the `top` largest in size of each component."""
    _, vectors = principal_components(gramian(df, columns)[2])
    rows = [(j + 1, columns[i], float(vectors[i, j])) for j in range(len(columns)) for i in np.argsort(-np.abs(vectors[:, j]), kind="stable")[:top]]
    return df.sparkSession.createDataFrame(rows, "component int, variable string, loading double")


def pca_scores(df: DataFrame, key: str, columns: list[str], k: int = 2) -> DataFrame:
    """key, pc_1 .. pc_k of each row: the components are as small as the columns, so projecting is one expression per row."""
    _, mean, cov = gramian(df, columns)
    sd = np.sqrt(np.diag(cov))
    _, vectors = principal_components(cov)
    score = lambda j: sum(((F.col(c) - float(mean[i])) / float(sd[i]) * float(vectors[i, j]) for i, c in enumerate(columns)), F.lit(0.0))
    return df.select(key, *[score(j).alias(f"pc_{j + 1}") for j in range(min(k, len(columns)))])


def pca_importance(cov: np.ndarray, target: float = S.pca_share, scaled: bool = True) -> np.ndarray:
    """Of each column: size of its loadings weighted by the proportions of the first components that reach the target together."""
    values, vectors = principal_components(cov, scaled)
    ratio = values / values.sum()
    k = int(np.searchsorted(np.cumsum(ratio), target - 1e-12) + 1)
    return np.abs(vectors[:, :k]) @ ratio[:k]


def bootstrap_importance(df: DataFrame, key: str, columns: list[str], rounds: int = S.bootstrap_rounds, seed: int = S.seed) -> np.ndarray:
    """rounds x columns: importances over resampled rows.

    Each row has a Poisson(1) weight in every round, which a hash of its key and the
    round decides, on any number of tasks. Tasks sum the weighted products; only
    matrices as large as the columns are added up.
    """
    p = len(columns)
    below = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(18)])

    def sums(frames: Iterator) -> Iterator:
        import pandas as pd

        total = np.zeros((rounds, p + 1, p + 1))
        for frame in frames:
            x = np.column_stack([np.ones(len(frame)), frame[columns].to_numpy(float)])
            keys = frame["__key"].to_numpy()
            for b in range(rounds):
                weight = np.searchsorted(below, uniform(seed, keys, b))
                total[b] += (x * weight[:, None]).T @ x
        yield pd.DataFrame({"round": np.repeat(np.arange(rounds), (p + 1) ** 2), "at": np.tile(np.arange((p + 1) ** 2), rounds), "value": total.ravel()})

    rows = df.select(*columns, F.xxhash64(key).alias("__key")).mapInPandas(sums, "round int, at int, value double").groupBy("round", "at").agg(F.sum("value").alias("value")).toPandas()
    out = []
    for _, g in rows.sort_values(["round", "at"]).groupby("round"):
        m = g["value"].to_numpy().reshape(p + 1, p + 1)
        mean = m[0, 1:] / m[0, 0]
        out.append(pca_importance(m[1:, 1:] / m[0, 0] - np.outer(mean, mean), scaled=False))
    return np.array(out)


def stability(reference: np.ndarray, resampled: np.ndarray) -> np.ndarray:
    """1 less the min-max scaled distance of the mean rank over rounds from the rank in the reference."""
    ranks = np.mean([_mid_ranks(-r) for r in resampled], axis=0)
    d = np.abs(ranks - _mid_ranks(-reference))
    return 1 - (np.ones_like(d) if d.max() == d.min() else (d - d.min()) / (d.max() - d.min()))


def _mid_ranks(x: np.ndarray) -> np.ndarray:
    return np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])


def feature_score(features: DataFrame, s: config.Settings = S) -> DataFrame:
    """features (variable, pca_importance, entropy, stability_score, n_unique) with component scores, combined_score and overall_rank."""
    w = Window.partitionBy()
    out = features.withColumn("pca_score", stats.normalise(F.col("pca_importance"), w)).withColumn("entropy_score", stats.normalise(F.col("entropy"), w)).withColumn("uniqueness_score", stats.normalise(F.log1p(F.col("n_unique").cast("double")), w))
    combined = s.score_pca * F.col("pca_score") + s.score_entropy * F.col("entropy_score") + s.score_stability * F.col("stability_score") + s.score_unique * F.col("uniqueness_score")
    out = out.withColumn("combined_score", combined)
    return out.withColumn("overall_rank", F.row_number().over(Window.orderBy(F.col("combined_score").desc_nulls_last(), "variable")))


def build_feature_set(target: int, scores: Sequence[dict], least_per_group: int = S.least_per_group) -> list[str]:
    """Forced variables, then the best of each group that still needs one, then the best of all, up to target; too many are cut from the worst, a group's last never.

    scores: variable, group, combined_score, force_keep, force_exclude.
    """
    pool = sorted((r for r in scores if not r.get("force_exclude")), key=lambda r: (-r["combined_score"], r["variable"]))
    chosen = [r for r in pool if r.get("force_keep")]
    target = min(max(target, len(chosen)), len(pool))
    for g in sorted({r["group"] for r in pool}):
        need = least_per_group - sum(r["group"] == g for r in chosen)
        chosen += [r for r in pool if r["group"] == g and r not in chosen][: max(0, need)]
    chosen += [r for r in pool if r not in chosen][: max(0, target - len(chosen))]
    for r in reversed(pool):
        size = Counter(x["group"] for x in chosen)
        if len(chosen) > target and r in chosen and not r.get("force_keep") and size[r["group"]] > least_per_group:
            chosen.remove(r)
    return [r["variable"] for r in sorted(chosen, key=lambda r: (-r["combined_score"], r["variable"]))]


def feature_sets(scores: Sequence[dict], s: config.Settings = S) -> dict[str, list[str]]:
    n = sum(not r.get("force_exclude") for r in scores)
    sizes = sorted({n, *(k for k in s.feature_counts if k <= n)}, reverse=True)
    return {f"set_{k}": build_feature_set(k, scores) for k in sizes}


def group_coverage(sets: DataFrame, available: DataFrame) -> DataFrame:
    """feature_set, group, n_selected, n_available, retention_pct. sets: feature_set, variable, group; available: variable, group."""
    have = available.groupBy("group").agg(F.count("*").alias("n_available"))
    got = sets.groupBy("feature_set", "group").agg(F.count("*").alias("n_selected"))
    every = sets.select("feature_set").distinct().join(F.broadcast(have))
    out = every.join(got, ["feature_set", "group"], "left").withColumn("n_selected", F.coalesce("n_selected", F.lit(0)))
    return out.select("feature_set", "group", "n_selected", "n_available", F.round(stats.pct(F.col("n_selected"), F.col("n_available")), 1).alias("retention_pct"))
