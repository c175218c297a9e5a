"""Composite scores that rank candidate segmentations. Tables of one row per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats

S = config.SETTINGS


def _all() -> WindowSpec:
    return Window.partitionBy()


def _weighted(parts: list[tuple[float, Column]]) -> Column:
    out = F.lit(0.0)
    for w, c in parts:
        out = out + F.lit(w) * c
    return out


def _norm(c: str) -> Column:
    return stats.normalise(F.col(c), _all())


def model_rank(q: DataFrame, s: config.Settings = S) -> DataFrame:
    """q: model_id, average_silhouette, balance, minimum_share, between_ratio -> with composite_score, acceptable_size, overall_rank, silhouette_rank."""
    out = q.withColumn("composite_score", _weighted(list(zip(s.model_weights, map(_norm, ("average_silhouette", "balance", "minimum_share", "between_ratio")), strict=True))))
    out = out.withColumn("acceptable_size", F.col("minimum_share") >= s.least_share)
    return out.withColumn("overall_rank", F.row_number().over(Window.orderBy(F.col("composite_score").desc_nulls_last(), "model_id"))).withColumn("silhouette_rank", F.rank().over(Window.orderBy(F.col("average_silhouette").desc_nulls_last())))


def best_by(ranked: DataFrame, group: str) -> DataFrame:
    return ranked.withColumn("__k", F.row_number().over(Window.partitionBy(group).orderBy(F.col("composite_score").desc_nulls_last(), "model_id"))).where("__k = 1").drop("__k")


def to_validate(ranked: DataFrame, s: config.Settings = S) -> DataFrame:
    return ranked.where(F.col("k").isin(*s.validated_k) & F.col("acceptable_size")).orderBy("overall_rank").limit(s.validated_models)


def stability_summary(jaccards: DataFrame, s: config.Settings = S) -> DataFrame:
    """jaccards: model_id, cluster, mean_jaccard -> mean, median, least, greatest and spread over clusters, n_stable, stable_model, good_model."""
    j = F.col("mean_jaccard")
    out = jaccards.groupBy("model_id").agg(F.avg(j).alias("average_jaccard"), F.median(j).alias("median_jaccard"), F.min(j).alias("minimum_jaccard"), F.max(j).alias("maximum_jaccard"), F.stddev_samp(j).alias("sd_jaccard"), F.count("*").alias("n_clusters"), F.count_if(j >= s.stable_jaccard).alias("n_stable"))
    stable = (F.col("average_jaccard") >= s.stable_jaccard) & (F.col("minimum_jaccard") >= s.stable_jaccard)
    return out.withColumn("stable_model", stable).withColumn("good_model", (F.col("average_jaccard") >= s.good_jaccard) & (F.col("minimum_jaccard") >= s.stable_jaccard))


def validation_rank(v: DataFrame, s: config.Settings = S) -> DataFrame:
    """v: model_id, composite_score, average_jaccard, gap, calinski_harabasz, davies_bouldin, stable_model, acceptable_size -> with validation_score, validation_rank, shortlist_status."""
    parts = [_norm("composite_score"), _norm("average_jaccard"), _norm("gap"), _norm("calinski_harabasz"), 1 - _norm("davies_bouldin")]
    out = v.withColumn("validation_score", _weighted(list(zip(s.validation_weights, parts, strict=True))))
    status = F.when(F.col("stable_model") & F.col("acceptable_size"), "Shortlist").when(~F.col("stable_model"), "Insufficient bootstrap stability").when(~F.col("acceptable_size"), "Cluster-size imbalance").otherwise("Review")
    return out.withColumn("validation_rank", F.row_number().over(Window.orderBy(F.col("validation_score").desc_nulls_last(), "model_id"))).withColumn("shortlist_status", status)


def candidates(v: DataFrame, s: config.Settings = S) -> DataFrame:
    """Shortlisted models (all, if none is) within the tolerance of the best score, at most candidate_models."""
    any_short = F.max(F.when(F.col("shortlist_status") == "Shortlist", 1).otherwise(0)).over(_all())
    kept = v.withColumn("__any", any_short).where((F.col("__any") == 0) | (F.col("shortlist_status") == "Shortlist")).drop("__any")
    best = F.max("validation_score").over(_all())
    return kept.withColumn("__best", best).where(F.col("validation_score") >= F.col("__best") - s.candidate_tolerance).drop("__best").orderBy(F.col("validation_score").desc_nulls_last(), "model_id").limit(s.candidate_models)


def final_model(c: DataFrame, s: config.Settings = S) -> DataFrame:
    """c: model_id, validation_score, mean_range, mean_association, balance -> with final_score, final_rank, selected."""
    out = c.withColumn("final_score", _weighted(list(zip(s.final_weights, map(_norm, ("validation_score", "mean_range", "mean_association", "balance")), strict=True))))
    out = out.withColumn("final_rank", F.row_number().over(Window.orderBy(F.col("final_score").desc_nulls_last(), "model_id")))
    return out.withColumn("selected", F.col("final_rank") == 1)
