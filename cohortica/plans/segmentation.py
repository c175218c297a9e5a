"""The segmentation workflow as stages over a respondent table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica import config
from cohortica.operators import audit, clean, cluster, features, profile, rules, selection, summaries, validity
from cohortica.plans.runner import Stage

S = config.SETTINGS


def stages(key: str, columns: list[str], categorical: list[str], groups: dict[str, str], s: config.Settings = S, sample: int = S.sample_rows) -> list[Stage]:
    """Audit, quality, scores, models, ranks, validation, candidates, comparison, final model, profiles, personas. Needs a table `respondents` with key, columns and categorical."""

    def audited(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        df = clean.clean_strings(t["respondents"])
        audit.check_key(df, key)
        return {"survey": df, "variable_audit": audit.variable_audit(df), "dataset_summary": audit.dataset_summary(df)}

    def quality(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        q = features.quality_metrics(t["survey"], columns, s)
        passed = [r["variable"] for r in q.where("initial_pass").select("variable").collect()]
        filled = clean.median_impute(t["survey"].select(key, *[F.col(c).cast("double").alias(c) for c in passed]), passed)
        pairs = features.high_correlations(features.correlation_pairs(filled, passed), s.high_correlation)
        table = {r["variable"]: r.asDict() for r in q.where("initial_pass").collect()}
        gone = {a for a, _ in features.remove_redundant(table, groups, [(r["variable_1"], r["variable_2"], r["absolute_correlation"]) for r in pairs.collect()])}
        kept = sorted(features.restore_groups(set(passed) - gone, table, groups))
        return {"quality_metrics": q, "high_correlations": pairs, "selected": filled.select(key, *kept)}

    def scores(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        cols = [c for c in t["selected"].columns if c != key]
        scaled = clean.standardise(t["selected"], cols)
        importance = features.pca_importance(features.gramian(scaled, cols)[2], s.pca_share, scaled=False)
        steady = features.stability(importance, features.bootstrap_importance(scaled, key, cols, s.bootstrap_rounds, s.seed))
        own = spark.createDataFrame([(c, groups[c], float(importance[i]), float(steady[i])) for i, c in enumerate(cols)], "variable string, group string, pca_importance double, stability_score double")
        scored = features.feature_score(own.join(t["quality_metrics"].select("variable", "entropy", "n_unique"), "variable"), s)
        sets = features.feature_sets([r.asDict() for r in scored.collect()], s)
        rows = [(n, v, groups[v]) for n, vs in sets.items() for v in vs]
        return {"feature_scores": scored, "feature_sets": spark.createDataFrame(rows, "feature_set string, variable string, group string"), "scaled": scaled}

    def models(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        sets: dict[str, list[str]] = {}
        for r in t["feature_sets"].collect():
            sets.setdefault(r["feature_set"], []).append(r["variable"])
        grid = cluster.model_grid(t["selected"], key, sets, ks=s.k_values, sample=sample, seed=s.seed, starts=s.kmeans_starts)
        return {"models": grid}

    def ranked(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        long = t["models"].select("model_id", F.explode("assignment").alias("a")).select("model_id", "a.*")
        cols = [c for c in t["scaled"].columns if c != key]
        sizes = validity.cluster_sizes(long, "cluster", "model_id")
        joined = long.join(t["scaled"].withColumn("id", F.col(key).cast("string")), "id")
        by = joined.groupBy("model_id", "cluster").agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s_{c}") for c in cols], *[F.sum(F.col(c) * F.col(c)).alias(f"q_{c}") for c in cols])
        within = sum((F.sum(F.col(f"q_{c}") - F.col(f"s_{c}") * F.col(f"s_{c}") / F.col("n")) for c in cols), F.lit(0.0))
        total = sum((F.sum(f"q_{c}") - F.sum(f"s_{c}") * F.sum(f"s_{c}") / F.sum("n") for c in cols), F.lit(0.0))
        ratio = by.groupBy("model_id").agg((1 - within / total).alias("between_ratio"))
        q = t["models"].drop("assignment").join(sizes, "model_id").join(ratio, "model_id")
        ranks = selection.model_rank(q, s)
        return {"model_ranks": ranks, "model_comparison": summaries.model_comparison_summary(ranks, "method", "distance"), "assignments": long}

    def validation(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        chosen = selection.to_validate(t["model_ranks"], s)
        sets: dict[str, list[str]] = {}
        for r in t["feature_sets"].collect():
            sets.setdefault(r["feature_set"], []).append(r["variable"])
        return {"cluster_stability": cluster.validate_models(t["selected"], key, sets, chosen, s, sample)}

    def validated(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        internal = t["cluster_stability"].groupBy("model_id").agg(*[F.first(c).alias(c) for c in ("calinski_harabasz", "davies_bouldin", "gap", "gap_standard_error")])
        scored = selection.validation_rank(t["model_ranks"].join(selection.stability_summary(t["cluster_stability"], s).drop("n_clusters"), "model_id").join(internal, "model_id"), s)
        return {"validation": scored, "validation_summary": summaries.validation_summary(scored, "method", "distance"), "candidates": selection.candidates(scored, s)}

    def compared(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        cols = [c for c in t["scaled"].columns if c != key]
        mine = t["assignments"].join(F.broadcast(t["candidates"].select("model_id")), "model_id")
        named = lambda d: d.withColumn("id", F.col(key).cast("string")).drop(key)
        agreement = validity.pairwise_adjusted_rand(mine)
        shown = summaries.model_distinctness(summaries.model_profiles(mine, named(t["scaled"]), cols, "id"))
        related = summaries.model_association_summary(summaries.model_associations(mine, named(t["survey"].select(key, *categorical)), categorical, "id"))
        made = summaries.candidate_summary(t["candidates"], shown, related, summaries.mean_ari(agreement))
        return {"agreement": agreement, "final_models": selection.final_model(made, s)}

    def final(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        best = t["final_models"].where("selected").select("model_id")
        cols = [c for c in t["scaled"].columns if c != key]
        labels = t["assignments"].join(F.broadcast(best), "model_id").select(F.col("id").alias("__id"), "cluster")
        sampled = t["scaled"].withColumn("__id", F.col(key).cast("string")).join(labels, "__id").select(key, "cluster")
        every = cluster.carry_over(t["scaled"], sampled, key, cols)
        return {"segments": every.select(key, F.col("cluster").alias("segment"))}

    def profiles(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        cols = [c for c in t["selected"].columns if c != key]
        joined = t["segments"].join(t["selected"], key).join(t["survey"].select(key, *categorical), key)
        return {"segment_sizes": profile.segment_sizes(joined), "segment_profile": profile.segment_profile(joined, cols), "categorical_profile": profile.categorical_profile(joined, categorical), "difference_tests": profile.difference_tests(joined, cols, categorical)}

    def personas(spark: SparkSession, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {"personas": rules.persona(t["segment_sizes"], t["segment_profile"], t["categorical_profile"])}

    return [
        Stage(1, "audit", audited, ("survey", "variable_audit", "dataset_summary")),
        Stage(2, "quality", quality, ("quality_metrics", "high_correlations", "selected")),
        Stage(3, "scores", scores, ("feature_scores", "feature_sets", "scaled")),
        Stage(4, "models", models, ("models",)),
        Stage(5, "ranks", ranked, ("model_ranks", "model_comparison", "assignments")),
        Stage(6, "validation", validation, ("cluster_stability",)),
        Stage(7, "candidates", validated, ("validation", "validation_summary", "candidates")),
        Stage(8, "comparison", compared, ("agreement", "final_models")),
        Stage(9, "final", final, ("segments",)),
        Stage(10, "profiles", profiles, ("segment_sizes", "segment_profile", "categorical_profile", "difference_tests")),
        Stage(11, "personas", personas, ("personas",)),
    ]
