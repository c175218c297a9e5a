"""Summary tables of the workflow's stages. Each reads tables of one row per variable, model or segment; only those that say so read respondents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats
from cohortica.operators import audit, profile
from cohortica.operators.profile import _long

S = config.SETTINGS


def items(table: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """item, value (double): one row per aggregate over the table, in one pass."""
    wide = table.agg(*[c.cast("double").alias(f"c{i}") for i, c in enumerate(counts.values())])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("item"), F.col(f"c{i}").alias("value")) for i, n in enumerate(counts)])).alias("v")).select("v.*")


# ---- variables ----


def configured_vs_observed(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """variable, label, role, group, configured_type, observed_type, n_missing, pct_missing, n_unique, minimum, maximum of each declared column that df has. Reads respondents, once."""
    names = [c for c in df.columns if c in {r["variable"] for r in metadata.select("variable").collect()}]
    kinds = dict(df.dtypes)
    numeric = [c for c in names if kinds[c] in ("double", "float", "int", "bigint", "smallint")]
    found = audit.variable_counts(df, names).select("variable", "n_missing", F.round("pct_missing", 2).alias("pct_missing"), "n_unique")
    span = audit.numeric_summary(df, numeric).select("variable", "minimum", "maximum")
    observed = F.create_map(*[F.lit(x) for c in names for x in (c, kinds[c])])
    return metadata.join(found, "variable").join(span, "variable", "left").select("variable", "label", "role", "group", F.col("data_type").alias("configured_type"), observed[F.col("variable")].alias("observed_type"), "n_missing", "pct_missing", "n_unique", "minimum", "maximum")


def with_role(dictionary: DataFrame, role: str) -> DataFrame:
    """The dictionary of one role: metadata, segmentation or profiling."""
    return dictionary.where(F.col("role") == role)


def numeric_dictionary(dictionary: DataFrame, numeric_summary: DataFrame) -> DataFrame:
    """Dictionary rows of numeric variables with their summary."""
    return dictionary.join(numeric_summary, "variable")


def high_missing(counts: DataFrame, s: config.Settings = S) -> DataFrame:
    return counts.where(F.col("pct_missing") >= s.high_missing_pct)


def low_variance(quality: DataFrame) -> DataFrame:
    """Variables with at most one value or no spread."""
    return quality.where((F.col("n_unique") <= 1) | F.col("standard_deviation").isNull() | (F.col("standard_deviation") == 0))


def preprocessing_summary(counts: DataFrame, dictionary: DataFrame, s: config.Settings = S) -> DataFrame:
    """item, value. counts: of the observed variables, with n_missing and n_non_missing; dictionary: with data_type."""
    all_of = dictionary.join(counts.select("variable", (F.col("n_missing") + F.col("n_non_missing")).alias("rows"), F.col("n_unique").alias("values"), F.col("pct_missing").alias("missing")), "variable", "full")
    candidate = F.col("include_segmentation")
    gone = F.col("missing") > s.segmentation_missing_pct
    flat = F.col("values") <= 1
    of_type = lambda t: F.count_if(F.col("data_type") == t)
    return items(all_of, {
        "Rows": F.max("rows"), "Columns": F.count("rows"), "Configured variables": F.count("role"), "Segmentation candidates": F.count_if(candidate),
        "Segmentation variables retained": F.count_if(candidate & ~gone & ~flat), "Profiling variables": F.count_if("include_profiling"), "Metadata variables": F.count_if(F.col("role") == "metadata"),
        "Binary variables": of_type("binary"), "Ordinal variables": of_type("ordinal"), "High-missingness exclusions": F.count_if(candidate & gone), "Zero-variance exclusions": F.count_if(candidate & flat),
    })


def dictionary_summary(dictionary: DataFrame, counts: DataFrame) -> DataFrame:
    """item, value: 14 counters of a dictionary with data_type, and of the data it describes."""
    both = dictionary.join(counts.select("variable", (F.col("n_missing") + F.col("n_non_missing")).alias("rows")), "variable", "full")
    of_type = lambda t: F.count_if(F.col("data_type") == t)
    return items(both, {
        "Rows in dataset": F.max("rows"), "Variables in dataset": F.count("rows"), "Variables in metadata": F.count("role"), "Matched variables": F.count_if(F.col("role").isNotNull() & F.col("rows").isNotNull()),
        "Metadata variables": F.count_if(F.col("role") == "metadata"), "Segmentation variables": F.count_if("include_segmentation"), "Profiling variables": F.count_if("include_profiling"),
        "Categorical variables": of_type("categorical"), "Ordinal variables": of_type("ordinal"), "Binary variables": of_type("binary"), "Numeric variables": of_type("numeric"), "Text variables": of_type("text"),
        "Variables with missing values": F.count_if(F.col("n_missing") > 0), "Variables with unexpected missing values": F.count_if(F.col("missingness_status") == "Unexpected missing values"),
    })


def components_for(variance: DataFrame, shares: tuple[float, ...] = (0.5, 0.7, 0.8)) -> DataFrame:
    """share, components: how many components say that share of the variance. variance: component, cumulative (as pca_variance gives)."""
    wide = variance.agg(*[F.min(F.when(F.col("cumulative") >= s - 1e-12, F.col("component"))).alias(f"c{i}") for i, s in enumerate(shares)])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(s).alias("share"), F.col(f"c{i}").cast("long").alias("components")) for i, s in enumerate(shares)])).alias("v")).select("v.*")


def best_of_kind(models: DataFrame) -> DataFrame:
    """method, k, average_silhouette: each method's model of the greatest mean silhouette, ties by k."""
    w = Window.partitionBy("method").orderBy(F.col("average_silhouette").desc_nulls_last(), "k")
    return models.withColumn("__i", F.row_number().over(w)).where("__i = 1").select("method", "k", "average_silhouette")


def exploratory_summary(rows: int, quality: DataFrame, pairs: DataFrame, components: DataFrame, best: DataFrame, sample: int) -> DataFrame:
    """item, value: the stage's counters, the components for each share, and each method's best k and silhouette."""
    flat = (F.col("n_unique") <= 1) | (F.coalesce("standard_deviation", F.lit(0.0)) == 0)
    of_variables = items(quality, {"Rows": F.max(F.lit(rows)), "Candidate variables": F.count("*"), "Variables retained after low-variance check": F.count_if(~flat), "Variables with missing values": F.count_if(F.col("n_missing") > 0), "Low-variance variables": F.count_if(flat)})
    of_pairs = items(pairs, {"High-correlation pairs": F.count("*")})
    of_shares = components.select(F.concat(F.lit("PCA components for "), F.round(F.col("share") * 100).cast("int").cast("string"), F.lit("% cumulative variance")).alias("item"), F.col("components").cast("double").alias("value"))
    of_models = best.select(F.explode(F.array(F.struct(F.concat(F.lit("Best "), "method", F.lit(" k")).alias("item"), F.col("k").cast("double").alias("value")), F.struct(F.concat(F.lit("Best "), "method", F.lit(" silhouette")).alias("item"), F.round("average_silhouette", 4).alias("value")))).alias("v")).select("v.*")
    last = items(quality, {"Distance sample size": F.max(F.lit(min(rows, sample)))})
    return of_variables.unionByName(of_pairs).unionByName(of_shares).unionByName(of_models).unionByName(last)


def feature_set_summary(sets: DataFrame, scores: DataFrame) -> DataFrame:
    """sets: feature_set, variable; scores: variable, group, combined_score, force_keep -> one row per set."""
    return sets.join(scores, "variable").groupBy("feature_set").agg(F.count("*").alias("feature_count"), F.countDistinct("group").alias("groups_represented"), F.avg("combined_score").alias("mean_combined_score"), F.min("combined_score").alias("minimum_combined_score"), F.count_if("force_keep").alias("forced_keep_features"))


def selected_by_group(sets: DataFrame, scores: DataFrame) -> DataFrame:
    """feature_set, group, n_selected, variables (as text, best first)."""
    told = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.coalesce(-F.col("combined_score"), F.lit(float("inf"))).alias("s"), "variable"))), lambda x: x["variable"]), ", ")
    return sets.join(scores, "variable").groupBy("feature_set", "group").agg(F.count("*").alias("n_selected"), told.alias("variables"))


def candidate_feature_metadata(sets: DataFrame, metadata: DataFrame) -> DataFrame:
    """Each set's variables with what is declared of them."""
    return sets.join(F.broadcast(metadata), "variable", "left")


def excluded_variables(quality: DataFrame, removed: DataFrame) -> DataFrame:
    """variable, exclusion_reason, a row a variable: what quality_metrics says against it, and only then that it goes with another.

    removed: variable, kept; of several kept ones the first by name is told.
    """
    failed = quality.where("exclusion_reason is not null").select("variable", "exclusion_reason", F.lit(1).alias("__k"))
    alike = removed.select("variable", F.concat(F.lit("Correlated with "), "kept").alias("exclusion_reason"), F.lit(2).alias("__k"))
    w = Window.partitionBy("variable").orderBy("__k", "exclusion_reason")
    return failed.unionByName(alike).withColumn("__i", F.row_number().over(w)).where("__i = 1").select("variable", "exclusion_reason")


def selected_variables(order: DataFrame, metadata: DataFrame) -> DataFrame:
    """order (variable, selection_order) with what is declared of each variable; undeclared ones stay."""
    return with_metadata(order.select("variable", "selection_order"), metadata)


def distinguishing_variables(associations: DataFrame, metadata: DataFrame) -> DataFrame:
    """Variables whose effect could be measured, with label and role, ranked by effect, then name."""
    known = associations.where("association is not null").select("variable", "measure", F.col("association").alias("effect_size"))
    told = known.join(F.broadcast(metadata.select("variable", "label", "role")), "variable", "left")  # a row a variable
    return told.withColumn("effect_rank", F.row_number().over(Window.orderBy(F.col("effect_size").desc(), "variable")))


# ---- distances and models ----


def best_distance(quality: DataFrame) -> DataFrame:
    """quality: feature_set, distance_method, k, average_silhouette, ... -> the best k of each set and distance, with silhouette_rank among a set's distances (ties share the lower rank)."""
    first = Window.partitionBy("feature_set", "distance_method").orderBy(F.col("average_silhouette").desc_nulls_last(), "k")
    best = quality.withColumn("__i", F.row_number().over(first)).where("__i = 1").drop("__i")
    return best.withColumn("silhouette_rank", F.rank().over(Window.partitionBy("feature_set").orderBy(F.col("average_silhouette").desc_nulls_last())))


def distance_method_summary(best: DataFrame, distribution: DataFrame) -> DataFrame:
    """One row per distance: means over feature sets of the best models and of the distances' distribution, wins and overall_rank."""
    joined = best.join(distribution.select("feature_set", "distance_method", "coefficient_of_variation", "relative_contrast"), ["feature_set", "distance_method"], "left")
    mean = lambda c, name: F.avg(c).alias(name)
    one = joined.groupBy("distance_method").agg(
        F.count("*").alias("feature_sets_evaluated"), mean("average_silhouette", "mean_best_silhouette"), F.median("average_silhouette").alias("median_best_silhouette"), mean("balance", "mean_balance_score"), mean("minimum_share", "mean_minimum_cluster_share"),
        mean("coefficient_of_variation", "mean_distance_cv"), mean("relative_contrast", "mean_relative_contrast"), F.count_if(F.col("silhouette_rank") == 1).alias("wins_by_silhouette"),
    )
    return one.withColumn("overall_rank", F.rank().over(Window.orderBy(F.col("mean_best_silhouette").desc_nulls_last())))


def model_comparison_summary(ranked: DataFrame, *keys: str) -> DataFrame:
    """One row per method (and whatever keys name): means of the model metrics, and how many models have clusters of acceptable size."""
    mean = lambda c, name: F.avg(c).alias(name)
    return ranked.groupBy(*keys).agg(F.count("*").alias("models_evaluated"), mean("average_silhouette", "mean_silhouette"), F.max("average_silhouette").alias("maximum_silhouette"), mean("balance", "mean_balance_score"), mean("minimum_share", "mean_minimum_cluster_share"), mean("between_ratio", "mean_between_ss_ratio"), mean("composite_score", "mean_composite_score"), F.count_if("acceptable_size").alias("acceptable_size_models"))


def validation_summary(validated: DataFrame, *keys: str) -> DataFrame:
    """One row per method: the greatest Jaccard is the greatest, not the mean again."""
    mean = lambda c, name: F.avg(c).alias(name)
    return validated.groupBy(*keys).agg(F.count("*").alias("models_validated"), mean("average_jaccard", "mean_jaccard"), F.max("average_jaccard").alias("maximum_jaccard"), F.count_if("stable_model").alias("stable_models"), mean("gap", "mean_gap"), mean("validation_score", "mean_validation_score"), F.count_if(F.col("shortlist_status") == "Shortlist").alias("shortlist_models"))


def model_profiles(assignments: DataFrame, scaled: DataFrame, columns: list[str], key: str) -> DataFrame:
    """model_id, cluster, variable, cluster_size, standardised_mean: each model's clusters on columns that are scaled already. Reads respondents, once for all models."""
    by = assignments.join(scaled.select(key, *columns), key).groupBy("model_id", "cluster").agg(F.count("*").alias("n"), *[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    return profiles_of(by, {c: F.col(c) for c in columns})


def profiles_of(by: DataFrame, means: dict[str, Column]) -> DataFrame:
    """model_profiles from a row per cluster: its size n, and how each variable's mean is told."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col("n").alias("cluster_size"), m.alias("standardised_mean")) for c, m in means.items()]))
    return by.select("model_id", "cluster", each.alias("v")).select("model_id", "cluster", "v.*")


def model_distinctness(profiles: DataFrame) -> DataFrame:
    """model_id with the mean, median and greatest range of standardised means over variables, and the mean greatest deviation."""
    by = profiles.groupBy("model_id", "variable").agg((F.max("standardised_mean") - F.min("standardised_mean")).alias("r"), F.max(F.abs("standardised_mean")).alias("d"))
    return by.groupBy("model_id").agg(F.avg("r").alias("mean_standardised_range"), F.median("r").alias("median_standardised_range"), F.max("r").alias("maximum_standardised_range"), F.avg("d").alias("mean_maximum_absolute_deviation"))


def model_associations(assignments: DataFrame, df: DataFrame, categorical: list[str], key: str) -> DataFrame:
    """model_id, variable, cramers_v: how each model's clusters go with profiling variables. Reads respondents, once for all models."""
    rows = assignments.join(df.select(key, *categorical), key).select("model_id", "cluster", F.lit(1).cast("long").alias("n"), *categorical)
    return associations_of(rows, {c: F.col(c) for c in categorical})


def associations_of(rows: DataFrame, levels: dict[str, Column]) -> DataFrame:
    """model_associations from model_id, cluster, n (as how many rows a row counts) and how each variable's level is told."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), x.cast("string").alias("level")) for c, x in levels.items()]))
    cell = rows.select("model_id", "cluster", "n", each.alias("v")).select("model_id", "cluster", "n", "v.*").where("level is not null").groupBy("model_id", "variable", "cluster", "level").agg(F.sum("n").alias("o"))
    over = lambda *c: F.sum("o").over(Window.partitionBy("model_id", "variable", *c))
    cell = cell.select("*", over("cluster").alias("r"), over("level").alias("c"), over().alias("t"))
    one = cell.groupBy("model_id", "variable").agg(F.first("t").alias("n"), F.sum(F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))).alias("s"), F.least(F.countDistinct("cluster"), F.countDistinct("level")).alias("least"))
    return one.select("model_id", "variable", F.when(F.col("least") > 1, F.sqrt(F.greatest(F.col("s") - 1, F.lit(0.0)) / (F.col("least") - 1))).alias("cramers_v"))


def model_association_summary(associations: DataFrame, most: int = 10) -> DataFrame:
    """model_id with the mean and the greatest of its `most` strongest associations."""
    w = Window.partitionBy("model_id").orderBy(F.col("cramers_v").desc_nulls_last(), "variable")
    top = associations.withColumn("__i", F.row_number().over(w)).where(F.col("__i") <= most)
    return top.groupBy("model_id").agg(F.avg("cramers_v").alias("mean_profiling_association"), F.max("cramers_v").alias("maximum_profiling_association"))


def mean_ari(pairwise: DataFrame) -> DataFrame:
    """model_id with its mean and least agreement with the other models."""
    return pairwise.where(F.col("model_1") != F.col("model_2")).groupBy(F.col("model_1").alias("model_id")).agg(F.avg("adjusted_rand_index").alias("mean_ari_with_other_candidates"), F.min("adjusted_rand_index").alias("minimum_ari_with_other_candidates"))


def candidate_summary(candidates: DataFrame, distinctness: DataFrame, association: DataFrame, agreement: DataFrame) -> DataFrame:
    """Candidates with their distinctness, association and agreement; mean_range and mean_association are what the final score takes."""
    out = candidates.join(distinctness, "model_id", "left").join(association, "model_id", "left").join(agreement, "model_id", "left")
    return out.withColumn("mean_range", F.col("mean_standardised_range")).withColumn("mean_association", F.coalesce("mean_profiling_association", F.lit(0.0)))


# ---- segments ----


def with_metadata(table: DataFrame, metadata: DataFrame) -> DataFrame:
    """A table by variable with the variables' label, group, type and description, where declared."""
    return table.join(F.broadcast(metadata.select("variable", *[c for c in ("label", "group", "data_type", "description") if c in metadata.columns])), "variable", "left")


def named_sizes(sizes: DataFrame, names: DataFrame | None) -> DataFrame:
    """sizes with each segment's working_name from names, if sizes has none and names knows any; else sizes as they are."""
    if "working_name" in sizes.columns or "segment" not in sizes.columns or names is None or not {"segment", "working_name"} <= set(names.columns) or names.isEmpty():
        return sizes
    return sizes.join(F.broadcast(names.select("segment", "working_name").distinct()), "segment", "left")  # a row a segment


def persona_table(sizes: DataFrame, narratives: DataFrame, recommendations: DataFrame) -> DataFrame:
    """A row for each segment's size: its narrative, if that tells of the same segment, name, number and share, and what is recommended for segment and name."""
    return sizes.join(narratives, ["segment", "working_name", "n", "share_pct"], "left").join(recommendations, ["segment", "working_name"], "left")


#: Column of the chosen model -> how the summary names it.
MODEL_ITEMS = {
    "model_id": "Final model ID", "feature_set": "Feature set", "feature_count": "Feature count", "method": "Method", "distance": "Distance method", "k": "Number of segments", "validation_score": "Validation score",
    "average_jaccard": "Mean Jaccard stability", "average_silhouette": "Average silhouette", "minimum_share": "Minimum cluster share", "balance": "Balance score", "mean_range": "Mean profile distinctness",
    "mean_association": "Mean profiling association", "mean_ari_with_other_candidates": "Mean ARI with other candidates", "final_score": "Profile comparison score",
}


def final_model_summary(final: DataFrame) -> DataFrame:
    """item, value (as text; measures with six decimals) of the selected model, for whichever of MODEL_ITEMS it has."""
    kinds = dict(final.dtypes)
    told = {c: F.format_string("%.6f", F.col(c)) if kinds[c] in ("double", "float") else F.col(c).cast("string") for c in MODEL_ITEMS if c in kinds}
    rows = F.array(*[F.struct(F.lit(MODEL_ITEMS[c]).alias("item"), F.when(F.col(c).isNotNull(), v).alias("value")) for c, v in told.items()])
    return final.where("selected").select(F.explode(rows).alias("v")).select("v.*")


def segment_overview(sizes: DataFrame, names: DataFrame, characteristics: DataFrame, interventions: DataFrame) -> DataFrame:
    """One row per segment: size, name, narrative, characteristics, priority and message, as far as known."""
    return sizes.join(names, "segment", "left").join(characteristics, "segment", "left").join(interventions, "segment", "left")


def report_rows(numeric: DataFrame, categorical: DataFrame, most_numeric: int = 8, most_levels: int = 12) -> tuple[DataFrame, DataFrame]:
    """The rows that a segment's page shows: its strongest means, and its commonest levels."""
    top = profile.top_per_group(numeric, "segment", F.abs("standardised_mean").desc_nulls_last(), most_numeric, "variable")
    keyed = categorical.withColumn("__v", F.concat_ws(" ", "variable", "level"))
    return top, profile.top_per_group(keyed, "segment", F.col("within_segment_share").desc(), most_levels, "__v").drop("__v")


def normalised(table: DataFrame, columns: list[str]) -> DataFrame:
    """table (one row per variable or model) with each column scaled to 0..1 as <column>_score."""
    return table.select("*", *[stats.normalise(F.col(c), Window.partitionBy()).alias(f"{c}_score") for c in columns])
