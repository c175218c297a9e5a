"""Registered queries of the summary and report tables, with their SQL. catalog.queries() takes them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica import config
from cohortica.operators import allpairs, audit, distance, features, numbering, profile, rules, selection, spreads, summaries, validity
from cohortica.plans import catalog as c
from cohortica.plans.catalog import CATEGORICAL, GROUPS, NUMERIC, query, respondents, rounded

# what is declared of each variable: type, label
TYPES = {v: "ordinal" if v == "n_orders" else "numeric" for v in NUMERIC} | {"nation": "categorical", "channel": "categorical", "urgent": "binary"}
_DECLARED_ROWS = [(v, v.replace("_", " "), "segmentation", GROUPS[v], TYPES[v], True, v == "n_orders", v != "balance") for v in NUMERIC] + [(v, v, "profiling", "context", TYPES[v], False, True, True) for v in CATEGORICAL] + [("respondent_id", "id", "metadata", "key", "identifier", False, False, False)]
_DECLARED_COLUMNS = "variable string, label string, role string, group string, data_type string, include_segmentation boolean, include_profiling boolean, allow_missing boolean"


def _values(rows: list[tuple], columns: str, name: str) -> str:
    told = lambda v: "NULL" if v is None else "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else f"{v}::BIGINT" if isinstance(v, int) else f"{v}::DOUBLE"
    return f"{name} AS (SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(told, r)) + ")" for r in rows) + ") AS t(" + ", ".join(f'"{x.split()[0]}"' for x in columns.split(", ")) + "))"


def _items(pairs: dict[str, str], of: str) -> str:
    return f"SELECT unnest([{', '.join(repr(k) for k in pairs)}]) AS item, unnest([{', '.join(f'CAST({v} AS DOUBLE)' for v in pairs.values())}]) AS value FROM {of}"


_DECLARED = _values(_DECLARED_ROWS, _DECLARED_COLUMNS, "md")
_ALL = [*NUMERIC, *CATEGORICAL]
#: A dictionary with types, beside the counts of what was observed.
_TYPED = f"""{c._COUNTS}, {_DECLARED}, dt AS (SELECT md.*, n_missing, pct_missing, n_unique, n_missing + n_non_missing AS n_rows,
CASE WHEN NOT allow_missing AND n_missing > 0 THEN 'Unexpected missing values' WHEN pct_missing >= 50 THEN 'High missingness' WHEN pct_missing > 0 THEN 'Missing values present' ELSE 'Complete' END AS missingness_status FROM md LEFT JOIN c USING (variable))"""


def _declared(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_DECLARED_ROWS, _DECLARED_COLUMNS)


def _counts(spark: SparkSession, sf: str) -> DataFrame:
    return audit.variable_counts(respondents(spark, sf), _ALL)


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    declared = _declared(spark)
    return audit.dictionary(declared.drop("label", "data_type"), _counts(spark, sf)).join(declared.select("variable", "label", "data_type"), "variable")


# ---- variables ----


@query(f"""WITH {c._COUNTS}, {c._SUMMARY}, {_DECLARED} SELECT variable, label, role, "group", data_type AS configured_type, CASE WHEN variable_type = 'numeric' THEN 'double' ELSE 'string' END AS observed_type, n_missing, round(pct_missing, 2) AS pct_missing, n_unique, minimum, maximum FROM md JOIN c USING (variable) LEFT JOIN s USING (variable)""")
def configured_vs_observed(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.configured_vs_observed(respondents(spark, sf).select(*_ALL), _declared(spark)))


def _register_roles() -> None:
    for role in config.ROLES:
        sql = f"""WITH {_TYPED} SELECT variable, label, "group", data_type, n_missing, round(pct_missing, 5) AS pct_missing, n_unique FROM dt WHERE role = '{role}'"""
        query(sql, f"dictionary_{role}")(lambda spark, sf, role=role: rounded(summaries.with_role(_typed(spark, sf), role).select("variable", "label", "group", "data_type", "n_missing", "pct_missing", "n_unique")))


_register_roles()


@query(f"WITH {_TYPED}, {c._SUMMARY} SELECT variable, label, data_type, n_unique, minimum, first_quartile, median, mean, third_quartile, maximum, standard_deviation FROM dt JOIN s USING (variable)")
def dictionary_numeric(spark: SparkSession, sf: str) -> DataFrame:
    out = summaries.numeric_dictionary(_typed(spark, sf), audit.numeric_summary(respondents(spark, sf), NUMERIC))
    return rounded(out.select("variable", "label", "data_type", "n_unique", "minimum", "first_quartile", "median", "mean", "third_quartile", "maximum", "standard_deviation"))


@query(f"WITH {_TYPED} " + _items({
    "Rows in dataset": "max(n_rows)", "Variables in dataset": "count(n_rows)", "Variables in metadata": "count(role)", "Matched variables": "count(*) FILTER (n_rows IS NOT NULL)", "Metadata variables": "count(*) FILTER (role = 'metadata')",
    "Segmentation variables": "count(*) FILTER (include_segmentation)", "Profiling variables": "count(*) FILTER (include_profiling)", "Categorical variables": "count(*) FILTER (data_type = 'categorical')", "Ordinal variables": "count(*) FILTER (data_type = 'ordinal')",
    "Binary variables": "count(*) FILTER (data_type = 'binary')", "Numeric variables": "count(*) FILTER (data_type = 'numeric')", "Text variables": "count(*) FILTER (data_type = 'text')",
    "Variables with missing values": "count(*) FILTER (n_missing > 0)", "Variables with unexpected missing values": "count(*) FILTER (missingness_status = 'Unexpected missing values')",
}, "dt"))
def dictionary_counters(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.dictionary_summary(_typed(spark, sf), _counts(spark, sf))


@query(f"WITH {_TYPED} " + _items({
    "Rows": "max(n_rows)", "Columns": "count(n_rows)", "Configured variables": "count(role)", "Segmentation candidates": "count(*) FILTER (include_segmentation)",
    "Segmentation variables retained": "count(*) FILTER (include_segmentation AND pct_missing <= 40 AND n_unique > 1)", "Profiling variables": "count(*) FILTER (include_profiling)", "Metadata variables": "count(*) FILTER (role = 'metadata')",
    "Binary variables": "count(*) FILTER (data_type = 'binary')", "Ordinal variables": "count(*) FILTER (data_type = 'ordinal')", "High-missingness exclusions": "count(*) FILTER (include_segmentation AND pct_missing > 40)", "Zero-variance exclusions": "count(*) FILTER (include_segmentation AND n_unique <= 1)",
}, "dt"))
def preprocessing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.preprocessing_summary(_counts(spark, sf), _typed(spark, sf))


@query(f"WITH {c._FILLED}, pv AS (SELECT 1 AS component, (1 + abs(corr(balance, spend))) / 2 AS cumulative FROM f UNION ALL SELECT 2, 1.0) SELECT share::DOUBLE AS share, (SELECT CAST(min(component) AS BIGINT) FROM pv WHERE cumulative >= share - 1e-12) AS components FROM (VALUES (0.5), (0.7), (0.8)) AS s(share)")
def components_for_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Of two variables, since SQL can tell their eigenvalues: 1 and more or less their correlation. exploratory_summary does it for all."""
    return summaries.components_for(features.pca_variance(c.filled(spark, sf), ["balance", "spend"]))


@query()
def exploratory_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Its components come from an eigenvalue decomposition, its models from a grid: no SQL."""
    filled = c.filled(spark, sf)
    quality = features.quality_metrics(respondents(spark, sf), NUMERIC)
    best = summaries.best_of_kind(c._given_models(spark, sf))
    components = summaries.components_for(features.pca_variance(filled, NUMERIC))
    return rounded(summaries.exploratory_summary(filled.count(), quality, features.high_correlations(features.correlation_pairs(filled, NUMERIC)), components, best, config.SETTINGS.sample_rows))


@query("""WITH x AS (SELECT 'n_components' AS variable, CAST(len(embedding) AS DOUBLE) AS value FROM embeddings UNION ALL SELECT 'label', label FROM embeddings)
SELECT * FROM (SELECT variable, count(DISTINCT value) AS n_unique, round(stddev_samp(value), 5) AS standard_deviation FROM x GROUP BY variable) WHERE n_unique <= 1 OR standard_deviation IS NULL OR standard_deviation = 0""")
def low_variance(spark: SparkSession, sf: str) -> DataFrame:
    """Among what is known of all vectors, which all have as many components."""
    known = spark.read.parquet(f"{sf}/embeddings.parquet").select(F.size("embedding").alias("n_components"), "label")
    return rounded(summaries.low_variance(features.quality_metrics(known, ["n_components", "label"])).select("variable", "n_unique", "standard_deviation"))


@query("""WITH d AS (SELECT quality, toxic, n_chars FROM documents LEFT JOIN labels USING (doc_id)), x AS (SELECT 'quality' AS variable, CAST(quality AS DOUBLE) AS value FROM d UNION ALL SELECT 'toxic', toxic FROM d UNION ALL SELECT 'n_chars', n_chars FROM d)
SELECT * FROM (SELECT variable, count(*) - count(value) AS n_missing, round(100.0::DOUBLE * (count(*) - count(value)) / count(*), 5) AS pct_missing FROM x GROUP BY variable) WHERE pct_missing >= 50""")
def high_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Among what is known of all documents, of which few are rated."""
    rated = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    return rounded(summaries.high_missing(audit.variable_counts(rated, ["quality", "toxic", "n_chars"])).select("variable", "n_missing", "pct_missing"))


#: Feature sets: the best so many variables by score.
_SIZES = (2, 3, 5)
_SCORED = f"""{c._METRICS_SQL}, u AS (SELECT *, {c._norm('pca_importance')} AS a, {c._norm('entropy')} AS b, {c._norm('ln(1 + n_unique)')} AS d FROM t), sc AS (SELECT variable, "group", 0.5 * a + 0.2 * b + 0.2 * stability_score + 0.1 * d AS combined_score, "group" = 'wealth' AS force_keep FROM u),
ork AS (SELECT variable, row_number() OVER (ORDER BY combined_score DESC NULLS LAST, variable) AS i FROM sc), fs AS (SELECT 'set_' || size AS feature_set, variable FROM ork, (VALUES {', '.join(f'({k})' for k in _SIZES)}) AS z(size) WHERE i <= size)"""


def _scored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    scores = c._feature_scores(spark, sf)
    of = F.filter(F.array(*[F.lit(k) for k in _SIZES]), lambda k: F.col("overall_rank") <= k)
    sets = scores.select("variable", F.explode(of).alias("size")).select(F.concat(F.lit("set_"), F.col("size").cast("string")).alias("feature_set"), "variable")
    return sets, scores.select("variable", "group", "combined_score", (F.col("group") == "wealth").alias("force_keep"))


@query(f"""WITH {_SCORED} SELECT feature_set, count(*) AS feature_count, count(DISTINCT "group") AS groups_represented, round(avg(combined_score), 5) AS mean_combined_score, round(min(combined_score), 5) AS minimum_combined_score, count(*) FILTER (force_keep) AS forced_keep_features FROM fs JOIN sc USING (variable) GROUP BY feature_set""")
def feature_set_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.feature_set_summary(*_scored(spark, sf)))


@query(f"""WITH {_SCORED} SELECT feature_set, "group", count(*) AS n_selected, string_agg(variable, ', ' ORDER BY combined_score DESC NULLS LAST, variable) AS variables FROM fs JOIN sc USING (variable) GROUP BY ALL""")
def selected_by_group(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.selected_by_group(*_scored(spark, sf)))


@query(f"""WITH {_SCORED} SELECT feature_set, variable, "group", round(combined_score, 5) AS combined_score FROM fs LEFT JOIN sc USING (variable)""")
def candidate_feature_metadata(spark: SparkSession, sf: str) -> DataFrame:
    sets, scores = _scored(spark, sf)
    return rounded(summaries.candidate_feature_metadata(sets, scores.drop("force_keep")))


# ---- distances and models ----

#: Feature sets whose distances are compared, and the given segmentations that they are judged by.
_DISTANCE_SETS = {"all": NUMERIC, "orders": ["n_orders", "spend", "mean_order"]}
_JUDGES = {"band": "CASE WHEN spend >= 1500000 THEN 'high' WHEN spend >= 1000000 THEN 'middle' ELSE 'low' END", "urgency": "urgent"}


def _distance_sql() -> str:
    of_set = lambda cols, m: " + ".join(f"abs(x.{v} - y.{v})" + (f" / w.{v}" if m == "gower" else "") for v in cols)
    whole = {(f, m): f"({of_set(cols, m)})" + (f" / {len(cols)}" if m == "gower" else "") for f, cols in _DISTANCE_SETS.items() for m in ("manhattan", "gower")}
    ranges = ", ".join(f"max({v}) - min({v}) AS {v}" for v in NUMERIC)
    return f"""{c._SCALED}, w AS (SELECT {ranges} FROM z), jl AS (SELECT respondent_id, {', '.join(f'{e} AS {m}' for m, e in _JUDGES.items())} FROM r), zj AS (SELECT * FROM z JOIN jl USING (respondent_id)),
dp AS MATERIALIZED (SELECT x.respondent_id AS i, y.respondent_id AS o, {', '.join(f'x.{m} AS x_{m}, y.{m} AS y_{m}' for m in _JUDGES)}, {', '.join(f'{d} AS {f}_{m}' for (f, m), d in whole.items())} FROM zj AS x JOIN zj AS y ON x.respondent_id <> y.respondent_id, w),
dl AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature_set, '{m}' AS distance_method, '{j}' AS judge, i, x_{j} AS own, y_{j} AS theirs, avg({f}_{m}) AS m FROM dp GROUP BY ALL" for f, m in whole for j in _JUDGES)}),
dab AS (SELECT feature_set, distance_method, judge, i, max(m) FILTER (own = theirs) AS a, min(m) FILTER (own <> theirs) AS b FROM dl GROUP BY ALL), dsi AS (SELECT feature_set, distance_method, judge, avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS average_silhouette FROM dab GROUP BY ALL),
dn AS (SELECT judge, cluster, count(*) AS n FROM ({' UNION ALL '.join(f"SELECT '{j}' AS judge, {j} AS cluster FROM jl" for j in _JUDGES)}) GROUP BY ALL), dz AS (SELECT judge, count(*) AS k, 1 - (max(n) - min(n)) / sum(n)::DOUBLE AS balance, min(n) / sum(n)::DOUBLE AS minimum_share FROM dn GROUP BY judge),
dq AS (SELECT feature_set, distance_method, k, average_silhouette, balance, minimum_share FROM dsi JOIN dz USING (judge)),
ds AS ({' UNION ALL '.join(f"SELECT '{f}' AS feature_set, '{m}' AS distance_method, stddev_samp({f}_{m}) / avg({f}_{m}) AS coefficient_of_variation, (max({f}_{m}) - min({f}_{m})) / max({f}_{m}) AS relative_contrast FROM dp WHERE i < o" for f, m in whole)})"""


_BEST = f"""{_distance_sql()}, b1 AS (SELECT *, row_number() OVER (PARTITION BY feature_set, distance_method ORDER BY average_silhouette DESC, k) AS i FROM dq),
bd AS (SELECT * EXCLUDE (i), rank() OVER (PARTITION BY feature_set ORDER BY average_silhouette DESC) AS silhouette_rank FROM b1 WHERE i = 1)"""


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled respondents with the segmentations that judge a distance, fixed as it is read often."""
    return c.given(spark, sf).select("respondent_id", *NUMERIC, *_JUDGES)


def _best(spark: SparkSession, d: DataFrame) -> DataFrame:
    measures = [(f, m, j) for f in _DISTANCE_SETS for m in ("manhattan", "gower") for j in _JUDGES]
    own = validity.average_silhouettes(d, "respondent_id", [(_DISTANCE_SETS[f], m, j) for f, m, j in measures])  # one sorting for all
    of = lambda i: F.lit([x[i] for x in measures])[F.col("measure")]
    own = own.select(of(0).alias("feature_set"), of(1).alias("distance_method"), of(2).alias("model_id"), "average_silhouette")
    n = c.given_moments(d, list(_JUDGES)).select("model_id", "cluster", "n")
    sizes = validity.sizes_of(n, "model_id").select("model_id", F.col("n_clusters").alias("k"), "balance", "minimum_share")
    made = own.join(F.broadcast(sizes), "model_id").select("feature_set", "distance_method", "k", "average_silhouette", "balance", "minimum_share")  # a row a measure
    return summaries.best_distance(numbering.checkpointed(made))


@query(f"WITH {_BEST} SELECT * REPLACE (round(average_silhouette, 5) AS average_silhouette, round(balance, 5) AS balance, round(minimum_share, 5) AS minimum_share) FROM bd")
def best_distance(spark: SparkSession, sf: str) -> DataFrame:
    """Which of the given segmentations each distance over each feature set shows best, over all respondents."""
    return rounded(_best(spark, _judged(spark, sf)))


@query(f"""WITH {_BEST}, su AS (SELECT distance_method, count(*) AS feature_sets_evaluated, {c._r('avg(average_silhouette) AS mean_best_silhouette', 'median(average_silhouette) AS median_best_silhouette', 'avg(balance) AS mean_balance_score', 'avg(minimum_share) AS mean_minimum_cluster_share', 'avg(coefficient_of_variation) AS mean_distance_cv', 'avg(relative_contrast) AS mean_relative_contrast')}, count(*) FILTER (silhouette_rank = 1) AS wins_by_silhouette FROM bd LEFT JOIN ds USING (feature_set, distance_method) GROUP BY distance_method)
SELECT *, rank() OVER (ORDER BY mean_best_silhouette DESC) AS overall_rank FROM su""")
def distance_method_summary(spark: SparkSession, sf: str) -> DataFrame:
    d = _judged(spark, sf)
    judged = [(f, m) for f in _DISTANCE_SETS for m in ("manhattan", "gower")]
    found = spreads.spreads(d, "respondent_id", [(m, _DISTANCE_SETS[f]) for f, m in judged])
    rows = [(f, m, s["coefficient_of_variation"], s["relative_contrast"]) for (f, m), s in zip(judged, found, strict=True)]
    told = spark.createDataFrame(rows, "feature_set string, distance_method string, coefficient_of_variation double, relative_contrast double")
    return rounded(summaries.distance_method_summary(_best(spark, d), told))


@query(f"WITH {c._V}, p AS (SELECT {c._D['euclidean']} AS euclidean, {c._D['manhattan']} AS manhattan, {c._D['gower']} AS gower FROM v AS a JOIN v AS b ON a.id < b.id) " + " UNION ALL ".join(f"SELECT '{a}' AS method_1, '{b}' AS method_2, round(corr({a}, {b}), 5) AS pearson, count(*) AS n_pairs FROM p" for a, b in (("euclidean", "gower"), ("euclidean", "manhattan"), ("gower", "manhattan"))))
def distance_pearson(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson's coefficient of every two distances over all pairs, from one table of pairs."""
    v, names = c._vectors(spark, sf)
    return rounded(allpairs.correlations(v, "id", names, distance.METHODS))


@query(f"WITH {c._RANKED} SELECT method, count(*) AS models_evaluated, {c._r('avg(average_silhouette) AS mean_silhouette', 'max(average_silhouette) AS maximum_silhouette', 'avg(balance) AS mean_balance_score', 'avg(minimum_share) AS mean_minimum_cluster_share', 'avg(between_ratio) AS mean_between_ss_ratio', 'avg(composite_score) AS mean_composite_score')}, count(*) FILTER (acceptable_size) AS acceptable_size_models FROM mr GROUP BY method")
def model_comparison_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.model_comparison_summary(c._ranked(spark, sf), "method"))


@query(f"WITH {c._VALIDATED} SELECT method, count(*) AS models_validated, {c._r('avg(average_jaccard) AS mean_jaccard', 'max(average_jaccard) AS maximum_jaccard', 'avg(gap) AS mean_gap', 'avg(validation_score) AS mean_validation_score')}, count(*) FILTER (stable_model) AS stable_models, count(*) FILTER (shortlist_status = 'Shortlist') AS shortlist_models FROM vr GROUP BY method")
def validation_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.validation_summary(c._validated(spark, sf), "method"))


@query(f"WITH {c._RANKED}, b AS (SELECT *, row_number() OVER (PARTITION BY method ORDER BY average_silhouette DESC, k) AS i FROM mr) SELECT method, k, round(average_silhouette, 5) AS average_silhouette FROM b WHERE i = 1")
def best_of_kind(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.best_of_kind(c._ranked(spark, sf)))


# three segmentations of all respondents: by market segment, by what they spend, and by urgency
_BAND = "CASE WHEN spend >= 1500000 THEN 'high' WHEN spend >= 1000000 THEN 'middle' ELSE 'low' END"
_ASSIGNED = f"a AS (SELECT respondent_id, 'market' AS model_id, segment AS cluster FROM r UNION ALL SELECT respondent_id, 'band', {_BAND} FROM r UNION ALL SELECT respondent_id, 'urgency', urgent FROM r)"
_DISTINCT = f"""{c._SCALED}, {_ASSIGNED}, lz AS ({c._unpivot(NUMERIC, 'respondent_id', of='z')}), mp AS (SELECT model_id, cluster, variable, count(*) AS cluster_size, avg(value) AS standardised_mean FROM a JOIN lz USING (respondent_id) GROUP BY ALL),
mv AS (SELECT model_id, variable, max(standardised_mean) - min(standardised_mean) AS g, max(abs(standardised_mean)) AS d FROM mp GROUP BY ALL), dis AS (SELECT model_id, avg(g) AS mean_standardised_range, median(g) AS median_standardised_range, max(g) AS maximum_standardised_range, avg(d) AS mean_maximum_absolute_deviation FROM mv GROUP BY model_id)"""
_ASSOCIATED = f"""{_ASSIGNED}, lc AS ({c._unpivot(CATEGORICAL, 'respondent_id', text=True)}), ce AS (SELECT model_id, variable, cluster, value, count(*) AS o FROM a JOIN lc USING (respondent_id) WHERE value IS NOT NULL GROUP BY ALL),
cm AS (SELECT *, sum(o) OVER (PARTITION BY model_id, variable, cluster) AS rs, sum(o) OVER (PARTITION BY model_id, variable, value) AS cs FROM ce), av AS (SELECT model_id, variable, sqrt(greatest(sum(o::DOUBLE * o / (rs::DOUBLE * cs)) - 1, 0) / (least(count(DISTINCT cluster), count(DISTINCT value)) - 1)) AS cramers_v FROM cm GROUP BY ALL),
aso AS (SELECT model_id, avg(cramers_v) AS mean_profiling_association, max(cramers_v) AS maximum_profiling_association FROM av GROUP BY model_id)"""
_AGREED = f"""{_ASSIGNED}, ct AS (SELECT x.model_id AS m1, y.model_id AS m2, x.cluster AS p, y.cluster AS q, count(*) AS n FROM a AS x JOIN a AS y USING (respondent_id) WHERE x.model_id <> y.model_id GROUP BY ALL),
c1 AS (SELECT m1, m2, sum(n) AS n, sum(n * (n - 1) / 2.0) AS cells FROM ct GROUP BY ALL), c2 AS (SELECT m1, m2, sum(n * (n - 1) / 2.0) AS pr FROM (SELECT m1, m2, p, sum(n) AS n FROM ct GROUP BY ALL) GROUP BY ALL), c3 AS (SELECT m1, m2, sum(n * (n - 1) / 2.0) AS qr FROM (SELECT m1, m2, q, sum(n) AS n FROM ct GROUP BY ALL) GROUP BY ALL),
ai AS (SELECT m1, (cells - pr * qr / (n * (n - 1) / 2.0)) / ((pr + qr) / 2.0 - pr * qr / (n * (n - 1) / 2.0)) AS ari FROM c1 JOIN c2 USING (m1, m2) JOIN c3 USING (m1, m2)), agr AS (SELECT m1 AS model_id, avg(ari) AS mean_ari_with_other_candidates, min(ari) AS minimum_ari_with_other_candidates FROM ai GROUP BY m1)"""


_COMPARED_MODELS = ["market", "band", "urgency"]


def _model_profiles(d: DataFrame) -> DataFrame:
    return c.given_profiles(c.given_moments(d, _COMPARED_MODELS))


def _associations(d: DataFrame) -> DataFrame:
    return c.given_associations(d, _COMPARED_MODELS)


def _agreement(d: DataFrame) -> DataFrame:
    return summaries.mean_ari(validity.adjusted_rand_of_columns(d, _COMPARED_MODELS))


@query(f"WITH {_DISTINCT} SELECT model_id, cluster, variable, cluster_size, round(standardised_mean, 5) AS standardised_mean FROM mp")
def model_profiles(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_model_profiles(c.given(spark, sf)))


@query(f"WITH {_DISTINCT} SELECT model_id, {c._r('mean_standardised_range AS mean_standardised_range', 'median_standardised_range AS median_standardised_range', 'maximum_standardised_range AS maximum_standardised_range', 'mean_maximum_absolute_deviation AS mean_maximum_absolute_deviation')} FROM dis")
def model_distinctness(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.model_distinctness(_model_profiles(c.given(spark, sf))))


@query(f"WITH {_ASSOCIATED} SELECT model_id, {c._r('mean_profiling_association AS mean_profiling_association', 'maximum_profiling_association AS maximum_profiling_association')} FROM aso")
def model_association(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.model_association_summary(_associations(c.given(spark, sf))))


@query(f"WITH {_AGREED} SELECT model_id, {c._r('mean_ari_with_other_candidates AS mean_ari_with_other_candidates', 'minimum_ari_with_other_candidates AS minimum_ari_with_other_candidates')} FROM agr")
def mean_ari(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_agreement(c.given(spark, sf)))


#: The validated models whose clusters are compared with those of others.
_COMPARED = f"ca AS (WITH {c._VALIDATED} SELECT model_id, validation_score, balance FROM vr WHERE model_id IN (SELECT model_id FROM agr))"


@query(f"""WITH {_DISTINCT}, {_ASSOCIATED.partition('), ')[2]}, {_AGREED.partition('), ')[2]}, {_COMPARED}, su AS (SELECT * FROM ca LEFT JOIN dis USING (model_id) LEFT JOIN aso USING (model_id) LEFT JOIN agr USING (model_id)),
fi AS (SELECT *, 0.45 * {c._norm('validation_score')} + 0.3 * {c._norm('mean_standardised_range')} + 0.15 * {c._norm('mean_profiling_association')} + 0.1 * {c._norm('balance')} AS final_score FROM su)
SELECT model_id, {c._r('mean_standardised_range AS mean_standardised_range', 'mean_profiling_association AS mean_profiling_association', 'mean_ari_with_other_candidates AS mean_ari_with_other_candidates', 'final_score AS final_score')}, row_number() OVER (ORDER BY final_score DESC, model_id) AS final_rank, row_number() OVER (ORDER BY final_score DESC, model_id) = 1 AS selected FROM fi""")
def candidate_profile_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The final score from the models' validation and what their clusters really show on all respondents."""
    d = c.given(spark, sf)
    agreement = numbering.checkpointed(_agreement(d))  # a row a model
    candidates = c._validated(spark, sf, d).join(agreement.select("model_id"), "model_id", "semi").select("model_id", "validation_score", "balance")
    made = summaries.candidate_summary(candidates, summaries.model_distinctness(_model_profiles(d)), summaries.model_association_summary(_associations(d)), agreement)
    return rounded(selection.final_model(made).select("model_id", "mean_standardised_range", "mean_profiling_association", "mean_ari_with_other_candidates", "final_score", "final_rank", "selected"))


# ---- segments ----


@query(f"""WITH {c._PROFILE}, {_DECLARED} SELECT segment, variable, n, round(standardised_mean, 5) AS standardised_mean, label, "group", data_type FROM pf LEFT JOIN md USING (variable)""")
def segment_profile_labelled(spark: SparkSession, sf: str) -> DataFrame:
    out = summaries.with_metadata(c._profile(spark, sf).select("segment", "variable", "n", "standardised_mean"), _declared(spark))
    return rounded(out)


# positions of the market segments; what they spend stands for trust
_PLACED = f"{c._WIDE}, po AS (SELECT segment, {c._NAME} AS working_name, {', '.join(f'{c._LEVEL(d)} AS {n}' for n, d in (('readiness', 'readiness'), ('confidence', 'confidence'), ('barriers', 'barriers'), ('trust', 'engagement')))} FROM st)"
_TONE = "CASE WHEN trust = 'Low' THEN 'Open, with evidence' WHEN confidence = 'Low' THEN 'Encouraging, without blame' WHEN readiness = 'High' THEN 'Decisive' ELSE 'Even and informative' END AS tone, CASE WHEN readiness = 'Low' THEN 'Pressing for action' WHEN confidence = 'Low' THEN 'Hints at failing' WHEN barriers = 'High' THEN 'Passing over cost, time or effort' WHEN trust = 'Low' THEN 'Claims without proof' ELSE 'The same words for everyone' END AS avoid"


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    level = lambda d, n: rules.classify_level(F.col(d), cut=0.02).alias(n)
    return c._named(spark, sf).select("segment", "working_name", level("readiness", "readiness"), level("confidence", "confidence"), level("barriers", "barriers"), level("engagement", "trust"))


@query(f"""WITH {_PLACED} SELECT segment, working_name, CASE WHEN readiness = 'High' THEN 'Short and direct, with the least effort asked' WHEN confidence = 'Low' THEN 'Guided, with support at each step' WHEN barriers = 'High' THEN 'Practical, with the obstacles taken first' ELSE 'Flexible, fitted to the person' END AS delivery_style,
CASE WHEN confidence = 'Low' AND barriers = 'High' THEN 'High' WHEN readiness = 'High' THEN 'Low to moderate' ELSE 'Moderate' END AS support_intensity, CASE WHEN readiness = 'High' THEN 'Begin today' WHEN confidence = 'Low' THEN 'Try one step with help' WHEN barriers = 'High' THEN 'See an easier way' ELSE 'Find out more' END AS call_to_action, {_TONE} FROM po""")
def interventions(spark: SparkSession, sf: str) -> DataFrame:
    return rules.interventions(_positions(spark, sf))


_HIERARCHY = "unnest([1, 2, 3])::BIGINT AS message_rank, unnest(['Main', 'Support', 'Doubts']) AS message_type, unnest([CASE readiness WHEN 'High' THEN 'You are set to begin' WHEN 'Low' THEN 'There is no hurry' ELSE 'A small start is enough' END, CASE confidence WHEN 'Low' THEN 'We go with you at each step' WHEN 'High' THEN 'You know how to do this' ELSE 'You can learn as you go' END, CASE barriers WHEN 'High' THEN 'We take care of cost and effort' ELSE 'It fits in with what you do already' END]) AS message"


@query(f"WITH {_PLACED} SELECT segment, working_name, {_HIERARCHY} FROM po")
def message_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.message_hierarchy(_positions(spark, sf)))


@query(f"WITH {_PLACED} SELECT segment, working_name, {_HIERARCHY}, {_TONE} FROM po")
def message_framework(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.message_framework(_positions(spark, sf)))


@query(f"""WITH {_PLACED} SELECT segment, chr(8220) || CASE WHEN readiness = 'High' AND confidence = 'High' THEN 'Tell me the next step and I will take it.' WHEN confidence = 'Low' THEN 'I would like to, if someone shows me that I can.' WHEN barriers = 'High' THEN 'It costs me too much time and money as things are.' ELSE 'I may change if it suits my life.' END || chr(8221) AS persona_quote FROM po""")
def persona_quote(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(spark, sf).select("segment", rules.quote(F.col("readiness"), F.col("confidence"), F.col("barriers")).alias("persona_quote"))


_STRATEGIES = _values(rules.STRATEGY, rules.STRATEGY_COLUMNS, "sy")


query(f"WITH {c._WIDE}, {_STRATEGIES}, na AS (SELECT segment, {c._NAME} AS working_name FROM st) SELECT * FROM na LEFT JOIN sy USING (working_name)")(c.strategy)


@query(f"""WITH {_PLACED}, {_STRATEGIES}, pr AS (SELECT segment, {c._BAND} AS priority FROM (SELECT *, {c._SCORE} AS s FROM st)) SELECT segment, unnest(range(1, 7)) AS action_rank, unnest(['Brief the team: ' || core_problem, 'Prepare the offer: ' || service, 'Prepare the message: ' || message, 'Open the channel: ' || channel, 'Support the first step: ' || call_to_action, 'Review at priority ' || lower(priority)]) AS action FROM po LEFT JOIN sy USING (working_name) LEFT JOIN pr USING (segment)""")
def segment_actions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.segment_actions(rules.strategy(_positions(spark, sf).select("segment", "working_name")), c._prioritised(spark, sf)))


@query(f"""WITH {_PLACED}, {_STRATEGIES} SELECT segment, unnest(range(1, 5)) AS kpi_rank, unnest(['Reach by ' || lower(channel), 'Response to: ' || message, 'Starts of ' || lower(service), 'Objective met: ' || objective]) AS kpi FROM po LEFT JOIN sy USING (working_name)""")
def segment_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.segment_kpis(rules.strategy(_positions(spark, sf).select("segment", "working_name"))))


@query(f"""WITH {c._WIDE}, na AS (SELECT segment, {c._NAME} AS working_name FROM st), sc AS (SELECT segment, {c._SCORE} AS s FROM st), tr AS (SELECT segment, CASE WHEN standardised_mean >= 0 THEN 'higher ' ELSE 'lower ' END || variable AS t, row_number() OVER (PARTITION BY segment ORDER BY abs(standardised_mean) DESC NULLS LAST, variable) AS k FROM pf),
ch AS (SELECT segment, string_agg(t, '; ' ORDER BY k) AS key_characteristics FROM tr WHERE k <= 4 GROUP BY segment) SELECT sz.segment, sz.n, sz.share_pct, working_name, key_characteristics, {c._BAND} AS priority FROM sz LEFT JOIN na USING (segment) LEFT JOIN ch USING (segment) LEFT JOIN sc USING (segment)""")
def segment_overview(spark: SparkSession, sf: str) -> DataFrame:
    d = respondents(spark, sf)
    sizes = profile.segment_sizes(d)
    told = rules.persona(sizes, profile.segment_profile(d, NUMERIC), profile.categorical_profile(d, CATEGORICAL)).select("segment", "key_characteristics")
    out = summaries.segment_overview(sizes, c._named(spark, sf).select("segment", "working_name"), told, c._prioritised(spark, sf).select("segment", "priority"))
    return rounded(out.select("segment", "n", "share_pct", "working_name", "key_characteristics", "priority"))


@query(f"WITH {c._PROFILE}, k AS (SELECT segment, variable, standardised_mean, row_number() OVER (PARTITION BY segment ORDER BY abs(standardised_mean) DESC NULLS LAST, variable) AS rank FROM pf) SELECT segment, rank, variable, round(standardised_mean, 5) AS standardised_mean FROM k WHERE rank <= 8")
def report_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """A segment's strongest 8 means: a top-k report."""
    d = respondents(spark, sf)
    return rounded(summaries.report_rows(profile.segment_profile(d, NUMERIC), profile.categorical_profile(d, CATEGORICAL))[0].select("segment", "rank", "variable", "standardised_mean"))


@query(f"WITH {c._CATEGORICAL}, k AS (SELECT segment, variable, level, n, row_number() OVER (PARTITION BY segment ORDER BY n / segment_total::DOUBLE DESC, variable || ' ' || level) AS rank FROM cp) SELECT segment, rank, variable, level, n FROM k WHERE rank <= 12")
def report_levels(spark: SparkSession, sf: str) -> DataFrame:
    """A segment's 12 commonest levels: a top-k report."""
    d = respondents(spark, sf)
    return rounded(summaries.report_rows(profile.segment_profile(d, NUMERIC), profile.categorical_profile(d, CATEGORICAL))[1].select("segment", "rank", "variable", "level", "n"))


# ---- joins of stages ----


@query(f"""WITH {c._COUNTS}, {_DECLARED} SELECT variable, n_missing, round(pct_missing, 5) AS pct_missing, label, "group", data_type FROM c LEFT JOIN md USING (variable)""")
def missingness_described(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.with_metadata(audit.missingness(respondents(spark, sf), _ALL), _declared(spark)).select("variable", "n_missing", "pct_missing", "label", "group", "data_type"))


@query(f"""WITH {_DECLARED}, v AS (SELECT * FROM ({c._unpivot(NUMERIC)}) WHERE value IS NOT NULL) SELECT variable, count(*) AS n, round(avg(value), 5) AS mean, round(stddev_samp(value), 5) AS standard_deviation, any_value(label) AS label, any_value("group") AS "group", any_value(data_type) AS data_type FROM v LEFT JOIN md USING (variable) GROUP BY variable""")
def distribution_described(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(summaries.with_metadata(audit.distribution(respondents(spark, sf), NUMERIC).select("variable", "n", "mean", "standard_deviation"), _declared(spark)))


@query(f"WITH {c._WIDE} SELECT segment, n, share_pct, {c._NAME} AS working_name FROM st")
def named_sizes(spark: SparkSession, sf: str) -> DataFrame:
    sizes = profile.segment_sizes(respondents(spark, sf)).select("segment", "n", "share_pct")
    return rounded(summaries.named_sizes(sizes, c._named(spark, sf)).select("segment", "n", "share_pct", "working_name"))


@query(f"""WITH {_PLACED}, {_STRATEGIES}, nr AS (SELECT segment, {c._NAME} AS working_name, n, share_pct, 'Readiness is ' || lower({c._LEVEL('readiness')}) AS told FROM st WHERE readiness >= 0)
SELECT st.segment, po.working_name, st.n, st.share_pct, told, objective, channel FROM st JOIN po USING (segment) LEFT JOIN nr ON nr.segment = st.segment AND nr.working_name = po.working_name AND nr.n = st.n AND nr.share_pct = st.share_pct LEFT JOIN sy ON sy.working_name = po.working_name""")
def persona_table(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes with narratives by segment, name, number and share, and with strategies by segment and name; a narrative is only told of the ready."""
    d = c._named(spark, sf)
    told = d.where("readiness >= 0").select("segment", "working_name", "n", "share_pct", F.concat(F.lit("Readiness is "), F.lower(rules.classify_level(F.col("readiness"), cut=0.02))).alias("told"))
    recommended = rules.strategy(d.select("segment", "working_name")).select("segment", "working_name", "objective", "channel")
    return rounded(summaries.persona_table(d.select("segment", "working_name", "n", "share_pct"), told, recommended))


_FINAL = {"Final model ID": "model_id", "Feature set": "feature_set", "Method": "method", "Number of segments": "CAST(k AS VARCHAR)"} | {n: f"printf('%.6f', {e})" for n, e in (("Validation score", "validation_score"), ("Mean Jaccard stability", "average_jaccard"), ("Average silhouette", "average_silhouette"), ("Minimum cluster share", "minimum_share"), ("Balance score", "balance"), ("Mean profile distinctness", "mean_range"), ("Mean profiling association", "mean_association"), ("Profile comparison score", "final_score"))}


@query(f"WITH {c._CANDIDATES} SELECT unnest([{', '.join(repr(n) for n in _FINAL)}]) AS item, unnest([{', '.join(_FINAL.values())}]) AS value FROM (SELECT * FROM fs ORDER BY final_score DESC NULLS LAST, model_id LIMIT 1)")
def final_model_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summaries.final_model_summary(selection.final_model(selection.candidates(c._validated(spark, sf))))
