"""Registered queries of the segmentation engine, each with DuckDB SQL where SQL can say the same.

The respondent table is each customer with what their orders say; a segment is
a customer's market segment. Results are rounded, so that sums in another order
of rows agree.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats
from cohortica.operators import allpairs, audit, clean, cluster, distance, features, linkage, numbering, profile, rules, selection, summaries, validity
from cohortica.streaming import behaviour

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

NUMERIC = ["balance", "n_orders", "spend", "mean_order", "largest_order"]
CATEGORICAL = ["nation", "channel", "urgent"]
GROUPS = {"balance": "wealth", "n_orders": "activity", "spend": "activity", "mean_order": "value", "largest_order": "value"}

_RESPONDENTS = """
r0 AS (SELECT c_custkey AS respondent_id, any_value(c_mktsegment) AS segment, any_value(CAST(c_nationkey AS VARCHAR)) AS nation, any_value(c_acctbal) AS acctbal,
  CAST(count(o_orderkey) AS DOUBLE) AS n_orders, round(sum(o_totalprice), 4) AS spend, round(sum(o_totalprice), 4) / nullif(count(o_totalprice), 0) AS mean_order, max(o_totalprice) AS largest_order,
  min(o_orderpriority) AS channel, CASE WHEN count(*) FILTER (o_orderpriority = '1-URGENT') > 1 THEN 'Yes' ELSE 'no' END AS urgent
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey),
r AS (SELECT respondent_id, segment, nation, CASE WHEN acctbal >= 0 THEN acctbal END AS balance, n_orders, spend, mean_order, largest_order, channel, urgent FROM r0)"""


def respondents(spark: SparkSession, sf: str) -> DataFrame:
    """respondent_id, segment, nation, balance (null if negative), n_orders, spend, mean_order, largest_order, channel, urgent.

    spend is rounded to four digits, below what prices have, and mean_order follows from it: sums in another order of
    orders differ in their last bits, which would make different values of equal ones and decide ties.
    """
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_mktsegment", "c_nationkey", "c_acctbal")
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_totalprice", "o_orderpriority")
    spend = F.round(F.sum("o_totalprice"), 4)
    # orders are summed before the join: it moves one row per customer
    by = o.groupBy("o_custkey").agg(F.count("*").cast("double").alias("n"), spend.alias("spend"), F.try_divide(spend, F.count("o_totalprice").cast("double")).alias("mean_order"), F.max("o_totalprice").alias("largest_order"), F.min("o_orderpriority").alias("channel"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"))
    return c.join(by, c["c_custkey"] == by["o_custkey"], "left").select(
        F.col("c_custkey").alias("respondent_id"), F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.coalesce("n", F.lit(0.0)).alias("n_orders"), "spend", "mean_order", "largest_order", "channel", F.when(F.col("u") > 1, "Yes").otherwise("no").alias("urgent"),
    )


def rounded(df: DataFrame, digits: int = 5) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c).cast("long").alias(c) if t in ("int", "smallint") else F.col(c) for c, t in df.dtypes])


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name. sql: a SELECT over the tables and r, the respondents."""

    def add(f: Query) -> Query:
        key = name or f.__name__
        _QUERIES[key] = f
        if sql:
            body = sql.strip()
            _SQL[key] = f"WITH {_RESPONDENTS.strip()}" + (f",\n{body[5:]}" if body.upper().startswith("WITH ") else f"\n{body}")
        return f

    return add


def queries() -> dict[str, Query]:
    from cohortica.plans import preparation, reports  # noqa: F401  they register their queries here

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from cohortica.plans import preparation, reports  # noqa: F401

    return dict(_SQL)


def _r(*exprs: str) -> str:
    return ", ".join(f"round({e.rpartition(' AS ')[0]}, 5) AS {e.rpartition(' AS ')[2]}" for e in exprs)


def _unpivot(cols: list[str], keep: str = "", text: bool = False, of: str = "r") -> str:
    k = f"{keep}, " if keep else ""
    cast = "VARCHAR" if text else "DOUBLE"
    return " UNION ALL ".join(f"SELECT {k}'{c}' AS variable, CAST({c} AS {cast}) AS value FROM {of}" for c in cols)


# ---- audit ----

_COUNTS = f"""
x AS ({_unpivot([*NUMERIC, *CATEGORICAL], text=True)}),
c AS (SELECT variable, CASE WHEN variable IN ({', '.join(repr(v) for v in NUMERIC)}) THEN 'numeric' ELSE 'character' END AS variable_type, count(*) - count(value) AS n_missing,
  100.0::DOUBLE * (count(*) - count(value)) / count(*) AS pct_missing, count(value) AS n_non_missing, count(DISTINCT value) AS n_unique, 100.0::DOUBLE * count(DISTINCT value) / nullif(count(value), 0) AS pct_unique_non_missing FROM x GROUP BY variable)"""
_SUMMARY = f"""
v AS ({_unpivot(NUMERIC)}),
s AS (SELECT variable, {_r('min(value) AS minimum', 'quantile_cont(value, 0.25) AS first_quartile', 'median(value) AS median', 'avg(value) AS mean', 'quantile_cont(value, 0.75) AS third_quartile', 'max(value) AS maximum', 'stddev_samp(value) AS standard_deviation')} FROM v GROUP BY variable)"""
_ROLE = """CASE WHEN regexp_matches(lower(variable), '(^id$|_id$|^id_|respondent|participant|transaction|case_number)') THEN 'Potential identifier'
  WHEN pct_unique_non_missing >= 95 AND n_unique > 20 THEN 'Potential identifier' WHEN pct_missing >= 50 THEN 'High-missingness variable'
  WHEN variable_type = 'numeric' AND n_unique = 2 THEN 'Binary numeric' WHEN variable_type = 'numeric' AND n_unique <= 10 THEN 'Ordinal or categorical numeric' WHEN variable_type = 'numeric' THEN 'Continuous numeric'
  WHEN n_unique = 2 THEN 'Binary categorical' WHEN n_unique <= 20 THEN 'Categorical' ELSE 'High-cardinality categorical' END"""


@query(f"WITH {_COUNTS}, {_SUMMARY} SELECT c.variable, variable_type, n_missing, round(pct_missing, 5) AS pct_missing, n_non_missing, n_unique, round(pct_unique_non_missing, 5) AS pct_unique_non_missing, n_unique <= 1 AS constant_variable, {_ROLE} AS suggested_role, minimum, first_quartile, median, mean, third_quartile, maximum, standard_deviation FROM c LEFT JOIN s USING (variable)")
def variable_audit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.variable_audit(respondents(spark, sf), [*NUMERIC, *CATEGORICAL]))


@query(f"WITH {_SUMMARY} SELECT * FROM s")
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.numeric_summary(respondents(spark, sf), NUMERIC))


@query(f"WITH {_COUNTS} SELECT variable, {_ROLE} AS suggested_role FROM c")
def variable_role(spark: SparkSession, sf: str) -> DataFrame:
    c = audit.variable_counts(respondents(spark, sf), [*NUMERIC, *CATEGORICAL])
    return c.select("variable", audit.role_of(F.col("variable"), F.col("variable_type"), F.col("n_unique"), F.col("pct_unique_non_missing"), F.col("pct_missing")).alias("suggested_role"))


@query("""WITH t AS (SELECT event_type, user_id FROM events), g AS (SELECT *, count(*) AS n FROM t GROUP BY ALL)
SELECT unnest(['rows', 'columns', 'missing_values', 'missing_pct', 'duplicate_rows']) AS metric, unnest([sum(n), 2, 0, 0, sum(n - 1)])::DOUBLE AS value FROM g""")
def dataset_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dataset_summary(spark.read.parquet(f"{sf}/events.parquet").select("event_type", "user_id"))


@query("""WITH n AS (SELECT variable, value AS level, count(*) AS n FROM (SELECT 'nation' AS variable, nation AS value FROM r UNION ALL SELECT 'channel', channel FROM r UNION ALL SELECT 'urgent', urgent FROM r) GROUP BY ALL)
SELECT variable, level, n, round(100.0::DOUBLE * n / sum(n) OVER (PARTITION BY variable), 5) AS pct FROM n""")
def level_audit(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.level_audit(respondents(spark, sf), CATEGORICAL))


@query("SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1")
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return audit.duplicate_rows(spark.read.parquet(f"{sf}/events.parquet"), ["user_id", "event_type"])


@query("""WITH d AS (SELECT quality, toxic, n_chars FROM documents LEFT JOIN labels USING (doc_id)),
x AS (SELECT 'quality' AS variable, CAST(quality AS DOUBLE) AS value FROM d UNION ALL SELECT 'toxic', toxic FROM d UNION ALL SELECT 'n_chars', n_chars FROM d)
SELECT variable, count(*) - count(value) AS n_missing, count(*) AS n_rows, round(100.0::DOUBLE * (count(*) - count(value)) / count(*), 5) AS pct_missing FROM x GROUP BY variable""")
def missingness(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left")
    return rounded(audit.missingness(d, ["quality", "toxic", "n_chars"]))


@query("""WITH x AS (SELECT 'urgent' AS variable, urgent AS value FROM r UNION ALL SELECT 'channel', channel FROM r), b AS (SELECT variable, value, CASE WHEN lower(trim(value)) IN ('yes', 'y', 'true', '1', 'selected') THEN 1 WHEN lower(trim(value)) IN ('no', 'n', 'false', '0', 'not selected') THEN 0 END AS b FROM x)
SELECT variable, count(*) FILTER (b = 0) AS n_zero, count(*) FILTER (b = 1) AS n_one, count(*) - count(value) AS n_missing, count(*) FILTER (value IS NOT NULL AND b IS NULL) AS n_unrecognised FROM b GROUP BY variable""")
def binary_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.binary_summary(respondents(spark, sf), ["urgent", "channel"])


@query("""SELECT 'p_size' AS variable, 5.0::DOUBLE AS scale_minimum, 45.0::DOUBLE AS scale_maximum, count(*) FILTER (p_size < 5) AS n_below, count(*) FILTER (p_size > 45) AS n_above, count(*) FILTER (p_size < 5 OR p_size > 45) AS n_invalid FROM part""")
def ordinal_validation(spark: SparkSession, sf: str) -> DataFrame:
    return audit.ordinal_validation(spark.read.parquet(f"{sf}/part.parquet"), {"p_size": "5-45"})


def _metadata(spark: SparkSession) -> DataFrame:
    rows = [(c, "segmentation", GROUPS[c], True, c == "n_orders", c != "balance") for c in NUMERIC] + [(c, "profiling", "context", False, True, True) for c in CATEGORICAL]
    return spark.createDataFrame(rows, "variable string, role string, group string, include_segmentation boolean, include_profiling boolean, allow_missing boolean")


_METADATA = "m AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', 'segmentation', '{GROUPS[c]}', true, {str(c == 'n_orders').lower()}, {str(c != 'balance').lower()})" for c in NUMERIC) + ", " + ", ".join(f"('{c}', 'profiling', 'context', false, true, true)" for c in CATEGORICAL) + ') AS t(variable, role, "group", include_segmentation, include_profiling, allow_missing))'
_DICTIONARY = f"""{_COUNTS}, {_METADATA}, d AS (SELECT m.*, n_missing, pct_missing, n_unique, CASE WHEN NOT allow_missing AND n_missing > 0 THEN 'Unexpected missing values' WHEN pct_missing >= 50 THEN 'High missingness' WHEN pct_missing > 0 THEN 'Missing values present' ELSE 'Complete' END AS missingness_status,
  CASE WHEN include_segmentation AND include_profiling THEN 'Segmentation and profiling' WHEN include_segmentation THEN 'Segmentation' WHEN include_profiling THEN 'Profiling' ELSE 'Not included in analysis' END AS inclusion_status FROM m LEFT JOIN c USING (variable))"""


def _dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dictionary(_metadata(spark), audit.variable_counts(respondents(spark, sf), [*NUMERIC, *CATEGORICAL]))


@query(f"WITH {_DICTIONARY} SELECT * REPLACE (round(pct_missing, 5) AS pct_missing) FROM d")
def dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_dictionary(spark, sf))


@query(f"""WITH {_DICTIONARY} SELECT role, "group", count(*) AS n_variables, count(*) FILTER (include_segmentation) AS n_segmentation, count(*) FILTER (include_profiling) AS n_profiling, round(avg(pct_missing), 5) AS mean_missing_pct FROM d GROUP BY ALL""")
def group_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.group_summary(_dictionary(spark, sf)))


@query(f"""WITH {_DICTIONARY} SELECT unnest(['variables', 'role_metadata', 'role_segmentation', 'role_profiling', 'segmentation', 'profiling', 'with_missing', 'unexpected_missing']) AS metric,
unnest([count(*), count(*) FILTER (role = 'metadata'), count(*) FILTER (role = 'segmentation'), count(*) FILTER (role = 'profiling'), count(*) FILTER (include_segmentation), count(*) FILTER (include_profiling), count(*) FILTER (n_missing > 0), count(*) FILTER (missingness_status = 'Unexpected missing values')]) AS value FROM d""")
def dictionary_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.dictionary_summary(_dictionary(spark, sf))


@query("""WITH a AS (SELECT DISTINCT source AS variable FROM documents), b AS (SELECT 'src' || (n_nationkey) AS variable FROM nation)
SELECT coalesce(a.variable, b.variable) AS variable, CASE WHEN a.variable IS NOT NULL AND b.variable IS NOT NULL THEN 'Matched' WHEN a.variable IS NOT NULL THEN 'Declared only' ELSE 'Observed only' END AS status FROM a FULL JOIN b USING (variable)""")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    a = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("source").alias("variable"))
    b = spark.read.parquet(f"{sf}/nation.parquet").select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("variable"))
    return audit.reconcile(a, b)


# ---- cleaning ----


@query("""SELECT conv_id, turn, CASE WHEN t NOT IN ('', 'NA', 'N/A', 'n/a', 'NULL', 'null', 'Missing', 'missing', 'Not stated', 'Prefer not to say') THEN t END AS text
FROM (SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS t FROM conversations)""")
def missing_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", clean.missing_tokens(F.col("text")).alias("text"))


@query("SELECT respondent_id, CAST(CASE lower(urgent) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS BIGINT) AS urgent FROM r")
def convert_binary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(respondents(spark, sf).select("respondent_id", clean.convert_binary(F.col("urgent")).alias("urgent")))


@query("SELECT respondent_id, round(coalesce(balance, (SELECT median(balance) FROM r)), 5) AS balance FROM r")
def median_impute(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(clean.median_impute(respondents(spark, sf).select("respondent_id", "balance"), ["balance"]))


_Z = ", ".join(f"round((f.{c} - avg(f.{c}) OVER ()) / stddev_samp(f.{c}) OVER (), 5) AS {c}" for c in NUMERIC)
_FILLED = "f AS (SELECT respondent_id, segment, " + ", ".join(f"coalesce({c}, (SELECT median({c}) FROM r), 0) AS {c}" for c in NUMERIC) + " FROM r)"
_SCALED = f"{_FILLED}, z AS (SELECT respondent_id, segment, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in NUMERIC) + " FROM f)"


def filled(spark: SparkSession, sf: str) -> DataFrame:
    return clean.median_impute(respondents(spark, sf).select("respondent_id", "segment", *NUMERIC), NUMERIC)


def scaled(spark: SparkSession, sf: str) -> DataFrame:
    return clean.standardise(filled(spark, sf), NUMERIC)


@query(f"WITH {_FILLED} SELECT respondent_id, {_Z} FROM f")
def standardise(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(scaled(spark, sf).drop("segment"))


_SHARES = f"""n AS (SELECT variable, value, count(*) AS n FROM ({_unpivot([*NUMERIC, *CATEGORICAL], text=True)}) WHERE value IS NOT NULL GROUP BY ALL),
p AS (SELECT variable, n / sum(n) OVER (PARTITION BY variable)::DOUBLE AS p FROM n),
e AS (SELECT variable, CASE WHEN count(*) = 1 THEN 0.0 ELSE sum(-p * ln(p)) / ln(count(*)) END AS entropy, count(*) AS n_levels FROM p GROUP BY variable)"""


@query(f"WITH {_SHARES} SELECT variable, round(entropy, 5) AS entropy, n_levels FROM e")
def entropy(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.entropy(respondents(spark, sf), [*NUMERIC, *CATEGORICAL]))


@query(f"""WITH {_SHARES}, v AS (SELECT * FROM ({_unpivot(NUMERIC)}) WHERE value IS NOT NULL),
b AS (SELECT variable, avg(value) AS mean, stddev_samp(value) AS sd FROM v GROUP BY variable),
k AS (SELECT variable, count(*) AS n, any_value(mean) AS mean, any_value(sd) AS sd, median(value) AS median, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr, avg(((value - mean) / sd) ** 3) AS skewness, avg(((value - mean) / sd) ** 4) - 3 AS kurtosis FROM v JOIN b USING (variable) GROUP BY variable)
SELECT variable, n, {_r('mean AS mean', 'sd AS standard_deviation', 'median AS median', 'iqr AS iqr', 'skewness AS skewness', 'kurtosis AS kurtosis', 'entropy AS entropy')}, n_levels FROM k JOIN e USING (variable)""")
def distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(audit.distribution(respondents(spark, sf), NUMERIC))


# ---- features ----

_QUALITY = f"""{_COUNTS}, {_SHARES}, {_SUMMARY}, q AS (SELECT c.variable, n_missing, pct_missing, n_unique, standard_deviation, entropy, pct_missing <= 40 AS missingness_pass, n_unique >= 2 AS uniqueness_pass, coalesce(standard_deviation > 1e-8, false) AS variance_pass FROM c JOIN s USING (variable) LEFT JOIN e USING (variable))"""


@query(f"""WITH {_QUALITY} SELECT variable, n_missing, {_r('pct_missing AS pct_missing', 'standard_deviation AS standard_deviation', 'entropy AS entropy')}, n_unique, missingness_pass, uniqueness_pass, variance_pass, missingness_pass AND uniqueness_pass AND variance_pass AS initial_pass,
CASE WHEN NOT missingness_pass THEN 'Missingness above threshold' WHEN NOT uniqueness_pass THEN 'Insufficient unique values' WHEN NOT variance_pass THEN 'Zero or near-zero variance' END AS exclusion_reason FROM q""")
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.quality_metrics(respondents(spark, sf), NUMERIC))


@query(f"WITH {_COUNTS} SELECT variable, round(pct_missing, 5) AS pct_missing, n_unique, pct_missing <= 40 AND n_unique > 1 AS retained FROM c")
def screen_features(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.screen_features(respondents(spark, sf), [*NUMERIC, *CATEGORICAL]))


_PAIRS = " UNION ALL ".join(f"SELECT '{min(a, b)}' AS variable_1, '{max(a, b)}' AS variable_2, corr({a}, {b}) AS correlation FROM f" for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :])


@query(f"WITH {_FILLED}, c AS ({_PAIRS}) SELECT variable_1, variable_2, round(correlation, 5) AS correlation, round(abs(correlation), 5) AS absolute_correlation FROM c")
def correlation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.correlation_pairs(filled(spark, sf), NUMERIC))


@query(f"WITH {_FILLED}, c AS ({_PAIRS}) SELECT variable_1, variable_2, round(correlation, 5) AS correlation, round(abs(correlation), 5) AS absolute_correlation FROM c WHERE abs(correlation) >= 0.3")
def high_correlations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(features.high_correlations(features.correlation_pairs(filled(spark, sf), NUMERIC), 0.3))


@query()
def pca_variance(spark: SparkSession, sf: str) -> DataFrame:
    return features.pca_variance(filled(spark, sf), NUMERIC)


@query()
def pca_loadings(spark: SparkSession, sf: str) -> DataFrame:
    return features.pca_loadings(filled(spark, sf), NUMERIC)


@query()
def pca_importance(spark: SparkSession, sf: str) -> DataFrame:
    values = features.pca_importance(features.gramian(filled(spark, sf), NUMERIC)[2])
    return spark.createDataFrame([(c, float(v)) for c, v in zip(NUMERIC, values, strict=True)], "variable string, pca_importance double")


@query()
def redundancy(spark: SparkSession, sf: str) -> DataFrame:
    """Which variables go for correlating at 0.3 or more, and for which they go."""
    q = {r["variable"]: r.asDict() for r in features.quality_metrics(respondents(spark, sf), NUMERIC).collect()}
    pairs = features.high_correlations(features.correlation_pairs(filled(spark, sf), NUMERIC), 0.3).collect()
    gone = features.remove_redundant(q, GROUPS, [(r["variable_1"], r["variable_2"], r["absolute_correlation"]) for r in pairs])
    return spark.createDataFrame(gone, "removed string, kept string")


@query()
def bootstrap_feature_stability(spark: SparkSession, sf: str) -> DataFrame:
    z = scaled(spark, sf)
    reference = features.pca_importance(features.gramian(z, NUMERIC)[2], scaled=False)
    steady = features.stability(reference, features.bootstrap_importance(z, "respondent_id", NUMERIC))
    return spark.createDataFrame([(c, float(a), float(b)) for c, a, b in zip(NUMERIC, reference, steady, strict=True)], "variable string, pca_importance double, stability_score double")


def _importance_sql(where: str) -> str:
    """Of each variable, the mean size of its correlations with the others."""
    of = lambda v: " + ".join(f"abs(corr({v}, {o}))" for o in NUMERIC if o != v)
    return " UNION ALL ".join(f"SELECT '{v}' AS variable, ({of(v)}) / {len(NUMERIC) - 1} AS importance FROM f WHERE {where}" for v in NUMERIC)


_METRICS_SQL = f"""{_FILLED}, {_SHARES}, i0 AS ({_importance_sql('true')}), i1 AS ({_importance_sql('respondent_id % 2 = 0')}), i2 AS ({_importance_sql('respondent_id % 2 = 1')}),
gr AS (SELECT * FROM (VALUES {', '.join(f"('{v}', '{g}')" for v, g in GROUPS.items())}) AS gr(variable, "group")),
t AS (SELECT variable, "group", i0.importance AS pca_importance, entropy, 1 - abs(i1.importance - i2.importance) AS stability_score, n_levels AS n_unique FROM gr JOIN i0 USING (variable) JOIN i1 USING (variable) JOIN i2 USING (variable) JOIN e USING (variable))"""


def _norm(e: str) -> str:
    return f"CASE WHEN min({e}) OVER () IS NULL THEN 0.0 WHEN max({e}) OVER () = min({e}) OVER () THEN 1.0 ELSE ({e} - min({e}) OVER ()) / (max({e}) OVER () - min({e}) OVER ()) END"


def _feature_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the respondents' variables by measures that SQL can take too: importance is the mean size of a variable's
    correlations with the others, and stability how alike it is among respondents of even and of odd number."""
    def importance(where: str, name: str) -> DataFrame:
        one = filled(spark, sf).where(where).agg(*[(sum(F.abs(F.corr(v, o)) for o in NUMERIC if o != v) / (len(NUMERIC) - 1)).alias(v) for v in NUMERIC])
        return one.unpivot([], NUMERIC, "variable", name)

    groups = spark.createDataFrame(list(GROUPS.items()), "variable string, group string")
    quality = features.quality_metrics(respondents(spark, sf), NUMERIC).select("variable", "entropy", "n_unique")
    halves = importance("respondent_id % 2 = 0", "even").join(importance("respondent_id % 2 = 1", "odd"), "variable")
    measured = groups.join(importance("true", "pca_importance"), "variable").join(quality, "variable").join(halves, "variable")  # a row a variable
    return features.feature_score(measured.select("variable", "group", "pca_importance", "entropy", (1 - F.abs(F.col("even") - F.col("odd"))).alias("stability_score"), F.col("n_unique").cast("long").alias("n_unique")))


@query(f"""WITH {_METRICS_SQL}, u AS (SELECT *, {_norm('pca_importance')} AS pca_score, {_norm('entropy')} AS entropy_score, {_norm('ln(1 + n_unique)')} AS uniqueness_score FROM t),
w AS (SELECT *, 0.5 * pca_score + 0.2 * entropy_score + 0.2 * stability_score + 0.1 * uniqueness_score AS combined_score FROM u)
SELECT variable, "group", n_unique, {_r('pca_importance AS pca_importance', 'entropy AS entropy', 'stability_score AS stability_score', 'pca_score AS pca_score', 'entropy_score AS entropy_score', 'uniqueness_score AS uniqueness_score', 'combined_score AS combined_score')}, row_number() OVER (ORDER BY combined_score DESC NULLS LAST, variable) AS overall_rank FROM w""")
def feature_score(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_feature_scores(spark, sf))


@query()
def feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows = [r.asDict() | {"combined_score": r["combined_score"] or 0.0} for r in _feature_scores(spark, sf).collect()]  # a row a variable
    sets = {k: features.build_feature_set(k, rows) for k in (5, 4, 3)}
    return spark.createDataFrame([(f"set_{k}", v, i + 1) for k, vs in sets.items() for i, v in enumerate(vs)], "feature_set string, variable string, selection_order int")


@query("""WITH s AS (SELECT c_mktsegment AS feature_set, c_nationkey AS "group" FROM customer WHERE c_acctbal > 5000), a AS (SELECT c_nationkey AS "group", count(*) AS n_available FROM customer GROUP BY ALL),
g AS (SELECT feature_set, "group", count(*) AS n_selected FROM s GROUP BY ALL), e AS (SELECT * FROM (SELECT DISTINCT feature_set FROM s) CROSS JOIN a)
SELECT feature_set, CAST(e."group" AS BIGINT) AS "group", coalesce(n_selected, 0) AS n_selected, n_available, round(100.0::DOUBLE * coalesce(n_selected, 0) / n_available, 1) AS retention_pct FROM e LEFT JOIN g USING (feature_set, "group")""")
def group_coverage(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_mktsegment").alias("feature_set"), F.col("c_nationkey").alias("group"), F.col("c_custkey").alias("variable"), "c_acctbal")
    return rounded(features.group_coverage(c.where("c_acctbal > 5000"), c))


# ---- windows, ranks, pivots, joins ----


@query(f"""SELECT respondent_id, {_r(f"{_norm('balance')} AS balance", f"{_norm('spend')} AS spend")} FROM r""")
def normalise(spark: SparkSession, sf: str) -> DataFrame:
    """Min-max scores of rows, by one row of bounds sent to each task."""
    d = respondents(spark, sf).select("respondent_id", "balance", "spend")
    b = F.broadcast(d.agg(*[f(c).alias(f"{n}_{c}") for c in ("balance", "spend") for n, f in (("lo", F.min), ("hi", F.max))]))
    score = lambda c: F.when(F.col(f"lo_{c}").isNull(), 0.0).when(F.col(f"hi_{c}") == F.col(f"lo_{c}"), 1.0).otherwise((F.col(c) - F.col(f"lo_{c}")) / (F.col(f"hi_{c}") - F.col(f"lo_{c}")))
    return rounded(d.join(b).select("respondent_id", score("balance").alias("balance"), score("spend").alias("spend")))


@query("""SELECT segment, respondent_id, round(spend, 5) AS spend, rank FROM (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY spend DESC NULLS LAST, respondent_id) AS rank FROM r) WHERE rank <= 4""")
def topk_per_group(spark: SparkSession, sf: str) -> DataFrame:
    top = profile.top_per_group(respondents(spark, sf), "segment", F.col("spend").desc_nulls_last(), 4, "respondent_id")
    return rounded(top.select("segment", "respondent_id", "spend", "rank"))


@query("""SELECT segment, respondent_id, n_orders, rank FROM (SELECT *, rank() OVER (PARTITION BY segment ORDER BY n_orders DESC NULLS LAST) AS rank FROM r) WHERE rank <= 3""")
def topk_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    top = profile.top_per_group(respondents(spark, sf), "segment", F.col("n_orders").desc_nulls_last(), 3, keep_ties=True)
    return rounded(top.select("segment", "respondent_id", "n_orders", "rank"))


@query("""SELECT segment, respondent_id, rank() OVER w + (count(*) OVER (PARTITION BY segment, n_orders) - 1) / 2.0::DOUBLE AS middle_rank FROM r WINDOW w AS (PARTITION BY segment ORDER BY n_orders)""")
def middle_ranks(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    d = respondents(spark, sf)
    rank = stats.middle_rank(Window.partitionBy("segment").orderBy("n_orders"), Window.partitionBy("segment", "n_orders"))
    return d.select("segment", "respondent_id", rank.cast("double").alias("middle_rank"))


@query(f"""WITH m AS (SELECT variable, segment, avg(value) AS mean FROM ({_unpivot(NUMERIC, 'segment')}) GROUP BY ALL)
SELECT variable, {', '.join(f"round(any_value(mean) FILTER (segment = '{s}'), 5) AS {s.lower()}" for s in ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'))} FROM m GROUP BY variable""")
def profile_wide(spark: SparkSession, sf: str) -> DataFrame:
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    wide = profile.profile_wide(profile.segment_profile(respondents(spark, sf), NUMERIC), names)
    return rounded(wide.withColumnsRenamed({n: n.lower() for n in names}))


@query("""SELECT c_custkey, c_nationkey, n_nationkey AS c_nationkey_profiling, n_name FROM (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer) LEFT JOIN (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name FROM nation) ON c_custkey = n_nationkey""")
def profile_join(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", "c_nationkey")
    n = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").cast("long").alias("c_custkey"), F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rounded(profile.profile_join(c, n, "c_custkey"))


# ---- statistics of segments ----


@query("SELECT segment, count(*) AS n, round(count(*) / sum(count(*)) OVER ()::DOUBLE, 5) AS share, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS share_pct FROM r GROUP BY segment")
def segment_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.segment_sizes(respondents(spark, sf)))


_PROFILE = f"""v AS ({_unpivot(NUMERIC, 'segment')}), o AS (SELECT variable, avg(value) AS overall_mean, stddev_samp(value) AS overall_sd FROM v GROUP BY variable),
g AS (SELECT segment, variable, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd, median(value) AS median, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM v GROUP BY ALL),
pf AS (SELECT g.*, overall_mean, overall_sd, CASE WHEN overall_sd > 0 THEN (mean - overall_mean) / overall_sd ELSE 0.0 END AS standardised_mean FROM g JOIN o USING (variable))"""


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.segment_profile(respondents(spark, sf), NUMERIC)


@query(f"WITH {_PROFILE} SELECT segment, variable, n, {_r(*[f'{c} AS {c}' for c in ('mean', 'sd', 'median', 'iqr', 'overall_mean', 'overall_sd', 'standardised_mean')])} FROM pf")
def segment_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_profile(spark, sf))


@query(f"WITH {_PROFILE} SELECT variable, round(max(standardised_mean) - min(standardised_mean), 5) AS profile_range, round(max(abs(standardised_mean)), 5) AS maximum_absolute FROM pf GROUP BY variable")
def profile_distinctness(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.distinctness(_profile(spark, sf)))


_CATEGORICAL = f"""x AS ({_unpivot(CATEGORICAL, 'segment', text=True)}), n AS (SELECT segment, variable, coalesce(value, 'Missing') AS level, count(*) AS n FROM x GROUP BY ALL),
cp AS (SELECT *, CAST(sum(n) OVER (PARTITION BY segment, variable) AS BIGINT) AS segment_total FROM n)"""


@query(f"WITH {_CATEGORICAL} SELECT segment, variable, level, n, segment_total, round(n / segment_total::DOUBLE, 5) AS within_segment_share, round(100.0::DOUBLE * (n / segment_total::DOUBLE), 1) AS within_segment_pct FROM cp")
def categorical_profile(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.categorical_profile(respondents(spark, sf), CATEGORICAL))


_ETA = f"""v AS (SELECT * FROM ({_unpivot(NUMERIC, 'segment')}) WHERE value IS NOT NULL), o AS (SELECT variable, avg(value) AS m FROM v GROUP BY variable), g AS (SELECT segment, variable, count(*) AS n, avg(value) AS gm FROM v GROUP BY ALL),
t AS (SELECT variable, sum((value - m) ** 2) AS total, sum((value - gm) ** 2) AS within_ss, count(*) AS n, count(DISTINCT segment) AS k FROM v JOIN o USING (variable) JOIN g USING (segment, variable) GROUP BY variable),
eta AS (SELECT variable, t.n, k, total - within_ss AS between_ss, within_ss, (total - within_ss) / total AS eta_squared FROM t)"""


@query(f"WITH {_ETA} SELECT variable, n, k, round(eta_squared, 5) AS eta_squared FROM eta")
def eta_squared(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.eta_squared(respondents(spark, sf), NUMERIC).select("variable", "n", "k", "eta_squared"))


@query(f"WITH {_ETA} SELECT variable, k - 1 AS df_between, n - k AS df_within, round((between_ss / (k - 1)) / (within_ss / (n - k)), 5) AS statistic, round(eta_squared, 5) AS eta_squared FROM eta")
def anova(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.anova(respondents(spark, sf), NUMERIC))


_CHI = f"""x AS (SELECT * FROM ({_unpivot(CATEGORICAL, 'segment', text=True)}) WHERE value IS NOT NULL), o AS (SELECT variable, segment, value, count(*) AS o FROM x GROUP BY ALL),
rt AS (SELECT variable, segment, count(*) AS rn FROM x GROUP BY ALL), ct AS (SELECT variable, value, count(*) AS cn FROM x GROUP BY ALL), tt AS (SELECT variable, count(*) AS n FROM x GROUP BY ALL),
cell AS (SELECT rt.variable, coalesce(o, 0) AS o, rn * cn / n::DOUBLE AS ex, n, rt.segment, ct.value FROM rt JOIN ct USING (variable) JOIN tt USING (variable) LEFT JOIN o ON o.variable = rt.variable AND o.segment = rt.segment AND o.value = ct.value),
chi AS (SELECT variable, any_value(n) AS n, sum((o - ex) ** 2 / ex) AS statistic, (count(DISTINCT segment) - 1) * (count(DISTINCT value) - 1) AS df, least(count(DISTINCT segment), count(DISTINCT value)) - 1 AS m FROM cell GROUP BY variable)"""


@query(f"WITH {_CHI} SELECT variable, n, round(statistic, 5) AS statistic, df, round(sqrt(statistic / (n * m)), 5) AS cramers_v FROM chi")
def chi_square(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.chi_square(respondents(spark, sf), CATEGORICAL))


@query(f"WITH {_CHI} SELECT variable, round(sqrt(statistic / (n * m)), 5) AS cramers_v FROM chi")
def cramers_v(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.chi_square(respondents(spark, sf), CATEGORICAL).select("variable", "cramers_v"))


@query()
def difference_tests(spark: SparkSession, sf: str) -> DataFrame:
    return profile.difference_tests(respondents(spark, sf), NUMERIC, CATEGORICAL)


@query(f"""WITH {_ETA}, {_CHI.replace('x AS', 'xc AS').replace('FROM x', 'FROM xc').replace('o AS (SELECT variable, segment, value', 'oc AS (SELECT variable, segment, value').replace('LEFT JOIN o ON o.variable = rt.variable AND o.segment = rt.segment AND o.value = ct.value', 'LEFT JOIN oc ON oc.variable = rt.variable AND oc.segment = rt.segment AND oc.value = ct.value')},
u AS (SELECT variable, 'eta_squared' AS measure, eta_squared AS association FROM eta UNION ALL SELECT variable, 'cramers_v', sqrt(statistic / (n * m)) FROM chi)
SELECT variable, measure, round(association, 5) AS association, row_number() OVER (ORDER BY association DESC NULLS LAST, variable) AS association_rank FROM u""")
def profiling_associations(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.associations(respondents(spark, sf), NUMERIC, CATEGORICAL))


@query("""WITH q AS (SELECT c_nationkey AS nation, o_orderstatus AS status FROM orders JOIN customer ON o_custkey = c_custkey), w AS (SELECT status, count(*) / sum(count(*)) OVER ()::DOUBLE AS share FROM q GROUP BY status), z AS (SELECT nation, count(*) AS total FROM q GROUP BY nation),
o AS (SELECT nation, status, count(*) AS n FROM q GROUP BY ALL), t AS (SELECT nation, exp(-sum((coalesce(n, 0) - total * share) ** 2 / (total * share)) / 2) AS p_value FROM z CROSS JOIN w LEFT JOIN o USING (nation, status) GROUP BY nation),
k AS (SELECT *, row_number() OVER (ORDER BY p_value) AS i, count(*) OVER () AS m FROM t WHERE p_value IS NOT NULL), a AS (SELECT nation, least(1.0, min(p_value * m / i) OVER (ORDER BY i DESC ROWS UNBOUNDED PRECEDING)) AS adjusted_p_value FROM k)
SELECT CAST(nation AS VARCHAR) AS variable, round(p_value, 5) AS p_value, round(adjusted_p_value, 5) AS adjusted_p_value FROM t LEFT JOIN a USING (nation)""")
def bh_adjust(spark: SparkSession, sf: str) -> DataFrame:
    """Of each nation, whether its orders have the three states in the shares of all orders: chi-square with two degrees of freedom, whose tail is exp(-x / 2)."""
    nations = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").cast("string").alias("variable"))
    counts = spark.read.parquet(f"{sf}/orders.parquet").select("o_custkey", "o_orderstatus").join(nations, "o_custkey").groupBy("variable", "o_orderstatus").agg(F.count("*").alias("n"))
    wide = counts.groupBy("variable").agg(*[F.coalesce(F.sum(F.when(F.col("o_orderstatus") == x, F.col("n"))), F.lit(0)).alias(x) for x in "FOP"])
    every = Window.partitionBy()  # a row a nation
    total = F.col("F") + F.col("O") + F.col("P")
    expected = lambda x: total * F.sum(x).over(every) / F.sum(total).over(every)
    tested = wide.withColumn("statistic", sum(F.pow(F.col(x) - expected(x), 2) / expected(x) for x in "FOP")).select("variable", F.exp(-F.col("statistic") / 2).alias("p_value"))
    return rounded(tested.withColumn("adjusted_p_value", stats.benjamini_hochberg("p_value")))


# ---- validity of given segments ----

_SIZES = "n AS (SELECT segment, count(*) AS n FROM r GROUP BY segment), s AS (SELECT *, n / sum(n) OVER ()::DOUBLE AS share FROM n)"


@query(f"WITH {_SIZES} SELECT count(*) AS n_clusters, min(n) AS minimum_size, max(n) AS maximum_size, {_r('min(share) AS minimum_share', 'max(share) AS maximum_share', 'sum(-share * ln(share)) / ln(count(*)) AS size_entropy', 'max(n) / min(n)::DOUBLE AS size_ratio', '1 - (max(share) - min(share)) AS balance')} FROM s")
def cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.cluster_sizes(respondents(spark, sf), "segment"))


_SS = f"""{_SCALED}, cm AS (SELECT segment, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM z GROUP BY segment),
ss AS (SELECT {' + '.join(f'sum((z.{c} - cm.{c}) ** 2)' for c in NUMERIC)} AS within_ss, {' + '.join(f'sum(z.{c} ** 2) - sum(z.{c}) ** 2 / count(*)' for c in NUMERIC)} AS total_ss, count(*) AS n, count(DISTINCT z.segment) AS k FROM z JOIN cm USING (segment))"""


@query(f"WITH {_SS} SELECT {_r('total_ss AS total_ss', 'within_ss AS within_ss', 'total_ss - within_ss AS between_ss', '(total_ss - within_ss) / total_ss AS between_ratio', '((total_ss - within_ss) / (k - 1)) / (within_ss / (n - k)) AS calinski_harabasz')} FROM ss")
def variance_separation(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.variance_separation(scaled(spark, sf), NUMERIC, "segment"))


@query(f"WITH {_SS} SELECT round(((total_ss - within_ss) / (k - 1)) / (within_ss / (n - k)), 5) AS calinski_harabasz FROM ss")
def calinski_harabasz(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.variance_separation(scaled(spark, sf), NUMERIC, "segment").select("calinski_harabasz"))


_DIST = lambda a, b: "sqrt(" + " + ".join(f"({a}.{c} - {b}.{c}) ** 2" for c in NUMERIC) + ")"


@query(f"""WITH {_SS}, sp AS (SELECT z.segment, avg({_DIST('z', 'cm')}) AS s FROM z JOIN cm USING (segment) GROUP BY z.segment), a AS (SELECT * FROM cm JOIN sp USING (segment)),
w AS (SELECT x.segment, max((x.s + y.s) / {_DIST('x', 'y')}) AS m FROM a AS x JOIN a AS y ON x.segment <> y.segment GROUP BY x.segment) SELECT round(avg(m), 5) AS davies_bouldin FROM w""")
def davies_bouldin(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.davies_bouldin(scaled(spark, sf), NUMERIC, "segment"))


@query(f"""WITH {_SS}, d AS (SELECT z.respondent_id, cm.segment, {_DIST('z', 'cm')} AS d FROM z CROSS JOIN cm), k AS (SELECT *, row_number() OVER (PARTITION BY respondent_id ORDER BY d, segment) AS i FROM d) SELECT respondent_id, segment, round(d, 5) AS distance FROM k WHERE i = 1""")
def nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    z = scaled(spark, sf)
    return rounded(validity.nearest_centroid(z, validity.centroids(z, NUMERIC, "segment"), "respondent_id", NUMERIC, "segment"))


_LABELS = "l AS (SELECT segment AS a, CASE WHEN spend >= 1500000 THEN 'high' WHEN spend >= 1000000 THEN 'middle' ELSE 'low' END AS b FROM r), t AS (SELECT a, b, count(*) AS n FROM l GROUP BY ALL)"


def _two_labels(spark: SparkSession, sf: str) -> DataFrame:
    band = F.when(F.col("spend") >= 1_500_000, "high").when(F.col("spend") >= 1_000_000, "middle").otherwise("low")
    return respondents(spark, sf).select(F.col("respondent_id").alias("id"), F.col("segment").alias("a"), band.alias("b"))


@query(f"WITH {_LABELS} SELECT a, b, round(n / (sum(n) OVER (PARTITION BY a) + sum(n) OVER (PARTITION BY b) - n)::DOUBLE, 5) AS jaccard FROM t")
def jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.jaccard(_two_labels(spark, sf), "a", "b"))


_ARI = f"""{_LABELS}, c AS (SELECT sum(n) AS n, sum(n * (n - 1) / 2.0) AS cells FROM t), ra AS (SELECT sum(n * (n - 1) / 2.0) AS p FROM (SELECT sum(n) AS n FROM t GROUP BY a)), rb AS (SELECT sum(n * (n - 1) / 2.0) AS q FROM (SELECT sum(n) AS n FROM t GROUP BY b)),
ar AS (SELECT CAST(n AS BIGINT) AS n_compared, round((cells - p * q / (n * (n - 1) / 2.0)) / ((p + q) / 2.0 - p * q / (n * (n - 1) / 2.0)), 5) AS adjusted_rand_index FROM c, ra, rb)"""


@query(f"WITH {_ARI} SELECT * FROM ar")
def ari(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(validity.adjusted_rand(_two_labels(spark, sf), "a", "b"))


@query(f"WITH {_ARI} SELECT 'a' AS model_1, 'b' AS model_2, * FROM ar UNION ALL SELECT 'b', 'a', * FROM ar UNION ALL SELECT m, m, n_compared, 1.0 FROM ar, (VALUES ('a'), ('b')) AS v(m)")
def pairwise_ari(spark: SparkSession, sf: str) -> DataFrame:
    d = _two_labels(spark, sf)
    long = d.select("id", F.explode(F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(m).alias("cluster")) for m in ("a", "b")])).alias("v")).select("id", "v.*")
    return rounded(validity.pairwise_adjusted_rand(long))


# ---- distances between embeddings ----


def _vectors(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """id, label and all components, x0, x1, ... of each vector; and the components' names."""
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    names = [f"x{i}" for i in range(e.agg(F.max(F.size("embedding"))).first()[0] or 1)]
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("long").alias("label"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(names)]), names


# x: a vector's numbers, g: each divided by its component's range
_V = """u AS (SELECT vec_id AS id, CAST(label AS BIGINT) AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), s AS (SELECT i, max(e) - min(e) AS w FROM (SELECT unnest(x) AS e, generate_subscripts(x, 1) AS i FROM u) GROUP BY i),
w AS (SELECT list(w ORDER BY i) AS w FROM s), v AS (SELECT id, label, x, [coalesce(z[1] / nullif(z[2], 0), 0) for z in list_zip(x, w)] AS g FROM u, w)"""
_D = {
    "euclidean": "sqrt(list_sum([(z[1] - z[2]) ** 2 for z in list_zip(a.x, b.x)]))",
    "manhattan": "list_sum([abs(z[1] - z[2]) for z in list_zip(a.x, b.x)])",
    "gower": "list_sum([abs(z[1] - z[2]) for z in list_zip(a.g, b.g)]) / len(a.g)",
}
_DISTRIBUTION = "count(*) AS n_pairs, " + _r("min(d) AS minimum", "quantile_cont(d, 0.25) AS first_quartile", "median(d) AS median", "avg(d) AS mean", "quantile_cont(d, 0.75) AS third_quartile", "max(d) AS maximum", "stddev_samp(d) AS standard_deviation", "stddev_samp(d) / avg(d) AS coefficient_of_variation", "(max(d) - min(d)) / max(d) AS relative_contrast")


def _distribution_sql(d: str) -> str:
    return f"WITH {_V}, p AS (SELECT {d} AS d FROM v AS a JOIN v AS b ON a.id < b.id) SELECT {_DISTRIBUTION} FROM p"


def _correlation_sql() -> str:
    return f"""WITH {_V}, p AS (SELECT {_D['manhattan']} AS x, {_D['gower']} AS y FROM v AS a JOIN v AS b ON a.id < b.id),
k AS (SELECT x, y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p) SELECT round(corr(x, y), 5) AS pearson, round(corr(rx, ry), 5) AS spearman, count(*) AS n_pairs FROM k"""


def _mean_distances_sql(method: str) -> str:
    return f"""{_V}, p AS (SELECT a.id AS i, a.label AS own, b.label AS theirs, {_D[method]} AS d FROM v AS a JOIN v AS b ON a.id <> b.id), m AS (SELECT i, own, theirs, avg(d) AS m FROM p GROUP BY ALL)"""


def _silhouette_sql(method: str) -> str:
    return f"""WITH {_mean_distances_sql(method)},
ab AS (SELECT i, own, max(m) FILTER (theirs = own) AS a, min(m) FILTER (theirs <> own) AS b FROM m GROUP BY ALL) SELECT i AS id, own AS label, round(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END, 5) AS silhouette FROM ab"""


def _register_distances() -> None:
    """All pairs of all vectors, as the SQL has it: quadratic, whatever the table's size."""

    def distribution_of(spark: SparkSession, sf: str, m: str) -> DataFrame:
        v, names = _vectors(spark, sf)
        return rounded(allpairs.distribution(v, "id", names, m))

    for method in distance.METHODS:
        query(_distribution_sql(_D[method]), f"distance_distribution_{method}")(lambda spark, sf, m=method: distribution_of(spark, sf, m))


_register_distances()


@query(_correlation_sql())
def distance_correlation(spark: SparkSession, sf: str) -> DataFrame:
    v, names = _vectors(spark, sf)
    return rounded(allpairs.rank_correlation(v, "id", names, "manhattan", "gower"))


@query(_silhouette_sql("euclidean"))
def silhouette(spark: SparkSession, sf: str) -> DataFrame:
    v, names = _vectors(spark, sf)
    return rounded(allpairs.silhouette(v, "id", names, "label"))


for _name in (*(f"distance_distribution_{m}" for m in distance.METHODS), "distance_correlation", "silhouette"):
    # the plain names take all components now; these are the names under which that stood before
    _QUERIES[f"whole_{_name}"], _SQL[f"whole_{_name}"] = _QUERIES[_name], _SQL[_name]


@query(_silhouette_sql("manhattan"))
def silhouette_manhattan(spark: SparkSession, sf: str) -> DataFrame:
    """By sorted coordinates, without pairs."""
    v, names = _vectors(spark, sf)
    return rounded(validity.silhouette_by_coordinates(v, "id", names, "manhattan", "label"))


@query(_silhouette_sql("gower"))
def silhouette_gower(spark: SparkSession, sf: str) -> DataFrame:
    v, names = _vectors(spark, sf)
    return rounded(validity.silhouette_by_coordinates(v, "id", names, "gower", "label"))


@query(f"WITH {_mean_distances_sql('manhattan')} SELECT i AS id, own, theirs AS other, round(m, 5) AS mean_distance FROM m")
def mean_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Of each vector to the vectors of each label, without pairs."""
    v, names = _vectors(spark, sf)
    return rounded(validity.mean_distances(v, "id", names, "manhattan", "label").where("mean_distance IS NOT NULL"))


@query("SELECT respondent_id, segment, row_number() OVER (ORDER BY segment, respondent_id) AS row_id FROM r")
def row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Gapless numbers of all respondents in order of segment and id."""
    return numbering.number_rows(respondents(spark, sf).select("respondent_id", "segment"), "segment", "respondent_id")


_DRAWN = f"""n AS (SELECT *, row_number() OVER (ORDER BY respondent_id) - 1 AS number FROM r), t AS (SELECT count(*) * (count(*) - 1) // 2 AS total FROM r),
h AS (SELECT id, CAST('0x' || substr(md5('{config.SETTINGS.seed}:' || id), 1, 15) AS BIGINT) AS h FROM t, range(0, CASE WHEN total < {4 * config.SETTINGS.sample_pairs} THEN total ELSE {2 * config.SETTINGS.sample_pairs} END) AS q(id)),
pn AS (SELECT CASE WHEN total < {4 * config.SETTINGS.sample_pairs} THEN id ELSE h % total END AS p, min(CASE WHEN total <= {config.SETTINGS.sample_pairs} THEN 0 WHEN total < {4 * config.SETTINGS.sample_pairs} THEN h ELSE id END) AS o FROM h, t GROUP BY ALL ORDER BY o, p LIMIT {config.SETTINGS.sample_pairs}),
ij AS (SELECT p, CAST(floor((1 + sqrt(1 + 8 * p::DOUBLE)) / 2) AS BIGINT) AS j FROM pn), dp AS (SELECT p - j * (j - 1) // 2 AS i, j FROM ij),
b AS (SELECT {', '.join(f'max({c}) - min({c}) AS {c}' for c in NUMERIC)} FROM r)"""
_MIXED = [(f"x.{c} IS NOT NULL AND y.{c} IS NOT NULL AND b.{c} > 0", f"abs(x.{c} - y.{c}) / b.{c}") for c in NUMERIC] + [(f"x.{c} IS NOT NULL AND y.{c} IS NOT NULL", f"CASE WHEN x.{c} <> y.{c} THEN 1.0 ELSE 0.0 END") for c in CATEGORICAL]


@query(f"""WITH {_DRAWN}, p AS (SELECT ({' + '.join(f'CASE WHEN {w} THEN {d} ELSE 0.0 END' for w, d in _MIXED)}) / nullif({' + '.join(f'CAST({w} AS INTEGER)' for w, _ in _MIXED)}, 0)::DOUBLE AS d FROM dp JOIN n AS x ON x.number = i JOIN n AS y ON y.number = j, b) SELECT {_DISTRIBUTION} FROM p WHERE d IS NOT NULL""")
def sampled_mixed_gower(spark: SparkSession, sf: str) -> DataFrame:
    """Gower distances over numeric and nominal columns with missing values, of drawn pairs of respondents."""
    pairs = distance.sample_pairs(respondents(spark, sf), "respondent_id", NUMERIC, ("mixed",), CATEGORICAL)
    return rounded(distance.distance_distribution(pairs.select(F.col("mixed").alias("d")).where("d IS NOT NULL")))


@query(f"""WITH {_FILLED}, {_DRAWN}, q AS (SELECT f.*, number FROM f JOIN n USING (respondent_id)),
p AS (SELECT {' + '.join(f'abs(x.{c} - y.{c})' for c in NUMERIC)} AS manhattan, ({' + '.join(f'abs(x.{c} - y.{c}) / w.{c}' for c in NUMERIC)}) / {len(NUMERIC)} AS gower FROM dp JOIN q AS x ON x.number = i JOIN q AS y ON y.number = j, (SELECT {', '.join(f'max({c}) - min({c}) AS {c}' for c in NUMERIC)} FROM f) AS w)
SELECT count(*) AS n_pairs, round(avg(manhattan), 3) AS mean_manhattan, round(avg(gower), 5) AS mean_gower, round(corr(manhattan, gower), 5) AS correlation FROM p""")
def sampled_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Two distances of the same drawn pairs of respondents."""
    pairs = distance.sample_pairs(filled(spark, sf), "respondent_id", NUMERIC, ("manhattan", "gower"))
    return pairs.agg(F.count("*").alias("n_pairs"), F.round(F.avg("manhattan"), 3).alias("mean_manhattan"), F.round(F.avg("gower"), 5).alias("mean_gower"), F.round(F.corr("manhattan", "gower"), 5).alias("correlation"))


# ---- models ----


@query()
def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.kmeans(scaled(spark, sf), "respondent_id", NUMERIC, 4)


@query()
def model_grid(spark: SparkSession, sf: str) -> DataFrame:
    """k-medoids and average linkage on a sample of respondents, for two feature sets, two distances and each k of the settings."""
    sets = {"all": NUMERIC, "orders": ["n_orders", "spend", "mean_order"]}
    return cluster.model_grid(filled(spark, sf), "respondent_id", sets).drop("assignment", "elapsed_seconds")


@query()
def bootstrap_stability(spark: SparkSession, sf: str) -> DataFrame:
    """k-medoids of three clusters over resamples of respondents, each fit a unit."""
    found = cluster.bootstrap_stability(filled(spark, sf), "respondent_id", NUMERIC, "pam", "manhattan", 3)
    return found.select("cluster", "mean_jaccard", "minimum_jaccard")


@query()
def gap_statistic(spark: SparkSession, sf: str) -> DataFrame:
    return cluster.gap_statistic(filled(spark, sf), "respondent_id", NUMERIC)


@query()
def kmeans_transfers(spark: SparkSession, sf: str) -> DataFrame:
    """k-means of all respondents that no transfer of a single one improves."""
    return cluster.hartigan_wong(scaled(spark, sf), "respondent_id", NUMERIC, 4)


@query()
def kmedoids(spark: SparkSession, sf: str) -> DataFrame:
    """k-medoids over all respondents by Manhattan distance."""
    return cluster.k_medoids(scaled(spark, sf), "respondent_id", NUMERIC, 4)


@query()
def average_linkage_all(spark: SparkSession, sf: str) -> DataFrame:
    """Average linkage over all respondents by Manhattan distance."""
    return linkage.average_linkage_rows(scaled(spark, sf), "respondent_id", NUMERIC, 4)


# ---- ranking of models: four given segmentations of all respondents, measured ----

_BANDS = "CASE WHEN spend >= 1500000 THEN 'high' WHEN spend >= 1000000 THEN 'middle' ELSE 'low' END"
#: model -> (kind, label in SQL)
_GIVEN = {"market": ("declared", "segment"), "channel": ("declared", "coalesce(channel, 'none')"), "urgency": ("declared", "urgent"), "band": ("banded", _BANDS)}
_MIXED_SUM = lambda f: " + ".join(f.format(c=c) for c in NUMERIC)
_MODELS_SQL = f"""{_SCALED}, la AS ({' UNION ALL '.join(f"SELECT respondent_id, '{m}' AS model_id, '{kind}' AS method, {e} AS cluster FROM r" for m, (kind, e) in _GIVEN.items())}), zl AS (SELECT model_id, method, cluster, z.* EXCLUDE (segment) FROM la JOIN z USING (respondent_id)),
cn AS (SELECT model_id, cluster, count(*) AS n, {', '.join(f'avg({c}) AS {c}' for c in NUMERIC)} FROM zl GROUP BY ALL), ms AS (SELECT model_id, count(*) AS k, sum(n) AS rows, min(n) / sum(n)::DOUBLE AS minimum_share, 1 - (max(n) / sum(n)::DOUBLE - min(n) / sum(n)::DOUBLE) AS balance, ({_MIXED_SUM('(max({c}) - min({c}))')}) / {len(NUMERIC)} AS mean_range FROM cn GROUP BY model_id),
mw AS (SELECT zl.model_id, any_value(method) AS method, {_MIXED_SUM('sum((zl.{c} - cn.{c}) ** 2)')} AS within_ss, {_MIXED_SUM('sum(zl.{c} ** 2) - sum(zl.{c}) ** 2 / count(*)')} AS total_ss FROM zl JOIN cn USING (model_id, cluster) GROUP BY zl.model_id),
mp0 AS (SELECT zl.model_id, zl.cluster, avg({_DIST('zl', 'cn')}) AS s FROM zl JOIN cn USING (model_id, cluster) GROUP BY ALL), mq AS (SELECT * FROM cn JOIN mp0 USING (model_id, cluster)),
md AS (SELECT model_id, avg(m) AS davies_bouldin FROM (SELECT x.model_id, x.cluster, max((x.s + y.s) / {_DIST('x', 'y')}) AS m FROM mq AS x JOIN mq AS y ON x.model_id = y.model_id AND x.cluster <> y.cluster GROUP BY ALL) GROUP BY model_id),
mn AS (SELECT zl.model_id, zl.cluster, cn.cluster AS near, row_number() OVER (PARTITION BY zl.model_id, respondent_id ORDER BY {_DIST('zl', 'cn')}, cn.cluster) AS i FROM zl JOIN cn USING (model_id)),
mt AS (SELECT model_id, cluster, near, count(*) AS n FROM mn WHERE i = 1 GROUP BY ALL), mu AS (SELECT *, n / (sum(n) OVER (PARTITION BY model_id, cluster) + sum(n) OVER (PARTITION BY model_id, near) - n)::DOUBLE AS j FROM mt), mj AS (SELECT model_id, avg(j) AS average_jaccard FROM (SELECT model_id, cluster, max(j) AS j FROM mu GROUP BY ALL) GROUP BY model_id),
mz AS (SELECT x.respondent_id AS i, y.respondent_id AS o, {_MIXED_SUM('abs(x.{c} - y.{c})')} AS d FROM z AS x JOIN z AS y ON x.respondent_id <> y.respondent_id), mm AS (SELECT lx.model_id, i, lx.cluster AS own, ly.cluster AS theirs, avg(d) AS m FROM mz JOIN la AS lx ON lx.respondent_id = i JOIN la AS ly ON ly.respondent_id = o AND ly.model_id = lx.model_id GROUP BY ALL),
mab AS (SELECT model_id, i, max(m) FILTER (theirs = own) AS a, min(m) FILTER (theirs <> own) AS b FROM mm GROUP BY ALL), mx AS (SELECT model_id, avg(CASE WHEN a IS NULL OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS average_silhouette FROM mab GROUP BY model_id),
lc AS ({_unpivot(CATEGORICAL, 'respondent_id', text=True)}), ce AS (SELECT model_id, variable, cluster, value, count(*) AS o FROM la JOIN lc USING (respondent_id) WHERE value IS NOT NULL GROUP BY ALL),
cf AS (SELECT *, sum(o) OVER (PARTITION BY model_id, variable, cluster) AS rs, sum(o) OVER (PARTITION BY model_id, variable, value) AS cs FROM ce), cv AS (SELECT model_id, variable, sqrt(greatest(sum(o::DOUBLE * o / (rs::DOUBLE * cs)) - 1, 0) / (least(count(DISTINCT cluster), count(DISTINCT value)) - 1)) AS v FROM cf GROUP BY ALL), ca0 AS (SELECT model_id, avg(v) AS mean_association FROM cv GROUP BY model_id),
t AS (SELECT model_id, 'all' AS feature_set, method, k, average_silhouette, balance, minimum_share, (total_ss - within_ss) / total_ss AS between_ratio, average_jaccard, NULL::DOUBLE AS gap, ((total_ss - within_ss) / (k - 1)) / (within_ss / (rows - k)) AS calinski_harabasz, davies_bouldin, mean_range, mean_association FROM ms JOIN mw USING (model_id) JOIN md USING (model_id) JOIN mj USING (model_id) JOIN mx USING (model_id) JOIN ca0 USING (model_id))"""


def given(spark: SparkSession, sf: str) -> DataFrame:
    """Respondents with scaled variables, a column for each given segmentation (market, channel, urgency, band) and the raw levels of the
    categorical variables (level_...). Respondents and scaled respondents are fixed, as both are read several times."""
    band = F.when(F.col("spend") >= 1_500_000, "high").when(F.col("spend") >= 1_000_000, "middle").otherwise("low")
    labels = {"market": F.col("segment"), "channel": F.coalesce("channel", F.lit("none")), "urgency": F.col("urgent"), "band": band}
    raw = numbering.checkpointed(numbering.spread(respondents(spark, sf), "respondent_id").select("respondent_id", *NUMERIC, *[e.alias(m) for m, e in labels.items()], *[F.col(v).alias(f"level_{v}") for v in CATEGORICAL]))
    return numbering.checkpointed(clean.standardise(clean.median_impute(raw, NUMERIC), NUMERIC))


def _of_models(d: DataFrame, models: list[str], *keep: str) -> DataFrame:
    return d.select(*keep, F.explode(F.array(*[F.struct(F.lit(m).alias("model_id"), F.col(m).alias("cluster")) for m in models])).alias("v")).select("v.*", *keep)


def given_moments(d: DataFrame, models: list[str]) -> DataFrame:
    """model_id, cluster, and its size, sums and sums of squares, from one pass over all respondents."""
    return numbering.checkpointed(validity.moments(_of_models(d, models, *NUMERIC), NUMERIC, "model_id", "cluster"))


def given_profiles(by: DataFrame) -> DataFrame:
    return summaries.profiles_of(by, {v: F.try_divide(F.col(f"s_{v}"), F.col("n").cast("double")) for v in NUMERIC})


def given_associations(d: DataFrame, models: list[str]) -> DataFrame:
    """Respondents are counted by all labels and levels first, so few rows are told by model and variable."""
    levels = [f"level_{v}" for v in CATEGORICAL]
    counted = d.groupBy(*models, *levels).agg(F.count("*").alias("n"))
    return summaries.associations_of(_of_models(counted, models, "n", *levels), {v: F.col(f"level_{v}") for v in CATEGORICAL})


def _given_models(spark: SparkSession, sf: str, d: DataFrame | None = None) -> DataFrame:
    """A row for each given segmentation: how well it parts all respondents. average_jaccard: of its clusters with those of the nearest centroids; gap: null, as nothing was fitted.

    All segmentations are measured together: one pass for moments, one for the nearest centroids, one sorting of the coordinates for silhouettes.
    """
    d, models = given(spark, sf) if d is None else d, list(_GIVEN)
    by = given_moments(d, models)
    near = numbering.checkpointed(validity.nearest_of_models(d, by, NUMERIC, models))
    own = validity.average_silhouettes(d, "respondent_id", [(NUMERIC, "manhattan", m) for m in models])
    own = own.select(F.lit(models)[F.col("measure")].alias("model_id"), "average_silhouette")
    alike = validity.jaccard_of(near, "cluster", "near", "model_id").groupBy("model_id", "cluster").agg(F.max("jaccard").alias("j")).groupBy("model_id").agg(F.avg("j").alias("average_jaccard"))
    centres = by.select("model_id", "cluster", *[(F.col(f"s_{v}") / F.col("n")).alias(f"__c_{v}") for v in NUMERIC])
    spread = centres.join(near.groupBy("model_id", "cluster").agg((F.sum("away") / F.sum("n")).alias("s")), ["model_id", "cluster"])
    sizes = validity.sizes_of(by, "model_id").select("model_id", F.col("n_clusters").alias("k"), "minimum_share", "balance")
    apart = validity.separation_of(by, NUMERIC, "model_id").select("model_id", "between_ratio", "calinski_harabasz")
    ranges = summaries.model_distinctness(given_profiles(by)).select("model_id", F.col("mean_standardised_range").alias("mean_range"))
    related = summaries.model_association_summary(given_associations(d, models)).select("model_id", F.col("mean_profiling_association").alias("mean_association"))
    rows = reduce(lambda a, b: a.join(F.broadcast(b), "model_id"), [apart, own, alike, validity.davies_bouldin_of(spread, NUMERIC, "cluster", "model_id"), ranges, related], sizes)  # a row a model
    kind = F.create_map(*[F.lit(x) for m, (method, _) in _GIVEN.items() for x in (m, method)])
    return numbering.checkpointed(rows.withColumns({"feature_set": F.lit("all"), "method": kind[F.col("model_id")], "gap": F.lit(None).cast("double")}))


_RANKED = f"""{_MODELS_SQL}, c AS (SELECT *, 0.45 * {_norm('average_silhouette')} + 0.2 * {_norm('balance')} + 0.15 * {_norm('minimum_share')} + 0.2 * {_norm('between_ratio')} AS composite_score, minimum_share >= 0.05 AS acceptable_size FROM t),
mr AS (SELECT *, row_number() OVER (ORDER BY composite_score DESC NULLS LAST, model_id) AS overall_rank, rank() OVER (ORDER BY average_silhouette DESC NULLS LAST) AS silhouette_rank FROM c)"""
_VALIDATED = f"""{_RANKED}, va AS (SELECT *, average_jaccard >= 0.6 AS stable_model FROM mr), vs AS (SELECT *, 0.3 * {_norm('composite_score')} + 0.35 * {_norm('average_jaccard')} + 0.15 * {_norm('gap')} + 0.1 * {_norm('calinski_harabasz')} + 0.1 * (1 - {_norm('davies_bouldin')}) AS validation_score FROM va),
vr AS (SELECT *, row_number() OVER (ORDER BY validation_score DESC NULLS LAST, model_id) AS validation_rank, CASE WHEN stable_model AND acceptable_size THEN 'Shortlist' WHEN NOT stable_model THEN 'Insufficient bootstrap stability' WHEN NOT acceptable_size THEN 'Cluster-size imbalance' ELSE 'Review' END AS shortlist_status FROM vs)"""


def _ranked(spark: SparkSession, sf: str, d: DataFrame | None = None) -> DataFrame:
    return selection.model_rank(_given_models(spark, sf, d))


def _validated(spark: SparkSession, sf: str, d: DataFrame | None = None) -> DataFrame:
    return selection.validation_rank(_ranked(spark, sf, d).withColumn("stable_model", F.col("average_jaccard") >= config.SETTINGS.stable_jaccard))


@query(f"WITH {_RANKED} SELECT model_id, round(composite_score, 5) AS composite_score, acceptable_size, overall_rank, silhouette_rank FROM mr")
def model_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_ranked(spark, sf).select("model_id", "composite_score", "acceptable_size", "overall_rank", "silhouette_rank"))


@query(f"WITH {_RANKED} SELECT method, model_id, round(composite_score, 5) AS composite_score FROM (SELECT *, row_number() OVER (PARTITION BY method ORDER BY composite_score DESC NULLS LAST, model_id) AS i FROM mr) WHERE i = 1")
def best_by_method(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(selection.best_by(_ranked(spark, sf), "method").select("method", "model_id", "composite_score"))


@query(f"WITH {_RANKED} SELECT model_id, overall_rank FROM mr WHERE k IN (3, 4, 5, 6) AND acceptable_size ORDER BY overall_rank LIMIT 30")
def models_to_validate(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(selection.to_validate(_ranked(spark, sf)).select("model_id", "overall_rank"))


@query(f"WITH {_VALIDATED} SELECT model_id, round(validation_score, 5) AS validation_score, validation_rank, shortlist_status FROM vr")
def validation_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_validated(spark, sf).select("model_id", "validation_score", "validation_rank", "shortlist_status"))


_CANDIDATES = f"""{_VALIDATED}, sl AS (SELECT * FROM vr WHERE shortlist_status = 'Shortlist' OR NOT EXISTS (SELECT 1 FROM vr WHERE shortlist_status = 'Shortlist')), ca AS (SELECT * FROM sl WHERE validation_score >= (SELECT max(validation_score) FROM sl) - 0.2),
fs AS (SELECT *, 0.45 * {_norm('validation_score')} + 0.3 * {_norm('mean_range')} + 0.15 * {_norm('mean_association')} + 0.1 * {_norm('balance')} AS final_score FROM ca)"""


@query(f"""WITH {_CANDIDATES}
SELECT model_id, round(final_score, 5) AS final_score, row_number() OVER (ORDER BY final_score DESC NULLS LAST, model_id) AS final_rank, row_number() OVER (ORDER BY final_score DESC NULLS LAST, model_id) = 1 AS selected FROM fs""")
def final_model(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(selection.final_model(selection.candidates(_validated(spark, sf))).select("model_id", "final_score", "final_rank", "selected"))


@query("""WITH j AS (SELECT segment AS model_id, n_orders % 7 AS cluster, avg(CASE WHEN urgent = 'Yes' THEN 0.9 ELSE 0.5 END) AS mean_jaccard FROM r GROUP BY ALL)
SELECT model_id, round(avg(mean_jaccard), 5) AS average_jaccard, round(min(mean_jaccard), 5) AS minimum_jaccard, round(max(mean_jaccard), 5) AS maximum_jaccard, count(*) AS n_clusters, count(*) FILTER (mean_jaccard >= 0.6) AS n_stable, avg(mean_jaccard) >= 0.6 AND min(mean_jaccard) >= 0.6 AS stable_model FROM j GROUP BY model_id""")
def stability_summary(spark: SparkSession, sf: str) -> DataFrame:
    j = respondents(spark, sf).groupBy(F.col("segment").alias("model_id"), (F.col("n_orders") % 7).alias("cluster")).agg(F.avg(F.when(F.col("urgent") == "Yes", 0.9).otherwise(0.5)).alias("mean_jaccard"))
    return rounded(selection.stability_summary(j).select("model_id", "average_jaccard", "minimum_jaccard", "maximum_jaccard", "n_clusters", "n_stable", "stable_model"))


# ---- rules ----

_LEVEL = lambda c: f"CASE WHEN {c} >= 0.02 THEN 'High' WHEN {c} <= -0.02 THEN 'Low' ELSE 'Moderate' END"
_DIMS = {"readiness": "n_orders", "confidence": "balance", "barriers": "mean_order", "engagement": "spend"}
_WIDE = f"""{_PROFILE}, dm AS (SELECT segment, {', '.join(f"any_value(standardised_mean) FILTER (variable = '{v}') AS {d}" for d, v in _DIMS.items())} FROM pf GROUP BY segment),
sz AS (SELECT segment, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS share_pct FROM r GROUP BY segment), st AS (SELECT * FROM dm JOIN sz USING (segment))"""
_NAME = """CASE WHEN 10 * readiness >= 0.5 AND 10 * confidence >= 0.5 THEN 'Ready and assured' WHEN 10 * readiness <= -0.5 AND 10 * barriers >= 0.5 THEN 'Held back by barriers' WHEN 10 * confidence <= -0.25 THEN 'Unsure of themselves' WHEN 10 * engagement >= 0.5 AND 10 * readiness < 0.25 THEN 'Active, not committed' ELSE 'Mixed middle' END"""
_SCORE = f"""(CASE {_LEVEL('readiness')} WHEN 'High' THEN 3 WHEN 'Moderate' THEN 2 ELSE 1 END + CASE {_LEVEL('confidence')} WHEN 'Low' THEN 2 WHEN 'Moderate' THEN 1 ELSE 0 END + CASE {_LEVEL('barriers')} WHEN 'High' THEN 3 WHEN 'Moderate' THEN 1 ELSE 0 END + CASE WHEN share_pct >= 30 THEN 2 WHEN share_pct >= 20 THEN 1 ELSE 0 END)"""


def _dimensions(spark: SparkSession, sf: str) -> DataFrame:
    p = _profile(spark, sf).withColumn("label", F.col("variable"))
    out = profile.segment_sizes(respondents(spark, sf)).select("segment", "n", "share_pct")
    for d, v in _DIMS.items():
        out = out.join(rules.value_for(p, d, f"^{v}$"), "segment", "left")
    return out


@query(f"WITH {_WIDE} SELECT segment, {', '.join(f'{_LEVEL(d)} AS {d}' for d in _DIMS)} FROM st")
def classify_level(spark: SparkSession, sf: str) -> DataFrame:
    return _dimensions(spark, sf).select("segment", *[rules.classify_level(F.col(d), cut=0.02).alias(d) for d in _DIMS])


@query(f"WITH {_WIDE} SELECT segment, {_NAME} AS working_name FROM st")
def segment_name(spark: SparkSession, sf: str) -> DataFrame:
    return _named(spark, sf).select("segment", "working_name")


def _named(spark: SparkSession, sf: str) -> DataFrame:
    return _dimensions(spark, sf).withColumn("working_name", rules.segment_name(*[F.col(d) * 10 for d in rules.DIMENSIONS]))


def _prioritised(spark: SparkSession, sf: str) -> DataFrame:
    levels = [rules.classify_level(F.col(d), cut=0.02) for d in ("readiness", "confidence", "barriers")]
    return _dimensions(spark, sf).withColumn("priority_score", rules.priority_score(*levels, F.col("share_pct"))).withColumn("priority", rules.priority(F.col("priority_score")))


_BAND = "CASE WHEN s >= 8 THEN 'Very high' WHEN s >= 6 THEN 'High' WHEN s >= 4 THEN 'Medium' ELSE 'Lower' END"


@query(f"WITH {_WIDE}, sc AS (SELECT *, {_SCORE} AS s FROM st) SELECT segment, CAST(s AS BIGINT) AS priority_score, {_BAND} AS priority FROM sc")
def priority(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(_prioritised(spark, sf).select("segment", "priority_score", "priority"))


@query(f"WITH {_WIDE}, sc AS (SELECT *, {_SCORE} AS s FROM st) SELECT segment, {_BAND} AS priority, unnest(range(1, 7)) AS action_rank, unnest([{', '.join(repr(a) for a in rules.ACTIONS)}]) AS action FROM sc")
def actions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.actions(_prioritised(spark, sf)))


@query(f"SELECT segment, unnest(range(1, 6)) AS kpi_rank, unnest([{', '.join(repr(a) for a in rules.KPIS)}]) AS kpi FROM (SELECT DISTINCT segment FROM r)")
def kpis(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.kpis(_prioritised(spark, sf)))


@query(f"WITH {_WIDE}, sc AS (SELECT *, {_SCORE} AS s FROM st) SELECT segment, CAST(s AS BIGINT) AS priority_score, share_pct, row_number() OVER (ORDER BY s DESC, share_pct DESC, segment) AS overall_rank FROM sc")
def implementation_rank(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(rules.implementation_rank(_prioritised(spark, sf).select("segment", "priority_score", "share_pct")))


def _begin_sql() -> str:
    holds = lambda levels: " AND ".join(f"{_LEVEL(d)} = '{level}'" for d, level in levels.items())
    return "CASE " + " ".join(f"WHEN {holds(levels)} THEN '{text}'" for levels, text in rules.SEQUENCE[:-1]) + f" ELSE '{rules.SEQUENCE[-1][1]}' END"


@query(f"""WITH {_WIDE}, sc AS (SELECT *, {_SCORE} AS s FROM st), pb AS (SELECT segment, n, share_pct, {_BAND} AS priority, CAST(CASE {_BAND} WHEN 'Very high' THEN 4 WHEN 'High' THEN 3 WHEN 'Medium' THEN 2 ELSE 1 END AS BIGINT) AS priority_level, {_begin_sql()} AS recommended_sequence FROM sc)
SELECT *, row_number() OVER (ORDER BY priority_level DESC, share_pct DESC, segment) AS overall_rank FROM pb""")
def implementation_priorities(spark: SparkSession, sf: str) -> DataFrame:
    at = {d: rules.classify_level(F.col(d), cut=0.02) for d in ("readiness", "confidence", "barriers")}
    made = rules.implementation_priorities(_prioritised(spark, sf).withColumns(at))
    return rounded(made.select("segment", "n", "share_pct", "priority", "priority_level", "recommended_sequence", "overall_rank"))


@query()
def strategy(spark: SparkSession, sf: str) -> DataFrame:
    return rules.strategy(_named(spark, sf).select("segment", "working_name"))


@query(f"""WITH {_PROFILE}, {_CATEGORICAL}, tr AS (SELECT segment, CASE WHEN standardised_mean >= 0 THEN 'higher ' ELSE 'lower ' END || variable AS t, row_number() OVER (PARTITION BY segment ORDER BY abs(standardised_mean) DESC NULLS LAST, variable) AS k FROM pf),
fm AS (SELECT segment, variable, level, n / segment_total::DOUBLE AS sh, row_number() OVER (PARTITION BY segment, variable ORDER BY n DESC, level) AS m FROM cp), sg AS (SELECT segment, variable || ': ' || level AS t, row_number() OVER (PARTITION BY segment ORDER BY sh DESC, variable) AS k FROM fm WHERE m = 1)
SELECT segment, count(*) AS n, (SELECT string_agg(t, '; ' ORDER BY k) FROM tr WHERE k <= 4 AND tr.segment = r.segment) AS key_characteristics, (SELECT string_agg(t, '; ' ORDER BY k) FROM sg WHERE k <= 4 AND sg.segment = r.segment) AS profiling_signals FROM r GROUP BY segment""")
def persona(spark: SparkSession, sf: str) -> DataFrame:
    d = respondents(spark, sf)
    made = rules.persona(profile.segment_sizes(d), profile.segment_profile(d, NUMERIC), profile.categorical_profile(d, CATEGORICAL))
    return made.select("segment", "n", "key_characteristics", "profiling_signals")


@query(f"""WITH {_PROFILE}, k AS (SELECT segment, variable, standardised_mean, CASE WHEN standardised_mean > 0 THEN 'positive' ELSE 'negative' END AS direction FROM pf WHERE standardised_mean <> 0),
i AS (SELECT *, row_number() OVER (PARTITION BY segment, direction ORDER BY abs(standardised_mean) DESC, variable) AS rank FROM k) SELECT segment, direction, rank, variable, round(standardised_mean, 5) AS standardised_mean FROM i WHERE rank <= 4""")
def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """The strongest positive and negative deviations of each segment."""
    p = _profile(spark, sf).where("standardised_mean <> 0").withColumn("direction", F.when(F.col("standardised_mean") > 0, "positive").otherwise("negative"))
    keyed = p.withColumn("__g", F.concat_ws("|", "segment", "direction"))
    top = profile.top_per_group(keyed, "__g", F.abs("standardised_mean").desc(), config.SETTINGS.top_features, "variable")
    return rounded(top.select("segment", "direction", "rank", "variable", "standardised_mean"))


@query(f"""WITH {_WIDE} SELECT segment, working_name, working_name || ': readiness is ' || lower({_LEVEL('readiness')}) || ', confidence is ' || lower({_LEVEL('confidence')}) || ', barriers is ' || lower({_LEVEL('barriers')}) || ', engagement is ' || lower({_LEVEL('engagement')}) || '.' AS short_narrative FROM (SELECT *, {_NAME} AS working_name FROM st)""")
def narratives(spark: SparkSession, sf: str) -> DataFrame:
    levels = {d: rules.classify_level(F.col(d), cut=0.02) for d in rules.DIMENSIONS}
    return _named(spark, sf).select("segment", "working_name", rules.narrative(F.col("working_name"), levels).alias("short_narrative"))


@query(f"WITH {_PROFILE}, i AS (SELECT variable, max(abs(standardised_mean)) AS m FROM pf GROUP BY variable) SELECT variable, round(m, 5) AS maximum_absolute FROM i ORDER BY m DESC, variable LIMIT 20")
def key_variables(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 variables that set segments apart most: a top-k report."""
    d = profile.distinctness(_profile(spark, sf)).select("variable", "maximum_absolute")
    return rounded(d.orderBy(F.col("maximum_absolute").desc(), "variable").limit(config.SETTINGS.key_variables))


@query(f"""WITH {_FILLED}, {_COUNTS} SELECT variable, n_missing AS n_imputed, round(CASE variable {' '.join(f"WHEN '{c}' THEN (SELECT median({c}) FROM r)" for c in NUMERIC)} END, 5) AS median_used FROM c WHERE variable_type = 'numeric'""")
def imputation_summary(spark: SparkSession, sf: str) -> DataFrame:
    d = respondents(spark, sf)
    m = clean.medians(d, NUMERIC)
    used = m.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("median_used")) for c in NUMERIC])).alias("v")).select("v.*")
    return rounded(audit.missingness(d, NUMERIC).select("variable", F.col("n_missing").alias("n_imputed")).join(used, "variable"))


@query("SELECT time_bucket(INTERVAL '1 day', ts) AS day, user_id, count(*) AS n_events, count(DISTINCT event_type) AS n_types, round(sum(value), 5) AS total_value FROM events GROUP BY ALL")
def behaviour_windows(spark: SparkSession, sf: str) -> DataFrame:
    w = behaviour.behaviour_windows(spark.read.parquet(f"{sf}/events.parquet"))
    return rounded(w.select(F.col("window.start").alias("day"), "user_id", "n_events", "n_types", "total_value"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Respondents from orders, imputed, scaled, put to the nearest segment centroid, and profiled."""
    z = scaled(spark, sf)
    near = validity.nearest_centroid(z, validity.centroids(z, NUMERIC, "segment"), "respondent_id", NUMERIC, "segment")
    return rounded(profile.segment_profile(near.select("respondent_id", "segment").join(filled(spark, sf).drop("segment"), "respondent_id"), NUMERIC))
