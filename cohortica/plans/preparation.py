"""Registered queries of cleaning and typing, of names and examples, and of the tables that figures are drawn from, with their SQL. catalog.queries() takes them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats
from cohortica.operators import audit, clean, features, numbering, present, profile, rules, summaries
from cohortica.plans import catalog as c
from cohortica.plans import reports
from cohortica.plans.catalog import CATEGORICAL, NUMERIC, query, respondents, rounded

_QUOTED = lambda texts: ", ".join(repr(t) for t in texts)


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# ---- cleaning and typing ----

# white space as the cleaning takes it
_SQUISHED = lambda x: f"trim(regexp_replace({x}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'))"


@query(f"""WITH d AS (SELECT doc_id, nullif({_SQUISHED('text')}, '') AS t, {_SQUISHED('source')} AS s FROM documents)
SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars, CASE WHEN s NOT IN ({_QUOTED(config.MISSING_TOKENS)}) THEN s END AS source FROM d""")
def cleaned_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts with their white space squished, empty ones null; sources that stand for no answer are null."""
    d = _read(spark, sf, "documents").select("doc_id", clean.clean_text(F.col("text")).alias("t"), clean.missing_tokens(F.col("source")).alias("source"))
    return rounded(d.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").alias("n_chars"), "source"))


_TYPES = {"nation": "ordinal", "balance": "numeric", "urgent": "binary", "channel": "categorical"}


@query(f"""WITH t AS (SELECT respondent_id, CAST(balance AS VARCHAR) AS balance, nation, urgent, channel FROM r)
SELECT respondent_id, TRY_CAST(nation AS DOUBLE) AS nation, TRY_CAST(balance AS DOUBLE) AS balance, CAST(CASE WHEN lower(trim(urgent)) IN ({_QUOTED(config.YES)}) THEN 1 WHEN lower(trim(urgent)) IN ({_QUOTED(config.NO)}) THEN 0 END AS BIGINT) AS urgent, nullif({_SQUISHED('channel')}, '') AS channel FROM t""")
def typed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Answers read as text and cast by their declared types."""
    texts = respondents(spark, sf).select("respondent_id", *[F.col(v).cast("string") for v in _TYPES])
    return rounded(clean.apply_types(texts, _TYPES))


@query("SELECT doc_id, quality = 1 AS quality, coalesce(toxic = 1, false) AS toxic, false AS reviewed FROM documents LEFT JOIN labels USING (doc_id)")
def parsed_logicals(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings of all documents as truth values: without a default, with one, and of a column that isn't there."""
    rated = _read(spark, sf, "documents").select("doc_id").join(_read(spark, sf, "labels").select("doc_id", "quality", "toxic"), "doc_id", "left")
    for name, default in (("quality", None), ("toxic", False), ("reviewed", False)):
        rated = clean.parse_optional_logical(rated, name, default)
    return rated


@query("SELECT CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY ALL")
def filled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of what is known of documents once rows and columns without any value are gone; no document has a rater."""
    known = _read(spark, sf, "documents").select("doc_id").join(_read(spark, sf, "labels"), "doc_id", "left").select("quality", "toxic", F.lit(None).cast("string").alias("rater"))
    left = clean.drop_empty(known)
    return rounded(left.groupBy(*left.columns).agg(F.count("*").alias("n")))


@query(f"""WITH v AS ({c._unpivot([*CATEGORICAL, 'segment'], text=True)}), k AS (SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) AS k FROM (SELECT DISTINCT variable, value FROM v WHERE value IS NOT NULL))
SELECT variable, string_agg(value, ' | ' ORDER BY k) AS example_values FROM k WHERE k <= {config.SETTINGS.example_values} GROUP BY variable""")
def example_values(spark: SparkSession, sf: str) -> DataFrame:
    """A report of the first few values of each variable."""
    return audit.example_values(respondents(spark, sf), [*CATEGORICAL, "segment"])


@query(f"""WITH {c._COUNTS}, {reports._DECLARED} SELECT coalesce(md.variable, c.variable) AS variable, CASE WHEN c.variable IS NULL THEN 'only declared' WHEN md.variable IS NULL THEN 'only in data' ELSE 'in both' END AS standing FROM md FULL JOIN c ON md.variable = c.variable
UNION ALL SELECT 'segment', 'only in data'""")
def compared_names(spark: SparkSession, sf: str) -> DataFrame:
    """What is declared beside what the respondents have; their ids are declared but taken out as keys."""
    return audit.compare_names(reports._declared(spark), respondents(spark, sf).drop("respondent_id").columns)


@query("""WITH s AS (SELECT user_id, epoch(max(ts) - min(ts)) AS seconds FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN seconds < 60 THEN printf('%.1f s', seconds) WHEN seconds < 3600 THEN printf('%.1f min', seconds / 60) WHEN seconds IS NOT NULL THEN printf('%.1f h', seconds / 3600) END AS active_for FROM s""")
def active_durations(spark: SparkSession, sf: str) -> DataFrame:
    """How long each user was seen, as text."""
    # an interval, so that no time zone comes in
    seen = _read(spark, sf, "events").groupBy("user_id").agg((F.max("ts") - F.min("ts")).cast("interval second").cast("decimal(20,6)").cast("double").alias("seconds"))
    return seen.select("user_id", stats.duration_text(F.col("seconds")).alias("active_for"))


@query(f"WITH {c._SCALED} SELECT respondent_id, round(r.spend, 5) AS spend, round(z.spend, 5) AS scaled_spend FROM r JOIN z USING (respondent_id)")
def bound_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled values put beside the respondents by position."""
    scaled = c.scaled(spark, sf).select(F.col("respondent_id").alias("scaled_id"), F.col("spend").alias("scaled_spend"))
    bound = numbering.bind_columns(respondents(spark, sf).select("respondent_id", "spend"), scaled, ["respondent_id"], ["scaled_id"])
    return rounded(bound.drop("scaled_id"))


_KNOWN = "d AS (SELECT quality, toxic, n_chars, length(text) AS length, 1 AS one FROM documents LEFT JOIN labels USING (doc_id))"
_KNOWN_COLUMNS = ["quality", "toxic", "n_chars", "length", "one"]


@query(f"""WITH {_KNOWN}, x AS ({c._unpivot(_KNOWN_COLUMNS, of='d')}), q AS (SELECT variable, CASE WHEN 100.0::DOUBLE * (count(*) - count(value)) / count(*) > 40 THEN 'Missingness above threshold' WHEN count(DISTINCT value) < 2 THEN 'Insufficient unique values' END AS reason FROM x GROUP BY variable),
al AS (SELECT 'n_chars' AS variable, 'Correlated with length' AS reason WHERE (SELECT abs(corr(length, n_chars)) FROM d) >= 0.8)
SELECT variable, coalesce(q.reason, al.reason) AS exclusion_reason FROM q LEFT JOIN al USING (variable) WHERE coalesce(q.reason, al.reason) IS NOT NULL""")
def excluded_variables(spark: SparkSession, sf: str) -> DataFrame:
    """What is known of all documents, without what is mostly missing, the same for all or told by the text's length already."""
    # lengths before the join, so that no text is shuffled
    measured = _read(spark, sf, "documents").select("doc_id", "n_chars", F.length("text").alias("length"))
    known = measured.join(_read(spark, sf, "labels"), "doc_id", "left").select("quality", "toxic", "n_chars", "length", F.lit(1).alias("one"))
    alike = features.high_correlations(features.correlation_pairs(known, ["length", "n_chars"])).select(F.col("variable_2").alias("variable"), F.col("variable_1").alias("kept"))
    return summaries.excluded_variables(features.quality_metrics(known, _KNOWN_COLUMNS), alike)


@query(f"""WITH {reports._SCORED}, {reports._DECLARED} SELECT ork.variable, ork.i AS selection_order, label, md."group", data_type FROM ork LEFT JOIN md USING (variable)""")
def selected_variables(spark: SparkSession, sf: str) -> DataFrame:
    """All scored variables in the order of their selection, with what is declared of them."""
    order = c._feature_scores(spark, sf).select("variable", F.col("overall_rank").alias("selection_order"))
    return rounded(summaries.selected_variables(order, reports._declared(spark)))


# ---- tables that figures and slides are drawn from ----


@query('SELECT segment AS "Segment", count(*) AS "N", round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS "Share Pct", round(100.0::DOUBLE * avg(CASE WHEN urgent = \'Yes\' THEN 1 ELSE 0 END), 1) AS "Urgent Share" FROM r GROUP BY segment')
def display_table(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of segments as a page shows them: shares as percentages, names as titles."""
    d = respondents(spark, sf)
    urgent = d.groupBy("segment").agg(F.avg(F.when(F.col("urgent") == "Yes", 1.0).otherwise(0.0)).alias("urgent_share"))
    return present.display_names(present.percent_columns(rounded(profile.segment_sizes(d).select("segment", "n", "share_pct"), 10).join(urgent, "segment")))


@query("""WITH m AS (SELECT o_orderpriority AS channel, avg(o_totalprice) AS mean_value FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL)
SELECT channel, round(mean_value, 5) AS mean_value, row_number() OVER (ORDER BY mean_value NULLS LAST, channel) AS level_order FROM m""")
def level_order(spark: SparkSession, sf: str) -> DataFrame:
    """Levels of priority in the order of their orders' mean price."""
    orders = _read(spark, sf, "orders").select(F.col("o_orderpriority").alias("channel"), "o_totalprice")
    return rounded(present.level_order(orders, "channel", "o_totalprice"))


@query(f"WITH {c._PROFILE} SELECT variable, segment, round(standardised_mean, 5) AS standardised_mean FROM (SELECT DISTINCT variable FROM pf) CROSS JOIN (SELECT DISTINCT segment FROM pf WHERE segment IS NOT NULL) LEFT JOIN pf USING (variable, segment)")
def figure_profile_heat_map(spark: SparkSession, sf: str) -> DataFrame:
    """Standardised means, a cell for each variable and segment."""
    return rounded(present.heat_map(c._profile(spark, sf), "variable", "segment", "standardised_mean"))


@query(f"""WITH {c._CATEGORICAL}, l AS (SELECT DISTINCT variable || ': ' || level AS level FROM cp), s AS (SELECT DISTINCT segment FROM cp WHERE segment IS NOT NULL)
SELECT l.level, s.segment, round(n / segment_total::DOUBLE, 5) AS within_segment_share FROM l CROSS JOIN s LEFT JOIN cp ON cp.segment = s.segment AND cp.variable || ': ' || cp.level = l.level""")
def figure_level_heat_map(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of each level within segments; levels that a segment lacks have null cells."""
    shares = profile.categorical_profile(respondents(spark, sf), CATEGORICAL).withColumn("level", F.concat_ws(": ", "variable", "level"))
    return rounded(present.heat_map(shares, "level", "segment", "within_segment_share"))


@query(f"""WITH {c._RANKED}, b AS (SELECT feature_set || ' | ' || method || ' | ' || model_id || ' | ' || CAST(k AS VARCHAR) AS display_label, composite_score, acceptable_size FROM mr), k AS (SELECT * FROM b ORDER BY composite_score DESC NULLS LAST, display_label LIMIT 20)
SELECT display_label, round(composite_score, 5) AS composite_score, acceptable_size, row_number() OVER (ORDER BY composite_score NULLS FIRST, display_label DESC) AS bar_order FROM k""")
def figure_top_models(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of the 20 best models: a top-k report."""
    bars = present.bar_labels(c._ranked(spark, sf), ["feature_set", "method", "model_id", "k"], "composite_score", 20)
    return rounded(bars.select("display_label", "composite_score", "acceptable_size", "bar_order"))


@query(f"WITH {c._RANKED} SELECT feature_set, method, model_id, round(average_silhouette, 5) AS average_silhouette, round(minimum_share, 5) AS minimum_share, {config.SETTINGS.least_share}::DOUBLE AS threshold, acceptable_size FROM mr")
def figure_model_balance(spark: SparkSession, sf: str) -> DataFrame:
    """A point for each model: its silhouette beside its least cluster's share, and the line that the share should reach."""
    points = c._ranked(spark, sf).withColumn("threshold", F.lit(config.SETTINGS.least_share))
    return rounded(points.select("feature_set", "method", "model_id", "average_silhouette", "minimum_share", "threshold", "acceptable_size"))


# the associations of all variables, as the query of them says
_ASSOCIATIONS = c._SQL["profiling_associations"].partition(f"{c._RESPONDENTS.strip()},\n")[2].partition("\nSELECT variable, measure")[0]


@query(f"""WITH {_ASSOCIATIONS}, lb AS (SELECT variable || ' | ' || measure AS display_label, association FROM u WHERE association IS NOT NULL), k AS (SELECT * FROM lb ORDER BY association DESC, display_label LIMIT 20)
SELECT display_label, round(association, 5) AS association, row_number() OVER (ORDER BY association, display_label DESC) AS bar_order FROM k""")
def figure_top_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of the 20 variables that tell segments apart best: a top-k report."""
    strong = profile.associations(respondents(spark, sf), NUMERIC, CATEGORICAL).where("association is not null")
    return rounded(present.bar_labels(strong, ["variable", "measure"], "association", 20).select("display_label", "association", "bar_order"))


@query(f"""WITH {_ASSOCIATIONS}, {reports._DECLARED} SELECT variable, measure, round(association, 5) AS effect_size, label, role, row_number() OVER (ORDER BY association DESC, variable) AS effect_rank FROM u LEFT JOIN md USING (variable) WHERE association IS NOT NULL""")
def distinguishing_variables(spark: SparkSession, sf: str) -> DataFrame:
    """Effects of the segments on each variable that has one, with its label and role."""
    measured = profile.associations(respondents(spark, sf), NUMERIC, CATEGORICAL)
    return rounded(summaries.distinguishing_variables(measured, reports._declared(spark)))


@query(f"""WITH {reports._PLACED}, {reports._STRATEGIES}, kp AS (SELECT segment, po.working_name, unnest(range(1, 5)) AS kpi_rank, unnest(['Reach by ' || lower(channel), 'Response to: ' || message, 'Starts of ' || lower(service), 'Objective met: ' || objective]) AS kpi FROM po LEFT JOIN sy USING (working_name))
SELECT segment AS "Segment", working_name AS "Working Name", kpi_rank AS "Kpi Rank", kpi AS "Kpi" FROM kp WHERE kpi_rank <= 3""")
def slide_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """A slide's table: the first three measures of each segment, a top-k report."""
    strategies = rules.strategy(reports._positions(spark, sf).select("segment", "working_name"))
    first = profile.top_per_group(rules.segment_kpis(strategies).select("segment", "kpi_rank", "kpi"), "segment", F.col("kpi_rank"), 3).drop("rank")
    return present.display_names(rounded(first.join(strategies.select("segment", "working_name"), "segment").select("segment", "working_name", "kpi_rank", "kpi")))


# ---- what positions call for ----

#: Which of the segments' own traits stand for digital habits here.
_ONLINE = r"higher n_orders"


def _by_position_sql(name: str) -> str:
    said = lambda text: "'" + text.replace("'", "''") + "'"
    holds = lambda levels: " AND ".join(f"{d} = '{level}'" for d, level in levels.items())
    cases = rules.BY_POSITION[name]
    return "CASE " + " ".join(f"WHEN {holds(levels)} THEN {said(text)}" for levels, text in cases[:-1]) + f" ELSE {said(cases[-1][1])} END AS {name}"


@query(f"""WITH {reports._PLACED}, tr AS (SELECT segment, CASE WHEN standardised_mean >= 0 THEN 'higher ' ELSE 'lower ' END || variable AS t, row_number() OVER (PARTITION BY segment ORDER BY abs(standardised_mean) DESC NULLS LAST, variable) AS k FROM pf),
dg AS (SELECT segment, CASE WHEN regexp_matches(lower(string_agg(t, '; ' ORDER BY k)), '{_ONLINE}') THEN 'High' ELSE 'Moderate' END AS digital FROM tr WHERE k <= 4 GROUP BY segment)
SELECT segment, working_name, {', '.join(_by_position_sql(n) for n in rules.BY_POSITION)} FROM po JOIN dg USING (segment)""")
def strategy_by_position(spark: SparkSession, sf: str) -> DataFrame:
    """Problem, objective, approach, service and channel from the segments' positions and traits."""
    d = respondents(spark, sf)
    traits = rules.persona(profile.segment_sizes(d), profile.segment_profile(d, NUMERIC), profile.categorical_profile(d, CATEGORICAL)).select("segment", "key_characteristics")
    made = rules.strategy_by_position(reports._positions(spark, sf).join(traits, "segment"), "key_characteristics", _ONLINE)
    return made.select("segment", "working_name", *rules.BY_POSITION)
