"""Profiles of segments and tests of how they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica import config
from cohortica.functions import stats

S = config.SETTINGS


def segment_sizes(df: DataFrame, segment: str = "segment") -> DataFrame:
    n = df.groupBy(segment).agg(F.count("*").alias("n"))
    s = stats.share(F.col("n"), F.sum("n").over(Window.partitionBy()))
    return n.select(segment, "n", s.alias("share"), F.round(s * 100, 1).alias("share_pct"))


def _long(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    return df.select(*keep, F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in columns])).alias("v")).select(*keep, "v.*")


def segment_profile(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """segment, variable, n, mean, sd, median, iqr, overall_mean, overall_sd, standardised_mean (0 where there is no spread)."""
    long = _long(df, columns, segment)
    by = long.groupBy(segment, "variable").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), F.median("value").alias("median"), stats.iqr("value").alias("iqr"))
    whole = long.groupBy("variable").agg(F.avg("value").alias("overall_mean"), F.stddev_samp("value").alias("overall_sd"))
    z = F.when(F.col("overall_sd") > 0, (F.col("mean") - F.col("overall_mean")) / F.col("overall_sd")).otherwise(0.0)
    return by.join(F.broadcast(whole), "variable").withColumn("standardised_mean", z)


def distinctness(profile: DataFrame) -> DataFrame:
    """variable, profile_range, maximum_absolute over segments."""
    return profile.groupBy("variable").agg((F.max("standardised_mean") - F.min("standardised_mean")).alias("profile_range"), F.max(F.abs("standardised_mean")).alias("maximum_absolute"))


def categorical_profile(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """segment, variable, level, n, segment_total, within_segment_share, within_segment_pct; null is the level Missing."""
    rows = [F.struct(F.lit(c).alias("variable"), F.coalesce(F.col(c).cast("string"), F.lit("Missing")).alias("level")) for c in columns]
    n = df.select(segment, F.explode(F.array(*rows)).alias("v")).select(segment, "v.*").groupBy(segment, "variable", "level").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(segment, "variable"))
    return n.withColumn("segment_total", total).withColumn("within_segment_share", F.col("n") / F.col("segment_total")).withColumn("within_segment_pct", F.round(F.col("within_segment_share") * 100, 1))


def eta_squared(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """variable, n, k, between_ss, within_ss, eta_squared: null for fewer than 3 rows or 2 segments, 0 without spread."""
    g = _long(df, columns, segment).where(F.col("value").isNotNull() & F.col(segment).isNotNull()).groupBy(segment, "variable").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    one = g.groupBy("variable").agg(F.sum("n").alias("n"), F.count("*").alias("k"), (F.sum("q") - F.sum("s") * F.sum("s") / F.sum("n")).alias("total"), F.sum(F.col("q") - F.col("s") * F.col("s") / F.col("n")).alias("within_ss"))
    out = one.withColumn("between_ss", F.col("total") - F.col("within_ss"))
    eta = F.when((F.col("n") >= 3) & (F.col("k") >= 2), F.when(F.col("total") <= 0, 0.0).otherwise(F.col("between_ss") / F.col("total")))
    return out.select("variable", "n", "k", "between_ss", "within_ss", eta.alias("eta_squared"))


def anova(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """eta_squared with df_between, df_within and the F statistic."""
    e = eta_squared(df, columns, segment)
    f = F.try_divide(F.col("between_ss") / (F.col("k") - 1), F.col("within_ss") / (F.col("n") - F.col("k")))
    return e.select("variable", (F.col("k") - 1).alias("df_between"), (F.col("n") - F.col("k")).alias("df_within"), F.when((F.col("k") >= 2) & (F.col("n") > F.col("k")), f).alias("statistic"), "eta_squared")


def chi_square(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """variable, n, statistic, df, cramers_v, without continuity correction; empty cells count by the marginals' products."""
    rows = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in columns]
    n = df.where(F.col(segment).isNotNull()).select(segment, F.explode(F.array(*rows)).alias("v")).select(segment, "v.*").where("level is not null").groupBy("variable", segment, "level").agg(F.count("*").alias("o"))
    w = Window.partitionBy("variable")
    cell = n.withColumn("r", F.sum("o").over(Window.partitionBy("variable", segment))).withColumn("c", F.sum("o").over(Window.partitionBy("variable", "level"))).withColumn("t", F.sum("o").over(w))
    # sum over all cells of (o - e)^2 / e = t * (sum of o^2 / (r c) - 1): cells without rows add nothing
    one = cell.groupBy("variable").agg(F.first("t").alias("n"), F.sum(F.col("o").cast("double") * F.col("o") / (F.col("r").cast("double") * F.col("c"))).alias("s"), F.countDistinct(segment).alias("rows"), F.countDistinct("level").alias("cols"))
    x = F.col("n") * (F.col("s") - 1)
    least = F.least(F.col("rows"), F.col("cols")) - 1
    return one.select("variable", "n", x.alias("statistic"), ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("df"), F.when(least > 0, F.sqrt(F.greatest(x, F.lit(0.0)) / (F.col("n") * least))).alias("cramers_v"))


def associations(df: DataFrame, numeric: list[str], categorical: list[str], segment: str = "segment") -> DataFrame:
    """variable, measure, association, association_rank: eta squared of numbers, Cramer's V of categories, strongest first."""
    a = eta_squared(df, numeric, segment).select("variable", F.lit("eta_squared").alias("measure"), F.col("eta_squared").alias("association"))
    b = chi_square(df, categorical, segment).select("variable", F.lit("cramers_v").alias("measure"), F.col("cramers_v").alias("association"))
    return a.unionByName(b).withColumn("association_rank", F.row_number().over(Window.orderBy(F.col("association").desc_nulls_last(), "variable")))


def difference_tests(df: DataFrame, numeric: list[str], categorical: list[str], segment: str = "segment", level: float = S.significance) -> DataFrame:
    """variable, test, statistic, p_value, effect_size, effect_size_name, adjusted_p_value, significant, effect_rank. One row per variable."""
    f = anova(df, numeric, segment).select("variable", F.lit("anova").alias("test"), "statistic", F.col("df_between").alias("d1"), F.col("df_within").alias("d2"), F.col("eta_squared").alias("effect_size"), F.lit("eta_squared").alias("effect_size_name"))
    x = chi_square(df, categorical, segment).select("variable", F.lit("chi_square").alias("test"), "statistic", F.col("df").alias("d1"), F.lit(0).cast("long").alias("d2"), F.col("cramers_v").alias("effect_size"), F.lit("cramers_v").alias("effect_size_name"))

    def tails(frames):
        for t in frames:
            p = [stats.f_tail(s, a, b) if k == "anova" else stats.chi_square_tail(s, a) for k, s, a, b in zip(t["test"], t["statistic"], t["d1"], t["d2"], strict=True)]
            yield t.assign(p_value=[None if v != v else v for v in p]).drop(columns=["d1", "d2"])

    made = f.unionByName(x).mapInPandas(tails, "variable string, test string, statistic double, effect_size double, effect_size_name string, p_value double")
    out = made.withColumn("adjusted_p_value", stats.benjamini_hochberg("p_value"))
    return out.withColumn("significant", F.col("adjusted_p_value") < level).withColumn("effect_rank", F.row_number().over(Window.orderBy(F.col("effect_size").desc_nulls_last(), "variable")))


def profile_join(assignment: DataFrame, features: DataFrame, key: str, suffix: str = "_profiling") -> DataFrame:
    """assignment with features by key; columns that both have get the suffix on the right."""
    clash = {c: f"{c}{suffix}" for c in features.columns if c in assignment.columns and c != key}
    return assignment.join(features.withColumnsRenamed(clash), key, "left")


def top_per_group(df: DataFrame, group: str, by: Column, k: int, *ties: str, keep_ties: bool = False) -> DataFrame:
    """The k first rows of each group by an ordering column; with keep_ties all that share the last place."""
    w = Window.partitionBy(group).orderBy(by, *([] if keep_ties else ties))
    return df.withColumn("rank", (F.rank() if keep_ties else F.row_number()).over(w)).where(F.col("rank") <= k)


def profile_wide(profile: DataFrame, segments: list[str], value: str = "mean", segment: str = "segment") -> DataFrame:
    """One row per variable, a column per segment."""
    return profile.groupBy("variable").pivot(segment, segments).agg(F.first(value))


def joined_text(df: DataFrame, group: str, order: str, text: str, separator: str = "; ") -> DataFrame:
    """group, joined: texts of a group in order."""
    return df.groupBy(group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text))), lambda x: x[text]), separator).alias("joined"))
