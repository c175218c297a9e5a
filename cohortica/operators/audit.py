"""Audits of a wide table: one pass of aggregates, then one row per variable."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica import config
from cohortica.functions import stats
from cohortica.operators.clean import convert_binary, scale_bounds


def kind_of(t: T.DataType) -> str:
    """date, datetime, logical, integer, numeric or character; the type's own name for others."""
    for name, types in (("date", T.DateType), ("datetime", (T.TimestampType, T.TimestampNTZType)), ("logical", T.BooleanType), ("integer", (T.ByteType, T.ShortType, T.IntegerType, T.LongType)), ("numeric", (T.FloatType, T.DoubleType, T.DecimalType)), ("character", T.StringType)):
        if isinstance(t, types):
            return name
    return t.typeName()


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if kind_of(f.dataType) in ("integer", "numeric")]


def long_form(df: DataFrame, columns: list[str], value: str = "value") -> DataFrame:
    """variable, value (double), and no other column, nulls included."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias(value)) for c in columns])).alias("v")).select("v.*")


def _wide(df: DataFrame, measures: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregate over df, then a row for each variable. measures: variable -> name -> aggregate; all variables have the same names."""
    names = list(next(iter(measures.values())))
    flat = {(v, n): f"c{i}_{j}" for i, v in enumerate(measures) for j, n in enumerate(names)}
    one = df.agg(*[measures[v][n].alias(a) for (v, n), a in flat.items()])
    rows = [F.struct(F.lit(v).alias("variable"), *[F.col(flat[v, n]).alias(n) for n in names]) for v in measures]
    return one.select(F.explode(F.array(*rows)).alias("v")).select("v.*")


def numeric_summary(df: DataFrame, columns: list[str] | None = None, accuracy: int | None = None) -> DataFrame:
    """variable, minimum, first_quartile, median, mean, third_quartile, maximum, standard_deviation."""
    columns = columns or numeric_columns(df)
    of = lambda c: {"minimum": F.min(c).cast("double"), "first_quartile": stats.quantile(c, 0.25, accuracy), "median": stats.quantile(c, 0.5, accuracy), "mean": F.avg(c), "third_quartile": stats.quantile(c, 0.75, accuracy), "maximum": F.max(c).cast("double"), "standard_deviation": F.stddev_samp(c)}
    return _wide(df, {c: of(c) for c in columns})


def role_of(name: Column, kind: Column, n_unique: Column, pct_unique: Column, pct_missing: Column, s: config.Settings = config.SETTINGS) -> Column:
    number, text = kind.isin("numeric", "integer"), kind.isin("factor", "character")
    return (
        F.when(F.lower(name).rlike(r"(^id$|_id$|^id_|respondent|participant|transaction|case_number)"), "Potential identifier")
        .when((pct_unique >= s.id_unique_pct) & (n_unique > s.id_least_values), "Potential identifier")
        .when(pct_missing >= s.high_missing_pct, "High-missingness variable")
        .when(number & (n_unique == 2), "Binary numeric")
        .when(number & (n_unique <= s.ordinal_values), "Ordinal or categorical numeric")
        .when(number, "Continuous numeric")
        .when(text & (n_unique == 2), "Binary categorical")
        .when(text & (n_unique <= s.categorical_values), "Categorical")
        .when(text, "High-cardinality categorical")
        .when(kind.isin("date", "datetime"), "Date or time")
        .otherwise("Review")
    )


def variable_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """variable, variable_type, n_missing, pct_missing, n_non_missing, n_unique, pct_unique_non_missing, constant_variable.

    Distinct values are counted on a long form, by a shuffle of one row per
    variable, task and value, rather than by many distinct aggregates at once.
    """
    columns = columns or df.columns
    kinds = {f.name: kind_of(f.dataType) for f in df.schema}
    text = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    levels = df.select(F.explode(F.array(*text)).alias("v")).select("v.*").groupBy("variable", "value").agg(F.count("*").alias("n"))
    by = levels.groupBy("variable").agg(F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_missing"), F.sum("n").alias("__n"), F.count("value").alias("n_unique"))
    kind = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(kinds[c]))])[F.col("variable")]
    present = F.col("__n") - F.col("n_missing")
    return by.select(
        "variable", kind.alias("variable_type"), "n_missing", stats.pct(F.col("n_missing"), F.col("__n")).alias("pct_missing"), present.alias("n_non_missing"), "n_unique",
        stats.pct(F.col("n_unique"), present).alias("pct_unique_non_missing"), (F.col("n_unique") <= 1).alias("constant_variable"),
    )


def example_values(df: DataFrame, columns: list[str] | None = None, most: int = config.SETTINGS.example_values) -> DataFrame:
    """variable, example_values: the least values as text, most of them, joined by a bar."""
    columns = columns or df.columns
    text = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    values = df.select(F.explode(F.array(*text)).alias("v")).select("v.*").where("value is not null").distinct()
    top = values.withColumn("k", F.row_number().over(Window.partitionBy("variable").orderBy("value"))).where(F.col("k") <= most)
    return top.groupBy("variable").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "value"))), lambda x: x["value"]), " | ").alias("example_values"))


def variable_audit(df: DataFrame, columns: list[str] | None = None, examples: bool = False) -> DataFrame:
    """variable_counts with the numeric summary and a suggested role, most missing first."""
    columns = columns or df.columns
    counts = variable_counts(df, columns)
    numeric = [c for c in numeric_columns(df) if c in columns]
    out = counts.withColumn("suggested_role", role_of(F.col("variable"), F.col("variable_type"), F.col("n_unique"), F.col("pct_unique_non_missing"), F.col("pct_missing")))
    if numeric:
        out = out.join(F.broadcast(numeric_summary(df, numeric)), "variable", "left")
    if examples:
        out = out.join(example_values(df, columns), "variable", "left")
    return out.orderBy(F.col("pct_missing").desc(), "variable")


def dataset_summary(df: DataFrame) -> DataFrame:
    """metric, value: rows, columns, missing values and their percentage, duplicate rows (without the first of each)."""
    nulls = sum((F.when(F.col(c).isNull(), 1).otherwise(0) for c in df.columns), F.lit(0))
    grouped = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    one = grouped.select("__n", nulls.alias("__nulls")).agg(F.sum("__n").alias("rows"), F.sum(F.col("__nulls") * F.col("__n")).alias("missing"), F.sum(F.col("__n") - 1).alias("duplicates"))
    rows = [("rows", F.col("rows")), ("columns", F.lit(len(df.columns))), ("missing_values", F.col("missing")), ("missing_pct", F.round(stats.pct(F.col("missing"), F.col("rows") * len(df.columns)), 2)), ("duplicate_rows", F.col("duplicates"))]
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in rows])).alias("v")).select("v.*")


def duplicate_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows that occur more than once in columns, each with its number of copies; nulls equal nulls. Sums of rows are shuffled, not rows."""
    columns = columns or df.columns
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).where("copies > 1")


def level_audit(df: DataFrame, columns: list[str], most_levels: int = 50, shown: int = config.SETTINGS.levels_shown) -> DataFrame:
    """variable, level, n, pct: counts of each value, null as a level; variables with more levels than most_levels show the `shown` most common."""
    text = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in columns]
    n = df.select(F.explode(F.array(*text)).alias("v")).select("v.*").groupBy("variable", "level").agg(F.count("*").alias("n"))
    by = Window.partitionBy("variable")
    ranked = n.withColumn("pct", stats.pct(F.col("n"), F.sum("n").over(by))).withColumn("__levels", F.count("*").over(by)).withColumn("__k", F.row_number().over(by.orderBy(F.col("n").desc(), F.col("level").asc_nulls_last())))
    return ranked.where((F.col("__levels") <= most_levels) | (F.col("__k") <= shown)).select("variable", "level", "n", "pct")


def missingness(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or df.columns
    out = _wide(df, {c: {"n_missing": F.count_if(F.col(c).isNull()), "n_rows": F.count("*")} for c in columns})
    return out.withColumn("pct_missing", stats.pct(F.col("n_missing"), F.col("n_rows")))


def binary_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, n_zero, n_one, n_missing, n_unrecognised after conversion of yes and no answers."""
    def of(c: str) -> dict[str, Column]:
        b = convert_binary(F.col(c))
        return {"n_zero": F.count_if(b == 0), "n_one": F.count_if(b == 1), "n_missing": F.count_if(F.col(c).isNull()), "n_unrecognised": F.count_if(F.col(c).isNotNull() & b.isNull())}

    return _wide(df, {c: of(c) for c in columns})


def ordinal_validation(df: DataFrame, scales: dict[str, str]) -> DataFrame:
    """variable, scale_minimum, scale_maximum, n_below, n_above, n_invalid for columns with a scale such as 1-5."""
    def of(c: str) -> dict[str, Column]:
        low, high = scale_bounds(F.lit(scales[c]))
        return {"scale_minimum": F.first(low), "scale_maximum": F.first(high), "n_below": F.count_if(F.col(c) < low), "n_above": F.count_if(F.col(c) > high), "n_invalid": F.count_if((F.col(c) < low) | (F.col(c) > high))}

    return _wide(df, {c: of(c) for c in scales})


def reconcile(declared: DataFrame, observed: DataFrame, key: str = "variable") -> DataFrame:
    """key, status: in both, declared only or observed only."""
    a, b = declared.select(key, F.lit(1).alias("__a")).distinct(), observed.select(key, F.lit(1).alias("__b")).distinct()
    status = F.when(F.col("__a").isNotNull() & F.col("__b").isNotNull(), "Matched").when(F.col("__a").isNotNull(), "Declared only").otherwise("Observed only")
    return a.join(b, key, "full").select(key, status.alias("status"))


def dictionary(metadata: DataFrame, audit: DataFrame, high: float = config.SETTINGS.high_missing_pct) -> DataFrame:
    """metadata with the audit's counts, a missingness and an inclusion status. metadata is small: one row per variable."""
    j = metadata.join(audit.select("variable", "n_missing", "pct_missing", "n_unique"), "variable", "left")
    missing = F.when(~F.col("allow_missing") & (F.col("n_missing") > 0), "Unexpected missing values").when(F.col("pct_missing") >= high, "High missingness").when(F.col("pct_missing") > 0, "Missing values present").otherwise("Complete")
    used = F.when(F.col("include_segmentation") & F.col("include_profiling"), "Segmentation and profiling").when(F.col("include_segmentation"), "Segmentation").when(F.col("include_profiling"), "Profiling").otherwise("Not included in analysis")
    return j.withColumn("missingness_status", missing).withColumn("inclusion_status", used)


def dictionary_summary(d: DataFrame) -> DataFrame:
    """metric, value: how many variables of each role and status."""
    counters = [("variables", F.count("*")), *[(f"role_{r}", F.count_if(F.col("role") == r)) for r in config.ROLES], ("segmentation", F.count_if("include_segmentation")), ("profiling", F.count_if("include_profiling")), ("with_missing", F.count_if(F.col("n_missing") > 0)), ("unexpected_missing", F.count_if(F.col("missingness_status") == "Unexpected missing values"))]
    one = d.agg(*[c.alias(n) for n, c in counters])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n, _ in counters])).alias("v")).select("v.*")


def group_summary(d: DataFrame) -> DataFrame:
    """role, group, n_variables, n_segmentation, n_profiling, mean_missing_pct."""
    return d.groupBy("role", "group").agg(F.count("*").alias("n_variables"), F.count_if("include_segmentation").alias("n_segmentation"), F.count_if("include_profiling").alias("n_profiling"), F.avg("pct_missing").alias("mean_missing_pct"))


def distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """The numeric summary with count, skewness, excess kurtosis and normalised entropy of each variable."""
    long = long_form(df, columns).where("value is not null")
    moments = long.groupBy("variable").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("standard_deviation"), F.percentile("value", 0.5).alias("median"), stats.iqr("value").alias("iqr"), stats.skewness("value").alias("skewness"), stats.kurtosis("value").alias("kurtosis"))
    return moments.join(entropy(df, columns), "variable", "left")


def entropy(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, entropy, n_levels; nulls are no level."""
    text = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value")) for c in columns]
    n = df.select(F.explode(F.array(*text)).alias("v")).select("v.*").where("value is not null").groupBy("variable", "value").agg(F.count("*").alias("n"))
    p = n.withColumn("p", stats.share(F.col("n"), F.sum("n").over(Window.partitionBy("variable"))))
    return p.groupBy("variable").agg(stats.entropy_of_shares("p").alias("entropy"), F.count("*").alias("n_levels"))


def validate_metadata(metadata: DataFrame, columns: list[str]) -> list[str]:
    """Errors in a variable table (one row per variable), and columns that it doesn't declare."""
    rows = metadata.collect()
    names = [r["variable"] for r in rows]
    errors = [f"missing metadata column: {c}" for c in ("variable", "label", "role", "group", "data_type", "scale", "include_segmentation", "include_profiling", "allow_missing", "description") if c not in metadata.columns]
    errors += [f"declared twice: {n}" for n in sorted({n for n in names if names.count(n) > 1})]
    errors += [f"{r['variable']}: unknown role {r['role']}" for r in rows if r["role"] not in config.ROLES]
    errors += [f"{r['variable']}: unknown data type {r['data_type']}" for r in rows if r["data_type"] not in config.DATA_TYPES]
    return errors + [f"not declared: {c}" for c in columns if c not in names]


def compare_names(declared: DataFrame, columns: list[str]) -> DataFrame:
    """variable, standing ("in both", "only declared" or "only in data"): names of a variable table, which may repeat, beside those of a data set. Null names are left out."""
    known = declared.select("variable").where("variable is not null").distinct()
    seen = declared.sparkSession.createDataFrame([(c,) for c in columns], "variable string").distinct()
    parts = {"in both": known.intersect(seen), "only declared": known.exceptAll(seen), "only in data": seen.exceptAll(known)}
    return reduce(DataFrame.unionByName, [d.withColumn("standing", F.lit(name)) for name, d in parts.items()])


def check_key(df: DataFrame, key: str) -> None:
    """Raises if key has nulls or repeats."""
    one = df.groupBy(key).agg(F.count("*").alias("n")).agg(F.count_if(F.col(key).isNull()).alias("nulls"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    if one["nulls"] or one["repeated"]:
        raise ValueError(f"{key}: {one['nulls']} null and {one['repeated']} repeated values")
