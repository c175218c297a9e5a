"""Cleaning, typing, imputing and scaling of a respondent table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica import config
from cohortica.functions.stats import squish


def clean_names(names: list[str]) -> list[str]:
    """Snake case, unique: a repeated name gets _2, _3 and so on."""
    out: list[str] = []
    for n in names:
        base = re.sub(r"_+", "_", re.sub(r"[^0-9a-zA-Z]+", "_", re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", n.strip()))).strip("_").lower() or "x"
        base = f"x{base}" if base[0].isdigit() else base
        k, name = 1, base
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def rename_clean(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    new = clean_names(df.columns)
    return df.toDF(*new), dict(zip(df.columns, new, strict=True))


def drop_empty(df: DataFrame) -> DataFrame:
    """Without rows that are null throughout and without columns that have no value. One aggregate finds the columns."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[f"`{c}`" for c in df.columns if counts[c]]).dropna("all")


def missing_tokens(x: Column, tokens: tuple[str, ...] = config.MISSING_TOKENS) -> Column:
    """Blanks squished; a text that stands for no answer becomes null."""
    s = squish(x)
    return F.when(~s.isin(*tokens), s)


def clean_strings(df: DataFrame) -> DataFrame:
    return df.select(*[missing_tokens(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def clean_text(x: Column) -> Column:
    return F.nullif(squish(x), F.lit(""))


def parse_logical(x: Column, name: str = "value", default: bool | None = None) -> Column:
    """true/t/yes/y/1 and false/f/no/n/0 in any case; blank gives the default; anything else is an error."""
    s = F.lower(F.trim(x))
    fail = F.raise_error(F.concat(F.lit(f"{name}: not a logical value: "), x)).cast("boolean")
    return F.when(s.isNull() | (s == ""), F.lit(default).cast("boolean")).when(s.isin(*config.TRUE_WORDS), True).when(s.isin(*config.FALSE_WORDS), False).otherwise(fail)


def parse_optional_logical(df: DataFrame, name: str, default: bool | None = None) -> DataFrame:
    """df with the column parsed as parse_logical does; a column that df lacks is added, with the default in every row."""
    return df.withColumn(name, parse_logical(F.col(f"`{name}`").cast("string"), name, default) if name in df.columns else F.lit(default).cast("boolean"))


def convert_binary(x: Column) -> Column:
    s = F.lower(squish(x.cast("string")))
    return F.when(s.isin(*config.YES), 1).when(s.isin(*config.NO), 0)


def convert_numeric(x: Column) -> Column:
    return x.try_cast("double")


def scale_bounds(scale: Column) -> tuple[Column, Column]:
    """Least and greatest value of a scale such as 1-5 or -2 - 2; null if it isn't one."""
    pattern = r"^\s*(-?\d+(?:\.\d+)?)\s*-\s*(-?\d+(?:\.\d+)?)\s*$"
    part = lambda i: F.nullif(F.regexp_extract(scale, pattern, i), F.lit("")).try_cast("double")
    return part(1), part(2)


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns cast by their declared type; undeclared ones stay."""
    cast = {"binary": convert_binary, "numeric": convert_numeric, "ordinal": convert_numeric, "categorical": lambda c: clean_text(c.cast("string")), "text": lambda c: clean_text(c.cast("string"))}
    return df.select(*[cast[types[c]](F.col(f"`{c}`")).alias(c) if types.get(c) in cast else F.col(f"`{c}`") for c in df.columns])


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row of exact medians; 0 for a column without values."""
    return df.agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(c) for c in columns])


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls become their column's median. The medians are one row that is sent to each task, not a window over all rows."""
    m = medians(df, columns).toDF(*[f"__m_{c}" for c in columns])
    out = df.join(F.broadcast(m))
    return out.select(*[F.coalesce(F.col(c), F.col(f"__m_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Z-scores by the sample standard deviation; a column without spread becomes null."""
    stats = df.agg(*[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    out = df.join(F.broadcast(stats))
    return out.select(*[F.when(F.col(f"__s_{c}") > 0, (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])
