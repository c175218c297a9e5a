"""Presentation of result tables: percentages, display names, fallbacks, file names and pivots for figures."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def percent_columns(df: DataFrame, digits: int = 1) -> DataFrame:
    """Columns named share become percentages with digits; those named pct or percent are rounded as they are, so nothing is scaled twice."""
    def shown(c: str):
        if re.search(r"pct|percent", c):
            return F.round(F.col(c), digits).alias(c)
        return F.round(F.col(c) * 100, digits).alias(c) if re.search(r"share", c) else F.col(c)

    numeric = {c for c, t in df.dtypes if t in ("double", "float") or t.startswith("decimal")}
    return df.select(*[shown(c) if c in numeric else F.col(c) for c in df.columns])


def display_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("_", " ").title() for c in df.columns])


def first_column(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of names that df has."""
    return next((n for n in names if n in df.columns), None)


def any_of(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of names that df has, in their order."""
    return df.select(*[n for n in names if n in df.columns])


def file_name(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", text.lower()).strip("_") or "unnamed"


def unique_file_names(texts: Sequence[str]) -> list[str]:
    """A name for each text, numbered where two would share one."""
    out: list[str] = []
    for t in texts:
        base, k = file_name(t), 1
        name = base
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def relative_path(path: str, root: str) -> str:
    """path below root, with forward slashes; a path that isn't below it stays as it is."""
    path, root = path.replace("\\", "/"), root.replace("\\", "/").rstrip("/")
    return path[len(root) + 1 :] if path.startswith(f"{root}/") else path


def heat_map(df: DataFrame, row: str, column: str, value: str) -> DataFrame:
    """row, column, value of a long table with a row a cell, absent cells null: what a heat map is drawn from.

    Cells come from a pivot. More columns than spark.sql.pivotMaxValues are an error; null labels
    in column are left out, those in row kept. The column is text in what it gives.
    """
    cells = df.select(F.col(f"`{row}`").alias("r"), F.col(f"`{column}`").cast("string").alias("c"), F.col(f"`{value}`").alias("v"))
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    names = sorted(x.c for x in cells.select("c").where("c is not null").distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"{column}: more than {most} labels")
    if not names:
        return df.select(row, column, value).limit(0)
    wide = cells.groupBy("r").pivot("c", names).agg(F.first("v"))
    shown = F.array(*[F.struct(F.lit(n).alias("c"), F.col(f"`{n.replace('`', '``')}`").alias("v")) for n in names])
    return wide.select("r", F.explode(shown).alias("x")).select(F.col("r").alias(row), F.col("x.c").alias(column), F.col("x.v").alias(value))


def level_order(df: DataFrame, level: str, by: str, name: str = "level_order") -> DataFrame:
    """level, mean_value, name: the order of a factor's levels by the mean of a column, least first; ties and levels without a value by text, the latter last.

    Null is no level. One aggregate; the order is over a row a level.
    """
    means = df.where(F.col(f"`{level}`").isNotNull()).groupBy(F.col(f"`{level}`").alias(level)).agg(F.avg(F.col(f"`{by}`")).alias("mean_value"))
    return means.withColumn(name, F.row_number().over(Window.orderBy(F.col("mean_value").asc_nulls_last(), F.col(f"`{level}`").cast("string"))))


def bar_labels(df: DataFrame, parts: Sequence[str], by: str, most: int, separator: str = " | ") -> DataFrame:
    """The `most` rows with the greatest values of by, with display_label (parts joined; nulls left out) and bar_order (1 is the least of them, so it's drawn first).

    Ties go by label. A top-k report: the rows are found without a sort of all.
    """
    told = df.withColumn("display_label", F.concat_ws(separator, *[F.col(f"`{p}`").cast("string") for p in parts]))
    top = told.orderBy(F.col(f"`{by}`").desc_nulls_last(), "display_label").limit(most)
    return top.withColumn("bar_order", F.row_number().over(Window.orderBy(F.col(f"`{by}`").asc_nulls_first(), F.col("display_label").desc())))
