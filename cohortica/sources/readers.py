"""Input dispatch by file extension."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.sources.spss import SpssSource
from cohortica.sources.workbook import WorkbookSource

METADATA_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("variable", "label", "role", "group", "data_type", "scale", "include_segmentation", "include_profiling", "allow_missing", "description", "force_keep", "force_exclude")]
)


def read_table(spark: SparkSession, path: str, sheet: int | str = 0, encoding: str | None = None, delimiter: str | None = None, schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """csv, txt, tsv, parquet, json, orc by Spark; xlsx and sav by the sources of this package; xls by pandas on the driver, as such a workbook has 65,536 rows a sheet at most.

    multi_line: quoted values of text files may hold line breaks. Such a file is one task, others are
    split. Without a schema, text files are read twice, and sheets too.
    """
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind in ("csv", "txt", "tsv"):
        separator = delimiter or ("," if kind == "csv" else "\t")
        reader = spark.read.option("header", True).option("encoding", encoding or "UTF-8").option("sep", separator).option("multiLine", multi_line).option("escape", '"')
        return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    reader = spark.read.schema(schema) if schema else spark.read
    if kind in ("parquet", "json", "orc"):
        return reader.format(kind).load(path)
    if kind == "xlsx":
        spark.dataSource.register(WorkbookSource)
        return reader.format("workbook").option("sheet", str(sheet)).load(path)
    if kind == "sav":
        spark.dataSource.register(SpssSource)
        return (reader.option("encoding", encoding) if encoding else reader).format("spss").load(path)
    if kind == "xls":
        import pandas as pd

        try:
            frame = pd.read_excel(path, sheet_name=sheet)
        except ImportError as e:
            raise RuntimeError("reading old workbooks needs an Excel engine for pandas") from e
        return spark.createDataFrame(frame.astype(object).where(frame.notna(), None))
    raise ValueError(f"unsupported file type: {kind}")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The variable table, all text; empty, NA and N/A are null. Columns that the file lacks are null."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    names = {c.strip().lower().replace(" ", "_"): c for c in raw.columns}
    text = lambda c: F.trim(F.col(f"`{c}`"))
    return raw.select(*[(F.when(~text(names[f.name]).isin("", "NA", "N/A"), text(names[f.name])) if f.name in names else F.lit(None).cast("string")).alias(f.name) for f in METADATA_SCHEMA])


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at path, or an empty one if nothing is there."""
    return read_table(spark, path, schema=schema) if exists(spark, path) else spark.createDataFrame([], schema)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def list_files(spark: SparkSession, folder: str, glob: str = "*.png", prefix: str = "") -> DataFrame:
    """key, path, bytes, modified of a folder's files by a pattern of names: figures for a report, say.

    The key is the file's name without prefix and ending. Files are listed, not read: their content is no column of the plan.
    A folder that isn't there gives no rows.
    """
    empty = spark.createDataFrame([], "key string, path string, bytes long, modified timestamp")
    try:
        found = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty
    name = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    key = F.when(name.startswith(prefix), F.substr(name, F.lit(len(prefix) + 1))).otherwise(name)
    return found.select(key.alias("key"), "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
