"""The corpus pipeline: STAGES over documents, each written as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm import bagminhash, bpe, mixing, ordinal, pii
from cohortica.llm.common import materialise, table
from cohortica.llm.queries import RANKS

#: No SQL says what the classifier, the signatures, the label model and the encoder do; tests hold run() against brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier gives a fair chance of the best grade stay; rejected ones go.

    Null and empty texts are judged by their measures. Where no label rates a document there is no model, and all stay.
    """
    model = ordinal.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return ordinal.classify(docs, model).where("quality_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays: the one with the least id, one row of it where rows repeat."""
    return bagminhash.one_of_each(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by the name of their kind; n_chars is counted anew, if there. Null texts stay null."""
    return pii.redact(docs).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate says, so copies are separate rows. A null source is one more source; texts without words have size 0."""
    return mixing.emit(mixing.plan_mix(docs)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether they decode to its text; a null text counts as the empty one and has no ids."""
    import public_tokenizers

    out = bpe.encode_documents(docs.select("doc_id", "source", "text"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("round_trip"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("private_data", private_data), ("mix", mix), ("encode", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids, round_trip of what STAGES leave of documents, each stage written as Parquet and read again.

    All but the last stage give back the columns that they got, in whatever table: further
    columns pass through, also ones named as a stage's own. Rows with nulls in any column,
    empty and very long texts, ties and repeated rows are treated as each stage says; an
    empty table gives an empty one.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
