"""Mixing sources to target weights.

Tokens are summed per source, a share of the total is dealt to the sources by
weight with a cap on repetition, and each document is emitted floor(rate) times
plus once more with probability rate - floor(rate), drawn from a hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import BROADCAST_ROWS, WORD, materialise, text_of

#: With more sources than may be broadcast, each source is spread over so many join keys.
SALTS = 64


def word_total(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], total_share: float, cap: float) -> DataFrame:
    """source, source_size -> the same with target and rate.

    Weights repeat over the sources in code-point order, null last. A source's
    target is its part by weight of total_share times all sizes, but cap times
    its own size at most; what a capped source leaves is dealt again by weight.
    The fixed point is a water level: sort by cap per weight, and the first
    source whose cap lies above the level of the rest sets the level. The
    windows run over one row per source, never over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nth = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    return (
        sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), nth))
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(total_share)) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("level", F.first(F.when(F.col("ratio") > F.col("level"), F.col("level")), ignorenulls=True).over(everything))
        .withColumn("target", F.least("most", F.coalesce(F.col("level") * F.col("weight"), F.col("most"))))
        .select("source", "source_size", "target", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)).alias("rate"))
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of an MD5 of the id, so that any engine can repeat it."""
    key = F.concat(F.lit(f"mix:{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(2**52)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs doesn't have, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def plan_mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), total_share: float = 1.5, cap: float = 2.0, seed: int = 17) -> DataFrame:
    """docs with mix_size, mix_source_size, mix_target and mix_copies; every row stays.

    Null and empty texts have size 0 and are copied like others of their source
    (they change no sum). Null sources are one source, last in order. Rows with
    the same doc_id share a draw, null ids too. An empty table gives an empty
    one. Columns of docs with the names above are replaced; others stay.
    """
    added = ("mix_size", "mix_source_size", "mix_target", "mix_copies")
    source, rate_of, salt, salt_of = (_free(docs, n) for n in ("mix_for", "mix_rate", "mix_salt", "mix_salt_for"))
    sized = docs.drop(*added).withColumn("mix_size", word_total(text_of()))
    # one partial sum per task and source: a hot source costs the shuffle no more than another
    sums = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    targets = materialise(source_targets(sums, weights, total_share, cap)).select(F.col("source").alias(source), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"), F.col("rate").alias(rate_of))
    if targets.count() <= BROADCAST_ROWS:
        joined = sized.join(F.broadcast(targets), F.col("source").eqNullSafe(F.col(source)), "left")
    else:
        salted = sized.withColumn(salt, F.pmod(F.xxhash64("doc_id", "text"), F.lit(SALTS)))
        spread = targets.withColumn(salt_of, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(spread, F.col("source").eqNullSafe(F.col(source)) & (F.col(salt) == F.col(salt_of)), "left").drop(salt, salt_of)
    rate, whole = F.col(rate_of), F.floor(rate_of)
    return joined.withColumn("mix_copies", whole + F.when(draw(F.col("doc_id"), seed) < rate - whole, 1).otherwise(0)).drop(source, rate_of)


def emit(planned: DataFrame) -> DataFrame:
    """Each row mix_copies times, without the columns of the plan."""
    copies, copy = F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))), _free(planned, "mix_copy")
    return planned.where("mix_copies > 0").withColumn(copy, copies).drop(copy, "mix_size", "mix_source_size", "mix_target", "mix_copies")
