"""SpotSigs document fingerprints.

A spot is an anchor, a common word, with the CHAIN content words that follow it;
common words between them are skipped. A document's fingerprint is the set of
its spots. Sets are partitioned by size, since sets whose sizes differ by more
than a factor can't be as like as that factor, and compared by a Jaccard
likeness that gives up where the sizes already rule the pair out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica.llm.common import broadcast_if_small, let, materialise, text_of

#: Common words of English, French, German and Spanish, which are anchors and never part of a chain.
ANCHORS = (
    "a all als an and are as at auf avec be but by con da das dans de del dem den der des die du ein eine el en er es est "
    "et für for from had has have he ich il im in is ist it la las le les los mit nicht not of on oder para pas por pour "
    "que qui se sich sie sont su sur that the this to un una und une von was were which with you zu"
).split()
CHAIN = 2
#: Partitions hold sets whose sizes lie within this factor.
FACTOR = 0.8
#: Ids are cut at so many quantiles at most, so one far id moves no other out of its block.
QUANTILES = 256


def spots(text: Column) -> Column:
    """The set of a text's spots as sorted numbers of 64 bits.

    Letters and digits make words, in lower case. However many common words
    stand in a row, each has the same chain. A text without spots, as one
    without common words, takes each word as an anchor of the two words after
    it, a shorter one all its words; a text without words has the empty set.
    """
    clean = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    words = F.filter(F.split(clean, " "), lambda w: w != "")

    def marked(words: Column) -> Column:
        content = F.filter(F.transform(words, lambda w, i: F.when(~w.isin(ANCHORS), i)), lambda i: i.isNotNull())
        return let(content, lambda at: let(chained(words, at), lambda f: F.when(F.size(f) > 0, f).otherwise(runs(words))))

    def chained(words: Column, at: Column) -> Column:
        # the anchors between two content words share the chain that begins with the second
        def before(k: Column) -> Column:
            start = F.when(k > 0, F.get(at, k - 1) + 1).otherwise(F.lit(0))
            chain = [F.get(words, F.get(at, k + c)) for c in range(CHAIN)]
            return F.transform(F.slice(words, start + 1, F.get(at, k) - start), lambda a: F.xxhash64(F.concat_ws(" ", a, *chain)))

        return F.when(F.size(at) >= CHAIN, F.flatten(F.transform(F.sequence(F.lit(0), F.size(at) - CHAIN), before))).otherwise(F.array().cast("array<bigint>"))

    def runs(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1)))
        return F.when(F.size(words) > 0, F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(3)), " ")))).otherwise(F.array().cast("array<bigint>"))

    return F.sort_array(F.array_distinct(let(words, marked)))


def partition_of(size: Column) -> Column:
    """Sets as like as FACTOR lie in the same partition or in neighbouring ones."""
    return F.floor(F.ln(F.greatest(size, F.lit(1)).cast("double")) / F.lit(-math.log(FACTOR))).cast("int")


def pruned_jaccard(a: Column, b: Column, floor: float = 0.0) -> Column:
    """Jaccard likeness of two sets; 0 where the smaller size over the larger one is below floor, which rules out a likeness of floor. Two empty sets are alike."""
    n, m = F.size(a), F.size(b)
    bound = F.try_divide(F.least(n, m).cast("double"), F.greatest(n, m).cast("double"))
    both = F.size(F.array_intersect(a, b))
    exact = let(both, lambda x: x.cast("double") / (n + m - x))
    return F.when(F.greatest(n, m) == 0, 1.0).when(bound < floor, 0.0).otherwise(exact)


def as_text(fingerprint: Column) -> Column:
    """Sixteen hexadecimal digits for each spot."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _blocks(known: DataFrame, rows_per_block: int) -> DataFrame:
    """known with part and sub, which order its rows' blocks as ids go down: quantiles of the ids, each cut into equal widths; null ids have a part of their own."""
    probabilities = [i / QUANTILES for i in range(1, QUANTILES)]
    stats = known.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n"), F.percentile_approx("doc_id", probabilities, 100_000).alias("cuts")).first()
    cuts = sorted({stats["low"], stats["high"], *(stats["cuts"] or [])} - {None}, reverse=True) or [0]
    subs = math.ceil(stats["n"] / len(cuts) / rows_per_block)
    bounds, number = F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("doc_id")
    # part k holds the ids from cut k down to, without it, cut k + 1
    part = F.when(number.isNull(), len(cuts)).otherwise(F.size(F.filter(bounds, lambda c: c >= number)) - 1)

    def sub(k: Column) -> Column:
        top = F.get(bounds, k).cast("double")
        width = top - F.coalesce(F.get(bounds, k + 1), F.get(bounds, k)).cast("double")
        return F.when(width > 0, F.least(F.floor((top - number.cast("double")) / width * subs), F.lit(subs - 1))).otherwise(F.lit(0))

    return known.withColumn("part", part.cast("int")).withColumn("sub", F.when(number.isNull(), 0).otherwise(sub(F.col("part"))).cast("int"))


def with_next(docs: DataFrame, rows_per_block: int = 2000) -> DataFrame:
    """doc_id, text, spots of each row with next_text, next_spots of the row after it in descending doc_id (long); after the last comes the first.

    Null ids come last, rows with the same id in order of their texts. Ids are
    cut into blocks of about rows_per_block rows, each one group of a window;
    the first row of a block is put at the end of the block before it as well,
    so no order over all rows is needed. Rows of one id share a block. One row
    alone is its own next.
    """
    blocked = _blocks(docs.select(F.col("doc_id"), text_of().alias("text")), rows_per_block)
    tops = blocked.groupBy("part", "sub").agg(F.max("doc_id").alias("top"))
    # which block stands before each: within a part by a window over its blocks, between parts by one over the parts, of which there are few
    tops = materialise(tops.withColumn("before", F.lag(F.struct("part", "sub")).over(Window.partitionBy("part").orderBy("sub"))))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = tops.groupBy("part").agg(F.max("sub").alias("last")).select("part", F.coalesce(F.lag(F.struct("part", F.col("last").alias("sub"))).over(by_part), F.last(F.struct("part", F.col("last").alias("sub"))).over(whole)).alias("end"))
    linked = materialise(tops.join(F.broadcast(ends), "part").select("part", "sub", "top", F.coalesce("before", "end").alias("to")))
    heads = blocked.join(broadcast_if_small(linked), ["part", "sub"]).where(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("part", "sub", "doc_id", "to").agg(F.min("text").alias("text"))
    copies = materialise(heads.select("doc_id", "text", F.col("to.part").alias("part"), F.col("to.sub").alias("sub"), F.lit(True).alias("copy")))
    all_rows = blocked.withColumn("copy", F.lit(False)).unionByName(copies).withColumn("spots", spots(F.col("text")))
    within = Window.partitionBy("part", "sub").orderBy("copy", F.col("doc_id").desc_nulls_last(), "text")
    follows = lambda c: F.lead(c).over(within)
    return all_rows.select("doc_id", "text", "spots", "copy", follows("text").alias("next_text"), follows("spots").alias("next_spots")).where(~F.col("copy")).drop("copy")


def edited_text(text: Column, following: Column) -> Column:
    """The last half of the code points (the smaller half) replaced by the first as many of the following text, or all of it."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substr(text, F.lit(1), F.length(text) - half), F.substr(following, F.lit(1), half))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next, size_partition, one row per row of docs.

    A null text is the empty one. Texts that are equal have equal fingerprints.
    An empty table gives an empty one; other columns are not read.
    """
    rows = with_next(docs).withColumn("edited_text", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("edited_spots", spots(F.col("edited_text")))
    return rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "edited_text",
        as_text(F.col("spots")).alias("fingerprint"),
        as_text(F.col("edited_spots")).alias("edited_fingerprint"),
        pruned_jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"),
        pruned_jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"),
        partition_of(F.size("spots")).alias("size_partition"),
    )


def near_pairs(docs: DataFrame, threshold: float = FACTOR) -> DataFrame:
    """fingerprint_a, fingerprint_b, likeness of all pairs of different fingerprints (as text) as like as the threshold, at least FACTOR.

    Equal fingerprints are one, so copies make no pairs. A set's spots stand in
    the order of how many sets have them, rarest first: two sets as like as t
    share one of the first n - ceil(t n) + 1 of each. Only those are joined,
    within a size partition and its neighbour, and only where as much is left in
    both from the shared spot on as the likeness needs.
    """
    if threshold < FACTOR:
        raise ValueError(f"size partitions serve a likeness of {FACTOR} or more")
    sets = materialise(docs.select(spots(text_of()).alias("spots")).where(F.size("spots") > 0).distinct().withColumn("uid", F.monotonically_increasing_id()))
    all_spots = sets.select("uid", F.size("spots").alias("n"), F.explode("spots").alias("spot"))
    common = all_spots.groupBy("spot").agg(F.count("*").alias("often")).where("often > 1")
    order = Window.partitionBy("uid").orderBy(F.coalesce("often", F.lit(1)), "spot")
    placed = all_spots.join(common, "spot", "left").withColumn("left", F.col("n") - F.row_number().over(order) + 1)
    first = materialise(placed.where((F.col("left") >= F.col("n") * threshold - 1e-9) & F.col("often").isNotNull()).select("uid", "n", "left", partition_of(F.col("n")).alias("part"), "spot"))
    a = first.select(F.col("uid").alias("a"), F.col("n").alias("n_a"), F.col("left").alias("left_a"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), F.col("spot"), F.col("part").alias("own_a"))
    b = first.select(F.col("uid").alias("b"), F.col("n").alias("n_b"), F.col("left").alias("left_b"), F.col("part"), F.col("spot"))
    enough = F.least("left_a", "left_b") >= (F.col("n_a") + F.col("n_b")) * (threshold / (1 + threshold)) - 1e-9
    fits = enough & ((F.col("own_a") != F.col("part")) | (F.col("a") < F.col("b")))
    pairs = a.join(b, ["part", "spot"]).where(fits).select("a", "b").distinct()
    left = sets.select(F.col("uid").alias("a"), F.col("spots").alias("x"))
    right = sets.select(F.col("uid").alias("b"), F.col("spots").alias("y"))
    found = pairs.join(left, "a").join(right, "b").withColumn("likeness", pruned_jaccard(F.col("x"), F.col("y"), threshold))
    return found.where(F.col("likeness") >= threshold).select(as_text(F.col("x")).alias("fingerprint_a"), as_text(F.col("y")).alias("fingerprint_b"), "likeness")
