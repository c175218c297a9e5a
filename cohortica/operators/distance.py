"""Distances of all pairs of rows or of drawn ones, and what their distribution says."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortica import config

METHODS = ("euclidean", "manhattan", "gower")


def sample_rows(df: DataFrame, key: str, rows: int = config.SETTINGS.sample_rows, seed: int = config.SETTINGS.seed) -> DataFrame:
    """The rows whose key has the least hashes: the same ones in each run, by a top-k without a sort of the table."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(rows)


#: So many terms of a sum are written out, which compiles to one loop-free expression; more would make a method too long to be compiled.
WRITTEN_OUT = 16


def _distance(method: str, n: int, a: Column, b: Column) -> Column:
    """Of two arrays of n numbers each."""
    term = lambda x, y: (x - y) * (x - y) if method == "euclidean" else F.abs(x - y)
    if n <= WRITTEN_OUT:
        total = reduce(lambda s, i: s + term(a[i], b[i]), range(n), F.lit(0.0))
    else:
        total = F.aggregate(F.zip_with(a, b, term), F.lit(0.0), lambda s, t: s + t)
    return F.sqrt(total) if method == "euclidean" else total / n if method == "gower" else total


#: Rows of a block at most, on average: a task of pairwise_many holds two blocks, whatever the table's size.
BLOCK_ROWS, LEAST_BLOCKS = 2048, 8


def pairwise_many(df: DataFrame, key: str, columns: list[str], methods: tuple[str, ...] = METHODS) -> DataFrame:
    """id_a < id_b and a column for each method. Numeric columns without nulls, scaled by the caller but for gower, which divides by each column's range.

    Every pair is the answer here, so the work is quadratic; rows are dealt to blocks
    of bounded size and blocks meet by an equality join, so that a task holds two
    blocks of rows, and tasks grow in number, not in size.
    """
    if unknown := set(methods) - set(METHODS):
        raise ValueError(f"unknown distance: {', '.join(sorted(unknown))}")
    x, n = F.array(*[F.col(c).cast("double") for c in columns]), len(columns)
    n_blocks = max(LEAST_BLOCKS, -(-df.count() // BLOCK_ROWS))
    by_range = F.lit(None).cast("array<double>")
    if "gower" in methods:
        r = df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(f"__r_{c}") for c in columns])
        df = df.join(F.broadcast(r))
        by_range = F.array(*[F.coalesce(F.try_divide(F.col(c).cast("double"), F.nullif(F.col(f"__r_{c}"), F.lit(0.0))), F.lit(0.0)) for c in columns])
    points = df.select(F.col(key).alias("id"), x.alias("x"), by_range.alias("g"), F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block"))
    blocks = F.sequence(F.lit(0), F.lit(n_blocks - 1))
    # each row goes once to each block it has to meet, under the pair of blocks as key
    left = points.select(F.col("id").alias("id_a"), F.col("x").alias("xa"), F.col("g").alias("ga"), F.col("block").alias("i"), F.explode(blocks).alias("j"))
    right = points.select(F.col("id").alias("id_b"), F.col("x").alias("xb"), F.col("g").alias("gb"), F.explode(blocks).alias("i"), F.col("block").alias("j"))
    made = [_distance(m, n, *((F.col("ga"), F.col("gb")) if m == "gower" else (F.col("xa"), F.col("xb")))).alias(m) for m in methods]
    # a fixed number of tasks: what is shuffled is small, so adaptive execution would put the quadratic work into one
    left, right = (side.repartition(n_blocks**2, "i", "j") for side in (left, right))
    return left.join(right, ["i", "j"]).where(F.col("id_a") < F.col("id_b")).select("id_a", "id_b", *made)


def pairwise(df: DataFrame, key: str, columns: list[str], method: str = "euclidean") -> DataFrame:
    """id_a < id_b, d: one method of pairwise_many."""
    return pairwise_many(df, key, columns, (method,)).withColumnRenamed(method, "d")


def _pair_of(p: Column) -> tuple[Column, Column]:
    """i < j of pair number p, where pair (i, j) has number j * (j - 1) / 2 + i; exact beyond what a root in doubles gives."""
    half = lambda j: F.shiftright(j * (j - 1), 1)
    near = F.floor((1 + F.sqrt(1 + 8 * p.cast("double"))) / 2).cast("long")
    j = F.when(half(near) > p, near - 1).when(half(near + 1) <= p, near + 1).otherwise(near)
    return p - half(j), j


def draw_pairs(df: DataFrame, key: str, pairs: int = config.SETTINGS.sample_pairs, seed: int = config.SETTINGS.seed) -> DataFrame:
    """i < j: numbers (from 0, in order of key) of at most `pairs` different pairs of rows, each as likely as the other; all pairs if there are no more.

    Pair numbers are hashes and are turned into (i, j): the work follows the number of
    pairs drawn, not that of all. The same for every use with the same seed and rows.
    """
    spark, n = df.sparkSession, df.count()
    total = n * (n - 1) // 2
    digits = lambda x: F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), x.cast("string"))), 1, 15), 16, 10).cast("long")
    if total <= pairs:
        numbers = spark.range(total).select(F.col("id").alias("p"))
    elif total < 4 * pairs:  # most draws would repeat: the pairs of the least hashes
        numbers = spark.range(total).orderBy(digits(F.col("id")), "id").limit(pairs).select(F.col("id").alias("p"))
    else:  # of twice as many draws, the first that differ; fewer than half can repeat
        numbers = spark.range(2 * pairs).select(F.col("id"), F.pmod(digits(F.col("id")), F.lit(total)).alias("p")).groupBy("p").agg(F.min("id").alias("first")).orderBy("first").limit(pairs).select("p")
    i, j = _pair_of(F.col("p"))
    return numbers.select(i.alias("i"), j.alias("j"))


def sample_pairs(df: DataFrame, key: str, columns: list[str], methods: tuple[str, ...] = METHODS, nominal: list[str] | None = None, pairs: int = config.SETTINGS.sample_pairs, seed: int = config.SETTINGS.seed) -> DataFrame:
    """id_a < id_b and a column for each method (METHODS, or mixed) of drawn pairs of rows, the same pairs for every method.

    Rows get gapless numbers in order of key (unique); those that a pair names are
    found by a broadcast of the drawn numbers, which the argument bounds, and only
    they are shuffled. mixed: Gower's distance over columns and nominal ones, see mixed_gower.
    """
    from cohortica.operators.numbering import number_rows

    drawn = draw_pairs(df, key, pairs, seed)
    named = nominal or []
    numbered = number_rows(df.select(F.col(key).alias("id"), F.struct(*[F.col(c).cast("double").alias(c) for c in columns], *named).alias("row")), "id", name="number", first=0)
    wanted = drawn.select(F.explode(F.array("i", "j")).alias("number")).distinct()
    rows = numbered.join(F.broadcast(wanted), "number")
    side = lambda n, e: rows.select(F.col("number").alias(n), F.col("id").alias(f"id_{e}"), F.col("row").alias(e))
    met = drawn.join(side("i", "a"), "i").join(side("j", "b"), "j")
    r = df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(c) for c in columns]).first()
    ranges = {c: float(r[c] or 0.0) for c in columns}
    array = lambda e, by: F.array(*[F.col(e)[c] / (by[c] or 1.0) * float(by[c] != 0) for c in columns])
    one = dict.fromkeys(columns, 1.0)
    made = {m: mixed_gower(F.col("a"), F.col("b"), ranges, named) if m == "mixed" else _distance(m, len(columns), array("a", ranges if m == "gower" else one), array("b", ranges if m == "gower" else one)) for m in methods}
    return met.select("id_a", "id_b", *[d.alias(m) for m, d in made.items()])


def mixed_gower(a: Column, b: Column, ranges: dict[str, float], nominal: list[str]) -> Column:
    """Gower's distance of two structs: |a - b| / range of numeric fields, 0 or 1 of nominal ones, averaged over the fields that count.

    A field counts if both have it, and a numeric one only if its range isn't 0. Null if none counts.
    """
    numeric = {c: r for c, r in ranges.items() if r}
    both = {c: a[c].isNotNull() & b[c].isNotNull() for c in [*numeric, *nominal]}
    term = {c: F.abs(a[c] - b[c]) / r for c, r in numeric.items()} | {c: (a[c] != b[c]).cast("double") for c in nominal}
    total = reduce(lambda s, c: s + F.when(both[c], term[c]).otherwise(0.0), both, F.lit(0.0))
    weight = reduce(lambda s, c: s + both[c].cast("int"), both, F.lit(0))
    return F.try_divide(total, weight.cast("double"))


#: A bin ends where the next begins, at values so many times in a factor of e; so no task sorts or merges all values.
BINS = 1024


def _bin(d: Column) -> Column:
    """Grows with a distance, by that alone: no bounds are looked for first. A factor of 1000 has 7,000 bins, all doubles 1.5 million."""
    return F.when(d > 0, F.floor(F.ln(d) * BINS)).otherwise(-(1 << 20)).alias("bin")


def _before(counted: Column, *group: str) -> Column:
    """How many stand in the bins before this one; a row for each bin."""
    return F.coalesce(F.sum(counted).over(Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def distance_distribution(pairs: DataFrame, *keys: str) -> DataFrame:
    """Number, seven-number summary, coefficient of variation and relative contrast, for each of keys or over all. d: no nulls, none below 0.

    Quartiles are exact and interpolate as percentile() does. Pairs are looked
    at twice, to count bins and to take the values of those that the quartiles
    fall into, and no more than that is shuffled.
    """
    named = lambda c: F.nullif(c, F.lit(0.0))
    quartiles = {"first_quartile": 0.25, "median": 0.5, "third_quartile": 0.75}
    rows = pairs.select((F.struct(*keys) if keys else F.lit(0)).alias("group"), "d", _bin(F.col("d")))
    bins = rows.groupBy("group", "bin").agg(F.count("*").alias("inside"), F.min("d").alias("low"), F.max("d").alias("high"), F.avg("d").alias("centre"), F.var_pop("d").alias("variance"))
    of_group = Window.partitionBy("group")
    bins = bins.withColumn("before", _before(F.col("inside"), "group")).withColumn("n_pairs", F.sum("inside").over(of_group)).withColumn("mean", F.sum(F.col("centre") * F.col("inside")).over(of_group) / F.col("n_pairs"))
    off = F.col("centre") - F.col("mean")
    squares = F.sum(F.col("inside") * (F.col("variance") + off * off))
    whole = bins.groupBy("group").agg(F.sum("inside").alias("n_pairs"), F.min("low").alias("minimum"), F.max("high").alias("maximum"), F.first("mean").alias("mean"), F.sqrt(F.try_divide(squares, (F.sum("inside") - 1).cast("double"))).alias("standard_deviation"))
    place = {q: (F.col("n_pairs") - 1) * p for q, p in quartiles.items()}
    ends = {f"{q}_{e}": f(x) for q, x in place.items() for e, f in (("low", F.floor), ("high", F.ceil))}
    holds = lambda at, first, n: (at >= first) & (at < first + n)
    wanted = bins.where(reduce(lambda x, y: x | y, [holds(at, F.col("before"), F.col("inside")) for at in ends.values()]))
    # six bins of a group at most are wanted; equal values become one row before they meet
    met = rows.join(F.broadcast(wanted.select("group", "bin", "before", "n_pairs")), ["group", "bin"]).groupBy("group", "bin", "before", "n_pairs", "d").agg(F.count("*").alias("n"))
    first = F.col("before") + F.sum("n").over(Window.partitionBy("group", "bin").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    found = met.withColumn("first", first).groupBy("group").agg(*[F.max(F.when(holds(at, F.col("first"), F.col("n")), F.col("d"))).alias(e) for e, at in ends.items()])
    between = lambda q: F.when(F.col(f"{q}_low") == F.col(f"{q}_high"), F.col(f"{q}_low")).otherwise((F.ceil(place[q]) - place[q]) * F.col(f"{q}_low") + (place[q] - F.floor(place[q])) * F.col(f"{q}_high"))
    out = whole.join(found, "group")
    if not keys:  # one row over all, also where there is no pair
        out = pairs.sparkSession.range(1).select(F.col("id").cast("int").alias("group")).join(out, "group", "left").withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0)))
    out = out.select(*[F.col("group")[k].alias(k) for k in keys], "n_pairs", "minimum", *[between(q).alias(q) for q in quartiles], "mean", "maximum", "standard_deviation")
    return out.withColumn("coefficient_of_variation", F.col("standard_deviation") / named(F.col("mean"))).withColumn("relative_contrast", (F.col("maximum") - F.col("minimum")) / named(F.col("maximum")))


def middle_ranks(values: DataFrame) -> DataFrame:
    """d, rank of distances without nulls, one row for each different value; equal ones share the mean of their ranks."""
    counted = values.groupBy("d").agg(F.count("*").alias("n")).withColumn("bin", _bin(F.col("d")))
    bins = counted.groupBy("bin").agg(F.sum("n").alias("inside"))
    upto = F.sum("n").over(Window.partitionBy("bin").orderBy("d").rowsBetween(Window.unboundedPreceding, 0))
    return counted.join(F.broadcast(bins.select("bin", _before(F.col("inside")).alias("before"))), "bin").select("d", (F.col("before") + upto - (F.col("n") - 1) / 2).alias("rank"))


def distance_correlation(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """pearson, spearman of two columns of the same pairs (pairwise_many); ranks average ties."""
    both = pairs.select(F.col(a).alias("x"), F.col(b).alias("y"))
    ranks = lambda c: middle_ranks(both.select(F.col(c).alias("d"))).select(F.col("d").alias(c), F.col("rank").alias(f"r{c}"))
    return both.join(ranks("x"), "x").join(ranks("y"), "y").agg(F.corr("x", "y").alias("pearson"), F.corr("rx", "ry").alias("spearman"), F.count("*").alias("n_pairs"))


def all_correlations(pairs: DataFrame, methods: tuple[str, ...]) -> DataFrame:
    """method_1, method_2, pearson, n_pairs of every two methods, in one pass."""
    two = list(combinations(sorted(methods), 2))
    wide = pairs.agg(F.count("*").alias("n"), *[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(two)])
    return wide.select("n", F.explode(F.array(*[F.struct(F.lit(a).alias("method_1"), F.lit(b).alias("method_2"), F.col(f"c{i}").alias("pearson")) for i, (a, b) in enumerate(two)])).alias("v")).select("v.*", F.col("n").alias("n_pairs"))
