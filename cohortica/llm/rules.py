"""Quality rules: a table of thresholds compiled into one projection.

Lengths, symbols, repeated lines, repeated five-word windows, stop words and
letter case are measured with built-in functions only; each rule is a bound on
a measure or on a ratio of two, and the verdict is their conjunction.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortica.llm.common import WORD, let, text_of

#: Common words of English, French, German and Spanish.
STOP_WORDS = (
    "a all als an and are as at auf avec be but by con da das dans de del dem den der des die du ein eine el en er es est "
    "et für for from had has have he ich il im in is ist it la las le les los mit nicht not of on oder of para par pas por pour "
    "que qui se sich sie sont su sur that the this to un una und une von was were which with y you zu"
).split()


@dataclass(frozen=True)
class Rule:
    """name: of the rule. measure over `per` (or alone) must lie in [low, high]; a bound of None is open, an undefined ratio passes."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None


#: The production table.
RULES = (
    Rule("enough_words", "n_words", low=10),
    Rule("word_length_low", "word_chars", "n_words", low=2.0),
    Rule("word_length_high", "word_chars", "n_words", high=14.0),
    Rule("symbols", "n_symbols", "n_words", high=0.25),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", high=0.5),
    Rule("stop_words", "n_stop_words", "n_words", low=0.02),
    Rule("upper_case", "n_upper", "word_chars", high=0.4),
    Rule("shouting", "n_bangs", "n_words", high=0.3),
)


def repeated_window_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of `width` words that the text has twice or more.

    Linear but for one sort, and that only where some window repeats. Windows are
    told apart by a 64-bit hash.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: let(F.sort_array(F.transform(F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"])), lambda x: x["i"])), spans))

    def spans(starts: Column) -> Column:
        fresh = F.transform(starts, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(starts, k + 1) - p, F.lit(width))))
        return F.aggregate(fresh, F.lit(0), lambda acc, x: acc + x)

    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - width), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
    some = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(F.size(words) > width, some).otherwise(F.lit(0))


def measures(text: Column) -> Column:
    """A struct of the measures of a text (no null)."""

    def made(words: Column) -> Column:
        chars = F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))
        lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, r"[\x20\x09-\x0D]+", "")) > 0)
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            chars.cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            F.length(F.regexp_replace(text, r"[^!]+", "")).cast("long").alias("n_bangs"),
            F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
            F.size(F.filter(words, lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            repeated_window_words(words).cast("long").alias("n_repeat_words"),
        )

    return let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), made)


def compile_rules(rules: Sequence[Rule], measure: dict[str, Column]) -> Column:
    """One boolean expression of the whole table."""
    verdict = F.lit(True)
    for r in rules:
        value = measure[r.measure].cast("double")
        value = F.try_divide(value, measure[r.per].cast("double")) if r.per else value
        for bound in ([value >= F.lit(float(r.low))] if r.low is not None else []) + ([value <= F.lit(float(r.high))] if r.high is not None else []):
            verdict = verdict & F.coalesce(bound, F.lit(True))
    return verdict


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs with a struct column quality: the measures, base_failed and kept. No shuffle, no user function.

    A null text has no words and fails, like an empty one; nulls elsewhere are
    not looked at. Repeated rows are judged alike. A column named quality is
    replaced.
    """
    out = docs.withColumn("quality", measures(text_of()))
    q = F.col("quality")
    measure = {k: q[k] for k in ("n_words", "word_chars", "n_symbols", "n_bangs", "n_upper", "n_stop_words", "n_repeat_words")} | {"n_lines": q["lines"]["n"], "n_dup_lines": q["lines"]["dup"]}
    failed = (q["n_words"] < 10) | (q["n_repeat_words"] * 100 > q["n_words"] * 20)
    return out.withColumn("quality", F.struct(*[v.alias(k) for k, v in measure.items()], failed.alias("base_failed"), (~failed & compile_rules(rules, measure)).alias("kept")))
