"""The registered queries of this subpackage and, where SQL can say the same, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortica.llm import bagminhash, bpe, centroids, chat, codes, hash_tree, mixing, ordinal, pii, ppm, rules, spotsigs, tokenfile
from cohortica.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER, END_ID = "byte_bpe_50k.json", 2


def op1_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), columns=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = ppm.is_held_out(F.col("doc_id"))
    out = ppm.score(docs, docs.where(~held_out))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards: three regions of two racks of four. Law `key`; a 25th shard opens a region of its own."""
    out = hash_tree.assign(table(spark, sf_dir, "documents"), shards=24, grown=25)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    return ordinal.classify(docs, model).select("doc_id", "expected_grade", "tail_probability", F.col("quality_kept").alias("kept"))


def op5_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts look like control strings of a template."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    out = chat.read_back(chat.format_windows(rows.unionByName(added)))
    joined = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = spotsigs.fingerprint_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "size_partition")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("quality")
    named = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *[q[k].alias(k) for k in named])


def op9_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_shingles")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256 if books else None).cast("string").alias("codebooks_sha256"))


def op12_screened_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_elias_fano_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfile.digests(spark, tokenfile.write_files(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), END_ID))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_weak_supervision_pii, op2_ppm, op3_hash_tree, op4_ordinal_quality, op5_chat_windows, op6_spotsigs, op7_mixing, op8_quality_rules, op9_bagminhash, op10_byte_bpe, op11_vector_codes, op12_screened_centroids, op13_elias_fano_ids)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_MIX_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(most, coalesce((SELECT min(level) FROM l AS x WHERE x.most / x.weight > x.level AND NOT EXISTS (SELECT 1 FROM l AS y WHERE y.most / y.weight > y.level AND (y.most / y.weight, coalesce(y.source, chr(1114111))) < (x.most / x.weight, coalesce(x.source, chr(1114111))))) * weight, most)) AS target FROM l),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0.0 ELSE t.target / t.source_size END AS rate,
  CAST('0x' || substr(md5('mix:17:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * CAST(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken FROM r
"""


def _rules_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in rules.STOP_WORDS)
    bounds = []
    for r in rules.RULES:
        value = f"(CAST({r.measure} AS DOUBLE) / nullif({r.per}, 0))" if r.per else r.measure
        bounds += [f"coalesce({value} >= {r.low}, true)"] * (r.low is not None) + [f"coalesce({value} <= {r.high}, true)"] * (r.high is not None)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT k, i, w[i:i + 4] AS five FROM (SELECT k, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
h AS (SELECT k, i, count(*) OVER (PARTITION BY k, five) AS n FROM g),
c AS (SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest(range(i, i + 5)) AS p FROM h WHERE n > 1) GROUP BY k),
l AS (SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(text, '[^!]+', '', 'g')) AS n_bangs,
  length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
  len(list_filter(w, lambda x: lower(rtrim(x, '.,;:!?')) IN ({stops}))) AS n_stop_words,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN c USING (k) LEFT JOIN l USING (k)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND {' AND '.join(bounds)} AS kept FROM f
"""


_FINITE = "len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)"


def _lloyd_sql(seeds: str, rounds: int) -> str:
    """Rounds b0, b1, ... of centres (p, e, c) for pieces x (id, p, v, label), then the last assignment a (id, p, e, d, label)."""
    near = lambda b: f"SELECT x.id, x.label, x.p, x.v, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(x.v, {b}.c)])::HUGEINT * 65536 + {b}.e) AS de FROM x JOIN {b} USING (p) GROUP BY ALL"
    out = [f"b0 AS MATERIALIZED ({seeds})"]
    for r in range(rounds):
        out.append(f"""n{r} AS MATERIALIZED ({near(f"b{r}")}),
s{r} AS (SELECT p, e, i, sum(y) AS s, count(*) AS n FROM (SELECT p, de % 65536 AS e, unnest(v) AS y, generate_subscripts(v, 1) AS i FROM n{r}) GROUP BY ALL),
m{r} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY p, e),
b{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (p, e))""")
    return ", ".join(out) + f", a AS MATERIALIZED (SELECT id, label, p, (de % 65536)::BIGINT AS e, (de // 65536)::BIGINT AS d FROM ({near(f'b{rounds}')}))"


_CODES_SQL = f"""
WITH k AS MATERIALIZED (SELECT vec_id, label, [floor(1024 * y::DOUBLE)::BIGINT for y in embedding] AS v FROM embeddings WHERE {_FINITE}),
x AS MATERIALIZED (SELECT vec_id AS id, label, p, v[1 + p * len(v) // 4 : (p + 1) * len(v) // 4] AS v FROM k, (SELECT unnest(range(4)) AS p)),
{_lloyd_sql("SELECT p, r AS e, v AS c FROM x JOIN (SELECT vec_id AS id, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM k) USING (id) WHERE r < 256", 4)},
w AS (SELECT id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a GROUP BY id, label)
SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM b4) AS codebooks_sha256 FROM w
"""

_CENTROIDS_SQL = f"""
WITH x AS MATERIALIZED (SELECT vec_id AS id, 0 AS label, 0 AS p, [floor(64 * y::DOUBLE)::BIGINT for y in embedding] AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}),
{_lloyd_sql("SELECT 0 AS p, row_number() OVER (ORDER BY h) - 1 AS e, v AS c FROM (SELECT v, sha256('1:' || id) AS h FROM x ORDER BY h LIMIT 16)", 3)}
SELECT id AS vec_id, e::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY e))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a JOIN b3 USING (p, e)
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_mixing": _MIX_SQL, "op8_quality_rules": _rules_sql(), "op11_vector_codes": _CODES_SQL, "op12_screened_centroids": _CENTROIDS_SQL}
