"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - w.x): one weight vector over hashed words
and bucketed measures of the text, shared by all grades, and ordered thresholds.
The score w.x gives the expected grade and the tail probability P(grade >= g),
by which documents are kept.

Grades: 0 bad quality, 1 good quality but toxic, 2 good quality and not toxic.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortica.llm.common import materialise, slices, texts_of, tidy

#: Hash buckets for words.
BITS = 20
#: The model is fitted on so many labelled documents at most, those least by a hash of the id, and on so many characters of text.
SAMPLE_ROWS, SAMPLE_CHARS = 12_000, 48_000_000
GRADES = 3
#: Penalties on weights and on thresholds (which holds them where a grade has no rows), and in how many rows of the sample a bucket must occur.
L1, RIDGE, LEAST_ROWS = 1e-3, 1e-5, 4
#: The fit ends where no slope is further than this from that of an optimum, or after so many rounds of so many steps at most.
TOLERANCE, ROUNDS, STEPS = 2e-5, 60, 200

#: Bytes of text that a task holds as Python values at once.
PART_BYTES = 1 << 20

_STRIP = ".,;:!?\"'()[]|#*$%&"


def grade(quality: Column, toxic: Column) -> Column:
    """The graded rating; null (not rated) if quality is null. A null toxic counts as 0."""
    return F.when(quality == 0, 0).when(quality == 1, F.when(F.coalesce(toxic, F.lit(0)) == 1, 1).otherwise(2))


def features(text: str) -> np.ndarray:
    """Buckets that the text has something in: its words, and how high its measures are."""
    words = text.split()
    n = max(1, len(words))
    seen = Counter(words)
    chars = max(1, len(text))
    symbols = sum(map(text.count, "#*$%&|<>!"))
    lines = [x for x in text.split("\n") if x.strip()]
    measures = {
        "symbols": 20 * symbols / n,
        "upper": 10 * sum(map(len, re.findall("[A-ZÀ-Þ]+", text))) / chars,
        "repeat": 10 * (1 - len(seen) / n),
        "most": 10 * max(seen.values(), default=0) / n,
        "lines": 10 * (1 - len(set(lines)) / max(1, len(lines))),
        "length": np.log2(n),
        "word": chars / n / 2,
        "digits": 20 * sum(map(len, re.findall("[0-9]+", text))) / chars,
    }
    named = {f"\0{k}:{j}" for k, v in measures.items() for j in range(int(min(v, 20)) + 1)}
    named.update(w.strip(_STRIP).lower() for w in seen)
    return np.unique(np.fromiter((zlib.crc32(x.encode()) >> (32 - BITS) for x in named), np.int64, len(named)))


class OrdinalModel:
    """thresholds: ordered, one fewer than grades. buckets and weights: those that aren't 0."""

    def __init__(self, thresholds: np.ndarray, buckets: np.ndarray, weights: np.ndarray):
        self.thresholds = thresholds
        self.dense = np.zeros(1 << BITS, np.float32)
        self.dense[np.asarray(buckets, np.int64)] = weights

    def tails(self, texts: list[str]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each text."""
        score = np.array([self.dense[features(t)].sum(dtype=np.float64) for t in texts])
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def _parts(grades: np.ndarray, score: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: its probability, the slopes of the upper and lower sigmoid over it, and those sigmoids."""
    full = np.concatenate([[-np.inf], th, [np.inf]])
    up, low = _sigmoid(full[grades + 1] - score), _sigmoid(full[grades] - score)
    p = np.maximum(up - low, 1e-12)
    return p, up * (1 - up) / p, low * (1 - low) / p, up, low


def loss(rows: list[np.ndarray], grades: np.ndarray, th: np.ndarray, w: np.ndarray) -> float:
    """What fit() minimises; w: over all buckets."""
    score = np.array([w[x].sum() for x in rows])
    return float(-(row_weights(grades) * np.log(_parts(grades, score, th)[0])).sum() + L1 * np.abs(w).sum() + RIDGE / 2 * (th**2).sum())


def row_weights(grades: np.ndarray) -> np.ndarray:
    """Rows weigh by one over the root of how common their grade is, one in all."""
    weight = 1 / np.sqrt((np.bincount(grades, minlength=GRADES) / len(grades))[grades])
    return weight / weight.sum()


def _ordered(th: np.ndarray, gap: float = 1e-6) -> np.ndarray:
    """Thresholds that are out of order meet in their mean, a gap apart."""
    if (np.diff(th) >= gap).all():
        return th
    blocks = [[x - gap * i] for i, x in enumerate(th)]
    while any(np.mean(a) > np.mean(b) for a, b in zip(blocks, blocks[1:], strict=False)):
        i = next(i for i in range(len(blocks) - 1) if np.mean(blocks[i]) > np.mean(blocks[i + 1]))
        blocks[i : i + 2] = [blocks[i] + blocks[i + 1]]
    return np.concatenate([np.full(len(b), np.mean(b)) for b in blocks]) + gap * np.arange(len(th))


def _better_thresholds(grades: np.ndarray, weight: np.ndarray, score: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, float]:
    """One Newton step on the thresholds, halved until the loss doesn't rise; and how far a gradient step would go."""
    at = lambda t: -(weight * np.log(_parts(grades, score, t)[0])).sum() + RIDGE / 2 * (t**2).sum()
    p, d_up, d_low, up, low = _parts(grades, score, th)
    k = len(th)
    # row by row: slope and curvature of -log p by the threshold above and the one below the grade
    slope = RIDGE * th - np.bincount(grades, weight * d_up, k + 1)[:k] + np.bincount(grades, weight * d_low, k + 1)[1:]
    bend = np.diag(RIDGE + np.bincount(grades, weight * d_up * (d_up - 1 + 2 * up), k + 1)[:k] + np.bincount(grades, weight * d_low * (d_low + 1 - 2 * low), k + 1)[1:])
    across = np.bincount(grades, weight * d_up * d_low, k + 1)
    for i in range(k - 1):
        bend[i, i + 1] = bend[i + 1, i] = -across[i + 1]
    far = float(np.abs(_ordered(th - slope) - th).max(initial=0.0))
    bend += 1e-9 * np.eye(k)
    # thresholds that would pass each other meet and move as one
    group = np.concatenate([[0], np.cumsum(np.diff(th - np.linalg.solve(bend, slope)) > 0)]).astype(int)
    one = (group[:, None] == np.arange(group[-1] + 1)).astype(float)
    target = _ordered(one @ ((one.T @ th) / one.sum(axis=0) - np.linalg.solve(one.T @ bend @ one, one.T @ slope)))
    step, now = target - th, at(th)
    for _ in range(30):
        if at(th + step) <= now:
            return th + step, far
        step = step / 2
    return th, far


def fit(rows: list[np.ndarray], grades: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Thresholds, buckets, weights that minimise the mean log loss with an L1 penalty on weights: see loss().

    The loss is convex in all of them. Each round takes the buckets whose weight
    isn't 0 or whose slope could move it, and takes proximal gradient steps with
    momentum on those weights and Newton steps on the thresholds.
    """
    n = len(rows)
    often = np.bincount(np.concatenate(rows), minlength=1 << BITS) >= LEAST_ROWS
    rows = [x[often[x]] for x in rows]
    used, col = np.unique(np.concatenate(rows), return_inverse=True)
    length = np.fromiter(map(len, rows), np.int64, n)
    row = np.repeat(np.arange(n), length)
    weight = row_weights(grades)
    w, th = np.zeros(len(used)), _ordered(np.linspace(-0.7, 0.7, GRADES - 1))
    for _ in range(ROUNDS):
        score = np.bincount(row, w[col], minlength=n)
        for _ in range(20):
            th, far = _better_thresholds(grades, weight, score, th)
            if far <= TOLERANCE / 10:
                break
        slope = _slopes(grades, weight, score, th, row, col, len(used))
        off = np.where(w != 0, np.abs(slope + L1 * np.sign(w)), np.maximum(np.abs(slope) - L1, 0))
        if max(far, off.max(initial=0.0)) <= TOLERANCE:
            break
        live = np.flatnonzero((w != 0) | (np.abs(slope) > 0.9 * L1))
        place = np.full(len(used), -1)
        place[live] = np.arange(len(live))
        mine = place[col] >= 0
        w[live], th = _descend(grades, weight, row[mine], place[col[mine]], w[live], th)
    kept = w != 0
    return th, used[kept], w[kept]


def _slopes(grades: np.ndarray, weight: np.ndarray, score: np.ndarray, th: np.ndarray, row: np.ndarray, col: np.ndarray, k: int) -> np.ndarray:
    """Of the log loss by each weight."""
    _, d_up, d_low, _, _ = _parts(grades, score, th)
    return np.bincount(col, (weight * (d_up - d_low))[row], minlength=k)


def _descend(grades: np.ndarray, weight: np.ndarray, row: np.ndarray, col: np.ndarray, w: np.ndarray, th: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """STEPS steps on these weights and on the thresholds, fewer where nothing is left to gain."""
    # each bucket's own step: a row's curvature is 1/2 at most, shared by all that it has
    curve = np.bincount(col, (weight * np.bincount(row, minlength=len(grades)))[row], minlength=len(w)) * 0.5 + 1e-9
    n, last, ahead, t = len(grades), w, w, 1.0
    for k in range(STEPS):
        score = np.bincount(row, ahead[col], minlength=n)
        if k % 4 == 0:
            th, far = _better_thresholds(grades, weight, score, th)
        w = ahead - _slopes(grades, weight, score, th, row, col, len(w)) / curve
        w = np.sign(w) * np.maximum(np.abs(w) - L1 / curve, 0)
        if max(far, np.abs((w - ahead) * curve).max(initial=0.0)) <= TOLERANCE / 4:
            break
        if ((ahead - w) * curve * (w - last)).sum() > 0:  # momentum starts anew where it has gone too far
            t = 1.0
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, last, t = w + (t - 1) / t_next * (w - last), w, t_next
    return w, th


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def train(docs: DataFrame, labels: DataFrame) -> OrdinalModel | None:
    """Fits on a bounded sample of the rated documents, in one task; None if nothing is rated, an error if none of it fits the sample.

    A document that is rated several times counts with each of its different
    ratings, rows of docs that are equal count once. Null texts are empty, null
    ids match nothing.
    """
    rated = labels.select("doc_id", grade(F.col("quality"), F.col("toxic")).alias("grade")).where("doc_id is not null and grade is not null")
    # the sample is taken from the ids, before any text is moved
    chosen = materialise(rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(SAMPLE_ROWS))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    # of rows that are equal one counts; ids that repeat with different texts are cut off at a few times the sample
    sizes = texts.select("doc_id", "grade", F.length("text").alias("chars"), F.xxhash64("text").alias("hash")).where(F.col("chars") <= SAMPLE_CHARS).distinct()
    sizes = sizes.orderBy(F.xxhash64("doc_id"), "doc_id", "grade", "hash").limit(4 * SAMPLE_ROWS)
    most_rows, most_chars = SAMPLE_ROWS, SAMPLE_CHARS

    def fitting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chars = 0
        for b in batches:
            mine = []
            for n in b.column("chars").to_pylist():  # a text that doesn't fit is passed over
                mine.append(rows < most_rows and chars + n <= most_chars)
                rows, chars = rows + mine[-1], chars + n * mine[-1]
            yield b.select(["doc_id", "hash"]).filter(pa.array(mine, pa.bool_()))

    ids = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("hash", T.LongType())])
    room = materialise(sizes.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "grade", "hash").mapInArrow(fitting, ids).distinct())
    named = texts.withColumn("hash", F.xxhash64("text"))
    sample = named.join(F.broadcast(room), ["doc_id", "hash"], "left_semi").groupBy("doc_id", "hash", "grade").agg(F.min("text").alias("text")).select("text", "grade")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, PART_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([features(t) for t in texts_of(b)], pa.list_(pa.int64())), b.column("grade")], ["x", "grade"])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, grades = [], []
        for b in batches:
            rows += [x.values.to_numpy() if x is not None else np.zeros(0, np.int64) for x in b.column("x")]
            grades += b.column("grade").to_pylist()
        if rows:
            by_content = sorted(range(len(rows)), key=lambda i: (len(rows[i]), rows[i].tobytes(), grades[i]))  # whatever the order of the partitions
            th, used, w = fit([rows[i] for i in by_content], np.array(grades)[by_content])
            yield pa.RecordBatch.from_arrays([pa.array([th], pa.list_(pa.float64())), pa.array([used], pa.list_(pa.int64())), pa.array([w], pa.list_(pa.float64()))], ["th", "used", "w"])

    made = sample.mapInArrow(tidy(extract), "x array<long>, grade int").repartition(1).mapInArrow(tidy(fitted), "th array<double>, used array<long>, w array<double>").collect()
    if not made and not docs.join(rated, "doc_id", "left_semi").isEmpty():
        raise ValueError("documents are rated, but none of them is in the sample")
    return OrdinalModel(*[np.array(c) for c in made[0]]) if made else None


def classify(docs: DataFrame, model: OrdinalModel | None, keep_grade: int = 2, at_least: float = 0.5) -> DataFrame:
    """docs with expected_grade, tail_probability (of keep_grade or better) and quality_kept.

    Null and empty texts are judged by their measures alone. Without a model
    everything is kept, with null scores. Nulls elsewhere, repeated rows and
    further columns pass through; columns named as the new ones are replaced.
    """
    named = ["expected_grade", "tail_probability", "quality_kept"]
    kept = docs.drop(*named)
    if model is None:
        return kept.withColumns({named[0]: F.lit(None).cast("double"), named[1]: F.lit(None).cast("double"), named[2]: F.lit(True)})
    thresholds, weights = model.thresholds, np.flatnonzero(model.dense)
    sent = docs.sparkSession.sparkContext.broadcast((thresholds, weights, model.dense[weights]))  # 2**BITS weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = OrdinalModel(*sent.value)
        for b in slices(batches, PART_BYTES):
            tails = m.tails(texts_of(b))
            tail = tails[:, keep_grade - 1] if len(tails) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= at_least)], [*b.schema.names, *named])

    added = [T.StructField(named[0], T.DoubleType()), T.StructField(named[1], T.DoubleType()), T.StructField(named[2], T.BooleanType())]
    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, *added]))
