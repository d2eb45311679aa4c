"""Quality rules: counted base rules, and a learned rule over hashed n-grams.

Method.  A text becomes its hashed counts of word uni- and bigrams and character tri- and
four-grams (``BUCKETS`` buckets, log counts, unit length).  A logistic regression (Spark's, which
sums gradients over the partitions) is trained on labelled rows, the rest of the labelled rows
calibrate its margins to probabilities (Platt's targets, again Spark's regression), and all texts
are scored in Arrow batches: kept are those that pass the base rules and whose probability of
quality reaches ``THRESHOLD``.

Training bound: at most about ``SAMPLE`` labelled doc_ids, drawn by a hash of the doc_id; of these
one in ``FOLDS`` calibrates.  A fifth of the documents (``common.held_out``) is never learned from.
The model is ``BUCKETS`` numbers, whatever the corpus; every row is counted and scored.

Defined cases: a null text counts as empty (no word, so the base rules fail); a doc_id labelled
twice counts with its best label, one with several rows with its smallest text; null labels and
null doc_ids are not learned from; without labels of both kinds nothing is learned and the base
rules alone decide (probability null); repeated rows each get their row; extra columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, stored, texts

BUCKETS = 1 << 16
#: Labelled doc_ids that the model is fitted and calibrated on.
SAMPLE = 5000
#: One of so many sampled doc_ids calibrates.
FOLDS = 5
RIDGE, ROUNDS = 1e-4, 60
#: Fixed thresholds of the verdict.
THRESHOLD, LEAST_WORDS, REPEAT_PERCENT = 0.5, 50, 50

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _numbered(values) -> np.ndarray:
    codes: dict = {}
    return np.fromiter((codes.setdefault(v, len(codes)) for v in values), np.int64)


def _repeat_words(words: list[bytes]) -> int:
    """Words that some 3-word window covers which occurs at least twice in the text."""
    if len(words) < 4:
        return 0
    code = _numbered(words)
    _, pair = np.unique(code[:-1] * (code.max() + 1) + code[1:], return_inverse=True)
    _, window, count = np.unique(pair[:-1] * (code.max() + 1) + code[2:], return_inverse=True,
                                 return_counts=True)
    again = count[window] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i:i + len(again)] |= again
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    """The counts of ``MEASURES``."""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), _repeat_words(words))


def _mixed(codes: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Buckets of all runs of ``n`` codes."""
    if len(codes) < n:
        return np.zeros(0, np.int64)
    mixed = np.full(len(codes) - n + 1, kind, np.uint64)
    for i in range(n):
        mixed = (mixed ^ codes[i:len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return (mixed >> np.uint64(20)).astype(np.int64) & (BUCKETS - 1)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(ascending buckets, weights): log counts of the hashed n-grams, scaled to unit length."""
    words = np.fromiter(map(zlib.crc32, text.encode().split()), np.uint64)
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    count = np.bincount(np.concatenate([_mixed(words, 1, 1), _mixed(words, 2, 2),
                                        _mixed(points, 3, 3), _mixed(points, 4, 4)]))
    found = np.flatnonzero(count)
    weight = np.log1p(count[found])
    return found, weight / max(np.sqrt(weight @ weight), 1e-12)


@dataclass(frozen=True)
class Model:
    """Weights of the buckets, and the line that calibrates a margin."""
    weights: np.ndarray
    constant: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, text: str) -> float:
        found, weight = features(text)
        return float(self.weights[found] @ weight) + self.constant

    def probability(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(text) + self.shift,
                                              -500, 500))))


def _sparse(text: Column) -> Column:
    """A text's features as arrays of buckets and weights."""
    @F.arrow_udf("struct<i:array<int>,v:array<double>>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = [features(t) for t in texts(column)]
            yield pa.StructArray.from_arrays(
                [pa.array([i.astype(np.int32) for i, _ in rows], pa.list_(pa.int32())),
                 pa.array([v for _, v in rows], pa.list_(pa.float64()))], ["i", "v"])
    return of(text)


def _margins(model: Model, text: Column) -> Column:
    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array([model.margin(t) for t in texts(column)], pa.float64())
    return of(text)


def sample(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> DataFrame:
    """(doc_id, text, y, calibrates) of about ``bound`` labelled doc_ids, or of all if fewer.

    The drawn doc_ids are at most about ``bound`` pairs of numbers, so they are broadcast.
    """
    best = (labels.filter("quality is not null and doc_id is not null")
            .filter(~held_out(F.col("doc_id"))).groupBy("doc_id")
            .agg((F.max("quality") > 0).cast("double").alias("y")))
    known = best.count()
    drawn = best.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
                        < int((1 << 30) * min(1.0, bound / max(1, known))))
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "y")
            .agg(F.min("text").alias("text"))
            .withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(FOLDS)) == 0))


def fit(rows: DataFrame) -> Model | None:
    """The calibrated model of sampled rows (doc_id, text, y, calibrates)."""
    rows = stored(rows, "labelled-texts")
    held = {(r.calibrates, r.y): r.n for r in
            rows.groupBy("calibrates", "y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not all(held.get((False, y)) for y in (0.0, 1.0)):
        return None
    as_vector = F.udf(lambda f: SparseVector(BUCKETS, f.i, f.v), VectorUDT())
    train = stored(rows.filter("not calibrates").select("y", _sparse(F.col("text")).alias("f")),
                   "ngrams").select("y", as_vector("f").alias("x"))
    fitted = LogisticRegression(featuresCol="x", labelCol="y", regParam=RIDGE, maxIter=ROUNDS,
                                standardization=False).fit(train)
    model = Model(fitted.coefficients.toArray(), float(fitted.intercept))
    if not all(held.get((True, y)) for y in (0.0, 1.0)):
        return model
    good, bad = held[True, 1.0], held[True, 0.0]
    target = F.when(F.col("y") == 1, (good + 1) / (good + 2)).otherwise(1 / (bad + 2))
    dense = F.udf(lambda m: DenseVector([m]), VectorUDT())
    margins = stored(rows.filter("calibrates").select(
        _margins(model, F.col("text")).alias("m"), target.alias("t")), "margins")
    weighted = margins.select(dense("m").alias("x"), F.inline(F.array(
        F.struct(F.lit(1.0).alias("y"), F.col("t").alias("w")),
        F.struct(F.lit(0.0).alias("y"), (1 - F.col("t")).alias("w")))))
    line = LogisticRegression(featuresCol="x", labelCol="y", weightCol="w").fit(weighted)
    return Model(model.weights, model.constant, float(line.coefficients[0]), float(line.intercept))


def measured(text: Column, model: Model | None) -> Column:
    """Struct of ``MEASURES`` and the probability of quality, in one pass over the text."""
    @F.arrow_udf(f"struct<{','.join(f'{m}:bigint' for m in MEASURES)},probability:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            strings = texts(column)
            counts = np.array([measures(t) for t in strings], np.int64).reshape(-1, len(MEASURES))
            score = [None if model is None else model.probability(t) for t in strings]
            yield pa.StructArray.from_arrays(
                [*(pa.array(c) for c in counts.T), pa.array(score, pa.float64())],
                [*MEASURES, "probability"])
    return of(text)


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, measures, base_failed, kept, probability) for every row of ``docs``."""
    model = fit(sample(docs, labels))
    found = docs.select("doc_id", measured(F.col("text"), model).alias("m")).select("doc_id", "m.*")
    failed = ((F.col("n_words") < LEAST_WORDS)
              | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    learned = F.coalesce(F.col("probability") >= threshold, F.lit(True))
    return found.select("doc_id", *MEASURES, failed.alias("base_failed"),
                        (~failed & learned).alias("kept"), "probability")
