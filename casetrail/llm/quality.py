"""Quality scores from document statistics.

Every text is reduced to a fixed list of statistics (``STATISTICS``).  Random Fourier features
approximate a Gaussian kernel over the standardised statistics; each partition adds up its
normal equations, Spark sums them, and the driver solves one small system (``FEATURES`` wide).
Isotonic calibration maps the ridge scores to label frequencies: scores are counted in fixed
narrow bins over all labelled rows, and pool-adjacent-violators runs over the bins.

Defined cases: a null text counts as empty; an empty text gets the score of its statistics;
labels that are null or whose document is held out are not learned from; a document that is
labelled twice counts with its best label; without labels every score is 0.5; repeated rows
each get their row; a null doc_id counts as held out; extra columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, stored, texts

FEATURES, SEED, RIDGE = 128, 7, 1e-3
#: Bins of raw scores between -0.5 and 1.5.
BINS, LOW, HIGH = 1000, -0.5, 1.5
THRESHOLD = 0.3

_MARKS = "|!#$%&*,.;:?\"'()<>/=@_-+"
STATISTICS = (["log_chars", "log_words", "word_length", "word_length_spread", "long_words",
               "upper", "digit", "space", "non_ascii", "other_ascii", "distinct_words", "top_word",
               "repeated_next", "distinct_pairs", "log_lines", "distinct_lines", "log_line_length",
               "mark_words", "capital_words"] + [f"mark_{ord(c)}" for c in _MARKS])


def statistics(text: str) -> list[float]:
    data = text.encode()
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n = max(1, len(data))
    words = data.split()
    m = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = [line for line in data.split(b"\n") if line.strip()]
    marked = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    order = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
    pairs = order[:-1] * len(codes) + order[1:]
    return [
        np.log1p(len(data)), np.log1p(len(words)), lengths.mean(), lengths.std(),
        (lengths > 20).mean(), count[65:91].sum() / n, count[48:58].sum() / n,
        (count[32] + count[9:14].sum()) / n, count[128:].sum() / n, marked / n,
        len(codes) / m, np.bincount(order).max() / m if words else 0.0,
        (order[1:] == order[:-1]).mean() if m > 1 else 0.0,
        len(np.unique(pairs)) / m if m > 1 else 1.0,
        np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)),
        np.log1p(len(data) / max(1, len(lines))),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / m,
        sum(w[:1].isupper() for w in words) / m,
        *(float(count[ord(c)]) / n for c in _MARKS)]


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = np.array([statistics(t) for t in texts(column)], float)
            rows = rows.reshape(-1, len(STATISTICS))
            offsets = np.arange(0, rows.size + 1, len(STATISTICS), dtype=np.int32)
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel()))
    return of(text)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    levels: np.ndarray

    def features(self, rows: np.ndarray) -> np.ndarray:
        return features((rows - self.centre) / self.scale)

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return self.features(rows) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(rows), self.steps, self.levels), 0, 1)


def features(rows: np.ndarray) -> np.ndarray:
    """Cosines of random projections of standardised rows, and a constant."""
    rng = np.random.default_rng(SEED)
    width = rows.shape[1]
    directions = rng.normal(0, 1 / np.sqrt(width), (width, FEATURES - 1))
    phases = rng.uniform(0, 2 * np.pi, FEATURES - 1)
    waves = np.cos(np.clip(rows, -8, 8) @ directions + phases) * np.sqrt(2 / FEATURES)
    return np.hstack([waves, np.ones((len(rows), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(STATISTICS))


def pool(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Isotonic fit: the non-decreasing sequence nearest to ``values`` under ``counts``."""
    blocks: list[list[float]] = []
    for v, c in zip(values, counts):
        blocks.append([v, c, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, c2, n2 = blocks.pop()
            v1, c1, n1 = blocks.pop()
            blocks.append([(v1 * c1 + v2 * c2) / (c1 + c2), c1 + c2, n1 + n2])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def labelled(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """(stats, y) of the documents that a model may learn from."""
    best = (labels.filter("quality is not null and doc_id is not null").groupBy("doc_id")
            .agg(F.max("quality").cast("double").alias("y")))
    return measured.filter(~held_out(F.col("doc_id"))).join(best, "doc_id").select("stats", "y")


def fit(train: DataFrame) -> Model | None:
    """Ridge regression on the random features of (stats, y), then calibration."""
    train = stored(train, "labelled")
    width = len(STATISTICS)
    moments = train.agg(F.count(F.lit(1)).alias("n"),
                        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(width)],
                        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(width)]
                        ).first()
    if not moments.n:
        return None
    centre = np.array([moments[f"m{i}"] for i in range(width)])
    scale = np.array([moments[f"s{i}"] for i in range(width)])
    scale[scale < 1e-9] = 1.0
    half = np.triu_indices(FEATURES)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((FEATURES, FEATURES)), np.zeros(FEATURES)
        for batch in batches:
            z = features((_matrix(batch.column("stats")) - centre) / scale)
            left += z.T @ z
            right += z.T @ batch.column("y").to_numpy()
        yield pa.record_batch([pa.array([np.concatenate([left[half], right]).tolist()])], ["sums"])

    summed = (train.mapInArrow(equations, "sums array<double>")
              .select(F.posexplode("sums").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")))
    sums = np.zeros(len(half[0]) + FEATURES)
    for r in summed.collect():
        sums[r.i] = r.v
    left = np.zeros((FEATURES, FEATURES))
    left[half] = sums[:-FEATURES]
    left = left + np.triu(left, 1).T
    weights = np.linalg.solve(left + RIDGE * moments.n / FEATURES * np.eye(FEATURES),
                              sums[-FEATURES:])
    model = Model(centre, scale, weights, np.zeros(1), np.zeros(1))
    width_of_bin = (HIGH - LOW) / BINS
    place = F.floor((F.least(F.greatest(score_column(model, F.col("stats"), raw=True),
                                        F.lit(LOW)), F.lit(HIGH)) - LOW) / width_of_bin)
    bins = (train.select(place.alias("bin"), "y").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).orderBy("bin").collect())
    counts = np.array([r.n for r in bins], float)
    model.steps = np.array([LOW + (r.bin + 0.5) * width_of_bin for r in bins])
    model.levels = pool(np.array([r.y for r in bins]) / counts, counts)
    return model


def score_column(model: Model | None, stats: Column, raw: bool = False) -> Column:
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = _matrix(column)
            yield pa.array(model.raw(rows) if raw else model.score(rows), pa.float64())
    return of(stats)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    The statistics are computed once and written; fitting and scoring read them again.
    """
    measured = stored(docs.select("doc_id", statistics_column(F.col("text")).alias("stats")),
                      "statistics")
    model = fit(labelled(measured, labels))
    return (measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                            score_column(model, F.col("stats")).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
