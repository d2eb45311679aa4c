"""Language identification with string kernels.

The kernel of two texts is the number of byte n-grams (n = 1, 2, 3 together: a blended
spectrum) that both contain, divided by the geometric mean of their own counts.  Only presence
counts, not frequency.  A Nyström map over landmark texts turns the kernel into features, and
one-versus-rest kernel ridge regression on them gives one score per language.  Since the
kernel is a product of presence vectors, landmarks and coefficients fold into one matrix: a
batch of texts is scored by one product of its presence matrix with that matrix.

Fitting uses a bounded sample of the labelled texts of every language: its first ``PER_LANGUAGE``
different ones by a hash of the text, so neither copies nor frequent languages push others out.
Beyond 64 languages each has fewer landmarks (``ALL_LANDMARKS``).  Every text of the table is
predicted, whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; ties go to the
language that sorts first; without labelled rows everything is ``und``; repeated rows each
get their row; a null doc_id counts as held out; extra columns are ignored; an empty table
gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, fresh, held_out

UNKNOWN = "und"
#: Bound of a language's labelled sample, landmarks among it, and landmarks of all languages.
PER_LANGUAGE, LANDMARKS, ALL_LANDMARKS = 300, 64, 4096
#: Parts in which a language's texts are ranked, so that no language is one task.
SAMPLE_PARTS = (64, 8, 1)
RIDGE = 1e-2
GRAMS = 256 + (1 << 16) + (1 << 24)
BATCH = 64
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> bytes:
    """Lower-cased letters with one space around and between runs; empty without a letter."""
    kept = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not any(c.isalpha() for c in set(kept)):
        return b""
    return b" " + kept.encode() + b" "


def grams(line: bytes) -> np.ndarray:
    """Codes of all n-grams of a line, repeats included."""
    b = np.frombuffer(line, np.uint8).astype(np.int32)
    two = (b[:-1] << 8 | b[1:]) + 256
    three = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) + 256 + (1 << 16)
    return np.concatenate([b, two, three])


@dataclass
class Model:
    """Fitted classifier: column codes, one weight column per language, bias, names."""
    codes: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    names: list[str]


def fit(rows: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Nyström features and one-versus-rest ridge regression of (text, language) rows."""
    lines = [(np.unique(grams(line)), lang) for text, lang in rows if (line := normal(text))]
    names = sorted({lang for _, lang in lines})
    if not names:
        return Model(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), [])
    landmarks = max(1, min(landmarks, ALL_LANDMARKS // len(names)))
    chosen = []
    for name in names:
        chosen += [g for g, lang in lines if lang == name][:landmarks]
    codes = np.unique(np.concatenate(chosen))
    marks = np.zeros((len(chosen), len(codes)), np.float32)
    for i, g in enumerate(chosen):
        marks[i, np.searchsorted(codes, g)] = 1
    marks /= np.sqrt(np.array([len(g) for g in chosen], np.float32))[:, None]
    own = (marks @ marks.T).astype(float)
    values, vectors = np.linalg.eigh(own)
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    features = np.zeros((len(lines), len(chosen)))
    for i, (g, _) in enumerate(lines):
        known = g[np.isin(g, codes, assume_unique=True)]
        features[i] = marks[:, np.searchsorted(codes, known)].sum(axis=1) / np.sqrt(len(g))
    mapped = features @ root
    target = np.array([[1.0 if lang == name else -1.0 for name in names] for _, lang in lines])
    centre, bias = mapped.mean(axis=0), target.mean(axis=0)
    mapped = mapped - centre
    solved = np.linalg.solve(mapped.T @ mapped + ridge * np.eye(mapped.shape[1]),
                             mapped.T @ (target - bias))
    weights = marks.T @ (root @ solved)
    return Model(codes, weights.astype(np.float32), bias - centre @ solved, names)


class Scorer:
    """Scores batches of texts in one task."""

    def __init__(self, model: Model):
        self.model = model
        self.column = np.full(GRAMS, -1, np.int32)
        self.column[model.codes] = np.arange(len(model.codes), dtype=np.int32)
        self.seen = np.zeros(GRAMS, np.int32)

    def score(self, whole: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(whole), [0.0] * len(whole)
        if not self.model.names:
            return langs, scores
        for at in range(0, len(whole), BATCH):
            lines = [normal(t) for t in whole[at:at + BATCH]]
            present = np.zeros((len(lines), len(self.model.codes)), np.float32)
            sizes = np.ones(len(lines))
            for i, line in enumerate(lines):
                if line:
                    found = grams(line)
                    order = np.arange(len(found), dtype=np.int32)
                    self.seen[found] = order              # the last one of equal codes stays
                    sizes[i] = np.count_nonzero(self.seen[found] == order)
                    columns = self.column[found]
                    present[i, columns[columns >= 0]] = 1
            out = present @ self.model.weights / np.sqrt(sizes)[:, None] + self.model.bias
            best = out.argmax(axis=1)
            for i, line in enumerate(lines):
                if line:
                    langs[at + i] = self.model.names[best[i]]
                    scores[at + i] = float(np.clip((1 + out[i, best[i]]) / 2, 0, 1))
        return langs, scores


def labelled_sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """The first ``per_language`` different texts, by hash, of each language that are not held
    out, as rows (text, lang)."""
    train = (docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()
                         & F.col("text").rlike(r"\p{L}"))
             .select("text", "lang", F.xxhash64("text").alias("_place")))
    # a language of most of the rows is ranked in parts, the best of them in fewer parts
    places = train.select("lang", "_place").distinct()
    for parts in SAMPLE_PARTS:
        order = Window.partitionBy("lang", F.pmod("_place", F.lit(parts))).orderBy("_place")
        places = (places.withColumn("_nth", F.row_number().over(order))
                  .filter(F.col("_nth") <= per_language).drop("_nth"))
    last = places.groupBy("lang").agg(F.max("_place").alias("last")).collect()
    if not last:
        return []
    bound = F.create_map(*[F.lit(v) for r in last for v in (r["lang"], r["last"])])
    picked = (train.filter(F.col("_place") <= bound[F.col("lang")])
              .groupBy("lang", "_place").agg(F.min("text").alias("text"))
              .orderBy("_place", "text", "lang"))
    return [(r.text, r.lang) for r in picked.collect()]


def language_column(model: Model, text: Column) -> Column:
    """Struct of ``lang`` and ``score`` for a text column."""
    @F.arrow_udf("struct<lang:string,score:double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for column in batches:
            langs, scores = scorer.score(column.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["lang", "score"])
    return of(text)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``."""
    model = model or fit(labelled_sample(docs))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        language_column(model, F.col("text")).alias("_found"))
            .select("doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), "_found.score"))


def keep_identified(docs: DataFrame, least_score: float = 0.25) -> DataFrame:
    """Rows whose language is recognised with at least ``least_score``; all columns stay."""
    found = fresh("_found", docs)
    return (docs.withColumn(found, language_column(fit(labelled_sample(docs)), F.col("text")))
            .filter((F.col(f"{found}.lang") != UNKNOWN) & (F.col(f"{found}.score") >= least_score))
            .select(*columns(docs)))
