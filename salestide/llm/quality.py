"""Quality scores of documents: random Fourier features, ridge regression, isotonic calibration.

A document becomes a short vector of statistics of its characters, words and lines. Random Fourier features
of the standardised vector approximate a Gaussian kernel; ridge weights solve the normal equations, which
every partition sums for its labelled rows. Isotonic regression on labelled rows that the ridge has not seen
turns raw scores into probabilities. All labelled training rows are used; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm import sums
from salestide.llm.text import crc_remainder, slices, text_or_empty
from salestide.session import materialize, scratch

FOURIER_FEATURES = 256
RIDGE = 1e-2
# Labelled rows by remainder of crc32(doc_id): 0 is held out, 1 calibrates, the others fit the weights.
FOLDS, HELD_OUT, CALIBRATION = 5, 0, 1
REJECT_BELOW = 0.3
# Raw scores are calibrated in steps of this width, at their rows' mean, so that isotonic regression sees a bounded
# table: scores less than a step apart may be ordered by their mean alone. Beyond -1 and 2 they count as those.
SCORE_STEP = 0.002
STATISTICS = (
    "log_bytes", "upper", "digit", "space", "non_ascii", "full_stop", "comma", "exclaim", "pipe", "symbol", "other_punct",
    "control", "distinct_words", "repeated_next", "word_length", "words_a_line", "repeated_lines",
)
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "space": b" ", "non_ascii": bytes(range(128, 256)),
    "full_stop": b".", "comma": b",", "exclaim": b"!?", "pipe": b"|", "symbol": b"#$%&*~^=<>{}[]\\", "other_punct": b"\"'()+-/:;@_`",
    "control": bytes(i for i in range(32) if i not in b"\n"),
}
_MEMBERS = np.array([[i in members for i in range(256)] for members in _CLASSES.values()], np.float64).T


@dataclass(frozen=True)
class QualityModel:
    """What scoring needs; a few thousand numbers whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    raw: np.ndarray
    calibrated: np.ndarray

    def fourier(self, statistics: np.ndarray) -> np.ndarray:
        z = np.clip((statistics - self.mean) / self.scale, -6, 6)
        waves = np.cos(z @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.hstack([np.ones((len(z), 1)), waves])

    def raw_score(self, statistics: np.ndarray) -> np.ndarray:
        return self.fourier(statistics) @ self.weights if len(statistics) else np.zeros(0)

    def score(self, statistics: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw_score(statistics), self.raw, self.calibrated), 0.0, 1.0)


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a whole text; an empty one has zeros."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = text.split()
    n = len(words)
    if not n:
        return [np.log1p(len(data)), *[0.0] * (len(STATISTICS) - 1)]
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _MEMBERS / len(data)
    lines = [line for line in text.split("\n") if line]
    return [
        np.log1p(len(data)), *np.sqrt(shares), len(set(words)) / n, sum(map(eq, words, words[1:])) / n, np.log1p(len(text) / n),
        np.log1p(n / max(len(lines), 1)), 1 - len(set(lines)) / max(len(lines), 1),
    ]


def _matrix(values: Iterable[str | None]) -> np.ndarray:
    rows = [statistics(v) for v in values]
    return np.array(rows, np.float64).reshape(len(rows), len(STATISTICS))


def describe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``_key`` and ``stats`` (array of double) of each row."""
    rows = docs.select(F.col(key).alias("_key"), text_or_empty(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            stats = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(stats, pa.list_(pa.float64()))], ["_key", "stats"])

    kind = rows.schema["_key"].dataType.simpleString()
    return rows.mapInArrow(run, f"_key {kind}, stats array<double>")


def _stats_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.array(batch.column("stats").to_pylist(), np.float64).reshape(batch.num_rows, len(STATISTICS))


def _normal_equations(labelled: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Sums over all rows of the outer products of the features, and of features times label."""
    size = len(model.phases) + 1

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            features = model.fourier(_stats_of(batch))
            left += features.T @ features
            right += features.T @ np.array(batch.column("label").to_pylist(), np.float64)
        yield sums.partial_rows(np.hstack([left, right[:, None]]))

    # One row per feature and partition is shuffled; the driver gets one row per feature.
    both = np.array(sums.total(labelled.select("stats", "label").mapInArrow(partial, sums.DDL)))
    return both[:, :size], both[:, size]


def _isotonic(labelled: DataFrame, model: QualityModel) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and the probabilities they stand for."""

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw_score(_stats_of(batch)), -1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(raw), batch.column("label")], ["raw", "label"])

    scored = labelled.select("stats", "label").mapInArrow(score, "raw double, label double")
    step = F.floor(F.col("raw") / SCORE_STEP)
    bins = scored.groupBy(step.alias("step")).agg(
        F.avg("raw").alias("raw"), F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("n")
    )
    table = VectorAssembler(inputCols=["raw"], outputCol="features").transform(bins).select("features", "label", "n")
    table = materialize(table, "quality-bins")
    if table.isEmpty():
        return np.array([0.0, 1.0]), np.array([0.0, 1.0])
    fitted = IsotonicRegression(weightCol="n").fit(table)
    return np.array(fitted.boundaries.toArray()), np.array(fitted.predictions.toArray())


def fit(
    described: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", features: int = FOURIER_FEATURES,
    ridge: float = RIDGE, seed: int = 7,
) -> QualityModel:
    """Fit on the labelled rows of ``described`` (see :func:`describe`) that are not held out.

    Rows without a label are left out; a document with several labels counts once for each. With no labelled
    rows the model scores 0.5 throughout.
    """
    known = labels.filter(F.col(label).isNotNull()).select(F.col(key).alias("_key"), F.col(label).cast("double").alias("label"))
    fold = crc_remainder("_key", FOLDS)
    labelled = materialize(described.join(known, "_key").withColumn("fold", fold).filter(fold != HELD_OUT), "quality-labelled")
    places = described.select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s"))
    moments = sorted(places.collect(), key=lambda r: r.i)
    rng = np.random.default_rng(seed)
    d = len(STATISTICS)
    mean = np.array([r.m for r in moments]) if moments else np.zeros(d)
    scale = np.array([max(r.s, 1e-6) for r in moments]) if moments else np.ones(d)
    start = QualityModel(
        mean, scale, rng.normal(size=(d, features)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1), np.array([0.0, 1.0]), np.array([0.0, 1.0]),
    )
    fitting = labelled.filter(F.col("fold") != CALIBRATION)
    n = fitting.count()
    if n == 0:
        return QualityModel(mean, scale, start.frequencies, start.phases, start.weights, np.array([0.0]), np.array([0.5]))
    left, right = _normal_equations(fitting, start)
    weights = np.linalg.solve(left + ridge * np.eye(features + 1), right)
    fitted = QualityModel(mean, scale, start.frequencies, start.phases, weights, start.raw, start.calibrated)
    raw, calibrated = _isotonic(labelled.filter(F.col("fold") == CALIBRATION), fitted)
    return QualityModel(mean, scale, start.frequencies, start.phases, weights, raw, calibrated)


def score_described(described: DataFrame, model: QualityModel, key: str = "doc_id") -> DataFrame:
    """Key, ``held_out``, ``score`` and ``predicted`` of each row of ``described``."""
    kind = described.schema["_key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("_key"), pa.array(model.score(_stats_of(batch)))], ["_key", "score"])

    scored = described.mapInArrow(run, f"_key {kind}, score double")
    return scored.select(
        F.col("_key").alias(key), (crc_remainder("_key", FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``held_out``, ``score`` (0 to 1), ``predicted`` (1 from ``REJECT_BELOW`` up).

    Scores depend on the whole text alone. Null and empty texts are scored like others, from zeros; a null key
    counts as empty text for the fold; repeated rows are scored each; no rows give no rows.
    """
    described = materialize(describe(docs, key, text), "quality-stats")
    return score_described(described, fit(described, labels, label, key), key)


def scorer(model: QualityModel):
    """A column function: the score of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    return score


def keep_good(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without those that the classifier rejects; all columns stay as they are.

    Null, empty and repeated texts are scored like others; with no labelled rows nothing is rejected; an empty table
    stays empty.
    """
    with scratch(docs.sparkSession):
        model = fit(materialize(describe(docs, key, text), "quality-stats"), labels, label, key)
    passed: Column = scorer(model)(text_or_empty(text)) >= REJECT_BELOW
    return docs.filter(passed)
