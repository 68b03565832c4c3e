"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of one to three characters of the whole lower-cased text, digits and ASCII punctuation
counting as blanks, weighted by (1 + log tf) * idf and scaled to length one. Document frequencies count every labelled
training document. The regression is trained with follow-the-regularised-leader (per-coordinate steps, elastic net)
on a bounded sample of every label: about ``PER_CLASS`` documents of each, fewer if there are so many labels that these were more
than ``EXAMPLES`` (``LEAST_PER_CLASS`` at least), drawn by a hash of id, text and input partition; a fifth of the sample is kept
for the temperature that calibrates the probabilities.

The model has ``DIMENSIONS`` times classes weights (128 kB a label), which is what is sent to the tasks.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any labelled training document every
text is. Null labels are never learned. A null id counts as the empty text when documents are split. Repeated rows each
get a row. Extra columns pass through in the struct ``row`` and are no inputs. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from trailperks.llm.common import field_of, slices, small_batches, with_row

DIMENSIONS = 2**14
SLICE_BYTES = 2 * 1024**2
#: Labelled texts that are drawn to fit: of each class, and of all classes, but of each class a few at least.
PER_CLASS, EXAMPLES, LEAST_PER_CLASS = 1000, 32_000, 20
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 1e-4
#: Temperatures that are tried.
COLDEST, HOTTEST = 1e-3, 1e3
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
#: ASCII characters that are not letters count as blanks.
FOLD = np.array([x if chr(x).isalpha() or x > 127 else 32 for x in range(256)], dtype=np.uint32)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of a text and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = np.where(points < 128, FOLD[np.minimum(points, 255)], points)
    codes, parts = np.zeros(len(points), np.uint32), []
    for n in range(3):
        codes = codes[: len(points) - n] * np.uint32(0x9E3779B1) + points[n:] + np.uint32(1)
        parts.append((codes ^ (codes >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(18))
        if len(points) <= n + 1:
            break
    counts = np.bincount(np.concatenate(parts), minlength=DIMENSIONS)
    places = np.flatnonzero(counts)
    return places, counts[places]


def weigh(places: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    values = (1 + np.log(counts)) * idf[places]
    return values / np.sqrt(values @ values)


def softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return scores / scores.sum(axis=-1, keepdims=True)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], classes: int) -> np.ndarray:
    """Weights (dimension by class) after FTRL-proximal steps over the examples."""
    z, n = np.zeros((DIMENSIONS, classes)), np.zeros((DIMENSIONS, classes))

    def weights(rows) -> np.ndarray:
        shrunk = np.sign(z[rows]) * np.maximum(np.abs(z[rows]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[rows])) / ALPHA + L2)

    for _ in range(EPOCHS):
        for places, values, label in examples:
            w = weights(places)
            error = softmax(values @ w)
            error[label] -= 1
            gradient = values[:, None] * error
            squares = n[places]
            sigma = (np.sqrt(squares + gradient**2) - np.sqrt(squares)) / ALPHA
            z[places] += gradient - sigma * w
            n[places] = squares + gradient**2
    return weights(slice(None))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, by golden-section search.

    The truth is smoothed as if each class had been seen once more, so that texts which are all told apart give a
    temperature above zero: the fewer they are, the less certain the model may be.
    """
    classes = scores.shape[1]
    target = np.full(scores.shape, 1 / (len(labels) + classes))
    target[np.arange(len(labels)), labels] += len(labels) / (len(labels) + classes)

    def loss(log_t: float) -> float:
        shifted = scores / np.exp(log_t)
        shifted = shifted - shifted.max(axis=1, keepdims=True)
        return -(target * (shifted - np.log(np.exp(shifted).sum(axis=1, keepdims=True)))).sum(axis=1).mean()

    low, high, ratio = np.log(COLDEST), np.log(HOTTEST), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not text or not LETTER.search(text):
            return UNKNOWN, 0.0
        places, counts = ngram_counts(text)
        chances = softmax(weigh(places, counts, self.idf) @ self.weights[places] / self.temperature)
        best = int(chances.argmax())
        return self.labels[best], float(chances[best])


def document_frequencies(texts: DataFrame) -> np.ndarray:
    """How many texts hold each hashed n-gram; a task sends one row per n-gram at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for begin, end in slices(batch.column(0), SLICE_BYTES):
                for text in batch.column(0).slice(begin, end - begin).to_pylist():
                    total[ngram_counts(text)[0]] += 1
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(total[places])], names=["place", "n"])

    out = np.zeros(DIMENSIONS)
    for row in texts.mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[row.place] = row.n
    return out


def fit(docs: DataFrame, is_training: Column, lang: str = "lang", doc_id: str = "doc_id", text: str = "text") -> Model:
    small_batches(docs.sparkSession)
    labelled = docs.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id"), is_training.alias("training")
    ).where("training and lang is not null and length(text) > 0")
    sizes = labelled.groupBy("lang").count().collect()
    labels = sorted(row["lang"] for row in sizes)
    if not labels:
        return Model([], np.zeros(DIMENSIONS), np.zeros((DIMENSIONS, 0)), 1.0)
    total = sum(row["count"] for row in sizes)
    idf = np.log((1 + total) / (1 + document_frequencies(labelled.select("text")))) + 1

    wanted = max(LEAST_PER_CLASS, min(PER_CLASS, EXAMPLES // len(labels)))
    shares = F.create_map(*[F.lit(x) for row in sizes for x in (row["lang"], min(1.0, wanted / row["count"]))])
    # By id, text and partition, so rows under one id are drawn one by one.
    draw = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text", F.spark_partition_id()), F.lit(2**30)) / 2.0**30
    sample = labelled.where(draw < F.element_at(shares, F.col("lang"))).withColumn(
        "turn", F.xxhash64(F.lit(13), "doc_id", "text")
    )
    numbers = {label: n for n, label in enumerate(labels)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_counts(text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([x.astype("<i4").tobytes() for x, _ in found], pa.binary()),
                    pa.array([x.astype("<i8").tobytes() for _, x in found], pa.binary()),
                ],
                names=["lang", "turn", "places", "counts"],
            )

    rows = sample.select("text", "lang", "turn").mapInArrow(features, "lang string, turn long, places binary, counts binary").collect()
    examples = []
    for row in sorted(rows, key=lambda x: x.turn):
        places = np.frombuffer(row.places, "<i4")
        examples.append((places, weigh(places, np.frombuffer(row.counts, "<i8"), idf), numbers[row.lang]))
    kept, used = examples[::5], [x for n, x in enumerate(examples) if n % 5] or examples
    weights = train(used, len(labels))
    scores = np.array([values @ weights[places] for places, values, _ in kept])
    return Model(labels, idf, weights, fit_temperature(scores, np.array([label for _, _, label in kept])))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` (all columns in a struct ``row``) with lang_pred and score."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = field_of(batch.column(0), text)
            for begin, end in slices(column, SLICE_BYTES):
                found = [model.predict(x) for x in column.slice(begin, end - begin).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        pa.array([x for x, _ in found], pa.string()),
                        pa.array([x for _, x in found], pa.float64()),
                    ],
                    names=["row", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, with_row(rows, "lang_pred string, score double"))
