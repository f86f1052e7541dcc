"""Quality classifier on random-indexing word vectors.

Every word has a random ternary index vector, and its context vector is the sum of the
index vectors of its neighbours throughout the corpus: words used alike get like
vectors, without a factorisation. Words are hashed to a fixed number of rows, so the
vectors have one size whatever the corpus, and each task adds up its own before they are
summed by row. A document is the mean and deviation of its words' vectors and how far
neighbouring words agree; a two-layer network turns that into a probability, whose
temperature is fitted on labelled documents that the network didn't see.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Remembered, mix

#: Letters, or signs without white space: capitals and trailing signs are words too.
WORDS = re.compile(r"[^\W\d_]+|[\d_]+|[^\w\s]+").findall
ROWS = 1 << 14
WIDTH = 32
REACH = 2
NONZERO = 2
HIDDEN = 32
#: Most labelled documents that the network is fitted on; a hash chooses them.
MAX_LABELLED = 20_000
EPOCHS, BATCH, RATE, DECAY = 40, 128, 0.003, 1e-4


def _row(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) % ROWS


def _rows(texts: list[str | None], rows: Remembered) -> list[np.ndarray]:
    """The row of each word, for each text."""
    out = []
    for text in texts:
        words = WORDS(text or "")
        out.append(np.fromiter(rows.all(words), np.int64, len(words)))
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Where the index vector of each row has its non-zero values, and their signs."""
    drawn = mix(np.arange(ROWS * NONZERO), seed=2).reshape(ROWS, NONZERO)
    return (drawn % np.uint64(WIDTH)).astype(np.int64), np.where(drawn >> np.uint64(63), 1.0, -1.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the neighbours' index vectors over all documents of the task."""
    remembered, (places, signs) = Remembered(_row), index_vectors()
    total = np.zeros(ROWS * WIDTH)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            documents = _rows(batch.column(0).slice(at, 256).to_pylist(), remembered)
            gap = np.full(REACH, -1)
            words = np.concatenate(list(chain.from_iterable((own, gap) for own in documents)))
            for reach in range(1, REACH + 1):
                left, right = words[:-reach], words[reach:]
                both = (left >= 0) & (right >= 0)
                left, right = left[both], right[both]
                for one, other in ((left, right), (right, left)):
                    for k in range(NONZERO):
                        total += np.bincount(one * WIDTH + places[other, k], signs[other, k], ROWS * WIDTH)
    vectors = total.reshape(ROWS, WIDTH)
    used = np.flatnonzero(vectors.any(axis=1))
    columns = [pa.array(used)] + [pa.array(vectors[used, k]) for k in range(WIDTH)]
    yield pa.RecordBatch.from_arrays(columns, ["row", *(f"v{k}" for k in range(WIDTH))])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context and index vector of each row, from all documents. Its size is fixed."""
    names = [f"v{k}" for k in range(WIDTH)]
    schema = "row long, " + ", ".join(f"{name} double" for name in names)
    sums = docs.select(text).mapInArrow(_contexts, schema).groupBy("row").agg(*(F.sum(n).alias(n) for n in names))
    context = np.zeros((ROWS, WIDTH))
    for part in sums.toPandas().itertuples(index=False):
        context[int(part[0])] = part[1:]
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-12)
    own, (places, signs) = np.zeros((ROWS, WIDTH)), index_vectors()
    for k in range(NONZERO):
        np.add.at(own, (np.arange(ROWS), places[:, k]), signs[:, k])
    return np.concatenate([context, own], axis=1).astype(np.float32)


def document_vector(rows: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean, deviation, agreement of neighbours and length; zeros without words."""
    out = np.zeros(4 * WIDTH + 3, np.float32)
    if len(rows):
        words = vectors[rows]
        mean = words.mean(axis=0)
        out[: 2 * WIDTH] = mean
        out[2 * WIDTH : 4 * WIDTH] = np.sqrt(np.maximum((words * words).mean(axis=0) - mean * mean, 0))
        if len(rows) > 1:
            agreement = (words[:-1] * words[1:]).mean(axis=0)
            out[-3], out[-2] = agreement[:WIDTH].sum(), agreement[WIDTH:].sum()
        out[-1] = np.log(len(rows))
    return out


@dataclass
class Network:
    """One hidden layer on standardised inputs; ``temperature`` divides the logit."""

    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.layers
        return np.tanh((x - self.centre) / self.scale @ w + b) @ v + c[0]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 0, times: np.ndarray | None = None) -> Network:
    """Adam on the log loss over four fifths of the rows; the rest fits the temperature.

    A row counts as often as ``times`` says. Rows come in any order and are sorted first,
    so the result depends on their values only. Without rows, or with one class, the
    probability is the smoothed share of 1.
    """
    times = np.ones(len(y)) if times is None else np.asarray(times, np.float64)
    order = np.lexsort([*x.T[:8], y]) if len(y) else np.zeros(0, int)
    x, y, times = x[order].astype(np.float64), y[order].astype(np.float64), times[order]
    rng = np.random.default_rng(seed)
    share = ((times * y).sum() + 1) / (times.sum() + 2)
    width = x.shape[1]
    if len(y) < 10 or y.min() == y.max():
        flat = [np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([np.log(share / (1 - share))])]
        return Network(np.zeros(width), np.ones(width), flat)
    unseen = rng.random(len(y)) < 0.2
    fit_x, fit_y, fit_times = x[~unseen], y[~unseen], times[~unseen]
    centre = np.average(fit_x, axis=0, weights=fit_times)
    scale = np.sqrt(np.average((fit_x - centre) ** 2, axis=0, weights=fit_times)) + 1e-6
    layers = [
        rng.normal(0, width**-0.5, (width, HIDDEN)),
        np.zeros(HIDDEN),
        rng.normal(0, HIDDEN**-0.5, HIDDEN),
        np.array([np.log(share / (1 - share))]),
    ]
    network = Network(centre, scale, layers)
    moments = [[np.zeros_like(layer), np.zeros_like(layer)] for layer in layers]
    step = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(len(fit_y)), max(1, len(fit_y) // BATCH)):
            z = (fit_x[rows] - centre) / scale
            hidden = np.tanh(z @ layers[0] + layers[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3][0], -30, 30))) - fit_y[rows])
            error *= fit_times[rows] / fit_times[rows].sum()
            back = np.outer(error, layers[2]) * (1 - hidden * hidden)
            slopes = [z.T @ back + DECAY * layers[0], back.sum(axis=0), hidden.T @ error, np.array([error.sum()])]
            step += 1
            for layer, slope, (first, second) in zip(layers, slopes, moments):
                first += 0.1 * (slope - first)
                second += 0.001 * (slope * slope - second)
                layer -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    if unseen.any():
        logits, signs = network.logit(x[unseen]), 2 * y[unseen] - 1
        options = np.geomspace(0.25, 8, 101)
        network.temperature = float(min(options, key=lambda t: (times[unseen] * np.logaddexp(0, -signs * logits / t)).sum()))
    return network


@dataclass
class Classifier:
    vectors: np.ndarray
    network: Network

    def probabilities(self, texts: list[str | None], remembered: Remembered) -> np.ndarray:
        rows = _rows(texts, remembered)
        x = np.array([document_vector(own, self.vectors) for own in rows], np.float64)
        return self.network.probability(x.reshape(len(texts), -1)) if len(texts) else np.zeros(0)


def score(classifier: Classifier, text: str = "text") -> Column:
    """Probability that a text is of quality 1. It depends on the text alone."""

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        remembered = Remembered(_row)
        for texts in batches:
            parts = [
                classifier.probabilities(list(texts.iloc[at : at + 256]), remembered) for at in range(0, len(texts), 256)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return probability(F.col(text))


def _features(vectors: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    remembered = Remembered(_row)
    for batch in batches:
        rows = _rows(batch.column(2).to_pylist(), remembered)
        x = pa.array([document_vector(own, vectors) for own in rows], pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x], ["quality", "times", "x"])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    most: int = MAX_LABELLED,
    doc_id: str = "doc_id",
    text: str = "text",
    quality: str = "quality",
) -> Classifier:
    """A classifier from ``docs`` and the ``labels`` it may learn from.

    The word vectors come from all documents. The network sees about ``most`` labelled
    texts at the most, chosen by a hash of their id and text. Labels other than 0 and 1 and
    null ids are ignored; of a document that is labelled twice the higher label counts;
    a text that repeats under one id is one row, which counts as often as it occurs. Null
    and empty texts have the zero vector. Without labels every score is one half.
    """
    vectors = word_vectors(docs, text)
    known = labels.where(F.col(quality).isin(0, 1) & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max(quality).cast("int").alias("quality"))
    known = _about(known, most, "id")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # At most about ``most`` ids and labels: 16 bytes each.
    rows = rows.join(F.broadcast(known), "id")
    chosen = _about(rows.groupBy("id", "quality", "hash").agg(F.count("*").alias("times")), most, "id", "hash")
    # One text for each, of as many rows as were counted.
    texts = rows.join(F.broadcast(chosen.select("id", "hash", "times")), ["id", "hash"])
    texts = texts.groupBy("id", "quality", "hash", "times").agg(F.first("text").alias("text")).select("quality", "times", "text")
    found = texts.mapInArrow(partial(_features, vectors), "quality int, times long, x array<float>").toPandas()
    x = np.array(found["x"].tolist(), np.float32).reshape(len(found), 4 * WIDTH + 3)
    return Classifier(vectors, train(x, found["quality"].to_numpy(), times=found["times"].to_numpy()))


def _about(rows: DataFrame, most: int, *key: str) -> DataFrame:
    """All rows, or if there are more than ``most``, about as many, chosen by a hash of the key."""
    count = rows.count()
    if count <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(*key, F.lit(7)), F.lit(1 << 20)) < F.lit(int(most / count * (1 << 20))))


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from one half upwards).

    See ``fit`` for what is learned and for odd rows. An empty table gives an empty one.
    Columns of ``docs`` that have the new names are replaced.
    """
    scored = docs.withColumn("score", score(fit(docs, labels, text=text, **options), text))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
