"""From trending repositories to rows of the search index.

candidates -> pending -> enriched -> text -> embedding -> appended to the index.
"""

from collections.abc import Callable, Iterator
from datetime import date
from math import log

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.events import top
from ..functions.text import letter_counts, missing_if_empty
from ..schemas import INDEX
from .trends import since

Encoder = Callable[[DataFrame], DataFrame]

# Vector length and batch size of the sentence encoder.
DIMENSIONS = 384
BATCH = 32
# Texts, and bytes of them, that an encoder works on at a time; a slice is many batches.
SLICE_ROWS, SLICE_BYTES = 1_024, 1 << 21
# Words whose bucket a task remembers.
WORDS_KEPT = 100_000


def embed_candidates(
    mart: DataFrame, as_of: date | None = None, days: int = 30, n: int = 500
) -> DataFrame:
    """repo_id, full_name, stars: the ``n`` most starred (repository, name) pairs."""
    stars = (
        since(mart, as_of, days)
        .groupBy("repo_id", F.col("repo_name").alias("full_name"))
        .agg(F.sum("stars").alias("stars"))
    )
    return top(stars, n, F.desc("stars"), "repo_id", "full_name")


def one_name_each(candidates: DataFrame) -> DataFrame:
    """One row per repository: a renamed one would otherwise be encoded twice."""
    best = F.max(F.struct("stars", "full_name"))
    return (
        candidates.groupBy("repo_id")
        .agg(best.alias("best"))
        .select("repo_id", F.col("best.full_name").alias("full_name"), F.col("best.stars").alias("stars"))
    )


def embed_pending(candidates: DataFrame, index: DataFrame) -> DataFrame:
    """Candidates whose repository is not in the index.

    The index may be huge and the candidates are few, so the index is first cut to
    the candidates' ids. Only those few ids meet the candidates again. How the sides
    meet is left to Spark, which sees their sizes.
    """
    ids = candidates.select("repo_id")
    indexed = index.select("repo_id").join(ids, "repo_id", "left_semi").distinct()
    return candidates.join(indexed, "repo_id", "left_anti")


def repo_enrich(pending: DataFrame, repos: DataFrame) -> DataFrame:
    """Description, language and lifetime stars of the pending repositories.

    Repositories the dimension does not know drop out. ``stars`` is the dimension's
    lifetime count, not the window's sum.
    """
    known = repos.select("repo_id", "description", "language", "stars")
    return known.join(pending.select("repo_id", "full_name"), "repo_id").select(
        "repo_id", "full_name", "description", "language", "stars"
    )


def embed_text(enriched: DataFrame) -> DataFrame:
    """Adds ``text``: the description, or the name where there is none."""
    return enriched.withColumn("text", F.coalesce(missing_if_empty("description"), "full_name"))


def encode(texts: DataFrame, encoder: Encoder) -> DataFrame:
    """Adds ``embedding`` (array<float>), computed from ``text`` by the encoder."""
    return encoder(texts)


def letters26(texts: DataFrame) -> DataFrame:
    """Encoder without a model: counts of the letters a-z."""
    return texts.withColumn("embedding", letter_counts("text"))


def fit_hashing(corpus: DataFrame, dimensions: int = DIMENSIONS) -> PipelineModel:
    """Hashed, idf-weighted words of unit length, fitted on the ``text`` of a corpus.

    Starts a job: document frequencies are one distributed pass. Save the model next
    to the index, so that later rows and queries are encoded alike.
    """
    stages = [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dimensions),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(corpus.select("text"))


def _slices(rows: int = SLICE_ROWS, size: int = SLICE_BYTES):
    """A function that cuts an Arrow array of texts into parts of few rows and bytes each.

    An Arrow batch has up to 10,000 texts, and what is computed from a text may take many
    times its room. Made in a closure, so that executors need no copy of this package.
    """

    def slices(texts):
        step = max(1, min(rows, size * len(texts) // max(texts.nbytes, 1)))
        for start in range(0, len(texts), step):
            yield texts.slice(start, step)

    return slices


def _md5_counts(dimensions: int):
    """A function from texts to a row of word counts for each, by the words' md5 bucket.

    Made in a closure, so that executors need no copy of this package.
    """
    most = WORDS_KEPT

    def counter():
        import re
        from hashlib import md5

        import numpy as np

        words, bucket = re.compile(r"[a-z0-9_]+").findall, {}

        def counts(texts: list):
            found = np.zeros((len(texts), dimensions))
            for row, text in enumerate(texts):
                own = words((text or "").lower())
                for word in set(own).difference(bucket):
                    bucket[word] = int.from_bytes(md5(word.encode()).digest()[:4], "big") % dimensions
                if own:
                    found[row] = np.bincount([bucket[word] for word in own], minlength=dimensions)
                if len(bucket) > most:
                    bucket.clear()
            return found

        return counts

    return counter


def _md5_vectors(dimensions: int, weights: list[float]):
    """A column function: word counts times ``weights``, scaled to unit length."""
    counter, slices = _md5_counts(dimensions), _slices()

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        count = counter()
        for texts in (part for batch in batches for part in slices(batch)):
            counts = count(texts.to_pylist()) * weights
            norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            counts /= np.where(norms == 0, 1.0, norms)
            offsets = pa.array(np.arange(0, counts.size + 1, dimensions, dtype="int32"))
            yield pa.ListArray.from_arrays(offsets, pa.array(counts.ravel().astype("float32")), mask=texts.is_null())

    return vectors


def fit_md5(corpus: DataFrame, dimensions: int = DIMENSIONS) -> list[float]:
    """Inverse document frequency of each md5 bucket, from the ``text`` of a corpus.

    Like ``fit_hashing``, but any engine that has md5 can compute the same vectors. One
    pass: a task sends one row, its number of documents and how many have each bucket.
    """
    counter, slices = _md5_counts(dimensions), _slices()

    def sums(batches):
        import numpy as np
        import pyarrow as pa

        count, having = counter(), np.zeros(dimensions + 1, dtype="int64")
        for batch in batches:
            for texts in slices(batch.column(0)):
                having[:-1] += (count(texts.to_pylist()) > 0).sum(axis=0)
                having[-1] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(range(dimensions + 1)), pa.array(having)], ["bucket", "documents"])

    found = corpus.select("text").mapInArrow(sums, "bucket long, documents long")
    totals = {row["bucket"]: row["n"] for row in found.groupBy("bucket").agg(F.sum("documents").alias("n")).collect()}
    total = totals.get(dimensions, 0)
    return [log((total + 1) / (totals.get(bucket, 0) + 1)) for bucket in range(dimensions)]


def save_md5(spark: SparkSession, weights: list[float], path: str) -> None:
    """Write the weights of ``fit_md5`` next to the index, for later rows and queries."""
    rows = spark.createDataFrame(list(enumerate(weights)), "bucket int, weight double")
    rows.coalesce(1).write.mode("overwrite").parquet(path)


def load_md5(spark: SparkSession, path: str) -> list[float]:
    return [row["weight"] for row in spark.read.parquet(path).orderBy("bucket").collect()]


def md5_encoder(weights: list[float]) -> Encoder:
    """Encoder that applies the weights of ``fit_md5``: unit length, zero without words."""
    vectors = _md5_vectors(len(weights), weights)
    return lambda texts: texts.withColumn("embedding", vectors("text"))


def hashing_encoder(model: PipelineModel) -> Encoder:
    """Encoder that applies a model of ``fit_hashing``."""

    def encoder(texts: DataFrame) -> DataFrame:
        embedding = vector_to_array("_unit", "float32")
        steps = ("_words", "_tf", "_idf", "_unit")
        return model.transform(texts).withColumn("embedding", embedding).drop(*steps)

    return encoder


def model_encoder(load_model: Callable[[], Callable[[list[str]], list]], batch: int = BATCH) -> Encoder:
    """Encoder around a user's model.

    ``load_model`` runs once per task; what it returns maps a list of up to
    ``batch`` texts to a sequence of vectors.
    """

    slices = _slices()

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa

        model = load_model()
        for texts in (part for arrived in batches for part in slices(arrived)):
            rows = []
            for start in range(0, len(texts), batch):
                encoded = model(texts.slice(start, batch).to_pylist())
                rows.extend(np.asarray(encoded, dtype="float32"))
            yield pa.array(rows, pa.list_(pa.float32()), from_pandas=True)

    return lambda texts: texts.withColumn("embedding", vectors("text"))


def index_rows(encoded: DataFrame) -> DataFrame:
    """Encoded rows in the index's schema."""
    return encoded.select(INDEX.names).to(INDEX)


def index_append(index: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; nothing is deduplicated or refreshed."""
    return index.unionByName(new.select(index.columns))
