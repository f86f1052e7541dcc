"""Importance resampling towards a target distribution.

Documents and target texts are seen as bags of hashed word n-grams. A text's separators
are collapsed to single spaces, and one overlapped regular expression for each length
finds every n-gram where a word starts and stops; the checksum of what it spans names a
bucket. A bucket's gain says how much more frequent it is in the target than in the
documents, a document's weight is the sum of its gains, and adding Gumbel noise to the
weights draws without replacement in proportion to them.

Texts are scanned once: their buckets are written, and all that is counted and weighed
after that reads numbers. Totals by bucket have a bound, the number of buckets. Ranks
come from a range partitioning and the sizes of its parts, never from one sorted task.
"""

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Remembered, free_name, materialised

NGRAMS, BUCKETS = 1, 10_000
PERCENT, LEAST_WORDS, SEED = 10, 20, 2024
#: What lies between words, in the bytes of a text: all ASCII but digits and small letters.
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLACE_BITS = 33  # of a row within its partition, in Spark's increasing ids


@lru_cache(maxsize=None)
def ngram_pattern(length: int) -> regex.Pattern:
    """Finds ``length`` words in a row, between boundaries, in text with single spaces."""
    more = rb"(?: [^ ]++){%d}" % (length - 1) if length > 1 else b""
    return regex.compile(rb"(?<![^ ])[^ ]++" + more + rb"(?![^ ])")


def collapsed(text: str | None) -> bytes:
    """The text's bytes, A-Z in lower case, with a single space between words."""
    return SEPARATORS.sub(b" ", (text or "").encode().lower()).strip(b" ")


def ngram_spans(text: bytes, length: int) -> Iterator[tuple[int, int]]:
    """Start and stop of each run of ``length`` words of a ``collapsed`` text."""
    for match in ngram_pattern(length).finditer(text, overlapped=True):
        yield match.span()


def _bucket_kind(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def bucket_list(text: bytes, ngrams: int, bucket: Remembered) -> list[int]:
    """Buckets of all n-grams of a ``collapsed`` text, those of one word first."""
    found = []
    for length in range(1, ngrams + 1):
        found += [bucket[text[start:stop]] for start, stop in ngram_spans(text, length)]
    return found


def _features(ngrams: int, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, bucket = _bucket_kind(buckets), Remembered(lambda gram: zlib.crc32(gram) % buckets)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            words, counts, packed = [], [], []
            for text in part.column(part.num_columns - 1).to_pylist():
                text = collapsed(text)
                own = bucket_list(text, ngrams, bucket)
                words.append(text.count(b" ") + 1 if text else 0)
                counts.append(len(own))
                packed.append(np.array(own, kind).tobytes())
            columns = [pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], *columns], [*part.schema.names[:-1], "n_words", "n_features", "buckets"]
            )


def _totals(buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals = np.zeros(buckets, np.int64)
    for batch in batches:
        raw = b"".join(batch.column(0).to_pylist())
        totals += np.bincount(np.frombuffer(raw, _bucket_kind(buckets)), minlength=buckets)
    some = np.flatnonzero(totals)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], ["bucket", "times"])


def features(docs: DataFrame, text: str, carry: list[str], ngrams: int, buckets: int, label: str) -> DataFrame:
    """A written table of ``carry``, n_words, n_features and the packed buckets of each text."""
    rows = docs.select(*carry, F.col(text).cast("string").alias("__text"))
    kinds = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in rows.schema.fields[:-1])
    schema = f"{kinds}{', ' if kinds else ''}n_words long, n_features long, buckets binary"
    return materialised(rows.mapInArrow(partial(_features, ngrams, buckets), schema), label)


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; at most ``buckets`` rows reach the driver."""
    partial_sums = found.select("buckets").mapInArrow(partial(_totals, buckets), "bucket long, times long")
    sums = partial_sums.groupBy("bucket").agg(F.sum("times").alias("times")).toArrow()
    totals = np.zeros(buckets, np.int64)
    totals[sums.column("bucket").to_numpy()] = sums.column("times").to_numpy()
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target over corpus frequency, one added to each count."""
    buckets, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(seed: int, doc_id: int | None) -> int:
    """Gumbel noise of a document in thousandths; a null id is the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    share = (int.from_bytes(digest[:4], "big") + 0.5) / 4294967296
    return math.floor(-1000 * math.log(-math.log(share)))


def _weigh(own: np.ndarray, seed: int, place: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = _bucket_kind(len(own))
    for batch in batches:
        names = batch.schema.names[:-1]
        weights = [int(own[np.frombuffer(raw, kind)].sum()) for raw in batch.column(batch.num_columns - 1).to_pylist()]
        ids = batch.column(place).to_pylist()
        scores = [weight + noise(seed, doc_id) for weight, doc_id in zip(weights, ids)]
        columns = [*batch.columns[:-1], pa.array(weights, pa.int64()), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "weight", "score"])


def ranked(rows: DataFrame, order: list, label: str) -> DataFrame:
    """``rows`` with ``rank``, 1 for the first in ``order``, by range partitions and their sizes."""
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialised(placed.withColumn("place", F.monotonically_increasing_id()), label)
    part = F.shiftright("place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    # As many rows as there are partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = F.col("place").bitwiseAND((1 << PLACE_BITS) - 1)
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    return joined.withColumn("rank", F.col("start") + within + 1).drop("part", "place", "start")


def importance(
    docs: DataFrame,
    target: DataFrame,
    ngrams: int = NGRAMS,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    carry: str | None = None,
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for each row of ``docs``, and the column ``carry`` if named.

    Words are runs of digits, letters a-z (A-Z in lower case) and anything beyond ASCII;
    features are runs of 1 to ``ngrams`` of them, repeats counted, each in the bucket of
    its CRC32. A bucket with s of the S features of all documents and t of the T features
    of all ``target`` texts has the gain floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))).
    ``weight`` sums a document's gains, ``score`` adds noise that its id and ``seed`` fix.
    Of the N documents with ``least_words`` words or more, floor(percent * N / 100) are
    drawn: those of the highest scores, equal ones by smaller id. ``rank`` counts them from
    1 and is null for all others.

    Null and empty texts have no features, weight 0 and are never drawn. A null id counts
    as the empty text in the noise and comes first among equal scores. Repeated rows are
    documents of their own: a repeated id has the same noise each time, and rows that agree
    in id and score are ordered by a hash of their text, equal ones anyhow. An empty target
    gives every bucket the gain of t = T = 0, an empty table of documents an empty result.
    Other columns of either table aren't read, so their names can't clash.
    """
    carried = (F.col(carry) if carry else F.lit(0)).cast("long").alias("carried")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), carried, F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    found = features(rows, "text", ["doc_id", "carried", "key"], ngrams, buckets, "resampling-features")
    wanted = features(target, target_text, [], ngrams, buckets, "resampling-target")
    own = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    schema = "doc_id long, carried long, key long, n_words long, n_features long, weight long, score long"
    weighed = materialised(found.mapInArrow(partial(_weigh, own, seed, 0), schema), "resampling-weights")
    enough = F.col("n_words") >= least_words
    drawn = weighed.where(enough).count() * percent // 100
    # Rows that agree in everything are told apart too, so that no range is one hot key.
    some = weighed.where(enough).withColumn("row", F.monotonically_increasing_id())
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("key").asc(), F.col("row").asc()]
    placed = ranked(some, order, "resampling-ranks").withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    names = ["doc_id", "n_features", "weight", "score", *([F.col("carried").alias(carry)] if carry else [])]
    rest = weighed.where(~enough).select(*names, F.lit(None).cast("long").alias("rank"))
    return placed.select(*names, "rank").union(rest)


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, with all their columns; ``settings`` as for ``importance``.

    Rows are numbered in a written table, under a name that ``docs`` doesn't have, so that
    repeated and null ids are told apart.
    """
    row = free_name(docs, "row")
    numbered = materialised(docs.withColumn(row, F.monotonically_increasing_id()), "resampling-rows")
    drawn = importance(numbered, target, doc_id=doc_id, text=text, carry=row, **settings).where("rank is not null")
    return numbered.join(drawn.select(row), row, "left_semi").select(docs.columns)
