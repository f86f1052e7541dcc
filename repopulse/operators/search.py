"""Exact cosine search over the index.

The index stays distributed. Each task scores its rows in Arrow batches and keeps only
its own best ``k`` keys per query, so no pair of query and row leaves a task unless it
can still be a result, and no text does at all: a final ranking merges the tasks' keys,
and metadata joins the few rows that are left.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import missing_if_empty
from ..session import shared_folder

# Queries sent to all tasks at a time (25 MB at 384 float dimensions). The index is
# scanned once for so many queries and never shuffled.
SCAN = 16_384
# Queries of a scan that are one matrix.
SLICE = 4_096
# Keys that the results of one scan may have at the most to be sent to all tasks (24 MB).
_SENT_KEYS = 1_000_000
# Queries scored at once, which bounds a task's score matrix.
_SCORED_AT_ONCE = 256
# Groups that the tasks' results for a query are ranked in before they meet.
_GROUPS = 64


def _scorer(sent: dict, k: int, key: str, by: str | None = None):
    """A function for ``mapInArrow``: the best keys of a task's rows for every query.

    ``sent`` holds slices (ids, matrix) of queries: those under None for all rows, or, where
    the rows have a column ``by``, those for the rows of each of its values. Built as a
    closure so that executors need no copy of this package.
    """
    at_once = _SCORED_AT_ONCE

    def matrix_of(column, rows, width):
        import pyarrow.compute as pc

        if rows and pc.any(pc.not_equal(pc.list_value_length(column), width)).as_py():
            raise ValueError(f"the index has vectors that are not of the query's length {width}")
        return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(rows, width)

    def lengths(matrix):
        import numpy as np

        # A zero vector is divided by 1 instead of its norm: similarity 0.
        norms = np.sqrt((matrix * matrix).sum(axis=1))
        norms[norms == 0] = 1.0
        return norms

    def best(batch, ids, queries):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        batch = batch.filter(pc.is_valid(batch.column("embedding")))
        if batch.num_rows == 0 or len(ids) == 0:
            return None
        # In key order, so that among equal scores the first rows are the right ones.
        batch = batch.take(pc.sort_indices(batch, sort_keys=[(key, "ascending")]))
        matrix = matrix_of(batch.column("embedding"), batch.num_rows, queries.shape[1])
        norms = lengths(matrix)
        keep = min(k, batch.num_rows)
        found = []
        for start in range(0, len(ids), at_once):
            part = queries[start : start + at_once].astype("float64")
            scores = (matrix @ part.T) / (norms[:, None] * lengths(part)[None, :])
            # Equal vectors must score equally wherever they stand in the batch.
            scores = np.round(scores, 12)
            bar = np.partition(scores, batch.num_rows - keep, axis=0)[batch.num_rows - keep]
            above, level = scores > bar, scores == bar
            room = keep - above.sum(axis=0)
            taken = above | (level & (np.cumsum(level, axis=0, dtype="int32") <= room))
            row, query = np.nonzero(taken)
            found.append((row, query + start, scores[row, query]))
        row, query, score = (np.concatenate(parts) for parts in zip(*found))
        keys = batch.column(key).combine_chunks().take(pa.array(row))
        return pa.table({"query_id": ids.take(pa.array(query)), key: keys, "similarity": score})

    def cut(table):
        """The first k rows of each query by similarity, then key."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        order = [("query_id", "ascending"), ("similarity", "descending"), (key, "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=order))
        codes = pc.rank(table.column("query_id"), tiebreaker="min").to_numpy()
        place = np.arange(1, table.num_rows + 1) - codes
        return table.filter(pa.array(place < k))

    def parts(table):
        import pyarrow.compute as pc

        if by is None:
            yield from ((table, *own) for own in sent[None])
            return
        for value in pc.unique(table.column(by)).to_pylist():
            rows = table.filter(pc.equal(table.column(by), value))
            yield from ((rows, *own) for own in sent.get(value, ()))

    def score(batches):
        import pyarrow as pa

        kept = None
        for batch in batches:
            for rows, ids, matrix in parts(pa.Table.from_batches([batch])):
                found = best(rows, ids, matrix)
                if found is not None:
                    kept = found if kept is None else cut(pa.concat_tables([kept, found]))
        if kept is not None:
            yield from kept.combine_chunks().to_batches()

    return score


def collected(queries: DataFrame, size: int):
    """Slices (ids, matrix) of ``size`` queries each; one scan's queries, a bounded number."""
    import numpy as np

    found = queries.toArrow().combine_chunks()
    slices = []
    for start in range(0, found.num_rows, size):
        part = found.slice(start, size).combine_chunks()
        ids, vectors = (part.column(name).combine_chunks() for name in ("query_id", "embedding"))
        slices.append((ids, np.asarray(vectors.flatten()).reshape(part.num_rows, -1)))
    return slices


def _scans(queries: DataFrame, count: int, size: int):
    """Slices of at most about ``SCAN`` queries at a time, chosen by a hash of their id.

    If there are more, they are written once, a folder for each scan.
    """
    if count <= SCAN:
        yield collected(queries, size)
        return
    parts, path = -(-count // SCAN), shared_folder(queries.sparkSession, "queries")
    scan = F.pmod(F.xxhash64("query_id"), F.lit(parts).cast("long"))
    queries.withColumn("scan", scan).write.partitionBy("scan").parquet(path)
    schema = T.StructType([*queries.schema.fields, T.StructField("scan", T.LongType())])
    written = queries.sparkSession.read.schema(schema).parquet(path)
    for part in range(parts):
        yield collected(written.where(F.col("scan") == part).drop("scan"), size)


def results_schema(queries: DataFrame, index: DataFrame, key: str) -> T.StructType:
    fields = [queries.schema["query_id"], index.schema[key], T.StructField("similarity", T.DoubleType())]
    return T.StructType(fields)


def _ranked(found: DataFrame, k: int, key: str) -> DataFrame:
    """The first ``k`` of each query, with their rank: within groups of tasks, then of all."""

    def first(df: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("similarity"), key)
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    grouped = found.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(_GROUPS)))
    return first(first(grouped, "query_id", "_group").drop("rank", "_group"), "query_id")


def with_metadata(ranked: DataFrame, index: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """Ranked keys with the index's other columns; ``most`` bounds the number of keys, if known."""
    metadata = [name for name in index.columns if name != "embedding"]
    if most is not None and most <= _SENT_KEYS:
        ranked = F.broadcast(ranked)
    return ranked.join(index.select(metadata), key).select("query_id", "rank", *metadata, "similarity")


def semantic_search_batch(
    index: DataFrame, queries: DataFrame, k: int = 10, key: str = "repo_id", slice_size: int = SLICE
) -> DataFrame:
    """query_id, rank, index metadata, similarity: the ``k`` best rows for every query.

    ``queries`` has query_id (unique) and embedding; ``key`` is unique in the index. The
    index is scanned once for ``SCAN`` queries, which a task scores ``slice_size`` at a
    time. What one scan leaves, ``k`` keys for each query, is joined with the metadata
    right away; the keys of several scans are written to the shared folder first. Vectors
    of another length than the query's are an error.
    """
    spark = index.sparkSession
    queries = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    schema, count = results_schema(queries, index, key), queries.count()

    def ranked(slices: list) -> DataFrame:
        found = index.select(key, "embedding").mapInArrow(_scorer({None: slices}, k, key), schema)
        return _ranked(found, k, key)

    scans = _scans(queries, count, slice_size)
    if count <= SCAN:
        return with_metadata(ranked(next(scans)), index, key, count * k)
    path = shared_folder(spark, "search")
    for slices in scans:
        ranked(slices).write.mode("append").parquet(path)
    return with_metadata(spark.read.schema(schema.add("rank", T.IntegerType())).parquet(path), index, key)


def semantic_search(
    index: DataFrame, vector: Sequence[float], k: int = 10, key: str = "repo_id"
) -> DataFrame:
    """Index metadata and similarity of the ``k`` rows closest to one vector, best first.

    Fewer rows if the index has fewer; none if it is empty. One scan of the index, by the
    scorer that many queries have; the vector goes straight to it.
    """
    import numpy as np
    import pyarrow as pa

    sent = {None: [(pa.array([0], pa.int32()), np.array([[float(x) for x in vector]]))]}
    key_field = index.schema[key]
    schema = T.StructType([T.StructField("query_id", T.IntegerType()), key_field, T.StructField("similarity", T.DoubleType())])
    ranked = _ranked(index.select(key, "embedding").mapInArrow(_scorer(sent, k, key), schema), k, key)
    found = with_metadata(ranked, index, key, k)
    return found.drop("query_id", "rank").orderBy(F.desc("similarity"), key).limit(k)


def search_display(results: DataFrame) -> DataFrame:
    """What a reader sees of a result; defaults stand in for missing metadata."""
    return results.select(
        "full_name",
        F.coalesce(missing_if_empty("language"), F.lit("Unknown")).alias("language"),
        F.coalesce("stars", F.lit(0).cast("bigint")).alias("stars"),
        F.round("similarity", 3).alias("similarity"),
        F.coalesce(missing_if_empty("description"), F.lit("_no description_")).alias("description"),
    )
