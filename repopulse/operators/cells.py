"""Approximate search: an index partitioned by coarse cells, of which few are read.

Centroids are fitted on a bounded sample of the vectors; every row of the index belongs
to the cell of the centroid it is closest to, and cells are folders of the table. A query
reads only the ``probes`` cells closest to it. What it misses are rows of other cells:
``recall`` measures that against the exact search, which stays the default.
"""

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import unit
from ..session import shared_folder
from ..sources.tables import file_system
from .search import SCAN, SLICE, _ranked, _scorer, collected, results_schema, with_metadata

# Most vectors that the centroids are fitted on; a hash of the key chooses them. All rows
# are indexed, whatever the sample.
SAMPLE = 100_000
CELLS, PROBES, ROUNDS = 32, 8, 12
CELL = "cell"


def fit_cells(index: DataFrame, cells: int = CELLS, sample: int = SAMPLE, key: str = "repo_id", seed: int = 1) -> list[list[float]]:
    """Unit centroids of at most ``cells`` cells, by k-means with cosine distance.

    Null and zero vectors have no direction and take no part. At most ``sample`` vectors
    are clustered, and ``cells`` centroids reach the driver.
    """
    vectors = index.where(F.exists("embedding", lambda x: x != 0))
    share = sample / max(vectors.count(), 1)
    if share < 1:
        bucket = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 20).cast("long"))
        vectors = vectors.where(bucket < int(share * (1 << 20)))
    points = vectors.select(array_to_vector(unit("embedding")).alias("features")).persist()
    try:
        if points.isEmpty():
            return []
        means = KMeans(k=cells, maxIter=ROUNDS, seed=seed, distanceMeasure="cosine").fit(points).clusterCenters()
    finally:
        points.unpersist()
    return [[float(x) for x in mean] for mean in means]


def nearest(centroids: Sequence[Sequence[float]], count: int = 1):
    """A column function: the ``count`` cells closest to a vector, closest first.

    Null vectors have none; vectors without a direction are equally close to all, so the
    first cells are theirs.
    """

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def cells(vectors):
        import numpy as np
        import pyarrow as pa

        means = np.asarray(centroids, dtype="float64")
        kept = min(count, len(means))
        valid = vectors.drop_null()
        rows = np.asarray(valid.flatten(), dtype="float64").reshape(len(valid), means.shape[1])
        order = np.argsort(-np.round(rows @ means.T, 9), axis=1, kind="stable")[:, :kept].astype("int32")
        found = iter(order)
        return pa.array([next(found) if ok else None for ok in vectors.is_valid().to_pylist()], pa.list_(pa.int32()))

    return cells


def _centroids(path: str) -> str:
    return f"{path.rstrip('/')}/_centroids"


def write_cells(index: DataFrame, path: str, centroids: Sequence[Sequence[float]]) -> None:
    """Append rows to the index at ``path``, each to its cell; the first call keeps the centroids.

    Rows without a vector are in a cell that no query probes. ``rebalance`` gathers a cell
    into few files and splits one that is too big for a task.
    """
    spark = index.sparkSession
    files, place = file_system(spark, _centroids(path))
    if not files.exists(place):
        rows = spark.createDataFrame(list(enumerate(map(list, centroids))), "cell int, centroid array<double>")
        rows.coalesce(1).write.parquet(_centroids(path))
    cell = F.coalesce(F.try_element_at(nearest(read_centroids(spark, path))("embedding"), F.lit(1)), F.lit(-1))
    index.withColumn(CELL, cell).hint("rebalance", CELL).write.mode("append").partitionBy(CELL).parquet(path)


def read_centroids(spark: SparkSession, path: str) -> list[list[float]]:
    return [row["centroid"] for row in spark.read.parquet(_centroids(path)).orderBy("cell").collect()]


def search_cells(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 10, probes: int = PROBES, key: str = "repo_id"
) -> DataFrame:
    """query_id, rank, index metadata, similarity: about the ``k`` best rows for every query.

    As ``semantic_search_batch``, but a query is compared only with the rows of the
    ``probes`` cells closest to it. Only cells that some query of a scan probes are read.
    """
    import numpy as np
    import pyarrow as pa

    index, centroids = spark.read.parquet(path), np.asarray(read_centroids(spark, path))
    queries = queries.select("query_id", "embedding").where(F.col("embedding").isNotNull())
    schema, columns = results_schema(queries, index, key), [name for name in index.columns if name != CELL]

    def ranked(part: DataFrame) -> DataFrame:
        sent: dict[int, list] = {}
        for ids, matrix in collected(part, SLICE):
            order = np.argsort(-np.round(matrix.astype("float64") @ centroids.T, 9), axis=1, kind="stable")[:, :probes]
            for cell in np.unique(order).tolist():
                rows = np.flatnonzero((order == cell).any(axis=1))
                sent.setdefault(cell, []).append((ids.take(pa.array(rows)), matrix[rows]))
        probed = index.where(F.col(CELL).isin(list(sent)))
        return _ranked(probed.select(key, "embedding", CELL).mapInArrow(_scorer(sent, k, key, CELL), schema), k, key)

    count = queries.count()
    if count <= SCAN:
        return with_metadata(ranked(queries), index.select(columns), key, count * k)
    found = shared_folder(spark, "search")
    parts = -(-count // SCAN)
    for number in range(parts):
        own = queries.where(F.pmod(F.xxhash64("query_id"), F.lit(parts).cast("long")) == number)
        ranked(own).write.mode("append").parquet(found)
    written = spark.read.schema(schema.add("rank", T.IntegerType())).parquet(found)
    return with_metadata(written, index.select(columns), key)


def recall(exact: DataFrame, found: DataFrame, key: str = "repo_id") -> DataFrame:
    """query_id, wanted, hits: how many of a query's exact results were found."""
    hits = found.select("query_id", key).withColumn("hit", F.lit(1))
    both = exact.select("query_id", key).join(hits, ["query_id", key], "left")
    return both.groupBy("query_id").agg(F.count("*").alias("wanted"), F.count("hit").alias("hits"))
