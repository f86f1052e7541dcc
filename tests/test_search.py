import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

from repopulse.functions.vectors import unit
from repopulse.operators import cells, embedding, search
from repopulse.schemas import INDEX
from repopulse.sources.index import read_index, write_index


def make_index(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [
        (int(n), f"o/r{n}", f"text {n}", "go", int(n), None if v is None else [float(x) for x in v])
        for n, v in zip(ids, vectors)
    ]
    return spark.createDataFrame(rows, INDEX)


def make_queries(spark, vectors, names=None):
    names = names or [f"q{n:03}" for n in range(len(vectors))]
    rows = [(name, [float(x) for x in v]) for name, v in zip(names, vectors)]
    return spark.createDataFrame(rows, "query_id string, embedding array<float>")


def brute_force(vectors, query, k):
    vectors, query = np.asarray(vectors, "float32").astype("float64"), np.asarray(query, "float32").astype("float64")
    norms = np.linalg.norm(vectors, axis=1)
    scores = vectors @ query / (np.where(norms == 0, 1, norms) * (np.linalg.norm(query) or 1))
    scores = np.round(scores, 12)
    order = sorted(range(len(vectors)), key=lambda n: (-scores[n], n))[:k]
    return [(n, scores[n]) for n in order]


def check(rows, expected):
    assert [row.repo_id for row in rows] == [n for n, _ in expected]
    assert np.allclose([row.similarity for row in rows], [s for _, s in expected])


@pytest.fixture(scope="module")
def vectors():
    return np.random.default_rng(3).normal(size=(700, 12)).round(3)


def test_unit(spark):
    index = make_index(spark, [[3, 4], [0, 0], None, [1, 0]])
    found = {row.repo_id: row.u for row in index.select("repo_id", unit("embedding").alias("u")).collect()}
    assert np.allclose(found[0], [0.6, 0.8]) and found[1] == [0, 0] and found[2] is None


def test_one_query(spark, vectors):
    index = make_index(spark, vectors).repartition(7)
    rows = search.semantic_search(index, list(vectors[5]), k=10).collect()
    check(rows, brute_force(vectors, vectors[5], 10))
    assert rows[0].repo_id == 5 and rows[0].full_name == "o/r5" and "embedding" not in rows[0]


def test_zero_vectors_score_zero(spark):
    index = make_index(spark, [[1, 0], [0, 0], [-1, 0]])
    rows = search.semantic_search(index, [2.0, 0.0]).collect()
    assert [(row.repo_id, row.similarity) for row in rows] == [(0, 1.0), (1, 0.0), (2, -1.0)]
    rows = search.semantic_search(index, [0.0, 0.0]).collect()
    assert [row.similarity for row in rows] == [0, 0, 0]


def test_k_beyond_the_index_and_empty_index(spark):
    index = make_index(spark, [[1, 0], [0, 1], None])
    assert search.semantic_search(index, [1.0, 0.0], k=50).count() == 2
    assert search.semantic_search(index.where("false"), [1.0, 0.0]).count() == 0
    queries = make_queries(spark, [[1, 0]])
    assert search.semantic_search_batch(index.where("false"), queries).count() == 0
    assert search.semantic_search_batch(index, queries.where("false")).count() == 0


@pytest.mark.parametrize("slice_size", [4096, 16, 1])
def test_many_queries(spark, vectors, slice_size):
    """However many slices they take: the same rows."""
    asked = vectors[100 : 140 if slice_size > 1 else 104] + 0.1
    queries = make_queries(spark, asked)
    index = make_index(spark, vectors).repartition(5)
    found = search.semantic_search_batch(index, queries, k=7, slice_size=slice_size).collect()
    assert len(found) == 7 * len(asked)
    for number, query in enumerate(asked):
        rows = sorted((row for row in found if row.query_id == f"q{number:03}"), key=lambda row: row.rank)
        assert [row.rank for row in rows] == list(range(1, 8))
        check(rows, brute_force(vectors, query, 7))


@pytest.mark.parametrize("slice_size", [4096, 2])
def test_copies_tie_and_the_lowest_keys_win(spark, vectors, slice_size):
    """A third of the index are copies of one vector."""
    many = np.concatenate([vectors, np.repeat(vectors[:1], 350, axis=0)])
    index = make_index(spark, many).repartition(6)
    queries = make_queries(spark, vectors[:5])
    found = search.semantic_search_batch(index, queries, k=20, slice_size=slice_size)
    rows = sorted(found.where("query_id = 'q000'").collect(), key=lambda row: row.rank)
    assert [row.repo_id for row in rows] == [0, *range(700, 719)]


def test_numeric_query_ids_and_metadata(spark, vectors):
    queries = make_queries(spark, vectors[:3]).withColumn("query_id", F.substring("query_id", 2, 3).cast("bigint"))
    found = search.semantic_search_batch(make_index(spark, vectors), queries, k=1)
    assert found.columns == [
        "query_id", "rank", "repo_id", "full_name", "description", "language", "stars", "similarity",
    ]
    assert {(row.query_id, row.repo_id) for row in found.collect()} == {(0, 0), (1, 1), (2, 2)}


def test_mixed_lengths_are_an_error(spark, folder):
    index = make_index(spark, [[1, 0], [0, 1], [1, 2, 3]])
    with pytest.raises(PythonException, match="not of the query's length 2"):
        search.semantic_search(index, [1.0, 0.0]).collect()
    path = folder("index")
    write_index(make_index(spark, [None, [1, 0]]), path)
    with pytest.raises(SparkRuntimeException, match="vectors of 2 elements, not of 3"):
        write_index(make_index(spark, [[1, 2, 3]], ids=[7]), path)
    write_index(make_index(spark, [[0, 1]], ids=[8]), path)
    assert read_index(spark, path).count() == 3


def test_no_text_leaves_the_scoring(spark, vectors):
    scored = search._scorer({None: [(pa.array([0]), np.ones((1, 2)))]}, 1, "repo_id")
    table = pa.table({"repo_id": [3, 4], "embedding": [[1.0, 0.0], [1.0, 1.0]]})
    (best,) = scored(table.to_batches())
    assert best.schema.names == ["query_id", "repo_id", "similarity"]
    assert best.column("repo_id").to_pylist() == [4]


def test_display_defaults(spark):
    columns = "full_name string, language string, stars bigint, similarity double, description string"
    rows = [("a/b", None, None, 0.12345, None), ("c/d", "", 5, 1.0, ""), ("e/f", "go", 7, 0.5, "x")]
    shown = [tuple(row) for row in search.search_display(spark.createDataFrame(rows, columns)).collect()]
    assert shown == [
        ("a/b", "Unknown", 0, 0.123, "_no description_"),
        ("c/d", "Unknown", 5, 1.0, "_no description_"),
        ("e/f", "go", 7, 0.5, "x"),
    ]


def test_more_queries_than_one_scan_takes(spark, vectors, monkeypatch):
    """Several scans, whose keys are written before they are joined: the same rows."""
    index, queries = make_index(spark, vectors).repartition(4), make_queries(spark, vectors[:30] + 0.1)
    once = search.semantic_search_batch(index, queries, k=5).collect()
    monkeypatch.setattr(search, "SCAN", 8)
    assert sorted(search.semantic_search_batch(index, queries, k=5).collect()) == sorted(once)


def test_an_index_is_encoded_once(spark, folder):
    """Looking at the vectors' length doesn't run the encoder again."""
    seen = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            seen.add(len(texts))
            return [[len(text), 1.0] for text in texts]

        return model

    texts = make_index(spark, [[0, 0]] * 20).drop("embedding").withColumn("text", F.col("description"))
    encoded = embedding.index_rows(embedding.encode(texts, embedding.model_encoder(load)))
    path = folder("index")
    write_index(encoded, path)
    assert seen.value == 20 and read_index(spark, path).count() == 20


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    return np.concatenate([centre + 0.15 * rng.normal(size=(80, 16)) for centre in centres]).round(3)


def test_cells(spark, folder, clustered):
    path = folder("cells")
    index = make_index(spark, [*clustered, None, [0] * 16]).repartition(6)
    centroids = cells.fit_cells(index, cells=12, sample=400)
    assert len(centroids) <= 12 and np.allclose(np.linalg.norm(centroids, axis=1), 1)
    cells.write_cells(index.where("repo_id < 500"), path, centroids)
    cells.write_cells(index.where("repo_id >= 500"), path, [[1.0] * 16])  # the first centroids stay
    assert cells.read_centroids(spark, path) == centroids
    assert spark.read.parquet(path).count() == index.count()  # every row is indexed
    queries = make_queries(spark, clustered[::16] + 0.01)
    exact = search.semantic_search_batch(index, queries)
    found = cells.search_cells(spark, path, queries, probes=3)
    hits = cells.recall(exact, found).agg(F.sum("hits"), F.sum("wanted")).first()
    assert hits[1] == 10 * queries.count() and hits[0] >= 0.9 * hits[1]
    # All cells probed: what the exact search finds, but for rows without a vector.
    assert sorted(cells.search_cells(spark, path, queries, probes=12).collect()) == sorted(exact.collect())
    assert cells.search_cells(spark, path, queries.where("false")).count() == 0


def test_only_probed_cells_are_read(spark, folder, clustered):
    path = folder("cells")
    index = make_index(spark, clustered)
    cells.write_cells(index, path, cells.fit_cells(index, cells=8))
    found = cells.search_cells(spark, path, make_queries(spark, clustered[:1]), probes=1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan or "PartitionFilters: [isnotnull(cell" in plan


def test_cells_of_nothing(spark, folder):
    assert cells.fit_cells(make_index(spark, [None, [0, 0]])) == []
