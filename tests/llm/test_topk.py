import numpy as np
import pytest

from checks.compare import connect, difference, oracle_rows, spark_rows
from repopulse.llm import topk
from repopulse.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def plain(ids, vectors, query, k):
    """Best k of all rows with another id, for one row."""
    found = [(int(-(np.floor(64 * vectors[query]) @ np.floor(64 * v))), i) for i, v in zip(ids, vectors) if i != ids[query]]
    return [(i, -score) for score, i in sorted(found)[:k]]


def table(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 7) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def by_query(df):
    found = {}
    for row in sorted(df.collect(), key=lambda row: (row.query_id, row.rank)):
        found.setdefault(row.query_id, []).append((row.vec_id, row.score))
    return found


@pytest.mark.parametrize("blocks", [(8192, 4096), (3, 16)])
@pytest.mark.parametrize("kind", ["even", "clustered", "copies"])
def test_against_a_plain_search(spark, monkeypatch, kind, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "ROW_BLOCK", blocks[1])
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(160, 13)).astype("f4")
    if kind == "clustered":
        vectors = (vectors * 0.01 + rng.normal(size=(8, 13))[rng.integers(0, 8, 160)]).astype("f4")
    if kind == "copies":
        vectors[::3] = vectors[0]
    ids = list(range(160))
    found = by_query(topk.top_k(table(spark, ids, vectors), k=9))
    assert sorted(found) == list(range(0, 160, 20))
    for query in found:
        assert found[query] == plain(ids, vectors.astype(float), query, 9)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(8)
    a, b = rng.normal(size=(50, 24)) * 100, rng.normal(size=(70, 24)) * 100
    exact = a @ b.T
    for level in (1, 2, 8, 24):
        bound = topk.statistics(a, level) @ topk.statistics(b, level).T
        assert (bound >= exact - 1e-6).all()
    # Segments of one component leave nothing open.
    assert np.allclose(bound, exact)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], [3, 4], None, [1, None], [nan, 1], [inf, 1], [], [1, 2, 3], [-1, -0.001], [5, 5]]
    ids = [0, 1, 2, 3, 4, 5, 20, 40, 60, None]
    found = by_query(topk.top_k(table(spark, ids, vectors), k=20))
    # Ids 0 and 60 have two components, 40 has no other row of its length.
    assert found == {
        0: [(1, 64 * 64 * 11), (60, -64 * 64 - 128)],
        60: [(0, -64 * 64 - 128), (1, -64 * 64 * 3 - 256)],
    }


def test_repeated_rows_and_empty_table(spark):
    vectors = table(spark, [0, 0, 1, 1, 2], [[1, 1], [1, 1], [2, 2], [2, 2], [0, 1]])
    rows = topk.top_k(vectors, k=3).collect()
    assert sorted((row.query_id, row.rank, row.vec_id) for row in rows) == sorted(
        [(0, 1, 1), (0, 2, 1), (0, 3, 2)] * 2
    )
    assert topk.top_k(vectors.where("false")).count() == 0
    assert topk.top_k(vectors.where("vec_id = 1")).count() == 0


def test_large_components_stay_exact(spark):
    vectors = table(spark, [0, 1, 2], [[1e6, 1.0], [1e6, 2.0], [1e6, 3.0]])
    big = 64 * 10**6
    assert by_query(topk.top_k(vectors))[0] == [(2, big * big + 64 * 192), (1, big * big + 64 * 128)]


def test_the_query_against_sql(spark):
    ours = spark_rows(QUERIES["op3_exact_top_k"](spark, FOLDER))
    assert difference(ours, oracle_rows(connect(FOLDER), ORACLE["op3_exact_top_k"])) is None
