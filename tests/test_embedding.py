import tracemalloc
from datetime import date
from hashlib import md5
from math import log

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from repopulse.functions import text as text_functions
from repopulse.operators import embedding as emb
from repopulse.operators.catalog import text_chunks
from repopulse.plans.embed import encode_query, new_rows, refresh_index, search_text
from repopulse.schemas import INDEX, MART, REPO
from repopulse.sources.index import read_index

AS_OF = date(2024, 3, 31)


@pytest.fixture
def mart(spark):
    def row(repo, name, day, stars):
        return (repo, name, date(2024, 3, day), stars, 0, 0, 0, None, stars)

    rows = [
        row(1, "a/one", 10, 5), row(1, "a/one", 11, 5), row(2, "b/two", 10, 9),
        row(3, "c/old", 10, 8), row(3, "c/new", 20, 6), row(4, "d/four", 10, 1),
        (5, "e/five", date(2024, 2, 28), 99, 0, 0, 0, None, 99),
    ]
    return spark.createDataFrame(rows, MART)


@pytest.fixture
def repos(spark):
    rows = [
        (1, "a/one", "first text", "go", 100), (2, "b/two", "", None, None),
        (3, "c/new", None, "", 300), (9, "z/nine", "never asked for", "go", 1),
    ]
    return spark.createDataFrame(rows, REPO)


def test_candidates(mart):
    rows = [tuple(row) for row in emb.embed_candidates(mart, AS_OF).collect()]
    assert rows == [(1, "a/one", 10), (2, "b/two", 9), (3, "c/old", 8), (3, "c/new", 6), (4, "d/four", 1)]
    assert emb.embed_candidates(mart, AS_OF, n=2).count() == 2


def test_one_name_each(mart):
    names = {row.repo_id: row.full_name for row in emb.one_name_each(emb.embed_candidates(mart, AS_OF)).collect()}
    assert names[3] == "c/old" and len(names) == 4


def test_refresh_appends_only_new_rows(spark, mart, repos, folder):
    path = folder("index")
    assert read_index(spark, path).count() == 0
    refresh_index(spark, mart, repos.where("repo_id = 1"), path, emb.letters26, AS_OF)
    refresh_index(spark, mart, repos, path, emb.letters26, AS_OF)
    refresh_index(spark, mart, repos, path, emb.letters26, AS_OF)
    index = read_index(spark, path)
    assert index.schema == INDEX
    found = {row.repo_id: row for row in index.collect()}
    # 4 is unknown to the dimension, 5 out of the window, 9 not a candidate.
    assert sorted(found) == [1, 2, 3] and index.count() == 3
    assert found[1].stars == 100  # lifetime count, not the window's sum
    assert sum(found[2].embedding) == 4  # "b/two": no description, so the name is encoded


def test_no_side_of_unknown_size_is_broadcast(spark):
    many = spark.range(5_000_000).select(
        F.col("id").alias("repo_id"), F.lit("a/b").alias("full_name"), F.lit(1).cast("bigint").alias("stars")
    )
    repos = many.select("repo_id", F.lit("x").alias("description"), F.lit("go").alias("language"), "stars")
    for df in (emb.embed_pending(many, many.select("repo_id")), emb.repo_enrich(many, repos)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_md5_vectors(spark):
    texts = spark.createDataFrame(
        [(1, "One two, two"), (2, "two"), (3, ""), (4, None)], "repo_id bigint, text string"
    )
    weights = emb.fit_md5(texts, dimensions=16)
    found = {row.repo_id: row.embedding for row in emb.md5_encoder(weights)(texts).collect()}
    places = {word: int(md5(word.encode()).hexdigest()[:8], 16) % 16 for word in ("one", "two")}
    assert places["one"] != places["two"]
    one, two = log(5 / 2), 2 * log(5 / 3)
    norm = (one * one + two * two) ** 0.5
    assert found[1][places["one"]] == pytest.approx(one / norm)
    assert found[1][places["two"]] == pytest.approx(two / norm)
    assert found[2][places["two"]] == 1 and sum(found[2]) == 1
    assert sum(found[3]) == 0 and found[4] is None


def test_letters(spark):
    vector = encode_query(spark, "Abba? ÄZ", emb.letters26)
    assert len(vector) == 26 and vector[0] == 2 and vector[1] == 2 and vector[25] == 1 and sum(vector) == 5


def test_hashing_model_can_be_saved(spark, folder):
    texts = spark.createDataFrame([(n, f"word{n} shared text") for n in range(5)], "repo_id bigint, text string")
    model = emb.fit_hashing(texts, dimensions=64)
    path = folder("model")
    model.write().save(path)
    direct = emb.hashing_encoder(model)(texts).orderBy("repo_id").collect()
    loaded = emb.hashing_encoder(PipelineModel.load(path))(texts).orderBy("repo_id").collect()
    assert direct == loaded and len(direct[0].embedding) == 64
    assert encode_query(spark, "word3 shared text", emb.hashing_encoder(model)) == direct[3].embedding


def test_user_model(spark):
    def load():
        return lambda texts: [[len(text), len(texts)] for text in texts]

    texts = spark.createDataFrame([(n, "x" * n) for n in range(70)], "repo_id bigint, text string").coalesce(1)
    encoder = emb.model_encoder(load, batch=32)
    found = {row.repo_id: row.embedding for row in emb.encode(texts, encoder).collect()}
    assert all(found[n][0] == n for n in range(70))
    assert max(vector[1] for vector in found.values()) == 32


def test_search_text(spark, mart, repos):
    index = new_rows(mart, repos, spark.createDataFrame([], INDEX), emb.letters26, AS_OF)
    best = search_text(spark, index, "TEXT first", emb.letters26, k=1).first()
    assert best.repo_id == 1 and best.similarity == pytest.approx(1.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5), st.integers(1, 20), st.data())
def test_chunks_cover_whole_texts(spark, texts, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    texts = [text.replace("\x00", "") for text in texts]
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    chunks = {}
    for row in text_chunks(df, size, overlap).collect():
        chunks.setdefault(row.doc_id, {})[row.chunk_no] = row.text
    for number, text in enumerate(texts):
        parts = chunks.get(number, {})
        assert sorted(parts) == list(range(len(parts)))
        whole = "".join(part if n == 0 else part[overlap:] for n, part in sorted(parts.items()))
        assert whole == text
        assert all(len(part) <= size for part in parts.values())


def test_chunk_bounds(spark):
    with pytest.raises(ValueError):
        text_chunks(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), 5, 5)


@pytest.fixture
def in_task(monkeypatch):
    """The functions that are sent to Python workers, as they are made."""
    made = []

    def arrow_udf(_kind):
        return lambda function: made.append(function) or (lambda column: column)

    monkeypatch.setattr("pyspark.sql.functions.arrow_udf", arrow_udf)
    return made


def peak_mb(function):
    tracemalloc.start()
    try:
        return function(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_letters_take_no_many_times_the_texts(in_task):
    """Also where a text is longer than what is counted at once."""
    text_functions.letter_counts("text")
    texts = pa.array(["ab", "A" * 3_000_000 + "b", None, "", "Zz\u00e9" * 500_000, "c"]).slice(1)
    counts, peak = peak_mb(lambda: in_task[0](texts))
    rows = counts.to_pylist()
    assert peak < 60 and [row and sum(row) for row in rows] == [3_000_001, None, 0, 1_000_000, 1]
    assert rows[0][:2] == [3_000_000, 1] and rows[3][25] == 1_000_000 and rows[4][2] == 1


@given(st.lists(st.one_of(st.none(), st.text("aBz{@\u00e9 ", max_size=12)), max_size=8), st.integers(1, 9))
@settings(deadline=None, max_examples=60)
def test_letters_counted_in_parts(texts, size):
    with pytest.MonkeyPatch.context() as patch:
        made = []
        patch.setattr("pyspark.sql.functions.arrow_udf", lambda _kind: lambda function: made.append(function) or (lambda c: c))
        patch.setattr(text_functions, "_BYTES_AT_ONCE", size)
        text_functions.letter_counts("text")
    letters = [chr(ord("a") + n) for n in range(26)]
    expected = [None if text is None else [text.lower().count(letter) for letter in letters] for text in texts]
    assert made[0](pa.array(texts, pa.string())).to_pylist() == expected


def test_hashing_works_on_few_rows_at_a_time(in_task):
    emb._md5_vectors(384, [1.0] * 384)
    texts = pa.array(["a b", None, ""] * 4_000)
    sizes, peak = peak_mb(lambda: [len(part) for part in in_task[0](iter([texts, texts.slice(0, 1)]))])
    assert sum(sizes) == 12_001 and peak < 25


def test_a_model_works_on_few_rows_at_a_time(in_task):
    asked = []

    def load():
        return lambda texts: asked.append(len(texts)) or np.array([[len(text or "")] * 64 for text in texts])

    emb.model_encoder(load, batch=100)
    texts = pa.array(["a" * (n % 7) for n in range(10_000)] + ["b" * emb.SLICE_BYTES, None])
    parts = [(len(part), sum(asked)) for part in in_task[0](iter([texts]))]
    # Vectors leave as soon as their slice is done.
    assert sum(asked) == 10_002 and max(asked) <= 100 and max(size for size, _ in parts) <= emb.SLICE_ROWS
    assert [done for _, done in parts] == list(np.cumsum([size for size, _ in parts]))
