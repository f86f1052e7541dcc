import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import quality
from repopulse.llm.common import Remembered
from repopulse.llm.queries import QUERIES, fold

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op9_quality_classifier"](spark, FOLDER).cache()


def test_held_out_accuracy(spark, scored):
    judged = scored.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert len(judged) > 80
    assert (judged.predicted == judged.quality).mean() > 0.94
    right = np.where(judged.quality == 1, judged.score, 1 - judged.score)
    assert -np.log(np.maximum(right, 1e-9)).mean() < 0.2


def test_the_query_covers_all_documents(spark, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert scored.count() == docs.count()
    assert scored.where("score < 0 or score > 1 or predicted <> cast(score >= 0.5 as int)").count() == 0
    expected = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1).count()
    assert scored.where("held_out").count() == expected


def test_other_columns_and_held_out_labels_change_nothing(spark, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(fold(3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = quality.classify(
        docs.withColumns({"lang": F.lit("zz"), "source": F.lit(None), "score": F.lit("clash")}), flipped.where(fold(3) != 1)
    )
    both = again.select("doc_id", F.col("score").alias("again")).join(scored, "doc_id")
    assert both.where(F.abs(F.col("again") - F.col("score")) > 1e-6).count() == 0


def test_word_vectors_against_a_loop(spark):
    texts = ["a b c a", "b c", None, "", "c", "a b"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    vectors = quality.word_vectors(df)
    places, signs = quality.index_vectors()
    index = np.zeros((quality.ROWS, quality.WIDTH))
    for k in range(quality.NONZERO):
        np.add.at(index, (np.arange(quality.ROWS), places[:, k]), signs[:, k])
    expected = np.zeros_like(index)
    for text in texts:
        rows = [quality._row(word) for word in quality.WORDS(text or "")]
        for i, row in enumerate(rows):
            for j in range(max(0, i - quality.REACH), min(len(rows), i + quality.REACH + 1)):
                if i != j:
                    expected[row] += index[rows[j]]
    expected /= np.maximum(np.linalg.norm(expected, axis=1, keepdims=True), 1e-12)
    assert np.allclose(vectors[:, : quality.WIDTH], expected, atol=1e-6)
    assert np.allclose(vectors[:, quality.WIDTH :], index)


def test_training_is_repeatable_and_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    y = (rng.random(3000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    order = rng.permutation(3000)
    one, other = quality.train(x, y), quality.train(x[order], y[order])
    assert np.allclose(one.probability(x), other.probability(x))
    chances = one.probability(x)
    for low in (0.1, 0.3, 0.5, 0.7):
        inside = (chances >= low) & (chances < low + 0.2)
        assert abs(chances[inside].mean() - y[inside].mean()) < 0.1


@pytest.mark.parametrize("y", [[], [1, 1, 1], [0] * 20])
def test_too_little_to_learn(y):
    network = quality.train(np.zeros((len(y), 5)), np.array(y))
    assert np.allclose(network.probability(np.ones((2, 5))), (sum(y) + 1) / (len(y) + 2))


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None), (1, ""), (None, "some words"), (2, "word " * 100_000), (3, "!!! ###"), (3, "!!! ###")],
        "doc_id long, text string",
    )
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, None), (3, 7), (None, 1), (9, 0)], "doc_id long, quality int"
    )
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 6 and all(0 <= row.score <= 1 for row in rows)
    # The one label that counts is that of the two rows of document 1.
    assert len({round(row.score, 9) for row in rows}) == 1 and rows[0].score == pytest.approx(3 / 4)
    assert quality.classify(docs.where("false"), labels).count() == 0
    assert quality.classify(docs, labels.where("false")).first().score == pytest.approx(0.5)


def test_an_empty_text_has_the_zero_vector():
    assert not quality.document_vector(quality._rows([None], Remembered(quality._row))[0], np.ones((quality.ROWS, 64))).any()


def test_score_of_a_fixed_network_against_plain_arithmetic(spark):
    """Mean, deviation and agreement of word vectors through both layers, word by word."""
    rng = np.random.default_rng(4)
    width = 4 * quality.WIDTH + 3
    layers = [rng.normal(0, 0.1, (width, 5)), rng.normal(size=5), rng.normal(size=5), np.array([0.3])]
    network = quality.Network(rng.normal(size=width), rng.uniform(1, 2, width), layers, temperature=1.7)
    vectors = rng.normal(size=(quality.ROWS, 2 * quality.WIDTH)).astype(np.float32)
    texts = ["one two three two", "Word!! 12 word", "single", "", None, "a b " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string").repartition(2)
    found = {row.n: row.p for row in df.select("n", quality.score(quality.Classifier(vectors, network)).alias("p")).collect()}
    for n, text in enumerate(texts):
        words = [vectors[quality._row(word)].astype(float) for word in quality.WORDS(text or "")]
        x = np.zeros(width)
        if words:
            size = 2 * quality.WIDTH
            x[:size] = [sum(word[k] for word in words) / len(words) for k in range(size)]
            x[size : 2 * size] = [(sum((word[k] - x[k]) ** 2 for word in words) / len(words)) ** 0.5 for k in range(size)]
            both = list(zip(words, words[1:]))
            if both:
                agree = [sum(a[k] * b[k] for a, b in both) / len(both) for k in range(size)]
                x[-3], x[-2] = sum(agree[: quality.WIDTH]), sum(agree[quality.WIDTH :])
            x[-1] = np.log(len(words))
        z = (x - network.centre) / network.scale
        hidden = [np.tanh(sum(z[i] * layers[0][i, j] for i in range(width)) + layers[1][j]) for j in range(5)]
        logit = sum(h * v for h, v in zip(hidden, layers[2])) + layers[3][0]
        assert found[n] == pytest.approx(1 / (1 + np.exp(-logit / 1.7)), abs=2e-4)  # vectors are 32-bit


def test_repeated_labelled_rows_are_one_row_with_a_weight(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(200, 6)), rng.integers(0, 2, 200)
    times = rng.integers(1, 4, 200)
    chances = quality.train(x, y, times=times).probability(x)
    assert not np.allclose(chances, quality.train(x, y).probability(x))
    assert np.allclose(chances, quality.train(x, y, times=5 * times).probability(x), atol=1e-3)
    # A labelled id with a third of all rows, equal and different ones, sends few rows.
    rows = [(n, f"text number {n} of many") for n in range(60)] + [(7, "again and again")] * 500
    rows += [(8, f"variant {n}") for n in range(300)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(60)], "doc_id long, quality int")
    sent = []
    monkeypatch.setattr(quality, "train", lambda x, y, **more: sent.append((len(y), more["times"].sum())) or quality.Network(0, 1, []))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    quality.fit(docs, labels)
    quality.fit(docs, labels, most=100)
    assert sent[0] == (361, 860) and sent[1][0] < 160
