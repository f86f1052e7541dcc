"""The pipeline's rows against its stages done plainly, one after another."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from repopulse.llm import quality
from repopulse.llm.common import Remembered
from repopulse.llm.queries import fold
from tests.llm.test_near_duplicates import plain_roots
from tests.llm.test_packing import check_pieces
from tests.llm.test_rules import plain_verdicts

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.materialised(stage(spark, docs[-1], FOLDER), name))
    return docs


def test_every_stage_against_a_plain_version(spark, stages):
    raw, good, ruled, unique, packed = (df.collect() for df in stages)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").where(fold(3) != 1)
    model = quality.fit(stages[0], labels)
    chances = model.probabilities([doc.text for doc in raw], Remembered(quality._row))
    assert {doc.doc_id for doc in good} == {doc.doc_id for doc, p in zip(raw, chances) if p >= 0.5}

    _, kept = plain_verdicts(good)
    assert {doc.doc_id for doc in ruled} == {doc_id for doc_id in kept if kept[doc_id]}

    # The smallest doc_id of each group by five words at 0.8; documents in order of their ids.
    ordered = sorted(ruled, key=lambda doc: doc.doc_id)
    roots = plain_roots([doc.text for doc in ordered])
    left = sorted(doc.doc_id for doc in unique)
    assert left == sorted(ordered[place].doc_id for place in set(roots))

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {doc.doc_id: tokenizer.encode(doc.text, add_special_tokens=False).ids + [1] for doc in unique}
    check_pieces(packed, expected, 2048)


def test_stages_keep_the_columns_and_clean_documents(spark, stages):
    assert all(df.schema == stages[0].schema for df in stages[:4])
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    clean = stages[0].join(labels.where("quality = 1"), "doc_id").where(F.size(F.split("text", r"\s+")) >= 60)
    kept = stages[2].select("doc_id").join(clean, "doc_id").count()
    assert kept > 0.95 * clean.count()
    junk = labels.where("quality = 0")
    assert stages[2].join(junk, "doc_id").count() < 0.1 * stages[0].join(junk, "doc_id").count() + 1


def test_columns_of_any_name_and_repeated_ids(spark):
    """Names that the stages use inside, a document twice, and one id with two texts."""
    text = " ".join(f"word{n}" for n in range(60))
    other = " ".join(f"other{n}" for n in range(60))
    rows = [(5, text), (5, text), (2, text), (7, other), (7, text), (None, other), (None, "x y z"), (3, None), (3, " ")]
    names = ["key", "hash", "stay", "root", "node", "copies", "__row", "__size", "__lang", "__m", "row", "measure", "a.b"]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"`{name}` int" for name in names)
    docs = spark.createDataFrame([(*row, "xx", *range(len(names))) for row in rows], schema)
    found = corpus_pipeline.near_duplicates(spark, docs, "")
    assert found.columns == docs.columns
    left = sorted(((row.doc_id, row.text) for row in found.collect()), key=str)
    assert left == sorted([(2, text), (7, other), (None, "x y z"), (3, None), (3, " ")], key=str)
    assert [tuple(row)[3:] for row in found.collect()] == [tuple(range(len(names)))] * 5
    ruled = corpus_pipeline.quality_rules(spark, docs, "")
    assert ruled.schema == docs.schema and ruled.count() <= 6


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER)
    assert rows.columns == stages[-1].columns
    totals = [df.agg(F.sum("length"), F.countDistinct("doc_id")).first() for df in (rows, stages[-1])]
    assert totals[0] == totals[1]


def test_odd_documents(spark, tmp_path):
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clean = spark.read.parquet(f"{FOLDER}/documents.parquet").join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id")
    clean = clean.where("lang = 'en' and quality = 1").orderBy("doc_id").limit(60).collect()
    long = " ".join(doc.text for doc in clean)  # prose, or the fertility bands reject it
    rows = [(1, None, None, None, None), (None, "", "en", "a", 0), (7, long, "en", "a", 1), (7, long, "en", "a", 1), (None, long, None, "b", 2)]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, 1), (1, 0)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    pieces = corpus_pipeline.run(spark, folder).collect()
    # Ids 1 and 7 are in folds to learn from. Of the equal long texts one stays; the others
    # have too few words.
    assert sum(row.length for row in pieces) == pieces[0].doc_tokens
    empty = tmp_path / "empty"
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
