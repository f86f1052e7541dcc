"""From raw documents to packed training sequences, one written table per stage.

Stages are ``(name, function)``; a function takes (spark, docs, folder of tables) and
returns the documents it keeps, with their columns; the last one returns the pieces of
the sequences. Each stage reads what the one before it wrote in the cluster's shared
folder, so a lost executor costs at most the stage that runs.
"""

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import ngram_join, packing, quality, rules
from repopulse.llm.common import KeyFilter, free_name, materialised, ship
from repopulse.llm.queries import PIECES, WORDS, fold

#: Near copies share this much (part, whole) of their shingles of so many words.
NEAR, SHINGLE = (80, 100), 5


def stage(function):
    """Sees to it that the executors have the package, however the stage is called."""

    @wraps(function)
    def shipped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, docs, sf_dir)

    return shipped


@stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for quality 1.

    It learns from the labels of two folds out of three; the third stays held out. Rows are
    judged alone and keep all their columns, whatever these are called: repeated rows get
    equal verdicts, ids and languages may be null. Null and empty texts have a score like
    any text. Without labels every score is one half, and all rows stay; an empty table
    gives an empty one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold(3) != 1)
    model = quality.fit(docs, labels)
    return docs.where(quality.score(model) >= 0.5)


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie within the fertility bands.

    Null, empty and short texts fail; long ones are measured whole. Rows are judged alone,
    against bands that repeated rows count in as often as they occur; a null language is a
    language of its own. All columns come back as they were, whatever they are called; an
    empty table gives an empty one.
    """
    judged = rules.judge_quality(docs.select("text", "lang", F.struct("*").alias("row")), PIECES, carry=["row"])
    return judged.where("kept").select("row.*")


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal or similar documents, and those without words.

    Similar is what shares four fifths of its five-word shingles. The row that stays is
    the one of the smallest doc_id (null ids come last), then of the smallest hash of its
    text; of rows that agree in both, any one. Null and empty texts and texts of white
    space resemble nothing and stay. Columns may have any names; an empty table gives an
    empty one.
    """
    groups = ngram_join.keyed_components(docs, NEAR, shingle=SHINGLE).where("n_shingles > 0")
    rows = materialised(groups.groupBy("root", "doc_id", "key").agg(F.count("*").alias("copies")), "pipeline-rows")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "copies")
    first = rows.groupBy("root").agg(F.min(order).alias("first"))
    judged = rows.join(materialised(first, "pipeline-first"), "root")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    judged = materialised(judged.select("doc_id", "key", "copies", stays.alias("stays")), "pipeline-judged")

    # Rows of which some may go meet the verdicts; a filter of fixed size passes the others by.
    key = free_name(docs, "key")
    keyed = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    doubtful = KeyFilter(judged.where("not stays or copies > 1"), "key").passes(F.col(key))
    met = keyed.where(doubtful)

    def kept(one: DataFrame) -> DataFrame:
        same = (met[key] == one["key"]) & met["doc_id"].eqNullSafe(one["doc_id"])
        return met.join(one, same, "left_semi")

    several = kept(judged.where("stays and copies > 1")).dropDuplicates(["doc_id", key])
    wordless = met.where(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    stay = kept(judged.where("stays and copies = 1")).unionByName(several).unionByName(wordless)
    return keyed.where(~doubtful).unionByName(stay).drop(key)


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the sequences that hold the documents left, along the curve.

    A null or empty text is its end token alone, a long one is cut over sequences. Each
    row is a document of its own, also where ids repeat or are null; equal places on the
    curve have one order. Only doc_id and text are read, so other columns can't clash; an
    empty table gives an empty one.
    """
    return packing.pack(docs, WORDS, with_ids=False)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("packing", packed),
]

#: The classifier, the fertility bands and the packing order have no SQL form;
#: tests/llm/test_pipeline.py compares the rows with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = materialised(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
