"""Weekly refresh of the search index, and text search on it."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators.embedding import (
    Encoder,
    embed_candidates,
    embed_pending,
    embed_text,
    encode,
    index_rows,
    one_name_each,
    repo_enrich,
)
from ..operators.search import semantic_search
from ..session import shared_folder
from ..sources.index import read_index, write_index


def new_rows(
    mart: DataFrame, repos: DataFrame, index: DataFrame, encoder: Encoder,
    as_of: date | None = None, days: int = 30, n: int = 500,
) -> DataFrame:
    """Index rows for the current candidates that the index lacks.

    The candidates are ranked once: they are written, at most ``n`` rows, before the
    index and the dimension are joined.
    """
    spark, path = mart.sparkSession, shared_folder(mart.sparkSession, "candidates")
    embed_candidates(mart, as_of, days, n).write.parquet(path)
    pending = embed_pending(spark.read.parquet(path), index)
    enriched = repo_enrich(one_name_each(pending), repos)
    return index_rows(encode(embed_text(enriched), encoder))


def refresh_index(
    spark: SparkSession, mart: DataFrame, repos: DataFrame, path: str, encoder: Encoder,
    as_of: date | None = None, n: int = 500,
) -> None:
    """Append the new rows to the index at ``path``."""
    write_index(new_rows(mart, repos, read_index(spark, path), encoder, as_of, n=n), path)


def encode_query(spark: SparkSession, text: str, encoder: Encoder) -> list[float]:
    """The vector of one query text."""
    encoded = encode(spark.createDataFrame([(text,)], "text string"), encoder)
    return list(encoded.first()["embedding"])


def search_text(spark: SparkSession, index: DataFrame, text: str, encoder: Encoder, k: int = 10) -> DataFrame:
    return semantic_search(index, encode_query(spark, text, encoder), k)
