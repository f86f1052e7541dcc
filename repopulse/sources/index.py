"""The search index: repository metadata and its vector side by side in one table."""

import uuid

from pyspark.errors import SparkRuntimeException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INDEX
from .tables import file_system, move_files, read_or_empty


def write_index(index: DataFrame, path: str) -> None:
    """Append rows; rows already indexed are never rewritten.

    All vectors of an index have one length: that of the rows already there, else that
    of the first new row. A vector of another length fails the write.
    """
    spark = index.sparkSession
    size, staged = F.size("embedding"), f"{path.rstrip('/')}/_staged/{uuid.uuid4().hex}"
    # Encoded once: the rows are written aside, looked at, and moved in.
    index.to(INDEX).write.option("compression", "snappy").parquet(staged)
    new = read_index(spark, staged).where("embedding is not null").agg(F.min(size), F.max(size)).first()
    known = read_index(spark, path).where("embedding is not null").select(size).first()
    length = known[0] if known else new[0]
    for found in new:
        if found is not None and found != length:
            files, place = file_system(spark, staged)
            files.delete(place, True)
            raise SparkRuntimeException(f"the index has vectors of {length} elements, not of {found}")
    move_files(spark, staged, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index, or an empty one if nothing has been indexed."""
    return read_or_empty(spark, path, INDEX)
