"""The daily mart as a materialised table, partitioned by date."""

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession

from ..schemas import MART
from .tables import file_system, read_or_empty, replace_table, set_aside


class AuditFailed(RuntimeError):
    """A new mart failed its checks and wasn't published; ``rows`` are the failing ones.

    The table stays at ``path`` for inspection, the mart before it is still the mart.
    """

    def __init__(self, rows: list[Row], path: str):
        failed = ", ".join(f"{row['check']} of {row['column']}: {row['failing_rows']}" for row in rows)
        super().__init__(f"the mart at {path} failed {failed}")
        self.rows, self.path = rows, path


def write_mart(mart: DataFrame, path: str, audit: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Full refresh: write, audit, publish.

    The new mart is written beside the old one. ``audit`` gives rows of checks with
    ``passed`` for the table as it was written; if one failed, the old mart stays and
    ``AuditFailed`` is raised. Else the new one takes its place, whatever the session's
    overwrite mode is. ``rebalance`` gathers each date into few files and splits a date
    that is too big for one task.
    """
    spark, new = mart.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    (
        mart.to(MART)
        .hint("rebalance", "event_date")
        .write.option("compression", "snappy")
        .partitionBy("event_date")
        .parquet(new)
    )
    if audit:
        failed = audit(read_mart(spark, new)).where("not passed").collect()
        if failed:
            raise AuditFailed(failed, new)
    replace_table(spark, new, path.rstrip("/"))


def replace_dates(rows: DataFrame, path: str, dates: list[date]) -> None:
    """Put ``rows`` in the place of all rows of ``dates``, each date as a whole."""
    spark = rows.sparkSession
    (
        rows.to(MART)
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("event_date")
        .parquet(path)
    )
    left = {row.event_date for row in rows.select("event_date").distinct().collect()}
    for gone in set(dates) - left:
        files, place = file_system(spark, f"{path.rstrip('/')}/event_date={gone}")
        files.delete(place, True)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    """The mart, or an empty one if none was ever written.

    If a refresh died between setting the old mart aside and publishing the new one,
    there is a mart but not at its place: an error, that says where it is.
    """
    files, place = file_system(spark, path)
    if not files.exists(place):
        aside = set_aside(spark, path)
        if aside:
            raise RuntimeError(f"a refresh of {path} was interrupted; the mart before it is at {aside[0]}")
    return read_or_empty(spark, path, MART).select(MART.names)
