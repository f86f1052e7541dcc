"""Keep the daily distinct counts of owners and accounts up to date with the lake.

Below one folder: ``numbers`` (the dictionary), and for owners and accounts a table of
totals and one of bitmaps, with a partition for each lake day.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.distincts import DAY, day_stamp, new_numbers, organization_days, organizations_of, user_days, users_of
from ..schemas import NUMBERS
from ..sources.lake import read_lake
from ..sources.tables import file_system, read_or_empty
from .refresh import changed_days, lake_files, write_seen, written

DAYS_OF = {"organizations": organization_days, "users": user_days}


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, f"{path}/numbers", NUMBERS)


def refresh_distincts(spark: SparkSession, lake: str, path: str) -> list[str]:
    """Count the lake days whose files changed since the last call; returns them.

    Other days' raw events aren't read. A day is replaced as a whole, and the record of
    the lake's files is written last, so a call that died is repeated by the next one.
    """
    path = path.rstrip("/")
    now = written(lake_files(spark, lake), "seen")
    days = changed_days(spark, now, path)
    if not days:
        return days
    raw = read_lake(spark, lake).where(day_stamp().isin(days))
    values = raw.select("repo_name").union(raw.select("actor_login")).toDF("value")
    new_numbers(values, read_numbers(spark, path)).write.mode("append").parquet(f"{path}/numbers")
    numbers = read_numbers(spark, path)
    for name, counted in DAYS_OF.items():
        for kind, table in zip(("totals", "bitmaps"), counted(raw, numbers)):
            _replace_days(table, f"{path}/{name}-{kind}", days)
    write_seen(now, path)
    return days


def _replace_days(table: DataFrame, path: str, days: list[str]) -> None:
    writer = table.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)
    spark = table.sparkSession
    # A day without a row, because it left the lake, has no folder to be replaced by.
    left = {row[DAY] for row in table.select(DAY).distinct().collect()}
    for gone in set(days) - left:
        files, place = file_system(spark, f"{path}/{DAY}={gone}")
        files.delete(place, True)


def _read(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    found = (spark.read.parquet(f"{path.rstrip('/')}/{name}-{kind}") for kind in ("totals", "bitmaps"))
    return tuple(table.withColumn(DAY, F.col(DAY).cast("string")) for table in found)


def organizations(spark: SparkSession, path: str, year: str, k: int = 50) -> DataFrame:
    return organizations_of(*_read(spark, path, "organizations"), year, k)


def users(spark: SparkSession, path: str, year: str, min_events: int = 5, k: int = 50) -> DataFrame:
    return users_of(*_read(spark, path, "users"), year, min_events, k)
