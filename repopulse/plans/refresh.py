"""Incremental refresh of the mart: what changed in the lake, and nothing else.

Beside the mart lies its state: counts by lake day, repository, date and name (``counts``,
a partition for each lake day), the lake's files as they were when the mart was last
refreshed (``seen``), and the repository-days whose change isn't in the mart yet
(``touched``). A refresh reads the raw events of changed lake days only, recounts the
repository-days that they hold or held, and recomputes the windows of their repositories
from the mart's own history. Dates on which a row changed are replaced as a whole.

A refresh that dies is repeated by the next one: ``touched`` is written before ``counts``
changes, and ``seen`` only when the mart is up to date.
"""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activity import GRAIN, daily_of, named_counts, repo_trends_daily
from ..operators.quality import mart_checks
from ..schemas import ACTIVITY, COUNTS, MART, SEEN, TOUCHED
from ..session import shared_folder
from ..sources.lake import read_lake
from ..sources.mart import read_mart, replace_dates, write_mart
from ..sources.tables import file_system, read_or_empty, replace_table

_DAY_OF_PATH = r"/year=(\d+)/month=(\d+)/day=(\d+)/"


def _state(mart: str, name: str) -> str:
    return f"{mart.rstrip('/')}-state/{name}"


def _lake_day() -> Column:
    return F.concat_ws("-", "year", "month", "day")


def lake_files(spark: SparkSession, lake: str) -> DataFrame:
    """lake_day, files, hash: how many files a day of the lake has, and which.

    Files are listed, not read. A day's hash covers the names, which are unique for each
    write, and the sizes of its files.
    """
    files, place = file_system(spark, lake)
    if not files.exists(place):
        return spark.createDataFrame([], SEEN)
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(lake).select("path", "length")
    day = F.concat_ws("-", *(F.regexp_extract("path", _DAY_OF_PATH, part) for part in (1, 2, 3)))
    name = F.substring_index("path", "/event_type=", -1)
    by_day = found.where(F.col("path").rlike(_DAY_OF_PATH)).groupBy(day.alias("lake_day"))
    return by_day.agg(F.count("*").alias("files"), F.bit_xor(F.xxhash64(name, "length")).alias("hash"))


def changed_days(spark: SparkSession, now: DataFrame, mart: str) -> list[str]:
    """Days of the lake whose files aren't those the mart was last refreshed from."""
    before = read_or_empty(spark, _state(mart, "seen"), SEEN).withColumnsRenamed({"files": "files_before", "hash": "before"})
    both = now.join(before, "lake_day", "full")
    differs = ~(F.col("hash").eqNullSafe(F.col("before")) & F.col("files").eqNullSafe(F.col("files_before")))
    return sorted(row.lake_day for row in both.where(differs).select("lake_day").collect())


def _write_state(df: DataFrame, mart: str, name: str) -> None:
    new = f"{_state(mart, name)}-{uuid.uuid4().hex}"
    df.write.parquet(new)
    replace_table(df.sparkSession, new, _state(mart, name))


def write_seen(now: DataFrame, mart: str) -> None:
    """The lake's files that the tables at ``mart`` are up to date with."""
    _write_state(now, mart, "seen")


def written(df: DataFrame, label: str) -> DataFrame:
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def recount(spark: SparkSession, lake: str, mart: str, days: list[str]) -> DataFrame:
    """Bring ``counts`` up to date for ``days`` of the lake; the repository-days to refresh."""
    counts = read_or_empty(spark, _state(mart, "counts"), COUNTS)
    raw = read_lake(spark, lake).withColumn("lake_day", _lake_day()).where(F.col("lake_day").isin(days))
    new = written(named_counts(raw, "lake_day").to(COUNTS), "counts")
    pending = read_or_empty(spark, _state(mart, "touched"), TOUCHED)
    held = counts.where(F.col("lake_day").isin(days)).select(*GRAIN)
    touched = held.union(new.select(*GRAIN)).union(pending.select(*GRAIN)).distinct()
    _write_state(touched, mart, "touched")
    path = _state(mart, "counts")
    new.hint("rebalance", "lake_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "lake_day"
    ).parquet(path)
    for gone in set(days) - {row.lake_day for row in new.select("lake_day").distinct().collect()}:
        files, place = file_system(spark, f"{path}/lake_day={gone}")
        files.delete(place, True)
    return read_or_empty(spark, _state(mart, "touched"), TOUCHED)


def refreshed_rows(mart: DataFrame, counts: DataFrame, touched: DataFrame) -> DataFrame:
    """The mart's rows, as they should be, of all repositories that ``touched`` names.

    Only touched repository-days are counted anew; the others are the mart's own.
    """
    span = touched.agg(F.min("event_date"), F.max("event_date")).first()
    near = counts.where(F.col("event_date").between(*span))  # reaches the files' statistics
    recounted = daily_of(near.join(touched, list(GRAIN), "left_semi"))
    repos = touched.select("repo_id").distinct()
    history = mart.join(repos, "repo_id", "left_semi").join(touched, list(GRAIN), "left_anti")
    return repo_trends_daily(history.select(ACTIVITY.names).unionByName(recounted)).select(MART.names)


def refresh_mart(spark: SparkSession, lake: str, mart: str) -> list[str]:
    """Bring the mart up to date with the lake; returns the lake days that had changed.

    The first refresh, or one without state, builds the mart as a whole, with its checks.
    Late and replaced hours, renames and days that left the lake are all followed: the
    mart then equals a full rebuild. One refresh of a mart runs at a time.
    """
    now = written(lake_files(spark, lake), "seen")
    days = changed_days(spark, now, mart)
    pending = read_or_empty(spark, _state(mart, "touched"), TOUCHED)
    if not days and pending.isEmpty():
        return days
    first = not all(files.exists(place) for files, place in (file_system(spark, p) for p in (mart, _state(mart, "seen"))))
    if first:
        days = [row.lake_day for row in now.select("lake_day").collect()]
    touched = recount(spark, lake, mart, days)
    counts = read_or_empty(spark, _state(mart, "counts"), COUNTS)
    if first:
        write_mart(repo_trends_daily(daily_of(counts)), mart, mart_checks)
    else:
        _replace_changed(read_mart(spark, mart), counts, touched, mart)
    write_seen(now, mart)
    _write_state(touched.limit(0), mart, "touched")
    return days


def _replace_changed(old: DataFrame, counts: DataFrame, touched: DataFrame, path: str) -> None:
    rows = written(refreshed_rows(old, counts, touched), "refreshed")
    repos = written(touched.select("repo_id").distinct(), "repositories")
    before = old.join(repos, "repo_id", "left_semi")
    differ = rows.exceptAll(before).select("event_date").union(before.exceptAll(rows).select("event_date"))
    dates = [row.event_date for row in differ.distinct().collect()]  # bounded by the calendar
    if dates:
        on_dates = F.col("event_date").isin(dates)
        others = old.where(on_dates).join(repos, "repo_id", "left_anti")
        replace_dates(written(rows.where(on_dates).unionByName(others), "dates"), path, dates)
