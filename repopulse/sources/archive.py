"""Hourly archives: gzip JSON lines, one file (or folder) per UTC hour.

The hour is part of the name, ``2024-01-31-7.json.gz``, with the day zero-padded
and the hour not. A gzip file cannot be split, so one hour is one task; a job over
many hours runs as many tasks as there are files.
"""

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.events import moment
from .tables import file_system

_DATE_AND_HOUR = r".*(\d{4}-\d{2}-\d{2}-\d{1,2})(?:\.json|/)"
PUBLICATION_LAG = timedelta(hours=2)
# Folders between the one that is listed and an archive, at the most.
DEPTH = 8


def resolve_hour(timestamp: str | None = None, now: datetime | None = None) -> datetime:
    """UTC hour to ingest: that of an ISO timestamp, else the last one surely published."""
    if timestamp:
        wanted = datetime.fromisoformat(timestamp)
    else:
        wanted = (now or datetime.now(timezone.utc)) - PUBLICATION_LAG
    if wanted.tzinfo is None:
        wanted = wanted.replace(tzinfo=timezone.utc)
    wanted = wanted.astimezone(timezone.utc)
    return datetime(wanted.year, wanted.month, wanted.day, wanted.hour)


def archive_name(hour: Column) -> Column:
    """File name of the archive that holds ``hour`` (a timestamp without zone)."""
    day = hour.cast("date").cast("string")
    return F.concat(day, F.lit("-"), F.hour(hour).cast("string"), F.lit(".json.gz"))


def archive_hours(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """One row per hour from ``start`` up to and without ``end``: hour, file."""
    first, last = resolve_hour(start.isoformat()), resolve_hour(end.isoformat())
    hours = spark.range(int((last - first).total_seconds()) // 3600).select(
        (moment(first) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("hour")
    )
    return hours.withColumn("file", archive_name(F.col("hour")))


def _stamp_of_path(path: Column) -> Column:
    """The date and hour in an archive's path, as in ``2024-01-31-7``; empty without them."""
    return F.regexp_extract(path, _DATE_AND_HOUR, 1)


def _hour_of_stamp(stamp: Column) -> Column:
    day, hour = F.substring(stamp, 1, 10).try_cast("date"), F.substring(stamp, 12, 2).try_cast("int")
    return F.when(hour < 24, day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour))


def hour_of_path(path: Column) -> Column:
    """The hour named by an archive's path, as a timestamp without zone; else NULL.

    A day has the hours 0 to 23; any other number names no hour.
    """
    return _hour_of_stamp(_stamp_of_path(path))


def _dated(first: datetime, last: datetime) -> str:
    """Glob of the names of all days (months, for long ranges) from first to last."""
    days = (first.date() + timedelta(days=n) for n in range((last.date() - first.date()).days + 1))
    kind = "%Y-%m-%d-" if last - first <= timedelta(days=31) else "%Y-%m-"
    return "*{" + ",".join(dict.fromkeys(f"{day:{kind}}" for day in days)) + "}*"


def list_archives(spark: SparkSession, folder: str, first: datetime, last: datetime) -> DataFrame:
    """hour, path, size of the archives below a folder for hours from ``first`` to ``last``.

    An archive is a file, or a folder of files, that is named by its hour, in the folder
    itself or up to ``DEPTH`` folders below it. Of files, those of that range are listed,
    however many others there are, and none is read.
    """
    patterns = [f"{folder.rstrip('/')}/{'*/' * depth}{_dated(first, last)}" for depth in range(DEPTH + 1)]
    there = [pattern for pattern in patterns if _matches(spark, pattern)]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if there:
        # A dated file in a dated folder is found at both depths.
        found = files.load(there).select("path", "length").dropDuplicates(["path"])
    else:
        found = spark.createDataFrame([], "path string, length bigint").where(F.lit(False))
    listed = found.select(hour_of_path(F.col("path")).alias("hour"), "path", F.col("length").alias("size"))
    return listed.where(F.col("hour").between(moment(first), moment(last)))


def _matches(spark: SparkSession, pattern: str) -> bool:
    files, place = file_system(spark, pattern)
    return bool(files.globStatus(place))


def keep_repeated_keys(spark: SparkSession) -> None:
    """An object that has a key twice is JSON, and the last value counts."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _with_hour(lines: DataFrame) -> DataFrame:
    # No filter on the hour here: it would be evaluated for every line. As a projection
    # it is computed only for the lines that later filters keep. The stamp is a column of
    # its own, so that each of those lines searches its path once and not once per use.
    stamped = lines.select("value", _stamp_of_path(F.col("_metadata.file_path")).alias("stamp"))
    return stamped.select("value", _hour_of_stamp(F.col("stamp")).alias("archive_hour"))


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Raw lines of the given archives: value, archive_hour."""
    keep_repeated_keys(spark)
    return _with_hour(spark.read.text(paths, recursiveFileLookup=True))


def stream_lines(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """The same columns from a folder that receives new gzip files."""
    keep_repeated_keys(spark)
    lines = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz")
        .text(folder)
    )
    return _with_hour(lines)


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """hour, file, size of the gzip files that arrive in a folder; none of them is read."""
    found = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.gz")
        .load(folder)
    )
    named = found.select(hour_of_path(F.col("path")).alias("hour"), F.col("path").alias("file"), F.col("length").alias("size"))
    return named.where(F.col("hour").isNotNull())
