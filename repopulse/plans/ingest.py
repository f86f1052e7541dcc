"""Ingest archives into the lake: one hour, a range, or the hours that files arrived for."""

import uuid
from datetime import datetime, timedelta
from hashlib import md5

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.events import moment
from ..operators.ingest import (
    drop_repeated,
    flatten_events,
    keep_types,
    kept_events,
    parsed_line,
    report_counts,
)
from ..schemas import RAW
from ..sources.archive import list_archives, read_lines
from ..sources.lake import (
    append_once,
    ingested_hours,
    ledger,
    record_files,
    record_hours,
    skip_existing,
    with_partitions,
    write_lake,
    written_partitions,
)


def flat_rows(lines: DataFrame, once: bool = False) -> DataFrame:
    """Lines to rows of the lake; ``once`` drops repeated deliveries of an event."""
    events = flatten_events(kept_events(lines))
    return with_partitions(drop_repeated(events) if once else events)


def ingest_hour(spark: SparkSession, source: str, hour: datetime, lake: str) -> dict:
    """Ingest one hour's archive and report what it held, in one pass.

    Counting ``total`` means parsing every line, kept or not; ``backfill`` does not
    count and so parses only candidates. A missing archive raises.
    """
    report = Observation("ingest")
    lines = read_lines(spark, f"{source.rstrip('/')}/{hour:%Y-%m-%d}-{hour.hour}.json.gz")
    events = lines.select(parsed_line().alias("event"), "archive_hour")
    counts = [count.alias(name) for name, count in report_counts().items()]
    raw = with_partitions(flatten_events(keep_types(events.observe(report, *counts))))
    write_lake(skip_existing(raw, written_partitions(spark, lake, hour, hour)), lake)
    record_hours(spark.range(1).select(moment(hour).alias("hour")), lake)
    return {"counts": report.get, "hour": f"{hour.isoformat()}+00:00"}


def pending_archives(
    spark: SparkSession, source: str, lake: str, first: datetime, last: datetime
) -> DataFrame:
    """hour, path, size of the archives from ``first`` to ``last`` that weren't ingested before.

    Hours that a stream takes file by file are left to it.
    """
    wanted = list_archives(spark, source, first, last)
    streamed = ledger(spark, lake).select("hour").distinct()
    return wanted.join(ingested_hours(spark, lake, first, last), "hour", "left_anti").join(streamed, "hour", "left_anti")


def months(start: datetime, end: datetime) -> list[tuple[datetime, datetime]]:
    """The range from ``start`` up to and without ``end``, cut at the first of each month."""
    cuts = [start]
    while cuts[-1] < end:
        later = cuts[-1].replace(day=1, hour=0) + timedelta(days=32)
        cuts.append(min(end, later.replace(day=1)))
    return list(zip(cuts, cuts[1:]))


def backfill(
    spark: SparkSession, source: str, lake: str, start: datetime, end: datetime, once: bool = False
) -> None:
    """Ingest every archive from ``start`` up to and without ``end`` that wasn't before.

    A job and a commit for each month, so that years are published as they come and a
    lost job costs a month: each archive is a task. The driver handles the paths of the
    month's pending archives only. Hours without an archive are left out. Partitions that
    the lake has are kept, and the hours are recorded, so a rerun reads nothing.
    ``once`` keeps one of several rows with an event id and hour.
    """
    for since, until in months(start, end):
        last = until - timedelta(hours=1)
        pending = pending_archives(spark, source, lake, since, last).collect()
        if pending:
            raw = flat_rows(read_lines(spark, [row.path for row in pending]), once)
            write_lake(skip_existing(raw, written_partitions(spark, lake, since, last)), lake)
            record_archives(spark, pending, lake)


def record_archives(spark: SparkSession, listed: list, lake: str) -> None:
    """Remember the hours, and the files of each, that ``listed`` (hour, path, size) holds."""
    files = spark.createDataFrame([tuple(row) for row in listed], "hour timestamp_ntz, file string, size bigint")
    record_files(files, lake, uuid.uuid4().hex)
    record_hours(files, lake)


def replace_hours(
    spark: SparkSession, source: str, arrived: DataFrame, lake: str, once: bool = False
) -> None:
    """Ingest the hours that the files of ``arrived`` belong to, as they are now.

    An hour may be a folder of files that arrive one by one. Its partitions are replaced
    by what all its files hold, so it doesn't matter which of them arrived together, and
    a repeated call changes nothing. Files whose path names no hour are no archives, and
    an hour is only recorded if files of it were listed and read.
    """
    hours = [row.hour for row in arrived.select(F.col("archive_hour").alias("hour")).distinct().collect() if row.hour]
    if hours:
        touched = spark.createDataFrame([(hour,) for hour in hours], "hour timestamp_ntz")
        listed = list_archives(spark, source, min(hours), max(hours)).join(touched, "hour", "left_semi").collect()
        if listed:
            write_lake(flat_rows(read_lines(spark, [row.path for row in listed]), once), lake)
            record_archives(spark, listed, lake)


def append_files(spark: SparkSession, arrived: DataFrame, lake: str) -> None:
    """Ingest the files of ``arrived`` (hour, file, size) that the lake doesn't have yet.

    Each file is read once, whatever else its hour gets: its rows join those that are in
    the hour's partitions. The ledger tells which files the lake has; hours that were
    ingested as a whole before there was a ledger for them are complete. The commit is
    named by the files, so a repeated call adds nothing, also after a call that died.
    """
    rows = arrived.select("hour", "file", "size").collect()  # one micro-batch's paths
    if not rows:
        return
    commit = md5("\n".join(sorted(row.file for row in rows)).encode()).hexdigest()
    files = spark.createDataFrame([tuple(row) for row in rows], "hour timestamp_ntz, file string, size bigint")
    known = ledger(spark, lake).where(F.col("commit") != commit)
    whole = ingested_hours(spark, lake, min(row.hour for row in rows), max(row.hour for row in rows))
    whole = whole.join(known.select("hour").distinct(), "hour", "left_anti")
    new = files.join(known.select("file"), "file", "left_anti").join(whole, "hour", "left_anti")
    paths = [row.file for row in new.collect()]
    raw = flat_rows(read_lines(spark, paths)) if paths else spark.createDataFrame([], RAW)
    append_once(raw, lake, commit, new)
