"""The raw lake: Parquet under event_type/year/month/day/hour.

The partition hour is the archive's, not ``created_at``'s. A partition is the unit
of idempotence: it is written once, as a whole, and skipped afterwards. That is
safe for one writer at a time; concurrent writers of one hour are not supported.
"""

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.events import moment, zero_padded
from ..schemas import INGESTED, LEDGER, PARTITIONS, RAW
from .tables import file_system, move_files, read_or_empty

STAMP_FORMAT = "%Y%m%d%H"


def with_partitions(flat: DataFrame) -> DataFrame:
    """Flat events plus the five partition columns, in the lake's schema."""
    hour = F.col("archive_hour")
    return flat.withColumns(
        {
            "event_type": F.col("type"),
            "year": zero_padded(F.year(hour), 4),
            "month": zero_padded(F.month(hour)),
            "day": zero_padded(F.day(hour)),
            "hour": zero_padded(F.hour(hour)),
        }
    ).to(RAW)


def write_lake(raw: DataFrame, path: str, compact: bool = False) -> None:
    """Write the partitions present in ``raw``; leave all others alone.

    Dynamic overwrite moves each partition into place as a whole. Where a folder is
    renamed atomically, a job that dies leaves a partition complete or absent; an
    object store copies, so there it may be torn, and only ``ingested_hours`` tells.
    Hourly gzip archives need no shuffle here: one task reads a whole hour, so each
    partition gets one file. ``compact`` is for inputs that spread an hour over many tasks;
    it lets AQE gather each partition, and split one that is too big for a task.
    """
    if compact:
        raw = raw.hint("rebalance", *PARTITIONS)
    (
        raw.to(RAW)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    """The lake with its partitions as string columns; empty if there is none yet."""
    return read_or_empty(spark, path, RAW)


def partition_stamp() -> Column:
    """The partition's hour as sortable text; ``STAMP_FORMAT`` reads it back."""
    return F.concat(*[F.col(name) for name in PARTITIONS[1:]])


def _folders(first: datetime, last: datetime) -> str:
    """Glob of the day folders (month folders for long ranges) from first to last."""
    days = (first.date() + timedelta(days=n) for n in range((last.date() - first.date()).days + 1))
    if last - first <= timedelta(days=31):
        folders = [f"year={day:%Y}/month={day:%m}/day={day:%d}" for day in days]
    else:
        folders = list(dict.fromkeys(f"year={day:%Y}/month={day:%m}" for day in days))
    return "event_type=*/{" + ",".join(folders) + "}"


def written_partitions(spark: SparkSession, path: str, first: datetime, last: datetime) -> DataFrame:
    """Partitions the lake holds for hours from ``first`` to ``last``, both included.

    Only folders of that range are listed, however large the lake is, and only
    partition columns are used, so no data column is read.
    """
    base = path.rstrip("/")
    found = read_or_empty(spark, f"{base}/{_folders(first, last)}", RAW, basePath=base)
    stamp = partition_stamp()
    in_range = (stamp >= f"{first:{STAMP_FORMAT}}") & (stamp <= f"{last:{STAMP_FORMAT}}")
    return found.select(*PARTITIONS).where(in_range).distinct()


def _record(path: str) -> str:
    # Readers of the lake pass over names that start with an underscore.
    return f"{path.rstrip('/')}/_ingested"


def record_hours(hours: DataFrame, path: str) -> None:
    """Remember that the ``hour`` s are in the lake, whatever types they had."""
    hours.select("hour").distinct().coalesce(1).write.mode("append").parquet(_record(path))


def ingested_hours(spark: SparkSession, path: str, first: datetime, last: datetime) -> DataFrame:
    """hour: those from ``first`` to ``last`` that were recorded after their commit."""
    found = read_or_empty(spark, _record(path), INGESTED)
    return found.where(F.col("hour").between(moment(first), moment(last))).distinct()


def _commit(path: str, commit: str) -> str:
    return f"{path.rstrip('/')}/_commits/commit={commit}"


def _staged(path: str, commit: str) -> str:
    return f"{path.rstrip('/')}/_staged/{commit}"


def committed(spark: SparkSession, path: str, commit: str) -> bool:
    files, place = file_system(spark, _commit(path, commit))
    return files.exists(place)


def record_files(listed: DataFrame, path: str, commit: str) -> None:
    """Commit: enter the archive files (hour, file, size) in the lake's ledger, at once."""
    spark, new = listed.sparkSession, f"{_staged(path, commit)}-files"
    listed.select("hour", "file", "size").coalesce(1).write.mode("overwrite").parquet(new)
    files, source = file_system(spark, new)
    _, target = file_system(spark, _commit(path, commit))
    files.mkdirs(target.getParent())
    if not files.rename(source, target):
        raise OSError(f"could not commit {commit}")


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """hour, file, size, commit: archive files that are in the lake, by the commit that read them."""
    return read_or_empty(spark, f"{path.rstrip('/')}/_commits", LEDGER)


def append_once(raw: DataFrame, path: str, commit: str, listed: DataFrame, compact: bool = False) -> None:
    """Add rows to the lake's partitions; a repeated call with the same ``commit`` adds none.

    Rows are written aside, the commit is recorded with the files it read, then the rows'
    files move into their partitions. A call that died before the record starts anew, one
    that died after it only finishes moving. Readers may see some partitions of a commit
    before others, never a part of a file. ``compact`` is as for ``write_lake``.
    """
    spark = raw.sparkSession
    if not committed(spark, path, commit):
        if compact:
            raw = raw.hint("rebalance", *PARTITIONS)
        (
            raw.to(RAW)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "snappy")
            .partitionBy(*PARTITIONS)
            .parquet(_staged(path, commit))
        )
        record_files(listed, path, commit)
    move_files(spark, _staged(path, commit), path)


def skip_existing(raw: DataFrame, written: DataFrame) -> DataFrame:
    """Rows whose (event_type, hour) partition is not in ``written`` yet.

    The broadcast is bounded by the calendar: at most one row per kept type and
    hour, about 20,000 a year. It keeps the events themselves from being shuffled.
    """
    return raw.join(F.broadcast(written), list(PARTITIONS), "left_anti").select(*raw.columns)
