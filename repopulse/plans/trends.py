"""Raw lake to daily mart."""

from datetime import date, datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.activity import repo_daily_activity, repo_trends_daily
from ..operators.quality import dq_freshness, dq_missing_hours, dq_reconcile, mart_checks, raw_checks
from ..schemas import PARTITIONS
from ..sources.lake import STAMP_FORMAT, partition_stamp, read_lake
from ..sources.mart import read_mart, write_mart


def trends(raw: DataFrame) -> DataFrame:
    """The mart's rows, lazily."""
    return repo_trends_daily(repo_daily_activity(raw))


def build_mart(spark: SparkSession, lake: str, mart: str, as_of: date | None = None, audit: bool = True) -> None:
    """Rebuild the mart from the whole lake; publish it only if it passes its checks."""
    checks = partial(mart_checks, as_of=as_of) if audit else None
    write_mart(trends(read_lake(spark, lake)), mart, checks)


def lake_checks(spark: SparkSession, lake: str, mart: str, now: datetime | None = None) -> DataFrame:
    """Freshness for each type, hours missing between the lake's first and last, and
    totals of the mart against the lake, in the form of the other checks."""

    def rows(found: DataFrame, check: str, column: str, failed) -> DataFrame:
        counted = found.groupBy(column).agg(F.count_if(failed).alias("failing_rows"))
        passed = F.col("failing_rows") == 0
        return counted.select(F.lit(check).alias("check"), F.col(column).alias("column"), "failing_rows", passed.alias("passed"))

    raw = read_lake(spark, lake)
    now = now or datetime.now(timezone.utc).replace(tzinfo=None)
    fresh = rows(dq_freshness(raw, now), "freshness", "event_type", F.col("status") == "error")
    totals = rows(dq_reconcile(raw, read_mart(spark, mart)), "reconcile", "metric", ~F.col("passed"))
    # Only partition columns, so no data is read.
    hours = raw.select(*PARTITIONS).distinct()
    span = hours.agg(F.min(partition_stamp()), F.max(partition_stamp())).first()
    if span[0] is None:
        return fresh.unionByName(totals)
    first, last = (datetime.strptime(stamp, STAMP_FORMAT) for stamp in span)
    missing = rows(dq_missing_hours(hours, first, last), "missing_hours", "event_type", F.lit(True))
    return fresh.unionByName(totals).unionByName(missing)


def check_all(
    spark: SparkSession, lake: str, mart: str, as_of: date | None = None, now: datetime | None = None
) -> DataFrame:
    """Every declared check of both tables, one row each."""
    declared = raw_checks(read_lake(spark, lake)).unionByName(mart_checks(read_mart(spark, mart), as_of))
    return declared.unionByName(lake_checks(spark, lake, mart, now))
