"""The seven ad-hoc analyses over the raw lake.

Each filters on partition columns (``event_type``, ``year``), so that only matching
files are opened. Rankings end with the entity key, which settles ties.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.events import (
    is_pull_request,
    is_star,
    merge_rate,
    opened,
    owner,
    pull_request_counts,
    top,
)


def _of_year(raw: DataFrame, year: str) -> DataFrame:
    return raw.where(F.col("year") == year)


def _named_stars(raw: DataFrame, year: str) -> DataFrame:
    return _of_year(raw, year).where(is_star() & F.col("repo_name").isNotNull())


def _stars_by_day(raw: DataFrame, year: str) -> DataFrame:
    """Stars per name and full date, taken from the partition columns."""
    days = _named_stars(raw, year).groupBy("repo_name", "year", "month", "day")
    return days.agg(F.count("*").alias("stars_in_day"))


def top_starred_repos(raw: DataFrame, year: str, k: int = 50) -> DataFrame:
    """repo_name, stars."""
    stars = _named_stars(raw, year).groupBy("repo_name").agg(F.count("*").alias("stars"))
    return top(stars, k, F.desc("stars"), "repo_name")


def star_velocity(raw: DataFrame, year: str, min_total: int = 10, k: int = 50) -> DataFrame:
    """Names by average stars per active day, above a floor of total stars."""
    # One row per name and day goes in, so counting rows counts distinct days.
    velocity = (
        _stars_by_day(raw, year)
        .groupBy("repo_name")
        .agg(
            F.sum("stars_in_day").alias("total_stars"),
            F.avg("stars_in_day").alias("avg_daily_stars"),
            F.max("stars_in_day").alias("peak_daily_stars"),
            F.count("*").alias("active_days"),
        )
        .where(F.col("total_stars") >= min_total)
    )
    return top(velocity, k, F.desc("avg_daily_stars"), "repo_name")


def pr_merge_rate(raw: DataFrame, year: str, min_closed: int = 5, k: int = 50) -> DataFrame:
    """Names by share of closed pull requests that were merged."""
    rates = (
        _of_year(raw, year)
        .where(is_pull_request() & F.col("repo_name").isNotNull())
        .groupBy("repo_name")
        .agg(*pull_request_counts())
        .where(F.col("prs_merged") + F.col("prs_closed_unmerged") >= min_closed)
        .withColumn("merge_rate", merge_rate())
    )
    return top(rates, k, F.desc_nulls_last("merge_rate"), "repo_name")


def top_organizations(raw: DataFrame, year: str, k: int = 50) -> DataFrame:
    """Owners by event volume, with their repositories and starrers counted exactly.

    The distinct counts aggregate on (owner, value) first, so a hot owner is spread
    over its repositories and starrers.
    """
    owners = (
        _of_year(raw, year)
        .where(F.col("repo_name").isNotNull())
        .groupBy(owner().alias("org_name"))
        .agg(
            F.count("*").alias("event_count"),
            F.count_distinct("repo_name").alias("unique_repos"),
            F.count_distinct(F.when(is_star(), F.col("actor_login"))).alias("unique_starrers"),
        )
    )
    return top(owners, k, F.desc("event_count"), "org_name")


def active_users(raw: DataFrame, year: str, min_events: int = 5, k: int = 50) -> DataFrame:
    """Accounts by events; a NULL repository name still counts as an event."""
    users = (
        _of_year(raw, year)
        .where(F.col("actor_login").isNotNull())
        .groupBy("actor_login")
        .agg(
            F.count_if(is_star()).alias("stars_given"),
            F.count_if(is_pull_request() & opened()).alias("prs_opened"),
            F.count_distinct("repo_name").alias("unique_repos_touched"),
            F.count("*").alias("total_events"),
        )
        .where(F.col("total_events") >= min_events)
    )
    return top(users, k, F.desc("total_events"), "actor_login")


def hourly_stars(raw: DataFrame, year: str) -> DataFrame:
    """Stars per UTC hour of day. Hours without a star have no row."""
    stars = _of_year(raw, year).where(is_star()).groupBy(F.col("hour").alias("utc_hour"))
    return stars.agg(F.count("*").alias("stars")).orderBy("utc_hour")


def emerging_repos(
    raw: DataFrame, year: str, peak: int = 50, quiet: int = 10, min_days: int = 2, k: int = 50
) -> DataFrame:
    """Names with a day of at least ``peak`` stars and a day below ``quiet``."""
    summary = (
        _stars_by_day(raw, year)
        .groupBy("repo_name")
        .agg(
            F.min("stars_in_day").alias("min_daily_stars"),
            F.max("stars_in_day").alias("peak_daily_stars"),
            F.avg("stars_in_day").alias("avg_daily_stars"),
            F.sum("stars_in_day").alias("total_stars"),
            F.count("*").alias("active_days"),
        )
        .where(
            (F.col("peak_daily_stars") >= peak)
            & (F.col("min_daily_stars") < quiet)
            & (F.col("active_days") >= min_days)
        )
    )
    return top(summary, k, F.desc(F.col("peak_daily_stars") - F.col("min_daily_stars")), "repo_name")
