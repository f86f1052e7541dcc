"""Daily activity per repository and the trend mart on top of it.

A repository may be renamed, so one (repo_id, event_date) can carry several names;
the largest wins, and names from stars win over names from pull requests.

Names are strings, and Spark can hash-aggregate strings only as keys, not as
``max`` results. So raw events are first counted per (repo, date, name) - a hash
aggregate that collapses a hot repository map-side - and the largest name is then
picked among the few names of a day, where the sort it needs is cheap.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import KEPT_TYPES, is_star, merge_rate, pull_request_counts
from .staging import event_date

GRAIN = ("repo_id", "event_date")
PR_COUNTS = ("prs_opened", "prs_merged", "prs_closed_unmerged")


def daily_stars(watch: DataFrame) -> DataFrame:
    """repo_id, event_date, repo_name, stars."""
    named = watch.where(F.col("repo_id").isNotNull()).groupBy(*GRAIN, "repo_name")
    return (
        named.agg(F.count("*").alias("stars"))
        .groupBy(*GRAIN)
        .agg(F.max("repo_name").alias("repo_name"), F.sum("stars").alias("stars"))
    )


def daily_prs(pull_requests: DataFrame) -> DataFrame:
    """repo_id, event_date, repo_name and the three outcome counts."""
    typed = pull_requests.withColumn("event_type", F.lit(KEPT_TYPES[1]))
    named = typed.where(F.col("repo_id").isNotNull()).groupBy(*GRAIN, "repo_name")
    return (
        named.agg(*pull_request_counts())
        .groupBy(*GRAIN)
        .agg(F.max("repo_name").alias("repo_name"), *[F.sum(name).alias(name) for name in PR_COUNTS])
    )


def join_daily(stars: DataFrame, prs: DataFrame) -> DataFrame:
    """Full outer join of the two daily frames, for callers that have only those.

    Both sides hold one row per repository and day, so no key is hot.
    """
    s, p = stars.alias("s"), prs.alias("p")
    on = [F.col(f"s.{key}") == F.col(f"p.{key}") for key in GRAIN]
    zero = F.lit(0).cast("bigint")
    return s.join(p, on, "full").select(
        F.coalesce("s.repo_id", "p.repo_id").alias("repo_id"),
        F.coalesce("s.repo_name", "p.repo_name").alias("repo_name"),
        F.coalesce("s.event_date", "p.event_date").alias("event_date"),
        F.coalesce(F.col("s.stars"), zero).alias("stars"),
        *[F.coalesce(F.col(f"p.{name}"), zero).alias(name) for name in PR_COUNTS],
    )


def named_counts(raw: DataFrame, *within: str) -> DataFrame:
    """Counts by repository, date and name, and by the columns ``within``."""
    kept = raw.where(
        F.col("event_type").isin(*KEPT_TYPES)
        & F.col("repo_id").isNotNull()
        & F.col("repo_name").isNotNull()
    )
    return (
        kept.withColumn("event_date", event_date())
        .groupBy(*within, *GRAIN, "repo_name")
        .agg(F.count_if(is_star()).alias("stars"), *pull_request_counts())
    )


def daily_of(named: DataFrame) -> DataFrame:
    """Activity from rows of ``named_counts``, of which a name and day may have several."""
    star_name = F.max(F.when(F.col("stars") > 0, F.col("repo_name")))
    return (
        named.repartition("repo_id")
        .groupBy(*GRAIN)
        .agg(
            F.coalesce(star_name, F.max("repo_name")).alias("repo_name"),
            *[F.sum(name).alias(name) for name in ("stars", *PR_COUNTS)],
        )
        .select("repo_id", "repo_name", "event_date", "stars", *PR_COUNTS)
    )


def repo_daily_activity(raw: DataFrame) -> DataFrame:
    """The rows of ``join_daily`` over both staged types, in one pass and without a join.

    The only full-size exchange carries partial counts. The second one carries
    repo-days and is by ``repo_id`` alone, so that it also serves the mart's window.
    """
    return daily_of(named_counts(raw))


def repo_trends_daily(activity: DataFrame, rows: int = 7, calendar: bool = False) -> DataFrame:
    """Activity plus merge rate and the star sum over the last ``rows`` active days.

    Days, not dates: the frame counts rows, and a day without any event has none.
    ``calendar`` adds ``stars_7d_calendar``, the sum over as many dates up to the row's;
    its frame has the same keys and order, so it costs neither an exchange nor a sort.
    A partition of the window is one repository's days, which history bounds.
    """
    recent = Window.partitionBy("repo_id").orderBy("event_date").rowsBetween(1 - rows, 0)
    columns = {"pr_merge_rate": merge_rate(), "stars_7d_rolling": F.sum("stars").over(recent)}
    if calendar:
        columns["stars_7d_calendar"] = F.expr(
            f"sum(stars) over (partition by repo_id order by event_date"
            f" range between interval {rows - 1} days preceding and current row)"
        )
    return activity.withColumns(columns)
