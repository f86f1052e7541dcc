"""Further marts: repositories and their names, organizations, languages, contributors; text chunks."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import is_pull_request, merge_rate, owner, top
from ..functions.text import missing_if_empty, windows
from .activity import PR_COUNTS


def dim_repos(activity: DataFrame) -> DataFrame:
    """One row per repository: latest name, active span, totals, overall merge rate."""
    return (
        activity.groupBy("repo_id")
        .agg(
            F.max_by("repo_name", "event_date").alias("repo_name"),
            F.min("event_date").alias("first_active_date"),
            F.max("event_date").alias("last_active_date"),
            F.count("*").alias("active_days"),
            F.sum("stars").alias("total_stars"),
            *[F.sum(name).alias(name) for name in PR_COUNTS],
        )
        .withColumn("pr_merge_rate", merge_rate())
    )


def name_history(activity: DataFrame) -> DataFrame:
    """repo_id, repo_name, valid_from, valid_to, last_seen, active_days: the names a repository had.

    A name holds from the first day it was seen until the day before the next one was, and
    the last one still holds (``valid_to`` is null). A name that comes back after another
    is a row of its own, so the intervals of a repository cover its time without overlap.
    A partition of the windows is one repository's days. All of them have one order, so a
    task sorts its days once and holds no more of them than Spark's sort does.
    """
    repo = Window.partitionBy("repo_id")
    days = repo.orderBy("event_date")
    whole = days.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.lag("repo_name").over(days)
    same = F.coalesce(before == F.col("repo_name"), F.lit(False))
    named = activity.select("repo_id", "event_date", "repo_name").withColumns(
        {
            "day_no": F.row_number().over(days),
            "renamed": ~same,
            "seen_before": F.lag("event_date").over(days),
            "days": F.count("*").over(whole),
            "dated": F.count("event_date").over(whole),
            "first_date": F.min("event_date").over(whole),
            "last_date": F.max("event_date").over(whole),
        }
    )
    # Only the first day of each name is left; what follows it tells where the name ends.
    next_no = F.coalesce(F.lead("day_no").over(days), F.col("days") + 1)
    spans = named.where("renamed").withColumns({"next_no": next_no, "next_seen": F.lead("seen_before").over(days)})
    # Days without a date come first; a name that goes on after them holds from its first date.
    goes_on = F.col("next_no") > F.col("days") - F.col("dated") + 1
    spans = spans.withColumn("valid_from", F.coalesce("event_date", F.when(goes_on, F.col("first_date"))))
    following = F.lead("valid_from").over(days)
    last_seen = F.when(F.col("next_no") > F.col("days"), F.col("last_date")).otherwise(F.col("next_seen"))
    return spans.select(
        "repo_id", "repo_name", "valid_from", F.date_sub(following, 1).alias("valid_to"),
        last_seen.alias("last_seen"), (F.col("next_no") - F.col("day_no")).alias("active_days"),
    )


def org_activity_daily(activity: DataFrame) -> DataFrame:
    """One row per owner and date. Activity has one row per repository and day, so
    counting rows counts repositories."""
    return activity.groupBy(owner().alias("org_name"), "event_date").agg(
        F.sum("stars").alias("stars"),
        *[F.sum(name).alias(name) for name in PR_COUNTS],
        F.count("*").alias("active_repos"),
    )


def language_trends(mart: DataFrame, repos: DataFrame) -> DataFrame:
    """Stars per language and date; repositories of unknown language count as Unknown.

    Neither side is bounded, so no broadcast is asked for: a repository has at most
    one row per day in the mart and one in ``repos``, which a shuffle spreads evenly.
    """
    languages = repos.select("repo_id", missing_if_empty("language").alias("language"))
    language = F.coalesce("language", F.lit("Unknown")).alias("language")
    return (
        mart.select("repo_id", "event_date", "stars")
        .join(languages, "repo_id", "left")
        .groupBy(language, "event_date")
        .agg(F.sum("stars").alias("stars"))
    )


def first_crossing(mart: DataFrame, threshold: int = 100) -> DataFrame:
    """repo_id, first_date: the first day with at least ``threshold`` stars."""
    crossed = mart.where(F.col("stars") >= threshold).groupBy("repo_id")
    return crossed.agg(F.min("event_date").alias("first_date"))


def top_pr_contributors(raw: DataFrame, year: str, k: int = 50) -> DataFrame:
    """actor_login, pr_events: the accounts with the most pull-request events."""
    events = raw.where((F.col("year") == year) & is_pull_request() & F.col("actor_login").isNotNull())
    counts = events.groupBy("actor_login").agg(F.count("*").alias("pr_events"))
    return top(counts, k, F.desc("pr_events"), "actor_login")


def text_chunks(texts: DataFrame, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Adds chunk_no and replaces ``text`` by windows that cover the whole text.

    Ready for ``encode``. Empty and NULL texts yield no chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than size")
    others = [name for name in texts.columns if name != "text"]
    return texts.where(F.length("text") > 0).select(
        *others, F.posexplode(windows("text", size, overlap)).alias("chunk_no", "text")
    )
