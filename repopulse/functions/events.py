"""Column expressions over event and pull-request fields."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The event types the lake keeps and the pull-request actions counted.
STAR = "WatchEvent"
PULL_REQUEST = "PullRequestEvent"
KEPT_TYPES = (STAR, PULL_REQUEST)
OPENED = "opened"
CLOSED = "closed"
CREATED_AT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def is_star() -> Column:
    return F.col("event_type") == STAR


def is_pull_request() -> Column:
    return F.col("event_type") == PULL_REQUEST


def created_at(column: str = "created_at") -> Column:
    """ISO text to a timestamp without zone. Malformed text raises, as ANSI Spark does."""
    return F.to_timestamp_ntz(column, F.lit(CREATED_AT_FORMAT))


def moment(value: datetime) -> Column:
    """A literal timestamp without zone. ``lit`` alone would go through the session's zone."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def owner(name: str = "repo_name") -> Column:
    """Part of the name before the first slash; the whole name if there is none."""
    return F.split_part(F.col(name), F.lit("/"), F.lit(1))


def opened() -> Column:
    return F.col("pr_action") == OPENED


def merged() -> Column:
    """Any event of a merged pull request, whatever its action."""
    return F.col("pr_merged") == 1


def closed_unmerged() -> Column:
    """Closed with a known outcome of not merged; an unknown outcome counts nowhere."""
    return (F.col("pr_action") == CLOSED) & (F.col("pr_merged") == 0)


def pull_request_counts() -> list[Column]:
    """The three outcome counts over rows that are pull-request events.

    The type test is part of each condition, so that they also work over rows of
    both types (``pr_action`` is filled for stars, too).
    """
    return [
        F.count_if(is_pull_request() & opened()).alias("prs_opened"),
        F.count_if(is_pull_request() & merged()).alias("prs_merged"),
        F.count_if(is_pull_request() & closed_unmerged()).alias("prs_closed_unmerged"),
    ]


def merge_rate(merged_count: str = "prs_merged", unmerged_count: str = "prs_closed_unmerged") -> Column:
    """Merged over closed; NULL where nothing was closed."""
    closed = F.col(merged_count) + F.col(unmerged_count)
    return F.col(merged_count).cast("double") / F.nullif(closed, F.lit(0))


def zero_padded(number: Column, width: int = 2) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def top(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    """The first ``k`` rows. ``order`` ends with the key, so that ties are settled."""
    return df.orderBy(*order).limit(k)
