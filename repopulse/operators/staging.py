"""Typed, named views over the raw lake. Lazy: nothing is materialised."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import created_at, is_pull_request, is_star

_IDENTITY = ("actor_id", "actor_login", "repo_id", "repo_name")
_PULL_REQUEST = ("pr_action", "pr_merged", "pr_state", "pr_base_ref", "pr_user_login")


def event_date() -> Column:
    return F.to_date(created_at()).alias("event_date")


def _staged(raw: DataFrame, of_type: Column, columns: tuple[str, ...]) -> DataFrame:
    return raw.where(of_type & F.col("repo_name").isNotNull()).select(
        F.col("id").alias("event_id"), *columns, created_at().alias("created_at"), event_date()
    )


def stg_watch_events(raw: DataFrame) -> DataFrame:
    """One row per star."""
    return _staged(raw, is_star(), _IDENTITY)


def stg_pull_request_events(raw: DataFrame) -> DataFrame:
    """One row per pull-request event."""
    return _staged(raw, is_pull_request(), _IDENTITY + _PULL_REQUEST)
