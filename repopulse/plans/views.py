"""The layers as temporary views, for those who query them in SQL."""

from pyspark.sql import SparkSession

from ..operators.activity import repo_daily_activity
from ..operators.staging import stg_pull_request_events, stg_watch_events
from ..sources.lake import read_lake
from ..sources.mart import read_mart


def register_views(spark: SparkSession, lake: str, mart: str | None = None) -> list[str]:
    """Register raw, the staging and intermediate layers and, if given, the mart.

    All but ``raw`` and the mart are computed when queried; partition filters on them
    reach the lake's files. Returns the names.
    """
    raw = read_lake(spark, lake)
    views = {
        "raw": raw,
        "stg_watch_events": stg_watch_events(raw),
        "stg_pull_request_events": stg_pull_request_events(raw),
        "int_repo_daily_activity": repo_daily_activity(raw),
    }
    if mart:
        views["fct_repo_trends_daily"] = read_mart(spark, mart)
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return list(views)
