"""Dashboard queries over the materialised mart. The date filter prunes its partitions."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import top

# The windows a reader can choose from, in days.
WINDOWS = (7, 14, 30, 60)


def since(mart: DataFrame, as_of: date | None, days: int) -> DataFrame:
    """Rows dated ``as_of`` minus ``days`` or later; no upper bound."""
    end: Column = F.current_date() if as_of is None else F.lit(as_of)
    return mart.where(F.col("event_date") >= F.date_sub(end, days))


def trending_window(mart: DataFrame, as_of: date | None = None, days: int = 30, k: int = 50) -> DataFrame:
    """repo_name, stars: the most starred names of the window."""
    if days not in WINDOWS:
        raise ValueError(f"days must be one of {WINDOWS}")
    stars = since(mart, as_of, days).groupBy("repo_name").agg(F.sum("stars").alias("stars"))
    return top(stars, k, F.desc("stars"), "repo_name")


def leaders(
    mart: DataFrame, as_of: date | None = None, days: int = 30, count: int = 10
) -> DataFrame:
    """The first ``count`` names of the window with their rank: rank, repo_name."""
    # The window has no partitions, but only the top rows reach it.
    order = Window.orderBy(F.desc("stars"), "repo_name")
    names = trending_window(mart, as_of, days, count)
    return names.select(F.row_number().over(order).alias("rank"), "repo_name")


def trend_series(
    mart: DataFrame, as_of: date | None = None, days: int = 30, count: int = 10
) -> DataFrame:
    """event_date, repo_name, stars of the window's leading names, by date."""
    names = leaders(mart, as_of, days, count).select("repo_name")
    # Bounded broadcast: ``count`` rows.
    series = since(mart, as_of, days).join(F.broadcast(names), "repo_name", "left_semi")
    return series.select("event_date", "repo_name", "stars").orderBy("event_date", "repo_name")


def trend_pivot(series: DataFrame, names: list, column: str = "repo_name") -> DataFrame:
    """One row per date and one column per value in ``names``; 0 where a name has no row.

    The values are given, which saves the job that would look for them.
    """
    wide = series.groupBy("event_date").pivot(column, names).agg(F.sum("stars"))
    return wide.na.fill(0).orderBy("event_date")


def ranked_pivot(
    mart: DataFrame, as_of: date | None = None, days: int = 30, count: int = 10
) -> DataFrame:
    """``trend_pivot`` with columns rank_1 .. rank_n, whoever holds the rank."""
    ranks = [f"rank_{rank}" for rank in range(1, count + 1)]
    places = leaders(mart, as_of, days, count).select(
        F.concat(F.lit("rank_"), F.col("rank").cast("string")).alias("place"), "repo_name"
    )
    series = since(mart, as_of, days).join(F.broadcast(places), "repo_name")
    return trend_pivot(series, ranks, "place")
