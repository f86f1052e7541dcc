"""Data checks. Each yields rows (check, column, failing_rows, passed)."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import KEPT_TYPES, created_at, is_star, moment, pull_request_counts
from .activity import PR_COUNTS

# What must hold for the raw lake and for the mart.
RAW_NOT_NULL = ("id", "event_type", "repo_id", "created_at")
MART_NOT_NULL = ("repo_id", "event_date")
MART_KEY = ("repo_id", "event_date")
MART_RANGES = {"stars": (0, None), "pr_merge_rate": (0, 1)}
WARN_HOURS, ERROR_HOURS = 3, 6
RECONCILE_TOLERANCE = 0.001


# (check, column, aggregate that counts failing rows)
Rule = tuple[str, str, Column]


def run_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One aggregation over ``df`` for all rules, then one row per rule."""
    counts = df.agg(*[failing.alias(f"rule_{place}") for place, (_, _, failing) in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"rule_{place}").alias("failing_rows"),
            (F.col(f"rule_{place}") == 0).alias("passed"),
        )
        for place, (check, column, _) in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def not_null_rules(columns: tuple[str, ...]) -> list[Rule]:
    return [("not_null", name, F.count_if(F.col(name).isNull())) for name in columns]


def accepted_values_rules(column: str, values: tuple[str, ...]) -> list[Rule]:
    """Rows with another value. NULL is not another value."""
    return [("accepted_values", column, F.count_if(~F.col(column).isin(*values)))]


def accepted_range_rules(ranges: dict[str, tuple]) -> list[Rule]:
    """Rows outside [low, high]; either end may be open (None). NULL is inside."""
    rules = []
    for name, (low, high) in ranges.items():
        below = F.lit(False) if low is None else F.col(name) < low
        above = F.lit(False) if high is None else F.col(name) > high
        rules.append(("accepted_range", name, F.count_if(below | above)))
    return rules


def dq_not_null(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return run_rules(df, not_null_rules(columns))


def dq_accepted_values(df: DataFrame, column: str, values: tuple[str, ...]) -> DataFrame:
    return run_rules(df, accepted_values_rules(column, values))


def dq_accepted_range(df: DataFrame, ranges: dict[str, tuple]) -> DataFrame:
    return run_rules(df, accepted_range_rules(ranges))


def dq_unique_combination(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Combinations that occur more than once."""
    repeated = df.groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    return run_rules(repeated, [("unique_combination", ",".join(columns), F.count("*"))])


def dq_no_future_dates(mart: DataFrame, as_of: date | None = None) -> DataFrame:
    """event_date, bad_rows of dates after ``as_of``; no rows means passed."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    future = mart.where(F.col("event_date") > today).groupBy("event_date")
    return future.agg(F.count("*").alias("bad_rows"))


def dq_reconcile(raw: DataFrame, mart: DataFrame, tolerance: float = RECONCILE_TOLERANCE) -> DataFrame:
    """metric, raw_total, mart_total, relative_difference, passed.

    Totals of the mart against counts taken directly from the raw events that
    qualify for it.
    """
    metrics = ["stars", *PR_COUNTS]
    qualifying = raw.where(F.col("repo_id").isNotNull() & F.col("repo_name").isNotNull())
    direct = qualifying.agg(F.count_if(is_star()).alias("stars"), *pull_request_counts())
    modelled = mart.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in metrics])
    sides = direct.unpivot([], metrics, "metric", "raw_total").join(
        modelled.unpivot([], metrics, "metric", "mart_total"), "metric"
    )
    gap = F.abs(F.col("raw_total") - F.col("mart_total")) / F.greatest("raw_total", F.lit(1))
    return sides.withColumn("relative_difference", gap).withColumn(
        "passed", F.col("relative_difference") <= tolerance
    )


def dq_freshness(
    raw: DataFrame, as_of: datetime, warn_hours: int = WARN_HOURS, error_hours: int = ERROR_HOURS
) -> DataFrame:
    """event_type, newest, age_hours, status (pass, warn, error) per kept type.

    A type without rows has no age, which is an error.
    """
    types = raw.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, KEPT_TYPES))).alias("event_type"))
    newest = raw.groupBy("event_type").agg(F.max(created_at()).alias("newest"))
    newest = types.join(newest, "event_type", "left")
    age = F.timestamp_diff("SECOND", "newest", moment(as_of)) / 3600.0
    too_old = F.col("age_hours").isNull() | (F.col("age_hours") > error_hours)
    status = F.when(too_old, "error").when(
        F.col("age_hours") > warn_hours, "warn"
    )
    return newest.withColumn("age_hours", age).withColumn("status", status.otherwise("pass"))


def dq_missing_hours(
    hours: DataFrame, first: datetime, last: datetime, types: tuple[str, ...] = KEPT_TYPES
) -> DataFrame:
    """event_type, hour of the range for which ``hours`` has no partition.

    ``hours`` has the lake's partition columns; repeated rows are fine. Both sides
    are bounded by the calendar.
    """
    present = hours.select(
        "event_type", F.concat_ws("-", "year", "month", "day", "hour").alias("stamp")
    ).distinct()
    span = F.sequence(moment(first), moment(last), F.expr("interval 1 hour"))
    expected = hours.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in types])).alias("event_type"), span.alias("span")
    )
    expected = expected.select("event_type", F.explode("span").alias("hour"))
    clock = F.lpad(F.hour("hour").cast("string"), 2, "0")
    stamped = expected.withColumn("stamp", F.concat_ws("-", F.col("hour").cast("date").cast("string"), clock))
    return stamped.join(present, ["event_type", "stamp"], "left_anti").select("event_type", "hour")


def raw_checks(raw: DataFrame) -> DataFrame:
    """All declared checks of the raw lake, in one pass."""
    return run_rules(raw, not_null_rules(RAW_NOT_NULL) + accepted_values_rules("event_type", KEPT_TYPES))


def mart_checks(mart: DataFrame, as_of: date | None = None) -> DataFrame:
    """All declared checks of the mart: one pass for rows, one for the key."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    future = [("no_future_dates", "event_date", F.count_if(F.col("event_date") > today))]
    rows = run_rules(mart, not_null_rules(MART_NOT_NULL) + accepted_range_rules(MART_RANGES) + future)
    return rows.unionByName(dq_unique_combination(mart, MART_KEY))
