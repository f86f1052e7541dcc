from datetime import date, datetime

from repopulse.operators import quality as dq
from repopulse.plans.trends import trends
from repopulse.schemas import MART


def mart_rows(spark, *rows):
    full = [(r, "a/b", d, s, 0, 0, 0, rate, s) for r, d, s, rate in rows]
    return spark.createDataFrame(full, MART)


def failing(df):
    return {(row.check, row.column): row.failing_rows for row in df.collect()}


DAY = date(2024, 1, 1)


def test_not_null_and_accepted_values(raw):
    rows = raw(
        ("star", None, "a/b", "2024-01-01T00:00:00Z"), ("ForkEvent", 1, "a/b", "2024-01-01T00:00:00Z"),
        ("star", 1, "a/b", "2024-01-01T00:00:00Z", {"event_type": None, "id": None}),
    )
    assert failing(dq.raw_checks(rows)) == {
        ("not_null", "id"): 1, ("not_null", "event_type"): 1, ("not_null", "repo_id"): 1,
        ("not_null", "created_at"): 0, ("accepted_values", "event_type"): 1,
    }


def test_mart_checks(spark):
    mart = mart_rows(
        spark, (1, DAY, -1, 1.5), (1, DAY, 0, None), (2, DAY, 1, 0.0), (None, DAY, 1, 1.0),
        (3, date(2024, 1, 3), 1, -0.1),
    )
    found = failing(dq.mart_checks(mart, date(2024, 1, 2)))
    assert found == {
        ("not_null", "repo_id"): 1, ("not_null", "event_date"): 0, ("accepted_range", "stars"): 1,
        ("accepted_range", "pr_merge_rate"): 2, ("no_future_dates", "event_date"): 1,
        ("unique_combination", "repo_id,event_date"): 1,
    }
    assert {row.passed for row in dq.mart_checks(mart.where("repo_id = 2"), DAY).collect()} == {True}


def test_future_dates(spark):
    mart = mart_rows(spark, (1, DAY, 1, None), (2, date(2024, 1, 2), 1, None), (3, date(2024, 1, 2), 1, None))
    assert [tuple(row) for row in dq.dq_no_future_dates(mart, DAY).collect()] == [(date(2024, 1, 2), 2)]
    assert dq.dq_no_future_dates(mart).count() == 0  # today is later


def test_empty_tables_pass(spark, raw):
    empty = raw(("star", 1, "a/b", None)).where("false")
    assert {row.passed for row in dq.raw_checks(empty).collect()} == {True}
    assert {row.passed for row in dq.mart_checks(mart_rows(spark, (1, DAY, 1, None)).where("false"), DAY).collect()} == {True}


def test_reconcile(raw):
    rows = raw(*[("star", n % 3, "a/b", "2024-01-01T00:00:00Z") for n in range(30)])
    assert all(row.passed for row in dq.dq_reconcile(rows, trends(rows)).collect())
    partial = trends(rows).where("repo_id > 0")
    found = {row.metric: row for row in dq.dq_reconcile(rows, partial).collect()}
    assert not found["stars"].passed and found["stars"].relative_difference == 10 / 30
    assert found["prs_opened"].passed


def test_freshness(raw):
    rows = raw(
        ("star", 1, "a/b", "2024-01-01T08:00:00Z"), ("star", 1, "a/b", "2024-01-01T04:00:00Z"),
        ("pr", 1, "a/b", "2024-01-01T05:59:59Z"),
    )

    def status(hour):
        found = dq.dq_freshness(rows, datetime(2024, 1, 1, hour)).collect()
        return {row.event_type: row.status for row in found}

    assert status(9) == {"WatchEvent": "pass", "PullRequestEvent": "warn"}
    assert status(12) == {"WatchEvent": "warn", "PullRequestEvent": "error"}
    rows = rows.where("type = 'WatchEvent'")
    assert status(9) == {"WatchEvent": "pass", "PullRequestEvent": "error"}


def test_missing_hours(raw):
    rows = raw(
        ("star", 1, "a/b", "2024-01-01T22:10:00Z"), ("star", 1, "a/b", "2024-01-02T00:10:00Z"),
        ("pr", 1, "a/b", "2024-01-01T23:10:00Z"),
    )
    missing = dq.dq_missing_hours(rows, datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 0))
    assert {(row.event_type, row.hour) for row in missing.collect()} == {
        ("WatchEvent", datetime(2024, 1, 1, 23)),
        ("PullRequestEvent", datetime(2024, 1, 1, 22)),
        ("PullRequestEvent", datetime(2024, 1, 2, 0)),
    }
