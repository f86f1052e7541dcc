import os
import re
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from repopulse.operators import activity as act
from repopulse.operators.catalog import name_history
from repopulse.operators.staging import stg_pull_request_events, stg_watch_events
from repopulse.plans.trends import build_mart, check_all, trends
from repopulse.sources.lake import write_lake
from repopulse.sources.mart import read_mart, write_mart


def opened():
    return {"pr_action": "opened", "pr_merged": 0}


def closed(merged):
    return {"pr_action": "closed", "pr_merged": merged}


def both(raw):
    stars = act.daily_stars(stg_watch_events(raw))
    return act.join_daily(stars, act.daily_prs(stg_pull_request_events(raw)))


def by_key(df):
    return {(row.repo_id, str(row.event_date)): row for row in df.collect()}


def test_staging_filters_and_types(raw):
    rows = raw(
        ("star", 1, "a/b", "2024-01-01T10:11:12Z"),
        ("star", None, "a/b", "2024-01-01T10:11:12Z"),
        ("star", 1, None, "2024-01-01T10:11:12Z"),
        ("pr", 1, "a/b", "2024-01-02T10:11:12Z", opened()),
        ("PushEvent", 1, "a/b", "2024-01-02T10:11:12Z"),
    )
    stars = stg_watch_events(rows)
    assert stars.columns == [
        "event_id", "actor_id", "actor_login", "repo_id", "repo_name", "created_at", "event_date",
    ]
    assert dict(stars.dtypes)["created_at"] == "timestamp_ntz"
    assert stars.count() == 2  # a NULL id passes staging, a NULL name does not
    assert [str(row.event_date) for row in stg_pull_request_events(rows).collect()] == ["2024-01-02"]


def test_bad_time_raises(raw):
    with pytest.raises(PySparkException):
        stg_watch_events(raw(("star", 1, "a/b", "2024-01-01 10:11"))).collect()


def test_names_of_a_renamed_repository(raw):
    rows = raw(
        ("star", 1, "a/old", "2024-01-01T00:00:00Z"),
        ("star", 1, "a/new", "2024-01-01T13:00:00Z"),
        ("pr", 1, "a/zzz", "2024-01-01T13:00:00Z", opened()),
        ("pr", 2, "b/old", "2024-01-01T00:00:00Z", opened()),
        ("pr", 2, "b/xyz", "2024-01-01T00:00:00Z", opened()),
    )
    found = by_key(act.repo_daily_activity(rows))
    assert found[1, "2024-01-01"].repo_name == "a/old"  # largest star name, not a/zzz
    assert found[1, "2024-01-01"].stars == 2
    assert found[2, "2024-01-01"].repo_name == "b/xyz"
    assert sorted(both(rows).collect()) == sorted(act.repo_daily_activity(rows).collect())


def test_outcome_counts(raw):
    at = "2024-01-01T00:00:00Z"
    rows = raw(
        ("pr", 1, "a/b", at, opened()),
        ("pr", 1, "a/b", at, closed(1)),
        ("pr", 1, "a/b", at, closed(0)),
        ("pr", 1, "a/b", at, closed(None)),  # unknown outcome: neither
        ("pr", 1, "a/b", at, {"pr_action": "labeled", "pr_merged": 1}),  # merged counts again
        ("star", 1, "a/b", at, {"pr_action": "opened", "pr_merged": 1}),  # a star never counts
        ("pr", 2, "c/d", at, opened()),
        ("star", 3, "e/f", at),
        ("pr", None, "x/y", at, opened()),
    )
    found = by_key(trends(rows))
    one = found[1, "2024-01-01"]
    assert (one.stars, one.prs_opened, one.prs_merged, one.prs_closed_unmerged) == (1, 1, 2, 1)
    assert one.pr_merge_rate == 2 / 3
    assert found[2, "2024-01-01"].pr_merge_rate is None  # opened only
    assert found[3, "2024-01-01"].pr_merge_rate is None  # no pull request
    assert len(found) == 3
    assert sorted(both(rows).collect()) == sorted(act.repo_daily_activity(rows).collect())


def test_rolling_sum_counts_active_days_not_dates(raw):
    days = [1, 2, 3, 10, 11, 12, 20, 21, 22]
    events = [("star", 1, "a/b", f"2024-01-{day:02}T00:00:00Z") for day in days]
    events.append(("pr", 1, "a/b", "2024-01-23T00:00:00Z", opened()))  # uses up a slot
    rows = trends(raw(*events)).orderBy("event_date").collect()
    assert [row.stars_7d_rolling for row in rows] == [1, 2, 3, 4, 5, 6, 7, 7, 7, 6]


def test_hot_repository_gives_the_same_rows(spark, raw):
    """A third of all events on one repository and day, under several names."""
    events = [("star", 1, f"a/b{n % 3}", "2024-01-01T00:00:00Z") for n in range(300)]
    events += [("star", n, f"o/r{n}", "2024-01-02T00:00:00Z") for n in range(2, 602)]
    found = by_key(act.repo_daily_activity(raw(*events).repartition(16)))
    assert found[1, "2024-01-01"].stars == 300 and len(found) == 601


def test_lake_to_mart_to_checks(spark, raw, folder):
    lake, mart = folder("lake"), folder("mart")
    write_lake(raw(
        ("star", 1, "a/b", "2024-01-01T00:00:00Z"),
        ("pr", 1, "a/b", "2024-01-02T00:00:00Z", closed(1)),
        ("star", None, "a/b", "2024-01-02T00:00:00Z"),
    ), lake)
    build_mart(spark, lake, mart)
    build_mart(spark, lake, mart)  # a full refresh replaces
    assert read_mart(spark, mart).count() == 2
    report = {(row.check, row.column): row for row in check_all(spark, lake, mart, date(2024, 1, 1)).collect()}
    # repo_id is declared not null for the lake and for the mart; only the lake fails.
    assert not report["no_future_dates", "event_date"].passed
    assert report["unique_combination", "repo_id,event_date"].passed
    assert report["accepted_values", "event_type"].passed


def test_mart_dates_share_tasks_not_files(spark, raw, folder):
    path = folder("mart")
    events = [("star", n, "a/b", f"2024-01-{1 + n % 20:02}T00:00:00Z") for n in range(200)]
    write_mart(trends(raw(*events).repartition(8)), path)
    assert len(read_mart(spark, path).inputFiles()) == 20


def test_a_full_refresh_leaves_no_old_date(spark, raw, folder):
    path = folder("mart")
    write_mart(trends(raw(("star", 1, "a/b", "2024-01-01T00:00:00Z"))), path)
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        # The new mart is made from the old one, which is readable until it is replaced.
        later = read_mart(spark, path).withColumn("event_date", F.date_add("event_date", 1))
        write_mart(later, path)
        assert [row.event_date for row in read_mart(spark, path).collect()] == [date(2024, 1, 2)]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    # Neither the old mart nor the place where the new one was written is left.
    folder_of, name = os.path.split(path)
    assert [entry for entry in os.listdir(folder_of) if entry.startswith(name)] == [name]


def test_name_history(spark):
    """A rename, a name that comes back, and a gap: intervals without overlap."""
    rows = [(1, "a/x", 1), (1, "a/x", 3), (1, "a/y", 4), (1, "a/x", 9), (2, "b/z", 5)]
    days = spark.createDataFrame([(repo, name, date(2024, 1, day)) for repo, name, day in rows], "repo_id long, repo_name string, event_date date")
    found = [(row.repo_id, row.repo_name, row.valid_from.day, row.valid_to and row.valid_to.day, row.last_seen.day, row.active_days)
             for row in name_history(days).orderBy("repo_id", "valid_from").collect()]
    assert found == [(1, "a/x", 1, 3, 3, 2), (1, "a/y", 4, 8, 4, 1), (1, "a/x", 9, None, 9, 1), (2, "b/z", 5, None, 5, 1)]


def test_name_history_sorts_once_and_groups_nothing(spark):
    """However many names there are, a task holds no more than one sort of its days."""
    days = spark.createDataFrame([(1, "a/x", date(2024, 1, 1))], "repo_id long, repo_name string, event_date date")
    text = name_history(days)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\bSort \[", text)) == 1 and "Aggregate" not in text


def test_name_history_of_days_without_a_name_and_repeated_days(spark):
    rows = [(1, "a", 1), (1, None, 2), (1, None, 3), (1, "a", 4), (1, "a", 4), (None, "b", 7), (None, "b", 8)]
    days = spark.createDataFrame([(repo, name, date(2024, 1, day)) for repo, name, day in rows], "repo_id long, repo_name string, event_date date")
    found = [(row.repo_id, row.repo_name, row.valid_from.day, row.valid_to and row.valid_to.day, row.last_seen.day, row.active_days)
             for row in name_history(days).orderBy("repo_id", "valid_from").collect()]
    assert found == [(None, "b", 7, None, 8, 2), (1, "a", 1, 1, 1, 1), (1, None, 2, 2, 2, 1), (1, None, 3, 3, 3, 1), (1, "a", 4, None, 4, 2)]


def test_name_history_of_days_without_a_date(spark):
    """They come first: alone, before another name, and before the same one."""
    rows = [(1, "a", None), (2, "a", None), (2, "b", 3), (2, "b", 4), (3, "a", None), (3, "a", 5), (3, "a", 6), (3, "b", 9)]
    days = spark.createDataFrame([(repo, name, day and date(2024, 1, day)) for repo, name, day in rows], "repo_id long, repo_name string, event_date date")
    found = [(row.repo_id, row.repo_name, *(day and day.day for day in (row.valid_from, row.valid_to, row.last_seen)), row.active_days)
             for row in name_history(days).orderBy("repo_id", "valid_from").collect()]
    assert found == [(1, "a", None, None, None, 1), (2, "a", None, 2, None, 1), (2, "b", 3, None, 4, 2), (3, "a", 5, 8, 6, 3), (3, "b", 9, None, 9, 1)]
