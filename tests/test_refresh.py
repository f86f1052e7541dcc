"""Incremental refreshes of the mart and of daily distinct counts, and the audit."""

from datetime import date
from functools import partial

import pytest
from pyspark.sql import functions as F

from repopulse.operators import analyses, distincts
from repopulse.operators.activity import repo_daily_activity, repo_trends_daily
from repopulse.operators.quality import mart_checks
from repopulse.plans import refresh
from repopulse.plans.distincts import organizations, read_numbers, refresh_distincts, users
from repopulse.plans.trends import build_mart, trends
from repopulse.schemas import NUMBERS
from repopulse.sources import lake as lakes
from repopulse.sources.mart import AuditFailed, read_mart, write_mart
from repopulse.sources.tables import file_system


def events(raw, *rows):
    """Rows of the lake from (kind, repo, name, day, hour)."""
    return raw(*((kind, repo, name, f"2024-01-{day:02}T{hour:02}:00:00Z") for kind, repo, name, day, hour in rows))


def full(spark, lake):
    return sorted(trends(lakes.read_lake(spark, lake)).collect())


START = [("star", repo, f"o/r{repo}", day, 5) for repo in range(6) for day in range(1, 10 + repo)]


def test_late_hours_renames_and_new_days(spark, raw, folder):
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START), lake)
    assert len(refresh.refresh_mart(spark, lake, mart)) == 14
    assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)
    assert refresh.refresh_mart(spark, lake, mart) == []
    steps = [
        # A late hour in the middle shifts the windows of the days after it.
        [("star", 1, "o/r1", 4, 7), ("pr", 1, "o/r1", 4, 7)],
        # A rename on a day that has events, a new repository, a day without any before.
        [("star", 2, "o/zz-renamed", 6, 9), ("star", 77, "o/new", 6, 9), ("star", 2, "o/r2", 25, 1)],
        # An event whose date isn't its archive's.
        [("star", 3, "o/r3", 26, 0)],
    ]
    for step in steps:
        rows = events(raw, *step)
        if step is steps[2]:
            rows = rows.withColumn("created_at", F.lit("2024-01-03T23:59:59Z"))
        days = sorted({row.day for row in rows.collect()})
        lakes.write_lake(rows, lake)
        assert refresh.refresh_mart(spark, lake, mart) == [f"2024-01-{day}" for day in days]
        assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)


def test_replaced_and_removed_hours(spark, raw, folder):
    """Rows may also leave: an hour is replaced by less, a day leaves the lake."""
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START, ("star", 9, "o/only", 5, 11), ("star", 1, "o/r1", 5, 11)), lake)
    refresh.refresh_mart(spark, lake, mart)
    lakes.write_lake(events(raw, ("star", 1, "o/other", 5, 11)), lake)
    refresh.refresh_mart(spark, lake, mart)
    assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)
    files, place = file_system(spark, f"{lake}/event_type=WatchEvent/year=2024/month=01/day=14")
    assert files.delete(place, True)
    assert refresh.refresh_mart(spark, lake, mart) == ["2024-01-14"]
    assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)


@pytest.mark.parametrize("step", ["_replace_changed", "write_seen"])
def test_a_refresh_that_died_is_repeated(spark, raw, folder, monkeypatch, step):
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START, ("star", 9, "o/only", 5, 11)), lake)
    refresh.refresh_mart(spark, lake, mart)
    lakes.write_lake(events(raw, ("star", 2, "o/r2", 5, 11)), lake)  # repository 9 leaves

    def dies(*_args):
        raise OSError("died")

    with monkeypatch.context() as broken:
        broken.setattr(refresh, step, dies)
        with pytest.raises(OSError, match="died"):
            refresh.refresh_mart(spark, lake, mart)
    refresh.refresh_mart(spark, lake, mart)
    assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)
    assert refresh.refresh_mart(spark, lake, mart) == []


def test_only_changed_days_are_read(spark, raw, folder, monkeypatch):
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START), lake)
    refresh.refresh_mart(spark, lake, mart)
    lakes.write_lake(events(raw, ("star", 1, "o/r1", 4, 7)), lake)
    opened, dates = [], []
    counts = refresh.named_counts
    monkeypatch.setattr(refresh, "named_counts", lambda rows, *by: opened.append(rows) or counts(rows, *by))
    replace = refresh.replace_dates
    monkeypatch.setattr(refresh, "replace_dates", lambda rows, path, days: dates.extend(days) or replace(rows, path, days))
    refresh.refresh_mart(spark, lake, mart)
    (rows,) = opened
    assert {row.day for row in rows.select("day").distinct().collect()} == {"04"}
    plan = rows.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PushedFilters: []" in plan
    # The late star counts in the windows of its day and the six active days after it.
    assert sorted(str(day) for day in dates) == [f"2024-01-{day:02}" for day in range(4, 11)]


def test_a_mart_that_was_built_before_there_was_state(spark, raw, folder):
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START), lake)
    write_mart(trends(events(raw, ("star", 500, "not/there", 1, 1))), mart)
    refresh.refresh_mart(spark, lake, mart)
    assert sorted(read_mart(spark, mart).collect()) == full(spark, lake)


def test_broken_rows_are_not_published(spark, raw, folder):
    mart = folder("mart")
    good = trends(events(raw, *START))
    audit = partial(mart_checks, as_of=None)
    write_mart(good, mart, audit)
    before = sorted(read_mart(spark, mart).collect())
    broken = good.union(good.limit(1).withColumn("stars", F.lit(-5).cast("bigint")))
    with pytest.raises(AuditFailed, match="accepted_range of stars: 1") as failed:
        write_mart(broken, mart, audit)
    assert {row["check"] for row in failed.value.rows} == {"accepted_range", "unique_combination"}
    assert sorted(read_mart(spark, mart).collect()) == before
    assert read_mart(spark, failed.value.path).count() == len(before) + 1  # left for inspection
    write_mart(broken, mart)
    assert read_mart(spark, mart).count() == len(before) + 1


def test_build_mart_audits(spark, raw, folder):
    lake, mart = folder("lake"), folder("mart")
    lakes.write_lake(events(raw, *START), lake)
    build_mart(spark, lake, mart)
    with pytest.raises(AuditFailed, match="no_future_dates"):
        build_mart(spark, lake, mart, as_of=date(2024, 1, 2))
    assert read_mart(spark, mart).count() == len(full(spark, lake))


def test_an_interrupted_replacement_is_no_empty_mart(spark, raw, folder, monkeypatch):
    """Dies between setting the old table aside and publishing the new one."""
    mart = folder("mart")
    assert read_mart(spark, mart).count() == 0
    write_mart(trends(events(raw, *START)), mart)
    files, place = file_system(spark, mart)
    _, aside = file_system(spark, f"{mart}-0123-replaced")
    assert files.rename(place, aside)
    with pytest.raises(RuntimeError, match="interrupted"):
        read_mart(spark, mart)


def test_calendar_window(spark, raw):
    rows = events(raw, *[("star", 1, "a/b", day, 3) for day in (1, 2, 3, 4, 10, 11, 20)])
    found = repo_trends_daily(repo_daily_activity(rows), calendar=True)
    assert [(row.event_date.day, row.stars_7d_rolling, row.stars_7d_calendar) for row in found.orderBy("event_date").collect()] == [
        (1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 4, 4), (10, 5, 2), (11, 6, 2), (20, 7, 1),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Partial counts, and repository-days: the calendar adds neither an exchange, a sort nor a window.
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Window [") == 1
    assert plan.count("Sort [repo_id") == 1


def test_numbers_are_dense_and_stay(spark):
    values = spark.range(1000).selectExpr("concat('v', id % 700) as value").repartition(7)
    first = distincts.new_numbers(values, spark.createDataFrame([], NUMBERS))
    assert sorted(row.number for row in first.collect()) == list(range(700))
    more = spark.range(900).selectExpr("concat('v', id) as value").union(spark.sql("select cast(null as string)"))
    second = distincts.new_numbers(more, first)
    assert sorted(row.number for row in second.collect()) == list(range(700, 900))
    assert first.union(second).select("value").distinct().count() == 900


def test_daily_distincts_follow_the_lake(spark, raw, folder):
    lake, path = folder("lake"), folder("distincts")
    first = [("star", n % 5, f"org{n % 3}/r{n % 5}", 1 + n % 4, n % 24) for n in range(60)]
    later = [("star", n % 7, f"org{n % 2}/r{n % 7}", 9, n % 24) for n in range(30)]
    later += [("pr", 1, None, 9, 3), ("pr", 1, "no-owner", 9, 3)]
    lakes.write_lake(events(raw, *first), lake)
    assert refresh_distincts(spark, lake, path) == [f"2024-01-0{n}" for n in range(1, 5)]
    numbers = {row.value: row.number for row in read_numbers(spark, path).collect()}
    lakes.write_lake(events(raw, *later), lake)
    lakes.write_lake(events(raw, ("star", 3, "org9/late", 2, 23)), lake)  # a late hour of an old day
    assert sorted(refresh_distincts(spark, lake, path)) == ["2024-01-02", "2024-01-09"]
    assert refresh_distincts(spark, lake, path) == []
    everything = lakes.read_lake(spark, lake)
    assert organizations(spark, path, "2024").collect() and sorted(organizations(spark, path, "2024").collect()) == sorted(
        analyses.top_organizations(everything, "2024").collect()
    )
    columns = ["actor_login", "stars_given", "prs_opened", "unique_repos_touched", "total_events"]
    assert sorted(users(spark, path, "2024").select(columns).collect()) == sorted(
        analyses.active_users(everything, "2024").select(columns).collect()
    )
    assert organizations(spark, path, "2023").count() == 0
    kept = {row.value: row.number for row in read_numbers(spark, path).collect()}
    assert numbers.items() <= kept.items() and len(set(kept.values())) == len(kept)
