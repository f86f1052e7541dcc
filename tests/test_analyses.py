from datetime import date

import pytest

from repopulse.operators import analyses, catalog, trends
from repopulse.plans.trends import trends as mart_of

DAY = "2024-01-{:02}T{:02}:00:00Z"


def stars(name, day, count=1, hour=0, **extra):
    return [("star", 1, name, DAY.format(day, hour), extra)] * count


def values(df):
    return [tuple(row) for row in df.collect()]


def test_top_breaks_ties_by_name(raw):
    rows = raw(*stars("b/b", 1, 2), *stars("a/a", 2, 2), *stars("c/c", 1, 3), *stars(None, 1, 9))
    assert values(analyses.top_starred_repos(rows, "2024", k=2)) == [("c/c", 3), ("a/a", 2)]
    assert values(analyses.top_starred_repos(rows, "2023")) == []


def test_velocity_averages_active_days(raw):
    rows = raw(*stars("a/a", 1, 8), *stars("a/a", 5, 4), *stars("b/b", 1, 9))
    assert values(analyses.star_velocity(rows, "2024")) == [("a/a", 12, 6.0, 8, 2)]
    assert len(values(analyses.star_velocity(rows, "2024", min_total=1))) == 2


def test_days_of_different_months_stay_apart(raw):
    events = stars("a/a", 5, 10) + [("star", 1, "a/a", "2024-02-05T00:00:00Z")] * 4
    assert values(analyses.star_velocity(raw(*events), "2024")) == [("a/a", 14, 7.0, 10, 2)]


def test_merge_rate_needs_enough_closed(raw):
    def pulls(name, merged, unmerged, unknown=0):
        outcomes = [1] * merged + [0] * unmerged + [None] * unknown
        return [("pr", 1, name, DAY.format(1, 0), {"pr_action": "closed", "pr_merged": m}) for m in outcomes]

    rows = raw(*pulls("a/a", 3, 2), *pulls("b/b", 4, 0, 3), *pulls("c/c", 0, 5))
    assert values(analyses.pr_merge_rate(rows, "2024")) == [("a/a", 0, 3, 2, 0.6), ("c/c", 0, 0, 5, 0.0)]


def test_organizations_count_distinct(raw):
    rows = raw(
        *stars("a/x", 1, 2, actor_login="u"), *stars("a/y", 1, actor_login="v"),
        ("pr", 1, "a/y", DAY.format(1, 0), {"actor_login": "w"}), *stars("ownerless", 1, actor_login=None),
    )
    assert values(analyses.top_organizations(rows, "2024")) == [("a", 4, 2, 2), ("ownerless", 1, 1, 0)]


def test_users_keep_events_without_a_name(raw):
    rows = raw(
        *stars("a/x", 1, 3), *stars(None, 1, 2), *stars("a/x", 1, 9, actor_login=None),
        ("pr", 1, "a/y", DAY.format(1, 0), {"pr_action": "opened"}),
    )
    assert values(analyses.active_users(rows, "2024")) == [("user1", 5, 1, 2, 6)]


def test_hours_without_stars_have_no_row(raw):
    rows = raw(*stars("a/x", 1, 2, hour=23), *stars(None, 2, 1, hour=4))
    assert values(analyses.hourly_stars(rows, "2024")) == [("04", 1), ("23", 2)]


def test_emerging_thresholds(raw):
    rows = raw(
        *stars("a/a", 1, 1), *stars("a/a", 2, 50), *stars("b/b", 2, 60),  # one day only
        *stars("c/c", 1, 10), *stars("c/c", 2, 60),  # never quiet
    )
    assert values(analyses.emerging_repos(rows, "2024")) == [("a/a", 1, 50, 25.5, 51, 2)]


def test_window_includes_its_first_day(raw):
    mart = mart_of(raw(*stars("a/a", 1, 1), *stars("b/b", 8, 1), *stars("c/c", 2, 1)))
    names = [row.repo_name for row in trends.trending_window(mart, date(2024, 1, 9), 7).collect()]
    assert names == ["b/b", "c/c"]
    with pytest.raises(ValueError):
        trends.trending_window(mart, date(2024, 1, 9), 8)


def test_series_and_pivots(raw):
    events = [("star", n, f"o/r{n:02}", DAY.format(day, 0)) for n in range(12) for day in range(1, 14 - n)]
    mart = mart_of(raw(*events))
    as_of = date(2024, 1, 13)
    series = trends.trend_series(mart, as_of).collect()
    assert {row.repo_name for row in series} == {f"o/r{n:02}" for n in range(10)}
    wide = trends.ranked_pivot(mart, as_of).collect()
    assert len(wide) == 13 and wide[12].rank_1 == 1 and wide[12].rank_10 == 0
    named = trends.trend_pivot(trends.trend_series(mart, as_of), ["o/r00", "o/r05"]).collect()
    assert named[12]["o/r00"] == 1 and named[12]["o/r05"] == 0


def test_repository_dimension(raw):
    rows = raw(
        ("star", 1, "a/old", DAY.format(1, 0)), ("star", 1, "a/new", DAY.format(3, 0)),
        ("pr", 1, "a/mid", DAY.format(2, 0), {"pr_action": "closed", "pr_merged": 1}),
    )
    repo = catalog.dim_repos(mart_of(rows)).first()
    assert (repo.repo_name, repo.active_days, repo.total_stars, repo.pr_merge_rate) == ("a/new", 3, 2, 1.0)
    assert (str(repo.first_active_date), str(repo.last_active_date)) == ("2024-01-01", "2024-01-03")


def test_languages_default_to_unknown(spark, raw):
    from repopulse.schemas import REPO

    mart = mart_of(raw(*[("star", n, f"o/r{n}", DAY.format(1, 0)) for n in range(4)]))
    repos = spark.createDataFrame([(0, "x", "", "go", 1), (1, "y", "", "", 1), (2, "z", "", None, 1)], REPO)
    found = {row.language: row.stars for row in catalog.language_trends(mart, repos).collect()}
    assert found == {"go": 1, "Unknown": 3}


def test_crossing_owners_and_contributors(raw):
    rows = raw(
        *stars("a/a", 1, 3), *stars("a/a", 2, 5), *stars("a/a", 3, 7),
        ("pr", 2, "a/b", DAY.format(2, 0), {"pr_action": "opened"}),
    )
    mart = mart_of(rows)
    assert [str(row.first_date) for row in catalog.first_crossing(mart, 5).collect()] == ["2024-01-02"]
    assert catalog.first_crossing(mart).count() == 0
    org = {str(row.event_date): row for row in catalog.org_activity_daily(mart).collect()}
    assert (org["2024-01-02"].stars, org["2024-01-02"].active_repos) == (5, 2)
    assert values(catalog.top_pr_contributors(rows, "2024")) == [("user1", 1)]
