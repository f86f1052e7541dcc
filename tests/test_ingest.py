import gzip
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repopulse.functions.events import moment
from repopulse.operators import ingest
from repopulse.plans.ingest import (
    backfill,
    flat_rows,
    ingest_hour,
    months,
    pending_archives,
)
from repopulse.schemas import RAW
from repopulse.sources import archive, lake
from repopulse.streaming.ingest import stream_ingest

HOUR = datetime(2024, 3, 5, 4)


def event(number, kind="WatchEvent", **changes):
    value = {
        "id": str(number), "type": kind, "created_at": "2024-03-05T03:59:59Z",
        "actor": {"id": 7, "login": "ann"}, "repo": {"id": 9, "name": "a/b"},
        "payload": {"action": "started"},
    }
    value.update(changes)
    return json.dumps(value)


def pull(number, merged=True, **changes):
    request = {"merged": merged, "state": "closed", "base": {"ref": "main"}, "user": {"login": "bob"}}
    payload = {"action": "closed", "pull_request": request}
    return event(number, "PullRequestEvent", payload=payload, **changes)


def frame(spark, *texts, hour=HOUR):
    lines = spark.createDataFrame([(text,) for text in texts], "value string")
    return lines.withColumn("archive_hour", moment(hour))


def flat(spark, *texts):
    rows = ingest.flatten_events(ingest.kept_events(frame(spark, *texts))).collect()
    return {row.id: row for row in rows}


def archive_file(folder, hour, *texts):
    folder.mkdir(exist_ok=True)
    with gzip.open(folder / f"{hour:%Y-%m-%d}-{hour.hour}.json.gz", "wt") as out:
        out.write("\n".join(texts) + "\n")


def test_lines_that_are_not_json_vanish(spark):
    lines = frame(spark, event(1), event(2)[:30], "", "[1, 2]", event(3, "PushEvent"))
    assert ingest.parse_events(lines).count() == 3
    report = {row.event_type: row.n for row in ingest.ingest_report(lines).collect()}
    assert report == {"total": 3, "WatchEvent": 1, "PullRequestEvent": 0}


def test_report_of_nothing_is_zero(spark):
    report = ingest.ingest_report(frame(spark, "{"))
    assert {row.n for row in report.collect()} == {0}


def test_text_search_loses_no_candidate(spark):
    escaped = event(2).replace("WatchEvent", "\\u0057atchEvent")
    mention = event(3, "IssueCommentEvent", payload={"action": "a WatchEvent"})
    lines = frame(spark, event(1), escaped, mention, event(4)[:40], pull(5), event(6, "ForkEvent"))
    fast = ingest.flatten_events(ingest.kept_events(lines))
    slow = ingest.flatten_events(ingest.keep_types(ingest.parse_events(lines)))
    assert sorted(row.id for row in fast.collect()) == ["1", "2", "5"]
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_a_line_is_parsed_and_its_path_searched_once(spark, tmp_path):
    archive_file(tmp_path, HOUR, event(1), event(2)[:30], event(3, "PushEvent"), pull(4))
    rows = flat_rows(archive.read_lines(spark, str(tmp_path)))
    assert sorted((row.id, row.hour) for row in rows.collect()) == [("1", "04"), ("4", "04")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # The second parse is that of lines with NaN or Infinity.
    assert plan.count("parseJson(") == 2 and plan.count("regexp_extract(") == 1


def test_hours_of_paths(spark):
    hours = {
        "/a/2024-03-05-4.json.gz": HOUR, "/a/2024-03-05-04.json.gz": HOUR, "/a/2024-03-05-4/part-0.gz": HOUR,
        "/a/archive=2024-03-05-4.json.gz/part-2024-01-01-9.gz": HOUR,
        "/2024-03-04-9/2024-03-05-4.json": HOUR, "/2024-03-05-4/2024-03-05-24.json": None,
        "/a/2024-02-30-4.json": None, "/a/2024-03-05.json": None, "/a/2024-03-05-123.json": None, "/a/x": None,
    }
    paths = spark.createDataFrame([(path,) for path in hours], "path string")
    found = paths.select("path", archive.hour_of_path(F.col("path")).alias("hour"))
    assert {row.path: row.hour for row in found.collect()} == hours


def test_missing_parents_give_null(spark):
    bare = event(1, actor=None, repo=None, payload=None)
    absent = json.dumps({"id": "2", "type": "PullRequestEvent"})
    rows = flat(spark, bare, absent)
    for row in rows.values():
        assert row.actor_id is row.actor_login is row.repo_id is row.repo_name is None
        assert row.pr_action is row.pr_merged is row.pr_state is row.pr_base_ref is None


def test_merged_becomes_a_number(spark):
    rows = flat(spark, pull(1, True), pull(2, False), pull(3, None), pull(4, 1))
    assert [rows[key].pr_merged for key in "1234"] == [1, 0, None, 1]


def test_unexpected_types_do_not_drop_a_line(spark):
    rows = flat(spark, event(1, actor="nobody"), event(2, repo={"id": "x", "name": "a/b"}))
    assert rows["1"].actor_login is None and rows["1"].repo_id == 9
    assert rows["2"].repo_id is None and rows["2"].repo_name == "a/b"


def test_action_passes_through_for_stars(spark):
    assert flat(spark, event(1))["1"].pr_action == "started"


def test_resolve_hour():
    assert archive.resolve_hour("2026-04-30T14:59:00Z") == datetime(2026, 4, 30, 14)
    assert archive.resolve_hour("2026-04-30T01:30:00+02:00") == datetime(2026, 4, 29, 23)
    now = datetime(2026, 1, 1, 1, 5, tzinfo=timezone.utc)
    assert archive.resolve_hour(now=now) == datetime(2025, 12, 31, 23)


def test_archive_hours(spark):
    rows = archive.archive_hours(spark, datetime(2024, 1, 31, 22), datetime(2024, 2, 1, 1)).collect()
    assert [row.file for row in sorted(rows)] == [
        "2024-01-31-22.json.gz", "2024-01-31-23.json.gz", "2024-02-01-0.json.gz",
    ]


def test_hour_comes_from_the_path(spark):
    paths = ["/x/2024-01-02-3.json.gz", "/2020-01-01-1/archive=2024-01-02-13.json.gz/part-0.gz", "/x/notes.txt", "/x/2024-01-02-25.json.gz"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    hours = [row[0] for row in df.select(archive.hour_of_path(F.col("p"))).collect()]
    assert hours == [datetime(2024, 1, 2, 3), datetime(2024, 1, 2, 13), None, None]


def test_ingest_hour_reports_and_skips(spark, tmp_path, folder):
    lake_path = folder("lake")
    archive_file(tmp_path / "in", HOUR, event(1), pull(2), event(3, "PushEvent"), "{broken")
    report = ingest_hour(spark, str(tmp_path / "in"), HOUR, lake_path)
    assert report == {
        "counts": {"total": 3, "WatchEvent": 1, "PullRequestEvent": 1}, "hour": "2024-03-05T04:00:00+00:00",
    }
    first = lake.read_lake(spark, lake_path).collect()
    ingest_hour(spark, str(tmp_path / "in"), HOUR, lake_path)
    assert sorted(lake.read_lake(spark, lake_path).collect()) == sorted(first)
    row = next(row for row in first if row.id == "1")
    # The partition is the archive's hour, not the hour of created_at.
    assert (row.year, row.month, row.day, row.hour) == ("2024", "03", "05", "04")


def test_missing_archive_raises(spark, tmp_path, folder):
    with pytest.raises(AnalysisException):
        ingest_hour(spark, str(tmp_path), HOUR, folder("lake"))


def test_no_partition_for_an_empty_group(spark, folder):
    path = folder("lake")
    lake.write_lake(flat_rows(frame(spark, event(1))), path)
    assert [row.event_type for row in lake.written_partitions(spark, path, HOUR, HOUR).collect()] == ["WatchEvent"]


def test_half_written_hour_is_completed(spark, tmp_path, folder):
    path, after = folder("lake"), HOUR + timedelta(hours=1)
    lake.write_lake(flat_rows(frame(spark, event(1))), path)
    assert lake.ingested_hours(spark, path, HOUR, HOUR).count() == 0
    # The star partition exists, so its new row is not taken; pull requests are.
    archive_file(tmp_path, HOUR, event(1), event(9), pull(2))
    backfill(spark, str(tmp_path), path, HOUR, after)
    assert sorted(row.id for row in lake.read_lake(spark, path).collect()) == ["1", "2"]
    assert [row.hour for row in lake.ingested_hours(spark, path, HOUR, HOUR).collect()] == [HOUR]


def test_an_hour_with_stars_only_is_read_once(spark, tmp_path, folder):
    path, after = folder("lake"), HOUR + timedelta(hours=1)
    archive_file(tmp_path, HOUR, event(1))
    backfill(spark, str(tmp_path), path, HOUR, after)
    (tmp_path / "2024-03-05-4.json.gz").write_bytes(b"no gzip")
    backfill(spark, str(tmp_path), path, HOUR, after)
    assert lake.read_lake(spark, path).count() == 1


def test_a_short_range_lists_its_days_only(spark, tmp_path):
    for n in (0, 30, 24 * 40):
        archive_file(tmp_path, HOUR + timedelta(hours=n), event(n))
    archive_file(tmp_path / "archive=2024-03-05-5.json.gz", HOUR, event(7))
    listed = archive.list_archives(spark, str(tmp_path), HOUR, HOUR + timedelta(hours=3))
    assert len(listed.inputFiles()) == 2
    assert sorted(row.hour for row in listed.collect()) == [HOUR, HOUR]
    long = archive.list_archives(spark, str(tmp_path), HOUR, HOUR + timedelta(days=41))
    assert long.count() == 4
    assert archive.list_archives(spark, str(tmp_path), datetime(2020, 1, 1), datetime(2020, 1, 2)).count() == 0


def test_months():
    cut = months(datetime(2024, 1, 31, 5), datetime(2024, 3, 1, 2))
    assert cut == [
        (datetime(2024, 1, 31, 5), datetime(2024, 2, 1)),
        (datetime(2024, 2, 1), datetime(2024, 3, 1)),
        (datetime(2024, 3, 1), datetime(2024, 3, 1, 2)),
    ]
    assert months(HOUR, HOUR) == []


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_stream_takes_every_file_of_an_hour(spark, tmp_path, folder, files_per_batch):
    path, checkpoint = folder("lake"), folder("checkpoint")
    for n in range(6):
        hour = HOUR + timedelta(hours=n % 2)
        inside = tmp_path / f"archive={hour:%Y-%m-%d}-{hour.hour}.json.gz"
        inside.mkdir(exist_ok=True)
        with gzip.open(inside / f"part-{n}.gz", "wt") as out:
            out.write(event(n) + "\n" + pull(10 + n) + "\n")
    for _ in range(2):
        stream_ingest(spark, str(tmp_path), path, checkpoint, files_per_batch).awaitTermination()
    assert sorted(int(row.id) for row in lake.read_lake(spark, path).collect()) == [*range(6), *range(10, 16)]


def test_repeated_keys_and_bare_numbers_are_json(spark, tmp_path):
    twice = event(1)[:-1] + ', "id": "8"}'
    bare = [event(n)[:-1] + f', "score": {word}}}' for n, word in ((2, "NaN"), (3, "-Infinity"), (4, "[NaN, 1]"))]
    archive_file(tmp_path, HOUR, twice, *bare, event(5)[:-1] + ', "score": nan}', event(6, note="NaN,"))
    lines = archive.read_lines(spark, str(tmp_path))
    kept = ingest.flatten_events(ingest.kept_events(lines))
    assert sorted(row.id for row in kept.collect()) == ["2", "3", "4", "6", "8"]
    assert {row.event_type: row.n for row in ingest.ingest_report(lines).collect()}["total"] == 5


def test_written_partitions_covers_exactly_the_range(spark, folder):
    path = folder("lake")
    hours = [HOUR, HOUR + timedelta(hours=1), HOUR + timedelta(days=1), HOUR + timedelta(days=60)]
    for number, hour in enumerate(hours):
        lake.write_lake(flat_rows(frame(spark, event(number), hour=hour)), path)
    assert lake.written_partitions(spark, path, HOUR, HOUR).count() == 1
    assert lake.written_partitions(spark, path, HOUR, hours[2]).count() == 3
    assert lake.written_partitions(spark, path, HOUR, hours[3]).count() == 4
    assert lake.written_partitions(spark, path, datetime(2020, 1, 1), datetime(2020, 1, 2)).count() == 0
    assert lake.written_partitions(spark, folder("none"), HOUR, HOUR).count() == 0


def test_schema_is_stable_without_pull_requests(spark, folder):
    path = folder("lake")
    lake.write_lake(flat_rows(frame(spark, event(1))), path)
    lake.write_lake(flat_rows(frame(spark, pull(2), hour=HOUR + timedelta(hours=1))), path)
    assert lake.read_lake(spark, path).schema == RAW
    assert spark.read.option("mergeSchema", "true").parquet(path).count() == 2


def test_compact_gathers_a_scattered_hour(spark, folder):
    path = folder("lake")
    rows = flat_rows(frame(spark, *[event(n) for n in range(40)]).repartition(8))
    lake.write_lake(rows, path, compact=True)
    assert len(lake.read_lake(spark, path).inputFiles()) == 1


def test_backfill_and_stream_agree(spark, tmp_path, folder):
    source = tmp_path / "in"
    for n in range(5):
        archive_file(source, HOUR + timedelta(hours=n), event(n), pull(10 + n), event(20 + n, "ForkEvent"))
    (source / "notes.txt").write_text("not an archive\n")
    with gzip.open(source / "notes.gz", "wt") as out:
        out.write(event(77))
    batch, streamed, checkpoint = folder("batch"), folder("stream"), folder("checkpoint")
    end = HOUR + timedelta(hours=5)
    backfill(spark, str(source), batch, HOUR, HOUR + timedelta(hours=2))
    assert lake.read_lake(spark, batch).count() == 4
    backfill(spark, str(source), batch, HOUR, end)
    backfill(spark, str(source), batch, HOUR, end)
    stream_ingest(spark, str(source), streamed, checkpoint, files_per_batch=2).awaitTermination()
    once = sorted(lake.read_lake(spark, streamed).collect())
    assert len(once) == 10 and once == sorted(lake.read_lake(spark, batch).collect())
    # A new archive is picked up, the others are not taken again; and backfill and
    # stream can share a lake.
    archive_file(source, end, event(99))
    stream_ingest(spark, str(source), streamed, checkpoint).awaitTermination()
    stream_ingest(spark, str(source), batch, folder("checkpoint")).awaitTermination()
    assert lake.read_lake(spark, streamed).count() == 11
    assert lake.read_lake(spark, batch).count() == 11


def test_backfill_opens_only_pending_archives(spark, tmp_path, folder):
    path, end = folder("lake"), HOUR + timedelta(hours=3)
    for n in range(6):
        archive_file(tmp_path, HOUR + timedelta(hours=n), event(n), pull(10 + n))
    backfill(spark, str(tmp_path), path, HOUR, HOUR + timedelta(hours=1))
    pending = pending_archives(spark, str(tmp_path), path, HOUR, end - timedelta(hours=1)).collect()
    assert sorted(row.hour for row in pending) == [HOUR + timedelta(hours=1), HOUR + timedelta(hours=2)]
    # Archives that are complete or out of the range are not opened: damage does no harm.
    (tmp_path / "2024-03-05-4.json.gz").write_bytes(b"no gzip")
    (tmp_path / "2024-03-05-9.json.gz").write_bytes(b"no gzip")
    backfill(spark, str(tmp_path), path, HOUR, end)
    assert lake.read_lake(spark, path).count() == 6


def test_hour_is_computed_for_kept_lines_only(spark, tmp_path):
    archive_file(tmp_path, HOUR, event(1))
    plan = flat_rows(archive.read_lines(spark, str(tmp_path)))._jdf.queryExecution().executedPlan()
    filters = [line for line in plan.toString().splitlines() if " Filter (" in line]
    assert len(filters) == 1 and "regexp_extract" not in filters[0]


def test_drop_repeated(spark):
    rows = ingest.flatten_events(ingest.kept_events(frame(spark, event(1), event(1), event(2))))
    assert rows.count() == 3 and ingest.drop_repeated(rows).count() == 2


def test_repeated_deliveries_can_be_dropped(spark, tmp_path, folder):
    inside = tmp_path / f"archive={HOUR:%Y-%m-%d}-{HOUR.hour}.json.gz"
    inside.mkdir()
    for n in range(3):
        with gzip.open(inside / f"part-{n}.gz", "wt") as out:
            out.write("\n".join([event(1), event(n), event(5, id=None)]) + "\n")
    streamed, filled = folder("stream"), folder("batch")
    stream_ingest(spark, str(tmp_path), streamed, folder("checkpoint"), 1, once=True).awaitTermination()
    backfill(spark, str(tmp_path), filled, HOUR, HOUR + timedelta(hours=1), once=True)
    for path in (streamed, filled):
        ids = sorted(row.id or "" for row in lake.read_lake(spark, path).collect())
        assert ids == ["", "", "", "0", "1", "2"]


def test_session_zone_does_not_matter(spark, tmp_path, folder):
    for n in range(3):
        archive_file(tmp_path, HOUR + timedelta(hours=n), event(n))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        path = folder("lake")
        backfill(spark, str(tmp_path), path, HOUR, HOUR + timedelta(hours=2))
        backfill(spark, str(tmp_path), path, HOUR, HOUR + timedelta(hours=2))
        assert sorted(row.hour for row in lake.read_lake(spark, path).collect()) == ["04", "05"]
        files = archive.archive_hours(spark, HOUR, HOUR + timedelta(hours=1)).collect()
        assert files[0].hour == HOUR and files[0].file == "2024-03-05-4.json.gz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
