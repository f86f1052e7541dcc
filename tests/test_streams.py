"""Streams that read each file once, and that drop repeated events."""

import gzip
import os
from datetime import timedelta

import pytest

from repopulse.plans import ingest as plans
from repopulse.plans.ingest import backfill, pending_archives, replace_hours
from repopulse.schemas import FLAT
from repopulse.sources import archive, lake
from repopulse.streaming.ingest import late_events, stream_append, stream_distinct, stream_ingest
from tests.test_ingest import HOUR, event, pull

WAIT = timedelta(hours=1)


def at(hour, number, **changes):
    return event(number, created_at=f"{hour:%Y-%m-%dT%H}:30:00Z", **changes)


def part(folder, hour, name, *texts, arrived=None):
    """One of several files of an hour, in the hour's folder."""
    inside = folder / f"archive={hour:%Y-%m-%d}-{hour.hour}.json.gz"
    inside.mkdir(parents=True, exist_ok=True)
    file = inside / f"{name}.gz"
    with gzip.open(file, "wt") as out:
        out.write("\n".join(texts) + "\n")
    if arrived is not None:
        os.utime(file, (1_700_000_000 + arrived, 1_700_000_000 + arrived))


def ids(spark, path):
    return sorted(row.id or "" for row in lake.read_lake(spark, path).collect())


def test_every_file_is_read_once(spark, tmp_path, folder, monkeypatch):
    """Nine files of three hours in nine micro-batches; rows as a backfill gives them."""
    path, opened = folder("lake"), []
    read = plans.read_lines
    monkeypatch.setattr(plans, "read_lines", lambda spark, paths: opened.extend(paths) or read(spark, paths))
    for n in range(9):
        part(tmp_path, HOUR + (n % 3) * WAIT, f"part-{n}", event(n), pull(10 + n), event(30 + n, "ForkEvent"), arrived=n)
    checkpoint = folder("checkpoint")
    stream_append(spark, str(tmp_path), path, checkpoint, files_per_batch=1).awaitTermination()
    assert len(opened) == len(set(opened)) == 9
    known = lake.ledger(spark, path)
    assert known.select("commit").distinct().count() == 9 and known.where("size > 0").count() == 9
    part(tmp_path, HOUR, "late", event(99))
    stream_append(spark, str(tmp_path), path, checkpoint).awaitTermination()
    # Another stream finds nothing new, and a backfill leaves the hours alone.
    stream_append(spark, str(tmp_path), path, folder("checkpoint")).awaitTermination()
    assert len(opened) == 10
    backfill(spark, str(tmp_path), path, HOUR, HOUR + 3 * WAIT)
    filled = folder("filled")
    backfill(spark, str(tmp_path), filled, HOUR, HOUR + 3 * WAIT)
    assert sorted(lake.read_lake(spark, path).collect()) == sorted(lake.read_lake(spark, filled).collect())
    # What a backfill has read, a stream doesn't read again.
    stream_append(spark, str(tmp_path), filled, folder("checkpoint")).awaitTermination()
    assert len(ids(spark, filled)) == 19


def test_hours_ingested_without_a_ledger_are_complete(spark, tmp_path, folder):
    path = folder("lake")
    part(tmp_path, HOUR, "a", event(1))
    lake.record_hours(spark.createDataFrame([(HOUR,)], "hour timestamp_ntz"), path)
    part(tmp_path, HOUR + WAIT, "b", event(2))
    stream_append(spark, str(tmp_path), path, folder("checkpoint")).awaitTermination()
    assert ids(spark, path) == ["2"]


@pytest.mark.parametrize("died", ["before the commit", "after the commit", "while moving"])
def test_a_commit_that_died_is_finished(spark, tmp_path, folder, monkeypatch, died):
    path = folder("lake")
    for n in range(3):
        part(tmp_path, HOUR + n * WAIT, "a", event(n), pull(10 + n))
    arrived = archive.list_archives(spark, str(tmp_path), HOUR, HOUR + 2 * WAIT).withColumnRenamed("path", "file")

    def dies(*_args):
        raise OSError("died")

    with monkeypatch.context() as broken:
        if died == "before the commit":
            broken.setattr(lake, "record_files", dies)
        else:
            broken.setattr(lake, "move_files", dies)
        with pytest.raises(OSError, match="died"):
            plans.append_files(spark, arrived, path)
    if died == "while moving":
        # One of the folders had moved already.
        staged = next((tmp_path.__class__(path) / "_staged").glob("*/event_type=WatchEvent"))
        staged.rename(tmp_path.__class__(path) / "event_type=WatchEvent")
    for _ in range(2):
        plans.append_files(spark, arrived, path)
        assert ids(spark, path) == sorted(["0", "1", "2", "10", "11", "12"])
    assert lake.ledger(spark, path).count() == 3


def test_repeated_deliveries_over_hours_are_dropped(spark, tmp_path, folder):
    """In the next hour's file, in the same micro-batch and in a later one; rows without id stay."""
    path, checkpoint = folder("lake"), folder("checkpoint")
    hours = [HOUR + n * WAIT for n in range(6)]
    for n, hour in enumerate(hours):
        again = [at(hours[n - 1], n - 1)] if n else []
        part(tmp_path, hour, "a", at(hour, n), at(hour, n), *again, at(hour, n, id=None), arrived=n)
    stream_distinct(spark, str(tmp_path), path, checkpoint, "3 hours", 2).awaitTermination()
    assert ids(spark, path) == ["", "", "", "", "", "", "0", "1", "2", "3", "4", "5"]
    # A restart from the checkpoint remembers: the last event comes once more, and a new one.
    late = HOUR + 6 * WAIT
    part(tmp_path, late, "a", at(hours[5], 5), at(late, 6), arrived=6)
    stream_distinct(spark, str(tmp_path), path, checkpoint, "3 hours", 2).awaitTermination()
    assert ids(spark, path) == ["", "", "", "", "", "", "0", "1", "2", "3", "4", "5", "6"]
    # From nothing, in one micro-batch: the same events.
    whole = folder("whole")
    stream_distinct(spark, str(tmp_path), whole, folder("checkpoint"), "3 hours").awaitTermination()
    names = [name for name in FLAT.names]
    rows = [sorted(map(str, lake.read_lake(spark, p).select(names).collect())) for p in (path, whole)]
    assert rows[0] == rows[1]


def test_late_events_are_dropped_and_counted(spark, tmp_path, folder):
    path = folder("lake")
    for n in range(5):
        part(tmp_path, HOUR + n * WAIT, "a", at(HOUR + n * WAIT, n), arrived=n)
    # Two days old, never seen; and a copy of the first event, whose id is forgotten by now.
    old = HOUR - timedelta(days=2)
    part(tmp_path, HOUR + 5 * WAIT, "a", at(old, 50), at(HOUR, 0), at(HOUR + 5 * WAIT, 5), arrived=5)
    query = stream_distinct(spark, str(tmp_path), path, folder("checkpoint"), "1 hour", 1)
    query.awaitTermination()
    assert ids(spark, path) == ["0", "1", "2", "3", "4", "5"] and late_events(query) == 2


def test_state_has_a_partition_for_each_core_at_most(spark, tmp_path, folder):
    part(tmp_path, HOUR, "a", at(HOUR, 0), at(HOUR, 0), at(HOUR, 1), arrived=0)
    conf, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(conf)
    spark.conf.set(conf, cores + 24)
    try:
        for asked, given in ((None, cores), (3, 3)):
            path, checkpoint = folder("lake"), folder("checkpoint")
            query = stream_distinct(spark, str(tmp_path), path, checkpoint, "1 hour", state_partitions=asked)
            query.awaitTermination()
            states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
            assert {state["numShufflePartitions"] for state in states} == {given}
            assert ids(spark, path) == ["0", "1"] and spark.conf.get(conf) == str(cores + 24)
    finally:
        spark.conf.set(conf, before)


def test_events_without_a_readable_time_take_the_archives(spark, tmp_path, folder):
    path = folder("lake")
    part(tmp_path, HOUR, "a", event(1, created_at="yesterday"), event(1, created_at="yesterday"), event(2, created_at=None))
    stream_distinct(spark, str(tmp_path), path, folder("checkpoint")).awaitTermination()
    assert ids(spark, path) == ["1", "2"]


def test_archives_in_subfolders(spark, tmp_path, folder):
    """Files by year and month, and an hour's folder of files, at any depth."""
    inside = tmp_path / f"{HOUR:%Y}" / f"{HOUR:%m}"
    inside.mkdir(parents=True)
    with gzip.open(inside / f"{HOUR:%Y-%m-%d}-{HOUR.hour}.json.gz", "wt") as out:
        out.write(event(1))
    part(tmp_path / "deep" / "deeper", HOUR + WAIT, "x", event(2))
    listed = archive.list_archives(spark, str(tmp_path), HOUR, HOUR + WAIT)
    assert listed.count() == 2 and listed.where("size > 0").count() == 2
    path = folder("lake")
    backfill(spark, str(tmp_path), path, HOUR, HOUR + 2 * WAIT)
    assert ids(spark, path) == ["1", "2"]
    streamed = folder("streamed")
    stream_ingest(spark, str(tmp_path), streamed, folder("checkpoint")).awaitTermination()
    assert ids(spark, streamed) == ["1", "2"]


def test_hours_that_list_nothing_are_not_recorded(spark, tmp_path, folder):
    path = folder("lake")
    arrived = spark.createDataFrame([(HOUR,)], "archive_hour timestamp_ntz")
    replace_hours(spark, str(tmp_path), arrived, path)
    part(tmp_path, HOUR, "a", event(1))
    assert pending_archives(spark, str(tmp_path), path, HOUR, HOUR).count() == 1
