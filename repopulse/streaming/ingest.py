"""Ingest archives as they appear, with the batch functions.

Three ways to the same lake. ``stream_ingest`` ingests an hour anew whenever a file of it
arrives; ``stream_append`` reads each file once and adds its rows; ``stream_distinct``
does that, too, and drops events that were delivered before, in whichever hour.
"""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ingest import distinct_events, flatten_events, kept_events
from ..plans.ingest import append_files, replace_hours
from ..schemas import LEDGER
from ..sources.archive import stream_files, stream_lines
from ..sources.lake import append_once, with_partitions
from ..sources.tables import file_system

_PARTITIONS = "spark.sql.shuffle.partitions"


def stream_ingest(
    spark: SparkSession,
    source: str,
    lake: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    once: bool = False,
) -> StreamingQuery:
    """Start ingesting the archives in ``source`` that were not ingested before, then stop.

    A micro-batch names the hours that files arrived for; the hours are then ingested
    anew from all their files. So the files of an hour may fall into several batches,
    and a batch that is repeated after a failure gives the same partitions. A file sink
    would hide partitions written by ``backfill`` from readers; this does not. ``once``
    drops repeated deliveries within an hour, in whichever file and batch they came; no
    state is kept for that, as the hour is read whole.
    """

    def write(lines: DataFrame, _batch: int) -> None:
        replace_hours(lines.sparkSession, source, lines, lake, once)

    return (
        stream_lines(spark, source, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_append(
    spark: SparkSession, source: str, lake: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Start ingesting the files in ``source`` that the lake doesn't have, each read once, then stop.

    The stream carries names of files. Those of a micro-batch are read and added to the
    partitions of their hours in one commit, which is entered in the lake's ledger of
    files. So many files of an hour cost what they hold, however they arrive, and a batch
    that is repeated after a failure adds nothing. Repeated deliveries are kept.
    """

    def write(arrived: DataFrame, _batch: int) -> None:
        append_files(arrived.sparkSession, arrived, lake)

    return (
        stream_files(spark, source, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The query's own id, which its checkpoint keeps over restarts."""
    files, place = file_system(spark, f"{checkpoint.rstrip('/')}/metadata")
    stream = files.open(place)
    try:
        return json.loads(bytes(stream.readAllBytes()))["id"]
    finally:
        stream.close()


def stream_distinct(
    spark: SparkSession,
    source: str,
    lake: str,
    checkpoint: str,
    delay: str = "6 hours",
    files_per_batch: int = 1000,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start ingesting the archives in ``source``, each event id once, then stop.

    An event that is delivered again is dropped, in whichever file, hour and batch it
    comes: within ``delay`` of the newest event seen, because its id is still in the state
    store; after that, because it is late. So ``delay`` must exceed the time by which
    archives arrive out of order: an event that comes first after that is late, too, and
    ``late_events`` counts it. The state holds the ids of ``delay``, not of all time, and
    is dealt by id, so no repository or account is a hot key. A micro-batch writes files for
    every partition of the state, however few ids it brings, so the state has no more
    partitions than the cluster has cores unless ``state_partitions`` says otherwise; a
    checkpoint keeps the number that its first run had.

    A micro-batch is added to its partitions in one commit, named by the query and the
    batch, so a restart from the checkpoint neither loses nor repeats rows.
    """
    events = distinct_events(flatten_events(kept_events(stream_lines(spark, source, files_per_batch))), delay)

    def write(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        commit = f"{_stream_id(session, checkpoint)}-{batch}"
        # Rows come by id, an hour's from every task.
        append_once(rows, lake, commit, session.createDataFrame([], LEDGER), compact=True)

    writer = (
        with_partitions(events)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    # A query takes the session's settings when it starts.
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, state_partitions or min(int(before), spark.sparkContext.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set(_PARTITIONS, before)


def late_events(query: StreamingQuery) -> int:
    """Events that a run of ``stream_distinct`` dropped because they were late.

    From the progress that Spark keeps, the last hundred batches by default
    (``spark.sql.streaming.numRecentProgressUpdates``).
    """
    states = (state for progress in query.recentProgress for state in progress["stateOperators"])
    return sum(state["numRowsDroppedByWatermark"] for state in states)
