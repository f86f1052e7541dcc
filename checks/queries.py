"""One entry per operator: (spark, folder of tables) -> DataFrame."""

from collections.abc import Callable
from datetime import datetime, timedelta
from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.operators import activity as act
from repopulse.operators import (
    analyses,
    catalog,
    cells,
    distincts,
    embedding,
    ingest,
    quality,
    search,
    staging,
    trends,
)
from repopulse.functions.events import STAR, is_star
from repopulse.functions.vectors import unit
from repopulse.plans.embed import encode_query, new_rows
from repopulse.plans.ingest import backfill, flat_rows
from repopulse.plans.refresh import refresh_mart
from repopulse.plans.trends import trends as mart_of
from repopulse.schemas import FLAT, NUMBERS, PARTITIONS
from repopulse.session import shared_folder
from repopulse.sources import archive, index, lake
from repopulse.sources import mart as mart_table
from repopulse.streaming import ingest as streaming

from . import adapters as a

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters, shared with the oracle. The tables hold fewer stars per repository than
# the thresholds that the operators default to.
VELOCITY_FLOOR = 30
EMERGING = {"peak": 5, "quiet": 2, "min_days": 2}
CROSSING = 5
QUERY_TEXT = "data engineering python pipelines"
FUTURE_AS_OF = datetime(2024, 1, 20).date()
FRESH_AS_OF = datetime(2024, 1, 31, 3)
HOUR_LEFT_OUT = "01-10-05"
PIVOT_NAMES = ["org1/repo1", "org2/repo2", "org7/repo7", "org7/repo7-renamed", "nobody/nothing"]
CHUNK = {"size": 1000, "overlap": 200}
TOP_CANDIDATES = 500
LATE_FROM, LATE_TO, LATE_END = "01-20-10", "01-20-13", "01-29-00"
FIRST_RUN = "0116"
RECALL = 0.9
LAST_WEEK = datetime(2001, 10, 28).date()


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_of(a.activity(spark, sf))


def _wide_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_of(a.wide(spark, sf))


# --- ingest ------------------------------------------------------------------


@query
def resolve_hour(spark, sf):
    """Hours of a range that begins before the data and for which an archive is there."""
    start, folder = a.FIRST_HOUR - timedelta(days=2), a.archives(spark, sf)
    there = archive.list_archives(spark, folder, start, a.LAST_HOUR).select("hour")
    hours = archive.archive_hours(spark, start, a.END).join(there, "hour", "left_semi")
    return hours.withColumnRenamed("hour", "archive_hour")


@query
def ingest_parse(spark, sf):
    events = ingest.parse_events(a.archived_lines(spark, sf))
    return ingest.flatten_events(events).select("id", "type", "archive_hour")


@query
def ingest_filter_types(spark, sf):
    events = ingest.keep_types(ingest.parse_events(a.archived_lines(spark, sf)))
    return ingest.flatten_events(events).select("id", "type", "archive_hour")


@query
def ingest_flatten(spark, sf):
    return ingest.flatten_events(ingest.kept_events(a.archived_lines(spark, sf)))


@query
def ingest_counts(spark, sf):
    return ingest.ingest_report(a.archived_lines(spark, sf))


@query
def lake_write(spark, sf):
    path = shared_folder(spark, "lake")
    lake.write_lake(flat_rows(a.archived_lines(spark, sf)), path)
    return lake.read_lake(spark, path)


@query
def lake_skip_existing(spark, sf):
    """Stars first, then everything: the second run must add pull requests only."""
    path = shared_folder(spark, "lake")
    rows = flat_rows(a.archived_lines(spark, sf))
    lake.write_lake(rows.where(F.col("event_type") == "WatchEvent"), path)
    written = lake.written_partitions(spark, path, a.FIRST_HOUR, a.LAST_HOUR)
    lake.write_lake(lake.skip_existing(rows, written), path)
    return lake.read_lake(spark, path)


@query
def lake_read(spark, sf):
    """Stars per day, from a lake read through its partitions."""
    stars = lake.read_lake(spark, a.written_lake(spark, sf)).where(is_star() & (F.col("year") == a.YEAR))
    return stars.groupBy("event_type", "month", "day").agg(F.count("*").alias("events"))


@query
def backfill_range(spark, sf):
    path = shared_folder(spark, "lake")
    backfill(spark, a.archives(spark, sf), path, a.FIRST_HOUR, a.END)
    return lake.read_lake(spark, path)


@query
def stream_ingest(spark, sf):
    """In several micro-batches, which split hours that have several files."""
    path, checkpoint = shared_folder(spark, "lake"), shared_folder(spark, "checkpoint")
    streaming.stream_ingest(spark, a.archives(spark, sf), path, checkpoint, files_per_batch=250).awaitTermination()
    return lake.read_lake(spark, path)


@query
def stream_append(spark, sf):
    """In several micro-batches, which split hours that have several files; each file is read once."""
    path, checkpoint = shared_folder(spark, "lake"), shared_folder(spark, "checkpoint")
    streaming.stream_append(spark, a.archives(spark, sf), path, checkpoint, files_per_batch=250).awaitTermination()
    return lake.read_lake(spark, path)


@query
def stream_distinct(spark, sf):
    """Archives with repeated deliveries, in several micro-batches: each event once.

    Which of two deliveries in one micro-batch stays is open, so no partitions are shown.
    """
    path, checkpoint = shared_folder(spark, "lake"), shared_folder(spark, "checkpoint")
    streaming.stream_distinct(spark, a.redelivered(spark, sf), path, checkpoint, "3 hours", 200).awaitTermination()
    return lake.read_lake(spark, path).select(FLAT.names)


# --- staging, activity, mart -------------------------------------------------


@query
def stg_watch_events(spark, sf):
    return staging.stg_watch_events(a.activity(spark, sf))


@query
def stg_pull_request_events(spark, sf):
    return staging.stg_pull_request_events(a.activity(spark, sf))


@query
def daily_stars(spark, sf):
    return act.daily_stars(stg_watch_events(spark, sf))


@query
def daily_prs(spark, sf):
    return act.daily_prs(stg_pull_request_events(spark, sf))


@query
def repo_daily_activity(spark, sf):
    return act.repo_daily_activity(a.activity(spark, sf))


@query
def repo_daily_activity_joined(spark, sf):
    return act.join_daily(daily_stars(spark, sf), daily_prs(spark, sf))


@query
def repo_trends_daily(spark, sf):
    return _mart(spark, sf)


@query
def repo_trends_daily_wide(spark, sf):
    return _wide_mart(spark, sf)


@query
def mart_write(spark, sf):
    path = shared_folder(spark, "mart")
    mart_table.write_mart(_mart(spark, sf), path)
    return mart_table.read_mart(spark, path)


@query
def repo_trends_daily_calendar(spark, sf):
    """With the sum over seven dates beside that over seven active days."""
    return act.repo_trends_daily(act.repo_daily_activity(a.wide(spark, sf)), calendar=True)


def _late() -> Column:
    """Hours that come after the first build: some in the middle and the last two days."""
    stamp = F.concat_ws("-", "month", "day", "hour")
    return stamp.between(LATE_FROM, LATE_TO) | (stamp >= LATE_END)


@query
def mart_refresh(spark, sf):
    """A mart built without some hours, and refreshed when they had come."""
    path, mart = shared_folder(spark, "lake"), shared_folder(spark, "mart")
    raw = lake.read_lake(spark, a.written_lake(spark, sf))
    lake.write_lake(raw.where(~_late()), path)
    refresh_mart(spark, path, mart)
    lake.write_lake(raw.where(_late()), path)
    refresh_mart(spark, path, mart)
    return mart_table.read_mart(spark, mart)


@query
def mart_audit(spark, sf):
    """Failing checks of a refresh with broken rows, which isn't published."""
    path = shared_folder(spark, "mart")
    good = _read_mart(spark, sf)
    mart_table.write_mart(good, path, partial(quality.mart_checks, as_of=a.AS_OF))
    last = good.where(F.col("event_date") == a.AS_OF).withColumn("stars", -1 - F.col("stars"))
    try:
        mart_table.write_mart(good.unionByName(last), path, partial(quality.mart_checks, as_of=a.AS_OF))
    except mart_table.AuditFailed as failed:
        kept = mart_table.read_mart(spark, path).count()
        rows = [(*row, kept) for row in failed.rows]
        return spark.createDataFrame(rows, "check string, column string, failing_rows long, passed boolean, mart_rows long")


# --- analyses ----------------------------------------------------------------


@query
def top_starred_repos(spark, sf):
    return analyses.top_starred_repos(a.activity(spark, sf), a.YEAR)


@query
def star_velocity(spark, sf):
    return analyses.star_velocity(a.activity(spark, sf), a.YEAR, min_total=VELOCITY_FLOOR)


@query
def star_velocity_wide(spark, sf):
    return analyses.star_velocity(a.wide(spark, sf), a.WIDE_YEAR, min_total=1)


@query
def pr_merge_rate(spark, sf):
    return analyses.pr_merge_rate(a.activity(spark, sf), a.YEAR)


@query
def top_organizations(spark, sf):
    return analyses.top_organizations(a.activity(spark, sf), a.YEAR)


@query
def top_organizations_wide(spark, sf):
    return analyses.top_organizations(a.wide(spark, sf), a.WIDE_YEAR)


@query
def active_users(spark, sf):
    return analyses.active_users(a.activity(spark, sf), a.YEAR)


@query
def active_users_wide(spark, sf):
    return analyses.active_users(a.wide(spark, sf), a.WIDE_YEAR)


def _in_two_runs(raw: DataFrame, days_of: Callable) -> tuple[DataFrame, DataFrame]:
    """Totals and bitmaps of two runs, the second of which finds a dictionary."""
    early = F.concat("month", "day") <= FIRST_RUN
    numbers = distincts.new_numbers(_values(raw.where(early)), raw.sparkSession.createDataFrame([], NUMBERS))
    more = numbers.unionByName(distincts.new_numbers(_values(raw.where(~early)), numbers))
    runs = days_of(raw.where(early), numbers), days_of(raw.where(~early), more)
    return tuple(one.unionByName(other) for one, other in zip(*runs))


def _values(raw: DataFrame) -> DataFrame:
    return raw.select("repo_name").union(raw.select("actor_login")).toDF("value")


@query
def top_organizations_merged(spark, sf):
    """From bitmaps of days, counted in two runs."""
    return distincts.organizations_of(*_in_two_runs(a.activity(spark, sf), distincts.organization_days), a.YEAR)


@query
def active_users_merged(spark, sf):
    return distincts.users_of(*_in_two_runs(a.activity(spark, sf), distincts.user_days), a.YEAR)


@query
def hourly_stars(spark, sf):
    return analyses.hourly_stars(a.activity(spark, sf), a.YEAR)


@query
def emerging_repos(spark, sf):
    return analyses.emerging_repos(a.activity(spark, sf), a.YEAR, **EMERGING)


# --- dashboard ---------------------------------------------------------------


def _read_mart(spark: SparkSession, sf: str) -> DataFrame:
    return mart_table.read_mart(spark, a.written_mart(spark, sf))


def _read_wide_mart(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(a.written_wide_mart(spark, sf))


@query
def trending_window(spark, sf):
    return trends.trending_window(_read_mart(spark, sf), a.AS_OF)


@query
def trending_window_week(spark, sf):
    return trends.trending_window(_read_mart(spark, sf), a.AS_OF, days=7)


@query
def trending_window_today(spark, sf):
    """With the default date: the mart is moved so that it ends today."""
    moved = F.date_add("event_date", F.date_diff(F.current_date(), F.lit(a.AS_OF)))
    return trends.trending_window(_read_mart(spark, sf).withColumn("event_date", moved))


@query
def trend_series(spark, sf):
    return trends.trend_series(_read_mart(spark, sf), a.AS_OF)


@query
def trend_pivot(spark, sf):
    return trends.ranked_pivot(_read_mart(spark, sf), a.AS_OF)


@query
def trend_pivot_names(spark, sf):
    """By repository name; the names that lead at any scale are asked for."""
    series = trends.trend_series(_read_mart(spark, sf), a.AS_OF, count=100)
    return trends.trend_pivot(series, PIVOT_NAMES)


# --- embedding and search ----------------------------------------------------


@query
def embed_candidates(spark, sf):
    return embedding.embed_candidates(_read_wide_mart(spark, sf), a.WIDE_AS_OF, n=TOP_CANDIDATES)


@cache
def _last_week(spark: SparkSession, sf: str) -> str:
    """Path of the index that a run one week earlier wrote; once per session."""
    path = shared_folder(spark, "last-week")
    index.write_index(
        new_rows(
            _read_wide_mart(spark, sf).where(F.col("event_date") <= LAST_WEEK),
            a.repos(spark, sf), index.read_index(spark, path), embedding.letters26, LAST_WEEK, n=TOP_CANDIDATES,
        ),
        path,
    )
    return path


def _last_week_index(spark, sf):
    return index.read_index(spark, _last_week(spark, sf))


@query
def embed_pending(spark, sf):
    return embedding.embed_pending(embed_candidates(spark, sf), _last_week_index(spark, sf))


@query
def repo_enrich(spark, sf):
    pending = embedding.one_name_each(embed_pending(spark, sf))
    return embedding.repo_enrich(pending, a.repos(spark, sf))


@query
def embed_text(spark, sf):
    return embedding.embed_text(repo_enrich(spark, sf)).select("repo_id", "full_name", "text")


@query
def encode(spark, sf):
    texts = embedding.embed_text(a.documents(spark, sf))
    return a.by_dimension(embedding.encode(texts, embedding.letters26), "repo_id")


@query
def encode_hashing(spark, sf):
    """Hashed words of all documents, weighted by how few documents have them."""
    texts = embedding.embed_text(a.documents(spark, sf))
    encoded = embedding.encode(texts, embedding.md5_encoder(embedding.fit_md5(texts)))
    return a.by_dimension(encoded, "repo_id").where("value <> 0")


@query
def encode_model(spark, sf):
    """A user's model: here one that counts characters, words and lines."""

    def load():
        return lambda texts: [[len(t), len(t.split()), t.count("\n") + 1] for t in texts]

    texts = embedding.embed_text(a.documents(spark, sf))
    return a.by_dimension(embedding.encode(texts, embedding.model_encoder(load)), "repo_id")


@query
def index_append(spark, sf):
    new = embedding.index_rows(embedding.letters26(embedding.embed_text(repo_enrich(spark, sf))))
    return embedding.index_append(_last_week_index(spark, sf), new).drop("embedding")


@query
def index_write(spark, sf):
    """Two weekly runs appended to one table and read back."""
    path = shared_folder(spark, "index")
    index.write_index(_last_week_index(spark, sf), path)
    mart, repos = _read_wide_mart(spark, sf), a.repos(spark, sf)
    rows = new_rows(
        mart, repos, index.read_index(spark, path), embedding.letters26, a.WIDE_AS_OF, n=TOP_CANDIDATES
    )
    index.write_index(rows, path)
    return a.by_dimension(index.read_index(spark, path), "repo_id", "full_name")


@query
def index_read(spark, sf):
    """An index of all documents, and one that was never written, read alike."""
    path = a.written_index(spark, sf)
    missing = index.read_index(spark, shared_folder(spark, "missing"))
    found = embedding.index_append(index.read_index(spark, path), missing)
    return found.select("repo_id", "full_name", "language", "stars", F.size("embedding").alias("dims"))


@query
def l2_normalize(spark, sf):
    vectors = a.vector_index(spark, sf).withColumn("embedding", unit("embedding"))
    return a.by_dimension(vectors, "repo_id")


def _documents_index(spark: SparkSession, sf: str) -> DataFrame:
    return index.read_index(spark, a.written_index(spark, sf))


@query
def semantic_search(spark, sf):
    vector = encode_query(spark, QUERY_TEXT, embedding.letters26)
    found = search.semantic_search(_documents_index(spark, sf), vector)
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def semantic_search_vectors(spark, sf):
    vectors = spark.read.parquet(a.written_vectors(spark, sf))
    found = search.semantic_search(vectors, a.mean_vector(spark, sf))
    return found.withColumn("similarity", F.round("similarity", 6))


@query
def semantic_search_batch(spark, sf):
    """Every benchmark text as a query, in several slices."""
    found = search.semantic_search_batch(_documents_index(spark, sf), a.questions(spark, sf), slice_size=16)
    columns = ("query_id", "rank", "repo_id", "full_name", "language", "stars")
    return found.select(*columns, F.round("similarity", 6).alias("similarity"))


@query
def semantic_search_centroids(spark, sf):
    vectors = spark.read.parquet(a.written_vectors(spark, sf))
    found = search.semantic_search_batch(vectors, a.centroids(spark, sf))
    return found.withColumn("similarity", F.round("similarity", 6))


@cache
def _cells(spark: SparkSession, sf: str) -> str:
    """Path of the index of all documents by cells; written once per session."""
    path, documents = shared_folder(spark, "cells"), _documents_index(spark, sf)
    cells.write_cells(documents, path, cells.fit_cells(documents))
    return path


@query
def semantic_search_cells(spark, sf):
    """Approximate search for every benchmark text, measured against the exact one."""
    asked = a.questions(spark, sf)
    found = cells.search_cells(spark, _cells(spark, sf), asked)
    hits = cells.recall(search.semantic_search_batch(_documents_index(spark, sf), asked), found)
    reached = F.sum("hits") >= RECALL * F.sum("wanted")
    return hits.agg(F.count("*").alias("queries"), F.sum("wanted").alias("wanted"), reached.alias("recall_reached"))


@query
def search_display(spark, sf):
    vector = encode_query(spark, QUERY_TEXT, embedding.letters26)
    return search.search_display(search.semantic_search(_documents_index(spark, sf), vector))


# --- data checks -------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    raw = quality.dq_not_null(a.activity(spark, sf), quality.RAW_NOT_NULL + ("repo_name",))
    return raw.unionByName(quality.dq_not_null(_mart(spark, sf), quality.MART_NOT_NULL))


@query
def dq_accepted_values(spark, sf):
    raw = a.activity(spark, sf)
    types = quality.dq_accepted_values(raw, "event_type", quality.KEPT_TYPES)
    return types.unionByName(quality.dq_accepted_values(raw, "pr_action", ("opened", "closed")))


@query
def dq_accepted_range(spark, sf):
    ranges = {**quality.MART_RANGES, "stars_7d_rolling": (2, 10)}
    return quality.dq_accepted_range(_mart(spark, sf), ranges)


@query
def dq_unique_combination(spark, sf):
    mart = quality.dq_unique_combination(_mart(spark, sf), quality.MART_KEY)
    raw = quality.dq_unique_combination(a.activity(spark, sf), ("repo_id", "actor_id"))
    return mart.unionByName(raw)


@query
def dq_no_future_dates(spark, sf):
    return quality.dq_no_future_dates(_mart(spark, sf), FUTURE_AS_OF)


@query
def dq_reconcile(spark, sf):
    return quality.dq_reconcile(a.activity(spark, sf), _mart(spark, sf))


@query
def dq_raw_checks(spark, sf):
    return quality.raw_checks(a.activity(spark, sf))


@query
def dq_mart_checks(spark, sf):
    return quality.mart_checks(_mart(spark, sf), FUTURE_AS_OF)


@query
def dq_freshness(spark, sf):
    fresh = quality.dq_freshness(a.activity(spark, sf), FRESH_AS_OF)
    return fresh.withColumn("age_hours", F.round("age_hours", 6))


@query
def dq_missing_hours(spark, sf):
    """Over the written lake, without the stars of one hour, from before its first hour."""
    hours = lake.read_lake(spark, a.written_lake(spark, sf)).select(*PARTITIONS)
    left_out = (F.col("event_type") == STAR) & (F.concat_ws("-", "month", "day", "hour") == HOUR_LEFT_OUT)
    return quality.dq_missing_hours(hours.where(~left_out), a.FIRST_HOUR - timedelta(hours=6), a.LAST_HOUR)


# --- further marts -----------------------------------------------------------


@query
def dim_repos(spark, sf):
    return catalog.dim_repos(repo_daily_activity(spark, sf))


@query
def name_history(spark, sf):
    return catalog.name_history(repo_daily_activity(spark, sf))


@query
def name_history_wide(spark, sf):
    """Repositories that change their name nearly every day they are active."""
    return catalog.name_history(act.repo_daily_activity(a.wide(spark, sf)))


@query
def org_activity_daily(spark, sf):
    return catalog.org_activity_daily(repo_daily_activity(spark, sf))


@query
def language_trends(spark, sf):
    return catalog.language_trends(_mart(spark, sf), a.repos(spark, sf))


@query
def first_crossing(spark, sf):
    return catalog.first_crossing(_read_mart(spark, sf), CROSSING)


@query
def top_pr_contributors(spark, sf):
    return catalog.top_pr_contributors(a.activity(spark, sf), a.YEAR)


@query
def text_chunks(spark, sf):
    texts = a.table(spark, sf, "documents").select("doc_id", "text")
    return catalog.text_chunks(texts, **CHUNK)
