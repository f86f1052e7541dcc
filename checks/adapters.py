"""The given tables seen as code-hosting activity. Every adapter covers whole tables.

``activity``   events: stars and pull requests of 100 repositories over 30 days
``lines``      the same events as JSON lines, some damaged, some of other types
``archives``   those lines as hourly gzip files
``redelivered`` the same, with some lines delivered again
``wide``       lineitem: many repositories over seven years, several names each
``repos``      documents that have a label: the repository dimension
``documents``  all documents as an index still to be encoded
"""

import re
from datetime import date, datetime, timezone
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.functions.events import PULL_REQUEST, STAR, zero_padded
from repopulse.operators.embedding import letters26
from repopulse.plans.ingest import flat_rows
from repopulse.plans.trends import trends as mart_of
from repopulse.schemas import RAW, REPO
from repopulse.session import shared_folder
from repopulse.sources.archive import archive_name, read_lines
from repopulse.sources.index import write_index
from repopulse.sources.lake import write_lake
from repopulse.sources.mart import write_mart
from repopulse.sources.tables import file_system

AS_OF = date(2024, 1, 30)
FIRST_HOUR, LAST_HOUR = datetime(2024, 1, 1, 0), datetime(2024, 1, 30, 23)
END = datetime(2024, 1, 31, 0)
YEAR = "2024"
WIDE_AS_OF = date(2001, 11, 4)
WIDE_YEAR = "2000"
RENAMED_AT = "2024-01-16 12:00:00"
# Lines of events below this value are cut in half; from the second value on they
# carry a type that the lake does not keep.
DAMAGED_BELOW, OTHER_FROM = 1.0, 150.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _clock(ts: Column) -> Column:
    return F.concat(
        ts.cast("date").cast("string"), F.lit("T"), F.substring(ts.cast("string"), 12, 8), F.lit("Z")
    )


def _hour_start(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.hour(ts))


def _activity_columns(events: DataFrame) -> DataFrame:
    ts, kind = F.col("ts"), F.col("kind")
    star = kind.isin("click", "view")
    k_text = F.col("k")
    k = k_text.cast("bigint")
    renamed = (k % 7 == 0) & (ts >= F.lit(RENAMED_AT).cast("timestamp_ntz"))
    name = F.concat(F.lit("org"), (k % 10).cast("string"), F.lit("/repo"), k_text)
    login = F.concat(F.lit("user"), F.col("user_id").cast("string"))
    action = F.when(kind == "signup", "opened").when(kind.isin("purchase", "error"), "closed")
    merged = F.when(kind == "purchase", 1).when(kind.isin("error", "signup"), 0)
    columns = {
        "id": F.col("event_id").cast("string"),
        "type": F.when(star, STAR).otherwise(PULL_REQUEST),
        "actor_id": F.col("user_id"),
        "actor_login": login,
        "repo_id": F.when(k != 98, k),
        "repo_name": F.when(k != 99, F.when(renamed, F.concat(name, F.lit("-renamed"))).otherwise(name)),
        "created_at": _clock(ts),
        "pr_action": action.otherwise("started"),
        "pr_merged": merged,
        "pr_state": F.when(kind == "signup", "open").when(~star, "closed"),
        "pr_base_ref": F.when(~star, "main"),
        "pr_user_login": F.when(~star, login),
    }
    return events.select(
        *[column.alias(name) for name, column in columns.items()], "ts", "value"
    )


def _events(events: DataFrame) -> DataFrame:
    events = events.withColumnRenamed("event_type", "kind")
    # A generator, so that the text is parsed once per row and not once per use of k.
    return _activity_columns(events.select("*", F.json_tuple("props", "k").alias("k")))


def _partitioned(flat: DataFrame, ts: Column) -> DataFrame:
    return flat.withColumns(
        {
            "event_type": F.col("type"),
            "year": zero_padded(F.year(ts), 4),
            "month": zero_padded(F.month(ts)),
            "day": zero_padded(F.day(ts)),
            "hour": zero_padded(F.hour(ts)),
        }
    ).to(RAW)


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _partitioned(_events(table(spark, sf_dir, "events")), F.col("ts"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, archive_hour."""
    return _lines_of(table(spark, sf_dir, "events"))


def _lines_of(rows: DataFrame) -> DataFrame:
    events = _events(rows)
    pull_request = F.struct(
        (F.col("pr_merged") == 1).alias("merged"),
        F.col("pr_state").alias("state"),
        F.struct(F.col("pr_base_ref").alias("ref")).alias("base"),
        F.struct(F.col("pr_user_login").alias("login")).alias("user"),
    )
    nested = F.struct(
        "id",
        F.when(F.col("value") >= OTHER_FROM, "PushEvent").otherwise(F.col("type")).alias("type"),
        "created_at",
        F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias("actor"),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.struct(
            F.col("pr_action").alias("action"),
            F.when(F.col("type") == PULL_REQUEST, pull_request).alias("pull_request"),
        ).alias("payload"),
    )
    text = F.to_json(nested)
    half = F.substring(text, F.lit(1), (F.length(text) / 2).cast("int"))
    value = F.when(F.col("value") < DAMAGED_BELOW, half).otherwise(text)
    return events.select(value.alias("value"), _hour_start(F.col("ts")).alias("archive_hour"))


def archived_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_lines(spark, archives(spark, sf_dir))


@cache
def written_lake(spark: SparkSession, sf_dir: str) -> str:
    """Path of a lake that holds all archives; written once per session."""
    path = shared_folder(spark, "lake")
    write_lake(flat_rows(archived_lines(spark, sf_dir)), path)
    return path


@cache
def written_mart(spark: SparkSession, sf_dir: str) -> str:
    """Path of the mart of ``activity``; written once per session."""
    path = shared_folder(spark, "mart")
    write_mart(mart_of(activity(spark, sf_dir)), path)
    return path


@cache
def written_wide_mart(spark: SparkSession, sf_dir: str) -> str:
    """Path of the mart of ``wide``; written once per session.

    It has few rows for each of 2,500 dates, so it is not partitioned by date, and its rows
    stay in the tasks that computed them: ordering them would shuffle the mart once more.
    """
    path = shared_folder(spark, "wide-mart")
    mart_of(wide(spark, sf_dir)).write.parquet(path)
    return path


@cache
def written_index(spark: SparkSession, sf_dir: str) -> str:
    """Path of an index of all documents; written once per session."""
    path = shared_folder(spark, "index")
    write_index(document_index(spark, sf_dir), path)
    return path


@cache
def written_vectors(spark: SparkSession, sf_dir: str) -> str:
    """Path of the table of vectors as an index; written once per session."""
    path = shared_folder(spark, "vectors")
    vector_index(spark, sf_dir).write.parquet(path)
    return path


@cache
def archives(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one sub-folder of gzip JSON lines per hour; written once per session."""
    folder = shared_folder(spark, "archives")
    spread_lines(spark, sf_dir).write.option("compression", "gzip").partitionBy("archive").text(folder)
    return folder


def spread_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, archive: by range, so that a busy hour is spread over several tasks and files.

    The ranges are of the rows and not of their lines, which are longer and would be made
    once more to find them.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    spread = table(spark, sf_dir, "events").repartitionByRange(tasks, _hour_start(F.col("ts")), "event_id")
    return _lines_of(spread).select("value", archive_name(F.col("archive_hour")).alias("archive"))


@cache
def redelivered(spark: SparkSession, sf_dir: str) -> str:
    """The archives once more, a file for each hour in the order of their hours, where some
    lines come again in the next hour's archive, others three days later."""
    folder, once = shared_folder(spark, "redelivered"), lines(spark, sf_dir)
    mark = F.crc32(F.col("value").cast("binary"))

    def again(every: int, hours: int) -> DataFrame:
        later = F.col("archive_hour") + F.make_dt_interval(hours=F.lit(hours))
        return once.where(mark % every == 0).withColumn("archive_hour", later)

    delivered = once.union(again(7, 1)).union(again(31, 72))
    named = delivered.select("value", archive_name(F.col("archive_hour")).alias("archive"))
    named.repartition("archive").write.option("compression", "gzip").partitionBy("archive").text(folder)
    # Streams take files by their time of modification, which stands for that of arrival.
    files, place = file_system(spark, folder)
    found = files.listFiles(place, True)
    while found.hasNext():
        file = found.next().getPath()
        hour = re.search(r"archive=(\d+-\d+-\d+-\d+)\.", file.toString())
        if hour:
            arrived = datetime.strptime(hour[1], "%Y-%m-%d-%H").replace(tzinfo=timezone.utc)
            files.setTimes(file, int(arrived.timestamp() * 1000), -1)
    return folder


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate").cast("date")
    star = F.col("l_linestatus") == "O"
    flag = F.col("l_returnflag")
    supplier, part = (F.col(name).cast("string") for name in ("l_suppkey", "l_partkey"))
    login = F.concat(F.lit("user"), supplier)
    outcome = F.when(flag == "R", 1).when(flag == "A", 0)
    flat = items.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("id"),
        F.when(star, STAR).otherwise(PULL_REQUEST).alias("type"),
        F.col("l_suppkey").alias("actor_id"),
        login.alias("actor_login"),
        F.col("l_partkey").alias("repo_id"),
        F.concat(F.lit("org"), supplier, F.lit("/part"), part).alias("repo_name"),
        F.concat(day.cast("string"), F.lit("T00:00:00Z")).alias("created_at"),
        F.when(star, "started").when(flag == "N", "opened").otherwise("closed").alias("pr_action"),
        F.when(~star, outcome).alias("pr_merged"),
        F.when(~star, F.when(flag == "N", "open").otherwise("closed")).alias("pr_state"),
        F.when(~star, "main").alias("pr_base_ref"),
        F.when(~star, login).alias("pr_user_login"),
        day.cast("timestamp_ntz").alias("ts"),
    )
    return _partitioned(flat, F.col("ts"))


def _as_repos(documents: DataFrame, description: Column) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("repo_id"),
        F.concat_ws("/", "source", F.concat(F.lit("doc"), F.col("doc_id").cast("string"))).alias("full_name"),
        description.alias("description"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("language"),
        F.col("n_chars").alias("stars"),
    ).to(REPO)


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents have an empty description, poor ones none; Spanish ones no language."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    description = F.when(F.col("toxic") == 1, "").when(F.col("quality") == 1, F.col("text"))
    return _as_repos(labelled, description)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_repos(table(spark, sf_dir, "documents"), F.col("text"))


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = documents(spark, sf_dir).withColumn("text", F.col("description"))
    return letters26(texts).drop("text")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, embedding: every benchmark text as a query."""
    items = table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "query_id")
    return letters26(items).select("query_id", "embedding")


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "repo_id")


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, embedding: the mean vector of every label."""
    elements = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding"))
    means = elements.groupBy("label", "pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    # One entry per dimension and label, so each list has the vector's length.
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda element: element["mean"]).alias("embedding")
    )


def mean_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    elements = table(spark, sf_dir, "embeddings").select(F.posexplode("embedding"))
    means = elements.groupBy("pos").agg(F.avg(F.col("col").cast("double")).alias("mean"))
    return [row.mean for row in means.orderBy("pos").collect()]


def by_dimension(df: DataFrame, *keys: str) -> DataFrame:
    """One row per vector element: keys, dim, value."""
    return df.select(*keys, F.posexplode("embedding").alias("dim", "value")).withColumn(
        "value", F.round(F.col("value").cast("double"), 6)
    )
