"""Exact distinct counts that are counted once a day and merged for any range of days.

A dictionary gives each repository name and each account a dense number, new ones the
next free numbers. A day's distinct values of an owner or account are bitmaps over these
numbers, one for each 32,768 of them. Bitmaps of several days are merged by a bitwise or,
so a range reads the days' bitmaps and no raw event of an old day again.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.events import is_pull_request, is_star, opened, owner, top
from ..session import shared_folder

DAY = "day_stamp"
REPOS, STARRERS = "repos", "starrers"
_PLACE_BITS = 33  # of a row within its partition, in Spark's increasing ids


def _written(df: DataFrame, label: str) -> DataFrame:
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_numbers(values: DataFrame, known: DataFrame) -> DataFrame:
    """value, number of the distinct ``value`` s that ``known`` lacks: the next dense numbers.

    Rows are numbered within partitions, and the partitions one after another by their
    sizes, of which there is a row for each partition.
    """
    new = values.select("value").where(F.col("value").isNotNull()).distinct().join(known, "value", "left_anti")
    placed = _written(new.withColumn("place", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("place", _PLACE_BITS)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    joined = placed.withColumn("part", part).join(F.broadcast(starts), "part")
    number = F.lit(first) + F.col("start") + F.col("place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return _written(joined.select("value", number.alias("number")), "numbers")


def with_new_numbers(raw: DataFrame, known: DataFrame) -> DataFrame:
    """The dictionary with all names and accounts of ``raw``; numbers never change."""
    values = raw.select("repo_name").union(raw.select("actor_login")).toDF("value")
    return known.unionByName(new_numbers(values, known))


def _bitmaps(pairs: DataFrame, numbers: DataFrame, kind: str) -> DataFrame:
    """entity, day, kind, bucket, bitmap from distinct rows (entity, day, value)."""
    numbered = pairs.join(numbers, "value")
    bucket, position = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    grouped = numbered.groupBy("entity", DAY, F.lit(kind).alias("kind"), bucket.alias("bucket"))
    return grouped.agg(F.bitmap_construct_agg(position).alias("bitmap"))


def day_stamp() -> Column:
    return F.concat_ws("-", "year", "month", "day")


def daily_bitmaps(raw: DataFrame, numbers: DataFrame, entity: Column, values: dict[str, Column]) -> DataFrame:
    """Bitmaps of the distinct ``values`` (by kind) of each entity and day of ``raw``.

    Values are made distinct before they are numbered, so an entity with a third of all
    events is spread over its values. Null entities and values have no bit.
    """
    found = None
    for kind, value in values.items():
        pairs = raw.select(entity.alias("entity"), day_stamp().alias(DAY), value.alias("value"))
        pairs = pairs.where(F.col("entity").isNotNull() & F.col("value").isNotNull()).distinct()
        own = _bitmaps(pairs, numbers, kind)
        found = own if found is None else found.unionByName(own)
    return found


def daily_totals(raw: DataFrame, entity: Column, counts: list[Column]) -> DataFrame:
    """entity, day and plain counts, which merge by adding."""
    named = raw.withColumns({"entity": entity, DAY: day_stamp()}).where(F.col("entity").isNotNull())
    return named.groupBy("entity", DAY).agg(*counts)


def merged_distincts(bitmaps: DataFrame, year: str, kinds: dict[str, str]) -> DataFrame:
    """entity and a column for each kind: its distinct values over all days of the year."""
    ored = (
        bitmaps.where(F.col(DAY).startswith(f"{year}-"))
        .groupBy("entity", "kind", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    )
    sums = [F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(name) for kind, name in kinds.items()]
    return ored.groupBy("entity").agg(*sums)


def organization_days(raw: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Daily totals and bitmaps that ``organizations_of`` ranks owners by."""
    named = raw.where(F.col("repo_name").isNotNull())
    values = {REPOS: F.col("repo_name"), STARRERS: F.when(is_star(), F.col("actor_login"))}
    return daily_totals(named, owner(), [F.count("*").alias("event_count")]), daily_bitmaps(named, numbers, owner(), values)


def organizations_of(totals: DataFrame, bitmaps: DataFrame, year: str, k: int = 50) -> DataFrame:
    """The rows of ``top_organizations``, from the days of a year that were counted before.

    The top ``k`` owners are chosen by their totals, and only their bitmaps are merged.
    """
    events = totals.where(F.col(DAY).startswith(f"{year}-")).groupBy("entity").agg(F.sum("event_count").alias("event_count"))
    best = top(events, k, F.desc("event_count"), "entity")
    distincts = merged_distincts(
        bitmaps.join(F.broadcast(best.select("entity")), "entity", "left_semi"),
        year, {REPOS: "unique_repos", STARRERS: "unique_starrers"},
    )
    zero = F.lit(0).cast("bigint")
    return best.join(distincts, "entity", "left").select(
        F.col("entity").alias("org_name"), "event_count",
        F.coalesce("unique_repos", zero).alias("unique_repos"), F.coalesce("unique_starrers", zero).alias("unique_starrers"),
    )


def user_days(raw: DataFrame, numbers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Daily totals and bitmaps that ``users_of`` ranks accounts by."""
    counts = [
        F.count_if(is_star()).alias("stars_given"),
        F.count_if(is_pull_request() & opened()).alias("prs_opened"),
        F.count("*").alias("total_events"),
    ]
    actor = F.col("actor_login")
    return daily_totals(raw, actor, counts), daily_bitmaps(raw, numbers, actor, {REPOS: F.col("repo_name")})


def users_of(totals: DataFrame, bitmaps: DataFrame, year: str, min_events: int = 5, k: int = 50) -> DataFrame:
    """The rows of ``active_users``, from the days of a year that were counted before."""
    names = ("stars_given", "prs_opened", "total_events")
    days = totals.where(F.col(DAY).startswith(f"{year}-")).groupBy("entity")
    users = days.agg(*(F.sum(name).alias(name) for name in names)).where(F.col("total_events") >= min_events)
    best = top(users, k, F.desc("total_events"), "entity")
    chosen = bitmaps.join(F.broadcast(best.select("entity")), "entity", "left_semi")
    distincts = merged_distincts(chosen, year, {REPOS: "unique_repos_touched"})
    touched = F.coalesce("unique_repos_touched", F.lit(0).cast("bigint")).alias("unique_repos_touched")
    return best.join(distincts, "entity", "left").select(F.col("entity").alias("actor_login"), *names, touched)
