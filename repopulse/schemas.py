"""One declared schema per layer; applied on read, asserted on write.

Everything is nullable: the archives are messy, and the data checks in
``operators.quality`` report missing values instead of failing a read.
"""

from pyspark.sql import types as T


def _struct(columns: str) -> T.StructType:
    fields = [column.strip().split(" ", 1) for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "vector": T.ArrayType(T.FloatType()),
}

# One event with its nested parts projected to columns.
FLAT = _struct(
    "id string, type string, actor_id bigint, actor_login string, repo_id bigint,"
    "repo_name string, created_at string, pr_action string, pr_merged int,"
    "pr_state string, pr_base_ref string, pr_user_login string"
)

# Partition columns of the raw lake, in directory order. They stay strings so
# that zero-padded values ("04") survive partition discovery.
PARTITIONS = ("event_type", "year", "month", "day", "hour")
RAW = T.StructType(FLAT.fields + [T.StructField(name, T.StringType()) for name in PARTITIONS])

# The record of the hours that were ingested.
INGESTED = _struct("hour timestamp")

# The archive files that were ingested one by one.
LEDGER = _struct("hour timestamp, file string, size bigint, commit string")

ACTIVITY = _struct(
    "repo_id bigint, repo_name string, event_date date, stars bigint,"
    "prs_opened bigint, prs_merged bigint, prs_closed_unmerged bigint"
)

MART = T.StructType(
    ACTIVITY.fields + _struct("pr_merge_rate double, stars_7d_rolling bigint").fields
)

# What an incremental refresh of the mart keeps beside it.
COUNTS = _struct(
    "repo_id bigint, event_date date, repo_name string, stars bigint,"
    "prs_opened bigint, prs_merged bigint, prs_closed_unmerged bigint, lake_day string"
)
SEEN = _struct("lake_day string, files bigint, hash bigint")
TOUCHED = _struct("repo_id bigint, event_date date")

# Dense numbers of names and accounts.
NUMBERS = _struct("value string, number bigint")

REPO = _struct("repo_id bigint, full_name string, description string, language string, stars bigint")
INDEX = T.StructType(REPO.fields + _struct("embedding vector").fields)
