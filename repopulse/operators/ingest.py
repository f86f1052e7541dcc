"""Archive lines to flat events.

Lines become variants, because a reader with a declared schema drops lines whose
fields have unexpected types, while here only text that is not JSON is skipped.
The bare numbers NaN and Infinity count as JSON, as lenient parsers have it; no
column reads a number that may be one, so they become null.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.events import CREATED_AT_FORMAT, KEPT_TYPES

# Where each flat column sits in the nested event.
_PATHS = {
    "id": ("$.id", "string"),
    "type": ("$.type", "string"),
    "actor_id": ("$.actor.id", "bigint"),
    "actor_login": ("$.actor.login", "string"),
    "repo_id": ("$.repo.id", "bigint"),
    "repo_name": ("$.repo.name", "string"),
    "created_at": ("$.created_at", "string"),
    "pr_action": ("$.payload.action", "string"),
    "pr_merged": ("$.payload.pull_request.merged", "boolean"),
    "pr_state": ("$.payload.pull_request.state", "string"),
    "pr_base_ref": ("$.payload.pull_request.base.ref", "string"),
    "pr_user_login": ("$.payload.pull_request.user.login", "string"),
}


# A bare word where a value belongs.
_NOT_FINITE = r"(?<=[:\[,])\s*-?(?:NaN|Infinity)\s*(?=[,}\]])"


def parsed_line(value: str = "value") -> Column:
    """The line as a variant, NULL if it isn't JSON.

    Lines that fail are tried once more without NaN and Infinity.
    """
    tolerant = F.when(
        F.col(value).contains("NaN") | F.col(value).contains("Infinity"),
        F.try_parse_json(F.regexp_replace(value, _NOT_FINITE, "null")),
    )
    return F.coalesce(F.try_parse_json(value), tolerant)


def _field(path: str, kind: str) -> Column:
    return F.try_variant_get("event", path, kind)


def _is_type(types: tuple[str, ...]) -> Column:
    return _field("$.type", "string").isin(*types)


def parse_events(lines: DataFrame) -> DataFrame:
    """event (variant), archive_hour; lines that are not JSON vanish."""
    # A filter on the parsed value would be merged with the parse below it and run it
    # twice per line. Generating zero or one row per line parses once.
    parsed = F.array_compact(F.array(parsed_line()))
    return lines.select(F.explode(parsed).alias("event"), "archive_hour")


def keep_types(events: DataFrame, types: tuple[str, ...] = KEPT_TYPES) -> DataFrame:
    return events.where(_is_type(types))


def kept_events(lines: DataFrame, types: tuple[str, ...] = KEPT_TYPES) -> DataFrame:
    """``keep_types(parse_events(lines), types)``, parsing only lines that may qualify, once.

    About one archive line in a hundred is of a kept type. A line can only be if it
    contains the type's name, or a ``\\u00`` escape that might spell a letter of it,
    so all others are dropped by a text search, which is far cheaper than a parse.
    """
    value = F.col("value")
    candidate = value.contains("\\u00")
    for name in types:
        candidate = candidate | value.contains(name)
    # Generated, as in parse_events; lines that are not JSON have no type and go with the others.
    parsed = F.explode(F.array(parsed_line()))
    return keep_types(lines.where(candidate).select(parsed.alias("event"), "archive_hour"), types)


def flatten_events(events: DataFrame) -> DataFrame:
    """The 12 flat columns plus archive_hour; a missing parent gives NULL.

    ``pr_merged`` becomes 0/1 here, so that every file stores the same type even if
    it holds no pull request. ``pr_action`` is filled for every type.
    """
    columns = [
        (_field(path, kind).cast("int") if kind == "boolean" else _field(path, kind)).alias(name)
        for name, (path, kind) in _PATHS.items()
    ]
    return events.select(*columns, "archive_hour")


def report_counts(types: tuple[str, ...] = KEPT_TYPES) -> dict[str, Column]:
    """Aggregates over parsed lines (``event`` NULL where not JSON): total, then each type."""
    counts = {"total": F.count("event")}
    counts.update({name: F.count_if(_is_type((name,))) for name in types})
    return counts


def ingest_report(lines: DataFrame, types: tuple[str, ...] = KEPT_TYPES) -> DataFrame:
    """event_type, n: all JSON lines as ``total``, and each kept type even if zero."""
    counts = report_counts(types)
    # Not via parse_events: its filter would make Catalyst parse every line twice.
    events = lines.select(parsed_line().alias("event"))
    totals = events.agg(*[count.alias(name) for name, count in counts.items()])
    return totals.unpivot([], list(counts), "event_type", "n")


def drop_repeated(events: DataFrame) -> DataFrame:
    """One row per event id and hour. Opt-in: the lake keeps repeated deliveries by default.

    Within the hour, because an hour is what the lake replaces as a whole; rows without
    an id are all kept.
    """
    known = events.where(F.col("id").isNotNull()).dropDuplicates(["id", "archive_hour"])
    return known.unionByName(events.where(F.col("id").isNull()))


def distinct_events(events: DataFrame, delay: str) -> DataFrame:
    """One row per event id of a stream, whatever archives delivered it.

    ``created_at`` is the event's time; where it can't be read, the archive's hour is.
    Ids are remembered until the watermark, ``delay`` behind the newest event, has passed
    their event. Rows without an id are all kept.
    """
    spoken = F.try_to_timestamp("created_at", F.lit(CREATED_AT_FORMAT))
    columns = {
        "_at": F.coalesce(spoken, F.col("archive_hour").cast("timestamp")),
        "_key": F.coalesce("id", F.concat(F.lit("none "), F.uuid())),
    }
    return events.withColumns(columns).withWatermark("_at", delay).dropDuplicatesWithinWatermark(["_key"]).drop(*columns)
