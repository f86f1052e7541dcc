"""For every deterministic query, SQL that DuckDB runs on the same tables."""

import string

from .adapters import AS_OF, DAMAGED_BELOW, OTHER_FROM, RENAMED_AT, WIDE_AS_OF, WIDE_YEAR, YEAR
from .queries import (
    CHUNK,
    CROSSING,
    EMERGING,
    FRESH_AS_OF,
    FUTURE_AS_OF,
    HOUR_LEFT_OUT,
    LAST_WEEK,
    PIVOT_NAMES,
    QUERY_TEXT,
    TOP_CANDIDATES,
    VELOCITY_FLOOR,
)

FLAT = """id, type, actor_id, actor_login, repo_id, repo_name, created_at, pr_action,
    pr_merged, pr_state, pr_base_ref, pr_user_login"""

# The tables as activity, independent of the adapters' DataFrame code.
_KEYED = """
keyed as (
  select *, cast(props->>'$.k' as bigint) as k, event_type in ('click', 'view') as star
  from events
)"""
_FIELDS = f"""
fields as (
  select
    cast(event_id as varchar) as id,
    case when star then 'WatchEvent' else 'PullRequestEvent' end as type,
    user_id as actor_id,
    'user' || user_id as actor_login,
    case when k <> 98 then k end as repo_id,
    case when k <> 99 then 'org' || (k % 10) || '/repo' || k
      || case when k % 7 = 0 and ts >= timestamp '{RENAMED_AT}' then '-renamed' else '' end
      end as repo_name,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as created_at,
    case event_type when 'signup' then 'opened' when 'purchase' then 'closed'
      when 'error' then 'closed' else 'started' end as pr_action,
    cast(case event_type when 'purchase' then 1 when 'error' then 0 when 'signup' then 0 end
      as integer) as pr_merged,
    case event_type when 'signup' then 'open' when 'purchase' then 'closed'
      when 'error' then 'closed' end as pr_state,
    case when not star then 'main' end as pr_base_ref,
    case when not star then 'user' || user_id end as pr_user_login,
    ts, value
  from keyed
)"""
_PARTS = """strftime(ts, '%Y') as year, strftime(ts, '%m') as month, strftime(ts, '%d') as day,
    strftime(ts, '%H') as "hour" """
_RAW = f"""
raw as (
  select {FLAT}, type as event_type, {_PARTS},
    date_trunc('second', ts) as created_ts, cast(ts as date) as event_date
  from fields
)"""
ACTIVITY = f"with {_KEYED}, {_FIELDS}, {_RAW}"
_SHIPPED = """
raw as (
  select
    l_orderkey || '-' || l_linenumber as id,
    case when l_linestatus = 'O' then 'WatchEvent' else 'PullRequestEvent' end as event_type,
    'user' || l_suppkey as actor_login,
    l_partkey as repo_id,
    'org' || l_suppkey || '/part' || l_partkey as repo_name,
    case when l_linestatus = 'O' then 'started' when l_returnflag = 'N' then 'opened'
      else 'closed' end as pr_action,
    case when l_linestatus <> 'O' and l_returnflag = 'R' then 1
      when l_linestatus <> 'O' and l_returnflag = 'A' then 0 end as pr_merged,
    cast(l_shipdate as date) as event_date,
    strftime(l_shipdate, '%Y') as year, strftime(l_shipdate, '%m') as month,
    strftime(l_shipdate, '%d') as day
  from lineitem
)"""
WIDE = f"with {_SHIPPED}"

_COUNTS = """
    count(*) filter (where event_type = 'PullRequestEvent' and pr_action = 'opened') as prs_opened,
    count(*) filter (where event_type = 'PullRequestEvent' and pr_merged = 1) as prs_merged,
    count(*) filter (where event_type = 'PullRequestEvent' and pr_action = 'closed'
      and pr_merged = 0) as prs_closed_unmerged"""
_DAILY = f"""
daily_stars as (
  select repo_id, event_date, max(repo_name) as repo_name, count(*) as stars
  from raw where event_type = 'WatchEvent' and repo_id is not null and repo_name is not null
  group by repo_id, event_date
), daily_prs as (
  select repo_id, event_date, max(repo_name) as repo_name, {_COUNTS}
  from raw where event_type = 'PullRequestEvent' and repo_id is not null and repo_name is not null
  group by repo_id, event_date
), activity as (
  select repo_id, coalesce(s.repo_name, p.repo_name) as repo_name, event_date,
    coalesce(stars, 0) as stars, coalesce(prs_opened, 0) as prs_opened,
    coalesce(prs_merged, 0) as prs_merged, coalesce(prs_closed_unmerged, 0) as prs_closed_unmerged
  from daily_stars s full join daily_prs p using (repo_id, event_date)
), mart as (
  select *,
    cast(prs_merged as double) / nullif(prs_merged + prs_closed_unmerged, 0) as pr_merge_rate,
    cast(sum(stars) over (partition by repo_id order by event_date
      rows between 6 preceding and current row) as bigint) as stars_7d_rolling
  from activity
)"""
DAILY, WIDE_DAILY = f"{ACTIVITY}, {_DAILY}", f"{WIDE}, {_DAILY}"

# Lines: damaged ones vanish, some are of a type the lake does not keep.
LINES = f"""with {_KEYED}, {_FIELDS}, parsed as (
  select * replace (case when value >= {OTHER_FROM} then 'PushEvent' else type end as type),
    date_trunc('hour', ts) as archive_hour
  from fields where value >= {DAMAGED_BELOW}
), kept as (select * from parsed where type <> 'PushEvent')"""
# The mart of what the lake holds.
LAKE_DAILY = f"""{LINES}, raw as (
  select {FLAT}, type as event_type, cast(ts as date) as event_date from kept
), {_DAILY}"""
LAKE = f"{LINES} select {FLAT}, type as event_type, {_PARTS} from kept"

REPOS = """
repos as (
  select doc_id as repo_id, source || '/doc' || doc_id as full_name,
    case when toxic = 1 then '' when quality = 1 then text end as description,
    case when lang <> 'es' then lang end as language, n_chars as stars
  from documents join labels using (doc_id)
)"""


def _letters(text: str) -> str:
    lowered = f"lower({text})"
    counts = [
        f"cast(length({lowered}) - length(replace({lowered}, '{letter}', '')) as double)"
        for letter in string.ascii_lowercase
    ]
    return "[" + ", ".join(counts) + "]"


def _cosine(a: str, b: str) -> str:
    return (
        f"list_dot_product({a}, {b}) / (case when list_dot_product({a}, {a}) = 0 then 1 else"
        f" sqrt(list_dot_product({a}, {a})) end * case when list_dot_product({b}, {b}) = 0 then 1"
        f" else sqrt(list_dot_product({b}, {b})) end)"
    )


def _best(scored: str, columns: str, k: int = 10) -> str:
    """The k best rows of ``scored`` per query."""
    return f"""
    select {columns} from (
      select *, row_number() over (partition by query_id order by round(similarity, 12) desc, repo_id) as place
      from {scored})
    where place <= {k}"""


_DOCUMENTS = f"""
indexed as (
  select doc_id as repo_id, source || '/doc' || doc_id as full_name, text as description,
    case when lang <> 'es' then lang end as language, n_chars as stars, {_letters("text")} as v
  from documents
)"""
_VECTORS = """
indexed as (
  select vec_id as repo_id, label, list_transform(embedding, lambda x: cast(x as double)) as v
  from embeddings
), elements as (
  select label, unnest(range(len(v))) as pos, unnest(v) as x from indexed
)"""


def _candidates(name: str, as_of, upper: str = "true") -> str:
    return f"""
{name} as (
  select repo_id, repo_name as full_name, cast(sum(stars) as bigint) as stars from mart
  where event_date >= date '{as_of}' - 30 and {upper}
  group by repo_id, repo_name order by stars desc, repo_id, full_name limit {TOP_CANDIDATES}
)"""


_ENRICHED_COLUMNS = "repo_id, full_name, description, language, stars"


def _enriched(name: str, source: str) -> str:
    return f"""
{name} as (
  select n.repo_id, n.full_name, r.description, r.language, r.stars
  from (
    select repo_id, full_name from {source}
    qualify row_number() over (partition by repo_id order by stars desc, full_name desc) = 1
  ) n join repos r using (repo_id)
)"""


EMBED = f"""{WIDE_DAILY}, {REPOS},
{_candidates("earlier", LAST_WEEK, f"event_date <= date '{LAST_WEEK}'")},
{_candidates("candidates", WIDE_AS_OF)},
{_enriched("indexed", "earlier")},
pending as (select * from candidates where repo_id not in (select repo_id from indexed)),
{_enriched("added", "pending")}"""
_TEXT = "coalesce(nullif(description, ''), full_name)"

LEADERS = f"""{DAILY}, leaders as (
  select repo_name, row_number() over (order by stars desc, repo_name) as place from (
    select repo_name, sum(stars) as stars from mart
    where event_date >= date '{AS_OF}' - 30 group by repo_name)
  qualify place <= 10
), series as (
  select event_date, repo_name, stars, place from mart join leaders using (repo_name)
  where event_date >= date '{AS_OF}' - 30
)"""


def _velocity(source: str, year: str, having: str, order: str) -> str:
    return f"""{source}, by_day as (
  select repo_name, month, day, count(*) as n from raw
  where event_type = 'WatchEvent' and year = '{year}' and repo_name is not null
  group by repo_name, month, day
), summary as (
  select repo_name, cast(sum(n) as bigint) as total_stars, avg(n) as avg_daily_stars,
    max(n) as peak_daily_stars, min(n) as min_daily_stars, count(*) as active_days
  from by_day group by repo_name
) select {{columns}} from summary where {having} order by {order}, repo_name limit 50"""


_VELOCITY_COLUMNS = "repo_name, total_stars, avg_daily_stars, peak_daily_stars, active_days"


def _organizations(source: str, year: str) -> str:
    return f"""{source}
select split_part(repo_name, '/', 1) as org_name, count(*) as event_count,
  count(distinct repo_name) as unique_repos,
  count(distinct case when event_type = 'WatchEvent' then actor_login end) as unique_starrers
from raw where year = '{year}' and repo_name is not null
group by org_name order by event_count desc, org_name limit 50"""


def _users(source: str, year: str) -> str:
    return f"""{source}
select actor_login, count(*) filter (where event_type = 'WatchEvent') as stars_given,
  count(*) filter (where event_type = 'PullRequestEvent' and pr_action = 'opened') as prs_opened,
  count(distinct repo_name) as unique_repos_touched, count(*) as total_events
from raw where year = '{year}' and actor_login is not null
group by actor_login having count(*) >= 5
order by total_events desc, actor_login limit 50"""


def _trending(days: int) -> str:
    return f"""{DAILY} select repo_name, cast(sum(stars) as bigint) as stars from mart
where event_date >= date '{AS_OF}' - {days}
group by repo_name order by stars desc, repo_name limit 50"""


def _check(check: str, column: str, failing: str, source: str) -> str:
    return f"""select '{check}' as "check", '{column}' as "column", n as failing_rows, n = 0 as passed
from (select count(*) as n from {source} where {failing})"""


def _checks(prefix: str, *checks: tuple[str, str, str, str]) -> str:
    return f"{prefix} " + " union all ".join(_check(*check) for check in checks)


def _repeated(source: str, keys: str) -> str:
    return f"(select {keys} from {source} group by {keys} having count(*) > 1)"


_RAW_NULLS = [
    ("not_null", name, f"{name} is null", "raw")
    for name in ("id", "event_type", "repo_id", "created_at")
]
_MART_NULLS = [("not_null", name, f"{name} is null", "mart") for name in ("repo_id", "event_date")]
_TYPES = ("accepted_values", "event_type", "event_type not in ('WatchEvent', 'PullRequestEvent')", "raw")
_MART_RANGES = [
    ("accepted_range", "stars", "stars < 0", "mart"),
    ("accepted_range", "pr_merge_rate", "pr_merge_rate < 0 or pr_merge_rate > 1", "mart"),
]
_MART_KEY = (
    "unique_combination", "repo_id,event_date", "true", _repeated("mart", "repo_id, event_date")
)
_DOCUMENT_TEXTS = """(
  select doc_id, coalesce(nullif(text, ''), source || '/doc' || doc_id) as text from documents)"""
_BY_DIMENSION = "unnest(range(len(v))) as dim, round(unnest(v), 6) as value"
_INT_DIMENSION = "cast(dim as integer) as dim, value"
_STEP = CHUNK["size"] - CHUNK["overlap"]

def _history(source: str) -> str:
    return f"""{source}, islands as (
  select *, sum(changed) over (partition by repo_id order by event_date) as name_no from (
    select repo_id, event_date, repo_name, case when repo_name is distinct from
      lag(repo_name) over (partition by repo_id order by event_date) then 1 else 0 end as changed
    from activity)
), spans as (
  select repo_id, repo_name, min(event_date) as valid_from, max(event_date) as last_seen,
    count(*) as active_days from islands group by repo_id, name_no, repo_name
) select repo_id, repo_name, valid_from, last_seen, active_days,
  cast(lead(valid_from) over (partition by repo_id order by valid_from) - 1 as date) as valid_to from spans"""


ORACLE: dict[str, str] = {
    "resolve_hour": f"""with {_KEYED}, {_FIELDS}
select distinct date_trunc('hour', ts) as archive_hour,
  strftime(ts, '%Y-%m-%d-') || hour(ts) || '.json.gz' as file from fields""",
    "ingest_parse": f"{LINES} select id, type, archive_hour from parsed",
    "ingest_filter_types": f"{LINES} select id, type, archive_hour from kept",
    "ingest_flatten": f"{LINES} select {FLAT}, archive_hour from kept",
    "ingest_counts": f"""{LINES}
select 'total' as event_type, count(*) as n from parsed
union all select 'WatchEvent', count(*) from kept where type = 'WatchEvent'
union all select 'PullRequestEvent', count(*) from kept where type = 'PullRequestEvent'""",
    "lake_write": LAKE,
    "lake_skip_existing": LAKE,
    "lake_read": f"""{LINES} select type as event_type, strftime(ts, '%m') as month,
  strftime(ts, '%d') as day, count(*) as events from kept
where type = 'WatchEvent' group by all""",
    "backfill_range": LAKE,
    "stream_ingest": LAKE,
    "stg_watch_events": f"""{ACTIVITY}
select id as event_id, actor_id, actor_login, repo_id, repo_name, created_ts as created_at, event_date
from raw where event_type = 'WatchEvent' and repo_name is not null""",
    "stg_pull_request_events": f"""{ACTIVITY}
select id as event_id, actor_id, actor_login, repo_id, repo_name, pr_action, pr_merged, pr_state,
  pr_base_ref, pr_user_login, created_ts as created_at, event_date
from raw where event_type = 'PullRequestEvent' and repo_name is not null""",
    "daily_stars": f"{DAILY} select * from daily_stars",
    "daily_prs": f"{DAILY} select * from daily_prs",
    "repo_daily_activity": f"{DAILY} select * from activity",
    "repo_daily_activity_joined": f"{DAILY} select * from activity",
    "repo_trends_daily": f"{DAILY} select * from mart",
    "repo_trends_daily_wide": f"{WIDE_DAILY} select * from mart",
    "mart_write": f"{DAILY} select * from mart",
    "stream_append": LAKE,
    "stream_distinct": f"{LINES} select {FLAT} from kept",
    "repo_trends_daily_calendar": f"""{WIDE_DAILY} select *,
  cast(sum(stars) over (partition by repo_id order by event_date
    range between interval 6 days preceding and current row) as bigint) as stars_7d_calendar from mart""",
    "mart_refresh": f"{LAKE_DAILY} select * from mart",
    "mart_audit": f"""{DAILY}, broken as (
  select repo_id, event_date, stars from mart
  union all select repo_id, event_date, -1 - stars from mart where event_date = date '{AS_OF}'
), rows as (select count(*) as mart_rows from mart)
select 'accepted_range' as "check", 'stars' as "column", count(*) as failing_rows, false as passed,
  any_value(mart_rows) as mart_rows from broken, rows where stars < 0
union all select 'unique_combination', 'repo_id,event_date', count(*), false, any_value(mart_rows) from (
  select repo_id, event_date from broken group by all having count(*) > 1), rows""",
    "top_organizations_merged": _organizations(ACTIVITY, YEAR),
    "active_users_merged": _users(ACTIVITY, YEAR),
    "semantic_search_cells": """select count(*) as queries,
  cast(count(*) * least(10, (select count(*) from documents where text is not null)) as bigint) as wanted,
  true as recall_reached from benchmark""",
    "top_starred_repos": f"""{ACTIVITY} select repo_name, count(*) as stars from raw
where event_type = 'WatchEvent' and year = '{YEAR}' and repo_name is not null
group by repo_name order by stars desc, repo_name limit 50""",
    "star_velocity": _velocity(
        ACTIVITY, YEAR, f"total_stars >= {VELOCITY_FLOOR}", "avg_daily_stars desc"
    ).format(columns=_VELOCITY_COLUMNS),
    "star_velocity_wide": _velocity(
        WIDE, WIDE_YEAR, "total_stars >= 1", "avg_daily_stars desc"
    ).format(columns=_VELOCITY_COLUMNS),
    "pr_merge_rate": f"""{ACTIVITY}, counted as (
  select repo_name, {_COUNTS} from raw
  where event_type = 'PullRequestEvent' and year = '{YEAR}' and repo_name is not null
  group by repo_name
) select *, cast(prs_merged as double) / (prs_merged + prs_closed_unmerged) as merge_rate
from counted where prs_merged + prs_closed_unmerged >= 5
order by merge_rate desc nulls last, repo_name limit 50""",
    "top_organizations": _organizations(ACTIVITY, YEAR),
    "top_organizations_wide": _organizations(WIDE, WIDE_YEAR),
    "active_users": _users(ACTIVITY, YEAR),
    "active_users_wide": _users(WIDE, WIDE_YEAR),
    "hourly_stars": f"""{ACTIVITY} select "hour" as utc_hour, count(*) as stars from raw
where event_type = 'WatchEvent' and year = '{YEAR}' group by utc_hour order by utc_hour""",
    "emerging_repos": _velocity(
        ACTIVITY, YEAR,
        f"peak_daily_stars >= {EMERGING['peak']} and min_daily_stars < {EMERGING['quiet']}"
        f" and active_days >= {EMERGING['min_days']}",
        "peak_daily_stars - min_daily_stars desc",
    ).format(columns=f"{_VELOCITY_COLUMNS}, min_daily_stars"),
    "trending_window": _trending(30),
    "trending_window_week": _trending(7),
    "trending_window_today": _trending(30),
    "trend_series": f"{LEADERS} select event_date, repo_name, stars from series order by 1, 2",
    "trend_pivot": f"{LEADERS} select event_date, "
    + ", ".join(
        f"cast(coalesce(sum(stars) filter (where place = {n}), 0) as bigint) as rank_{n}"
        for n in range(1, 11)
    )
    + " from series group by event_date order by event_date",
    "trend_pivot_names": f"{DAILY} select event_date, "
    + ", ".join(
        f"cast(coalesce(sum(stars) filter (where repo_name = '{name}'), 0) as bigint) as \"{name}\""
        for name in PIVOT_NAMES
    )
    + f""" from mart where event_date >= date '{AS_OF}' - 30 and repo_name in (
  select repo_name from mart where event_date >= date '{AS_OF}' - 30
  group by repo_name order by sum(stars) desc, repo_name limit 100)
group by event_date""",
    "embed_candidates": f"{EMBED} select * from candidates",
    "embed_pending": f"{EMBED} select * from pending",
    "repo_enrich": f"{EMBED} select {_ENRICHED_COLUMNS} from added",
    "embed_text": f"{EMBED} select repo_id, full_name, {_TEXT} as text from added",
    "encode": f"""with encoded as (
  select doc_id as repo_id, {_letters("text")} as v from {_DOCUMENT_TEXTS}
) select repo_id, {_INT_DIMENSION} from (select repo_id, {_BY_DIMENSION} from encoded)""",
    "encode_hashing": f"""with words as (
  select doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_]+')) as word from {_DOCUMENT_TEXTS}
), counted as (
  select doc_id, cast(('0x' || substr(md5(word), 1, 8)) as bigint) % 384 as dim, count(*) as n
  from words group by 1, 2
), weights as (
  select dim, ln(((select count(*) from documents) + 1) / (count(*) + 1.0)) as weight from counted group by dim
), weighted as (
  select doc_id, dim, n * weight as x from counted join weights using (dim)
), scaled as (
  select *, sqrt(sum(x * x) over (partition by doc_id)) as norm from weighted
) select doc_id as repo_id, cast(dim as integer) as dim,
  round(cast(cast(x / norm as real) as double), 6) as value
from scaled where norm > 0 and round(cast(cast(x / norm as real) as double), 6) <> 0""",
    "encode_model": f"""with encoded as (
  select doc_id as repo_id, [length(text), len(string_split_regex(trim(text, e' \\n\\t\\r'), '[\\s]+')),
    length(text) - length(replace(text, chr(10), '')) + 1] as v from {_DOCUMENT_TEXTS}
) select repo_id, {_INT_DIMENSION} from (
  select repo_id, unnest(range(len(v))) as dim, cast(unnest(v) as double) as value from encoded)""",
    "index_append": f"""{EMBED} select {_ENRICHED_COLUMNS} from indexed
union all select {_ENRICHED_COLUMNS} from added""",
    "index_write": f"""{EMBED}, encoded as (
  select repo_id, full_name, {_letters("text")} as v from (
    select repo_id, full_name, {_TEXT} as text from indexed
    union all select repo_id, full_name, {_TEXT} from added)
) select repo_id, full_name, {_INT_DIMENSION} from (select repo_id, full_name, {_BY_DIMENSION} from encoded)""",
    "index_read": f"""with {_DOCUMENTS}
select repo_id, full_name, language, stars, cast(len(v) as integer) as dims from indexed""",
    "l2_normalize": f"""with {_VECTORS}, scaled as (
  select repo_id, v, case when list_dot_product(v, v) = 0 then 1 else sqrt(list_dot_product(v, v)) end as n
  from indexed
) select repo_id, {_INT_DIMENSION} from (
  select repo_id, unnest(range(len(v))) as dim, round(unnest(v) / n, 6) as value from scaled)""",
    "semantic_search": f"""with {_DOCUMENTS}, asked as (select {_letters(f"'{QUERY_TEXT}'")} as q),
scored as (select *, 0 as query_id, {_cosine("v", "q")} as similarity from indexed, asked)
{_best("scored", "repo_id, full_name, description, language, stars, round(similarity, 6) as similarity")}""",
    "semantic_search_vectors": f"""with {_VECTORS}, asked as (
  select list(x order by pos) as q from (select pos, avg(x) as x from elements group by pos)
), scored as (select *, 0 as query_id, {_cosine("v", "q")} as similarity from indexed, asked)
{_best("scored", "repo_id, label, round(similarity, 6) as similarity")}""",
    "semantic_search_batch": f"""with {_DOCUMENTS},
asked as (select item_id as query_id, {_letters("text")} as q from benchmark),
scored as (
  select query_id, repo_id, full_name, language, stars, {_cosine("v", "q")} as similarity
  from indexed, asked
) {_best("scored", '''query_id, cast(place as integer) as rank, repo_id, full_name, language, stars,
  round(similarity, 6) as similarity''')}""",
    "semantic_search_centroids": f"""with {_VECTORS}, asked as (
  select label as query_id, list(x order by pos) as q
  from (select label, pos, avg(x) as x from elements group by label, pos) group by label
), scored as (select indexed.*, query_id, {_cosine("v", "q")} as similarity from indexed, asked)
{_best("scored", '''query_id, cast(place as integer) as rank, repo_id, label,
  round(similarity, 6) as similarity''')}""",
    "search_display": f"""with {_DOCUMENTS}, asked as (select {_letters(f"'{QUERY_TEXT}'")} as q),
scored as (select *, 0 as query_id, {_cosine("v", "q")} as similarity from indexed, asked)
{_best("scored", '''full_name, coalesce(nullif(language, ''), 'Unknown') as language,
  coalesce(stars, 0) as stars, round(similarity, 3) as similarity,
  coalesce(nullif(description, ''), '_no description_') as description''')}""",
    "dq_not_null": _checks(
        DAILY, *_RAW_NULLS, ("not_null", "repo_name", "repo_name is null", "raw"), *_MART_NULLS
    ),
    "dq_accepted_values": _checks(
        ACTIVITY, _TYPES, ("accepted_values", "pr_action", "pr_action not in ('opened', 'closed')", "raw")
    ),
    "dq_accepted_range": _checks(
        DAILY,
        *_MART_RANGES,
        ("accepted_range", "stars_7d_rolling", "stars_7d_rolling < 2 or stars_7d_rolling > 10", "mart"),
    ),
    "dq_unique_combination": _checks(
        DAILY,
        _MART_KEY,
        ("unique_combination", "repo_id,actor_id", "true", _repeated("raw", "repo_id, actor_id")),
    ),
    "dq_no_future_dates": f"""{DAILY} select event_date, count(*) as bad_rows from mart
where event_date > date '{FUTURE_AS_OF}' group by event_date""",
    "dq_reconcile": f"""{DAILY}, direct as (
  select count(*) filter (where event_type = 'WatchEvent') as stars, {_COUNTS}
  from raw where repo_id is not null and repo_name is not null
), modelled as (
  select cast(sum(stars) as bigint) as stars, cast(sum(prs_opened) as bigint) as prs_opened,
    cast(sum(prs_merged) as bigint) as prs_merged,
    cast(sum(prs_closed_unmerged) as bigint) as prs_closed_unmerged
  from mart
), sides as ("""
    + " union all ".join(
        f"select '{m}' as metric, d.{m} as raw_total, m.{m} as mart_total from direct d, modelled m"
        for m in ("stars", "prs_opened", "prs_merged", "prs_closed_unmerged")
    )
    + """), gaps as (
  select *, abs(raw_total - mart_total) / cast(greatest(raw_total, 1) as double) as relative_difference
  from sides
) select *, relative_difference <= 0.001 as passed from gaps""",
    "dq_raw_checks": _checks(ACTIVITY, *_RAW_NULLS, _TYPES),
    "dq_mart_checks": _checks(
        DAILY,
        *_MART_NULLS,
        *_MART_RANGES,
        ("no_future_dates", "event_date", f"event_date > date '{FUTURE_AS_OF}'", "mart"),
        _MART_KEY,
    ),
    "dq_freshness": f"""{ACTIVITY}, newest as (
  select event_type, max(created_ts) as newest from raw group by event_type
), aged as (
  select t.event_type, newest, date_diff('second', newest, timestamp '{FRESH_AS_OF}') / 3600.0 as age
  from (values ('WatchEvent'), ('PullRequestEvent')) t(event_type) left join newest using (event_type)
) select event_type, newest, round(cast(age as double), 6) as age_hours,
  case when age > 6 or age is null then 'error' when age > 3 then 'warn' else 'pass' end as status from aged""",
    "dq_missing_hours": f"""{LINES}, expected as (
  select t.event_type, h."hour" from (values ('WatchEvent'), ('PullRequestEvent')) t(event_type),
    (select unnest(generate_series(timestamp '2023-12-31 18:00:00', timestamp '2024-01-30 23:00:00',
      interval 1 hour)) as "hour") h
) select event_type, e."hour" from expected e where not exists (
  select 1 from kept r where r.type = e.event_type and r.archive_hour = e."hour"
    and not (r.type = 'WatchEvent' and strftime(r.ts, '%m-%d-%H') = '{HOUR_LEFT_OUT}'))""",
    "dim_repos": f"""{DAILY} select repo_id, max_by(repo_name, event_date) as repo_name,
  min(event_date) as first_active_date, max(event_date) as last_active_date,
  count(*) as active_days, cast(sum(stars) as bigint) as total_stars,
  cast(sum(a.prs_opened) as bigint) as prs_opened, cast(sum(a.prs_merged) as bigint) as prs_merged,
  cast(sum(a.prs_closed_unmerged) as bigint) as prs_closed_unmerged,
  cast(sum(a.prs_merged) as double)
    / nullif(sum(a.prs_merged) + sum(a.prs_closed_unmerged), 0) as pr_merge_rate
from activity a group by repo_id""",
    "name_history": _history(DAILY),
    "name_history_wide": _history(WIDE_DAILY),
    "org_activity_daily": f"""{DAILY} select split_part(repo_name, '/', 1) as org_name, event_date,
  cast(sum(stars) as bigint) as stars, cast(sum(prs_opened) as bigint) as prs_opened,
  cast(sum(prs_merged) as bigint) as prs_merged,
  cast(sum(prs_closed_unmerged) as bigint) as prs_closed_unmerged,
  count(distinct repo_id) as active_repos
from activity group by 1, 2""",
    "language_trends": f"""{DAILY}, {REPOS}
select coalesce(nullif(r.language, ''), 'Unknown') as language, event_date,
  cast(sum(m.stars) as bigint) as stars
from mart m left join repos r on m.repo_id = r.repo_id group by 1, 2""",
    "first_crossing": f"""{DAILY} select repo_id, min(event_date) as first_date from mart
where stars >= {CROSSING} group by repo_id""",
    "top_pr_contributors": f"""{ACTIVITY} select actor_login, count(*) as pr_events from raw
where year = '{YEAR}' and event_type = 'PullRequestEvent' and actor_login is not null
group by actor_login order by pr_events desc, actor_login limit 50""",
    "text_chunks": f"""with starts as (
  select doc_id, text, unnest(range(0, greatest(length(text) - {CHUNK["overlap"]}, 1), {_STEP})) as p
  from documents where length(text) > 0
) select doc_id, cast(p // {_STEP} as integer) as chunk_no,
  substring(text, p + 1, {CHUNK["size"]}) as text from starts""",
}
