"""One query per operator over its whole table: (spark, folder of tables) -> DataFrame."""

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import alignment, minhash, ngram_join, packing, pitman_yor, preferences, quality, resampling, rules, sentencepieces, tokens, topk, urls
from .common import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def query(function: Query) -> Query:
    @wraps(function)
    def shipped(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return function(spark, sf)

    QUERIES[function.__name__] = shipped
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(folds: int) -> Column:
    """Remainder of the checksum of ``doc_id`` as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds, F.lit(0))


@query
def op1_token_counts(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return tokens.count_tokens(docs, PIECES).drop("text")


@query
def op2_packing(spark, sf):
    return packing.pack(_table(spark, sf, "documents"), WORDS, with_ids=False)


@query
def op3_exact_top_k(spark, sf):
    return topk.top_k(_table(spark, sf, "embeddings"))


ORACLE["op3_exact_top_k"] = """
with usable as (
  select vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as v
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0
), scored as (
  select q.vec_id as query_id, r.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) as bigint) as score
  from usable q join usable r on q.vec_id <> r.vec_id and len(q.v) = len(r.v)
  where q.vec_id % 20 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""


@query
def op4_quality_rules(spark, sf):
    judged = rules.judge_quality(_table(spark, sf, "documents"), PIECES, carry=["doc_id"])
    return judged.select("doc_id", *rules.BASE, "base_failed", "kept", *rules.FERTILITY)


@query
def op6_ngram_jaccard_join(spark, sf):
    return ngram_join.jaccard_components(_table(spark, sf, "documents"))


def _components_sql(width: int, part: int) -> str:
    """CTEs up to ``named`` (doc_id, n_shingles, component_id), by joining sets on their shingles."""
    return rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then cast([] as varchar[])
    when len(w) < {width} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {width - 2}), lambda i: array_to_string(w[i : i + {width - 1}], ' '))
    end) as s
  from words
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select c.a, c.b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b
  where 100 * c.n >= {part} * (x.n + y.n - c.n)
), edges as (
  select a, b from links union all select b, a from links
), reached as (
  select doc_id as node, doc_id as root from documents
  union
  select e.b, r.root from reached r join edges e on e.a = r.node
), named as (
  select d.doc_id, coalesce(any_value(x.n), 0) as n_shingles, min(r.root) as component_id
  from documents d left join sizes x using (doc_id) join reached r on r.node = d.doc_id group by d.doc_id
)"""


ORACLE["op6_ngram_jaccard_join"] = f"{_components_sql(3, 90)} select * from named"


@query
def op7_sentencepiece(spark, sf):
    return sentencepieces.verify(_table(spark, sf, "documents"), PIECES)


#: Verdict, host, start of the path.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


@query
def op8_url_filter(spark, sf):
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return urls.judge_urls(pages, URL_RULES).drop("url")


ORACLE["op8_url_filter"] = r"""
with parts as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages
), cut as (
  select page_id,
         translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
  from parts
), judged as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from cut
)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end as verdict
from judged
"""


@query
def op9_quality_classifier(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    labels = _table(spark, sf, "labels").where(fold(3) != 1)
    scored = quality.classify(docs, labels)
    return scored.select("doc_id", (fold(3) == 1).alias("held_out"), "score", "predicted")


@query
def op10_lm_scoring(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    return pitman_yor.score_documents(docs, fold(10) != 0)


def _last_reply_replaced(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chosen and rejected turns of each conversation.

    Both end with the last reply of the assistant, or with the conversation if there is
    none. In the rejected one that reply says what the one before said, or nothing.
    """
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    reply = F.col("role") == preferences.ASSISTANT
    turns = turns.withColumns(
        {
            "last": F.max(F.when(reply, F.col("turn"))).over(whole),
            "earlier": F.last(F.when(reply, F.col("text")), ignorenulls=True).over(before),
        }
    ).where("last is null or turn <= last")
    replaced = F.when(F.col("turn") == F.col("last"), F.coalesce("earlier", F.lit(""))).otherwise(F.col("text"))
    return turns, turns.withColumn("text", replaced)


def _spans(name: str) -> Column:
    as_text = F.transform(name, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return F.array_join(as_text, ",")


@query
def op5_preference_formatting(spark, sf):
    turns = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    pairs = preferences.format_preferences(*_last_reply_replaced(turns), pair_id="conv_id")
    return pairs.withColumns(
        {"chosen_spans": _spans("chosen_spans"), "rejected_spans": _spans("rejected_spans")}
    ).withColumnRenamed("pair_id", "conv_id")


ORACLE["op5_preference_formatting"] = r"""
with marked as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         max(case when role = 'assistant' then turn end) over (partition by conv_id) as last,
         last_value(case when role = 'assistant' then text end ignore nulls) over (
           partition by conv_id order by turn rows between unbounded preceding and 1 preceding) as earlier
  from conversations where conv_id is not null
), sides as (
  select *, text as other, row_number() over (partition by conv_id order by turn) as i
  from marked where last is null or turn <= last
), replaced as (
  select conv_id, i, role, text, case when turn = last then coalesce(earlier, '') else text end as other from sides
), prefix as (
  select conv_id, count(*) as n,
         cast(coalesce(min(case when text <> other then i end) - 1, count(*)) as integer) as n_prompt_turns
  from replaced group by conv_id
), rendered as (
  select r.conv_id, i, n, n_prompt_turns, role,
         '<|' || role || '|>' || chr(10) as head, text, other, '<|end|>' || chr(10) as tail
  from replaced r join prefix p on r.conv_id = p.conv_id
), placed as (
  select *, i > n_prompt_turns as after,
         sum(case when i > n_prompt_turns then length(head || text || tail) else 0 end)
           over (partition by conv_id order by i) as stop_c,
         sum(case when i > n_prompt_turns then length(head || other || tail) else 0 end)
           over (partition by conv_id order by i) as stop_r
  from rendered
)
select conv_id, n_prompt_turns,
       cast(max(n) - n_prompt_turns as integer) as n_chosen_turns,
       cast(max(n) - n_prompt_turns as integer) as n_rejected_turns,
       coalesce(string_agg(head || text || tail, '' order by i) filter (where not after), '') as prompt,
       coalesce(string_agg(head || text || tail, '' order by i) filter (where after), '') as chosen,
       coalesce(string_agg(head || other || tail, '' order by i) filter (where after), '') as rejected,
       coalesce(string_agg((stop_c - length(text || tail)) || '-' || stop_c, ',' order by i)
         filter (where after and role = 'assistant'), '') as chosen_spans,
       coalesce(string_agg((stop_r - length(other || tail)) || '-' || stop_r, ',' order by i)
         filter (where after and role = 'assistant'), '') as rejected_spans
from placed group by conv_id, n_prompt_turns
"""


@query
def op11_cross_tokenizer_alignment(spark, sf):
    return alignment.align_documents(_table(spark, sf, "documents"), BYTES, PIECES)


@query
def op12_minhash_near_dedup(spark, sf):
    return minhash.near_duplicates(_table(spark, sf, "documents"))


ORACLE["op12_minhash_near_dedup"] = f"{_components_sql(4, 80)} select *, doc_id = component_id as kept from named"


@query
def op13_importance_resampling(spark, sf):
    return resampling.importance(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
