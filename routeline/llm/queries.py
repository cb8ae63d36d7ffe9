"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routeline.llm import (
    classifier, fingerprint, hardneg, language, mixing, neardup, pieces, rules, secrets, sharding, spelling,
    substrings, urllists,
)
from routeline.llm.common import bucket_of, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare(table(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classify(table(spark, sf_dir, "documents"))


def op3_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "quality_p")


def captures(pages: DataFrame) -> DataFrame:
    """Pages with a fetch day: the table has none, so the id is spread over three years."""
    offset = F.pmod(F.col("page_id") * 7919, F.lit(1096)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit("2021-01-01").cast("date"), offset).alias("day"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated list changes derived from the hosts of the pages themselves, by a hash of the domain.

    One domain in three was blocked at some day; half of these were removed later, a quarter added
    again; one host in seven was on the allow list for a while.
    """
    host = urllists.host_of(F.col("url"))
    labels = F.split(host, r"\.")
    parent = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), 3), ".")
    seen = pages.select(F.explode(F.array_distinct(F.array(host, parent))).alias("domain")).filter(
        "domain is not null").distinct()
    part = lambda salt, modulus: F.pmod(F.conv(F.substring(F.sha2(
        F.concat(F.lit(salt), F.col("domain")), 256), 1, 12), 16, 10).cast("bigint"), F.lit(modulus))
    day = lambda salt, first, days: F.date_add(F.lit(first).cast("date"), part(salt, days).cast("int"))
    change = lambda name, when, action: F.struct(
        F.lit(name).alias("list"), when.alias("day"), F.lit(action).alias("action"))
    blocked, removed, again, allowed = part("p", 3) == 0, part("r", 2) == 0, part("s", 2) == 0, part("w", 7) == 0
    changes = F.array(
        F.when(blocked, change("block", day("a", "2020-10-01", 500), "add")),
        F.when(blocked & removed, change("block", day("b", "2022-03-01", 300), "remove")),
        F.when(blocked & removed & again, change("block", day("c", "2023-01-01", 300), "add")),
        F.when(allowed, change("allow", day("d", "2021-01-01", 400), "add")),
        F.when(allowed, change("allow", day("e", "2022-06-01", 400), "remove")))
    return seen.select("domain", F.explode(F.filter(changes, lambda c: c.isNotNull())).alias("c")).select("domain", "c.*")


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = urllists.evaluate(captures(pages), list_entries(pages), "page_id")
    return found.select(F.col("key").alias("page_id"), "host", F.col("day").cast("string").alias("fetched"),
                        F.col("n_active").cast("bigint").alias("n_active"), "matched", "verdict")


def _sql_part(salt: str, modulus: int) -> str:
    return f"(cast('0x' || substr(sha256('{salt}' || domain), 1, 12) as bigint) % {modulus})"


def _sql_change(name: str, first: str, salt: str, days: int, action: str, where: str) -> str:
    return (f"select '{name}' as list, domain, date '{first}' + cast({_sql_part(salt, days)} as integer) as day, "
            f"'{action}' as action from seen where {where}")


_BLOCKED, _REMOVED, _AGAIN, _ALLOWED = (f"{_sql_part(x, n)} = 0" for x, n in (("p", 3), ("r", 2), ("s", 2), ("w", 7)))
OP4_SQL = f"""
with host as (
  select page_id, date '2021-01-01' + cast(page_id * 7919 % 1096 as integer) as day,
         nullif(regexp_replace(lower(regexp_extract(
           url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\\.$', ''), '') as host
  from pages),
parts as (select *, string_split(host, '.') as labels from host),
seen as (
  select distinct unnest([host, array_to_string(labels[greatest(len(labels) - 2, 1):greatest(len(labels) - 2, 1) + 2], '.')]) as domain
  from parts where host is not null),
changes as (
  {_sql_change("block", "2020-10-01", "a", 500, "add", _BLOCKED)}
  union all {_sql_change("block", "2022-03-01", "b", 300, "remove", f"{_BLOCKED} and {_REMOVED}")}
  union all {_sql_change("block", "2023-01-01", "c", 300, "add", f"{_BLOCKED} and {_REMOVED} and {_AGAIN}")}
  union all {_sql_change("allow", "2021-01-01", "d", 400, "add", _ALLOWED)}
  union all {_sql_change("allow", "2022-06-01", "e", 400, "remove", _ALLOWED)}),
daily as (select list, domain, day, max(action) as action from changes group by all),
stepped as (select *, lag(action, 1, 'remove') over (partition by list, domain order by day) as before from daily),
spans as (
  select list, domain, day as valid_from, lead(day) over (partition by list, domain order by day) as valid_to, action
  from stepped where action <> before),
asked as (
  select page_id, day, unnest(list_transform(range(least(2, len(labels)), len(labels) + 1),
           lambda k: {{'domain': array_to_string(labels[len(labels) - k + 1:], '.'), 'labels': k}})) as s
  from parts where host is not null),
hits as (
  select page_id, i.list, i.domain, s.labels as labels
  from asked join spans i on i.domain = s.domain and i.action = 'add' and day >= valid_from
    and (valid_to is null or day < valid_to)),
best as (
  select page_id, count(distinct (list, domain)) as n_active,
         max_by(list, labels * 2 + (list = 'allow')::int) as list, max_by(domain, labels * 2 + (list = 'allow')::int) as matched
  from hits group by page_id)
select h.page_id, h.host, cast(h.day as varchar) as fetched, coalesce(n_active, 0) as n_active, matched,
       case when list is null then 'unlisted' when list = 'allow' then 'allowed' else 'blocked' end as verdict
from host h left join best using (page_id)
"""


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = bucket_of(F.col("doc_id"), 5) == 0
    model = language.train(docs.filter(~held_out))
    found = language.identify(docs.drop("lang"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("secret_base", lambda s: s.kind == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined(F.col("secret_base")), 256).alias("base_sha256"),
        secrets.joined(F.col("secret_spans")).alias("spans"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP8_SQL = f"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents),
totals as (select source, sum(size) as source_size from sized group by source),
ranked as (
  select *, [5.0, 2.0, 1.0][(row_number() over (order by source is null, encode(source)) - 1) % 3 + 1] as weight from totals),
-- a source is capped if the level reached when all sources of lower ratio are capped still exceeds its cap
ordered as (
  select *, 2.0 * source_size / weight as ratio, 1.5 * sum(source_size) over () as budget,
         coalesce(sum(2.0 * source_size) over (order by 2.0 * source_size / weight, source rows between unbounded preceding and 1 preceding), 0) as below,
         sum(weight) over (order by 2.0 * source_size / weight, source rows between current row and unbounded following) as rest
  from ranked),
level as (select max((budget - below) / rest) filter (where (budget - below) / rest < ratio) as level from ordered),
targets as (
  select source, source_size, case when level is null then 2.0 * source_size else least(2.0 * source_size, weight * level) end as target
  from ordered, level),
drawn as (
  select s.*, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
         cast('0x' || substr(sha256('{mixing.SEED}' || chr(31) || coalesce(cast(doc_id as varchar), chr(30))), 1, 13) as bigint)
           / 4503599627370496.0 as draw
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, cast(target as double) as target,
       cast(size * (floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) as bigint) as taken
from drawn
"""


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    back = docs.withColumn("p", pieces.roundtrip(spark, F.col("text"), F.col("doc_id"))).select("doc_id", "text", "p.*")
    return back.select("doc_id", "piece_ids", F.size("piece_ids").alias("n_pieces"),
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket_of(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", F.col("quality").alias("label"))
    weights = classifier.train(labels, docs)
    score = classifier.scorer(weights, spark)
    return docs.withColumn("score", score("text")).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, in whole 1/256 units, after relabelling every seventh."""
    vec_id = F.col("vec_id")
    whole = F.transform("embedding", lambda x: F.floor(256.0 * x.cast("double")).cast("double"))
    rows = table(spark, sf_dir, "embeddings").filter(hardneg.usable(F.col("embedding"))).select(
        "vec_id", F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        whole.alias("embedding"))
    return hardneg.mine(rows, vec_id % 100 == 0)


OP11_SQL = """
with usable as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id as other, a.label = b.label as alike, list_dot_product(a.v, b.v)::bigint as score
  from usable a join usable b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
positives as (
  select anchor_id, other as positive_id, score as positive_score from scored where alike
  qualify row_number() over (partition by anchor_id order by score desc, other) <= 5)
select anchor_id, positive_id, row_number() over w::integer as rank, other as negative_id, positive_score, score as negative_score
from positives p join scored s using (anchor_id)
where not alike and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other)
qualify row_number() over w <= 10
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with planted deletions."""
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents"), damage=97))


def sql_crc32(data: str) -> str:
    """CRC-32 of a blob in DuckDB, which has no such function; needs the common table ``crc_table(t)``."""
    return (f"xor(list_reduce(list_transform(regexp_extract_all(hex({data}), '..'), lambda b: ('0x' || b)::bigint), "
            f"lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)")


CRC_TABLE = """
crc_steps as (
  select range as n, 0 as step, range::bigint as c from range(256)
  union all
  select n, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end from crc_steps where step < 8),
crc_table as (select list(c order by n) as t from crc_steps where step = 8)"""

OP12_SQL = f"""
with recursive {CRC_TABLE},
runs as (
  select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') as run from documents),
distinct_runs as (
  select run, encode(coalesce(doc_id::varchar, '') || ':' || run) as data, count(*) as n from runs group by all),
hashed as (select run, n, {sql_crc32("data")} as h from distinct_runs, crc_table),
damaged as (
  select n, case when h % 97 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
                 else run end as word from hashed),
words as (
  select word, sum(n)::bigint as n from damaged where length(word) >= 5 group by word having sum(n) >= 3),
cuts as (
  select word, n, unnest(range(1, length(word) + 1)) as spot, substr(word, 1, spot - 1) || substr(word, spot + 1) as rest from words),
near as (
  select a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.spot = b.spot and a.rest = b.rest and a.word <> b.word
  union select c.word, w.word, w.n from cuts c join words w on c.rest = w.word
  union select w.word, c.word, c.n from cuts c join words w on c.rest = w.word),
best as (
  select word, count(*) as n_near, first(near order by near_n desc, encode(near)) as form, max(near_n) as form_n
  from near group by word),
judged as (
  select word, n, coalesce(n_near, 0) as n_near, case when form_n >= 2 * n then form end as form,
         case when form_n >= 2 * n then form_n end as form_n
  from words left join best using (word)),
walk as (
  select word, word as root, form as ahead from judged
  union all
  select walk.word, walk.ahead, judged.form from walk join judged on judged.word = walk.ahead)
select word, n, n_near, form, form_n, root from judged join (select word, root from walk where ahead is null) using (word)
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to eight shards that each match the mixture of sources (law ``rows``)."""
    return sharding.interleave(table(spark, sf_dir, "documents"), carry=["doc_id"])


OP13_SQL = f"""
with recursive {CRC_TABLE},
sized as (
  select doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 as size,
         {sql_crc32("encode(coalesce(text, ''))")} as crc from documents, crc_table),
drawn as (
  select *, cast('0x' || substr(sha256('{mixing.SEED}' || chr(31) || coalesce(doc_id::varchar, chr(30)) || chr(31) || crc), 1, 13)
                 as bigint) / 4503599627370496.0 as draw from sized),
ranked as (
  select *, row_number() over (partition by source order by draw, doc_id, crc, size) - 1 as rank,
         count(*) over (partition by source) as n, count(*) over () as total from drawn),
placed as (
  select *, row_number() over (order by (2 * rank + 1) / (2 * n), source is null, encode(source), rank) - 1 as spot from ranked)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, (spot * 8 // total)::integer as shard,
       (spot - ((spot * 8 // total) * total + 7) // 8)::bigint as slot, null::integer as grown_shard
from placed
"""


LLM_QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_fingerprints, op2_minhash, op3_weak_supervision, op4_url_lists, op5_language, op6_secrets,
    op7_substrings, op8_mixing, op9_pieces, op10_quality, op11_hard_negatives, op12_spelling, op13_sharding)}
LLM_SQL: dict[str, str] = {"op4_url_lists": OP4_SQL, "op8_mixing": OP8_SQL, "op11_hard_negatives": OP11_SQL,
                           "op12_spelling": OP12_SQL, "op13_sharding": OP13_SQL}
