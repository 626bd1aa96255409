"""The queries of this subpackage over the driver tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guestbook.llm import (
    chat,
    classifier,
    decontamination,
    extraction,
    interactions,
    jaccard,
    linespread,
    mixing,
    outliers,
    privacy,
    search,
    secrets,
    suffixes,
)
from guestbook.llm.common import open_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_table(spark, sf_dir, "documents")
    return outliers.verdicts(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "distance",
        "kept",
    )


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.overlaps(open_table(spark, sf_dir, "documents"), open_table(spark, sf_dir, "benchmark"))
    return decontamination.contaminated(found).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


SQL["op4_winnowing"] = r"""
with doc as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
item as (
  select coalesce(cast(item_id as varchar), 'null') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
item_window as (
  select distinct item, least(13, len(w)) as n, w[i : i + least(13, len(w)) - 1] as run
  from item, unnest(range(1, len(w) - least(13, len(w)) + 2)) as t(i)
  where len(w) > 0),
doc_window as (
  select rid, i, n, w[i : i + n - 1] as run
  from doc, (select distinct n from item_window), unnest(range(1, len(w) - n + 2)) as t(i)),
hit as (select rid, i, n, item from doc_window join item_window using (n, run)),
spans as (
  select rid, count(distinct p) as n_hit
  from (select distinct rid, i, n from hit), unnest(range(i, i + n)) as t(p) group by rid),
items as (
  select rid, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct rid, item from hit) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join spans using (rid) left join items using (rid)
"""


@query
def op5_linespread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return linespread.without_boilerplate(docs).select(
        "doc_id",
        F.col("__lines").cast("long").alias("n_lines"),
        F.col("__removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


SQL["op5_linespread"] = r"""
with doc as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents),
line as (
  select rid, doc_id, source, i, string_split(text, chr(10))[i] as raw,
         regexp_replace(string_split(text, chr(10))[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as line
  from doc, unnest(range(1, len(string_split(text, chr(10))) + 1)) as t(i)),
spread as (
  select line, min(doc_id) as first from line where line <> ''
  group by line having count(distinct source) >= 5),
marked as (
  select l.*, s.line is not null and l.doc_id is distinct from s.first as gone from line l left join spread s on l.line = s.line)
select doc_id, count(*) filter (where line <> '') as n_lines, count(*) filter (where gone) as n_removed,
       sha256(coalesce(string_agg(raw, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by rid, doc_id
"""


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = open_table(spark, sf_dir, "documents")
    return mixing.taken(docs).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        "taken",
        "passes",
        "extra",
        F.array_join("shards", ",").alias("shards"),
    )


@query
def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar(open_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


SQL["op8_jaccard"] = r"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w from documents),
shingle as (
  select distinct doc_id, w[i : i + least(5, len(w)) - 1] as s
  from doc, unnest(range(1, len(w) - least(5, len(w)) + 2)) as t(i) where len(w) > 0),
size as (select doc_id, count(*) as n from shingle group by doc_id),
link as (
  select a.doc_id as a, b.doc_id as b
  from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id
  join size x on x.doc_id = a.doc_id join size y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach as (
  select doc_id as a, doc_id as b from doc
  union select r.a, l.b from reach r join link l on r.b = l.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from (select a as doc_id, min(b) as component_id from reach group by a) left join size using (doc_id)
"""


@query
def op1_fourier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classifier.classify(open_table(spark, sf_dir, "documents"), open_table(spark, sf_dir, "labels"))
    return found.select(
        F.col("id").alias("doc_id"), "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rendered(open_table(spark, sf_dir, "conversations"))


SQL["op7_chat"] = r"""
with turn as (
  select distinct conv_id, coalesce(turn, -9223372036854775808) as turn, role, text from conversations),
line as (
  select *, md5(turn || ':' || coalesce('r' || role, '') || ':' || coalesce('t' || text, '')) as h from turn),
chain as (
  select conv_id, turn, role, text, string_agg(h, '') over (partition by conv_id order by turn, role nulls first, text nulls first) as so_far,
         row_number() over (partition by conv_id order by turn, role nulls first, text nulls first) as i,
         row_number() over (partition by conv_id order by turn desc, role desc nulls last, text desc nulls last) as back
  from line),
whole as (select conv_id, so_far from chain where back = 1),
kept as (
  select min(conv_id) as conv_id from whole
  where so_far not in (select so_far from chain where back > 1) group by so_far)
select c.conv_id, cast((i - 1) // 256 as bigint) as part, nullif(min(turn), -9223372036854775808) as first_turn, count(*) as n_turns,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                  order by i) as text
from chain c join kept k on c.conv_id is not distinct from k.conv_id group by c.conv_id, (i - 1) // 256
"""


@query
def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extraction.extract(open_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op6_privacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = privacy.personal_data(open_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in privacy.KINDS]
    base = F.sha2(privacy.listed("base"), 256).alias("base_sha256")
    return found.select(F.col("id").alias("doc_id"), *counts, base, privacy.listed("spans").alias("spans"))


@query
def op3_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.deduplicated(open_table(spark, sf_dir, "documents"))
    spans = (F.size("cuts") / 2).cast("long").alias("n_spans")
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", spans, "kept_sha256")


@query
def op11_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.audit(open_table(spark, sf_dir, "documents"), open_table(spark, sf_dir, "labels")).drop("filter")


SQL["op11_interactions"] = r"""
with recursive doc as (
  select row_number() over () as rid, doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
label as (
  select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
fails as (
  select rid, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
         (case when len(w) < 100 then 'A' else '' end)
         || (case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end)
         || (case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) then 'C' else '' end)
         || (case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end)
         || (case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end) as failed
  from doc left join label using (doc_id)),
orders as (
  select '' as o union all
  select o || f from orders, unnest(['A', 'B', 'C', 'D', 'E']) as t(f) where not contains(o, f)),
step as (
  select o as filter_order, cast(i as int) as step, o[i : i] as filter, o[1 : i - 1] as earlier
  from orders, unnest(range(1, 6)) as t(i) where length(o) = 5),
profile as (select part, failed, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from fails group by 1, 2),
met as (
  select part, filter_order, step, filter, n, good, toxic, failed = filter as alone, contains(failed, filter) as here,
         len(list_intersect(string_split(failed, ''), string_split(earlier, ''))) > 0 and earlier <> '' and failed <> '' as gone
  from profile, step),
counted as (
  select part, filter_order, step, filter,
         coalesce(sum(n) filter (where not gone and not here), 0) as kept, coalesce(sum(n) filter (where here and not gone), 0) as removed,
         coalesce(sum(n) filter (where here and gone), 0) as redundant, coalesce(sum(n) filter (where alone), 0) as unique_fails,
         coalesce(sum(good) filter (where here and not gone), 0) as good_lost,
         coalesce(sum(toxic) filter (where here and not gone), 0) as toxic_lost
  from met group by 1, 2, 3, 4)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
       cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, filter) as bigint) as shapley
from counted
"""


@query
def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.ranked(open_table(spark, sf_dir, "benchmark"), open_table(spark, sf_dir, "documents"))
    return found.select("item_id", "rank", F.col("id").alias("doc_id"), "score")


SQL["op12_search"] = r"""
with doc as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from documents),
item as (
  select row_number() over () as iid, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t
  from benchmark),
total as (select count(*) as docs, sum(len(t)) as terms from doc where len(t) > 0),
wanted as (select iid, item_id, term, count(*) as times from item, unnest(t) as u(term) group by 1, 2, 3),
held as (
  select rid, doc_id, len(t) as n, term, count(*) as tf from doc, unnest(t) as u(term)
  where term in (select term from wanted) group by 1, 2, 3, 4),
known as (select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w from held, total group by term, docs),
scored as (
  select iid, item_id, rid, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // cast(terms as bigint))))) as score
  from wanted join known using (term) join held using (term), total group by 1, 2, 3, 4),
placed as (select *, row_number() over (partition by iid order by score desc, doc_id nulls last) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, cast(score as bigint) as score from placed where rank <= 10
"""


@query
def op13_grammars(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(open_table(spark, sf_dir, "documents"))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in secrets.KINDS]
    base = F.sha2(secrets.listed("base"), 256).alias("base_sha256")
    return found.select(F.col("id").alias("doc_id"), *counts, base, secrets.listed("spans").alias("spans"))
