"""One query for each operator, over whole tables and with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import packing, token_codec, token_counts
from shelfwise.llm.decontamination import contaminated
from shelfwise.llm.jaccard_join import jaccard_components
from shelfwise.llm.license_scan import scan_licenses
from shelfwise.llm.packing import pack_documents
from shelfwise.llm.periodic_runs import periodic_runs, run_digests, with_looped_tails
from shelfwise.llm.quality_crf import quality_scores
from shelfwise.llm.quality_rules import judged_documents
from shelfwise.llm.shipping import ship
from shelfwise.llm.source_divergence import divergence_audit
from shelfwise.llm.staging import new_path
from shelfwise.llm.substring_dedup import remove_repeated_windows
from shelfwise.llm.token_codec import coded_documents
from shelfwise.llm.token_counts import cleaned_token_counts
from shelfwise.llm.topk_search import top_inner_products
from shelfwise.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name."""

    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = remove_repeated_windows(table(spark, folder, "documents"), cut_text=False)
    return kept.select("doc_id", "n_words", "n_removed", "kept_sha256")


ORACLE["op6_substring_dedup"] = r"""
with docs as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, row_number() over (partition by md5(array_to_string(w[i + 1 : i + 20], ' ')) order by doc_id, i) as time
  from docs, unnest(range(len(w) - 19)) as u(i)
), gone as (
  select distinct doc_id, i + k as place from windows, unnest(range(20)) as v(k) where time > 1
), words as (
  select doc_id, place, w[place + 1] as word from docs, unnest(range(len(w))) as u(place)
), kept as (
  select doc_id, string_agg(word, ' ' order by place) as text, count(*) as n from words anti join gone using (doc_id, place) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from docs left join kept using (doc_id)
"""


@query
def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"))


#: Words in lower case and distinct five-word shingles of documents; a shorter text is one.
SHINGLES = r"""
docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as shingle
  from docs, unnest(range(case when len(w) = 0 then 0 else greatest(len(w) - 4, 1) end)) as u(i)
)"""

ORACLE["op3_jaccard_join"] = f"""
with recursive {SHINGLES}, sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as common from shingles a join shingles b using (shingle)
  where a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 80 * (x.n + y.n - common)
), reach as (
  select doc_id as a, doc_id as b from docs union select reach.a, links.b from reach join links on links.a = reach.b
), components as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select doc_id, coalesce(n, 0) as n_shingles, component_id from components left join sizes using (doc_id)
"""


@query
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


ORACLE["op4_decontamination"] = r"""
with docs as (
  select row_number() over () as uid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), items as (
  select row_number() over () as iid, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from benchmark where item_id is not null
), doc_shingles as (
  select uid, i, array_to_string(w[i + 1 : i + 5], ' ') as shingle, strlen(array_to_string(w[i + 1 : i + 5], '')) as weight
  from docs, unnest(range(len(w) - 4)) as u(i)
), item_shingles as (
  select distinct iid, len(w) as n, array_to_string(w[i + 1 : i + 5], ' ') as shingle, strlen(array_to_string(w[i + 1 : i + 5], '')) as weight
  from items, unnest(range(len(w) - 4)) as u(i)
), totals as (
  select iid, any_value(n) as n, sum(weight) as total, max(weight) as most from item_shingles group by iid
), hits as (
  select uid, iid, i from doc_shingles join item_shingles using (shingle)
), starts as (
  select distinct uid, iid, i + 5 - n + k as start from hits join totals using (iid), unnest(range(n - 4)) as v(k)
), stretches as (
  select distinct s.uid, s.iid, s.start, d.shingle, d.weight
  from starts s join totals t using (iid) join doc_shingles d on d.uid = s.uid and d.i >= s.start and d.i <= s.start + t.n - 5
), weighed as (
  select s.uid, s.iid, s.start, sum(s.weight) as found, sum(case when i.shingle is not null then s.weight else 0 end) as common
  from stretches s left join item_shingles i on i.iid = s.iid and i.shingle = s.shingle group by all
), scored as (
  select uid, iid, greatest(start, 0) as place, cast(common as double) / cast(total + found - common as double) as similarity
  from weighed join totals using (iid)
), best as (
  select doc_id, item_id, similarity, place, row_number() over (partition by doc_id, item_id order by similarity desc, place) as choice
  from scored join docs using (uid) join items using (iid) where similarity >= 0.8
)
select doc_id, item_id, similarity, cast(place as bigint) as first_word from best where choice = 1
"""


@query
def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path(packing.TOKENIZER), added_tokens=True)


@query
def op2_quality_crf(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op5_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return top_inner_products(rows, rows.where("vec_id % 50 = 0"))


ORACLE["op5_topk_search"] = """
with v as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as q
  from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), pairs as (
  select a.vec_id as query_id, b.vec_id,
    cast(list_sum([p[1] * p[2] for p in list_zip(a.q, b.q)]) as bigint) as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query
def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents"))


ORACLE["op7_license_scan"] = r"""
with templates(template, label, base, w) as (
  select template, label, base, string_split(phrase, ' ') from (values
    (0, 'cc-by', true, 'cc by'),
    (1, 'gpl', true, 'general public license'),
    (2, 'reserved', true, 'all rights reserved'),
    (3, 'mit', false, 'released under the mit license'),
    (4, 'mit', false, 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
    (5, 'apache-2.0', false, 'licensed under the apache license version 2 0'),
    (6, 'bsd', false, 'redistribution and use in source and binary forms with or without modification are permitted'),
    (7, 'gpl-3.0', false, 'this work is licensed under the gnu general public license version 3'),
    (8, 'lgpl', false, 'licensed under the gnu lesser general public license'),
    (9, 'mpl-2.0', false, 'subject to the terms of the mozilla public license v 2 0'),
    (10, 'cc-by-nc-4.0', false, 'licensed under cc by nc 4 0'),
    (11, 'cc-by-sa-4.0', false, 'licensed under cc by sa 4 0'),
    (12, 'cc-by-4.0', false, 'this work is licensed under a creative commons attribution 4 0 international license')
  ) as t(template, label, base, phrase)
), template_pairs as (
  select template, label, base, len(w) - 1 as n_pairs, i as step, w[i + 1] as a, w[i + 2] as b
  from templates, unnest(range(len(w) - 1)) as u(i)
), docs as (
  select row_number() over () as uid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), hits as (
  select uid, template, label, base, n_pairs, step, i as place, i - step as diagonal
  from docs, unnest(range(len(w) - 1)) as u(i), template_pairs
  where w[i + 1] = a and w[i + 2] = b
), marked as (
  select *, place - lag(place) over along > 4 or abs(diagonal - lag(diagonal) over along) > 2 as apart
  from hits window along as (partition by uid, template order by place, step)
), spans as (
  select *, case when base then diagonal else
    sum(case when coalesce(apart, true) then 1 else 0 end) over (partition by uid, template order by place, step rows unbounded preceding) end as span
  from marked
), judged as (
  select uid, template, label, base, span, min(diagonal) as first, count(distinct step) / cast(n_pairs as double) as cover
  from spans group by uid, template, label, base, n_pairs, span
), kept as (
  select * from judged where case when base then cover = 1 else cover >= 0.8 end
), labelled as (
  select uid, count(*) filter (base) as n_base, cast(min(first) filter (base) as bigint) as first_word,
    cast(max(first) filter (base) as bigint) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels,
    string_agg(distinct label, ',' order by label) as labels, max(cover) as score
  from kept group by uid
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from docs left join labelled using (uid)
"""


@query
def op8_token_codec(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    return coded_documents(table(spark, folder, "documents"), path, public_tokenizers.path(token_codec.TOKENIZER), added_tokens=True)


@query
def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_token_counts(table(spark, folder, "documents"), public_tokenizers.path(token_counts.TOKENIZER), added_tokens=True)


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence_audit(table(spark, folder, "documents"))


ORACLE["op11_source_divergence"] = r"""
with docs as (
  select row_number() over () as uid, coalesce(lang, '') as lang, coalesce(source, '') as source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
), found as (
  select uid, lang, source, unnest(w) as term from docs
), kept as (
  select lang, term, count(*) as total from found group by lang, term having count(distinct uid) >= 3
), sizes as (
  select lang, count(*) as v, sum(total) as total from kept group by lang
), groups as (
  select distinct lang, source from docs
), counts as (
  select lang, source, term, count(*) as c from found join kept using (lang, term) group by lang, source, term
), totals as (
  select lang, source, sum(c) as n from counts group by lang, source
), shares as (
  select g.lang, g.source, k.term, coalesce(c, 0) as c,
    1 + (cast(1000000000 as hugeint) * (coalesce(c, 0) + 1)) // (coalesce(n, 0) + v) as p,
    1 + (cast(1000000000 as hugeint) * (k.total + 1)) // (sizes.total + v) as q
  from groups g join kept k using (lang) join sizes using (lang)
  left join totals using (lang, source) left join counts using (lang, source, term)
), pair_sums as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), pairs as (
  select a.lang, a.source, b.source as item, coalesce(value, 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join pair_sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
), items as (
  select lang, source, 'pair' as part, item, value from pairs
  union all select lang, source, 'term', term, ((p - q) * (p - q)) // q from shares where c > 0 and p > q
), ranked as (
  select lang, source, part, item, cast(value as bigint) as value,
    cast(row_number() over (partition by lang, source, part order by value desc, item) as integer) as rank
  from items
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 200
"""


@query
def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return run_digests(periodic_runs(with_looped_tails(table(spark, folder, "documents"))))


@query
def op12_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judged_documents(table(spark, folder, "documents"))


ORACLE["op12_quality_rules"] = r"""
with docs as (
  select row_number() over () as uid, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as lines
  from documents
), windows as (
  select uid, i, count(*) over (partition by uid, w[i + 1 : i + 8]) as times
  from docs, unnest(range(greatest(len(w) - 7, 0))) as u(i)
), again as (
  select uid, least(8, coalesce(lead(i) over (partition by uid order by i) - i, 8)) as own from windows where times > 1
), repeats as (
  select uid, sum(own) as n_repeat_words from again group by uid
), measured as (
  select doc_id, t, w, lines, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) as capitals, length(regexp_replace(t, '[^a-z]', '', 'g')) as small,
    length(t) - length(replace(t, '!', '')) as exclamations,
    len([x for x in w if not regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) as without_letters,
    len([x for x in lines if regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')]) as cut_lines
  from docs left join repeats using (uid)
), judged as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from measured
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 25 * n_words
    or 10 * n_dup_lines > 4 * len(lines) or 10 * capitals > 3 * (capitals + small) or 10 * exclamations > n_words
    or 10 * without_letters > 2 * n_words or 10 * cut_lines > 3 * len(lines)) as kept
from judged
"""
