"""The registered queries of the text operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mdmspark.llm import bpe, decontamination, hard_negatives, langid, line_cleaning, ns_bounds, packing, pii, ppm, sharding, simhash, url_rules, warc
from mdmspark.llm.common import read_table

N_SHARDS = 40


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _remainder(n: int):
    """crc32 of doc_id as text, modulo n, is 1 (false for a null doc_id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % n == 1, F.lit(False))


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("text_md5"))
    out = sharding.minimax_shards(rows, "size", F.col("text_md5"), "doc_id", N_SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(read_table(spark, sf, "documents"), tokenizer_path())


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf, "documents"))
    return found.select("doc_id", simhash.fingerprint_text(F.col("fp")).alias("fingerprint"), "component_id")


def op4_ppm(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    scored = ppm.score_documents(docs, docs.where(~_remainder(5)))
    return scored.select("doc_id", _remainder(5).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_line_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    judged = line_cleaning.clean_lines(read_table(spark, sf, "documents"))
    rest = [c for c in judged.columns if c not in ("kept", "n_bad_lines", "n_lost_words")]
    return judged.select(*rest, "kept", "n_bad_lines", "n_lost_words")


def op6_url_rules(spark: SparkSession, sf: str) -> DataFrame:
    labels = read_table(spark, sf, "labels").select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return url_rules.judge_urls(read_table(spark, sf, "pages"), labels)


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contaminated(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


# Captures of every page, the same text in both engines: a full response; a
# revisit with a (weak, sometimes other) entity tag, sometimes before or at the
# time of the response; a changed response or a revisit by date; and a revisit
# of a url with a tracking parameter, sometimes without a validator.
_NL = "chr(10)"
CAPTURES = f"""
select page_id * 4 as record_id, url, 1700000000 + page_id * 37 % 100000 as ts, 200 as status,
  'Content-Type: text/html' || {_NL} || 'ETag: "' || md5(html) || '"' || {_NL} || 'Last-Modified: day ' || cast(page_id % 97 as varchar(20))
    || {_NL} || 'Cache-Control: max-age=60' as headers, md5(html) as digest
from pages
union all
select page_id * 4 + 1, url || '#again',
  1700000000 + page_id * 37 % 100000 + case when page_id % 11 = 0 then -3600 when page_id % 13 = 0 then 0 else 3600 end, 304,
  'ETag: W/"' || case when page_id % 5 = 0 then 'other' else md5(html) end || '"' || {_NL} || 'Date: day 2' || {_NL} || 'Set-Cookie: a=b'
    || {_NL} || 'Cache-Control: max-age=600', null
from pages
union all
select page_id * 4 + 2, url, 1700000000 + page_id * 37 % 100000 + 7200, case when page_id % 3 = 0 then 200 else 304 end,
  case when page_id % 3 = 0 then 'Content-Type: text/html' || {_NL} || 'ETag: "' || md5(html || 'x') || '"'
    else 'Last-Modified: day ' || cast(page_id % 97 as varchar(20)) || {_NL} || 'Expires: day 9' end,
  case when page_id % 3 = 0 then md5(html || 'x') end
from pages
union all
select page_id * 4 + 3,
  regexp_replace(url, '#.*', '') || case when url like '%?%' then '&' else '?' end || 'utm_campaign=x',
  1700000000 + page_id * 37 % 100000 + 10800, 304,
  case when page_id % 7 = 0 then 'Date: day 3' else 'Vary: Accept' || {_NL} || 'ETag: "' || md5(html) || '"' end, null
from pages
"""


def captures(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(CAPTURES.replace("from pages", "from {pages}"), pages=read_table(spark, sf, "pages").select("page_id", "url", "html"))


def op8_revisits(spark: SparkSession, sf: str) -> DataFrame:
    return warc.resolve_revisits(captures(spark, sf))


def op9_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf, "documents"))

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.BASE]
    base = F.filter("found", lambda s: s["kind"].isin(*pii.BASE))
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))


def op10_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    model = langid.fit(docs.where(~_remainder(3)))
    return langid.identify(docs, model).select("doc_id", _remainder(3).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(read_table(spark, sf, "documents"), ranks, pattern), ranks, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf, "embeddings").withColumn("label", label)
    mined = hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_ns_bounds(spark: SparkSession, sf: str) -> DataFrame:
    found = ns_bounds.cluster(read_table(spark, sf, "embeddings"))
    text = F.array_join(F.transform("centroid", lambda c: c.cast("string")), ",")
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(text, 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_packing, op3_simhash, op4_ppm, op5_line_cleaning, op6_url_rules, op7_decontamination, op8_revisits, op9_pii, op10_langid,
                                   op11_bpe, op12_hard_negatives, op13_ns_bounds)}


# --------------------------------------------------------------------------
# DuckDB
# --------------------------------------------------------------------------

_SPACE = r"[\x09-\x0D\x20]"
_SYMBOLS = "[" + line_cleaning.SYMBOLS + "]"
_UNSPACED = "[" + "".join(f"\\p{{{s}}}" for s in line_cleaning.UNSPACED) + "]"
_RULES = line_cleaning.Rules()


def _any(texts, column: str) -> str:
    return "(" + " or ".join(f"contains({column}, '{t}')" for t in texts) + ")"


_LINE_CLEANING = f"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '{_SPACE}+'), lambda x: x <> '') as w
  from documents),
lines as (
  select rid, line, list_filter(string_split_regex(line, '{_SPACE}+'), lambda x: x <> '') as w
  from (select rid, unnest(string_split(t, chr(10))) as line from d)),
judged as (
  select rid, line, len(w) as n,
    100 * (length(line) - length(regexp_replace(line, '{_SYMBOLS}', '', 'g'))) > {_RULES.max_symbols} * length(regexp_replace(line, '{_SPACE}', '', 'g'))
    or not regexp_matches(line, '[\\pL\\pN]')
    or (shouts >= 3 and 100 * shouts >= {_RULES.min_shouts} * len(w))
    or (marks >= 2 and 100 * marks >= {_RULES.min_separators} * len(w))
    or (len(w) + (length(line) - length(regexp_replace(line, '{_UNSPACED}', '', 'g'))) // {_RULES.unspaced_letters} < {_RULES.stub_words} and not contains({"'" + line_cleaning.TERMINAL.replace("'", "''") + "'"}, right(w[-1], 1)))
    or (len(w) <= {_RULES.boilerplate_words} and {_any(line_cleaning.BOILERPLATE, "translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) as bad
  from (select *, (length(line) - length(replace(line, '!!', ''))) // 2 as shouts,
      len(list_filter(w, lambda x: x in ({", ".join(f"'{s}'" for s in line_cleaning.SEPARATORS)}))) as marks
    from lines where len(w) > 0)),
by_line as (
  select rid, count(*) - count(distinct line) as dup, count(*) filter (where bad) as n_bad, coalesce(sum(n) filter (where bad), 0) as lost
  from judged group by rid),
windows as (
  select rid, i, array_to_string(w[i:i + 4], ' ') as five
  from (select rid, w, unnest(generate_series(1, len(w) - 4)) as i from d)),
repeated as (
  select rid, count(distinct i + k) as n
  from (select rid, i, count(*) over (partition by rid, five) as times from windows), unnest(generate_series(0, 4)) as g(k)
  where times > 1 group by rid),
m as (
  select d.doc_id, len(w) as n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) as word_chars,
    length(t) - length(regexp_replace(t, '{_SYMBOLS}', '', 'g')) as n_symbols,
    coalesce(dup, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words, coalesce(n_bad, 0) as n_bad_lines, cast(coalesce(lost, 0) as bigint) as n_lost_words
  from d left join by_line using (rid) left join repeated r using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {_RULES.min_words} or 100 * n_repeat_words > {_RULES.max_repeat} * n_words as base_failed, n_bad_lines, n_lost_words,
  not (n_words < {_RULES.min_words} or 100 * n_repeat_words > {_RULES.max_repeat} * n_words) and 100 * n_lost_words <= {_RULES.max_loss} * n_words as kept
from m
"""


def _fixed_sql() -> str:
    ranked = sorted(url_rules.FIXED, key=lambda r: (-len(r[0] + r[1]), r))
    return " ".join(f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then {{'rule': '{h}{p}', 'verdict': '{v}'}}" for h, p, v in ranked)


_URL_RULES = f"""
with rest as (
  select row_number() over () as rid, page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as r from pages),
parts as (
  select rid, page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(r, '^[^?#]*\\?([^#]*)', 1) as query from rest),
cut as (
  select *, string_split(host, '.') as labels, list_filter(string_split(path, '/'), lambda x: x <> '') as segments,
    list_filter(list_transform(string_split(query, '&'), lambda x: split_part(x, '=', 1)), lambda x: x <> '') as names
  from parts),
tokens as (
  select rid, page_id, host, path, case when host = '' then [] else list_sort(list_distinct(list_filter(
    list_transform(list_concat(list_transform(labels, lambda x: 'h:' || x), list_transform(segments, lambda x: 'p:' || x),
      list_transform(names, lambda x: 'q:' || x)), lambda x: regexp_replace(x, '[0-9]+', '0', 'g')), lambda x: x <> 'h:'))) end as tokens,
    case {_fixed_sql()} end as fixed
  from cut),
labelled as (
  select row_number() over () as lid, tokens, quality = 0 or toxic = 1 as bad from tokens join labels on doc_id = page_id
  where len(tokens) > 0 and (quality = 0 or toxic = 1) is not null),
base as (select count(*) as n, count(*) filter (where bad) as n_bad, cast(count(*) filter (where bad) as double) / count(*) as share from labelled),
-- Subsets are enumerated over the tokens that enough block labels have; no other token is part of a rule.
likely as (select token from (select unnest(tokens) as token, bad from labelled) where bad group by token having count(*) >= {url_rules.MIN_PAGES}),
short as (
  select lid, any_value(bad) as bad, list_sort(list(token)) as tokens
  from (select lid, bad, unnest(tokens) as token from labelled) join likely using (token) group by lid),
combos as (
  select list_filter(tokens, lambda x, i: (bits >> (i - 1)) & 1 = 1) as tokens, bad
  from (select tokens, bad, unnest(generate_series(1, (1 << len(tokens)) - 1)) as bits from short)),
counted as (select tokens as rule, count(*) as n_fit, count(*) filter (where bad) as n_block from combos group by tokens),
rules as (
  select rule from (select *, n_block - n_fit * share as above from counted, base)
  where n_block >= {url_rules.MIN_PAGES} and n_block >= {url_rules.MIN_CONFIDENCE} * n_fit
    and above >= 0 and above * above >= {url_rules.MIN_DEVIATIONS ** 2} * n_fit * (share * (1 - share))),
hit as (select distinct rid from tokens join rules on list_has_all(tokens, rule) where fixed is null)
select page_id, host, path, fixed.rule as rule, coalesce(fixed.verdict, case when hit.rid is not null then 'block' else 'allow' end) as verdict
from tokens left join hit using (rid)
"""

_FIELDS = ("list_transform(list_filter(string_split({0}, chr(10)), lambda x: contains(x, ':')), "
           "lambda x: {{'k': lower(trim(split_part(x, ':', 1))), 'v': trim(regexp_replace(x, '^[^:]*:', ''))}})")


def _field(fields: str, name: str) -> str:
    return f"list_filter({fields}, lambda e: e.k = '{name}')[1].v"


_PERMITTED = ", ".join(f"'{h}'" for h in warc.PERMITTED)
_REVISITS = f"""
with records as ({CAPTURES}),
whole as (select *, regexp_extract(url, '^([^#]*)', 1) as u from records),
parts as (
  select *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) as scheme,
    lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) as host,
    regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) as path,
    list_sort(list_filter(string_split(regexp_extract(u, '^[^?]*\\?(.*)$', 1), '&'),
      lambda x: x <> '' and not regexp_matches(split_part(x, '=', 1), '{warc.TRACKING}'))) as query from whole),
base as (
  select record_id, ts, status, {_FIELDS.format("headers")} as fields, digest,
    coalesce(case when scheme <> '' then scheme || '://'
      || case scheme when 'http' then regexp_replace(host, ':80$', '') when 'https' then regexp_replace(host, ':443$', '') else host end
      || case when path = '' then '/' else path end || case when len(query) > 0 then '?' || array_to_string(query, '&') else '' end end, '') as canonical_url
  from parts),
pairs as (
  select r.record_id, r.canonical_url, r.ts, r.fields, r.digest as claimed, f.record_id as refers_to, f.fields as stored, f.digest as digest,
    row_number() over (partition by r.record_id order by f.ts desc, f.record_id desc) as place
  from base r left join base f on f.status = 200 and r.canonical_url = f.canonical_url and r.canonical_url <> '' and f.ts < r.ts
  where r.status = 304),
checked as (
  select *, coalesce(
      regexp_replace({_field("fields", "etag")}, '^W/', '') = regexp_replace({_field("stored", "etag")}, '^W/', ''),
      {_field("fields", "last-modified")} = {_field("stored", "last-modified")}, claimed = digest) as same,
    list_filter(fields, lambda e: e.k in ({_PERMITTED})) as updates
  from pairs where place = 1),
done as (
  select *, case when refers_to is null then 'orphan' when same is null then 'unverified' when same then 'resolved' else 'mismatch' end as outcome,
    array_to_string(list_sort(list_transform(list_concat(list_filter(stored, lambda s: not list_contains(list_transform(updates, lambda e: e.k), s.k)), updates),
      lambda e: e.k || ': ' || e.v)), chr(10)) as merged
  from checked)
select record_id, canonical_url, ts, outcome, refers_to, case when outcome = 'resolved' then digest end as digest,
  case when outcome = 'resolved' then merged end as headers
from done
"""

_FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0"

_HARD_NEGATIVES = f"""
with v as materialized (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: cast(floor({hard_negatives.SCALE} * cast(x as double)) as bigint)) as e
  from embeddings where label is not null and {_FINITE}),
scored as (
  select a.r as a, a.vec_id as anchor_id, b.r, b.vec_id, a.label = b.label as same,
    cast(coalesce(list_sum(list_transform(range(1, least(len(a.e), len(b.e)) + 1), lambda i: a.e[i] * b.e[i])), 0) as bigint) as score
  from v a join v b on a.r <> b.r where a.vec_id % 100 = 0),
positives as (
  select * from (select *, row_number() over (partition by a order by score desc, vec_id nulls last, r) as place from scored where same)
  where place <= {hard_negatives.POSITIVES}),
pairs as (
  select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by p.a, p.place order by n.score desc, n.vec_id nulls last, n.r) as rank
  from positives p join scored n on n.a = p.a and not n.same
    and {hard_negatives.LEAST} * p.score <= 100 * n.score and 100 * n.score <= {hard_negatives.MOST} * p.score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from pairs where rank <= {hard_negatives.NEGATIVES}
"""


def _clustering_sql() -> str:
    """The rounds written out: assignment, then floors of means, each a table expression."""
    n = ns_bounds.DIMENSIONS
    gap = f"cast(list_sum(list_transform(range(1, {n + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) as bigint)"
    parts = [f"""v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor({ns_bounds.SCALE} * cast(x as double)) as bigint)) as e, embedding
  from embeddings where len(embedding) = {n} and {_FINITE})""", f"""c0 as materialized (
  select cast(row_number() over (order by sha256('{ns_bounds.SALT}' || coalesce(cast(vec_id as varchar), '')), embedding) - 1 as integer) as j, e
  from v qualify j < {ns_bounds.CLUSTERS})"""]
    for k in range(ns_bounds.ROUNDS + 1):
        parts.append(f"""a{k} as materialized (
  select r, j, d from (select v.r, c.j, {gap} as d from v, c{k} c) qualify row_number() over (partition by r order by d, j) = 1)""")
        if k < ns_bounds.ROUNDS:
            parts.append(f"""c{k + 1} as materialized (
  select c.j, coalesce(m.e, c.e) as e from c{k} c left join (
    select j, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as e
    from (select j, i, sum(e[i]) as s, count(*) as n from a{k} join v using (r), generate_series(1, {n}) as g(i) group by j, i) group by j) m using (j))""")
    k = ns_bounds.ROUNDS
    return f"""with {", ".join(parts)}
select vec_id, j as cluster, d as distance, cast(sum(d) over (partition by j) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(c.e, ',')) as centroid_sha256
from a{k} join v using (r) join c{k} c using (j)"""


ORACLE = {"op12_hard_negatives": _HARD_NEGATIVES, "op13_ns_bounds": _clustering_sql(), "op5_line_cleaning": _LINE_CLEANING, "op6_url_rules": _URL_RULES, "op8_revisits": _REVISITS}
