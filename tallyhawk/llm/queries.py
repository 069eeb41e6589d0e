"""The registered queries of the training-data operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhawk.llm import bpe, collocation, dedup, divergence, jaccard, language, packing, shuffle, substring, suffix_array, suffix_tree_lm, topk, toxicity
from tallyhawk.llm.common import table
from tallyhawk.llm.language import held_out

_NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), every=50, k=5, scale=256)


OP1_SQL = """
with t as (select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(embedding) > 0),
s as (select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from t q join t c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5"""


def op2_nearest_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = held_out(F.col("doc_id"), 4, 2)
    model = language.fit(docs.filter(~out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "rejected")


def op3_partenum_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"), digests=True).drop("text_key")


OP4_SQL = f"""
with t as (select doc_id, sha256({_NORMAL}) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from t join g using (text_sha256)"""


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), window=13)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"

OP5_SQL = f"""
with t as (select doc_id, {_WORDS} as w from documents),
p as (select doc_id, w, unnest(generate_series(1, len(w) - 12)) as i from t where len(w) >= 13),
x as (select doc_id, i, hash(array_to_string(w[i:i + 12], ' ')) as h from p),
f as (select h, min(doc_id) as least from x group by h),
r as (select distinct doc_id, i + k as j from x join f using (h), generate_series(0, 12) as g(k) where least < doc_id),
c as (select doc_id, list(j) as gone from r group by doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
  sha256(case when gone is null then array_to_string(w, ' ') else array_to_string(
    [w[j] for j in generate_series(1, len(w)) if not list_contains(gone, j)], ' ') end) as kept_sha256
from t left join c using (doc_id)"""


def op6_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 7, 2)
    model, words = suffix_tree_lm.fit(docs.filter(~out))
    found = suffix_tree_lm.score(docs, model, words)
    return found.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shuffle.two_pass_shuffle(table(spark, sf_dir, "documents"), shards=40, seed=7)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              public_tokenizers.PATTERN)


def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2048)
    return packing.pack(pieces, 2048)


def op10_segment_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = held_out(F.col("doc_id"), 5, 0)
    train = toxicity.labelled(docs.filter(~out), table(spark, sf_dir, "labels").filter(~out))
    return toxicity.score(docs, toxicity.fit(train)).select("doc_id", out.alias("held_out"), "score", "predicted", "passages")


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), length=200)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# bytes as hex digits, so that a byte string is a text of twice its length
OP11_SQL = """
with t as (select row_number() over () as r, doc_id, lower(hex(encode(coalesce(text, '')))) as x from documents),
q as (select r, x, unnest(generate_series(0, length(x) // 2 - 200, 256)) as o from t where length(x) >= 400),
y as (select r, o, substr(x, 2 * o + 1, 910) as y from q),
p as (select r, o, y, unnest(generate_series(0, length(y) // 2 - 200)) as i from y),
k as (select r, o + i as i, hash(substr(y, 2 * i + 1, 400)) as s from p),
c as (select s from k group by s having count(*) > 1),
b as (select r, i, i - lag(i) over (partition by r order by i) as step from k where s in (select s from c)),
g as (select r, i, sum(case when step <= 200 then 0 else 1 end) over (partition by r order by i) as span from b),
v as (select r, span, min(i) as lo, max(i) + 200 as hi from g group by r, span),
w as (select *, lag(hi, 1, 0) over (partition by r order by lo) as prev, row_number() over (partition by r order by lo desc) as last from v),
d as (select w.r, count(*) as n_spans, sum(hi - lo) as n_removed, string_agg(substr(x, 2 * prev + 1, 2 * (lo - prev))
  || case when last = 1 then substr(x, 2 * hi + 1) else '' end, '' order by lo) as kept from w join t using (r) group by w.r)
select doc_id, cast(length(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(case when d.r is null then x else kept end)) as kept_sha256
from t left join d using (r)"""


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), least_docs=10, top=10)


OP12_SQL = f"""
with d as (select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source, {_NORMAL} as x from documents),
w as (select r, lang, source, unnest(regexp_extract_all(x, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from w group by lang, term having count(distinct r) >= 10),
c as (select lang, source, term, count(*) as n from w join k using (lang, term) group by lang, source, term),
g as (select d.lang, d.source, coalesce(max(t), 0) as t from d left join (select lang, source, sum(n) as t from c group by lang, source) s
  on s.lang = d.lang and s.source = d.source group by d.lang, d.source),
v as (select lang, count(*) as v, sum(n) as t from k group by lang),
p as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    1 + (cast(1000000000 as hugeint) * (coalesce(c.n, 0) + 2)) // (cast(g.t as hugeint) + 2 * v.v) as p,
    1 + (cast(1000000000 as hugeint) * (k.n + 2)) // (cast(v.t as hugeint) + 2 * v.v) as q
  from g join k on k.lang = g.lang join v on v.lang = g.lang left join c on c.lang = g.lang and c.source = g.source and c.term = k.term),
a as (select x.lang, x.source, y.source as item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) as value
  from p x join p y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by x.lang, x.source, y.source),
f as (select g.lang, g.source, 'pair' as part, h.source as item, cast(coalesce(a.value, 0) as bigint) as value
  from g join g h on g.lang = h.lang and g.source <> h.source left join a on a.lang = g.lang and a.source = g.source and a.item = h.source
  union all
  select lang, source, 'term', term, cast((p - q) * (p - q) // (p + q) as bigint) from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from f)
select lang, source, part, item, value, cast(rank as integer) as rank from r where part = 'pair' or rank <= 10"""


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"), longest=3, least=10, top=2000, contained=50)


OP13_SQL = f"""
with d as (select coalesce(lang, 'und') as lang, {_NORMAL} as x from documents),
s as (select lang, unnest(regexp_split_to_array(x, '[.,;:!?\\x0A-\\x0D]')) as x from d),
w as (select lang, regexp_extract_all(x, '[^\\x20\\x09]+') as w from s),
v as (select lang, w, unnest([1, 2, 3]) as k from w),
g as (select lang, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from v where len(w) >= k),
f as (select lang, k, array_to_string(w[i:i + k - 1], ' ') as p, count(*) as f from g group by lang, k, p),
n as (select lang, sum(f) as n from f where k = 1 group by lang),
c as (select lang, k, p, string_split(p, ' ') as w, f as a from f where k > 1 and f >= 10),
e as (select lang, p, a, w, k, unnest(generate_series(1, k - 1)) as j from c),
o as (select lang, p, a, j, array_to_string(w[1:j], ' ') as lp, array_to_string(w[j + 1:k], ' ') as rp from e),
j as (select o.lang, o.p, a, j, x.f as l, y.f as r, cast(1000000 as hugeint) * a * a // (cast(x.f as hugeint) * y.f) as score
  from o join f x on x.lang = o.lang and x.p = lp join f y on y.lang = o.lang and y.p = rp),
b as (select *, row_number() over (partition by lang, p order by score, j) as best from j),
t as (select lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as p, a from c where k = 3),
m as (select lang, p, max(a) as longer from t group by lang, p),
r as (select b.*, row_number() over (partition by b.lang order by score desc, b.a desc, b.p) as rank
  from b left join m using (lang, p) where best = 1 and not coalesce(100 * longer >= 50 * b.a, false))
select r.lang, rank, p as phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n,
  cast(score as bigint) as score from r join n using (lang) where rank <= 2000"""


QUERIES = {f.__name__: f for f in (
    op1_bit_sliced_topk, op2_nearest_centroid_language, op3_partenum_jaccard, op4_exact_dedup, op5_substring_dedup,
    op6_suffix_tree_lm, op7_two_pass_shuffle, op8_byte_bpe, op9_best_two_fit, op10_segment_toxicity,
    op11_suffix_array_dedup, op12_source_divergence, op13_phrase_collocations)}
ORACLE = {"op1_bit_sliced_topk": OP1_SQL, "op4_exact_dedup": OP4_SQL, "op5_substring_dedup": OP5_SQL,
          "op11_suffix_array_dedup": OP11_SQL, "op12_source_divergence": OP12_SQL,
          "op13_phrase_collocations": OP13_SQL}
