"""Registered queries of the operators with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from brontide.llm import chat, decontaminate, hard_negatives, langid, lattice, lexical, mixing, neighbours, ngram_join, packing, quality, rules, urls
from brontide.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _add(sql: str | None = None):
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql:
            SQL[query.__name__] = sql
        return query
    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_add()
def op1_packing(spark, sf_dir):
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    return packing.pack(pieces)


@_add()
def op5_quality_classifier(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = quality.train_quality(documents, table(spark, sf_dir, "labels"), metadata=("n_chars",),
                                  train=~fold("doc_id", 5, 0))
    scored = quality.score_quality(documents, model, into=("score", "predicted"))
    return scored.select("doc_id", fold("doc_id", 5, 0).alias("held_out"), "score", "predicted")


@_add()
def op8_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = langid.train_language_id(documents, train=~fold("doc_id", 3, 1))
    found = langid.identify_language(documents, model)
    return found.select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


_MIX_SQL = """
with recursive d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size,
         md5('10:' || coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')) as digest
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size, cast(3 * sum(size) as bigint) as cap,
         row_number() over (order by source nulls last) as k,
         1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from d group by source),
r as (
  select *, row_number() over w as n,
         cast((select sum(size) from d) - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0) as double)
         / sum(weight) over (w rows between current row and unbounded following) as level
  from s window w as (order by cap / weight, source)),
l as (select coalesce(arg_min(level, n), 0) as level from r where level * weight <= cap),
t as (
  select k, s.source, source_size, least(cast(cap as double), level * weight) as target,
         case when source_size > 0 then least(floor(least(cast(cap as double), level * weight) / source_size), 3) else 0 end as whole
  from s, l),
u as (
  select k, digest, sum(size) as words, row_number() over (partition by k order by digest) as n
  from d join t on d.source is not distinct from t.source group by k, digest),
walk as (
  select k, cast(0 as bigint) as n, target - whole * source_size as gap, '' as digest, cast(0 as hugeint) as words, false as held from t
  union all
  select u.k, u.n, case when u.words <= gap then gap - u.words else gap end, u.digest, u.words, u.words <= gap and gap > 0
  from walk join u on u.k = walk.k and u.n = walk.n + 1),
g as (select k, arg_max(gap, n) as gap from walk group by k),
f as (
  select k, arg_min(digest, (abs(words - gap), digest)) as digest from (
    select walk.k, digest, words, g.gap from walk join g using (k) where not held and words > 0 and abs(words - g.gap) < g.gap)
  group by k),
h as (select k, digest from walk where held union all select k, digest from f)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(size * (whole + case when h.digest is null then 0 else 1 end) as bigint) as taken
from d join t on d.source is not distinct from t.source left join h on h.k = t.k and h.digest = d.digest
"""


@_add(_MIX_SQL)
def op10_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


_JOIN_SQL = """
with recursive w as (
  select doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select doc_id, unnest(list_distinct(case when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end)) as g
  from w where len(w) > 0),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (
  select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 10 * count(*) >= 8 * (min(x.n) + min(y.n) - count(*))),
reach as (select doc_id as a, doc_id as b from documents union select r.a, p.b from reach r join p on p.a = r.b),
c as (select a as doc_id, min(b) as class_id, count(*) as class_size from reach group by a),
l as (select a as doc_id, count(*) as n_links from p group by a)
select c.doc_id, class_id, coalesce(n_links, 0) as n_links, class_size, cast(coalesce(n, 0) as int) as n_shingles
from c left join l using (doc_id) left join n using (doc_id)
"""


@_add(_JOIN_SQL)
def op4_ngram_join(spark, sf_dir):
    return ngram_join.similar_classes(table(spark, sf_dir, "documents"))


_RULES_SQL = """
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents),
g as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from d where len(w) > 2),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from g) where n > 1),
p as (select doc_id, count(distinct i + k) as n from r, (values (0), (1), (2)) as x(k) group by doc_id),
s as (
  select d.doc_id, t, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
         coalesce(p.n, 0) as n_repeat_words, len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) as n_stutter
  from d left join p using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from s)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
       cast(n_dup_lines as bigint) as n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or (n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines)
            or word_chars < 2 * n_words or word_chars > 14 * n_words
            or 5 * len(regexp_extract_all(t, '[A-Z]')) > 2 * word_chars
            or 4 * (length(t) - length(replace(t, '!', ''))) > n_words
            or 10 * n_repeat_words > 3 * n_words or 5 * n_stutter > n_words) as kept
from b
"""


@_add(_RULES_SQL)
def op3_quality_rules(spark, sf_dir):
    judged = rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# The rules of the contract.
URL_RULES = (urls.Rule("org/", "allow"), urls.Rule("example.org/es/", "block"), urls.Rule("example.org/en/1", "block"),
             urls.Rule("com/fr/", "allow"), urls.Rule("com/de/", "block"))


@_add()
def op6_url_filter(spark, sf_dir):
    judged = urls.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "template", "purity")


_CHAT_SQL = """
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
e as (
  select *, 20 + length(role) + length(text) + length(regexp_replace(role || chr(10) || text, '[^\\\\]', '', 'g'))
    + len(regexp_extract_all(role, '<s>|</s>|\\[INST\\]|\\[/INST\\]')) + len(regexp_extract_all(text, '<s>|</s>|\\[INST\\]|\\[/INST\\]')) as n
  from t)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
       cast(sum(n) as bigint) as formatted_chars
from e group by conv_id
"""


@_add(_CHAT_SQL)
def op2_chat_format(spark, sf_dir):
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.digests(chat.format_conversations(rows))


@_add()
def op7_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 100 = 0"))


@_add()
def op9_lattice_score(spark, sf_dir):
    import public_tokenizers

    documents = table(spark, sf_dir, "documents")
    vocabulary = lattice.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = lattice.train_lm(documents, vocabulary, train=~fold("doc_id", 7, 2))
    scored = lattice.score_documents(documents, model)
    return scored.select("doc_id", fold("doc_id", 7, 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


_LEAK_SQL = """
with d as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents),
b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark),
v as (
  select distinct item_id, m, array_to_string(w[i:i + m - 1], ' ') as g
  from (select item_id, w, least(len(w), 10) as m, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from b where len(w) > 0)),
p as (
  select r, m, i, array_to_string(w[i:i + m - 1], ' ') as g
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) as i from d, (select distinct m from v))),
h as (select r, p.m, i, item_id from p join v on p.m = v.m and p.g = v.g),
n as (select r, count(distinct k) as n_hit from (select distinct r, unnest(range(i, i + m)) as k from h) group by r),
t as (select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
      from (select distinct r, cast(item_id as varchar) as item_id from h where item_id is not null) group by r)
select doc_id, cast(coalesce(len(w), 0) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join n using (r) left join t using (r)
"""


@_add(_LEAK_SQL)
def op13_decontamination(spark, sf_dir):
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


_SEARCH_SQL = """
with d as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
  from documents),
b as (
  select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) as term
  from benchmark),
q as (select item_id, term, count(*) as q from b group by all),
k as (select count(*) as docs, cast(sum(len(w)) as bigint) as length from d where len(w) > 0),
t as (select r, term, count(*) as tf from (select r, unnest(w) as term from d) group by all),
i as (select term, cast(floor(1000 * ln(cast(2 * any_value(docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as w from t, k group by term),
m as (select doc_id, r, 100 - 25 + (25 * len(w) * docs) // length as m from d, k where len(w) > 0),
s as (
  select item_id, r, cast(sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score
  from q join t using (term) join i using (term) join m using (r) group by all),
o as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from s join m using (r) where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from o where rank <= 20
"""


@_add(_SEARCH_SQL)
def op11_lexical_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_NEGATIVES_SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same,
         cast(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) as bigint) as score
  from e a join e b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
t as (select * from p where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select t.anchor_id, t.id as positive_id,
       cast(row_number() over (partition by t.anchor_id, t.id order by p.score desc, p.id) as int) as rank,
       p.id as negative_id, t.score as positive_score, p.score as negative_score
from t join p on t.anchor_id = p.anchor_id and not p.same and 50 * t.score <= 100 * p.score and 100 * p.score <= 95 * t.score
qualify rank <= 3
"""


@_add(_NEGATIVES_SQL)
def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)
