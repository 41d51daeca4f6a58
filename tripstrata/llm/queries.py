"""The operators of this folder as queries on the given tables, with their SQL where it can say it."""

from __future__ import annotations

import zlib
from pathlib import Path

from pyspark.sql import functions as F

from tripstrata.llm import decontaminate as dc
from tripstrata.llm import hard_negatives as hn
from tripstrata.llm import importance as im
from tripstrata.llm import licences as lc
from tripstrata.llm import line_chunks as ch
from tripstrata.llm import packing as pk
from tripstrata.llm import pseudonyms as ps
from tripstrata.llm import quality as ql
from tripstrata.llm import repeats as rp
from tripstrata.llm import set_join as sj
from tripstrata.llm import token_files as tf
from tripstrata.llm import tool_calls as tc
from tripstrata.llm import vector_links as vl
from tripstrata.sources.staging import stage_table

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run

    return register


def table(spark, sf, name):
    """A given table. Python workers on this machine find this package even where the driver's path was set by hand;
    on a cluster it comes with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}" if paths else root
    return spark.read.parquet(f"{sf}/{name}.parquet")


AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@query("op3_decontamination", rf"""
with d as (select doc_id, regexp_extract_all({AZ}, '{BENCH_WORD}') w from documents),
b as (select cast(item_id as varchar) item, regexp_extract_all({AZ}, '{BENCH_WORD}') w from benchmark),
l as (select item, w, least(10, len(w)) n from b where len(w) > 0),
bw as (select distinct item, n, array_to_string(w[i:i + n - 1], ' ') x from (
  select item, n, w, unnest(generate_series(1, len(w) - n + 1)) i from l)),
n as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') x from (
  select doc_id, n, w, unnest(generate_series(1, len(w) - n + 1)) i from d, n where len(w) >= n)),
hit as (select doc_id, i, dw.n, item from dw join bw on dw.n = bw.n and dw.x = bw.x),
word as (select doc_id, count(distinct p) n_hit from (
  select distinct doc_id, unnest(generate_series(i, i + n - 1)) p from hit) group by doc_id),
item as (select doc_id, count(*) n_items, string_agg(item, ',' order by item) items from (
  select distinct doc_id, item from hit) group by doc_id)
select d.doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join word on d.doc_id = word.doc_id left join item on d.doc_id = item.doc_id""")
def _(spark, sf):
    return dc.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark")).drop("items", "spans")


@query("op4_pseudonyms")
def _(spark, sf):
    out = ps.pseudonymise(table(spark, sf, "documents").select("doc_id", "text"), SECRET)
    return out.withColumn("n_replaced", sum((F.col(f"n_{k}") for k in ps.KINDS), F.lit(0)))


#: In production the key comes from the cluster's secret store.
SECRET = "pseudonyms-of-the-test-tables"


@query("op5_line_dedup", f"""
with l as (select doc_id, i, ls[i] s, ('0x' || md5(ls[i])[1:8])::bigint h,
    len(list_filter(string_split(ls[i], ' '), lambda x: x <> '')) c, len(ls) n from (
  select doc_id, ls, unnest(generate_series(1, len(ls))) i from (
    select doc_id, string_split(text, chr(10)) ls from documents where text is not null))),
r as (select *, lag(s) over w ps, lead(s) over w ns, case when lag(c) over w < {ch.LONG_LINE} and c < {ch.LONG_LINE}
    and lag(c) over w + c >= {ch.LEAST_WORDS} then (lag(h) over w * {ch.BASE} + h) % {ch.PRIME} end r,
    lag(c) over w + c cc, lag(s, 2) over w pps from l window w as (partition by doc_id order by i)),
e as (select *, coalesce(r <= lag(r) over w, true) or coalesce(r <= lead(r) over w, true) or cc >= {ch.LONG_LINE} chosen
  from r window w as (partition by doc_id order by i)),
c as (select doc_id, i first, i last, n, s body, ps b, ns a from e where c >= {ch.LONG_LINE}
  union all select doc_id, i - 1, i, n, ps || chr(10) || s, pps, ns from e where r is not null and chosen),
m as (select * from (select *, count(*) over (partition by body) times from c) where times > 1),
f as (select *, row_number() over (partition by body order by doc_id, first) nr from (
  select doc_id, first, last, body from m
  union select doc_id, first - 1, last, b || chr(10) || body from m where first > 1
  union select doc_id, first, last + 1, body || chr(10) || a from m where last < n)),
x as (select distinct doc_id, unnest(generate_series(first, last)) i from f where nr > 1),
o as (select l.doc_id, count(*) n_lines, count(*) filter (x.i is not null) n_removed,
    string_agg(s, chr(10) order by l.i) filter (x.i is null) t
  from l left join x on l.doc_id = x.doc_id and l.i = x.i group by l.doc_id)
select d.doc_id, case when text is not null then coalesce(t, '') end as text,
  coalesce(n_lines, 0)::bigint n_lines, coalesce(n_removed, 0)::bigint n_removed
from documents d left join o on d.doc_id = o.doc_id""")
def _(spark, sf):
    return ch.dedup_lines(table(spark, sf, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def _licence_sql() -> str:
    """The scan in SQL: the same tables of sentences and rules, as lists and regular expressions."""
    def text(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    known = "[" + ", ".join(text(k) for k in lc.KNOWN) + "]"
    names = "[" + ", ".join(text(v) for v in lc.KNOWN.values()) + "]"
    rules = ", ".join(f"case when regexp_matches(j, {text(lc.rule_pattern(ids))}) then {text(n)} end"
                      for n, _, ids in lc.RULES)
    kinds = {k: [n for n, kind, _ in lc.RULES if kind == k] for k in lc.SEVERITY}
    worst = " ".join(f"when list_has_any(v, [{', '.join(map(text, kinds[k]))}]) then {text(k)}" for k in lc.SEVERITY)
    return rf"""
with s as (select doc_id, list_filter(list_transform(string_split_regex(regexp_replace(
    coalesce(text, ''), '([.!?;:])\s+', '\1' || chr(10), 'g'), '[\r\n]+'),
  lambda x: trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> '') p from documents),
q as (select doc_id, list_transform(p, lambda x: coalesce({names}[list_position({known}, x)], '-')) ids from s),
k as (select doc_id, list_filter(ids, lambda x: x <> '-') own, array_to_string(ids, ' ') || ' ' j from q),
u as (select *, list_sort(list_distinct(list_filter([{rules}], lambda x: x is not null))) v from k),
o as (select doc_id, string_agg(x, ',' order by i) sentence_ids from (
  select doc_id, x, min(i) i from (select doc_id, unnest(own) x, generate_subscripts(own, 1) i from u) group by all)
  group by doc_id)
select u.doc_id, len(own)::bigint n_known, coalesce(sentence_ids, '') sentence_ids,
  array_to_string(v, ',') licences, case {worst} else 'none' end category
from u left join o on u.doc_id = o.doc_id"""


@query("op10_licences", _licence_sql())
def _(spark, sf):
    return lc.scan_licences(table(spark, sf, "documents"))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op2_vector_links", """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
e as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.98),
r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
n as (select a, count(*) n_links from e group by a), c as (select a, min(b) least_id from r group by a)
select vec_id, coalesce(n_links, 0)::bigint n_links, least(vec_id, coalesce(least_id, vec_id)) component_id,
  vec_id <= coalesce(least_id, vec_id) kept
from embeddings left join n on n.a = vec_id left join c on c.a = vec_id""")
def _(spark, sf):
    return vl.vector_links(table(spark, sf, "embeddings")).drop("recall")


@query("op6_token_files")
def _(spark, sf):
    documents = table(spark, sf, "documents")
    folder = tf.new_folder(documents)
    return tf.read_tokens(tf.write_tokens(documents, tokenizer(), folder), folder)


@query("op7_quality")
def _(spark, sf):
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    stats = stage_table(ql.statistics(documents), "statistics")
    model = ql.fit(stats, labels.filter(~ql.held_out("doc_id")))
    return ql.with_scores(stats, model).withColumn("held_out", ql.held_out("doc_id"))


@query("op8_packing")
def _(spark, sf):
    return pk.pack_documents(table(spark, sf, "documents"), tokenizer())


@query("op9_set_join", rf"""
with recursive d as (select doc_id, regexp_extract_all({AZ}, '[^\x20\x09-\x0D]+') w from documents),
s as (select distinct doc_id, case when len(w) >= 5 then array_to_string(w[i:i + 4], ' ') else array_to_string(w, ' ') end x
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) i from d where len(w) > 0)),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
e as (select a, b from l union all select b, a from l),
r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
m as (select a, min(b) least_id from r group by a)
select d.doc_id, coalesce(n, 0)::bigint n_shingles, least(d.doc_id, coalesce(least_id, d.doc_id)) component_id
from d left join n on n.doc_id = d.doc_id left join m on m.a = d.doc_id""")
def _(spark, sf):
    return sj.jaccard_components(table(spark, sf, "documents"))


#: Turns of the table as tool traffic: what a user or system turn says is the argument of a call, which refers to
#: the user turn before it; an assistant turn is the result of the call of the turn before.
TURN_SCHEMAS = {
    "ask": {"type": "object", "required": ["text", "n_chars"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "n_chars": {"type": "integer", "minimum": 25},
        "after": {"type": "string"}}},
    "instruct": {"type": "object", "required": ["text"], "additionalProperties": False, "properties": {
        "text": {"type": "string", "minLength": 1}, "n_chars": {"type": "integer"}}},
}


def tool_messages(conversations):
    """The messages of :data:`TURN_SCHEMAS`: (conv_id, turn, role, text)."""
    back = F.when((F.col("role") == "user") & (F.col("turn") >= 2), F.struct(
        F.concat(F.lit("c"), F.col("turn") - 2).alias("$ref")))
    call = F.to_json(F.struct(
        F.concat(F.lit("c"), "turn").alias("id"), F.when(F.col("role") == "user", "ask").otherwise("instruct").alias("name"),
        F.struct("text", F.length("text").alias("n_chars"), back.alias("after")).alias("arguments")))
    result = F.to_json(F.struct(F.concat(F.lit("c"), F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    answer = F.col("role") == "assistant"
    return conversations.select(
        "conv_id", "turn", F.when(answer, "tool").otherwise("assistant").alias("role"),
        F.when(answer, result).otherwise(F.concat(F.lit("<tool_call>"), call, F.lit("</tool_call>"))).alias("text"))


@query("op1_tool_calls", """
with c as (select conv_id, turn, role, text, 'c' || turn id, 'c' || (turn - 2) back from conversations where role <> 'assistant'),
a as (select conv_id, turn, text, 'c' || (turn - 1) id from conversations where role = 'assistant'),
k as (select conv_id, id from c),
l as (select c.*, a.turn result_turn, a.text content, role = 'user' and c.turn >= 2 refers, k.id is not null known
  from c left join a on c.conv_id = a.conv_id and c.id = a.id left join k on c.conv_id = k.conv_id and c.back = k.id)
select conv_id, id call_id, turn, 0 place, case when role = 'user' then 'ask' else 'instruct' end tool,
  case when result_turn is null then 'unanswered' else 'linked' end status, result_turn,
  case when role = 'user' then (turn // 2)::int else 0 end as level,
  case when refers and not known then back else '' end missing_refs,
  case when role = 'user' and length(text) < 25 then '$.n_chars: minimum' else '' end errors,
  '{"arguments":{' || case when refers then '"after":{"$ref":"' || back || '"},' else '' end || '"n_chars":' || length(text)
    || ',"text":' || to_json(text)::varchar || '},"id":"' || id || '","name":"'
    || case when role = 'user' then 'ask' else 'instruct' end || '","result":'
    || coalesce(to_json(content)::varchar, 'null') || '}' record from l
union all
select a.conv_id, a.id, null, null, null, 'orphan', a.turn, null, '', '', null
from a left join k on a.conv_id = k.conv_id and a.id = k.id where k.id is null""")
def _(spark, sf):
    return tc.link_tool_calls(tool_messages(table(spark, sf, "conversations")), TURN_SCHEMAS)


@query("op11_substring_dedup", r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
n as (select doc_id, i, array_to_string(w[i:i + 12], ' ') x from (
  select doc_id, w, unnest(generate_series(1, len(w) - 12)) i from d where len(w) >= 13)),
f as (select x, min(doc_id) least from n group by x),
p as (select distinct doc_id, unnest(generate_series(i, i + 12)) p from n join f on n.x = f.x where f.least < doc_id),
g as (select doc_id, count(*) n_removed, list(p) gone from p group by doc_id)
select d.doc_id, len(w)::bigint n_words, coalesce(n_removed, 0)::bigint n_removed, sha256(array_to_string(
  list_filter(w, lambda x, i: not list_contains(coalesce(gone, []), i)), ' ')) kept_sha256
from d left join g on d.doc_id = g.doc_id""")
def _(spark, sf):
    return rp.dedup_substrings(table(spark, sf, "documents").select("doc_id", "text")).drop("text", "spans")


def _crc_sql(x: str) -> str:
    """CRC-32 of the UTF-8 bytes of a string, byte by byte from a table."""
    zero = zlib.crc32(b"\0")  # the remainders differ from the checksums of single bytes by this
    table = ", ".join(str(zlib.crc32(bytes([i])) ^ zero) for i in range(256))
    raw = f"hex(encode({x}))"
    step = f"xor(c >> 8, [{table}][(xor(c, b) & 255) + 1])"
    return (f"xor(4294967295::bigint, list_reduce(list_transform(range(0, (len({raw}) // 2)::bigint), lambda i: "
            f"('0x' || {raw}[2 * i + 1:2 * i + 2])::bigint), lambda c, b: {step}, 4294967295::bigint))")


@query("op12_importance_resampling", rf"""
with d as (select doc_id, regexp_extract_all({AZ}, '{BENCH_WORD}') w from documents),
b as (select regexp_extract_all({AZ}, '{BENCH_WORD}') w from benchmark),
k as (select unnest([1, 2, 3]) k),
df as (select doc_id, array_to_string(w[i:i + k - 1], ' ') x from (
  select doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) i from d, k where len(w) >= k)),
bf as (select array_to_string(w[i:i + k - 1], ' ') x from (
  select w, k, unnest(generate_series(1, len(w) - k + 1)) i from b, k where len(w) >= k)),
c as (select x, {_crc_sql('x')} % 10000 bucket from (select distinct x from (select x from df union all select x from bf))),
s as (select bucket, count(*) s from df join c on df.x = c.x group by bucket),
t as (select bucket, count(*) t from bf join c on bf.x = c.x group by bucket),
g as (select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * ((select count(*) from df) + 10000)::double)
    / ((coalesce(s, 0) + 1)::double * ((select count(*) from bf) + 10000)::double)))::bigint gain
  from s full join t using (bucket)),
f as (select doc_id, count(*) n, sum(gain) weight from df join c on df.x = c.x join g on c.bucket = g.bucket group by doc_id),
o as (select d.doc_id, len(w) n_words, coalesce(n, 0)::bigint n_features, coalesce(weight, 0)::bigint weight,
  coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || sha256('42:' || d.doc_id)[1:8])::bigint + 0.5::double) / 4294967296)))::bigint score
  from d left join f on d.doc_id = f.doc_id),
r as (select doc_id, row_number() over (order by score desc, doc_id) nr from o where n_words >= 20)
select o.doc_id, n_features, weight, score,
  case when nr <= (select count(*) * 5 // 100 from o where n_words >= 20) then nr end rank
from o left join r on o.doc_id = r.doc_id""")
def _(spark, sf):
    return im.importance_resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op13_hard_negatives", """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) e from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (select a.vec_id a, a.label la, b.vec_id b, b.label lb, list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::bigint s
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id and len(a.e) = len(b.e)),
p as (select a, b, s, row_number() over (partition by a order by s desc, b) nr from s where la = lb),
n as (select p.a, p.b p, p.s ps, s.b n, s.s ns, row_number() over (partition by p.a, p.b order by s.s desc, s.b) nr
  from p join s on p.a = s.a and s.la <> s.lb and 50 * p.s <= 100 * s.s and 100 * s.s <= 95 * p.s where p.nr <= 5)
select a anchor_id, p positive_id, nr::int as rank, n negative_id, ps positive_score, ns negative_score from n where nr <= 3""")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hn.hard_negatives(vectors.withColumn("label", moved))
