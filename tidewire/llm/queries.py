"""The queries opN_<name>: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import decontaminate, language_id, licenses, lm_score, ngram_join, packing, pii, prefix_trie, secrets, spelling, topk, toxicity, url_filter
from tidewire.llm.common import table
from tidewire.session import ship


def fold(column: str, n: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % n


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(ship(spark), sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(ship(spark), sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic")
    scored = toxicity.score(docs, labels, fold("doc_id", 3) != 1)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted", "n_hits")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents", "doc_id", "text", "lang")
    found = language_id.identify(docs, fold("doc_id", 4) != 2)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(ship(spark), sf_dir, "documents", "doc_id", "text"), n=3, percent=90)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(ship(spark), sf_dir, "documents", "doc_id", "text"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(ship(spark), sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(ship(spark), sf_dir, "documents", "doc_id", "text"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(ship(spark), sf_dir, "documents", "doc_id", "text"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages", "page_id", "url"))


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scores(table(ship(spark), sf_dir, "documents", "doc_id", "text"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted(table(ship(spark), sf_dir, "documents", "doc_id", "text"), letters=6, least=5, every=199))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered(table(ship(spark), sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    rebuilt, convs = prefix_trie.grafted(turns, F.col("conv_id") - F.col("conv_id") % 5, fold("conv_id", 9))
    return prefix_trie.trie(rebuilt, convs).drop("digest")


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.found_in(table(ship(spark), sf_dir, "documents", "doc_id", "text"))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op13's result that SQL can express."""
    return op13_pii(spark, sf_dir).drop("spans", "n_added")


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of op7's result that SQL can express; -1 where there is no place."""
    found = op7_license_scan(spark, sf_dir)
    return found.select("doc_id", "n_words", "n_base", F.coalesce("first_word", F.lit(-1)).alias("first_word"), F.coalesce("last_word", F.lit(-1)).alias("last_word"), "base_labels")


def crc32_sql(text: str) -> str:
    """DuckDB SQL of the unsigned CRC-32 of a text's UTF-8 bytes: eight shifts a byte."""
    octets = f"list_transform(range(1, strlen({text}) + 1), lambda i: cast('0x' || substr(hex(encode({text})), cast(2 * i - 1 as bigint), 2) as bigint))"
    shifted = "list_reduce([xor(a, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce([4294967295::bigint] || {octets}, lambda a, b: {shifted}), 4294967295)"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_exact_topk, op2_toxicity, op3_language_id, op4_ngram_join, op5_packing, op6_decontamination, op7_license_scan, op8_secret_scan, op9_url_filter, op10_lm_score, op11_spelling, op12_prefix_trie, op13_pii, license_base, pii_base)}

#: Whole-table SQL where it is fast enough and can express the query.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_topk": """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as w from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id as vec_id, cast(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) as bigint) as score
  from v q join v c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 20""",
    "op9_url_filter": url_filter.ORACLE,
    "op4_ngram_join": r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents where doc_id is not null),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w),
n as (select doc_id, len(s) as n from s),
e as (select doc_id, unnest(s) as g from s),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y, c = p.n and c = q.n as same from c join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 90 * (p.n + q.n - c)),
b as (select x, y from l union select y, x from l),
r(id, to_id) as (select doc_id, doc_id from n union select r.id, b.y from r join b on b.x = r.to_id)
select n.doc_id, cast(n.n as bigint) as n_shingles, coalesce(k.class_id, n.doc_id) as class_id, m.component_id from n
join (select id, min(to_id) as component_id from r group by all) m on m.id = n.doc_id left join (select y, min(x) as class_id from l where same group by all) k on k.y = n.doc_id""",
    "op11_spelling": f"""
with recursive t as (select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as w from documents),
d as (select doc_id, w, count(*) as n from t where length(w) >= 6 group by all),
h as (select w, n, {crc32_sql("(coalesce(cast(doc_id as varchar), '') || ':' || w)")} as h from d),
c as (select case when h % 199 = 0 then w[:h % length(w)] || w[h % length(w) + 2:] else w end as word, cast(sum(n) as bigint) as n from h group by all),
v as (select word, n from c where length(word) >= 6 and n >= 5),
p as (select word, n, unnest(range(0, length(word))) as i from v),
q as (select word, n, i, word[:i] || '_' || word[i + 2:] as replaced, word[:i] || word[i + 2:] as shorter from p),
e as (select a.word as x, b.word as y, b.n as m from q a join q b on a.replaced = b.replaced and a.word <> b.word
  union select q.word, v.word, v.n from q join v on q.shorter = v.word union select v.word, q.word, q.n from q join v on q.shorter = v.word),
b as (select x, count(*) as n_near, first(y order by m desc, y) as y, max(m) as m from e group by x),
f as (select word, n, coalesce(n_near, 0) as n_near, case when m >= 5 * n then y end as form, case when m >= 5 * n then m end as form_n from v left join b on x = word),
r(word, to_word) as (select word, coalesce(form, word) from f union select r.word, f.form from r join f on f.word = r.to_word where f.form is not null)
select f.word, f.form, (select first(r.to_word) from r join f g on g.word = r.to_word where r.word = f.word and g.form is null) as root, f.n, f.n_near, f.form_n from f""",
    "op12_prefix_trie": f"""
with o as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(strlen(role) || ':' || role || text)) as p from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null)),
k as (select conv_id, conv_id - conv_id % 5 as base, {crc32_sql('cast(conv_id as varchar)')} % 9 as h from (select distinct conv_id from o)),
s as (select k.conv_id, coalesce((select list({{'r': o.role, 't': o.text}} order by p) from o where o.conv_id = k.base and p <= h), []) || coalesce((select list({{'r': o.role, 't': o.text}} order by p) from o where o.conv_id = k.conv_id and p > h), []) as w from k),
f as (select conv_id, unnest(range(0, len(w) + 1)) as d, w from s),
x as (select conv_id, d, w[:d] as q, d = len(w) as ended, case when d = 0 then 0 else strlen(w[d].t) end as b, case when d > 0 then w[:d - 1] end as up from f),
n as (select d, q, any_value(up) as up, min(conv_id) as conv_id, count(*) as n_convs, max(b) as b, coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where ended), '') as ends from x group by d, q),
c as (select d - 1 as d, up as q, count(*) as n from n where d > 0 group by all),
m as (select n.*, coalesce(c.n, 0) as n_children from n left join c on c.d = n.d and c.q = n.q),
u as (select a.d, a.q, cast(sum(case when e.n_children = 0 then 1 else 0 end) as bigint) as n_leaves, cast(sum((e.n_convs - 1) * e.b) as bigint) as saved from m a join m e on e.d >= a.d and e.q[:a.d] = a.q group by all)
select m.conv_id, cast(m.d as bigint) as depth, p.conv_id as parent_conv_id, m.n_convs, cast(m.n_children as bigint) as n_children, u.n_leaves, u.saved as saved_tokens, sha256(m.ends) as ends_sha256
from m join u on u.d = m.d and u.q = m.q left join m p on p.d = m.d - 1 and p.q = m.up""",
    "pii_base": r"""
with t as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
k as (select * from (values (0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'), (1, 'ip', '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)'), (2, 'card', '[0-9](?:[\x20-]?[0-9])+'), (3, 'phone', '\+[0-9][\x20().0-9-]+[0-9]')) as v(k, name, re)),
s as (select r, k, name, string_split_regex(text, re) as gaps, regexp_extract_all(text, re) as hits from t cross join k),
m as (select r, k, name, i, gaps, hits, hits[i] as hit, regexp_replace(hits[i], '[^0-9]', '', 'g') as digits from (select *, unnest(range(1, len(hits) + 1)) as i from s)),
p as (select r, k, name, cast(list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) as bigint) as a, length(hit) as n from m
  where case k when 0 then true when 1 then len(list_filter(string_split(hit, '.'), lambda x: length(ltrim(x, '0')) > 3 or cast('0' || right(x, 3) as integer) > 255)) = 0
  when 2 then length(digits) between 16 and 19 and list_sum(list_transform(range(0, length(digits)), lambda j: case when j % 2 = 0 then cast(substr(digits, length(digits) - j, 1) as integer)
    else (2 * cast(substr(digits, length(digits) - j, 1) as integer)) // 10 + (2 * cast(substr(digits, length(digits) - j, 1) as integer)) % 10 end)) % 10 = 0
  else length(digits) between 8 and 15 end),
g as (select r, count(*) filter (where k = 0) as n_email, count(*) filter (where k = 1) as n_ip, count(*) filter (where k = 2) as n_card, count(*) filter (where k = 3) as n_phone, string_agg(name || ':' || a || ':' || (a + n), ',' order by k, a) as spans from p group by r)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone, sha256(coalesce(spans, '')) as base_sha256 from t left join g on g.r = t.r""",
    "license_base": r"""
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
p as (select doc_id, len(w) as n_words,
  list_filter(range(1, len(w) + 1), lambda i: w[i] = 'gnu' and w[i + 1] = 'general' and w[i + 2] = 'public' and w[i + 3] = 'license') as gpl,
  list_filter(range(1, len(w) + 1), lambda i: w[i] = 'apache' and w[i + 1] = 'license') as apache,
  list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' and w[i + 1] = 'by') as ccby,
  list_filter(range(1, len(w) + 1), lambda i: w[i] = 'mit' and w[i + 1] = 'license') as mit from w),
a as (select *, list_sort(gpl || apache || ccby || mit) as places from p)
select doc_id, n_words, len(places) as n_base, coalesce(places[1] - 1, -1) as first_word, coalesce(places[-1] - 1, -1) as last_word,
  array_to_string(list_filter([case when len(apache) > 0 then 'apache' end, case when len(ccby) > 0 then 'cc-by' end, case when len(gpl) > 0 then 'gpl' end, case when len(mit) > 0 then 'mit' end], lambda x: x is not null), ',') as base_labels from a""",
}
