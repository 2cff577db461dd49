"""The numbered operators as queries over the given tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanbook.llm import language, line_quality
from loanbook.llm.bpe import encode_documents
from loanbook.llm.collocations import mine
from loanbook.llm.common import read
from loanbook.llm.decontaminate import decontaminate
from loanbook.llm.fingerprint import fingerprint_documents
from loanbook.llm.packing import pack
from loanbook.llm.page_text import extract
from loanbook.llm.radix_dedup import radix_dedup
from loanbook.llm.shards import shard
from loanbook.llm.similarity import near_duplicates
from loanbook.llm.url_filter import filter_urls
from loanbook.llm.vector_codes import compress

URL_RULES = """
select * from values
  ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
  as rules(host, path, verdict)
"""
SHARD_BYTES = 1 << 20


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return radix_dedup(read(spark, sf_dir, "documents"))


OP1_SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
           from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), spark.sql(URL_RULES))


OP3_SQL = """
with rules(h, p, v) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
j as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
m as (select j.page_id, h || p as rule, v, row_number() over (partition by j.page_id order by length(h || p) desc) as k
      from j join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select j.page_id, j.host, j.path, m.rule, coalesce(m.v, 'allow') as verdict
from j left join m on m.page_id = j.page_id and m.k = 1
"""


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"), SHARD_BYTES)


OP7_SQL = """
with recursive d as (
  select doc_id, coalesce(strlen(text), 0)::bigint as n_bytes,
         lpad(bin(('0x' || substr(md5(doc_id::varchar), 1, 15))::bigint), 60, '0') as bits from documents),
tree as (
  select 0 as depth, '' as shard, (select sum(n_bytes) from d)::bigint as shard_bytes, (select count(*) from d) as shard_rows
  union all
  (select t.depth + 1, substr(d.bits, 1, t.depth + 1), sum(d.n_bytes)::bigint, count(*)
   from tree t join d on substr(d.bits, 1, t.depth) = t.shard
   where t.shard_bytes > 1048576 and t.shard_rows > 1 group by t.depth, substr(d.bits, 1, t.depth + 1)))
select d.doc_id, d.n_bytes, t.shard, t.depth, t.shard_bytes, t.shard_rows, t.shard_bytes <= 1048576 as fits
from tree t join d on substr(d.bits, 1, t.depth) = t.shard
where t.shard_bytes <= 1048576 or t.shard_rows = 1
"""

def crc_of_id(parts: int, id_col: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(parts))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id(4) == 2, F.lit(False))
    model = line_quality.train(docs, read(spark, sf_dir, "labels"), where=~held_out)
    found = line_quality.score_documents(docs.withColumn("held_out", held_out), model, columns=["doc_id", "held_out"])
    return found.select("row.*", "score").withColumn("predicted", (F.col("score") >= line_quality.THRESHOLD).cast("int"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_of_id(3) == 1, F.lit(False))
    model = language.train(docs, where=~held_out)
    found = language.identify(docs.withColumn("held_out", held_out), model, columns=["doc_id", "held_out"])
    return found.select("row.*", "lang_pred", "score")


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level tokens: a row is as long as its UTF-8 bytes."""
    return pack(read(spark, sf_dir, "documents"), F.octet_length("text"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(read(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_documents(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP11_SQL = f"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
win as (select distinct item_id, least(len(w), 10) as k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') as win
        from (select *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
ks as (select distinct k from win),
spans as (select r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') as win
       from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from d, ks)),
hit as (select r, i, k, win from spans semi join win using (k, win)),
words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from hit) group by r),
items as (select r, count(*) as n_items, string_agg(item, ',' order by item) as listed
          from (select distinct r, item_id::varchar as item from hit join win using (k, win) where item_id is not null) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(listed, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (r) left join items using (r)
"""


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(read(spark, sf_dir, "embeddings"))


def _round_sql(r: int) -> str:
    """Assign parts to the codebook c{r}; c{r + 1} has the floored means."""
    return f"""
a{r} as materialized (
  select vec_id, x.p, any_value(x.v) as v,
         min(list_sum(list_transform(list_zip(x.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::hugeint * 16 + c.k) as best
  from parts x join c{r} c on c.p = x.p group by vec_id, x.p),
c{r + 1} as materialized (
  select c.p, c.k, coalesce(n.v, c.v) as v
  from c{r} c left join (
    select p, k, list((s - (s % n + n) % n) // n order by i) as v
    from (select p, best % 16 as k, i, sum(v[i])::hugeint as s, count(*) as n
          from a{r}, (select unnest(range(1, 1 + (select max(len(v)) from parts))) as i) group by all)
    group by p, k) n on n.p = c.p and n.k = c.k)"""


OP12_SQL = f"""
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as materialized (
  select vec_id, p, list_slice(q, p * (len(q) // 8) + 1, (p + 1) * (len(q) // 8)) as v
  from kept, (select unnest(range(8)) as p)),
c0 as materialized (
  select p, k, v from (select *, row_number() over (partition by p order by vec_id) - 1 as k from parts) where k < 16),
{",".join(_round_sql(r) for r in range(7))},
coded as (
  select vec_id, string_agg(printf('%02x', (best % 16)::int), '' order by p) as code, sum(best // 16)::bigint as error
  from a6 group by vec_id),
book as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, k)) as codebooks_sha256 from c6)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256
from coded join kept using (vec_id), book
"""


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
starts as (select lang, size, list_slice(w, i, i + size - 1) as ws
           from (select lang, w, size, unnest(range(1, len(w) - size + 2)) as i from w, (select unnest(range(1, 5)) as size))),
f as materialized (select lang, size, array_to_string(ws, ' ') as phrase, count(*) as f from starts group by all),
n as (select lang, sum(f)::bigint as n from f where size = 1 group by lang),
c as materialized (select lang, size, phrase, f as a, string_split(phrase, ' ') as ws from f where size > 1 and f >= 30),
cut as (select lang, phrase, size, a, k, array_to_string(list_slice(ws, 1, k), ' ') as first, array_to_string(list_slice(ws, k + 1, size), ' ') as rest
        from (select *, unnest(range(1, size)) as k from c)),
scored as (select cut.lang, cut.phrase, a, k, l.f as l, r.f as r, ((2000000::hugeint * a) // (l.f + r.f))::bigint as score
           from cut join f l on l.lang = cut.lang and l.phrase = first join f r on r.lang = cut.lang and r.phrase = rest),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
held as (select lang, array_to_string(list_slice(ws, i, i + m - 1), ' ') as phrase, max(a) as most
         from (select *, unnest(range(1, size - m + 2)) as i from (select *, unnest(range(2, size)) as m from c where size > 2))
         group by all),
kept as (select best.* from best left join held using (lang, phrase) where most is null or 100::hugeint * most < 80::hugeint * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang)
qualify rank <= 2000
"""


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_line_quality": op2_line_quality,
    "op3_url_filter": op3_url_filter,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_language_id": op5_language_id,
    "op6_page_text": op6_page_text,
    "op7_sharding": op7_sharding,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_bpe": op10_bpe,
    "op11_decontaminate": op11_decontaminate,
    "op12_vector_codes": op12_vector_codes,
    "op13_collocations": op13_collocations,
}
LLM_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL, "op3_url_filter": OP3_SQL, "op7_sharding": OP7_SQL, "op11_decontaminate": OP11_SQL,
    "op12_vector_codes": OP12_SQL, "op13_collocations": OP13_SQL,
}
