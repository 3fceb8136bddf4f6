"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veleta.llm import (attention, decontaminate, extract, fingerprint, jaccard, licenses, ordinal,
                        packing, resample, sharding, substrings, suffixes, vectorcodes)
from veleta.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_packing(spark, sf_dir):
    """Documents cut into power-of-two pieces of at most 1024 tokens."""
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op6_fingerprints(spark, sf_dir):
    """Context-triggered fingerprints of documents, their edited texts and their neighbours."""
    return fingerprint.next_and_edited(table(spark, sf_dir, "documents"))


@query
def op7_decontamination(spark, sf_dir):
    """Benchmark windows of ten words in documents."""
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"),
                                       table(spark, sf_dir, "benchmark")).drop("items")


@query
def op8_sharding(spark, sf_dir):
    """Eight shards of nearly equal bytes over virtual slots."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op9_license_scan(spark, sf_dir):
    """License phrases and notices in documents."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark, sf_dir):
    """Words of documents inside repeated windows of twenty words."""
    return substrings.dedup(table(spark, sf_dir, "documents"))


@query
def op2_ngram_jaccard_join(spark, sf_dir):
    """Components of documents whose five-word shingles are 75 % alike."""
    return jaccard.join(table(spark, sf_dir, "documents"))


def quality_model(spark, docs, sf_dir):
    """The classifier of the pipeline and of op4, from the label table."""
    labels = table(spark, sf_dir, "labels")
    grades = labels.select("doc_id", ordinal.grade_of(labels["quality"], labels["toxic"]).alias("grade"))
    return ordinal.fit(docs, grades)


@query
def op4_quality_classifier(spark, sf_dir):
    """Expected grade and tail probabilities of all documents."""
    docs = table(spark, sf_dir, "documents")
    return ordinal.score(docs, quality_model(spark, docs, sf_dir))


@query
def op3_suffix_array_dedup(spark, sf_dir):
    """Bytes of documents inside repeated strings of a hundred bytes."""
    return suffixes.dedup(table(spark, sf_dir, "documents"))


@query
def op1_html_extraction(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return extract.extract(pages, extract.fit(pages))


@query
def op11_lm_scoring(spark, sf_dir):
    """Log-probabilities of all texts under a causal self-attention model and under word counts."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return attention.score(docs, attention.fit(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op12_importance_resampling(spark, sf_dir):
    """A tenth of the documents, drawn to look like the benchmark texts."""
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_vector_codes(spark, sf_dir):
    """Codes of all vectors in eight parts, by exact ball k-means."""
    return vectorcodes.encode(table(spark, sf_dir, "embeddings"))


# -- SQL twins ---------------------------------------------------------------------------------------

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str, separators: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({text}, ''), '{separators}'), lambda x: x <> '')"


_BLANKS = r"[\x09-\x0D\x20]+"
_MARKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FOLDED = f"translate(text, '{_UPPER}', '{_LOWER}')"

SQL["op2_ngram_jaccard_join"] = f"""
with recursive w as (select doc_id, {_words(_FOLDED, _BLANKS)} as a from documents),
s as (select distinct doc_id, array_to_string(a[i:i + least(5, len(a)) - 1], ' ') as g, least(5, len(a)) as k
  from w, unnest(range(1, greatest(1, len(a) - 4) + 1)) t(i) where len(a) > 0),
n as (select doc_id, count(*) as n from s group by 1),
o as (select x.doc_id as a, y.doc_id as b, count(*) as o from s x join s y on x.g = y.g and x.k = y.k and x.doc_id <> y.doc_id group by 1, 2),
l as (select a, b from o join n p on p.doc_id = a join n q on q.doc_id = b where 100 * o >= 75 * (p.n + q.n - o)),
r as (select doc_id, doc_id as root from documents union select r.doc_id, l.b from r join l on l.a = r.root)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, c.component_id
from documents d left join n on n.doc_id = d.doc_id
join (select doc_id, min(root) as component_id from r group by 1) c on c.doc_id = d.doc_id"""

SQL["op7_decontamination"] = f"""
with d as (select doc_id, {_words(_FOLDED, _MARKS)} as a from documents),
b as (select cast(item_id as varchar) as item, {_words(_FOLDED, _MARKS)} as a from benchmark),
v as (select distinct item, least(10, len(a)) as k, array_to_string(a[i:i + least(10, len(a)) - 1], ' ') as g
  from b, unnest(range(1, greatest(1, len(a) - 9) + 1)) t(i) where len(a) > 0),
f as (select doc_id, i, k, array_to_string(a[i:i + k - 1], ' ') as g
  from d, (select distinct k from v) z, unnest(range(1, len(a) - k + 2)) t(i)),
m as (select f.doc_id, f.i, f.k, v.item from f join v on v.g = f.g and v.k = f.k),
h as (select doc_id, count(distinct i + j) as n from m, unnest(range(0, k)) t(j) group by 1),
q as (select doc_id, count(distinct item) as n, string_agg(distinct item, ',' order by item) as s from m group by 1)
select d.doc_id, cast(len(a) as bigint) as n_words, cast(coalesce(h.n, 0) as bigint) as n_hit, cast(coalesce(q.n, 0) as bigint) as n_items,
  sha256(coalesce(q.s, '')) as items_sha256, h.n is not null as contaminated
from d left join h on h.doc_id = d.doc_id left join q on q.doc_id = d.doc_id"""

SQL["op10_substring_dedup"] = f"""
with w as (select doc_id, {_words("text", _BLANKS)} as a from documents),
f as (select doc_id, i, row_number() over (partition by array_to_string(a[i:i + 19], ' ') order by doc_id, i) as rn
  from w, unnest(range(1, len(a) - 18)) t(i)),
g as (select distinct doc_id, i + j as p from f, unnest(range(0, 20)) t(j) where rn > 1),
u as (select doc_id, unnest(a) as x, generate_subscripts(a, 1) as p from w),
k as (select u.doc_id, string_agg(x, ' ' order by u.p) as s from u left join g on g.doc_id = u.doc_id and g.p = u.p where g.p is null group by 1),
z as (select doc_id, count(*) as n, count(*) filter (q is null or q <> p - 1) as runs
  from (select doc_id, p, lag(p) over (partition by doc_id order by p) as q from g) y group by 1)
select w.doc_id, cast(len(a) as bigint) as n_words, cast(coalesce(z.n, 0) as bigint) as n_removed, sha256(coalesce(k.s, '')) as kept_sha256,
  cast(coalesce(z.runs, 0) as bigint) as n_repeats
from w left join k on k.doc_id = w.doc_id left join z on z.doc_id = w.doc_id"""

# CRC-32 is linear: the xor of what each byte gives at its distance from the end, and of what the start value gives.
_BYTE_STEP = "list_reduce([c, 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: case when r & 1 = 1 then xor(r >> 1, 3988292384) else r >> 1 end)"

SQL["op12_importance_resampling"] = f"""
with recursive d as (select doc_id, {_words(_FOLDED, _MARKS)} as a from documents),
b as (select {_words(_FOLDED, _MARKS)} as a from benchmark),
u as (select doc_id, unnest(a) as w from d), ub as (select unnest(a) as w from b),
h as (select w, hex(encode(w)) as x from (select w from u union select w from ub) y),
far as (select 0 as p, v, {_BYTE_STEP} as c from (select v, cast(v as bigint) as c from range(256) t(v))
  union all select p + 1, v, {_BYTE_STEP} from far where p < (select max(length(x)) // 2 from h)),
begin_at as (select 0 as n, cast(4294967295 as bigint) as c union all select n + 1, {_BYTE_STEP} from begin_at where n < (select max(length(x)) // 2 from h)),
y as (select w, length(x) // 2 as n, length(x) // 2 - 1 - i as p, 16 * (strpos('0123456789ABCDEF', x[2 * i + 1:2 * i + 1]) - 1)
  + strpos('0123456789ABCDEF', x[2 * i + 2:2 * i + 2]) - 1 as v from h, unnest(range(length(x) // 2)) t(i)),
k as (select w, xor(xor(bit_xor(far.c), any_value(o.c)), 4294967295) % 10000 as bucket
  from y join far on far.p = y.p and far.v = y.v join begin_at o on o.n = y.n group by 1),
s as (select bucket, count(*) as n from u join k using (w) group by 1), t as (select bucket, count(*) as n from ub join k using (w) group by 1),
z as (select cast((select coalesce(sum(n), 0) from s) as double) as s, cast((select coalesce(sum(n), 0) from t) as double) as t),
g as (select bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1) * (z.s + 10000) / ((coalesce(s.n, 0) + 1) * (z.t + 10000)))) as bigint) as g
  from z, (select distinct bucket from k) q left join s using (bucket) left join t using (bucket)),
f as (select doc_id, count(*) as n, sum(g) as total from u join k using (w) join g using (bucket) group by 1),
e as (select d.doc_id, len(a) as n, coalesce(cast(floor(cast(total as double) / f.n) as bigint), 0) as weight,
  (cast('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) as bigint) + 0.5) / 4294967296 as p from d left join f using (doc_id)),
c as (select *, weight + cast(floor(-1000 * ln(-ln(cast(p as double)))) as bigint) as score from e),
r as (select doc_id, row_number() over (order by score desc, doc_id) as rank from c where n >= 20)
select c.doc_id, cast(n as bigint) as n_features, weight, score, case when rank <= (select count(*) from r) * 10 // 100 then rank end as rank
from c left join r using (doc_id)"""


def _kmeans_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means: every part against every entry in every round."""
    out = [f"""v as (select vec_id, label, embedding as e from embeddings where embedding is not null
  and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0),
x as materialized (select vec_id, (i - 1) // (len(e) // {parts}) as p, (i - 1) % (len(e) // {parts}) as q, cast(floor(4096 * cast(e[i] as double)) as bigint) as c
  from v, unnest(range(1, len(e) + 1)) t(i)),
c0 as materialized (select p, k, q, c from x join (select vec_id, row_number() over (order by vec_id) - 1 as k from v order by vec_id limit {entries}) o using (vec_id))"""]
    for r in range(rounds + 1):
        out.append(f"""d{r} as materialized (select vec_id, p, min(d * {entries} + k) as m from (select x.vec_id, x.p, c.k, sum((x.c - c.c) * (x.c - c.c)) as d
  from x join c{r} c on c.p = x.p and c.q = x.q group by 1, 2, 3) y group by 1, 2)""")
        if r < rounds:
            out.append(f"""c{r + 1} as materialized (select c.p, c.k, c.q, coalesce(n.c, c.c) as c from c{r} c left join
  (select x.p, d.m % {entries} as k, x.q, cast(floor(cast(sum(x.c) as double) / count(*)) as bigint) as c from x join d{r} d using (vec_id, p) group by 1, 2, 3) n
  on n.p = c.p and n.k = c.k and n.q = c.q)""")
    return "with " + ", ".join(out) + f""",
o as (select vec_id, string_agg(lower(printf('%02x', cast(m % {entries} as int))), '' order by p) as code, cast(sum(m // {entries}) as bigint) as error from d{rounds} group by 1),
l as (select label, cast(sum(error) as bigint) as label_error from v join o using (vec_id) group by 1),
h as (select sha256(string_agg(c, ',' order by p, k, q)) as s from c{rounds})
select v.vec_id, code, error, label_error, h.s as codebooks_sha256 from v join o using (vec_id) join l on l.label is not distinct from v.label, h"""


SQL["op13_vector_codes"] = _kmeans_sql()
