"""The opN_ queries: each operator over its whole table with production
parameters, next to DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fertility, langid, line_windows, mixing, packing, quality_knn, rp_forest, shingle_join, spelling, syncmers, token_alignment, toxicity, warc
from .common import fold, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


@register("op10_warc_salvage", """
with p as (select page_id, coalesce(html, '') as body from pages),
h as (select page_id, octet_length(encode(body)) as payload_bytes, sha1(body) as hex,
             min(page_id) over (partition by body) as first_id from p)
select page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int, 1)), '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id = first_id then null else first_id end as refers_to
from h
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, read_table(spark, sf_dir, "pages"), min_bytes=0)


@register("op1_token_fertility")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(read_table(spark, sf_dir, "documents"))


@register("op4_mix_budgets", """
with tok as (select doc_id,
    coalesce(case when regexp_matches(source, '[0-9]+$')
             then 'd' || (right(regexp_extract(source, '[0-9]+$'), 9)::bigint % 4) end, 'other') as domain,
    coalesce(lang, 'und') as language, coalesce(source, 'unknown') as source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as n_tokens from documents),
leaves as (select domain, language, source, sum(n_tokens)::bigint as available from tok group by all),
root as (select *, available * 2 as cap,
    least(floor((sum(available) over ())::bigint * 0.6::double)::bigint, (sum(available) over ())::bigint * 2) as b0 from leaves),
d1 as (select domain, b0, sum(cap)::bigint as c,
    case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end::bigint as w from root group by all),
d2 as (select *, (b0 - coalesce(sum(c) over (order by c::double / w, domain rows between unbounded preceding and 1 preceding), 0)::bigint)::double
    / (sum(w) over (order by c::double / w, domain rows between current row and unbounded following))::bigint as lv from d1),
d3 as (select domain, greatest(least(c, floor(w * max(lv) over ())::bigint), 0) as b1 from d2),
l1 as (select domain, language, b1, sum(cap)::bigint as c,
    case language when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end::bigint as w from root join d3 using (domain) group by all),
l2 as (select *, (b1 - coalesce(sum(c) over (partition by domain order by c::double / w, language rows between unbounded preceding and 1 preceding), 0)::bigint)::double
    / (sum(w) over (partition by domain order by c::double / w, language rows between current row and unbounded following))::bigint as lv from l1),
l3 as (select domain, language, greatest(least(c, floor(w * max(lv) over (partition by domain))::bigint), 0) as b2 from l2),
s1 as (select domain, language, source, b2, cap as c, 1::bigint as w from root join l3 using (domain, language)),
s2 as (select *, (b2 - coalesce(sum(c) over (partition by domain, language order by c::double / w, source rows between unbounded preceding and 1 preceding), 0)::bigint)::double
    / (sum(w) over (partition by domain, language order by c::double / w, source rows between current row and unbounded following))::bigint as lv from s1),
s3 as (select domain, language, source, greatest(least(c, floor(w * max(lv) over (partition by domain, language))::bigint), 0) as leaf_budget from s2),
a as (select *, case when available > 0 then least(floor(leaf_budget::double / available)::bigint, 2) else 0 end as n_full
    from leaves join s3 using (domain, language, source)),
j as (select tok.*, a.leaf_budget, a.n_full, a.leaf_budget - a.n_full * a.available as rest
    from tok join a using (domain, language, source)),
p as (select *, sum(n_tokens) over (partition by domain, language, source order by md5('mix-1:' || n_full || ':' || doc_id)) as run from j where rest > 0)
select doc_id, domain, language, source, n_tokens, leaf_budget, unnest(range(n_full))::bigint as epoch from j
union all select doc_id, domain, language, source, n_tokens, leaf_budget, n_full::bigint as epoch from p where run <= rest
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), mixing.QUERY_PLAN)


@register("op8_line_windows", """
with l as (select doc_id, t.i, t.s from (select doc_id, unnest(list_zip(range(len(string_split(text, chr(10)))), string_split(text, chr(10)))) z
                                         from documents where text is not null) q, lateral (select z[1] as i, z[2] as s) t),
f as (select *, row_number() over (partition by doc_id order by i) as k, count(*) over (partition by doc_id) as n
      from l where regexp_matches(s, '[^\\x20\\x09-\\x0D]')),
w as (select doc_id, k, n, i, list(s) over (partition by doc_id order by k rows between current row and 2 following) as win from f),
v as (select doc_id, k, least(n, 3) as m, win from w where k <= greatest(n - 2, 1)),
o as (select *, row_number() over (partition by win order by doc_id, k) as r from v),
gone as (select distinct f.doc_id, f.i from f join o on o.doc_id = f.doc_id and o.r > 1 and f.k between o.k and o.k + o.m - 1),
kept as (select l.doc_id, string_agg(l.s, chr(10) order by l.i) as s from l left join gone using (doc_id, i) where gone.i is null group by 1),
cnt as (select d.doc_id, coalesce((select count(*) from f where f.doc_id = d.doc_id), 0) as n,
               coalesce((select count(*) from gone where gone.doc_id = d.doc_id), 0) as g from documents d)
select d.doc_id, case when d.text is null then null when g > 0 and g = n then '' else kept.s end as text, n as n_lines, g as n_removed
from documents d join cnt using (doc_id) left join kept using (doc_id)
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_windows.dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", out["_n_lines"].alias("n_lines"), out["_n_removed"].alias("n_removed"))


@register("op9_closed_syncmers")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(read_table(spark, sf_dir, "documents"), stand_in=True)


@register("op2_certified_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(read_table(spark, sf_dir, "documents")))


@register("op6_langid_ftrl")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    model = langid.train(docs.filter(~F.col("held_out")))
    return langid.predict(docs, model, ["doc_id", "held_out"])


@register("op5_quality_neighbours")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))
    labels = read_table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    scored = quality_knn.score(docs, quality_knn.train(docs, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@register("op3_toxic_compression")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)))
    labels = read_table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.train(docs, labels), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register("op7_shingle_components", """
with recursive w as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\\x20\\x09-\\x0D]+') as ws from documents),
s as (select distinct doc_id, unnest(case when coalesce(len(ws), 0) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
      else list_transform(range(len(ws) - 3), lambda i: array_to_string(ws[i + 1:i + 4], ' ')) end) as sh from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as same from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * same >= 85 * (na.n + nb.n - same)),
r as (select doc_id as node, doc_id as reach from documents union select r.node, e.b from r join e on e.a = r.reach)
select d.doc_id, coalesce(n.n, 0) as n_shingles, c.component_id
from documents d left join n using (doc_id) join (select node, min(reach) as component_id from r group by 1) c on c.node = d.doc_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.join_components(read_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@register("op11_galloping_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_report(read_table(spark, sf_dir, "documents"))


@register("op12_pivotal_variants", """
with recursive tab as (select list(c order by i) as l from (select i, list_reduce(list_concat([i], range(8)),
    lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) t(i))),
runs as (select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[A-Za-z\\x{00C0}-\\x{00FF}]+')) as w from documents),
d as (select doc_id, w, count(*) as k, hex(encode(coalesce(doc_id::varchar, '') || ':' || w)) as x from runs where length(w) >= 7 group by doc_id, w),
h as (select w, k, xor(list_reduce(list_concat([4294967295], list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)),
                                   lambda c, b: xor(c >> 8, l[1 + (xor(c, b) & 255)])), 4294967295) as h from d, tab),
m as (select case when h % 31 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end as w, k from h),
v as (select w, sum(k)::bigint as n from m where length(w) >= 7 group by w having sum(k) >= 2),
g as (select w, n, i, left(w, i) as a, substr(w, i + 2) as b from (select w, n, unnest(range(length(w))) as i from v)),
e as (select x.w as w, y.w as o, y.n as m from g x join g y on x.i = y.i and x.a = y.a and x.b = y.b and x.w <> y.w
      union select x.w, y.w, y.n from g x join v y on x.a || x.b = y.w
      union select y.w, x.w, x.n from g x join v y on x.a || x.b = y.w),
f as (select w, count(*) as n_near, arg_min(o, (-m, o)) as o, max(m) as m from e group by w),
t as (select v.w as word, case when f.m >= 10 * v.n then f.o end as form, v.n, coalesce(f.n_near, 0) as n_near,
             case when f.m >= 10 * v.n then f.m end as form_n from v left join f using (w)),
c as (select word, word as at from t union all select c.word, t.form from c join t on t.word = c.at where t.form is not null),
r as (select c.word, c.at as root from c join t on t.word = c.at where t.form is null)
select word, form, root, n, n_near, form_n from t join r using (word)
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"), min_chars=7, min_n=2, ratio=10, thin_every=31)


@register("op13_rp_forest")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
