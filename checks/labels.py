"""Weak labels, confidence, mining, splits and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import Views, big, check, r6
from veleta.functions import probs as P
from veleta.operators import labels as L


def weak(v: Views) -> DataFrame:
    return L.weak_labels(v.star_probs())


@check("weak_labels", """
select id, sentimiento_label, cast(label as bigint) as label, round(p_neg, 6) as p_neg, round(p_neu, 6) as p_neu,
  round(p_pos, 6) as p_pos from weak""")
def weak_labels(v: Views) -> DataFrame:
    return weak(v).withColumns({"label": big("label"), **{c: r6(c) for c in ("p_neg", "p_neu", "p_pos")}})


@check("label_map", """
select sentimiento_label, cast(label as bigint) as label, cast(count(*) as bigint) as n from weak group by 1, 2""")
def label_map(v: Views) -> DataFrame:
    return weak(v).groupBy("sentimiento_label", big(P.label_id(F.col("sentimiento_label")))
                           .alias("label")).agg(big(F.count(F.lit(1))).alias("n"))


_SOFT = """(select vec_id, l, list_transform(l, lambda x: exp(x - list_max(l))) as e
  from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as l from embeddings) q) z"""


@check("softmax_argmax", f"""
select vec_id, cast(list_position(l, list_max(l)) - 1 as bigint) as clase,
  round(list_max(list_transform(e, lambda x: x / list_sum(e))), 6) as confianza,
  round(list_sum(list_transform(e, lambda x: x / list_sum(e))), 6) as suma from {_SOFT}""")
def softmax_argmax(v: Views) -> DataFrame:
    probs = P.softmax(F.col("embedding").cast("array<double>"))
    out = v.table("embeddings").select("vec_id", "embedding", probs.alias("p"))
    total = F.aggregate("p", F.lit(0.0), lambda a, x: a + x)
    return out.select("vec_id", big(P.argmax(F.col("p"))).alias("clase"),
                      r6(F.array_max("p")).alias("confianza"), r6(total).alias("suma"))


@check("predict_record", """
select s.id, case when trim(texto, ' ' || chr(10)) = '' then 'Neutro' when w.p_neg >= w.p_neu and w.p_neg >= w.p_pos then 'Negativo'
    when w.p_neu >= w.p_pos then 'Neutro' else 'Positivo' end as prediction,
  round(case when trim(texto, ' ' || chr(10)) = '' then 0.33 else w.confianza end, 6) as confidence,
  round(case when trim(texto, ' ' || chr(10)) = '' then 0.34 else w.p_neu end, 6) as p_neutro
from silver s join weak w on w.id = s.id""")
def predict_record(v: Views) -> DataFrame:
    rows = v.silver().select("id", "texto").join(weak(v), "id")
    rec = P.prediction_record(F.col("texto"), F.array("p_neg", "p_neu", "p_pos"))
    return rows.select("id", rec.alias("r")).select(
        "id", "r.prediction", r6("r.confidence").alias("confidence"),
        r6(F.get("r.probabilities", F.lit(1))).alias("p_neutro"))


@check("class_distribution", """
select cast(label as bigint) as label, cast(count(*) as bigint) as n, round(count(*) / sum(count(*)) over (), 3) as proporcion
from weak group by 1""")
def class_distribution(v: Views) -> DataFrame:
    return L.class_distribution(weak(v)).withColumn("label", big("label"))


@check("confidence_split", "select id, round(confianza, 6) as confianza, alta as alta_confianza from weak")
def confidence_split(v: Views) -> DataFrame:
    return L.with_confidence(weak(v)).select("id", r6("confianza").alias("confianza"),
                                             "alta_confianza")


_NEED = "(60 - (select count(*) from weak where alta and sentimiento_label = 'neu'))"


@check("neutral_mining", f"""
select id, sentimiento_label, false as minado from weak where alta
union all select id, sentimiento_label, true from (
  select *, row_number() over (order by p_neu desc, margen desc, id) as rn from weak where not alta and sentimiento_label = 'neu') q
where rn <= {_NEED}""")
def neutral_mining(v: Views) -> DataFrame:
    return L.mine_neutrals(weak(v)).select("id", "sentimiento_label", "minado")


@check("neutral_relax", f"""
select id, round(p_neu, 6) as p_neu from (
  select *, row_number() over (order by p_neu desc, id) as rn from weak where not alta and sentimiento_label = 'neu' and p_neu >= 0.38::double) q
where rn <= {_NEED}""")
def neutral_relax(v: Views) -> DataFrame:
    rated = L.with_confidence(weak(v))
    return L.relax_neutrals(rated, rated.filter("alta_confianza")).select("id", r6("p_neu").alias("p_neu"))


@check("binary_fallback", """
select cast(label as bigint) as label, cast(count(*) as bigint) as n, false as forzado from weak group by 1
union all select cast(label as bigint), cast(count(*) as bigint), true from weak where label in (0, 2) group by 1""")
def binary_fallback(v: Views) -> DataFrame:
    """Unchanged with the usual minimum; reduced to two classes when the minimum is out of reach."""
    counted = lambda d, forced: d.groupBy(big("label").alias("label")).agg(
        big(F.count(F.lit(1))).alias("n")).withColumn("forzado", F.lit(forced))
    return counted(L.binary_fallback(weak(v)), False).unionByName(
        counted(L.binary_fallback(weak(v), least=1 << 60), True))


@check("stratified_split", """
select id, cast(label as bigint) as label, case when u < 0.8::double then 'train' when u < 0.9::double then 'val' else 'test' end as particion
from (select id, label, cast(('0x' || substr(md5(id || ':42'), 1, 8))::bigint as double) / 4294967296 as u from weak) q""")
def stratified_split(v: Views) -> DataFrame:
    return L.hash_split(weak(v)).select("id", big("label").alias("label"), "particion")


@check("stratified_split_exact", """
select id, cast(label as bigint) as label, case when rn <= round(0.8::double * n) then 'train' when rn <= round(0.9::double * n) then 'val' else 'test' end as particion
from (select id, label, row_number() over (partition by label order by md5(id || ':42'), id) as rn, count(*) over (partition by label) as n from weak) q""")
def stratified_split_exact(v: Views) -> DataFrame:
    return L.ranked_split(weak(v)).select("id", big("label").alias("label"), "particion")


@check("split_unstratified", """
select id, case when rn <= round(0.8::double * n) then 'train' when rn <= round(0.9::double * n) then 'val' else 'test' end as particion
from (select id, row_number() over (order by md5(id || ':42'), id) as rn, count(*) over () as n from weak) q""")
def split_unstratified(v: Views) -> DataFrame:
    return L.ranked_split(weak(v), label=None).select("id", "particion")


@check("class_weights", """
with c as (select label, count(*) as n from weak group by 1), i as (select label, n, sum(n) over () / cast(n as double) as inv from c)
select cast(label as bigint) as label, cast(n as bigint) as n, round(inv * count(*) over () / sum(inv) over (), 6) as peso from i""")
def class_weights(v: Views) -> DataFrame:
    return L.class_weights(weak(v)).withColumns({"label": big("label"), "peso": r6("peso")})
