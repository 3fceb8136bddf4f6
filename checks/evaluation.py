"""Evaluation of the weak labels against the label table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import Views, check, r6
from checks.labels import weak
from veleta.operators import evaluate as E


def judged(v: Views) -> DataFrame:
    return weak(v).select("id", F.col("label").alias("prediccion")).join(
        v.labelled().select("id", "real"), "id")


@check("confusion_matrix", """
select cast(r.k as bigint) as real, cast(p.k as bigint) as prediccion, cast(count(e.id) as bigint) as n
from (values (0), (1), (2)) r(k) cross join (values (0), (1), (2)) p(k)
left join evaluado e on e.real = r.k and e.prediccion = p.k group by 1, 2""")
def confusion_matrix(v: Views) -> DataFrame:
    return E.confusion_matrix(judged(v), "real", "prediccion")


_PER = """per as (select k, tp, sup, pre, case when pre = 0 then 0 else tp / cast(pre as double) end as p,
    case when sup = 0 then 0 else tp / cast(sup as double) end as r,
    case when sup + pre = 0 then 0 else 2 * tp / cast(sup + pre as double) end as f
  from (select k, (select count(*) from evaluado where real = k and prediccion = k) as tp,
    (select count(*) from evaluado where real = k) as sup, (select count(*) from evaluado where prediccion = k) as pre
    from (values (0), (1), (2)) t(k)) q)"""


@check("classification_report", f"""
with {_PER}, tot as (select count(*) as n, avg(case when real = prediccion then 1.0::double else 0 end) as acc from evaluado)
select cast(k as varchar) as clase, round(p, 6) as precision, round(r, 6) as recall, round(f, 6) as f1, cast(sup as bigint) as support from per
union all select 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), cast(n as bigint) from tot
union all select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), cast(sum(sup) as bigint) from per
union all select 'weighted avg', round(sum(p * sup) / sum(sup), 6), round(sum(r * sup) / sum(sup), 6), round(sum(f * sup) / sum(sup), 6), cast(sum(sup) as bigint) from per""")
def classification_report(v: Views) -> DataFrame:
    return E.classification_report(judged(v), "real", "prediccion").withColumns(
        {c: r6(c) for c in ("precision", "recall", "f1")})


@check("macro_metrics", f"""
with {_PER} select round(avg(r), 6) as acc_macro, round(avg(f), 6) as f1_macro, round(sum(f * sup) / sum(sup), 6) as f1_weighted from per""")
def macro_metrics(v: Views) -> DataFrame:
    return E.macro_metrics(judged(v), "real", "prediccion").withColumns(
        {c: r6(c) for c in ("acc_macro", "f1_macro", "f1_weighted")})


_TIER = "case when {0} >= 0.8::double then 'excelente' when {0} >= 0.7::double then 'bueno' else 'insuficiente' end"


@check("validation_accuracy", f"""
select case real when 0 then 'Negativo' when 1 then 'Neutro' else 'Positivo' end as categoria,
  cast(count(*) filter (where real = prediccion) as bigint) as aciertos, cast(count(*) as bigint) as total,
  round(count(*) filter (where real = prediccion) / cast(count(*) as double), 6) as precision,
  {_TIER.format("count(*) filter (where real = prediccion) / cast(count(*) as double)")} as nivel from evaluado group by real
union all select 'total', cast(count(*) filter (where real = prediccion) as bigint), cast(count(*) as bigint),
  round(count(*) filter (where real = prediccion) / cast(count(*) as double), 6),
  {_TIER.format("count(*) filter (where real = prediccion) / cast(count(*) as double)")} from evaluado""")
def validation_accuracy(v: Views) -> DataFrame:
    names = F.array(F.lit("Negativo"), F.lit("Neutro"), F.lit("Positivo"))
    rows = judged(v).withColumn("categoria_real", F.get(names, F.col("real")))
    return E.validation_accuracy(rows, "categoria_real", "real", "prediccion").withColumn(
        "precision", r6("precision"))
