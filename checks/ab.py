"""Comparison of two prediction tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.core import SQL_ISO, Views, big, check, iso, r6
from veleta.functions.values import epoch_timestamp
from veleta.operators import ab

_M = """cast(count(*) as bigint) as total_registros,
  cast(count(*) filter (where prediccion_a = 1) as bigint) as predicciones_a_positivas,
  cast(count(*) filter (where prediccion_b = 1) as bigint) as predicciones_b_positivas,
  cast(count(*) filter (where prediccion_a = prediccion_b) as bigint) as concordancia_ab,
  round(avg(probabilidad_b - probabilidad_a), 6) as diferencia_prob_media,
  round(avg(probabilidad_a), 6) as prob_a_media, round(avg(probabilidad_b), 6) as prob_b_media"""
_MEANS = ("diferencia_prob_media", "prob_a_media", "prob_b_media")


def joined(v: Views) -> DataFrame:
    return ab.ab_join(v.pred_a(), v.pred_b())


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: r6(c) for c in _MEANS})


@check("ab_join", """
select id, fecha_creacion, subreddit_nombre, titulo, titulo_b, cast(prediccion_a as bigint) as prediccion_a,
  probabilidad_a, modelo_a, cast(prediccion_b as bigint) as prediccion_b, probabilidad_b, modelo_b from ab""")
def ab_join(v: Views) -> DataFrame:
    return joined(v).withColumns({c: big(c) for c in ("prediccion_a", "prediccion_b")})


@check("ab_metrics", f"""
select 'global' as ventana, {_M} from ab
union all select subreddit_nombre, {_M} from ab group by subreddit_nombre""")
def ab_metrics(v: Views) -> DataFrame:
    return rounded(ab.ab_metrics(joined(v)))


@check("ab_agreement", """
select subreddit_nombre, cast(count(*) as bigint) as total,
  round(avg(case when prediccion_a = prediccion_b then 1.0::double else 0 end) * 100, 6) as porcentaje_concordancia
from ab group by 1""")
def ab_agreement(v: Views) -> DataFrame:
    return ab.ab_agreement(joined(v)).withColumn("porcentaje_concordancia",
                                                 r6("porcentaje_concordancia"))


@check("ab_metrics_hourly", f"""
select {SQL_ISO.format("date_trunc('hour', make_timestamp(cast(fecha_creacion * 1000000 as bigint)))")} as hora, {_M}
from ab group by 1""")
def ab_metrics_hourly(v: Views) -> DataFrame:
    rows = joined(v).withColumn("fecha_creacion", epoch_timestamp(F.col("fecha_creacion")))
    return rounded(ab.ab_metrics_hourly(rows)).withColumn("hora", iso("hora"))


def _hist(column: str, name: str) -> str:
    return f"""select '{name}' as columna, b.bin, round(lo + (hi - lo) / 20 * b.bin, 6) as desde,
  round(lo + (hi - lo) / 20 * (b.bin + 1), 6) as hasta,
  cast((select count(*) from ab where least(floor(({column} - lo) / (hi - lo) * 20), 19) = b.bin) as bigint) as n, round(media, 6) as media
from (select min({column}) as lo, max({column}) as hi, avg({column}) as media from ab) e,
  (select cast(unnest(range(20)) as bigint) as bin) b"""


@check("prob_histogram", " union all ".join([
    _hist("probabilidad_a", "probabilidad_a"), _hist("probabilidad_b", "probabilidad_b"),
    _hist("(probabilidad_b - probabilidad_a)", "diferencia")]))
def prob_histogram(v: Views) -> DataFrame:
    return ab.probability_histograms(joined(v)).withColumns(
        {c: r6(c) for c in ("desde", "hasta", "media")})
