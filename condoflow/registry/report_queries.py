"""Queries: the six reports, over all buildings and the whole range of dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import dates
from ..plans import reports, statements as st
from ..sources import xml
from .base import numbers_as_text, query, rounded, text_of
from .star import AS_OF, RANGE, Star

WEEKLY_SQL = f""",
semana AS (
  SELECT consorcio_id, year(fecha) AS anio, month(fecha) AS mes,
         (dayofyear(fecha) + dayofweek(date_trunc('year', fecha)::DATE) - 1) // 7 + 1 AS semana,
         SUM(ord_cents)::BIGINT AS o, SUM(ext_cents)::BIGINT AS e, SUM(ord_cents + ext_cents)::BIGINT AS t
  FROM costo GROUP BY ALL),
ventana AS (
  SELECT *, SUM(t) OVER (PARTITION BY consorcio_id, anio, mes ORDER BY semana ROWS UNBOUNDED PRECEDING) AS acumulado,
         SUM(t) OVER (PARTITION BY consorcio_id, anio, mes) AS suma,
         COUNT(*) OVER (PARTITION BY consorcio_id, anio, mes) AS n
  FROM semana)
SELECT nombre AS "Nombre_Consorcio", consorcio_id AS "ID_Consorcio",
       consorcio_id * 1000000 + anio * 100 + mes AS "ID_Expensa",
       anio || '-' || lpad(mes::VARCHAR, 2, '0') AS "Periodo", anio AS "Anio", mes AS "Mes", semana AS "Semana",
       {text_of("o")} AS "Egreso_Ordinario", {text_of("e")} AS "Egreso_Extraordinario",
       {text_of("t")} AS "Egreso_Semanal_Total", {text_of("acumulado")} AS "Acumulado_Progresivo",
       {text_of(rounded("suma", "n"))} AS "Promedio_Periodo"
FROM ventana JOIN consorcio c ON c.id = consorcio_id
"""


@query("r1_weekly_flow", WEEKLY_SQL)
def r1_weekly_flow(star: Star) -> DataFrame:
    return reports.weekly_flow(star.costs(), star.statements(), star.building_names())


_MONTHS = ", ".join(
    f'COALESCE(SUM(importe_cents) FILTER (month(fecha) = {i}), 0) / 100.0 AS "{name}"'
    for i, name in enumerate(reports.MONTH_COLUMNS, 1)
)


@query("r2_dept_month_pivot", f"""
SELECT consorcio_id, year(fecha) AS anio, departamento, {_MONTHS}, SUM(importe_cents) / 100.0 AS "Total"
FROM aplicado JOIN unidad_base USING (uf_id, consorcio_id) GROUP BY consorcio_id, year(fecha), departamento
""")
def r2_dept_month_pivot(star: Star) -> DataFrame:
    return reports.department_month_table(star.applied(), star.bare_units())


def _part(weight: str) -> str:
    """SQL of a payment's part in millionths; only the weight of late interest can be negative."""
    return (
        f"(CASE WHEN w > 0 THEN sign({weight}) * ((2 * importe_cents::HUGEINT * abs({weight}) * 10000 + w) // (2 * w)) "
        "ELSE 0 END)"
    )


def _millionths(total: str) -> str:
    """SQL of an exact amount, as text, of a sum of millionths."""
    return f"(({total})::DECIMAL(30, 0) * 0.000001::DECIMAL(7, 6))::VARCHAR"


_PARTS = {"Ordinario": _part("ord_cents"), "Extraordinario": _part("ext_cents"), "Mora": _part("mora_cents")}
_SUMS = ", ".join(
    f'{_millionths(f"SUM({part})")} AS "{name}"' for name, part in (*_PARTS.items(), ("Total", " + ".join(_PARTS.values())))
)


@query("r3_income_by_source", f""",
peso AS (
  SELECT strftime(fecha, '%Y-%m') AS periodo, importe_cents, ord_cents, ext_cents, mora_cents,
         (ord_cents + ext_cents + mora_cents)::HUGEINT AS w
  FROM aplicado a JOIN detalle d ON d.uf_id = a.uf_id AND d.periodo = a.periodo)
SELECT periodo AS "Periodo", {_SUMS} FROM peso GROUP BY periodo
""")
def r3_income_by_source(star: Star) -> DataFrame:
    settled = dates.shift_period(dates.period_of(F.col("fecha")), -1)
    lines = st.ledger_lines(star.ledgers(), RANGE, carry=("cvu",), paid_only=True)
    return reports.payments_by_source(star.payments().withColumn("periodo", settled), lines, as_of=AS_OF, unit="cvu")


@query("r4_top_months", """,
gasto_mes AS (
  SELECT year(periodo) AS a, month(periodo) AS m, SUM(ord_cents + ext_cents) AS x FROM costo_mes
  JOIN expensa USING (consorcio_id, periodo) GROUP BY 1, 2),
cobro_mes AS (
  SELECT year(periodo) AS a, month(periodo) AS m, SUM(pagado_cents) AS x FROM recibido WHERE pagado_cents > 0 GROUP BY 1, 2)
SELECT 'Gasto' AS "Tipo", a AS "Anio", m AS "Mes", monthname(make_date(a, m, 1)) AS "NombreMes", x / 100.0 AS "Monto"
FROM (SELECT * FROM gasto_mes ORDER BY x DESC, a, m LIMIT 5)
UNION ALL
SELECT 'Ingreso', a, m, monthname(make_date(a, m, 1)), x / 100.0
FROM (SELECT * FROM cobro_mes ORDER BY x DESC, a, m LIMIT 5)
""")
def r4_top_months(star: Star) -> DataFrame:
    return reports.top_months(star.costs(), star.statements(), star.applied())


def _debtors(star: Star) -> DataFrame:
    return reports.ledger_debtors(star.ledgers(), RANGE, star.persons(), as_of=AS_OF)


DEBTORS_SQL = """,
moroso AS (
  SELECT dni, nombre, apellido, email, telefono, SUM(GREATEST(total_cents - pagado_cents, 0))::BIGINT AS x
  FROM detalle JOIN unidad_base USING (uf_id) JOIN persona USING (cvu) GROUP BY ALL
  HAVING x > 1 ORDER BY x DESC, dni LIMIT 3)
"""


@query("r5_top_debtors", DEBTORS_SQL + """
SELECT dni, nombre, apellido, email, telefono, x / 100.0 AS morosidad FROM moroso
""")
def r5_top_debtors(star: Star) -> DataFrame:
    return reports.top_debtors(_debtors(star))


@query("r5_top_debtors_xml", DEBTORS_SQL + """
SELECT '<mayoresMorosos>' || chr(10) || string_agg(
  '<propietario dni="' || dni || '">' || chr(10) || '    <nombre>' || nombre || '</nombre>' || chr(10)
  || '    <apellido>' || apellido || '</apellido>' || chr(10) || '    <email>' || email || '</email>' || chr(10)
  || '    <telefono>' || telefono || '</telefono>' || chr(10) || '    <morosidad>' || (x // 100) || '.'
  || lpad((x % 100)::VARCHAR, 2, '0') || '</morosidad>' || chr(10) || '</propietario>', chr(10) ORDER BY x DESC, dni)
  || chr(10) || '</mayoresMorosos>' AS "XML_Reporte5"
FROM moroso
""")
def r5_top_debtors_xml(star: Star) -> DataFrame:
    return xml.debtors_document(_debtors(star))


GAPS_SQL = """,
intervalo AS (
  SELECT a.uf_id, a.consorcio_id, id_pago, fecha,
         date_diff('day', LAG(fecha) OVER w, fecha) AS dias,
         LAG(fecha) OVER w IS NULL AS primero, LEAD(fecha) OVER w IS NULL AS ultimo
  FROM aplicado a JOIN emitido d ON d.uf_id = a.uf_id AND d.periodo = a.periodo AND d.ord_cents > 0
  WINDOW w AS (PARTITION BY a.uf_id ORDER BY fecha, id_pago))
"""


def _gaps(star: Star) -> DataFrame:
    return reports.ordinary_payment_gaps(star.applied_with_shares(), as_of=AS_OF)


@query("r6_payment_gaps", GAPS_SQL + """
SELECT uf_id, consorcio_id, id_pago, fecha::VARCHAR AS fecha, dias::VARCHAR AS dias FROM intervalo
""")
def r6_payment_gaps(star: Star) -> DataFrame:
    return numbers_as_text(_gaps(star).drop("primero", "ultimo"), "dias")


@query("r6_payment_gaps_xml", GAPS_SQL + """
SELECT uf_id, fecha::VARCHAR AS fecha, id_pago,
       CASE WHEN primero THEN '<unidadFuncional id="' || uf_id || '">' ELSE '' END
       || '<pago fecha="' || fecha::VARCHAR || '"' || COALESCE(' diasDesdeAnterior="' || dias || '"', '') || '/>'
       || CASE WHEN ultimo THEN '</unidadFuncional>' ELSE '' END AS fragmento
FROM intervalo
""")
def r6_payment_gaps_xml(star: Star) -> DataFrame:
    return xml.gap_fragments(_gaps(star))
