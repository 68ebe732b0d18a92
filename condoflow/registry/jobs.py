"""Queries: imports, annexes, statements, notifications."""

from __future__ import annotations

import datetime as dt
from math import gcd

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import dates, text
from ..plans import annexes, ingest, notifications, statements as st
from ..sources.files import parse_lines, split_rejects
from ..sources.text_lines import parse_documents
from . import inputs, lines as src, tables
from .base import numbers_as_text, query, rounded
from .star import RANGE, Star

SENDER = "administracion@example.org"


@query("ingest_pagos", """
SELECT id_pago, 1::BIGINT AS forma_pago_id, cvu, fecha::VARCHAR AS fecha, importe_cents FROM pago WHERE fecha >= DATE '1998-01-01'
""")
def ingest_pagos(star: Star) -> DataFrame:
    """Payments of the whole file that are not among the loaded ones."""
    loaded = star.payments().filter(F.col("fecha") < F.lit(tables.LOADED_UNTIL))
    new, _ = ingest.import_payments(inputs.src_pagos(star), loaded)
    return new


@query("ingest_gastos", src.DOCUMENT_SQL + """
SELECT consorcio_id, make_date(anio, mes, 1)::VARCHAR AS fecha, importe_cents, tipo_servicio,
       lpad((consorcio_id % 1000)::VARCHAR, 3, '0') || strftime(make_date(anio, mes, 1), '%y%m')
         || lpad((ROW_NUMBER() OVER (ORDER BY consorcio_id, anio, mes, tipo_servicio) % 1000)::VARCHAR, 3, '0') AS nro_factura
FROM suma_servicio WHERE importe_cents > 0
""")
def ingest_gastos(star: Star) -> DataFrame:
    docs = parse_documents(src.cost_document_arrays(star)).drop("consorcio_id")
    return ingest.import_costs(docs, star.building_names(), "anio").select(
        "consorcio_id", "fecha", "importe_cents", "tipo_servicio", "nro_factura"
    )


@query("refused_cost_documents", src.DOCUMENT_SQL + """,
leido AS (
  SELECT *, CASE WHEN mes = 3 THEN 'consorcio desconocido' WHEN mes = 4 THEN 'sin consorcio' WHEN mes = 6 THEN 'mes desconocido' END AS entero
  FROM documento CROSS JOIN servicio LEFT JOIN texto_servicio USING (consorcio_id, consorcio, anio, mes, tipo_servicio))
SELECT DISTINCT entero AS motivo, anio::BIGINT AS anio, consorcio, mes::BIGINT AS mes, NULL::VARCHAR AS tipo_servicio FROM leido WHERE entero IS NOT NULL
UNION ALL SELECT CASE mes WHEN 1 THEN 'importe ilegible' ELSE 'importe no positivo' END, anio, consorcio, mes, tipo_servicio FROM leido
  WHERE mes IN (1, 2) AND tipo_servicio = 'SEGUROS' AND importe_texto IS NOT NULL
UNION ALL SELECT DISTINCT 'sin importes', anio, consorcio, mes, NULL FROM leido WHERE mes = 9
""")
def refused_cost_documents(star: Star) -> DataFrame:
    """Documents with a fault each month, and the reasons they are refused for; what is not refused is a cost of ``ingest_gastos``."""
    docs, month = parse_documents(src.cost_document_arrays(star)).drop("consorcio_id"), F.trim("Mes")
    name, insured = F.col("`Nombre del consorcio`"), F.col("SEGUROS")
    kept = docs.select("*", name.alias("_consorcio"), dates.spanish_month_number(month).alias("_mes"))
    faulty = kept.withColumns({
        "Nombre del consorcio": F.when(month == "marzo", F.concat(name, F.lit(" bis"))).when(month == "abril", F.lit(" ")).otherwise(name),
        "Mes": F.when(month == "junio", F.lit("junip")).otherwise(F.col("Mes")),
        "SEGUROS": F.when(insured.isNotNull() & (month == "enero"), F.lit("sin dato")).when(insured.isNotNull() & (month == "febrero"), F.lit("-5,00"))
        .otherwise(insured),
    })
    bare = faulty.withColumns({s: F.when(month != "septiembre", F.col(f"`{s}`")) for s in text.SERVICES})
    refused = ingest.cost_entries(bare, star.building_names(), "anio").filter("motivo is not null")
    said = lambda key: F.get_json_object("detalle", f"$.{key}")
    return refused.select(
        "motivo", said("anio").cast("bigint").alias("anio"), said("_consorcio").alias("consorcio"), said("_mes").cast("bigint").alias("mes"), "tipo_servicio"
    )


@query("ingest_personas", src.PERSON_SQL + """
SELECT nombre, apellido, dni, email, telefono, cvu, rol_id FROM persona_unica
WHERE dni NOT IN (SELECT dni FROM persona WHERE c_acctbal < 0 AND apellido <> 'MACHINERY')
""")
def ingest_personas(star: Star) -> DataFrame:
    """Holders in debt are registered already, under their own account."""
    balance = star.read("customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    known = star.persons().join(balance, "id").filter("c_acctbal < 0 and apellido <> 'MACHINERY'")
    return ingest.import_persons(inputs.src_personas(star), known)


@query("upsert_consorcio", """,
existente AS (SELECT s_suppkey AS id, s_name AS nombre FROM supplier WHERE s_acctbal >= 0)
SELECT COALESCE(e.id, (SELECT MAX(id) FROM existente)
                + ROW_NUMBER() OVER (PARTITION BY e.id IS NULL ORDER BY s_name)) AS id,
       s_name AS nombre, CASE WHEN s_nationkey % 2 = 0 OR e.id IS NULL THEN 'Calle ' || s_suppkey ELSE 'Calle vieja' END AS direccion,
       (100 + s_suppkey)::DOUBLE AS m2_total
FROM supplier LEFT JOIN existente e ON e.nombre = s_name
""")
def upsert_consorcio(star: Star) -> DataFrame:
    """The building file lists every supplier's name; the registered ones are those not in debt.

    Where the file has no address the registered one stays.
    """
    supplier = star.read("supplier")
    known = F.col("s_acctbal") >= 0
    registered = supplier.filter(known).select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("nombre"),
        F.lit("Calle vieja").alias("direccion"), F.lit(None).cast("decimal(18,2)").alias("m2_total"),
    )
    address = F.concat(F.lit("Calle "), F.col("s_suppkey").cast("string"))
    incoming = supplier.select(
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("nombre"),
        F.when((F.col("s_nationkey") % 2 == 0) | ~known, address).alias("direccion"),
        (F.col("s_suppkey") + 100).cast("decimal(18,2)").alias("m2_total"),
    )
    return ingest.import_buildings(incoming, registered)


@query("enrich_suppliers", src.SUPPLIER_SQL + """,
oferta AS (
  SELECT consorcio_id, tipo_servicio, categoria_nueva, empresa, detalle FROM (
    SELECT g.consorcio_id, tipo_servicio, categoria_nueva, empresa, detalle,
           ROW_NUMBER() OVER (PARTITION BY g.consorcio_id, tipo_servicio ORDER BY categoria, empresa, detalle) AS k
    FROM (SELECT DISTINCT consorcio_id, tipo_servicio FROM gasto WHERE NOT extraordinario) g
    JOIN proveedor_limpio p ON p.consorcio_id = g.consorcio_id AND upper(tipo_servicio) LIKE categoria || '%'
    WHERE tipo_servicio <> 'GASTOS GENERALES') WHERE k = 1)
SELECT g.consorcio_id, fecha::VARCHAR AS fecha, importe_cents, COALESCE(o.categoria_nueva, g.tipo_servicio) AS tipo_servicio,
       o.empresa, o.detalle
FROM gasto g LEFT JOIN oferta o USING (consorcio_id, tipo_servicio) WHERE NOT extraordinario
""")
def enrich_suppliers(star: Star) -> DataFrame:
    nothing = F.lit(None).cast("string")
    costs = star.ordinary_costs().select(
        "consorcio_id", "fecha", "importe_cents", "tipo_servicio", nothing.alias("empresa"), nothing.alias("detalle")
    )
    return ingest.enrich_with_suppliers(costs, tables.suppliers(star).drop("consorcio", "s_suppkey"))


@query("ingest_uf_titular", """
SELECT cvu, nombre AS consorcio, u.consorcio_id, numero, piso, departamento
FROM unidad_base u JOIN consorcio c ON c.id = u.consorcio_id
WHERE cvu NOT IN (SELECT cvu FROM pago WHERE fecha >= DATE '2001-01-01')
""")
def ingest_uf_titular(star: Star) -> DataFrame:
    """Units of accounts that paid lately are registered already."""
    registered = star.bare_units().join(tables.recent_accounts(star), "cvu", "left_semi")
    new, _ = ingest.import_unit_holders(
        inputs.src_uf_titular(star), registered, star.building_names(), star.persons()
    )
    return new


@query("ingest_uf_consorcio", """
SELECT uf_id, consorcio_id, numero, CASE WHEN departamento = 'A' THEN m2 ELSE m2 + 0.5 END::DOUBLE AS m2, pct_bp,
       (ARRAY['local', 'departamento', 'duplex'])[('0x' || substr(md5(upper(nombre) || '|' || numero), 1, 8))::BIGINT % 3 + 1] AS tipo
FROM unidad JOIN consorcio c ON c.id = consorcio_id
""")
def ingest_uf_consorcio(star: Star) -> DataFrame:
    """Sizes of department A are known, everything else comes from the file."""
    units = star.bare_units().select(
        "uf_id", "consorcio_id", "numero",
        F.when(F.col("departamento") == "A", F.col("m2")).cast("decimal(10,2)").alias("m2"),
        F.lit(None).cast("bigint").alias("pct_bp"),
        F.lit(None).cast("string").alias("tipo"),
    )
    sizes = split_rejects(parse_lines(src.unit_size_lines(star).select("linea"), schemas.UNIT_SIZE_FILE, "\t")).good
    filled, _ = ingest.import_unit_sizes(sizes, units, star.building_names())
    return filled


@query("fill_general_costs", """,
azar AS (
  SELECT *, l_orderkey || '|' || l_linenumber AS k FROM gasto WHERE NOT extraordinario)
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, importe_cents, tipo_servicio,
       CASE WHEN tipo_servicio = 'GASTOS GENERALES' THEN (ARRAY['Fumigadora La Rápida', 'Iluminación LED S.A.', 'Llaves Express',
         'Servicios de Mantenimiento Integral', 'Piscinas del Sur'])[('0x' || substr(md5('v|' || k), 1, 8))::BIGINT % 5 + 1] END AS empresa,
       CASE WHEN tipo_servicio = 'GASTOS GENERALES' THEN (ARRAY['Reposición de lámparas LED', 'Duplicado de llaves', 'Fumigación mensual',
         'Mantenimiento de extinguidores', 'Limpieza de tanque de agua', 'Mantenimiento de jardines'])[
         ('0x' || substr(md5('d|' || k), 1, 8))::BIGINT % 6 + 1] END AS detalle
FROM azar
""")
def fill_general_costs(star: Star) -> DataFrame:
    nothing = F.lit(None).cast("string")
    costs = star.ordinary_costs().select(
        "l_orderkey", "l_linenumber", "importe_cents", "tipo_servicio",
        nothing.alias("empresa"), F.lit("  ").alias("detalle"),
    )
    filled = ingest.fill_general_costs(costs, ["l_orderkey", "l_linenumber"])
    return filled.withColumn("detalle", text.blank_to_null(F.col("detalle")))


def _annexes(star: Star, weight: int) -> DataFrame:
    units = star.bare_units().select("uf_id", "consorcio_id", "m2")
    existing = units.filter("m2 >= 80").select("uf_id", F.col("m2").alias("numero"))
    return annexes.new_annexes(units, existing, weight)


def _annex_sql(weight: int) -> str:
    share, common = rounded(f"m2 * 100 * {100 * weight}", "total_m2"), gcd(weight, 100)
    return f"""
SELECT uf_id, consorcio_id, {share} AS pct_bp, m2 * 100 * {weight // common} AS share_num, total_m2 * {100 // common} AS share_den,
       ROW_NUMBER() OVER (PARTITION BY consorcio_id ORDER BY uf_id) + COALESCE(ultimo, 0) AS numero
FROM unidad_base JOIN superficie USING (consorcio_id)
LEFT JOIN (SELECT consorcio_id, MAX(m2) AS ultimo FROM unidad_base WHERE m2 >= 80 GROUP BY 1) USING (consorcio_id)
WHERE m2 < 80
"""


@query("annex_parking", _annex_sql(annexes.PARKING_WEIGHT))
def annex_parking(star: Star) -> DataFrame:
    return _annexes(star, annexes.PARKING_WEIGHT)


@query("annex_storage", _annex_sql(annexes.STORAGE_WEIGHT))
def annex_storage(star: Star) -> DataFrame:
    return _annexes(star, annexes.STORAGE_WEIGHT)


@query("apply_payments", """
SELECT id_pago, uf_id, consorcio_id, periodo::VARCHAR AS periodo, fecha::VARCHAR AS fecha, importe_cents FROM aplicado
WHERE fecha >= DATE '1998-01-01'
""")
def apply_payments(star: Star) -> DataFrame:
    """Payments of the loaded years have been applied before."""
    before = star.payments().filter(F.col("fecha") < F.lit(tables.LOADED_UNTIL))
    return st.apply_payments(star.payments(), star.bare_units(), star.statements(), before)


@query("statement_header", """
SELECT consorcio_id, periodo::VARCHAR AS periodo, saldo_anterior_cents, ingresos_cents, adeudados_cents,
       adelantados_cents, egresos_cents, saldo_cierre_cents
FROM encabezado
""")
def statement_header(star: Star) -> DataFrame:
    return star.headers()


@query("statement_detail", """
SELECT uf_id, consorcio_id, periodo::VARCHAR AS periodo, ord_cents, ext_cents, deuda_cents, interes_cents, total_cents,
       vencimiento_1::VARCHAR AS vencimiento_1, vencimiento_2::VARCHAR AS vencimiento_2
FROM detalle
""")
def statement_detail(star: Star) -> DataFrame:
    return star.lines().select(
        "uf_id", "consorcio_id", "periodo", "ord_cents", "ext_cents", "deuda_cents", "interes_cents",
        "total_cents", "vencimiento_1", "vencimiento_2",
    )


ISSUED = st.Range(dt.date(1995, 1, 1), dt.date(1999, 12, 1))
ISSUING = st.Range(dt.date(2000, 1, 1), dt.date(2000, 12, 1))


@query("assign_costs_to_statement", """
SELECT consorcio_id, fecha::VARCHAR AS fecha, importe_cents, (consorcio_id * 1000000 + year(p) * 100 + month(p))::VARCHAR AS expensa_id
FROM (SELECT *, CASE WHEN fecha >= DATE '2001-01-01' THEN NULL
                     WHEN fecha < DATE '2000-01-01' AND l_linenumber = 7 THEN DATE '2000-01-01'
                     ELSE date_trunc('month', fecha)::DATE END AS p FROM gasto)
""")
def assign_costs_to_statement(star: Star) -> DataFrame:
    """Statements until 1999 are issued, those of 2000 are being issued, later costs stay open.

    Lines numbered 7 of the issued months come in only now, after their statement, and go to the first open one.
    """
    costs = star.cost_items().select("consorcio_id", "fecha", "importe_cents", "l_linenumber")
    known = costs.withColumn(
        "periodo_expensa", F.when((F.col("l_linenumber") != 7) & ISSUED.has(F.col("fecha")), dates.period_of(F.col("fecha")))
    )
    linked = st.link_costs(known, ISSUING)
    statement = dates.statement_key(F.col("consorcio_id"), F.col("periodo_expensa"))
    return numbers_as_text(linked.select("consorcio_id", "fecha", "importe_cents", statement.alias("expensa_id")), "expensa_id")


@query("late_interest", """
SELECT uf_id, periodo::VARCHAR AS periodo, pagado_anterior_cents, pagado_cents, primera_fecha::VARCHAR AS primera_fecha, mora_cents
FROM detalle
""")
def late_interest(star: Star) -> DataFrame:
    return star.lines().select(
        "uf_id", "periodo", "pagado_anterior_cents", "pagado_cents", "primera_fecha", "mora_cents"
    )


@query("statement_batch", """
SELECT e.consorcio_id, e.periodo::VARCHAR AS periodo, saldo_anterior_cents, ingresos_cents, adeudados_cents, adelantados_cents,
       egresos_cents, saldo_cierre_cents, COUNT(*) AS detalles, SUM(ord_cents)::BIGINT AS suma_ord_cents,
       SUM(ext_cents)::BIGINT AS suma_ext_cents, SUM(deuda_cents)::BIGINT AS suma_deuda_cents,
       SUM(interes_cents)::BIGINT AS suma_interes_cents, SUM(total_cents)::BIGINT AS suma_total_cents,
       SUM(pagado_cents)::BIGINT AS suma_pagado_cents, SUM(mora_cents)::BIGINT AS suma_mora_cents
FROM encabezado e JOIN detalle d ON d.consorcio_id = e.consorcio_id AND d.periodo = e.periodo GROUP BY ALL
""")
def statement_batch(star: Star) -> DataFrame:
    return st.batch_summary(star.headers(), star.lines())


def _text(cents: str) -> str:
    return f"printf('%.2f', {cents} / 100.0)"


@query("notification_payload", f"""
SELECT uf_id, periodo::VARCHAR AS periodo, email,
  '{{"personalizations":[{{"to":[{{"email":"' || email || '"}}],"subject":"Expensa Mensual"}}],'
  || '"from":{{"email":"{SENDER}","name":"Sistema de Expensas"}},"content":[{{"type":"text/html","value":"'
  || '<h1>' || apellido || ' ' || p.nombre || '</h1><p>Detalle de su expensa de ' || strftime(periodo, '%m/%Y') || ', unidad '
  || departamento || ' del consorcio ' || c.nombre || '.</p><ul class=\\"importes\\"><li>Total a pagar: $' || {_text("total_cents")}
  || '</li><li>Saldo anterior abonado: $' || {_text("pagado_anterior_cents")} || '</li><li>Pagos recibidos: $'
  || {_text("pagado_cents")} || '</li><li>Interés por mora: $' || {_text("mora_cents")} || '</li></ul>'
  || '<ul class=\\"vencimientos\\"><li>' || strftime(vencimiento_1, '%d/%m/%Y') || ': sin recargo</li><li>'
  || strftime(vencimiento_2, '%d/%m/%Y') || ': con 2% de recargo</li><li>Después: con 5% de recargo</li></ul>"}}]}}' AS payload
FROM detalle d JOIN unidad_base u USING (uf_id) JOIN persona p USING (cvu) JOIN consorcio c ON c.id = u.consorcio_id
""")
def notification_payload(star: Star) -> DataFrame:
    units = notifications.with_contacts(star.units(), star.building_names(), star.persons())
    units = notifications.letters(units, SENDER)
    return notifications.payloads(st.statement_detail(units, star.costs(), star.payments(), RANGE, carry=notifications.LETTER), SENDER)
