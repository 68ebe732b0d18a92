"""Queries: file layouts, cleaning, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import schemas
from ..functions import dates, money, pii, text
from ..operators import maintenance as m
from ..operators.services import unpivot_services
from ..plans import ingest
from ..sources.files import CORRUPT, parse_lines, split_rejects
from ..sources.text_lines import amount_shapes, parse_documents
from . import lines as src
from .base import numbers_as_text, query, rounded, text_of
from .star import Star

# A key for the test tables only; real runs read theirs from the session.
TEST_KEY = "0123456789abcdef"


def _good(parsed: DataFrame) -> DataFrame:
    return split_rejects(parsed).good


@query("src_consorcios", """
SELECT 'Consorcio ' || c.id AS consorcio, nombre, direccion, COUNT(*) AS unidades, SUM(m2)::DOUBLE AS m2_total
FROM consorcio c JOIN unidad_base ON consorcio_id = c.id GROUP BY c.id, nombre, direccion
""")
def src_consorcios(star: Star) -> DataFrame:
    return _good(parse_lines(src.building_lines(star), schemas.BUILDING_FILE, ","))


@query("src_proveedores", src.SUPPLIER_SQL + """
SELECT s_suppkey, tipo_gasto, empresa_detalle, detalle_adicional, consorcio FROM proveedor
""")
def src_proveedores(star: Star) -> DataFrame:
    lines = src.supplier_lines(star).select("s_suppkey", "linea")
    return _good(parse_lines(lines, schemas.SUPPLIER_FILE, ";"))


@query("src_uf_titular", """
SELECT cvu, nombre AS consorcio, numero, piso, departamento FROM unidad_base JOIN consorcio c ON c.id = consorcio_id
""")
def src_uf_titular(star: Star) -> DataFrame:
    return _good(parse_lines(src.unit_holder_lines(star).select("linea"), schemas.UNIT_HOLDER_FILE, "|"))


@query("src_uf_consorcio", """
SELECT nombre || ' ' AS consorcio, numero::VARCHAR AS numero, piso, departamento,
       pct_bp / 100.0 AS coeficiente, (m2 + 0.5)::DOUBLE AS m2
FROM unidad JOIN consorcio c ON c.id = consorcio_id
""")
def src_uf_consorcio(star: Star) -> DataFrame:
    parsed = _good(parse_lines(src.unit_size_lines(star).select("linea"), schemas.UNIT_SIZE_FILE, "\t"))
    return parsed.select(
        "consorcio", "numero", "piso", "departamento",
        text.decimal_comma(F.col("coeficiente"), "decimal(5,2)").alias("coeficiente"),
        text.decimal_comma(F.col("m2"), "decimal(10,2)").alias("m2"),
    )


@query("src_pagos", """
SELECT id_pago, strftime(fecha, '%d/%m/%Y') AS fecha, cvu,
       '$ ' || (importe_cents // 100) || '.' || lpad((importe_cents % 100)::VARCHAR, 2, '0') AS valor
FROM pago
""")
def src_pagos(star: Star) -> DataFrame:
    return _good(parse_lines(src.payment_lines(star), schemas.PAYMENT_FILE, ","))


@query("src_personas", src.PERSON_SQL + """
SELECT ' ' || nombre AS nombre, apellido, dni::BIGINT AS dni, replace(email, '@', ' @') AS email,
       telefono::BIGINT AS telefono, cvu, rol_id % 2 AS inquilino
FROM linea_persona
""")
def src_personas(star: Star) -> DataFrame:
    return _good(parse_lines(src.person_lines(star), schemas.PERSON_FILE, ";"))


@query("src_servicios_json", src.DOCUMENT_SQL + """
SELECT anio, consorcio, CASE mes WHEN 5 THEN 'mayo ' ELSE (ARRAY['enero', 'febrero', 'marzo', 'abril', 'mayo',
         'junio', 'julio', 'agosto', 'septiembre', 'octubre', 'noviembre', 'diciembre'])[mes] END AS mes,
       MAX(importe_texto) FILTER (tipo_servicio = 'BANCARIOS') AS bancarios,
       MAX(importe_texto) FILTER (tipo_servicio = 'LIMPIEZA') AS limpieza,
       MAX(importe_texto) FILTER (tipo_servicio = 'ADMINISTRACION') AS administracion,
       MAX(importe_texto) FILTER (tipo_servicio = 'SEGUROS') AS seguros,
       MAX(importe_texto) FILTER (tipo_servicio = 'GASTOS GENERALES') AS generales,
       MAX(importe_texto) FILTER (tipo_servicio = 'SERVICIOS PUBLICOS-Agua') AS agua,
       MAX(importe_texto) FILTER (tipo_servicio = 'SERVICIOS PUBLICOS-Luz') AS luz
FROM texto_servicio GROUP BY consorcio, anio, mes
""")
def src_servicios_json(star: Star) -> DataFrame:
    docs = parse_documents(src.cost_document_arrays(star))
    names = ("bancarios", "limpieza", "administracion", "seguros", "generales", "agua", "luz")
    return docs.select(
        "anio", F.col("`Nombre del consorcio`").alias("consorcio"), F.col("Mes").alias("mes"),
        *[F.col(f"`{s}`").alias(n) for s, n in zip(text.SERVICES, names)],
    )


@query("unpivot_services", src.DOCUMENT_SQL + """
SELECT consorcio, anio, mes, tipo_servicio, importe_texto
FROM documento CROSS JOIN servicio LEFT JOIN texto_servicio USING (consorcio_id, consorcio, anio, mes, tipo_servicio)
""")
def unpivot(star: Star) -> DataFrame:
    return unpivot_services(
        src.service_documents(star).drop("consorcio_id"), ["consorcio", "anio", "mes"]
    )


@query("clean_blank_rows", """
SELECT o_orderkey AS id_pago, lpad(o_custkey::VARCHAR, 22, '0') AS cvu FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
""")
def clean_blank_rows(star: Star) -> DataFrame:
    """Orders in status P play empty lines, those of low priority lines with a blank account."""
    filled = F.col("o_orderstatus") != "P"
    account = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("  ")).otherwise(
        text.zero_pad(F.col("o_custkey"), 22)
    )
    raw = star.read("orders").select(
        F.when(filled, F.col("o_orderkey")).alias("id_pago"),
        F.when(filled, account).otherwise(F.lit(" ")).alias("cvu"),
    )
    return m.require_keys(m.drop_blank_rows(raw), ["cvu"])


@query("load_reject_split", """
SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END::VARCHAR AS id_pago,
       CASE WHEN o_orderstatus = 'P' THEN 'n' || o_orderkey || ',' || lpad(o_custkey::VARCHAR, 22, '0') END AS rechazada
FROM orders
""")
def load_reject_split(star: Star) -> DataFrame:
    """Orders in status P play lines whose id is no number."""
    mark = F.when(F.col("o_orderstatus") == "P", "n").otherwise("")
    lines = star.read("orders").select(
        F.concat(
            mark, F.col("o_orderkey").cast("string"), F.lit(","), text.zero_pad(F.col("o_custkey"), 22)
        ).alias("linea")
    )
    layout = schemas.PAYMENT_FILE["id_pago"], schemas.PAYMENT_FILE["cvu"]
    loaded = split_rejects(parse_lines(lines, schemas.T.StructType(list(layout)), ","))
    both = loaded.good.select("id_pago", F.lit(None).cast("string").alias("rechazada")).unionByName(
        loaded.rejected.select(F.lit(None).cast("bigint").alias("id_pago"), F.col(CORRUPT).alias("rechazada"))
    )
    return numbers_as_text(both, "id_pago")


@query("parse_payment_line", """
SELECT id_pago, 1::BIGINT AS forma_pago_id, cvu, fecha::VARCHAR AS fecha, importe_cents FROM pago
""")
def parse_payment_line(star: Star) -> DataFrame:
    return ingest.parse_payments(src_pagos(star))


@query("split_company_detail", src.SUPPLIER_SQL + """
SELECT s_suppkey, empresa, detalle FROM proveedor_limpio
""")
def split_company_detail(star: Star) -> DataFrame:
    return src_proveedores(star).select(
        "s_suppkey",
        text.company_name(F.col("empresa_detalle")).alias("empresa"),
        text.cost_detail(F.col("empresa_detalle"), F.col("detalle_adicional")).alias("detalle"),
    )


@query("normalize_category", src.SUPPLIER_SQL + """
SELECT s_suppkey, categoria, categoria_nueva FROM proveedor_limpio
""")
def normalize_category(star: Star) -> DataFrame:
    return src_proveedores(star).select(
        "s_suppkey",
        text.normalize_category(F.col("tipo_gasto")).alias("categoria"),
        text.utility_category(F.col("empresa_detalle")).alias("categoria_nueva"),
    )


@query("scalar_string", """
SELECT id, upper(nombre) AS mayusculas, lower(apellido) AS minusculas, 'x' || trim('  ' || apellido || ' ') || 'x' AS recortado,
       replace(email, '@', '') AS sin_arroba, dni || '-' || rol_id AS unido, left(apellido, 3) AS izquierda,
       right(nombre, 4) AS derecha
FROM persona
""")
def scalar_string(star: Star) -> DataFrame:
    return star.persons().select(
        "id",
        F.upper("nombre").alias("mayusculas"),
        F.lower("apellido").alias("minusculas"),
        F.concat(
            F.lit("x"), F.trim(F.concat(F.lit("  "), F.col("apellido"), F.lit(" "))), F.lit("x")
        ).alias("recortado"),
        F.replace("email", F.lit("@"), F.lit("")).alias("sin_arroba"),
        F.concat("dni", F.lit("-"), F.col("rol_id").cast("string")).alias("unido"),
        F.left("apellido", F.lit(3)).alias("izquierda"),
        F.right("nombre", F.lit(4)).alias("derecha"),
    )


@query("scalar_null_logic", """
SELECT id, COALESCE(CASE WHEN c_acctbal < 0 THEN NULL ELSE email END, 'sin correo') AS email,
       NULLIF(trim(CASE WHEN apellido = 'BUILDING' THEN '  ' ELSE apellido END), '') AS apellido,
       COALESCE(NULLIF(trim(CASE WHEN apellido = 'BUILDING' THEN ' ' ELSE apellido END), ''), nombre) AS visible
FROM persona
""")
def scalar_null_logic(star: Star) -> DataFrame:
    customer = star.read("customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    blank = F.when(F.col("apellido") == "BUILDING", F.lit("  ")).otherwise(F.col("apellido"))
    return star.persons().join(customer, "id").select(
        "id",
        F.coalesce(F.when(F.col("c_acctbal") >= 0, F.col("email")), F.lit("sin correo")).alias("email"),
        text.blank_to_null(blank).alias("apellido"),
        F.coalesce(text.blank_to_null(blank), F.col("nombre")).alias("visible"),
    )


@query("scalar_format", f"""
SELECT id_pago, {text_of("importe_cents")} AS importe, strftime(fecha, '%Y-%m') AS periodo,
       lpad(month(fecha)::VARCHAR, 2, '0') AS mes
FROM pago
""")
def scalar_format(star: Star) -> DataFrame:
    return star.payments().select(
        "id_pago",
        money.amount_text(F.col("importe_cents")).alias("importe"),
        F.date_format("fecha", "yyyy-MM").alias("periodo"),
        text.zero_pad(F.month("fecha"), 2).alias("mes"),
    )


@query("scalar_date", """
SELECT id_pago, (fecha + INTERVAL 1 MONTH)::DATE::VARCHAR AS mes_siguiente, (fecha - 7)::VARCHAR AS semana_antes,
       date_trunc('month', fecha)::DATE::VARCHAR AS periodo, last_day(fecha)::VARCHAR AS fin_de_mes,
       (date_trunc('month', fecha)::DATE + 9)::VARCHAR AS vencimiento_1,
       (date_trunc('month', fecha)::DATE + 14)::VARCHAR AS vencimiento_2,
       date_diff('day', DATE '1995-01-01', fecha) AS dias, year(fecha) AS anio, day(fecha) AS dia
FROM pago
""")
def scalar_date(star: Star) -> DataFrame:
    date = F.col("fecha")
    period = dates.period_of(date)
    return star.payments().select(
        "id_pago",
        F.add_months(date, 1).alias("mes_siguiente"),
        F.date_add(date, -7).alias("semana_antes"),
        period.alias("periodo"),
        F.last_day(date).alias("fin_de_mes"),
        dates.due_date(period, dates.FIRST_DUE_DAY).alias("vencimiento_1"),
        dates.due_date(period, dates.SECOND_DUE_DAY).alias("vencimiento_2"),
        F.datediff(date, F.make_date(F.lit(1995), F.lit(1), F.lit(1))).alias("dias"),
        F.year(date).alias("anio"),
        F.dayofmonth(date).alias("dia"),
    )


@query("scalar_math", f"""
SELECT id_pago, importe_cents % 1000 AS resto, abs(importe_cents - 20000000) AS distancia,
       {rounded("importe_cents - 20000000", "100")} AS pesos, {rounded("importe_cents * 5", "100")} AS interes_cents
FROM pago
""")
def scalar_math(star: Star) -> DataFrame:
    value = F.col("importe_cents")
    return star.payments().select(
        "id_pago",
        (value % 1000).alias("resto"),
        F.abs(value - 20000000).alias("distancia"),
        money.div_round(value - 20000000, F.lit(100)).alias("pesos"),
        money.share_of(value, F.lit(money.DETAIL_RATE_BP)).alias("interes_cents"),
    )


@query("week_of_year_us", """
SELECT id_pago, year(fecha) AS anio,
       (dayofyear(fecha) + dayofweek(date_trunc('year', fecha)::DATE) - 1) // 7 + 1 AS semana
FROM pago
""")
def week_of_year_us(star: Star) -> DataFrame:
    return star.payments().select(
        "id_pago", F.year("fecha").alias("anio"), dates.us_week(F.col("fecha")).alias("semana")
    )


@query("month_name_number", """
SELECT id_pago, monthname(fecha) AS nombre_mes, month(fecha) AS mes FROM pago
""")
def month_name_number(star: Star) -> DataFrame:
    spanish = F.concat(F.lit(" "), F.initcap(dates.spanish_month_name(F.month("fecha"))), F.lit(" "))
    return star.payments().select(
        "id_pago",
        F.date_format("fecha", "MMMM").alias("nombre_mes"),
        dates.spanish_month_number(spanish).alias("mes"),
    )


@query("nth_business_day", """
SELECT id_pago, id_pago % 25 AS n, dia::VARCHAR AS dia
FROM pago LEFT JOIN (
  SELECT date_trunc('month', d)::DATE AS periodo, d::DATE AS dia,
         ROW_NUMBER() OVER (PARTITION BY date_trunc('month', d) ORDER BY d) AS n
  FROM generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) g(d)
  WHERE dayofweek(d) NOT IN (0, 6)
  UNION ALL SELECT periodo, periodo, 0 FROM mes) h
ON h.periodo = date_trunc('month', fecha)::DATE AND h.n = id_pago % 25
""")
def nth_business_day(star: Star) -> DataFrame:
    n = (F.col("id_pago") % 25).cast("int")
    return star.payments().select(
        "id_pago", n.alias("n"),
        dates.nth_business_day(F.year("fecha"), F.month("fecha"), n).alias("dia"),
    )


@query("clean_number", """,
texto AS (
  SELECT id_pago, importe_cents, CASE id_pago % 3
           WHEN 0 THEN translate(format('{:,.2f}', importe_cents / 100.0), ',.', '.,')
           WHEN 1 THEN format('{:,.2f}', importe_cents / 100.0)
           ELSE translate(format('{:,.2f}', importe_cents / 100.0), '.', ',') END AS x
  FROM pago)
SELECT id_pago, importe_cents / 100.0 AS importe,
       TRY_CAST(replace(replace(x, '.', ''), ',', '.') AS DECIMAL(18, 2))::DOUBLE AS solo_coma
FROM texto
""")
def clean_number(star: Star) -> DataFrame:
    written = amount_shapes(F.col("importe_cents"), F.col("id_pago") % 3)
    return star.payments().select("id_pago", written.alias("x")).select(
        "id_pago",
        text.clean_number(F.col("x")).alias("importe"),
        text.clean_number(F.col("x"), comma_decimals_only=True).alias("solo_coma"),
    )


@query("invoice_number", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, importe_cents, fecha::VARCHAR AS fecha,
       lpad((consorcio_id % 1000)::VARCHAR, 3, '0') || strftime(fecha, '%y%m')
         || lpad((l_orderkey % 1000)::VARCHAR, 3, '0') AS nro_factura
FROM gasto
""")
def invoice_number(star: Star) -> DataFrame:
    return star.cost_items().select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "importe_cents", "fecha",
        text.invoice_number(F.col("consorcio_id"), F.col("fecha"), F.col("l_orderkey")).alias("nro_factura"),
    )


@query("hash_choose", """
SELECT uf_id, (ARRAY['local', 'departamento', 'duplex'])[('0x' || substr(md5(uf_id::VARCHAR), 1, 8))::BIGINT % 3 + 1] AS tipo
FROM unidad_base
""")
def hash_choose(star: Star) -> DataFrame:
    return star.bare_units().select(
        "uf_id", text.choose_by_hash(F.col("uf_id"), schemas.UNIT_TYPES).alias("tipo")
    )


PII_COLUMNS = ("dni", "email", "cvu")


def _encrypted(star: Star) -> DataFrame:
    """Persons with dni, e-mail and account encrypted; the bytes differ on every run."""
    return pii.encrypt_columns(star.persons(), PII_COLUMNS, "id", TEST_KEY)


@query("encrypt_pii", f"""
SELECT id, {", ".join(f"strlen({c}) + 28 AS {c}_bytes, 'true' AS {c}_oculto, 'true' AS {c}_vuelve" for c in PII_COLUMNS)} FROM persona
""")
def encrypt_pii(star: Star) -> DataFrame:
    """What does not vary of the encrypted columns: length, that they hide the clear text, and that they decrypt to it."""
    return pii.encryption_facts(star.persons(), PII_COLUMNS, "id", TEST_KEY)


@query("decrypt_pii_view", """
SELECT id, nombre, apellido, dni, email, cvu FROM persona
""")
def decrypt_pii_view(star: Star) -> DataFrame:
    return pii.decrypt_columns(_encrypted(star), PII_COLUMNS, "id", TEST_KEY).select(
        "id", "nombre", "apellido", *PII_COLUMNS
    )
