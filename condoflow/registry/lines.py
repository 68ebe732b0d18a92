"""Text lines of the monthly files, made from columns of the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, money, text
from ..sources.text_lines import amount_shapes, document_array
from .star import Star

# The supplier lines of the test tables cycle through these forms:
# (expense type, company cell, extra detail), {} standing for the supplier's name.
SUPPLIER_FORMS = (
    ("SERVICIOS PUBLICOS", "AYSA ", "Cuenta {}"),
    ("GASTOS BANCARIOS", "{} - Comision", ""),
    ("GASTOS DE LIMPIEZA", "Serv. Limpieza", "{}"),
    ("SEGUROS", "{} - Integral de consorcio", ""),
    ("GASTOS DE ADMINISTRACION", "{} - Honorarios", ""),
    ("Gastos varios", "{}", " "),
)

SUPPLIER_SQL = """,
proveedor AS (
  SELECT s_suppkey, s_acctbal, s_nationkey::BIGINT AS consorcio_id, n_name AS consorcio,
         CASE s_suppkey % 6 WHEN 0 THEN 'SERVICIOS PUBLICOS' WHEN 1 THEN 'GASTOS BANCARIOS'
              WHEN 2 THEN 'GASTOS DE LIMPIEZA' WHEN 3 THEN 'SEGUROS'
              WHEN 4 THEN 'GASTOS DE ADMINISTRACION' ELSE 'Gastos varios' END AS tipo_gasto,
         CASE s_suppkey % 6 WHEN 0 THEN 'AYSA ' WHEN 1 THEN s_name || ' - Comision'
              WHEN 2 THEN 'Serv. Limpieza' WHEN 3 THEN s_name || ' - Integral de consorcio'
              WHEN 4 THEN s_name || ' - Honorarios' ELSE s_name END AS empresa_detalle,
         CASE s_suppkey % 6 WHEN 0 THEN 'Cuenta ' || s_name WHEN 2 THEN s_name WHEN 5 THEN ' ' END
           AS detalle_adicional
  FROM supplier JOIN nation ON n_nationkey = s_nationkey),
proveedor_limpio AS (
  SELECT s_suppkey, s_acctbal, consorcio_id, consorcio,
         CASE s_suppkey % 6 WHEN 0 THEN 'SERVICIOS PUBLICOS' WHEN 1 THEN 'BANCARIOS' WHEN 2 THEN 'LIMPIEZA'
              WHEN 3 THEN 'SEGUROS' WHEN 4 THEN 'ADMINISTRACION' ELSE 'GASTOS VARIOS' END AS categoria,
         CASE WHEN trim(empresa_detalle) = 'AYSA' THEN 'SERVICIOS PUBLICOS' END AS categoria_nueva,
         trim(split_part(empresa_detalle, '-', 1)) AS empresa,
         COALESCE(NULLIF(trim(detalle_adicional), ''), NULLIF(trim(
           CASE WHEN strpos(empresa_detalle, '-') = 0 THEN empresa_detalle
                ELSE substr(empresa_detalle, strpos(empresa_detalle, '-') + 1) END), '')) AS detalle
  FROM proveedor)
"""

DOCUMENT_SQL = """,
suma_servicio AS (
  SELECT consorcio_id, nombre AS consorcio, year(fecha) AS anio, month(fecha) AS mes, tipo_servicio,
         SUM(importe_cents)::BIGINT AS importe_cents
  FROM gasto JOIN consorcio ON id = consorcio_id WHERE NOT extraordinario GROUP BY ALL),
texto_servicio AS (
  SELECT consorcio_id, consorcio, anio, mes, tipo_servicio, importe_cents,
         CASE mes % 3
           WHEN 0 THEN translate(format('{:,.2f}', importe_cents / 100.0), ',.', '.,')
           WHEN 1 THEN format('{:,.2f}', importe_cents / 100.0)
           ELSE translate(format('{:,.2f}', importe_cents / 100.0), '.', ',') END AS importe_texto
  FROM suma_servicio),
documento AS (SELECT DISTINCT consorcio_id, consorcio, anio, mes FROM texto_servicio),
servicio(tipo_servicio) AS (
  VALUES ('BANCARIOS'), ('LIMPIEZA'), ('ADMINISTRACION'), ('SEGUROS'), ('GASTOS GENERALES'),
         ('SERVICIOS PUBLICOS-Agua'), ('SERVICIOS PUBLICOS-Luz'))
"""


def building_lines(star: Star) -> DataFrame:
    sizes = star.bare_units().groupBy("consorcio_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m2").alias("m2")
    )
    names = star.buildings().select(F.col("id").alias("consorcio_id"), "nombre", "direccion")
    return names.join(sizes, "consorcio_id").select(
        F.concat_ws(
            ",", F.concat(F.lit("Consorcio "), F.col("consorcio_id").cast("string")), "nombre", "direccion",
            F.col("n").cast("string"), F.col("m2").cast("string"),
        ).alias("linea")
    )


def supplier_lines(star: Star) -> DataFrame:
    supplier, nation = star.read("supplier"), star.read("nation")
    name = F.col("s_name")

    def form(part: int) -> Column:
        texts = [f[part].split("{}") for f in SUPPLIER_FORMS]
        cells = [F.lit(t[0]) if len(t) == 1 else F.concat(F.lit(t[0]), name, F.lit(t[1])) for t in texts]
        return F.get(F.array(*cells), (F.col("s_suppkey") % len(SUPPLIER_FORMS)).cast("int"))

    return supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", "s_acctbal", F.col("s_nationkey").cast("bigint").alias("consorcio_id"),
        F.concat_ws(";", form(0), form(1), form(2), "n_name").alias("linea"),
    )


def named_units(star: Star, units: DataFrame | None = None) -> DataFrame:
    """Units with their building's name."""
    names = star.building_names().select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    return (star.bare_units() if units is None else units).join(names, "consorcio_id")


def unit_holder_lines(star: Star) -> DataFrame:
    return named_units(star).select(
        "uf_id",
        F.concat_ws(
            "|", "cvu", "consorcio", F.col("numero").cast("string"), "piso", "departamento"
        ).alias("linea"),
    )


def unit_size_lines(star: Star) -> DataFrame:
    percent = F.translate(money.plain_text(F.col("pct_bp")), ".", ",")
    return named_units(star, star.units()).select(
        "uf_id",
        F.concat_ws(
            "\t", F.concat(F.col("consorcio"), F.lit(" ")), F.col("numero").cast("string"), "piso", "departamento",
            percent, F.concat(F.col("m2").cast("string"), F.lit(",50")), F.lit("SI"), F.lit("NO"),
            F.lit("3"), F.lit("0"),
        ).alias("linea"),
    )


def payment_lines(star: Star) -> DataFrame:
    return star.payments().select(
        F.concat_ws(
            ",", F.col("id_pago").cast("string"), F.date_format("fecha", "dd/MM/yyyy"), "cvu",
            F.concat(F.lit("$ "), money.plain_text(F.col("importe_cents"))),
        ).alias("linea")
    )


def person_lines(star: Star) -> DataFrame:
    """Lines with a blank inside the e-mail and, for some holders, a shared account."""
    account = F.when(F.col("c_mktsegment") == "MACHINERY", text.zero_pad(F.col("c_custkey") - F.col("c_custkey") % 10, 22))
    persons = star.persons().join(star.read("customer"), F.col("id") == F.col("c_custkey"))
    return persons.select(
        F.concat_ws(
            ";", F.concat(F.lit(" "), F.col("nombre")), "apellido", F.col("id").cast("string"),
            F.replace(F.col("email"), F.lit("@"), F.lit(" @")), "telefono",
            F.coalesce(account, F.col("cvu")), (F.col("rol_id") % 2).cast("string"),
        ).alias("linea")
    )


PERSON_SQL = """,
linea_persona AS (
  SELECT nombre, apellido, dni, email, telefono, rol_id,
         CASE WHEN apellido = 'MACHINERY' THEN lpad((id - id % 10)::VARCHAR, 22, '0') ELSE cvu END AS cvu
  FROM persona),
persona_unica AS (
  SELECT * FROM linea_persona
  WHERE cvu IN (SELECT cvu FROM linea_persona GROUP BY cvu HAVING COUNT(*) = 1))
"""


def service_documents(star: Star) -> DataFrame:
    """Ordinary costs per building, year and month with a text amount per service."""
    monthly = star.ordinary_costs().groupBy(
        "consorcio_id", F.year("fecha").alias("anio"), F.month("fecha").alias("mes")
    ).agg(*[F.sum(F.when(F.col("tipo_servicio") == s, F.col("importe_cents"))).alias(s) for s in text.SERVICES])
    names = star.building_names().select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    return monthly.join(names, "consorcio_id").select(
        "consorcio_id", "consorcio", "anio", "mes",
        *[amount_shapes(F.col(f"`{s}`"), F.col("mes") % 3).alias(s) for s in text.SERVICES],
    )


def cost_document_arrays(star: Star) -> DataFrame:
    """One JSON array per building and year; May comes with a trailing blank, as in the files."""
    month = F.when(F.col("mes") == 5, F.lit("mayo ")).otherwise(dates.spanish_month_name(F.col("mes")))
    return document_array(
        service_documents(star), ["consorcio_id", "anio"], "mes", F.col("consorcio"), month
    )
