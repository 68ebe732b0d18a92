"""Registration of queries and the common tables of the checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.text import SERVICES
from .star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, amounts as DOUBLE, those too wide for it and dates as text."""
    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return c.cast("double" if field.dataType.precision <= 18 else "string").alias(field.name)
        if isinstance(field.dataType, T.IntegerType):
            return c.cast("bigint").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.BooleanType)):
            return c.cast("string").alias(field.name)
        return c

    return df.select(*[column(f) for f in df.schema])


def numbers_as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Whole numbers that may be null as text: data frames of some tools turn them into floats."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def query(name: str, sql: str | None = None):
    """Register a function of the star tables under ``name``, with the SQL giving the same rows."""
    def register(build: Callable[[Star], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: plain(build(Star(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = f"{COMMON_TABLES}\n{sql.strip()}"
        return build

    return register


def rounded(num: str, den: str) -> str:
    """SQL of an integer quotient with halves away from zero."""
    return (
        f"(CASE WHEN ({num}) < 0 THEN -((-2 * ({num}) + ({den})) // (2 * ({den}))) "
        f"ELSE (2 * ({num}) + ({den})) // (2 * ({den})) END)::BIGINT"
    )


def text_of(cents: str) -> str:
    """SQL of cents as text with thousands separators."""
    return f"format('{{:,.2f}}', ({cents}) / 100.0)"


SERVICE_CASE = "CASE l_linenumber " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SERVICES, 1)) + " END"

COMMON_TABLES = f"""
WITH RECURSIVE
consorcio AS (
  SELECT n_nationkey::BIGINT AS id, n_name AS nombre, 'Calle ' || n_name AS direccion,
         COALESCE(saldo, 0)::BIGINT AS saldo_cents
  FROM nation LEFT JOIN (
    SELECT s_nationkey, SUM(ROUND(s_acctbal * 100)::BIGINT) AS saldo FROM supplier GROUP BY 1
  ) ON s_nationkey = n_nationkey),
persona AS (
  SELECT c_custkey AS id, c_name AS nombre, c_mktsegment AS apellido, lpad(c_custkey::VARCHAR, 8, '0') AS dni,
         replace(lower(c_name), '#', '.') || '@example.org' AS email, lpad(c_custkey::VARCHAR, 22, '0') AS cvu,
         '11' || lpad(c_custkey::VARCHAR, 8, '0') AS telefono, c_custkey % 2 + 1 AS rol_id, c_acctbal
  FROM customer),
unidad_base AS (
  SELECT c_custkey AS uf_id, lpad(c_custkey::VARCHAR, 22, '0') AS cvu, c_nationkey::BIGINT AS consorcio_id,
         chr((65 + c_custkey % 5)::INTEGER) AS departamento,
         CASE WHEN c_custkey % 10 = 0 THEN 'PB' ELSE (c_custkey % 10)::VARCHAR END AS piso,
         c_custkey AS numero, 30 + c_custkey % 70 AS m2
  FROM customer),
superficie AS (SELECT consorcio_id, SUM(m2 * 100)::BIGINT AS total_m2 FROM unidad_base GROUP BY 1),
unidad AS (
  SELECT u.*, {rounded("m2 * 100 * 10000", "total_m2")} AS pct_bp,
         m2 * 100 AS share_num, total_m2 AS share_den
  FROM unidad_base u JOIN superficie USING (consorcio_id)),
pago AS (
  SELECT o_orderkey AS id_pago, lpad(o_custkey::VARCHAR, 22, '0') AS cvu, o_orderdate::DATE AS fecha,
         ROUND(o_totalprice * 100)::BIGINT AS importe_cents
  FROM orders),
gasto AS (
  SELECT s_nationkey::BIGINT AS consorcio_id, l_shipdate::DATE AS fecha,
         ROUND(l_extendedprice * 100)::BIGINT AS importe_cents, {SERVICE_CASE} AS tipo_servicio,
         l_returnflag = 'R' AS extraordinario, l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
costo AS (
  SELECT consorcio_id, fecha, CASE WHEN extraordinario THEN 0 ELSE importe_cents END AS ord_cents,
         CASE WHEN extraordinario THEN importe_cents ELSE 0 END AS ext_cents
  FROM gasto),
mes AS (
  SELECT i, (DATE '1995-01-01' + to_months(i::INTEGER))::DATE AS periodo FROM range(84) t(i)),
expensa AS (SELECT id AS consorcio_id, periodo, i FROM consorcio CROSS JOIN mes),
costo_mes AS (
  SELECT consorcio_id, date_trunc('month', fecha)::DATE AS periodo,
         SUM(ord_cents)::BIGINT AS ord_cents, SUM(ext_cents)::BIGINT AS ext_cents
  FROM costo GROUP BY 1, 2),
aplicado AS (
  SELECT id_pago, uf_id, u.consorcio_id, e.periodo, fecha, importe_cents
  FROM pago JOIN unidad_base u USING (cvu)
  JOIN expensa e ON e.consorcio_id = u.consorcio_id
                AND e.periodo = (date_trunc('month', fecha) - INTERVAL 1 MONTH)::DATE),
recibido AS (
  SELECT uf_id, periodo, SUM(importe_cents)::BIGINT AS pagado_cents, MIN(fecha) AS primera_fecha
  FROM aplicado GROUP BY 1, 2),
parte AS (
  SELECT u.uf_id, u.consorcio_id, e.periodo, i, share_num, share_den, COALESCE(c.ord_cents, 0) AS g_ord,
         COALESCE(c.ext_cents, 0) AS g_ext, COALESCE(r.pagado_cents, 0) AS pagado_cents, r.primera_fecha
  FROM unidad u JOIN expensa e ON e.consorcio_id = u.consorcio_id
  LEFT JOIN costo_mes c ON c.consorcio_id = u.consorcio_id AND c.periodo = e.periodo
  LEFT JOIN recibido r ON r.uf_id = u.uf_id AND r.periodo = e.periodo),
deuda AS (
  SELECT uf_id, i, 0::BIGINT AS deuda_cents,
         {rounded("(g_ord + g_ext)::HUGEINT * share_num", "share_den")} AS total_cents, pagado_cents
  FROM parte WHERE i = 0
  UNION ALL
  SELECT p.uf_id, p.i, d.total_cents - d.pagado_cents,
         {rounded("(p.g_ord + p.g_ext)::HUGEINT * p.share_num * 20 + ((d.total_cents - d.pagado_cents)::HUGEINT * 20"
                  " + GREATEST(d.total_cents - d.pagado_cents, 0)) * p.share_den", "p.share_den * 20")}, p.pagado_cents
  FROM deuda d JOIN parte p ON p.uf_id = d.uf_id AND p.i = d.i + 1),
emitido AS (
  SELECT uf_id, consorcio_id, periodo, i, {rounded("g_ord::HUGEINT * share_num", "share_den")} AS ord_cents,
         {rounded("g_ext::HUGEINT * share_num", "share_den")} AS ext_cents, d.deuda_cents,
         {rounded("GREATEST(d.deuda_cents, 0) * 500", "10000")} AS interes_cents, d.total_cents,
         p.pagado_cents, primera_fecha,
         COALESCE(LAG(p.pagado_cents) OVER (PARTITION BY uf_id ORDER BY i), 0) AS pagado_anterior_cents,
         periodo + 9 AS vencimiento_1, periodo + 14 AS vencimiento_2
  FROM parte p JOIN deuda d USING (uf_id, i)),
detalle AS (
  SELECT *, CASE WHEN primera_fecha IS NULL THEN interes_cents
                 WHEN primera_fecha > vencimiento_2
                   THEN {rounded("(total_cents - pagado_anterior_cents) * 500", "10000")}
                 WHEN primera_fecha > vencimiento_1
                   THEN {rounded("(total_cents - pagado_anterior_cents) * 200", "10000")}
                 ELSE 0 END AS mora_cents
  FROM emitido),
ingreso_mes AS (
  SELECT consorcio_id, date_trunc('month', fecha)::DATE AS m, SUM(importe_cents)::BIGINT AS total,
         SUM(CASE WHEN day(fecha) >= 10 THEN importe_cents ELSE 0 END)::BIGINT AS desde_1,
         SUM(CASE WHEN day(fecha) > 15 THEN importe_cents ELSE 0 END)::BIGINT AS tras_2
  FROM pago JOIN unidad_base USING (cvu) GROUP BY 1, 2),
ingreso AS (
  SELECT consorcio_id, periodo, SUM(a)::BIGINT AS ingresos_cents, SUM(b)::BIGINT AS adeudados_cents,
         SUM(c)::BIGINT AS adelantados_cents
  FROM (SELECT consorcio_id, m AS periodo, total AS a, desde_1 AS b, 0 AS c FROM ingreso_mes
        UNION ALL
        SELECT consorcio_id, (m + INTERVAL 1 MONTH)::DATE, 0, 0, tras_2 FROM ingreso_mes)
  GROUP BY 1, 2),
flujo AS (
  SELECT e.consorcio_id, e.periodo, COALESCE(ingresos_cents, 0) AS ingresos_cents,
         COALESCE(adeudados_cents, 0) AS adeudados_cents, COALESCE(adelantados_cents, 0) AS adelantados_cents,
         COALESCE(ord_cents, 0) + COALESCE(ext_cents, 0) AS egresos_cents
  FROM expensa e LEFT JOIN ingreso USING (consorcio_id, periodo) LEFT JOIN costo_mes USING (consorcio_id, periodo)),
encabezado AS (
  SELECT consorcio_id, periodo, ingresos_cents, adeudados_cents, adelantados_cents, egresos_cents,
         (saldo_cents + acumulado - ingresos_cents + egresos_cents)::BIGINT AS saldo_anterior_cents,
         (saldo_cents + acumulado)::BIGINT AS saldo_cierre_cents
  FROM (SELECT *, SUM(ingresos_cents - egresos_cents) OVER (PARTITION BY consorcio_id ORDER BY periodo) AS acumulado
        FROM flujo) f JOIN consorcio ON id = consorcio_id)
"""
