"""Queries: table maintenance, filters, joins, aggregations, windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from .. import schemas
from ..functions import dates, money, text
from ..operators import maintenance as m, numbering, quality, ranking
from ..plans import annexes, ingest, reports, statements as st
from . import inputs, lines as src
from .base import numbers_as_text, query, rounded
from .star import AS_OF, EXTRAORDINARY_FLAG, RANGE, Star

LOADED_UNTIL = dt.date(1998, 1, 1)  # payments before it count as loaded already
RECENT = dt.date(2001, 1, 1)


# ---- table maintenance ----

@query("fill_nulls_from", """
SELECT uf_id, m2, departamento FROM unidad_base
""")
def fill_nulls_from(star: Star) -> DataFrame:
    """Units of holders in debt lack size and department and get them from the size file."""
    known = star.read("customer").select(F.col("c_custkey").alias("uf_id"), (F.col("c_acctbal") >= 0).alias("known"))
    source = star.bare_units().select("uf_id", "m2", "departamento")
    current = source.join(known, "uf_id").select(
        "uf_id",
        F.when(F.col("known"), F.col("m2")).alias("m2"),
        F.when(F.col("known"), F.col("departamento")).alias("departamento"),
    )
    return m.fill_nulls_from(current, source, ["uf_id"], ["m2", "departamento"])


@query("seed_if_absent", """
SELECT descripcion, MAX(confirmacion) AS confirmacion FROM (
  SELECT DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN 'Transferencia Bancaria' ELSE o_orderpriority END
           AS descripcion, 'Comprobante' AS confirmacion FROM orders
  UNION ALL VALUES ('Transferencia Bancaria', 'Comprobante'), ('Efectivo en Oficina', 'Recibo Manual'),
                   ('Mercado Pago/Billetera', 'ID de Transaccion'))
GROUP BY descripcion
""")
def seed_if_absent(star: Star) -> DataFrame:
    """Payment methods in use plus the seeds among them that are missing."""
    used = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(schemas.PAYMENT_METHOD_SEEDS[0][0])).otherwise(
        F.col("o_orderpriority")
    )
    existing = star.read("orders").select(used.alias("descripcion")).distinct().withColumn(
        "confirmacion", F.lit("Comprobante")
    )
    seeds = star.spark.createDataFrame(list(schemas.PAYMENT_METHOD_SEEDS), "descripcion string, confirmacion string")
    return m.seed_if_absent(existing, seeds, "descripcion")


@query("discover_parents", """
SELECT DISTINCT nombre, 'Dirección desconocida' AS direccion
FROM unidad_base JOIN consorcio c ON c.id = consorcio_id
WHERE nombre NOT IN (SELECT n_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name IN ('ASIA', 'EUROPE'))
""")
def discover_parents(star: Star) -> DataFrame:
    """Buildings of the unit file that are not among the registered ones, those of two regions."""
    children = src.named_units(star).select(F.concat(F.lit(" "), F.col("consorcio"), F.lit(" ")).alias("nombre"))
    region = star.read("region").filter(F.col("r_name").isin("ASIA", "EUROPE"))
    nation = star.read("nation")
    parents = nation.join(region, nation.n_regionkey == region.r_regionkey, "left_semi").select(
        F.col("n_name").alias("nombre")
    )
    return m.discover_parents(children, parents, "nombre", schemas.UNKNOWN_ADDRESS)


COST_ORDER = ["consorcio_id", "fecha", "tipo_servicio", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "importe_cents"]


@query("assign_surrogate_id", """
SELECT ROW_NUMBER() OVER (ORDER BY consorcio_id, fecha, tipo_servicio, l_orderkey, l_partkey, l_suppkey,
                          l_linenumber, importe_cents) + (SELECT MAX(id_pago) FROM pago) AS id,
       consorcio_id, fecha::VARCHAR AS fecha, tipo_servicio, importe_cents
FROM gasto WHERE NOT extraordinario
""")
def assign_surrogate_id(star: Star) -> DataFrame:
    """Ids for all ordinary costs, going on from the largest payment id."""
    costs = star.ordinary_costs().select(*COST_ORDER)
    return numbering.continue_ids(
        costs.withColumn("id", F.lit(None).cast("bigint")), star.payments().select(F.col("id_pago").alias("id")),
        "id", COST_ORDER,
    ).select("id", "consorcio_id", "fecha", "tipo_servicio", "importe_cents")


@query("dq_violations", """
SELECT regla, COUNT(*) AS violaciones FROM (
  SELECT 'persona: email obligatorio' AS regla FROM persona WHERE c_acctbal < 0
  UNION ALL SELECT 'persona: cvu unico' FROM persona GROUP BY cvu HAVING COUNT(*) > 1
  UNION ALL SELECT 'gasto: nro_factura unico' FROM gasto
    GROUP BY lpad((consorcio_id % 1000)::VARCHAR, 3, '0') || strftime(fecha, '%y%m')
             || lpad((l_orderkey % 1000)::VARCHAR, 3, '0') HAVING COUNT(*) > 1
  UNION ALL SELECT 'unidad: cvu con pagos' FROM (SELECT DISTINCT cvu FROM unidad_base) u
    WHERE NOT EXISTS (SELECT 1 FROM pago p WHERE p.cvu = u.cvu AND p.fecha >= DATE '2001-01-01')
  UNION ALL SELECT 'pago: cvu con unidad' FROM (SELECT DISTINCT cvu FROM pago) p
    WHERE NOT EXISTS (SELECT 1 FROM unidad_base u WHERE u.cvu = p.cvu)
  UNION ALL SELECT 'proveedor: saldo no negativo' FROM supplier WHERE s_acctbal < 0
  UNION ALL SELECT 'gasto: nro_factura valido' FROM gasto WHERE l_orderkey < 0)
GROUP BY regla
""")
def dq_violations(star: Star) -> DataFrame:
    """Customers are holders and units at once; payments are checked themselves and vouch for the units that paid lately."""
    customers = star.read("customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("email"), text.zero_pad(F.col("c_custkey"), 22).alias("cvu")
    )
    invoice = text.invoice_number(F.col("consorcio_id"), F.col("fecha"), F.col("l_orderkey"))
    invoices = star.cost_items().select(F.inline(F.array(F.struct(invoice.alias("nro_factura")))))
    cvu, number = F.col("cvu"), F.col("nro_factura")
    paying, known = "unidad: cvu con pagos", "pago: cvu con unidad"
    return quality.count_violations([
        (customers, [
            quality.must_hold("persona: email obligatorio", F.col("email").isNotNull()),
            quality.must_be_unique("persona: cvu unico", cvu), quality.must_exist(paying, cvu), quality.gives(known, cvu),
        ]),
        (star.payments(), [quality.gives(paying, cvu, F.col("fecha") >= F.lit(RECENT)), quality.must_exist(known, cvu)]),
        (invoices, [
            quality.must_be_unique("gasto: nro_factura unico", number),
            quality.must_hold("gasto: nro_factura valido", quality.valid_invoice(number)),
        ]),
        (star.read("supplier"), [quality.must_hold("proveedor: saldo no negativo", F.col("s_acctbal") >= 0)]),
    ])


@query("audit_counts", """
SELECT 'TipoRol' AS tabla, COUNT(DISTINCT rol_id) AS registros FROM persona
UNION ALL SELECT 'Persona', COUNT(*) FROM persona
UNION ALL SELECT 'CuentaBancaria', COUNT(*) FROM supplier
UNION ALL SELECT 'Consorcio', COUNT(*) FROM consorcio
UNION ALL SELECT 'UnidadFuncional', COUNT(*) FROM unidad_base
UNION ALL SELECT 'Cochera', COUNT(*) FROM unidad_base
UNION ALL SELECT 'Baulera', COUNT(*) FROM unidad_base
UNION ALL SELECT 'FormaDePago', COUNT(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'Expensa', COUNT(*) FROM expensa
UNION ALL SELECT 'DetalleExpensa', COUNT(*) FROM unidad_base JOIN expensa USING (consorcio_id)
UNION ALL SELECT 'GastoOrdinario', COUNT(*) FROM gasto WHERE NOT extraordinario
UNION ALL SELECT 'GastoExtraordinario', COUNT(*) FROM gasto WHERE extraordinario
UNION ALL SELECT 'Pago', COUNT(*) FROM pago
UNION ALL SELECT 'PagoAplicado', COUNT(*) FROM aplicado
""")
def audit_counts(star: Star) -> DataFrame:
    """Lines, costs and applied payments are counted by key and multiplied, without making them."""
    units = star.bare_units()
    suppliers, items = star.read("supplier").select(F.col("s_suppkey").alias("l_suppkey")), star.read("lineitem")
    extraordinary = F.col("l_returnflag") == EXTRAORDINARY_FLAG
    payers = star.payments().filter(RANGE.has(F.col("fecha"), 1)).select("cvu")  # each settles a month of the range
    return quality.audit_counts(
        {
            "TipoRol": star.persons().select("rol_id").distinct(),
            "Persona": star.persons(),
            "CuentaBancaria": star.read("supplier"),
            "Consorcio": star.building_names(),
            "UnidadFuncional": units,
            "Cochera": units,
            "Baulera": units,
            "FormaDePago": star.read("orders").select("o_orderpriority").distinct(),
            "Expensa": star.statements(),
            "Pago": star.payments(),
        },
        {
            "DetalleExpensa": quality.joined_count([units.select("consorcio_id"), star.statements()], "consorcio_id"),
            "GastoOrdinario": quality.joined_count([items.filter(~extraordinary), suppliers], "l_suppkey"),
            "GastoExtraordinario": quality.joined_count([items.filter(extraordinary), suppliers], "l_suppkey"),
            "PagoAplicado": quality.joined_count([payers, units.select("cvu")], "cvu"),
        },
    )


@query("drop_all_duplicates", """,
cuenta AS (
  SELECT o_orderkey AS id_pago, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE lpad(o_custkey::VARCHAR, 22, '0') END AS cvu
  FROM orders)
SELECT id_pago, cvu FROM cuenta
WHERE cvu IS NULL OR cvu IN (SELECT cvu FROM cuenta GROUP BY cvu HAVING COUNT(*) = 1)
""")
def drop_all_duplicates(star: Star) -> DataFrame:
    """Orders whose customer ordered once; the account of orders in status P is unknown."""
    account = F.when(F.col("o_orderstatus") != "P", text.zero_pad(F.col("o_custkey"), 22))
    return m.drop_all_duplicates(
        star.read("orders").select(F.col("o_orderkey").alias("id_pago"), account.alias("cvu")), "cvu"
    )


# ---- filters, sort, limit, union ----

@query("filter_date_range", """
SELECT id_pago, fecha::VARCHAR AS fecha, importe_cents FROM pago
WHERE fecha BETWEEN DATE '1997-03-15' AND DATE '1999-10-31'
""")
def filter_date_range(star: Star) -> DataFrame:
    payments = star.payments()
    wanted = dates.in_range(F.col("fecha"), dt.date(1997, 3, 15), dt.date(1999, 10, 31))
    return payments.filter(wanted).select("id_pago", "fecha", "importe_cents")


@query("filter_period", """
SELECT consorcio_id, fecha::VARCHAR AS fecha, importe_cents FROM gasto WHERE year(fecha) = 1998 AND month(fecha) = 12
""")
def filter_period(star: Star) -> DataFrame:
    costs = star.cost_items().filter(dates.in_period(F.col("fecha"), 1998, 12))
    return costs.select("consorcio_id", "fecha", "importe_cents")


@query("sort_mixed", """
SELECT consorcio_id, periodo::VARCHAR AS periodo, ord_cents, ext_cents FROM costo_mes
ORDER BY consorcio_id, ord_cents DESC, periodo
""")
def sort_mixed(star: Star) -> DataFrame:
    return st.costs_by_period(star.costs()).orderBy("consorcio_id", F.desc("ord_cents"), "periodo")


@query("limit_first_n", """
SELECT id_pago, fecha::VARCHAR AS fecha, importe_cents FROM pago ORDER BY pago.fecha, pago.id_pago LIMIT 10
""")
def limit_first_n(star: Star) -> DataFrame:
    return ranking.first_rows(star.payments().select("id_pago", "fecha", "importe_cents"), 10, ["fecha", "id_pago"])


@query("union_costs", """
SELECT consorcio_id, fecha::VARCHAR AS fecha, ord_cents, ext_cents FROM costo
""")
def union_costs(star: Star) -> DataFrame:
    return st.union_costs(star.ordinary_costs(), star.extraordinary_costs())


# ---- joins ----

@query("join_star_payments", """
SELECT a.id_pago, a.uf_id, c.nombre AS consorcio, u.departamento, a.periodo::VARCHAR AS periodo,
       a.fecha::VARCHAR AS fecha, a.importe_cents, d.total_cents
FROM aplicado a JOIN detalle d ON d.uf_id = a.uf_id AND d.periodo = a.periodo
JOIN unidad_base u ON u.uf_id = a.uf_id JOIN consorcio c ON c.id = u.consorcio_id
""")
def join_star_payments(star: Star) -> DataFrame:
    names = star.building_names().select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    return (
        star.applied()
        .join(star.paid_lines().select("uf_id", "periodo", "total_cents"), ["uf_id", "periodo"])
        .join(star.bare_units().select("uf_id", "departamento"), "uf_id")
        .join(names, "consorcio_id")
        .select("id_pago", "uf_id", "consorcio", "departamento", "periodo", "fecha", "importe_cents", "total_cents")
    )


@query("join_left_default", """
SELECT uf_id, COALESCE(SUM(importe_cents), 0)::BIGINT AS pagado_cents
FROM unidad_base LEFT JOIN (SELECT * FROM pago WHERE fecha >= DATE '2001-01-01') USING (cvu) GROUP BY uf_id
""")
def join_left_default(star: Star) -> DataFrame:
    paid = (
        star.payments().filter(F.col("fecha") >= F.lit(RECENT))
        .groupBy("cvu").agg(F.sum("importe_cents").alias("pagado_cents"))
    )
    return star.bare_units().select("uf_id", "cvu").join(paid, "cvu", "left").select(
        "uf_id", F.coalesce("pagado_cents", F.lit(0)).alias("pagado_cents")
    )


@query("join_trimmed_key", """
SELECT uf_id, consorcio_id FROM unidad_base
""")
def join_trimmed_key(star: Star) -> DataFrame:
    """Units find their building by a name in other case and with outer blanks."""
    written = F.concat(F.lit("  "), F.lower("consorcio"), F.lit(" "))
    units = src.named_units(star).select("uf_id", text.key_text(written).alias("_name"))
    names = star.building_names().select(
        F.col("id").alias("consorcio_id"), text.key_text(F.col("nombre")).alias("_name")
    )
    return units.join(names, "_name").select("uf_id", "consorcio_id")


def recent_accounts(star: Star) -> DataFrame:
    """Accounts that paid lately, once each however often they paid."""
    return star.payments().filter(F.col("fecha") >= F.lit(RECENT)).select("cvu").distinct()


@query("join_anti_single", """
SELECT uf_id, cvu FROM unidad_base WHERE cvu NOT IN (SELECT cvu FROM pago WHERE fecha >= DATE '2001-01-01')
""")
def join_anti_single(star: Star) -> DataFrame:
    return m.absent_rows(star.bare_units().select("uf_id", "cvu"), recent_accounts(star), ["cvu"])


@query("join_semi", """
SELECT uf_id, cvu FROM unidad_base WHERE cvu IN (SELECT cvu FROM pago WHERE fecha >= DATE '2001-01-01')
""")
def join_semi(star: Star) -> DataFrame:
    return star.bare_units().select("uf_id", "cvu").join(recent_accounts(star), "cvu", "left_semi")


@query("join_like_prefix", src.SUPPLIER_SQL + """
SELECT g.consorcio_id, tipo_servicio, s_suppkey, empresa, detalle
FROM (SELECT DISTINCT consorcio_id, tipo_servicio FROM gasto) g
JOIN proveedor_limpio p ON p.consorcio_id = g.consorcio_id AND upper(trim(tipo_servicio)) LIKE upper(trim(categoria)) || '%'
""")
def join_like_prefix(star: Star) -> DataFrame:
    services = star.cost_items().select("consorcio_id", "tipo_servicio").distinct()
    return ingest.match_suppliers(services, suppliers(star)).select(
        "consorcio_id", "tipo_servicio", "s_suppkey", "empresa", "detalle"
    )


def suppliers(star: Star) -> DataFrame:
    """Cleaned suppliers with the id of their building."""
    keyed = src.supplier_lines(star).select("s_suppkey", "consorcio_id")
    clean = inputs.src_proveedores(star)
    return ingest.supplier_rows(clean, "s_suppkey").join(keyed, "s_suppkey")


@query("join_scalar_lookup", src.SUPPLIER_SQL + """
SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN consorcio_id END::VARCHAR AS consorcio_id FROM proveedor
""")
def join_scalar_lookup(star: Star) -> DataFrame:
    """Suppliers in debt name a building nobody knows."""
    supplier, nation = star.read("supplier"), star.read("nation")
    named = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, F.lit("desconocido")).otherwise(F.concat(F.lit(" "), F.col("n_name"))).alias("nombre"),
    )
    names = star.building_names().select(F.col("id").alias("consorcio_id"), "nombre")
    found = m.scalar_lookup(named, names, "nombre", "consorcio_id").select("s_suppkey", "consorcio_id")
    return numbers_as_text(found, "consorcio_id")


@query("join_by_position", """
SELECT posicion, s_suppkey, c_custkey FROM
  (SELECT s_suppkey, ROW_NUMBER() OVER (ORDER BY s_acctbal, s_suppkey) AS posicion FROM supplier)
JOIN (SELECT c_custkey, ROW_NUMBER() OVER (ORDER BY c_acctbal, c_custkey) AS posicion FROM customer) USING (posicion)
""")
def join_by_position(star: Star) -> DataFrame:
    accounts = star.read("supplier").select("s_acctbal", "s_suppkey")
    holders = star.read("customer").select("c_acctbal", "c_custkey")
    return numbering.join_by_position(
        accounts, holders, ["s_acctbal", "s_suppkey"], ["c_acctbal", "c_custkey"]
    ).select("posicion", "s_suppkey", "c_custkey")


@query("prev_period_debt", """
SELECT uf_id, periodo::VARCHAR AS periodo, deuda_cents AS saldo_deudor_cents FROM detalle
""")
def prev_period_debt(star: Star) -> DataFrame:
    return st.ledger_debts(star.ledgers(), RANGE)


@query("dept_month_grid", """
SELECT d.consorcio_id, d.departamento, a.anio, m.mes, COALESCE(SUM(importe_cents), 0)::BIGINT AS importe_cents
FROM (SELECT DISTINCT consorcio_id, departamento FROM unidad_base) d
JOIN (SELECT DISTINCT consorcio_id, year(fecha) AS anio FROM aplicado) a USING (consorcio_id)
CROSS JOIN (SELECT range AS mes FROM range(1, 13)) m
LEFT JOIN (SELECT consorcio_id, departamento, year(fecha) AS anio, month(fecha) AS mes, importe_cents
           FROM aplicado JOIN unidad_base USING (uf_id, consorcio_id)) x
  ON x.consorcio_id = d.consorcio_id AND x.departamento = d.departamento AND x.anio = a.anio AND x.mes = m.mes
GROUP BY 1, 2, 3, 4
""")
def dept_month_grid(star: Star) -> DataFrame:
    return reports.department_months(star.applied(), star.bare_units(), include_unpaid=True)


# ---- aggregations ----

@query("agg_weekly", """
SELECT consorcio_id, year(fecha) AS "Anio", month(fecha) AS "Mes",
       (dayofyear(fecha) + dayofweek(date_trunc('year', fecha)::DATE) - 1) // 7 + 1 AS "Semana",
       SUM(ord_cents)::BIGINT AS ord_cents, SUM(ext_cents)::BIGINT AS ext_cents,
       SUM(ord_cents + ext_cents)::BIGINT AS total_cents
FROM costo GROUP BY ALL
""")
def agg_weekly(star: Star) -> DataFrame:
    return reports.weekly_costs(star.costs())


@query("agg_dept_month", """
SELECT consorcio_id, departamento, year(fecha) AS anio, month(fecha) AS mes, SUM(importe_cents)::BIGINT AS importe_cents
FROM aplicado JOIN unidad_base USING (uf_id, consorcio_id) GROUP BY ALL
""")
def agg_dept_month(star: Star) -> DataFrame:
    return reports.collected_by_department(star.applied(), star.bare_units())


@query("agg_sum_or_zero", """
SELECT consorcio_id, COALESCE(SUM(importe_cents) FILTER (fecha >= DATE '2001-07-01'), 0)::BIGINT AS reciente_cents,
       COALESCE(SUM(importe_cents) FILTER (fecha >= DATE '2030-01-01'), 0)::BIGINT AS futuro_cents
FROM unidad_base LEFT JOIN pago USING (cvu) GROUP BY consorcio_id
""")
def agg_sum_or_zero(star: Star) -> DataFrame:
    def since(day: dt.date, name: str):
        return F.coalesce(F.sum(F.when(F.col("mes") >= F.lit(day), F.col("total_cents"))), F.lit(0)).alias(name)

    monthly = st.payments_by_month(star.payments())
    return (
        star.bare_units().select("cvu", "consorcio_id").join(monthly, "cvu", "left").groupBy("consorcio_id")
        .agg(since(dt.date(2001, 7, 1), "reciente_cents"), since(dt.date(2030, 1, 1), "futuro_cents"))
    )


@query("agg_having", """
SELECT dni, nombre, apellido, email, telefono, SUM(GREATEST(total_cents - pagado_cents, 0))::BIGINT AS morosidad_cents
FROM detalle JOIN unidad_base USING (uf_id) JOIN persona USING (cvu) GROUP BY ALL
HAVING SUM(GREATEST(total_cents - pagado_cents, 0)) > 1
""")
def agg_having(star: Star) -> DataFrame:
    return reports.ledger_debtors(star.ledgers(), RANGE, star.persons(), as_of=AS_OF)


@query("first_payment", """
SELECT uf_id, periodo::VARCHAR AS periodo, primera_fecha::VARCHAR AS primera_fecha FROM recibido
""")
def first_payment(star: Star) -> DataFrame:
    return st.payments_received(star.applied()).select("uf_id", "periodo", "primera_fecha")


@query("payments_received", """
SELECT uf_id, periodo::VARCHAR AS periodo, pagado_cents FROM recibido
""")
def payments_received(star: Star) -> DataFrame:
    return st.payments_received(star.applied()).select("uf_id", "periodo", "pagado_cents")


@query("agg_count_distinct_rows", """
SELECT consorcio_id, year(fecha) AS anio, COUNT(*) AS pagos, COUNT(DISTINCT uf_id) AS unidades
FROM aplicado GROUP BY ALL
""")
def agg_count_distinct_rows(star: Star) -> DataFrame:
    per_unit = star.applied().groupBy("consorcio_id", "uf_id", F.year("fecha").alias("anio")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return per_unit.groupBy("consorcio_id", "anio").agg(
        F.sum("_n").alias("pagos"), F.count(F.lit(1)).alias("unidades")
    )


@query("income_buckets", """
SELECT consorcio_id, periodo::VARCHAR AS periodo, ingresos_cents, adeudados_cents, adelantados_cents FROM ingreso
""")
def income_buckets(star: Star) -> DataFrame:
    return st.income_buckets(star.payments(), star.bare_units())


@query("share_of_total", """
SELECT uf_id, consorcio_id, m2, pct_bp FROM unidad
""")
def share_of_total(star: Star) -> DataFrame:
    return annexes.share_of_total(star.bare_units()).select("uf_id", "consorcio_id", "m2", "pct_bp")


# ---- windows ----

@query("win_running_sum", """
SELECT consorcio_id, anio, semana, total_cents,
       SUM(total_cents) OVER (PARTITION BY consorcio_id ORDER BY anio, semana ROWS UNBOUNDED PRECEDING)::BIGINT AS acumulado_cents
FROM (SELECT consorcio_id, year(fecha) AS anio,
             (dayofyear(fecha) + dayofweek(date_trunc('year', fecha)::DATE) - 1) // 7 + 1 AS semana,
             SUM(ord_cents + ext_cents)::BIGINT AS total_cents
      FROM costo GROUP BY ALL)
""")
def win_running_sum(star: Star) -> DataFrame:
    """Over the weeks of a building, a number the calendar bounds."""
    weekly = star.costs().groupBy(
        "consorcio_id", F.year("fecha").alias("anio"), dates.us_week(F.col("fecha")).alias("semana")
    ).agg(F.sum(F.col("ord_cents") + F.col("ext_cents")).alias("total_cents"))
    so_far = Window.partitionBy("consorcio_id").orderBy("anio", "semana").rowsBetween(Window.unboundedPreceding, 0)
    return weekly.withColumn("acumulado_cents", F.sum("total_cents").over(so_far))


@query("win_avg_all", f"""
SELECT consorcio_id, periodo::VARCHAR AS periodo, ord_cents + ext_cents AS total_cents,
       {rounded("s", "n")} AS promedio_cents
FROM (SELECT *, SUM(ord_cents + ext_cents) OVER (PARTITION BY consorcio_id) AS s,
             COUNT(*) OVER (PARTITION BY consorcio_id) AS n FROM costo_mes)
""")
def win_avg_all(star: Star) -> DataFrame:
    """Average over all months of a building beside each of them."""
    building = Window.partitionBy("consorcio_id")
    total = F.col("ord_cents") + F.col("ext_cents")
    average = money.div_round(F.sum(total).over(building), F.count(F.lit(1)).over(building))
    return st.costs_by_period(star.costs()).select(
        "consorcio_id", "periodo", total.alias("total_cents"), average.alias("promedio_cents")
    )


@query("running_balance", """
SELECT consorcio_id, periodo::VARCHAR AS periodo, saldo_anterior_cents, saldo_cierre_cents FROM encabezado
""")
def running_balance(star: Star) -> DataFrame:
    return star.headers().select("consorcio_id", "periodo", "saldo_anterior_cents", "saldo_cierre_cents")


@query("debt_rollforward", """
SELECT uf_id, periodo::VARCHAR AS periodo, deuda_cents, interes_cents, total_cents FROM detalle
""")
def debt_rollforward(star: Star) -> DataFrame:
    return star.lines().select("uf_id", "periodo", "deuda_cents", "interes_cents", "total_cents")


@query("annex_numbering", """
SELECT uf_id, consorcio_id,
       ROW_NUMBER() OVER (PARTITION BY consorcio_id ORDER BY uf_id) + COALESCE(ultimo, 0) AS numero
FROM unidad_base LEFT JOIN (SELECT consorcio_id, MAX(m2) AS ultimo FROM unidad_base WHERE m2 >= 80 GROUP BY 1)
  USING (consorcio_id)
WHERE m2 < 80
""")
def annex_numbering(star: Star) -> DataFrame:
    """Big units have a place already, numbered like their size."""
    units = star.bare_units().select("uf_id", "consorcio_id", "m2")
    taken = units.filter("m2 >= 80").select("consorcio_id", F.col("m2").alias("numero"))
    return numbering.number_after(
        units.filter("m2 < 80").select("uf_id", "consorcio_id"), taken, "consorcio_id", "numero", ["uf_id"]
    )
