"""The six reports.  Column names of the results are fixed values users read by name.

Filters that are None select everything; amounts leave as DECIMAL or as text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import dates, money
from ..operators.gaps import payment_gaps
from ..operators.ranking import largest
from . import statements as st

# Month columns of the cross table.
MONTH_COLUMNS = ("Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic")
MIN_DEBT_CENTS = 1  # debtors owe more than this


def weekly_costs(costs: DataFrame) -> DataFrame:
    """Costs per building, year, month and week."""
    date = F.col("fecha")
    return costs.groupBy(
        "consorcio_id", F.year(date).alias("Anio"), F.month(date).alias("Mes"), dates.us_week(date).alias("Semana")
    ).agg(
        F.sum("ord_cents").alias("ord_cents"),
        F.sum("ext_cents").alias("ext_cents"),
        F.sum(F.col("ord_cents") + F.col("ext_cents")).alias("total_cents"),
    )


def weekly_flow(
    costs: DataFrame,
    statements: DataFrame,
    buildings: DataFrame,
    building: str | None = None,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Report 1: weekly expenses of a statement with progressive sum and period average.

    Without a building or period it reports every statement.
    """
    if building is not None:
        buildings = buildings.filter(F.col("nombre") == building)
        if buildings.isEmpty():
            raise ValueError(f"no building is named {building!r}")
    if year is not None and month is not None:
        costs = costs.filter(dates.in_period(F.col("fecha"), year, month))
        statements = statements.filter(dates.in_period(F.col("periodo"), year, month))
        if building is not None:
            own = buildings.select(F.col("id").alias("consorcio_id"))
            if statements.join(own, "consorcio_id", "left_semi").isEmpty():
                raise ValueError(f"{building!r} has no statement for {month}/{year}")
    names = buildings.select(F.col("id").alias("consorcio_id"), "nombre")
    weekly = (
        weekly_costs(costs)
        .withColumn("periodo", F.make_date("Anio", "Mes", F.lit(1)))
        .join(statements.select("consorcio_id", "periodo"), ["consorcio_id", "periodo"])
        .join(names, "consorcio_id")
    )
    # At most six weeks per window: one statement's month.
    statement = Window.partitionBy("consorcio_id", "periodo")
    so_far = statement.orderBy("Semana").rowsBetween(Window.unboundedPreceding, 0)
    average = money.div_round(
        F.sum("total_cents").over(statement), F.count(F.lit(1)).over(statement)
    )
    return weekly.select(
        F.col("nombre").alias("Nombre_Consorcio"),
        F.col("consorcio_id").alias("ID_Consorcio"),
        dates.statement_key(F.col("consorcio_id"), F.col("periodo")).alias("ID_Expensa"),
        F.date_format("periodo", "yyyy-MM").alias("Periodo"),
        "Anio", "Mes", "Semana",
        money.amount_text(F.col("ord_cents")).alias("Egreso_Ordinario"),
        money.amount_text(F.col("ext_cents")).alias("Egreso_Extraordinario"),
        money.amount_text(F.col("total_cents")).alias("Egreso_Semanal_Total"),
        money.amount_text(F.sum("total_cents").over(so_far)).alias("Acumulado_Progresivo"),
        money.amount_text(average).alias("Promedio_Periodo"),
    ).orderBy("ID_Consorcio", "Anio", "Mes", "Semana")


def collected_by_department(applied: DataFrame, units: DataFrame) -> DataFrame:
    """Applied amounts per building, department, year and month of payment.

    Summed per unit and month before the units are joined.
    """
    per_unit = applied.groupBy("uf_id", dates.period_of(F.col("fecha")).alias("_mes")).agg(
        F.sum("importe_cents").alias("importe_cents")
    )
    return (
        per_unit.join(units.select("uf_id", "consorcio_id", "departamento"), "uf_id")
        .groupBy("consorcio_id", "departamento", F.year("_mes").alias("anio"), F.month("_mes").alias("mes"))
        .agg(F.sum("importe_cents").alias("importe_cents"))
    )


def _department_rows(
    applied: DataFrame, units: DataFrame, building_id: int | None, year: int | None, include_unpaid: bool
) -> DataFrame:
    """Collected amounts; with ``include_unpaid`` also a row without month per department and year."""
    if building_id is not None:
        units = units.filter(F.col("consorcio_id") == building_id)
    if year is not None:
        applied = applied.filter(dates.in_year(F.col("fecha"), year))
    collected = collected_by_department(applied, units)
    if not include_unpaid:
        return collected
    departments = units.select("consorcio_id", "departamento").distinct()
    if year is not None:
        departments = departments.withColumn("anio", F.lit(year))
    else:
        departments = departments.join(collected.select("consorcio_id", "anio").distinct(), "consorcio_id")
    return departments.join(collected, ["consorcio_id", "departamento", "anio"], "left")


def department_months(
    applied: DataFrame, units: DataFrame, building_id: int | None = None, year: int | None = None,
    include_unpaid: bool = False,
) -> DataFrame:
    """Report 2 in long form: every department and month with its collection, 0 without one.

    Departments without any payment in the year appear only on request.
    """
    value = F.col("importe_cents")
    months = F.array(*[
        F.struct(F.lit(i).alias("mes"), F.coalesce(F.sum(F.when(F.col("mes") == i, value)), F.lit(0)).alias("importe_cents"))
        for i in range(1, 13)
    ])
    return (
        _department_rows(applied, units, building_id, year, include_unpaid)
        .groupBy("consorcio_id", "anio", "departamento")
        .agg(months.alias("_months"))
        .select("consorcio_id", "anio", "departamento", F.inline("_months"))
    )


def department_month_table(
    applied: DataFrame, units: DataFrame, building_id: int | None = None, year: int | None = None,
    include_unpaid: bool = False,
) -> DataFrame:
    """Report 2: collection by department with a column per month and the row total."""
    value = F.col("importe_cents")
    months = [
        F.coalesce(F.sum(F.when(F.col("mes") == i, value)), F.lit(0)).alias(name)
        for i, name in enumerate(MONTH_COLUMNS, 1)
    ]
    return (
        _department_rows(applied, units, building_id, year, include_unpaid)
        .groupBy("consorcio_id", "anio", "departamento")
        .agg(*months, F.coalesce(F.sum(value), F.lit(0)).alias("Total"))
        .select(
            "consorcio_id", "anio", "departamento",
            *[money.amount(F.col(c)).alias(c) for c in (*MONTH_COLUMNS, "Total")],
        )
        .orderBy("consorcio_id", "anio", "departamento")
    )


def income_by_source(
    applied: DataFrame,
    lines: DataFrame,
    building_id: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Report 3: payments split by the weight of ordinary, extraordinary and interest parts of their line, by month of payment.

    Payments are summed per line before they meet it, so that each line is rounded once; ``payments_by_source`` splits every
    payment, and ``paid_by_source`` does without the join where whole lines are asked for.
    """
    applied, lines = _wanted(applied, lines, building_id, since, until, as_of)
    paid = applied.groupBy("uf_id", "periodo", dates.period_of(F.col("fecha")).alias("_mes")).agg(F.sum("importe_cents").alias("_paid"))
    return _by_source(paid.join(lines.select("uf_id", "periodo", "ord_cents", "ext_cents", "mora_cents"), ["uf_id", "periodo"]))


def payments_by_source(
    payments: DataFrame,
    lines: DataFrame,
    building_id: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    as_of: dt.date | None = None,
    unit: str = "uf_id",
) -> DataFrame:
    """Report 3 as the reference has it: every single payment is split by the weights of its line, by month of payment.

    ``payments`` have ``unit`` and the ``periodo`` they settle: applied payments, or with ``cvu`` as ``unit`` payments that meet the
    lines carrying it by account, once for each line.
    """
    payments, lines = _wanted(payments, lines, building_id, since, until, as_of)
    paid = payments.select(unit, "periodo", dates.period_of(F.col("fecha")).alias("_mes"), F.col("importe_cents").alias("_paid"))
    return _by_source(paid.join(lines.select(unit, "periodo", "ord_cents", "ext_cents", "mora_cents"), [unit, "periodo"]))


def _wanted(applied: DataFrame, lines: DataFrame, building_id: int | None, since: dt.date | None, until: dt.date | None, as_of: dt.date | None):
    """Payments of the range of dates and lines, of one building if it is given."""
    applied = applied.filter(dates.in_range(F.col("fecha"), since, until, as_of))
    if building_id is not None:
        lines = lines.filter(F.col("consorcio_id") == building_id)
    return applied, lines


def paid_by_source(lines: DataFrame, building_id: int | None = None) -> DataFrame:
    """Report 3 over all payments, from what the lines have received: all of it in the month after their period."""
    if building_id is not None:
        lines = lines.filter(F.col("consorcio_id") == building_id)
    month = dates.shift_period(F.col("periodo"), 1)
    return _by_source(lines.filter("primera_fecha is not null").withColumns({"_paid": F.col("pagado_cents"), "_mes": month}))


def _by_source(paid: DataFrame) -> DataFrame:
    """What was paid toward each line (``_paid`` in ``_mes``), by line or by payment, split in millionths, so that sums do not depend on their order.

    The sums are DECIMAL: millionths of many amounts leave the range of BIGINT.
    """
    weight = {"Ordinario": "ord_cents", "Extraordinario": "ext_cents", "Mora": "mora_cents"}
    given = paid.select("_mes", "_paid", *[F.coalesce(c, F.lit(0)).alias(c) for c in weight.values()])
    whole = F.col("ord_cents") + F.col("ext_cents") + F.col("mora_cents")
    split = [money.weighted_part(F.col("_paid"), F.col(c), F.col("_whole")).cast("decimal(20,0)").alias(n) for n, c in weight.items()]
    parts = given.withColumn("_whole", whole).select("_mes", *split)
    sums = {n: F.sum(n) for n in weight} | {"Total": F.sum(F.col("Ordinario") + F.col("Extraordinario") + F.col("Mora"))}
    return (
        parts.groupBy("_mes")
        .agg(*[total.alias(name) for name, total in sums.items()])
        .select(
            F.date_format("_mes", "yyyy-MM").alias("Periodo"),
            *[(F.col(n).cast("decimal(31,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(37,6)").alias(n) for n in sums],
        )
        .orderBy("Periodo")
    )


def monthly_costs(costs: DataFrame, statements: DataFrame, year: int | None, building_id: int | None) -> DataFrame:
    """Costs linked to a statement, per year and month."""
    if year is not None:
        costs = costs.filter(dates.in_year(F.col("fecha"), year))
    if building_id is not None:
        costs = costs.filter(F.col("consorcio_id") == building_id)
    per_statement = costs.groupBy("consorcio_id", dates.period_of(F.col("fecha")).alias("periodo")).agg(
        F.sum(F.col("ord_cents") + F.col("ext_cents")).alias("monto_cents")
    )
    return (
        per_statement.join(statements.select("consorcio_id", "periodo"), ["consorcio_id", "periodo"], "left_semi")
        .groupBy(F.year("periodo").alias("Anio"), F.month("periodo").alias("Mes"))
        .agg(F.sum("monto_cents").alias("monto_cents"))
    )


def monthly_income(received: DataFrame, year: int | None, building_id: int | None) -> DataFrame:
    """Payments received per statement period; ``received`` is at line grain or finer."""
    if year is not None:
        received = received.filter(dates.in_year(F.col("periodo"), year))
    if building_id is not None:
        received = received.filter(F.col("consorcio_id") == building_id)
    return (
        received.groupBy("uf_id", "periodo")
        .agg(F.sum("importe_cents").alias("pagado_cents"))
        .filter("pagado_cents > 0")
        .groupBy(F.year("periodo").alias("Anio"), F.month("periodo").alias("Mes"))
        .agg(F.sum("pagado_cents").alias("monto_cents"))
    )


def top_months(
    costs: DataFrame,
    statements: DataFrame,
    applied: DataFrame,
    n: int = 5,
    year: int | None = None,
    building_id: int | None = None,
) -> DataFrame:
    """Report 4: the n months of largest cost and the n of largest income."""
    spent = largest(monthly_costs(costs, statements, year, building_id), n, "monto_cents", ["Anio", "Mes"])
    earned = largest(monthly_income(applied, year, building_id), n, "monto_cents", ["Anio", "Mes"])

    def tagged(rows: DataFrame, kind: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("Tipo"), "Anio", "Mes",
            F.date_format(F.make_date("Anio", "Mes", F.lit(1)), "MMMM").alias("NombreMes"),
            money.amount(F.col("monto_cents")).alias("Monto"),
        )

    return tagged(spent, "Gasto").unionByName(tagged(earned, "Ingreso")).orderBy(
        F.desc("Tipo"), F.desc("Monto")
    )


def debtors(
    lines: DataFrame,
    units: DataFrame,
    persons: DataFrame,
    building_id: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Persons with what their units owe on lines due in the range, if more than a cent."""
    lines = lines.filter(dates.in_range(F.col("vencimiento_1"), since, until, as_of))
    if building_id is not None:
        lines = lines.filter(F.col("consorcio_id") == building_id)
    owed = F.greatest(F.col("total_cents") - F.coalesce("pagado_cents", F.lit(0)), F.lit(0))
    per_unit = lines.groupBy("uf_id").agg(F.sum(owed).alias("morosidad_cents"))
    return _owing_persons(per_unit.join(units.select("uf_id", "cvu"), "uf_id"), persons)


def ledger_debtors(
    ledgers: DataFrame,
    period_range: st.Range,
    persons: DataFrame,
    building_id: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """``debtors`` of the lines of these ledgers, summed per unit without making the lines."""
    if building_id is not None:
        ledgers = ledgers.filter(F.col("consorcio_id") == building_id)
    return _owing_persons(st.unpaid_sum(ledgers, period_range, since, until or as_of or dt.date.today()), persons)


def _owing_persons(per_unit: DataFrame, persons: DataFrame) -> DataFrame:
    identity = ["dni", "nombre", "apellido", "email", "telefono"]
    return (
        per_unit.filter("morosidad_cents > 0")
        .join(persons.select("cvu", *identity), "cvu")
        .groupBy(*identity)
        .agg(F.sum("morosidad_cents").alias("morosidad_cents"))
        .filter(F.col("morosidad_cents") > MIN_DEBT_CENTS)
    )


def top_debtors(debtor_rows: DataFrame, n: int = 3) -> DataFrame:
    """Report 5: the n largest debtors with their contact data."""
    return largest(debtor_rows, n, "morosidad_cents", ["dni"]).select(
        "dni", "nombre", "apellido", "email", "telefono",
        money.amount(F.col("morosidad_cents")).alias("morosidad"),
    )


def ordinary_payment_gaps(
    paid_lines: DataFrame,
    building_id: int | None = None,
    unit_id: int | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Report 6: payments toward lines with an ordinary part and the days since the unit's previous one.

    ``paid_lines`` are applied payments with ``ord_cents`` of their line.
    """
    wanted = paid_lines.filter(dates.in_range(F.col("fecha"), since, until, as_of)).filter("ord_cents > 0")
    for column, value in (("consorcio_id", building_id), ("uf_id", unit_id)):
        if value is not None:
            wanted = wanted.filter(F.col(column) == value)
    return payment_gaps(wanted.select("uf_id", "consorcio_id", "id_pago", "fecha"))
