"""Monthly statements of all buildings and months of a range in one pass.

Instead of looping over buildings and months, payments and costs are first
reduced to one row per (account or building, month).  From then on the size of
every group is bounded by the number of months, whatever the number of payments
or costs of a hot unit or building.  A statement is known by its building and
period, a statement line by its unit and period.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import dates, money
from ..operators.spread import spread_join


class Range:
    """Inclusive range of statement periods, given by the first day of each end month."""

    def __init__(self, first: dt.date, last: dt.date):
        self.first, self.last = first.replace(day=1), last.replace(day=1)
        self.months = (last.year - first.year) * 12 + last.month - first.month + 1
        if self.months < 1:
            raise ValueError("the range ends before it starts")

    def after(self, months: int) -> dt.date:
        index = self.first.year * 12 + self.first.month - 1 + months
        return dt.date(index // 12, index % 12 + 1, 1)

    def has(self, date: Column, shift: int = 0) -> Column:
        """Date falls into the range moved by ``shift`` months; a plain comparison that scans can prune."""
        return (date >= F.lit(self.after(shift))) & (date < F.lit(self.after(self.months + shift)))

    def index(self, period: Column) -> Column:
        return (dates.month_index(period) - (self.first.year * 12 + self.first.month - 1)).cast("int")


def statements_of(buildings: DataFrame, period_range: Range) -> DataFrame:
    """(consorcio_id, periodo) of every statement of the range."""
    periods = F.sequence(
        F.lit(period_range.first), F.lit(period_range.last), F.expr("interval 1 month")
    )
    return buildings.select(F.col("id").alias("consorcio_id"), F.explode(periods).alias("periodo"))


# ---- costs ----

def union_costs(ordinary: DataFrame, extraordinary: DataFrame) -> DataFrame:
    """Both kinds of cost as one fact with a column per kind and zero in the other."""
    zero = F.lit(0).cast("bigint")
    value = F.col("importe_cents")
    keys = ["consorcio_id", "fecha"]
    return ordinary.select(*keys, value.alias("ord_cents"), zero.alias("ext_cents")).unionByName(
        extraordinary.select(*keys, zero.alias("ord_cents"), value.alias("ext_cents"))
    )


def costs_by_period(costs: DataFrame) -> DataFrame:
    return costs.groupBy("consorcio_id", dates.period_of(F.col("fecha")).alias("periodo")).agg(
        F.sum("ord_cents").alias("ord_cents"), F.sum("ext_cents").alias("ext_cents")
    )


def link_costs(costs: DataFrame, period_range: Range) -> DataFrame:
    """Costs with ``periodo_expensa``, the statement of their building that charges them, as the statements of the range are issued.

    A link made before is kept.  A cost of a month of the range goes to that month; one that arrives after the statement of its
    month was issued goes to the first statement still open, which is the first of the range; a later one stays open.  Every
    building has a statement for each period of the range, so the link needs no join, and each cost is charged once.
    """
    own = dates.period_of(F.col("fecha"))
    first = F.lit(period_range.first)
    now = F.when(own < first, first).when(own <= F.lit(period_range.last), own)
    kept = F.col("periodo_expensa") if "periodo_expensa" in costs.columns else F.lit(None).cast("date")
    return costs.withColumn("periodo_expensa", F.coalesce(kept, now))


def charged_costs(costs: DataFrame) -> DataFrame:
    """Linked costs dated by the statement that charges them, which is how the statements count them."""
    return costs.filter(F.col("periodo_expensa").isNotNull()).withColumn("fecha", F.col("periodo_expensa"))


# ---- payments ----

def payments_by_month(payments: DataFrame) -> DataFrame:
    """One row per account and month: total, part from the first due day on, part after the second."""
    day, value = F.dayofmonth("fecha"), F.col("importe_cents")
    return payments.groupBy("cvu", dates.period_of(F.col("fecha")).alias("mes")).agg(
        F.sum(value).alias("total_cents"),
        F.sum(F.when(day >= dates.FIRST_DUE_DAY, value).otherwise(F.lit(0))).alias("desde_1_cents"),
        F.sum(F.when(day > dates.SECOND_DUE_DAY, value).otherwise(F.lit(0))).alias("tras_2_cents"),
        F.min("fecha").alias("primera_fecha"),
    )


def income_buckets(payments: DataFrame, units: DataFrame) -> DataFrame:
    """Income per building and period: all of the month, overdue part, advances of the month before."""
    monthly = (
        payments_by_month(payments)
        .join(units.select("cvu", "consorcio_id"), "cvu")
        .groupBy("consorcio_id", "mes")
        .agg(*[F.sum(c).alias(c) for c in ("total_cents", "desde_1_cents", "tras_2_cents")])
    )
    zero = F.lit(0).cast("bigint")
    own = F.struct(
        F.col("mes").alias("periodo"), F.col("total_cents").alias("ingresos_cents"),
        F.col("desde_1_cents").alias("adeudados_cents"), zero.alias("adelantados_cents"),
    )
    next_month = F.struct(
        dates.shift_period(F.col("mes"), 1).alias("periodo"), zero.alias("ingresos_cents"),
        zero.alias("adeudados_cents"), F.col("tras_2_cents").alias("adelantados_cents"),
    )
    sums = ("ingresos_cents", "adeudados_cents", "adelantados_cents")
    return (
        monthly.select("consorcio_id", F.inline(F.array(own, next_month)))
        .groupBy("consorcio_id", "periodo")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def apply_payments(
    payments: DataFrame,
    units: DataFrame,
    statements: DataFrame,
    applied: DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Whole payments applied to the line of their unit in the statement of the month before.

    Every unit has a line in each statement of its building, so the building's
    statement decides whether the line exists.  Payments in ``applied`` are left out.
    ``carry`` names unit columns to keep, which saves a second join with the units.

    Units bring the periods of their building's statements along, a list the calendar bounds, so the payments are
    joined once, by account, and not dealt again to meet the statements; if payments and units are stored in buckets by account,
    see ``sources.buckets``, not at all.
    """
    target = dates.shift_period(dates.period_of(F.col("fecha")), -1)
    fresh = payments
    if applied is not None:
        fresh = payments.join(applied.select("id_pago"), "id_pago", "left_anti")
    periods = statements.groupBy("consorcio_id").agg(F.collect_set("periodo").alias("_periods"))
    holders = spread_join(units.select("cvu", "uf_id", "consorcio_id", *carry), periods, ["consorcio_id"], ["uf_id"])
    return (
        fresh.select("id_pago", "cvu", "fecha", "importe_cents", target.alias("periodo"))
        .join(holders, "cvu")
        .filter(F.array_contains("_periods", F.col("periodo")))
        .select("id_pago", "uf_id", "consorcio_id", "periodo", "fecha", "importe_cents", *carry)
    )


def payments_received(applied: DataFrame) -> DataFrame:
    """Sum and first date of the payments applied to each statement line."""
    return applied.groupBy("uf_id", "periodo").agg(
        F.sum("importe_cents").alias("pagado_cents"), F.min("fecha").alias("primera_fecha")
    )


# ---- header ----

def running_balance(flows: DataFrame, opening: DataFrame) -> DataFrame:
    """Opening and closing balance per period: each month opens with the closing of the one before.

    ``flows`` has one row per building and period with ingresos_cents and egresos_cents.
    """
    net = F.col("ingresos_cents") - F.col("egresos_cents")
    so_far = Window.partitionBy("consorcio_id").orderBy("periodo").rowsBetween(Window.unboundedPreceding, 0)
    balances = opening.select(F.col("id").alias("consorcio_id"), "saldo_cents")
    return (
        flows.withColumn("_net", F.sum(net).over(so_far))
        .join(balances, "consorcio_id", "left")
        .withColumn("saldo_cierre_cents", F.coalesce("saldo_cents", F.lit(0)) + F.col("_net"))
        .withColumn("saldo_anterior_cents", F.col("saldo_cierre_cents") - net)
        .drop("_net", "saldo_cents")
    )


def statement_flows(
    buildings: DataFrame, units: DataFrame, costs: DataFrame, payments: DataFrame, period_range: Range
) -> DataFrame:
    """Income and expense of every statement of the range, 0 where there is none."""
    # Payments of the month before the range still count as advances of its first month.
    near = period_range.has(F.col("fecha")) | period_range.has(F.col("fecha"), -1)
    income = income_buckets(payments.filter(near), units)
    expense = costs_by_period(costs.filter(period_range.has(F.col("fecha"))))
    columns = ("ingresos_cents", "adeudados_cents", "adelantados_cents", "ord_cents", "ext_cents")
    keys = ["consorcio_id", "periodo"]
    return (
        statements_of(buildings, period_range)
        .join(income, keys, "left")
        .join(expense, keys, "left")
        .select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in columns])
        .withColumn("egresos_cents", F.col("ord_cents") + F.col("ext_cents"))
    )


def statement_header(
    buildings: DataFrame, units: DataFrame, costs: DataFrame, payments: DataFrame, period_range: Range
) -> DataFrame:
    """The statements of the range; ``buildings`` carry the opening balance ``saldo_cents``."""
    flows = statement_flows(buildings, units, costs, payments, period_range)
    return running_balance(flows, buildings).select(
        "consorcio_id", "periodo", "saldo_anterior_cents", "ingresos_cents", "adeudados_cents",
        "adelantados_cents", "egresos_cents", "saldo_cierre_cents",
    )


# ---- lines ----

def _costs_per_building(costs: DataFrame, period_range: Range) -> DataFrame:
    """One row per building with its ordinary and extraordinary cost of every month of the range."""
    monthly = costs_by_period(costs.filter(period_range.has(F.col("fecha")))).select(
        "consorcio_id", period_range.index(F.col("periodo")).alias("_i"), "ord_cents", "ext_cents"
    )
    zero = F.lit(0).cast("bigint")
    value = F.struct("ord_cents", "ext_cents", (F.col("ord_cents") + F.col("ext_cents")).alias("all_cents"))
    by_index = F.map_from_entries(F.collect_list(F.struct("_i", value.alias("v"))))
    empty = F.struct(zero.alias("ord_cents"), zero.alias("ext_cents"), zero.alias("all_cents"))
    months = F.sequence(F.lit(0), F.lit(period_range.months - 1))
    return (
        monthly.groupBy("consorcio_id")
        .agg(by_index.alias("_costs"))
        .select(
            "consorcio_id",
            F.transform(months, lambda i: F.coalesce(F.try_element_at("_costs", i), empty)).alias("costs"),
        )
    )


def _payments_per_account(payments: DataFrame, period_range: Range) -> DataFrame:
    """One row per account: what it paid toward each period, i.e. in the month after it.

    Dealt to a stated number of partitions: where the join with the units keeps this side's, these are not coalesced by
    their small size, though every row grows into one line per month.
    """
    partitions = int(payments.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    settled = dates.shift_period(F.col("mes"), -1)
    by_index = F.map_from_entries(
        F.collect_list(F.struct("_i", F.struct("total_cents", "primera_fecha").alias("v")))
    )
    return (
        payments_by_month(payments.filter(period_range.has(F.col("fecha"), 1)))
        .withColumn("_i", period_range.index(settled))
        .repartition(partitions, "cvu")
        .groupBy("cvu")
        .agg(by_index.alias("paid"))
    )


SHARE = ("share_num", "share_den")


def share_of_units(units: DataFrame) -> tuple[Column, Column]:
    """Numerator and denominator of the units' share: the exact one where they carry it, else ``pct_bp`` as read from a file."""
    if set(SHARE) <= set(units.columns):
        return F.coalesce(SHARE[0], F.lit(0)).cast("bigint"), F.coalesce(SHARE[1], F.lit(1)).cast("bigint")
    return F.coalesce("pct_bp", F.lit(0)).cast("bigint"), F.lit(10000).cast("bigint")


def statement_shares(units: DataFrame, costs: DataFrame, period_range: Range) -> DataFrame:
    """Ordinary and extraordinary part of every unit in every statement of the range."""
    months = _costs_per_building(costs, period_range)
    num, den = share_of_units(units)
    shares = units.select("uf_id", "consorcio_id", num.alias("_num"), den.alias("_den"))
    zero = F.lit(0).cast("bigint")
    rows = (
        spread_join(shares, months, ["consorcio_id"], ["uf_id"], "left")
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(period_range.months - 1))))
        .withColumn("_c", F.get("costs", F.col("_i")))
    )
    return rows.select(
        "uf_id", "consorcio_id",
        F.add_months(F.lit(period_range.first), F.col("_i")).alias("periodo"),
        money.fraction_of(F.coalesce(F.col("_c.ord_cents"), zero), F.col("_num"), F.col("_den")).alias("ord_cents"),
        money.fraction_of(F.coalesce(F.col("_c.ext_cents"), zero), F.col("_num"), F.col("_den")).alias("ext_cents"),
    )


def with_shares(applied: DataFrame, costs: DataFrame) -> DataFrame:
    """Applied payments, carrying their unit's share (``SHARE``, or ``pct_bp`` alone), with the parts of the line they settle.

    Gives what a join with the statement lines would, without a row per unpaid month.
    """
    zero, (num, den) = F.lit(0).cast("bigint"), share_of_units(applied)
    return (
        spread_join(applied, costs_by_period(costs), ["consorcio_id", "periodo"], ["id_pago"], "left")
        .withColumns({
            c: money.fraction_of(F.coalesce(c, zero), num, den) for c in ("ord_cents", "ext_cents")
        })
        .drop("pct_bp", *SHARE)
    )


def unit_ledgers(
    units: DataFrame,
    costs: DataFrame,
    payments: DataFrame,
    period_range: Range,
    opening_debt: DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per unit with the months of the range as arrays: what is charged and paid, and the debt carried into each.

    A month's debt is the previous line's total less what was paid toward it.  The interest on positive debt makes that
    a true recurrence, so it is folded over the unit's months, see ``carried_debts``.  ``_debts`` has
    one element more than there are months, what the last line leaves unpaid.  ``opening_debt`` (uf_id, deuda_cents) carries on from
    an earlier run.  ``carry`` names unit columns to keep, to be joined once per unit instead of once per line.
    """
    zero = F.lit(0).cast("bigint")
    num, den = share_of_units(units)
    accounts = units.select("uf_id", "consorcio_id", "cvu", num.alias("_num"), den.alias("_den"), *carry)
    if opening_debt is not None:
        opening = opening_debt.select("uf_id", F.col("deuda_cents").alias("_opening"))
        accounts = accounts.join(opening, "uf_id", "left")
    else:
        accounts = accounts.withColumn("_opening", zero)
    # Every unit grows into one line per month, so units are spread over all
    # shuffle partitions instead of being coalesced by their small size.
    partitions = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paying = accounts.repartition(partitions, "cvu").join(
        _payments_per_account(payments, period_range), "cvu", "left"
    )

    inputs = spread_join(paying, _costs_per_building(costs, period_range), ["consorcio_id"], ["uf_id"], "left")

    debts = carried_debts(period_range.months)(
        F.col("costs.all_cents"), F.map_keys("paid"), F.map_values("paid").getField("total_cents"),
        F.col("_num"), F.col("_den"), F.coalesce("_opening", zero),
    )
    return inputs.select("uf_id", "consorcio_id", "cvu", *carry, "_num", "_den", "costs", "paid", debts.alias("_debts"))


def carried_debts(months: int):
    """Function of a unit's charges by month, the months it paid in, what it paid in them, its share (numerator, denominator) and its
    opening debt: the debt carried into each month and, last, what the last one leaves unpaid.

    A month leaves the debt, the exact share of the charge and one part in PER_RATE of a positive debt, rounded once, halves away
    from zero, less what was paid.  Units of an Arrow batch go through a month together.  What leaves the range of BIGINT fails.
    """
    per_rate, limit = PER_RATE, 9.2e18

    @F.arrow_udf("array<bigint>")
    def fold(charged: pa.Array, paid_in: pa.Array, paid: pa.Array, num: pa.Array, den: pa.Array, opening: pa.Array) -> pa.Array:
        n = len(den)

        def by_month(lists, at=None):
            """Months by units: elements of the lists at their place, or at the month that ``at`` has in that place; else 0."""
            count = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(n), count)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) if at is None else pc.list_flatten(at).to_numpy(zero_copy_only=False).astype(np.int64)
            table = np.zeros((months, n), np.int64)
            inside = (place >= 0) & (place < months)
            table[place[inside], row[inside]] = pc.fill_null(pc.list_flatten(lists), 0).to_numpy(zero_copy_only=False)[inside]
            return table

        def held(*terms):
            """Fails where the sum of the terms, products given as pairs, may leave the range of BIGINT."""
            size = sum(np.abs(t[0].astype(float)) * np.abs(np.asarray(t[1], float)) if isinstance(t, tuple) else np.abs(t.astype(float)) for t in terms)
            if size.size and size.max() >= limit:
                raise ArithmeticError("ARITHMETIC_OVERFLOW: a debt leaves the range of BIGINT")

        charge, received = by_month(charged), by_month(paid, paid_in)
        num, den, debt = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (num, den, opening))
        if (den <= 0).any():
            raise ArithmeticError("DIVIDE_BY_ZERO: a share's denominator is not positive")
        left, times = charge % den, charge // den
        held((left, num))
        held((times, num), (left, num))
        part, rest = times * num + left * num // den, left * num % den
        held((den, 2 * 2 * per_rate))
        whole_den = den * per_rate
        debts = np.empty((n, months + 1), np.int64)
        for i in range(months):
            debts[:, i] = debt
            owed = np.maximum(debt, 0)
            held(debt, part[i], owed, received[i])
            over = rest[i] * per_rate + owed % per_rate * den
            floor = debt + part[i] + owed // per_rate + over // whole_den
            twice = over % whole_den * 2
            debt = floor + np.where(floor >= 0, twice >= whole_den, twice > whole_den) - received[i]
        debts[:, months] = debt
        return pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * np.int32(months + 1), debts.reshape(-1))

    return fold


def _charged(i: Column) -> tuple[Column, Column]:
    """A unit's exact part of its building's costs of month ``i``, see ``money.exact_part``."""
    return money.exact_part(F.coalesce(F.get("costs", i).all_cents, F.lit(0).cast("bigint")), F.col("_num"), F.col("_den"))


def ledger_lines(ledgers: DataFrame, period_range: Range, carry: tuple[str, ...] = (), paid_only: bool = False) -> DataFrame:
    """Statement lines of the ledgers of a range; with ``paid_only`` those that received a payment, and no row is made of the others.

    Only the debts, which need the fold, are computed in the arrays; the rest is taken out of them line by line, in compiled code.
    """
    kept, zero = ("uf_id", "consorcio_id", *carry, "_num", "_den", "costs", "paid"), F.lit(0).cast("bigint")
    if paid_only:
        received = ledgers.select(*kept, "_debts", F.explode(F.map_keys("paid")).alias("_i"))
        months = received.select(*kept, "_i", F.get("_debts", F.col("_i")).alias("deuda_cents"))
    else:
        months = ledgers.select(*kept, F.posexplode(F.slice("_debts", 1, period_range.months)).alias("_i", "deuda_cents"))
    i, cost, paid = F.col("_i"), F.get("costs", F.col("_i")), F.try_element_at("paid", F.col("_i"))
    lines = months.select(
        "uf_id", "consorcio_id", *carry, "_num", "_den", "_i", "deuda_cents",
        F.coalesce(cost.ord_cents, zero).alias("ord"), F.coalesce(cost.ext_cents, zero).alias("ext"),
        *(c.alias(n) for c, n in zip(_charged(i), ("part", "rest"))),
        F.coalesce(paid.total_cents, zero).alias("paid"), paid.primera_fecha.alias("first"),
        F.coalesce(F.try_element_at("paid", i - 1).total_cents, zero).alias("paid_before"),
    )
    debt, num, den = F.col("deuda_cents"), F.col("_num"), F.col("_den")
    issued = lines.select(
        "uf_id", "consorcio_id", *carry,
        F.add_months(F.lit(period_range.first), F.col("_i")).alias("periodo"),
        money.fraction_of(F.col("ord"), num, den).alias("ord_cents"),
        money.fraction_of(F.col("ext"), num, den).alias("ext_cents"),
        "deuda_cents",
        money.share_of(F.greatest(debt, zero), F.lit(money.DETAIL_RATE_BP)).alias("interes_cents"),
        _total(F.col("part"), F.col("rest"), den, debt).alias("total_cents"),
        F.col("paid").alias("pagado_cents"),
        F.col("first").alias("primera_fecha"),
        F.col("paid_before").alias("pagado_anterior_cents"),
    )
    dated = issued.withColumns({
        "vencimiento_1": dates.due_date(F.col("periodo"), dates.FIRST_DUE_DAY),
        "vencimiento_2": dates.due_date(F.col("periodo"), dates.SECOND_DUE_DAY),
    })
    return late_interest(dated)


def statement_detail(
    units: DataFrame,
    costs: DataFrame,
    payments: DataFrame,
    period_range: Range,
    opening_debt: DataFrame | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Statement lines of all units and periods of the range, see ``unit_ledgers``.

    Besides the amounts at issue the lines hold the later refresh:
    ``pagado_cents`` (0 if none), ``pagado_anterior_cents`` and ``mora_cents``,
    the interest by date of the first payment.
    """
    ledgers = unit_ledgers(units, costs, payments, period_range, opening_debt, carry)
    return ledger_lines(ledgers, period_range, carry)


def unpaid_sum(ledgers: DataFrame, period_range: Range, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """(uf_id, consorcio_id, cvu, morosidad_cents): what the lines first due in the range of dates leave unpaid, credits not set off.

    What a line leaves unpaid is the debt carried into the month after, so the sum is taken inside the array.  It comes out of
    a generator, so that filters on it stay above: pushed below, each would fold the months again.
    """
    due = [period_range.after(i).replace(day=dates.FIRST_DUE_DAY) for i in range(period_range.months)]
    wanted = [i for i, d in enumerate(due) if (since is None or d >= since) and (until is None or d <= until)]
    zero = F.lit(0).cast("bigint")
    owed = zero
    if wanted:
        left = F.slice("_debts", wanted[0] + 2, len(wanted))
        owed = F.aggregate(left, zero, lambda total, debt: total + F.greatest(debt, zero))
    return ledgers.select(F.inline(F.array(F.struct("uf_id", "consorcio_id", "cvu", owed.alias("morosidad_cents")))))


def ledger_debts(ledgers: DataFrame, period_range: Range) -> DataFrame:
    """(uf_id, periodo, saldo_deudor_cents) as ``previous_debt`` of the ledgers' lines: the first one has none before it."""
    debts = F.slice("_debts", 1, period_range.months)
    return ledgers.select("uf_id", F.posexplode(debts).alias("_i", "_debt")).select(
        "uf_id", F.add_months(F.lit(period_range.first), F.col("_i")).alias("periodo"),
        F.when(F.col("_i") > 0, F.col("_debt")).otherwise(F.lit(0)).alias("saldo_deudor_cents"),
    )


PER_RATE = 10000 // money.DETAIL_RATE_BP  # interest is one part in so many of the debt


def _exact_total(part: Column, rest: Column, den: Column, debt: Column, owed: Column) -> tuple[Column, Column]:
    """Total to pay as whole part and what is over, in parts of ``den * PER_RATE``; ``owed`` is the debt if positive."""
    whole = debt + part + money.int_div(owed, F.lit(PER_RATE))
    return whole, rest * PER_RATE + owed % PER_RATE * den


def _total(part: Column, rest: Column, den: Column, debt: Column) -> Column:
    """Total to pay: cost share (``part + rest / den``), debt and interest on it, rounded once from the exact value."""
    owed = F.greatest(debt, F.lit(0).cast("bigint"))
    return money.rounded_sum(*_exact_total(part, rest, den, debt, owed), den * PER_RATE)


def late_interest(lines: DataFrame) -> DataFrame:
    """Add ``mora_cents``: interest on the total less the previous payments, by first payment date.

    Lines nobody paid keep the interest they were issued with.
    """
    base = F.col("total_cents") - F.col("pagado_anterior_cents")
    first = F.col("primera_fecha")
    late = (
        F.when(first > F.col("vencimiento_2"), money.share_of(base, F.lit(money.LATE_SECOND_RATE_BP)))
        .when(first > F.col("vencimiento_1"), money.share_of(base, F.lit(money.LATE_FIRST_RATE_BP)))
        .otherwise(F.lit(0))
    )
    unpaid = F.coalesce("interes_cents", F.lit(0))
    return lines.withColumn("mora_cents", F.when(first.isNull(), unpaid).otherwise(late))


def previous_debt(lines: DataFrame) -> DataFrame:
    """(uf_id, periodo, saldo_deudor_cents): what the line of the month before left unpaid, 0 if none."""
    by_unit = Window.partitionBy("uf_id").orderBy("periodo")
    owed = F.col("total_cents") - F.coalesce("pagado_cents", F.lit(0))
    adjacent = F.lag("periodo").over(by_unit) == F.add_months("periodo", -1)
    return lines.select(
        "uf_id", "periodo",
        F.coalesce(F.when(adjacent, F.lag(owed).over(by_unit)), F.lit(0)).alias("saldo_deudor_cents"),
    )


def batch_summary(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Headers of a batch with count and totals of their lines."""
    sums = ("ord_cents", "ext_cents", "deuda_cents", "interes_cents", "total_cents", "pagado_cents", "mora_cents")
    totals = lines.groupBy("consorcio_id", "periodo").agg(
        F.count(F.lit(1)).alias("detalles"), *[F.sum(c).alias(f"suma_{c}") for c in sums]
    )
    return headers.join(totals, ["consorcio_id", "periodo"], "left")
