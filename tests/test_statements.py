"""Statements against a month-by-month loop in plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from condoflow.plans import notifications, reports, statements as st
from condoflow.sources import xml

RANGE = st.Range(dt.date(2024, 11, 1), dt.date(2025, 4, 1))


def months(first, n):
    return [dt.date(first.year + (first.month - 1 + i) // 12, (first.month - 1 + i) % 12 + 1, 1) for i in range(n)]


def half_away(num, den):
    q = (2 * abs(num) + den) // (2 * den)
    return q if num >= 0 else -q


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    buildings = [(1, "Norte", 5000), (2, "Sur", 0)]
    units = [(u, f"{u:022d}", 1 + u % 2, "AB"[u % 3 % 2], 900 + 37 * u) for u in range(1, 9)]
    costs, payments = [], []
    for m in months(dt.date(2024, 10, 1), 8):
        for b, _, _ in buildings:
            for _ in range(rng.randint(0, 3)):
                day = m.replace(day=rng.randint(1, 28))
                costs.append((b, day, rng.randint(1, 900000), 0) if rng.random() < 0.7 else (b, day, 0, rng.randint(1, 90000)))
        for u in units[1:]:  # unit 1 never pays
            for _ in range(rng.randint(0, 2)):
                payments.append((len(payments) + 1, u[1], m.replace(day=rng.randint(1, 28)), rng.randint(1, 90000)))
    # one account holds most payments
    for i in range(300):
        payments.append((len(payments) + 1, units[2][1], dt.date(2025, 2, 1 + i % 28), 11))
    return {
        "buildings": spark.createDataFrame(buildings, "id long, nombre string, saldo_cents long"),
        "units": spark.createDataFrame(units, "uf_id long, cvu string, consorcio_id long, departamento string, pct_bp long"),
        "costs": spark.createDataFrame(costs, "consorcio_id long, fecha date, ord_cents long, ext_cents long"),
        "payments": spark.createDataFrame(payments, "id_pago long, cvu string, fecha date, importe_cents long"),
        "persons": spark.createDataFrame(
            [(u[1], f"{u[0]:08d}", f"N{u[0]}", 'A "<b>"', None if u[0] == 8 else f"u{u[0]}@x.org", "11") for u in units],
            "cvu string, dni string, nombre string, apellido string, email string, telefono string",
        ),
        "raw": (buildings, units, costs, payments),
    }


def expected_lines(raw, first_debt=0):
    _, units, costs, payments = raw
    out = {}
    for uf, cvu, building, _, bp in units:
        debt, before = first_debt, 0
        for period in months(RANGE.first, RANGE.months):
            following = months(period, 2)[1]
            month_costs = [c for c in costs if c[0] == building and c[1].replace(day=1) == period]
            ordinary, extra = sum(c[2] for c in month_costs), sum(c[3] for c in month_costs)
            mine = [p for p in payments if p[1] == cvu and p[2].replace(day=1) == following]
            paid = sum(p[3] for p in mine)
            total = half_away((ordinary + extra) * bp + debt * 10000 + max(debt, 0) * 500, 10000)
            interest = half_away(max(debt, 0) * 500, 10000)
            late = half_away((total - before) * 500, 10000) if mine else interest
            out[uf, period] = (
                half_away(ordinary * bp, 10000), half_away(extra * bp, 10000), debt, interest, total, paid, before, late
            )
            debt, before = total - paid, paid
    return out


LINE = ("ord_cents", "ext_cents", "deuda_cents", "interes_cents", "total_cents", "pagado_cents", "pagado_anterior_cents", "mora_cents")


def detail(world, **kw):
    return st.statement_detail(world["units"], world["costs"], world["payments"], RANGE, **kw)


def test_lines(world):
    got = {(r.uf_id, r.periodo): tuple(r[c] for c in LINE) for r in detail(world).collect()}
    assert got == expected_lines(world["raw"])


def test_lines_carry_on_from_an_opening_debt(spark, world):
    opening = spark.createDataFrame([(u[0], 1234) for u in world["raw"][1]], "uf_id long, deuda_cents long")
    got = {(r.uf_id, r.periodo): tuple(r[c] for c in LINE) for r in detail(world, opening_debt=opening).collect()}
    assert got == expected_lines(world["raw"], 1234)


def test_shares_are_those_of_the_lines(world):
    shares = {(r.uf_id, r.periodo): (r.ord_cents, r.ext_cents) for r in st.statement_shares(world["units"], world["costs"], RANGE).collect()}
    assert shares == {k: v[:2] for k, v in expected_lines(world["raw"]).items()}


def test_previous_debt_is_the_carried_one(world):
    carried = {(r.uf_id, r.periodo): r.saldo_deudor_cents for r in st.previous_debt(detail(world)).collect()}
    assert carried == {k: v[2] for k, v in expected_lines(world["raw"]).items()}


def test_ledgers_give_what_the_lines_give(world, rows):
    """Debts and unpaid sums taken inside the arrays, against the lines made of them."""
    ledgers = st.unit_ledgers(world["units"], world["costs"], world["payments"], RANGE)
    assert ledgers.count() == len(world["raw"][1])
    assert rows(st.ledger_debts(ledgers, RANGE)) == rows(st.previous_debt(detail(world)).select("uf_id", "periodo", "saldo_deudor_cents"))
    for since, until in ((None, None), (dt.date(2024, 12, 10), None), (dt.date(2024, 12, 11), dt.date(2025, 2, 10)), (dt.date(2030, 1, 1), None)):
        lines = detail(world).filter(F.col("vencimiento_1").between(since or dt.date(1900, 1, 1), until or dt.date(2100, 1, 1)))
        owed = F.greatest(F.col("total_cents") - F.col("pagado_cents"), F.lit(0))
        want = {r.uf_id: r.x for r in lines.groupBy("uf_id").agg(F.sum(owed).alias("x")).collect()}
        got = {r.uf_id: r.morosidad_cents for r in st.unpaid_sum(ledgers, RANGE, since, until).collect()}
        assert got == {u[0]: want.get(u[0], 0) for u in world["raw"][1]}
        by_lines = reports.debtors(detail(world), world["units"], world["persons"], since=since, until=until, as_of=dt.date(2026, 1, 1))
        assert rows(reports.ledger_debtors(ledgers, RANGE, world["persons"], since=since, until=until, as_of=dt.date(2026, 1, 1))) == rows(by_lines)


def test_lines_with_payments_alone(world, rows):
    ledgers = st.unit_ledgers(world["units"], world["costs"], world["payments"], RANGE)
    paid = detail(world).filter("primera_fecha is not null")
    assert rows(st.ledger_lines(ledgers, RANGE, paid_only=True)) == rows(paid) and not paid.isEmpty()


def test_carried_columns_reach_the_lines(world, rows):
    carried = st.statement_detail(notifications.with_contacts(world["units"], world["buildings"], world["persons"]),
                                  world["costs"], world["payments"], RANGE, carry=notifications.CONTACT)
    joined = notifications.recipients(detail(world), world["units"], world["buildings"], world["persons"])
    assert rows(notifications.recipients(carried)) == rows(joined)


def test_reports_are_as_of_a_day(world):
    """An open end is the day of the report, not today."""
    day = dt.date(2025, 1, 31)
    months_of = lambda df: {r.Periodo for r in df.collect()}
    assert months_of(reports.income_by_source(applied(world), detail(world), as_of=day)) == {"2024-12", "2025-01"}
    assert reports.ordinary_payment_gaps(with_lines(world), as_of=day).filter(F.col("fecha") > day).isEmpty()


def test_previous_debt_resets_at_a_gap(spark):
    lines = spark.createDataFrame(
        [(1, dt.date(2025, 1, 1), 10, None), (1, dt.date(2025, 3, 1), 20, 5), (1, dt.date(2025, 4, 1), 30, 1)],
        "uf_id long, periodo date, total_cents long, pagado_cents long",
    )
    assert [r.saldo_deudor_cents for r in st.previous_debt(lines).orderBy("periodo").collect()] == [0, 0, 15]


@pytest.mark.parametrize("first_day, rate", [(9, 0), (10, 0), (11, 200), (15, 200), (16, 500), (None, None)])
def test_late_interest_by_first_payment(spark, first_day, rate):
    first = None if first_day is None else dt.date(2025, 5, first_day)
    lines = spark.createDataFrame(
        [(1000, 400, 33, first, dt.date(2025, 5, 10), dt.date(2025, 5, 15))],
        "total_cents long, pagado_anterior_cents long, interes_cents long, primera_fecha date, vencimiento_1 date, vencimiento_2 date",
    )
    assert st.late_interest(lines).first().mora_cents == (33 if rate is None else 600 * rate // 10000)


def test_header(world):
    buildings, units, costs, payments = world["raw"]
    got = {
        (r.consorcio_id, r.periodo): tuple(r)[2:]
        for r in st.statement_header(world["buildings"], world["units"], world["costs"], world["payments"], RANGE).collect()
    }
    for b, _, balance in buildings:
        accounts = {u[1] for u in units if u[2] == b}
        for period in months(RANGE.first, RANGE.months):
            before = period.replace(year=period.year - (period.month == 1), month=(period.month - 2) % 12 + 1)
            mine = [p for p in payments if p[1] in accounts and p[2].replace(day=1) == period]
            earlier = [p for p in payments if p[1] in accounts and p[2].replace(day=1) == before]
            income = sum(p[3] for p in mine)
            overdue = sum(p[3] for p in mine if p[2].day >= 10)
            advance = sum(p[3] for p in earlier if p[2].day > 15)
            expense = sum(c[2] + c[3] for c in costs if c[0] == b and c[1].replace(day=1) == period)
            closing = balance + income - expense
            assert got.pop((b, period)) == (balance, income, overdue, advance, expense, closing)
            balance = closing
    assert not got


def applied(world):
    return st.apply_payments(world["payments"], world["units"], st.statements_of(world["buildings"], RANGE))


def test_payments_apply_once_to_the_month_before(world):
    rows = applied(world).collect()
    assert len({r.id_pago for r in rows}) == len(rows)
    dates = {p[0]: p[2] for p in world["raw"][3]}
    wanted = {i for i, d in dates.items() if RANGE.after(1) <= d.replace(day=1) <= RANGE.after(RANGE.months)}
    assert {r.id_pago for r in rows} == wanted
    for r in rows:
        assert months(r.periodo, 2)[1] == dates[r.id_pago].replace(day=1)
    again = st.apply_payments(world["payments"], world["units"], st.statements_of(world["buildings"], RANGE), applied(world))
    assert again.isEmpty()


def test_received_matches_the_lines(world):
    received = {(r.uf_id, r.periodo): r.pagado_cents for r in st.payments_received(applied(world)).collect()}
    assert received == {k: v[5] for k, v in expected_lines(world["raw"]).items() if v[5]}


def test_costs_go_to_their_month_or_the_first_open_one(world):
    linked = st.link_costs(world["costs"], RANGE).collect()
    assert len(linked) == len(world["raw"][2])
    for r in linked:
        month = r.fecha.replace(day=1)
        assert r.periodo_expensa == (None if month > RANGE.last else max(month, RANGE.first))
    # a link once made is kept by later runs
    later = st.Range(RANGE.after(RANGE.months), RANGE.after(RANGE.months + 2))
    again = st.link_costs(st.link_costs(world["costs"], RANGE), later).collect()
    for r in again:
        month = r.fecha.replace(day=1)
        assert r.periodo_expensa == (max(month, RANGE.first) if month <= RANGE.last else month if month <= later.last else None)


def test_weekly_flow_of_one_statement(world):
    statements = st.statements_of(world["buildings"], RANGE)
    rows = reports.weekly_flow(world["costs"], statements, world["buildings"], "Norte", 2025, 1).orderBy("Semana").collect()
    costs = [c for c in world["raw"][2] if c[0] == 1 and (c[1].year, c[1].month) == (2025, 1)]
    total = sum(c[2] + c[3] for c in costs)
    assert rows[-1].Acumulado_Progresivo == f"{total / 100:,.2f}"
    assert {r.Promedio_Periodo for r in rows} == {f"{half_away(total, len(rows)) / 100:,.2f}"}
    assert {(r.Nombre_Consorcio, r.Periodo, r.ID_Expensa) for r in rows} == {("Norte", "2025-01", 1202501)}


def test_weekly_flow_errors_are_distinct(world):
    statements = st.statements_of(world["buildings"], RANGE)
    with pytest.raises(ValueError, match="named"):
        reports.weekly_flow(world["costs"], statements, world["buildings"], "Este", 2025, 1)
    with pytest.raises(ValueError, match="no statement"):
        reports.weekly_flow(world["costs"], statements, world["buildings"], "Norte", 2026, 1)


def test_department_table_does_not_fan_out(world):
    table = reports.department_month_table(applied(world), world["units"], 1, 2025)
    total = sum(float(r.Total) for r in table.collect())
    mine = [r for r in applied(world).collect() if r.consorcio_id == 1 and r.fecha.year == 2025]
    assert round(total * 100) == sum(r.importe_cents for r in mine)


def test_departments_without_payments_on_request(spark, world):
    units = world["units"].unionByName(spark.createDataFrame([(99, "x", 1, "Z", 0)], world["units"].schema))
    without = reports.department_month_table(applied(world), units, 1, 2025)
    with_all = reports.department_month_table(applied(world), units, 1, 2025, include_unpaid=True)
    assert {r.departamento for r in with_all.collect()} - {r.departamento for r in without.collect()} == {"Z"}
    grid = reports.department_months(applied(world), units, 1, 2025, include_unpaid=True)
    assert grid.count() == 12 * with_all.count()


def test_income_by_source_adds_up(world):
    rows = reports.income_by_source(applied(world), detail(world), since=dt.date(2025, 1, 1), until=dt.date(2025, 3, 31)).collect()
    assert {r.Periodo for r in rows} == {"2025-01", "2025-02", "2025-03"}
    for r in rows:
        assert r.Total == r.Ordinario + r.Extraordinario + r.Mora
    whole = reports.income_by_source(applied(world), detail(world), as_of=dt.date(2030, 1, 1)).collect()
    assert sorted(whole) == sorted(reports.paid_by_source(detail(world)).collect())
    received = sum(v[5] for v in expected_lines(world["raw"]).values() if v[0] + v[1] + v[7] > 0)
    assert abs(sum(r.Total for r in whole) * 100 - received) < 1


def test_reports_come_in_order(world):
    """Reports 1 to 3 as they are read: by building and date, by department, by month."""
    statements = st.statements_of(world["buildings"], RANGE)
    weeks = [(r.ID_Consorcio, r.Anio, r.Mes, r.Semana) for r in reports.weekly_flow(world["costs"], statements, world["buildings"]).collect()]
    assert weeks == sorted(weeks) and len({w[0] for w in weeks}) > 1
    units = world["units"].withColumn("departamento", F.chr((F.col("uf_id") % 3 + 65).cast("int")))
    table = [(r.consorcio_id, r.anio, r.departamento) for r in reports.department_month_table(applied(world), units).collect()]
    assert table == sorted(table) and len(table) > 2
    months_ = [r.Periodo for r in reports.paid_by_source(detail(world)).collect()]
    assert months_ == sorted(months_) and len(months_) > 2


def test_very_large_sums_of_millionths(spark):
    """Millionths of this many amounts do not fit in BIGINT."""
    n, amount = 40_000, 4 * 10**14
    lines = spark.range(n).select(
        "id", F.lit(dt.date(2025, 1, 1)).alias("periodo"), F.lit(amount).alias("pagado_cents"), F.lit(dt.date(2025, 2, 3)).alias("primera_fecha"),
        F.lit(3).alias("ord_cents"), F.lit(1).alias("ext_cents"), F.lit(0).alias("mora_cents"))
    (r,) = reports.paid_by_source(lines).collect()
    assert (r.Periodo, int(r.Total), int(r.Ordinario)) == ("2025-02", n * amount // 100, n * amount * 3 // 400)


def test_top_months(world):
    statements = st.statements_of(world["buildings"], RANGE)
    rows = reports.top_months(world["costs"], statements, applied(world), 2, year=2025).collect()
    assert [r.Tipo for r in rows] == ["Ingreso"] * 2 + ["Gasto"] * 2
    assert all(r.Anio == 2025 for r in rows) and rows[0].Monto >= rows[1].Monto and rows[2].Monto >= rows[3].Monto


def test_debtors_and_their_document(world):
    owed = reports.debtors(detail(world), world["units"], world["persons"], building_id=2, since=dt.date(2024, 12, 10))
    lines = expected_lines(world["raw"])
    sums = {}
    for (uf, period), v in lines.items():
        if 1 + uf % 2 == 2 and period >= dt.date(2024, 12, 1):
            sums[f"{uf:08d}"] = sums.get(f"{uf:08d}", 0) + max(v[4] - v[5], 0)
    assert {r.dni: r.morosidad_cents for r in owed.collect()} == {k: v for k, v in sums.items() if v > 1}
    best = sorted(((k, v) for k, v in sums.items() if v > 1), key=lambda kv: (-kv[1], kv[0]))[:3]
    assert [r.dni for r in reports.top_debtors(owed).orderBy(F.desc("morosidad")).collect()] == [k for k, _ in best]
    import xml.etree.ElementTree as tree

    root = tree.fromstring(xml.debtors_document(owed).first()[0])
    assert root.tag == "mayoresMorosos"
    assert [e.get("dni") for e in root] == [k for k, _ in best]
    assert root[0].find("apellido").text == 'A "<b>"'


def with_lines(world):
    shares = st.statement_shares(world["units"], world["costs"], RANGE)
    return applied(world).join(shares.drop("consorcio_id"), ["uf_id", "periodo"])


def test_shares_without_the_lines_are_the_same(world, rows):
    carried = st.apply_payments(
        world["payments"], world["units"], st.statements_of(world["buildings"], RANGE), carry=("pct_bp",)
    )
    columns = ["id_pago", "ord_cents", "ext_cents"]
    assert rows(st.with_shares(carried, world["costs"]).select(*columns)) == rows(with_lines(world).select(*columns))


def test_gap_document_nests(world, tmp_path, spark):
    import glob
    import xml.etree.ElementTree as tree

    gaps = reports.ordinary_payment_gaps(with_lines(world))
    xml.write_gaps(gaps, str(tmp_path / "gaps"))
    body = "".join(open(f).read() for f in sorted(glob.glob(str(tmp_path / "gaps" / "part-*"))))
    root = tree.fromstring(f"<pagosOrdinarios>{body}</pagosOrdinarios>")
    rows = gaps.collect()
    ids = [int(e.get("id")) for e in root]
    assert ids == sorted({r.uf_id for r in rows}) and sum(len(e) for e in root) == len(rows)
    for unit in root:
        days = [dt.date.fromisoformat(p.get("fecha")) for p in unit]
        assert days == sorted(days) and unit[0].get("diasDesdeAnterior") is None
        assert [int(p.get("diasDesdeAnterior")) for p in unit[1:]] == [(b - a).days for a, b in zip(days, days[1:])]


def test_gaps_filters(world):
    some = reports.ordinary_payment_gaps(with_lines(world), unit_id=3, since=dt.date(2025, 2, 1), until=dt.date(2025, 2, 28))
    assert {r.uf_id for r in some.collect()} <= {3} and some.filter("primero").count() <= 1


def test_payloads(world):
    import json

    rows = notifications.recipients(detail(world), world["units"], world["buildings"], world["persons"])
    sent = notifications.payloads(rows, "admin@example.org").collect()
    assert len(sent) == 7 * RANGE.months  # one holder has no address
    message = json.loads(sent[0].payload)
    assert message["personalizations"][0]["to"][0]["email"] == sent[0].email
    assert message["from"]["email"] == "admin@example.org"
    assert "&lt;b&gt;" in message["content"][0]["value"] and "<b>" not in message["content"][0]["value"]


def test_range_limits():
    with pytest.raises(ValueError):
        st.Range(dt.date(2025, 2, 1), dt.date(2025, 1, 1))
    assert RANGE.months == 6 and RANGE.after(-1) == dt.date(2024, 10, 1)


def test_costs_of_a_very_large_building_are_charged(spark):
    """Every unit's share rounds to 0.00 %, yet the lines add up to the cost."""
    from condoflow.plans.annexes import share_of_total

    n, key = 60_000, F.col("id")
    units = share_of_total(spark.range(n).select(
        key.alias("uf_id"), key.cast("string").alias("cvu"), F.lit(1).cast("bigint").alias("consorcio_id"), (key % 70 + 30).alias("m2"),
    ))
    costs = spark.createDataFrame([(1, dt.date(2025, 1, 5), 10**9 + 7, 500)], "consorcio_id long, fecha date, ord_cents long, ext_cents long")
    paid = spark.createDataFrame([], "id_pago long, cvu string, fecha date, importe_cents long")
    one = st.Range(dt.date(2025, 1, 1), dt.date(2025, 1, 1))
    got = st.statement_detail(units, costs, paid, one).agg(F.sum("ord_cents"), F.min("ord_cents"), F.sum("total_cents")).first()
    assert units.agg(F.max("pct_bp")).first()[0] == 0
    assert abs(got[0] - 10**9 - 7) <= n / 2 and got[1] > 0 and abs(got[2] - 10**9 - 507) <= n / 2
