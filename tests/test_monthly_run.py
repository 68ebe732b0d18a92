"""The monthly chain on invented files: two months, a repeated drop, a failing drop."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from condoflow import schemas
from condoflow.plans import statements as st
from condoflow.plans.monthly_run import MonthlyFiles, run_month
from condoflow.plans import ingest
from condoflow.sources.versions import OPEN, Snapshot, read_table

ACCOUNTS = [f"{i:022d}" for i in range(1, 5)]
COSTS = {"BANCARIOS": "1,000.00", "GASTOS GENERALES": "500,00"}


def document(building, month, **amounts):
    return {"_id": {"$oid": f"{building}{month}"}, "Nombre del consorcio": building, "Mes": month} | amounts


def drop(folder, month, payments, documents=None):
    """Files of one month: two buildings, four units, one document per building unless others are given."""
    folder.mkdir()
    texts = {
        "buildings": "Consorcio,Nombre,Domicilio,Cant,m2\nConsorcio 1,Norte,Calle Uno 10,2,100\nConsorcio 2,Sur,Calle Dos 20,2,100\n",
        "persons": "Nombre;apellido;DNI;email;tel;CVU;Inquilino\n"
        + "".join(f"N{i};Paz;{i};n {i}@x.org;11{i};{a};{i % 2}\n" for i, a in enumerate(ACCOUNTS, 1))
        + "Mal;Paz;99;x;1;3,62E+21;1\n",
        "unit_holders": "CVU|Nombre|nro|piso|departamento\n"
        + "".join(f"{a}|{'Norte' if i <= 2 else 'Sur'}|{i}|PB|A\n" for i, a in enumerate(ACCOUNTS, 1)),
        "unit_sizes": "\t".join("abcdefghij") + "\n"
        + "".join(f"{'Norte' if i <= 2 else 'Sur'}\t{i}\tPB\tA\t50,00\t{i}0\tSI\tNO\t3\t0\n" for i in range(1, 5)),
        "suppliers": "﻿;;;Nombre del consorcio\nGASTOS BANCARIOS;BANCO UNO - Comision;;Norte\n",
        "costs": json.dumps([document(n, month, **COSTS) for n in ("Norte", "Sur")] if documents is None else documents),
        "payments": "id,fecha,cvu,valor\n" + "".join(f"{i},{d},{a},$ {v}\n" for i, d, a, v in payments),
    }
    paths = {}
    for name, text in texts.items():
        path = folder / name
        path.write_bytes(text.encode("utf-8"))
        paths[name] = str(path)
    return MonthlyFiles(**paths)


def table(spark, root, name):
    return read_table(spark, root, name)


def test_two_months_and_a_failure(spark, tmp_path):
    root = str(tmp_path / "root")
    may = st.Range(dt.date(2025, 5, 1), dt.date(2025, 5, 1))
    june = st.Range(dt.date(2025, 6, 1), dt.date(2025, 6, 1))
    banks = spark.createDataFrame([("9" * 22, "Titular", 100000), ("8" * 22, "Titular", 200000)], schemas.TABLES["cuenta_bancaria"])
    first = drop(tmp_path / "may", "mayo ", [(1, "05/05/2025", ACCOUNTS[0], "100.00")])
    run_month(spark, root, first, may, 2025, accounts=banks)

    assert {r.nombre: r.id for r in table(spark, root, "consorcio").collect()} == {"Norte": 1, "Sur": 2}
    assert table(spark, root, "persona").count() == 4  # the rounded account is refused
    units = table(spark, root, "unidad").collect()
    assert sorted((u.uf_id, u.consorcio_id, u.pct_bp) for u in units) == [(1, 1, 5000), (2, 1, 5000), (3, 2, 5000), (4, 2, 5000)]
    costs = {(c.consorcio_id, c.tipo_servicio): c for c in table(spark, root, "gasto_ordinario").collect()}
    assert costs[1, "BANCARIOS"].empresa == "BANCO UNO" and costs[2, "BANCARIOS"].empresa is None
    assert costs[1, "GASTOS GENERALES"].empresa in schemas.GENERAL_VENDORS
    refused = {(r.origen, r.motivo): r.detalle for r in table(spark, root, "rechazo").collect()}
    assert list(refused) == [("persons", "cuenta o documento ilegible")] and "3,62E+21" in refused[list(refused)[0]]
    lines = {(r.uf_id, r.periodo.month): r for r in table(spark, root, "detalle_expensa").collect()}
    assert {k: r.total_cents for k, r in lines.items()} == {(u, 5): 75000 for u in range(1, 5)}
    # accounts go to buildings in order; a balance becomes the closing one, also in the bank account: 2000 + 100 - 1500
    assert {r.id: r.saldo_cents for r in table(spark, root, "consorcio").collect()} == {1: 200000 + 10000 - 150000, 2: 100000 - 150000}
    assert {r.cvu[0]: r.saldo_cents for r in table(spark, root, "cuenta_bancaria").collect()} == {"8": 60000, "9": -50000}

    second = drop(tmp_path / "june", "junio", [
        (1, "05/05/2025", ACCOUNTS[0], "100.00"), (2, "12/06/2025", ACCOUNTS[0], "750.00"), (3, "20/06/2025", ACCOUNTS[1], "250.00"),
    ])
    run_month(spark, root, second, june, 2025)
    assert [table(spark, root, t).count() for t in ("consorcio", "persona", "unidad", "pago", "cochera", "baulera")] == [2, 4, 4, 3, 4, 4]
    lines = {(r.uf_id, r.periodo.month): r for r in table(spark, root, "detalle_expensa").collect()}
    # payments of June settle the lines of May, and only what is left is carried on with interest
    assert [lines[u, 5].pagado_cents for u in (1, 2, 3, 4)] == [75000, 25000, 0, 0]
    assert [lines[u, 6].deuda_cents for u in (1, 2, 3, 4)] == [0, 50000, 75000, 75000]
    assert [lines[u, 6].total_cents for u in (1, 2, 3, 4)] == [75000, 75000 + 52500, 75000 + 78750, 75000 + 78750]
    assert lines[1, 5].mora_cents == 3750 and lines[1, 6].pagado_anterior_cents == 75000
    headers = {(r.consorcio_id, r.periodo.month): r for r in table(spark, root, "expensa").collect()}
    assert headers[1, 6].saldo_anterior_cents == headers[1, 5].saldo_cierre_cents
    assert table(spark, root, "pago_aplicado").count() == 2
    assert {r.nombre for r in table(spark, root, "tipo_rol").collect()} == {"Inquilino", "Propietario"}
    assert table(spark, root, "forma_de_pago").count() == 3

    with pytest.raises(ValueError):
        run_month(spark, root, second, june, 2025)
    broken = MonthlyFiles(**{**second.__dict__, "payments": str(tmp_path / "missing")})
    with pytest.raises(Exception):
        run_month(spark, root, broken, st.Range(dt.date(2025, 7, 1), dt.date(2025, 7, 1)), 2025)
    assert table(spark, root, "expensa").count() == 4
    assert table(spark, root, "detalle_expensa").agg(F.sum("pagado_cents")).first()[0] == 100000


def month(m):
    return st.Range(dt.date(2025, m, 1), dt.date(2025, m, 1))


PAYMENTS = {  # by the month of the drop that brings them
    5: [(1, "05/05/2025", ACCOUNTS[0], "100.00")],
    6: [(2, "12/06/2025", ACCOUNTS[0], "750.00"), (3, "20/06/2025", ACCOUNTS[1], "250.00")],
    7: [(4, "09/07/2025", ACCOUNTS[2], "1000.00"), (5, "16/07/2025", ACCOUNTS[3], "10.00")],
}
NAMES = {5: "mayo", 6: "junio", 7: "julio"}


@pytest.fixture(scope="module")
def banks(spark):
    return spark.createDataFrame([("9" * 22, "Titular", 100000), ("8" * 22, "Titular", 200000)], schemas.TABLES["cuenta_bancaria"])


@pytest.fixture(scope="module")
def three_months(spark, tmp_path_factory, banks):
    """Three months one by one, and the tables after each."""
    folder = tmp_path_factory.mktemp("steps")
    root = folder / "root"
    states = [Snapshot.open(spark, str(root))]
    for m in (5, 6, 7):
        run_month(spark, str(root), drop(folder / str(m), NAMES[m], PAYMENTS[m]), month(m), 2025, accounts=banks)
        states.append(Snapshot.open(spark, str(root)))
    return root, states


def test_a_month_writes_only_what_it_touches(three_months):
    """Each run writes its own partitions and those its payments settle."""
    root, (before, *states) = three_months
    wrote = {}
    for m, after in zip((5, 6, 7), states):
        for t in schemas.PARTITION_BY:
            old = {f.path for f in before.folders.get(t, ())}
            wrote[m, t] = {f.partition[-2:] for f in after.folders.get(t, ()) if f.path not in old}
            # what a run leaves alone is listed as it was, and its own folders hold nothing else
            held = {p.parent.name + "/" + p.name for p in (root / after.version).glob(f"{t}-*/particion=*")}
            assert held == {"/".join(f.path.rsplit("/", 2)[1:]) for f in after.folders.get(t, ()) if f.path.startswith(after.version)}
        before = after
    assert {m: wrote[m, "pago"] for m in (5, 6, 7)} == {5: {"05"}, 6: {"06"}, 7: {"07"}}
    assert {m: wrote[m, "gasto_ordinario"] for m in (5, 6, 7)} == {5: {"05"}, 6: {"06"}, 7: {"07"}}
    assert {m: wrote[m, "expensa"] for m in (5, 6, 7)} == {5: {"05"}, 6: {"06"}, 7: {"07"}}
    # payments of June settle lines of May, so June changes these and adds its own; likewise July with June
    assert {m: wrote[m, "detalle_expensa"] for m in (5, 6, 7)} == {5: {"05"}, 6: {"05", "06"}, 7: {"06", "07"}}
    assert {m: wrote[m, "pago_aplicado"] for m in (5, 6, 7)} == {5: set(), 6: {"05"}, 7: {"06"}}
    assert not list(root.glob("version-*/steps"))
    assert {r.tabla: r.registros for r in before.audit().collect()} == {t: before.read(t).count() for t in schemas.TABLES}
    assert {t: before.rows(t) for t in ("pago", "expensa", "detalle_expensa")} == {
        t: before.read(t).count() for t in ("pago", "expensa", "detalle_expensa")} == {"pago": 5, "expensa": 6, "detalle_expensa": 12}


def test_month_by_month_equals_one_run_over_all(spark, tmp_path, rows, three_months, banks):
    steps, whole = str(three_months[0]), str(tmp_path / "whole")
    every = drop(tmp_path / "all", "", [p for m in (5, 6, 7) for p in PAYMENTS[m]],
                 [document(n, NAMES[m], **COSTS) for m in (5, 6, 7) for n in ("Norte", "Sur")])
    run_month(spark, whole, every, st.Range(dt.date(2025, 5, 1), dt.date(2025, 7, 1)), 2025, accounts=banks)
    for t in ("pago", "pago_aplicado", "expensa", "consorcio", "cuenta_bancaria", "unidad", "persona", "cochera", "baulera", "detalle_expensa"):
        assert rows(table(spark, steps, t)) == rows(table(spark, whole, t)), t
    costs = ["consorcio_id", "fecha", "tipo_servicio", "importe_cents", "periodo_expensa"]
    assert rows(table(spark, steps, "gasto_ordinario").select(costs)) == rows(table(spark, whole, "gasto_ordinario").select(costs))


def test_every_cost_is_charged_exactly_once(spark, tmp_path):
    """Costs of a month may come before their month or after its statement; each document is a cost or has its reason.

    A payment of June comes in August, when the lines of May that it settles are long issued.
    """
    root = str(tmp_path / "root")
    documents = {
        5: [document("Norte", "mayo", BANCARIOS="10,00"), document("Norte", "julio", SEGUROS="70,00"), document("Oeste", "mayo", SEGUROS="1,00")],
        6: [document("Norte", "junio", BANCARIOS="20,00"), document("Sur", "mayo", BANCARIOS="5,00"), document("Norte", "mayo", BANCARIOS="99,00"),
            document("Sur", "abril", LIMPIEZA="3,00"), document("Sur", "nunca", LIMPIEZA="3,00")],
        7: [document("Norte", "junio", BANCARIOS="20,00"), document("Sur", "agosto", BANCARIOS="8,00"), document("Sur", "julio", LIMPIEZA="x", SEGUROS="2,00")],
        8: [document("Norte", "agosto", BANCARIOS="1,00")],
    }
    extra = [(1, "Obra", "0000000001", dt.date(2025, 4, 9), 400, "x", True, 1, 400)]
    fields = [f for f in schemas.TABLES["gasto_extraordinario"] if f.name != "periodo_expensa"]
    open_costs = {}
    for m in (5, 6, 7, 8):
        more = spark.createDataFrame(extra, type(schemas.TABLES["rechazo"])(fields)) if m == 6 else None
        payments = [(1, "20/06/2025", ACCOUNTS[1], "2.50")] if m == 8 else [(90 + m, "01/01/2020", ACCOUNTS[0], "1.00")]
        run_month(spark, root, drop(tmp_path / str(m), "", payments, documents[m]), month(m), 2025, extraordinary=more)
        open_costs[m] = Snapshot.open(spark, root).read("gasto_ordinario", {OPEN}).count()
    assert open_costs == {5: 1, 6: 1, 7: 1, 8: 0}
    charged = {(r.consorcio_id, r.fecha.month, r.tipo_servicio): (r.importe_cents, r.periodo_expensa.month) for r in table(spark, root, "gasto_ordinario").collect()}
    assert charged == {
        (1, 5, "BANCARIOS"): (1000, 5), (1, 7, "SEGUROS"): (7000, 7), (1, 6, "BANCARIOS"): (2000, 6), (2, 5, "BANCARIOS"): (500, 6),
        (2, 4, "LIMPIEZA"): (300, 6), (2, 8, "BANCARIOS"): (800, 8), (2, 7, "SEGUROS"): (200, 7), (1, 8, "BANCARIOS"): (100, 8),
    }
    assert [r.periodo_expensa for r in table(spark, root, "gasto_extraordinario").collect()] == [dt.date(2025, 6, 1)]
    spent = {(r.consorcio_id, r.periodo.month): r.egresos_cents for r in table(spark, root, "expensa").collect() if r.egresos_cents}
    assert spent == {(1, 5): 1000, (1, 6): 2000 + 400, (2, 6): 800, (1, 7): 7000, (2, 7): 200, (1, 8): 100, (2, 8): 800}
    lines = table(spark, root, "detalle_expensa").agg(F.sum(F.col("ord_cents") + F.col("ext_cents"))).first()[0]
    assert lines == sum(c for c, _ in charged.values()) + 400  # halves of each amount, so nothing is lost by rounding
    reasons = sorted(r.motivo for r in table(spark, root, "rechazo").filter("origen = 'costs'").collect())
    assert reasons == sorted([ingest.REFUSED_BUILDING, ingest.REFUSED_REPEATED, ingest.REFUSED_MONTH, ingest.REFUSED_REPEATED, ingest.REFUSED_AMOUNT])
    now = Snapshot.open(spark, root)
    line = {(r.uf_id, r.periodo.month): r for r in now.read("detalle_expensa").collect()}
    assert (line[2, 5].pagado_cents, line[2, 5].primera_fecha, line[2, 5].total_cents) == (250, dt.date(2025, 6, 20), 500)
    assert line[2, 5].mora_cents == 25 and line[2, 6].pagado_anterior_cents == 250 and line[1, 5].pagado_cents == 0
    assert {f.partition[-2:] for f in now.folders["detalle_expensa"] if f.path.startswith(now.version)} == {"05", "06", "08"}
    assert {f.partition for f in now.folders["pago_aplicado"]} == {"2025-05"}
