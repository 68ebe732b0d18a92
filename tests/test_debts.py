"""Debts carried from month to month against a plain loop, and letters against JSON of their parts."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from condoflow.plans import notifications, statements as st


def plain(charged, paid, num, den, debt):
    out = []
    for i in range(6):
        out.append(debt)
        over = den * 20
        exact = (charged[i] * num * 20 if i < len(charged or []) and charged[i] is not None else 0) + (debt * 20 + max(debt, 0)) * den
        total = (2 * exact + over) // (2 * over) if exact >= 0 else -((-2 * exact + over) // (2 * over))
        debt = total - (paid or {}).get(i, 0)
    return [*out, debt]


def test_debts_are_those_of_a_plain_loop(spark):
    rng = random.Random(4)
    rows = [(k, [rng.choice([None, 0, 1, rng.randint(-10**6, 10**11)]) for _ in range(rng.choice([0, 6]))], {rng.randrange(6): rng.randint(-5, 10**9) for _ in range(3)},
             rng.randint(0, 999), rng.randint(1, 99999), rng.randint(-10**6, 10**6)) for k in range(300)]
    rows += [(300, None, None, 0, 1, 7), (301, [10**16] * 6, {}, 90, 100, 0)]
    frame = spark.createDataFrame(rows, "id long, c array<long>, p map<int,long>, num long, den long, debt long")
    out = frame.select("id", st.carried_debts(6)(F.col("c"), F.map_keys("p"), F.map_values("p"), "num", "den", "debt").alias("d"))
    assert {r.id: r.d for r in out.collect()} == {k: plain(c or [], p, num, den, debt) for k, c, p, num, den, debt in rows}
    for bad in ((1, [2**62] * 6, {}, 9, 1, 0), (1, [1], {}, 1, 0, 0)):
        with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW|DIVIDE_BY_ZERO"):
            spark.createDataFrame([bad], frame.schema).select(st.carried_debts(6)(F.col("c"), F.map_keys("p"), F.map_values("p"), "num", "den", "debt")).collect()


def test_letters_are_json_of_their_parts_and_made_per_unit(spark):
    day, odd = dt.date(1998, 3, 1), 'a "b" <c> & \\ \n ñ €'
    lines = spark.createDataFrame([(1, day, odd, odd, None, "A", odd, day, dt.date(1998, 3, 15), -5, 0, 123456, 100)],
        "uf_id long, periodo date, email string, nombre string, apellido string, departamento string, consorcio string, vencimiento_1 date, vencimiento_2 date, "
        "total_cents long, mora_cents long, pagado_anterior_cents long, pagado_cents long")
    (r,) = notifications.payloads(lines, odd).collect()
    sent, html = json.loads(r.payload), odd.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert sent["personalizations"] == [{"to": [{"email": odd}], "subject": "Expensa Mensual"}] and sent["from"] == {"email": odd, "name": "Sistema de Expensas"}
    assert sent["content"][0]["value"].startswith(
        f"<h1> {html}</h1><p>Detalle de su expensa de 03/1998, unidad A del consorcio {html}.</p><ul class=\"importes\"><li>Total a pagar: $-0.05</li>"
        "<li>Saldo anterior abonado: $1234.56</li><li>Pagos recibidos: $1.00</li><li>Interés por mora: $0.00</li></ul><ul class=\"vencimientos\"><li>01/03/1998: sin")
    assert set(notifications.LETTER) <= set(notifications.letters(lines, odd).columns)
