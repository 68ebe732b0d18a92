"""Report 3 splits every payment, not what a line received in all."""

import datetime as dt
from decimal import Decimal

from condoflow import registry
from condoflow.plans import reports


def tables(spark, folder):
    """One building and unit with costs of 1 cent (ordinary) and 2 cents (extraordinary) in May 1996, paid in June by four payments of 1 cent."""
    may, june = dt.date(1996, 5, 7), dt.date(1996, 6, 3)
    for name, rows, schema in (
        ("nation", [(1, "Norte")], "n_nationkey int, n_name string"),
        ("supplier", [(1, 1, 0.0)], "s_suppkey long, s_nationkey int, s_acctbal double"),
        ("customer", [(7, 1)], "c_custkey long, c_nationkey int"),
        ("orders", [(k, 7, june, 0.01) for k in range(1, 5)], "o_orderkey long, o_custkey long, o_orderdate date, o_totalprice double"),
        ("lineitem", [(1, 1, 1, 1, may, 0.01, "N"), (2, 1, 1, 1, may, 0.02, "R")],
         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate date, l_extendedprice double, l_returnflag string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_each_payment_is_split(spark, tmp_path):
    tables(spark, tmp_path)
    (r,) = registry.queries()["r3_income_by_source"](spark, str(tmp_path)).collect()
    # thirds of a cent four times: 3333 and 6667 millionths each; of 4 cents at once 13333 and 26667
    assert (r.Periodo, Decimal(r.Ordinario), Decimal(r.Extraordinario), Decimal(r.Mora)) == ("1996-06", Decimal("0.013332"), Decimal("0.026668"), 0)


def test_rounding_is_that_of_the_payments(spark):
    applied = spark.createDataFrame(
        [(k, 1, 1, dt.date(2025, 1, 1), dt.date(2025, 2, 1 + k), 1) for k in range(4)],
        "id_pago long, uf_id long, consorcio_id long, periodo date, fecha date, importe_cents long")
    lines = spark.createDataFrame(
        [(1, 1, dt.date(2025, 1, 1), 1, 2, 0), (2, 1, dt.date(2025, 1, 1), 1, 0, 0)],
        "uf_id long, consorcio_id long, periodo date, ord_cents long, ext_cents long, mora_cents long")
    (r,) = reports.payments_by_source(applied, lines, building_id=1, as_of=dt.date(2030, 1, 1)).collect()
    assert (r.Ordinario, r.Extraordinario, r.Total) == (Decimal("0.013332"), Decimal("0.026668"), Decimal("0.040000"))
    assert reports.payments_by_source(applied, lines, since=dt.date(2025, 2, 2), until=dt.date(2025, 2, 3)).first().Total == Decimal("0.020000")
    assert reports.payments_by_source(applied, lines, building_id=2, as_of=dt.date(2030, 1, 1)).count() == 0


def test_a_repeated_unit_row_has_its_lines_twice_but_no_payment_more_often(spark):
    payments = spark.createDataFrame([(k, "7", dt.date(2025, 1, 1), dt.date(2025, 2, 1), 100) for k in range(2)], "id_pago long, cvu string, periodo date, fecha date, importe_cents long")
    lines = spark.createDataFrame([("7", 1, dt.date(2025, 1, 1), 1, 3, 0)] * 2, "cvu string, consorcio_id long, periodo date, ord_cents long, ext_cents long, mora_cents long")
    (r,) = reports.payments_by_source(payments, lines, building_id=1, as_of=dt.date(2030, 1, 1), unit="cvu").collect()
    assert (r.Ordinario, r.Total) == (Decimal("1"), Decimal("4"))
