import datetime as dt

from pyspark.sql import functions as F

from condoflow import schemas
from condoflow.plans import annexes, ingest


def test_payments_import_once(spark, rows):
    lines = spark.createDataFrame(
        [(1, "05/04/2025", "7", "$ 10.00"), (1, "05/04/2025", "7", "$10.00"), (2, "31/02/2025", "7", "$ 1"), (None, "01/01/2025", "7", "$ 1"),
         (3, "01/01/2025", "8", "$x"), (4, "02/01/2025", " 9 ", "3.5"), (None, None, None, None)],
        "id_pago long, fecha string, cvu string, valor string",
    )
    new, refused = ingest.import_payments(lines)
    assert rows(new) == [(1, 1, "7", dt.date(2025, 4, 5), 1000), (4, 1, "9", dt.date(2025, 1, 2), 350)]
    assert sorted(r.id_pago for r in refused.collect()) == [2, 3]
    again, _ = ingest.import_payments(lines, new)
    assert again.isEmpty()


def test_payments_that_share_an_id(spark, rows):
    lines = spark.createDataFrame(
        [(1, "05/04/2025", "7", "$ 10.00"), (1, "06/04/2025", "7", "$ 10.00"), (2, "05/04/2025", "7", "$ 1.00")] * 2,
        "id_pago long, fecha string, cvu string, valor string",
    )
    new, refused = ingest.import_payments(lines)
    assert rows(new) == [(2, 1, "7", dt.date(2025, 4, 5), 100)]
    assert sorted(r.id_pago for r in refused.collect()) == [1, 1, 1, 1]


def person(nombre, dni, cvu, tipo):
    return (nombre, "Paz", dni, f" {nombre.lower()} @x.org ", 11, cvu, tipo)


def test_persons(spark, rows):
    lines = spark.createDataFrame(
        [person(" Ana ", 1, "7", 1), person("Eva", 2, "8", 0), person("Leo", 3, "9", 1), person("Luz", 4, "9", 0),
         person("Sol", 5, "10", None), person("Noa", 123456789, "11", 1)],
        schemas.PERSON_FILE,
    )
    known = spark.createDataFrame([("00000002", "8")], "dni string, cvu string")
    assert rows(ingest.import_persons(lines, known).select("nombre", "dni", "email", "cvu", "rol_id")) == [
        ("Ana", "00000001", "ana@x.org", "7", 1), ("Sol", "00000005", "sol@x.org", "10", None),
    ]


def test_rounded_accounts(spark):
    df = spark.createDataFrame([("3,62E+21",), ("0000000000000000000007",), ("abc",)], "c string")
    assert [r[0] for r in df.select(ingest.rounded_account(F.col("c"))).collect()] == [True, False, True]


def test_costs_get_dates_and_invoices(spark, rows):
    docs = spark.createDataFrame(
        [(None, " sur ", "enero", "1,00", None, None, None, None, None, "2,00"),
         (None, "NORTE", "mayo ", None, None, None, "3.000,50", None, None, None),
         (None, "Nadie", "mayo", "1,00", None, None, None, None, None, None)],
        schemas.COST_DOCUMENT,
    )
    buildings = spark.createDataFrame([(1, "Norte"), (2, "Sur")], "id long, nombre string")
    got = ingest.import_costs(docs, buildings, 2025).select("consorcio_id", "fecha", "importe_cents", "tipo_servicio", "nro_factura")
    assert rows(got) == [
        (1, dt.date(2025, 5, 1), 300050, "SEGUROS", "0012505001"),
        (2, dt.date(2025, 1, 1), 100, "BANCARIOS", "0022501002"),
        (2, dt.date(2025, 1, 1), 200, "SERVICIOS PUBLICOS-Luz", "0022501003"),
    ]


def test_supplier_enrichment(spark, rows):
    costs = spark.createDataFrame(
        [(1, "BANCARIOS", None, None), (1, "SERVICIOS PUBLICOS-Agua", None, " "), (1, "GASTOS GENERALES", None, None),
         (1, "SEGUROS", "ya", "puesto"), (2, "BANCARIOS", None, None), (1, "LIMPIEZA", None, None), (1, None, None, None)],
        "consorcio_id long, tipo_servicio string, empresa string, detalle string",
    )
    lines = spark.createDataFrame(
        [("GASTOS BANCARIOS", "UNO - Comision", "", "N"), ("SERVICIOS PUBLICOS", "AYSA ", "Cuenta 1", "N"),
         ("SERVICIOS PUBLICOS", "EDENOR", "cuenta 2", "N"), ("SEGUROS", "OTRO - x", "", "N"), ("GASTOS GENERALES", "Z", "", "N")],
        schemas.SUPPLIER_FILE,
    )
    suppliers = ingest.supplier_rows(lines).withColumn("consorcio_id", F.lit(1))
    assert rows(ingest.enrich_with_suppliers(costs, suppliers)) == sorted([
        (1, "BANCARIOS", "UNO", "Comision"), (1, "SERVICIOS PUBLICOS", "AYSA", "Cuenta 1"),
        (1, "GASTOS GENERALES", None, None), (1, "SEGUROS", "ya", "puesto"), (2, "BANCARIOS", None, None),
        (1, "LIMPIEZA", None, None), (1, None, None, None),
    ], key=repr)


def test_prefix_match_equals_like(spark):
    services = spark.createDataFrame([(1, "BANCARIOS"), (1, "SEGUROS X"), (2, "SEGUROS")], "consorcio_id long, tipo_servicio string")
    suppliers = spark.createDataFrame(
        [(1, "BAN"), (1, "SEGUROS"), (1, "SEGUROS XY"), (2, "SEGUROS"), (2, ""), (2, None)], "consorcio_id long, categoria string"
    )
    got = {(r.consorcio_id, r.tipo_servicio, r.categoria) for r in ingest.match_suppliers(services, suppliers).collect()}
    assert got == {(1, "BANCARIOS", "BAN"), (1, "SEGUROS X", "SEGUROS"), (2, "SEGUROS", "SEGUROS")}


def test_unit_holders(spark, rows):
    lines = spark.createDataFrame(
        [("7", " norte", 1, "PB", "A"), ("8", "Nadie", 2, "1", "B"), ("9", "Norte", 3, "1", "C"), ("9", "Norte", 4, "1", "D"),
         ("5", "Norte", 5, "2", "A"), ("6", "Norte", 6, "2", "B")],
        schemas.UNIT_HOLDER_FILE,
    )
    units = spark.createDataFrame([("6",)], "cvu string")
    buildings = spark.createDataFrame([(1, "Norte")], "id long, nombre string")
    persons = spark.createDataFrame([("7",), ("8",), ("9",), ("6",)], "cvu string")
    new, refused = ingest.import_unit_holders(lines, units, buildings, persons)
    assert rows(new) == [("7", " norte", 1, 1, "PB", "A")]
    assert sorted(r.numero for r in refused.collect()) == [2, 3, 4, 5]


def test_unit_sizes_fill_only_nulls(spark, rows):
    lines = spark.createDataFrame(
        [("Norte", "1", "PB", "A", "2,5", "40,25") + ("",) * 4, ("Norte ", "2", "1", "B", "3", "50") + ("",) * 4,
         ("Oeste", "1", "1", "B", "3", "50") + ("",) * 4, ("", "9", "", "", "1", "1") + ("",) * 4, ("Norte", "dos", "", "", "1", "1") + ("",) * 4],
        schemas.UNIT_SIZE_FILE,
    )
    units = spark.createDataFrame(
        [(1, 1, 1, None, None, None), (2, 1, 2, None, 77, "duplex"), (3, 1, 3, None, None, None)],
        "uf_id long, consorcio_id long, numero int, m2 decimal(10,2), pct_bp long, tipo string",
    )
    buildings = spark.createDataFrame([(1, "Norte")], "id long, nombre string")
    filled, new_buildings = ingest.import_unit_sizes(lines, units, buildings)
    got = {r.uf_id: r for r in filled.collect()}
    assert (str(got[1].m2), got[1].pct_bp, got[1].tipo in schemas.UNIT_TYPES) == ("40.25", 250, True)
    assert (str(got[2].m2), got[2].pct_bp, got[2].tipo) == ("50.00", 77, "duplex")
    assert (got[3].m2, got[3].tipo) == (None, None)
    assert rows(new_buildings) == [("Oeste", schemas.UNKNOWN_ADDRESS)]


def test_general_costs_keep_what_they_have(spark):
    costs = spark.createDataFrame(
        [(1, "gastos generales", None, None), (2, "GASTOS GENERALES", "x", " "), (3, "SEGUROS", None, None)],
        "id long, tipo_servicio string, empresa string, detalle string",
    )
    got = {r.id: (r.empresa, r.detalle) for r in ingest.fill_general_costs(costs, ["id"]).collect()}
    assert got[1][0] in schemas.GENERAL_VENDORS and got[1][1] in schemas.GENERAL_DETAILS
    assert got[2][0] == "x" and got[2][1] in schemas.GENERAL_DETAILS
    assert got[3] == (None, None)


def test_building_upsert_is_repeatable(spark, rows):
    lines = spark.createDataFrame(
        [("1", "Norte", "Calle 1", 3, None), ("2", " Sur ", "Calle 2", 3, None), ("3", None, "x", 1, None)],
        schemas.BUILDING_FILE,
    )
    old = spark.createDataFrame([(4, "NORTE", None, "vieja", None, 5)], schemas.TABLES["consorcio"])
    once = ingest.import_buildings(lines, old)
    assert rows(once.select("id", "nombre", "direccion")) == [(4, "NORTE", "Calle 1"), (5, "Sur", "Calle 2")]
    assert rows(ingest.import_buildings(lines, once)) == rows(once)


def test_annexes(spark, rows):
    units = spark.createDataFrame([(1, 10, 40), (2, 10, 60), (3, 20, 0), (4, 10, None)], "uf_id long, consorcio_id long, m2 int")
    existing = spark.createDataFrame([(1, 7)], "uf_id long, numero long")
    parking = annexes.new_annexes(units, existing, annexes.PARKING_WEIGHT)
    assert rows(parking.select("uf_id", "numero", "pct_bp")) == [(2, 8, 6000), (3, 1, 0), (4, 9, None)]
    storage = annexes.new_annexes(units, existing.filter("false"), annexes.STORAGE_WEIGHT)
    assert rows(storage.select("uf_id", "numero", "pct_bp")) == [(1, 1, 2000), (2, 2, 3000), (3, 1, 0), (4, 3, None)]


def test_shares_add_up(spark):
    units = spark.range(30).select(F.col("id").alias("uf_id"), F.lit(1).alias("consorcio_id"), (F.col("id") + 1).alias("m2"))
    assert abs(annexes.share_of_total(units).agg(F.sum("pct_bp")).first()[0] - 10000) <= 15
