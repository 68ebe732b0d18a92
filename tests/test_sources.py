"""File reads with the dirt real drops have; all values are invented."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from condoflow import schemas
from condoflow.plans import ingest
from condoflow.sources import files, versions


def put(folder, name, content, encoding="utf-8"):
    path = folder / name
    path.write_bytes(content.encode(encoding))
    return str(path)


def test_buildings_without_final_newline(spark, tmp_path, rows):
    path = put(tmp_path, "c.csv", "Consorcio,Nombre del consorcio,Domicilio,Cant,m2\nConsorcio 1,Norte,Calle Uno 10,30,1200.5")
    assert [tuple(map(str, r)) for r in rows(files.read_buildings(spark, path).good)] == [
        ("Consorcio 1", "Norte", "Calle Uno 10", "30", "1200.50")
    ]


def test_suppliers_with_bom_and_blank_header_names(spark, tmp_path, rows):
    path = put(tmp_path, "p.csv", "﻿;;;Nombre del consorcio\nGASTOS BANCARIOS;BANCO UNO - Comision;;Norte\nSERVICIOS PUBLICOS;AYSA ;Cuenta 1;Norte\n")
    assert rows(files.read_suppliers(spark, path).good) == [
        ("GASTOS BANCARIOS", "BANCO UNO - Comision", None, "Norte"), ("SERVICIOS PUBLICOS", "AYSA ", "Cuenta 1", "Norte"),
    ]


def test_pipe_and_tab_files(spark, tmp_path, rows):
    holders = put(tmp_path, "u.csv", "CVU|Nombre|nro|piso|depto\n0000000000000000000007|Norte|1|PB|A\n")
    assert rows(files.read_unit_holders(spark, holders).good) == [("0000000000000000000007", "Norte", 1, "PB", "A")]
    sizes = put(tmp_path, "s.txt", "a\tb\tc\td\te\tf\tg\th\ti\tj\nNorte\t1\tPB\tA\t2,5\t40\tSI\tNO\t3\t0\n")
    assert rows(files.read_unit_sizes(spark, sizes).good) == [("Norte", "1", "PB", "A", "2,5", "40", "SI", "NO", "3", "0")]


def test_ansi_code_page(spark, tmp_path):
    path = put(tmp_path, "p.csv", "n;a;d;e;t;c;i\nAñá;Núñez;30111222;a b@x.org;1150;0000000000000000000007;1\n", "cp1252")
    row = files.read_persons(spark, path).good.first()
    assert (row.nombre, row.apellido, row.dni, row.inquilino) == ("Añá", "Núñez", 30111222, 1)
    comma = put(tmp_path, "q.csv", 'n,a,d,e,t,c,i\nAna,Paz,1,x,2,"3,62E+21",0\n')
    assert files.read_persons(spark, comma, ",", "UTF-8").good.first().cvu == "3,62E+21"


def test_bad_lines_go_to_the_rejects(spark, tmp_path, rows):
    path = put(tmp_path, "pagos.csv", "id,fecha,cvu,valor\n1,05/04/2025,0000000000000000000007,$ 10.00\nx,05/04/2025,7,$ 1\n3,01/01/2025\n")
    loaded = files.read_payments(spark, path)
    assert [r[0] for r in rows(loaded.good)] == [1]
    # the split does not depend on the columns a reader uses
    assert rows(loaded.good.select("cvu")) == [("0000000000000000000007",)] and loaded.good.count() == 1
    assert rows(loaded.rejected) == [("3,01/01/2025",), ("x,05/04/2025,7,$ 1",)]


def test_empty_and_missing_files_fail(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_payments(spark, put(tmp_path, "e.csv", "id,fecha,cvu,valor\n"))
    with pytest.raises(Exception):
        files.read_payments(spark, str(tmp_path / "nothing.csv"))


COSTS = [
    {"_id": {"$oid": "1"}, "Nombre del consorcio": "Norte", "Mes": "mayo ", "BANCARIOS": "1,234.50",
     "LIMPIEZA": "12,000,00", "SEGUROS": "3.400,25", "GASTOS GENERALES": "0,00"},
    {"_id": {"$oid": "2"}, "Nombre del consorcio": "Sur", "Mes": "??", "BANCARIOS": "1,00"},
    {"_id": {"$oid": "3"}},
]


@pytest.mark.parametrize("as_array", [True, False])
def test_cost_documents(spark, tmp_path, rows, as_array):
    text = json.dumps(COSTS, indent=1) if as_array else "\n".join(json.dumps(c) for c in COSTS)
    docs = files.read_costs(spark, put(tmp_path, "s.json", text), as_array)
    buildings = spark.createDataFrame([(1, "norte "), (2, "SUR")], "id long, nombre string")
    entries = ingest.cost_entries(docs, buildings, 2025)
    may = dt.date(2025, 5, 1)
    assert rows(entries.filter("motivo is null").select("consorcio_id", "fecha", "tipo_servicio", "importe_cents")) == [
        (1, may, "BANCARIOS", 123450), (1, may, "LIMPIEZA", 1200000), (1, may, "SEGUROS", 340025),
    ]
    refused = {r.motivo: r.detalle for r in entries.filter("motivo is not null").collect()}
    assert set(refused) == {ingest.REFUSED_NOT_POSITIVE, ingest.REFUSED_MONTH, ingest.REFUSED_NO_BUILDING}
    assert json.loads(refused[ingest.REFUSED_MONTH]) == {"_id": {"$oid": "2"}, "Nombre del consorcio": "Sur", "Mes": "??", "BANCARIOS": "1,00"}


def test_every_document_is_a_cost_or_has_a_reason(spark, rows):
    texts = [("Norte", "mayo", "1,00"), ("Oeste", "mayo", "1,00"), (" ", "mayo", "1,00"), ("Norte", "mayonesa", "1,00"), ("Norte", "junio", "uno"),
             ("Norte", "julio", "-1,00"), ("Norte", "agosto", " "), ("Norte", None, None), (None, None, None)]
    docs = spark.createDataFrame([((str(i),), *t[:2], t[2]) for i, t in enumerate(texts)],
                                 "_id struct<`$oid`: string>, `Nombre del consorcio` string, Mes string, BANCARIOS string")
    broken = docs.withColumn(files.CORRUPT, F.when(F.col("_id.$oid") == "0", F.lit("{ no json")))
    buildings = spark.createDataFrame([(1, "Norte")], "id long, nombre string")
    reasons = [None, ingest.REFUSED_BUILDING, ingest.REFUSED_NO_BUILDING, ingest.REFUSED_MONTH, ingest.REFUSED_AMOUNT, ingest.REFUSED_NOT_POSITIVE,
               ingest.REFUSED_EMPTY, ingest.REFUSED_MONTH, ingest.REFUSED_NO_BUILDING]
    assert sorted(r.motivo or "" for r in ingest.cost_entries(docs, buildings, 2025).collect()) == sorted(r or "" for r in reasons)
    unreadable = ingest.cost_entries(broken, buildings, 2025).filter(F.col("motivo") == ingest.REFUSED_UNREADABLE)
    assert [r.detalle for r in unreadable.collect()] == ["{ no json"]


@pytest.mark.parametrize("layout", [{"indent": 1}, {"separators": (",", ":")}, {"indent": 4, "separators": (" , ", " : ")}])
def test_one_array_is_read_by_many_tasks(spark, tmp_path, rows, layout):
    docs = [{"_id": {"$oid": str(i)}, "Nombre del consorcio": f'N "_{i}" }}, {{ [x] \\', "Mes": "mayo", "BANCARIOS": str(i)} for i in range(2000)]
    docs[7] = {"_id": {"$oid": "7"}}
    docs.insert(9, {"Nombre del consorcio": "sin clave", "Mes": "junio"})
    docs.insert(0, {"Nombre del consorcio": "primero"})
    path = put(tmp_path, "a.json", json.dumps(docs, ensure_ascii=False, **layout) + "\n")
    whole = files.read_costs(spark, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        cut = files.read_costs(spark, path, record_key=files.RECORD_KEY)
        assert cut.rdd.getNumPartitions() > 4
        assert rows(cut) == rows(whole) and cut.count() == len(docs)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_unbalanced_pieces_of_an_array_are_kept_as_such(spark, tmp_path):
    path = put(tmp_path, "a.json", '[{"_id": {"$oid": "1"}, "Mes": "mayo"}, {"Mes": "junio", "_id": {"$oid": "2"}}, {"_id": {"$oid": "3"}, "Mes": "julio"}]')
    got = files.read_costs(spark, path, record_key=files.RECORD_KEY).collect()
    # the second document does not begin with its key: its text stays with the first one, which is refused whole
    assert [(r._id["$oid"], r.Mes) for r in got if r[files.CORRUPT] is None] == [("2", None), ("3", "julio")]
    assert ["mayo" in r[files.CORRUPT] and "junio" in r[files.CORRUPT] for r in got if r[files.CORRUPT] is not None] == [True]
    assert files.read_array(spark, put(tmp_path, "b.json", "[ ]"), schemas.COST_DOCUMENT, "_id").isEmpty()


def test_lines_with_the_control_character_are_refused(spark, tmp_path, rows):
    path = put(tmp_path, "pagos.csv", "id,fecha,cvu,valor\n1,05/04/2025,7,$ 10.00\n2,05/04/2025,7,$ 1\u0001lost\n")
    loaded = files.read_payments(spark, path)
    assert [r.id_pago for r in loaded.good.collect()] == [1]
    assert rows(loaded.rejected) == [("2,05/04/2025,7,$ 1\u0001lost",)]


def test_lines_in_a_column_parse_like_files(spark, rows):
    df = spark.createDataFrame([("1,05/04/2025,7,$ 1",), ("x,,,",)], "linea string")
    loaded = files.split_rejects(files.parse_lines(df, schemas.PAYMENT_FILE, ","))
    assert rows(loaded.good) == [(1, "05/04/2025", "7", "$ 1")]
    assert rows(loaded.rejected) == [("x,,,",)]


def test_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3).withColumn("p", F.lit(1))
    files.append(df, path, ["p"])
    files.append(df, path, ["p"])
    assert spark.read.parquet(path).count() == 6


def test_a_version_counts_only_after_its_commit(spark, tmp_path, rows):
    root = str(tmp_path / "root")
    seed = spark.createDataFrame([(1, "Inquilino", None)], schemas.TABLES["tipo_rol"])
    assert versions.read_table(spark, root, "tipo_rol").isEmpty()
    first = versions.NewVersion(spark, root)
    first.write("tipo_rol", seed)
    assert versions.read_table(spark, root, "tipo_rol").isEmpty()
    first.commit()
    assert versions.read_table(spark, root, "tipo_rol").count() == 1
    abandoned = versions.NewVersion(spark, root)
    abandoned.write("tipo_rol", seed)
    assert versions.read_table(spark, root, "tipo_rol").count() == 1
    second = versions.NewVersion(spark, root)
    second.write("tipo_rol", seed)
    second.commit()
    assert versions.read_table(spark, root, "tipo_rol").count() == 2
    with pytest.raises(RuntimeError):  # it began before the second one was published
        abandoned.commit()
    assert versions.read_table(spark, root, "tipo_rol").count() == 2
    third = versions.NewVersion(spark, root)
    third.replace("tipo_rol", seed)
    third.commit()
    assert versions.read_table(spark, root, "tipo_rol").count() == 1


def payments_of(spark, *months):
    return spark.createDataFrame([(100 * m + i, 1, "7", dt.date(2025, m, 1 + i), 5) for m in months for i in range(3)], schemas.TABLES["pago"])


def test_facts_are_written_by_month(spark, tmp_path):
    root = str(tmp_path / "root")
    first = versions.NewVersion(spark, root)
    first.write("pago", payments_of(spark, 1, 2).unionByName(spark.createDataFrame([(9, 1, "7", None, 5)], schemas.TABLES["pago"])))
    first.commit()
    held = versions.Snapshot.open(spark, root)
    assert held.partitions("pago") == {"2025-01", "2025-02", versions.OPEN} and held.rows("pago") == 7
    second = versions.NewVersion(spark, root)
    added = second.write("pago", payments_of(spark, 2, 3))
    assert added.count() == 6 and {f.partition for f in second.written["pago"]} == {"2025-02", "2025-03"}
    second.write("pago", payments_of(spark, 1).limit(1), replacing={"2025-01"})
    second.commit()
    now = versions.Snapshot.open(spark, root)
    assert {p: now.read("pago", {p}).count() for p in now.partitions("pago")} == {"2025-01": 1, "2025-02": 6, "2025-03": 3, versions.OPEN: 1}
    # folders of the first run are listed as they are, except the one replaced
    kept = {f.path for f in held.folders["pago"]} & {f.path for f in now.folders["pago"]}
    assert {p.rsplit("=")[-1] for p in kept} == {"2025-02", versions.OPEN}
    assert all("2025-03" in f for f in now.read("pago", {"2025-03"}).inputFiles())
    assert held.read("pago").count() == 7  # a reader of the first run is not disturbed


def test_compaction_keeps_the_rows(spark, tmp_path, rows):
    root = str(tmp_path / "root")
    for _ in range(3):
        version = versions.NewVersion(spark, root)
        version.write("pago", payments_of(spark, 1))
        version.write("rechazo", spark.createDataFrame([("a", "b", "c")], schemas.TABLES["rechazo"]))
        version.commit()
    before = rows(versions.read_table(spark, root, "pago"))
    assert versions.compact(spark, root, many=4) == []
    assert versions.compact(spark, root, many=3) == [("pago", "2025-01"), ("rechazo", versions.WHOLE)]
    assert rows(versions.read_table(spark, root, "pago")) == before and len(versions.Snapshot.open(spark, root).folders["pago"]) == 1


def test_a_damaged_pointer_is_no_first_run(spark, tmp_path):
    root = str(tmp_path / "root")
    version = versions.NewVersion(spark, root)
    version.write("rechazo", spark.createDataFrame([("a", "b", "c")], schemas.TABLES["rechazo"]))
    version.commit()
    (tmp_path / "root" / "pointers" / "00000002").write_text("version-that-is-not-there")
    with pytest.raises(Exception):
        versions.NewVersion(spark, root)
