import datetime as dt

from pyspark.sql import functions as F

from condoflow.operators import gaps, maintenance as m, numbering, quality, ranking
from condoflow.operators.services import unpivot_services
from condoflow.operators.spread import spread_join
from condoflow.functions.text import SERVICES


def test_dense_numbers_over_a_hot_group(spark):
    """One group holds most rows and is spread over many slices; the numbers still run 1..n."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10).alias("g"), (F.col("id") * 7919 % 5000).alias("k")
    )
    got = numbering.dense_numbers(df.repartition(8), ["k"], ["g"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.k, r.numero))
    assert len(got) == 5000
    for pairs in by_group.values():
        assert [n for _, n in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_dense_numbers_without_groups_and_with_null_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5), ("a", 4)], "g string, k int")
    assert sorted((r.k, r.numero) for r in numbering.dense_numbers(df, ["k"]).collect()) == [(1, 1), (2, 2), (4, 3), (5, 4)]
    assert sorted((r.k, r.numero) for r in numbering.dense_numbers(df, ["k"], ["g"]).collect()) == [
        (1, 1), (2, 2), (4, 1), (5, 2),
    ]


def test_dense_numbers_of_equal_rows_are_distinct(spark):
    df = spark.createDataFrame([(1,)] * 50, "k int")
    assert sorted(r.numero for r in numbering.dense_numbers(df, ["k"]).collect()) == list(range(1, 51))


def test_numbering_is_lazy_and_spreads_a_hot_group(spark, tmp_path):
    """No job and no file before an action; equal in every run, also where one group and one key own most rows."""
    hot = spark.range(20_000).select(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("g"), F.lit(1).alias("k"), "id").repartition(7)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    numbered = numbering.continue_ids(numbering.dense_numbers(hot, ["k"], ["g"], name="n"), spark.range(5).toDF("nr"), "nr", ["g", "k"])
    assert jobs() == before
    got, again = ({r.id: (r.n, r.nr) for r in df.collect()} for df in (numbered, numbered))
    assert got == again and sorted(nr for _, nr in got.values()) == list(range(5, 20_005))
    assert sorted(n for i, (n, _) in got.items() if i % 10 < 9) == list(range(1, 18_001))
    keyed = hot.withColumn("_key", F.struct("g", "k", F.xxhash64("id")))
    slices = [r["count"] for r in numbering._with_slice(keyed, 16).groupBy("_slice").count().collect()]
    assert len(slices) == 16 and max(slices) < 2 * 20_000 / 16


def test_dense_numbers_of_nothing_and_by_several_columns(spark):
    df = spark.createDataFrame([(2, None, "b"), (1, 5.0, "a"), (2, 1.0, "c"), (None, 3.0, "d")], "x int, y double, z string")
    assert {r.z: r.numero for r in numbering.dense_numbers(df, ["x", "y"]).collect()} == {"d": 1, "a": 2, "b": 3, "c": 4}
    assert numbering.dense_numbers(df.limit(0), ["x"], ["z"]).collect() == []


def test_continue_ids(spark):
    new = spark.createDataFrame([("b", None), ("a", None)], "nombre string, id long")
    old = spark.createDataFrame([(41,)], "id long")
    assert sorted((r.nombre, r.id) for r in numbering.continue_ids(new, old, "id", ["nombre"]).collect()) == [("a", 42), ("b", 43)]
    empty = old.filter("false")
    assert sorted(r.id for r in numbering.continue_ids(new, empty, "id", ["nombre"]).collect()) == [1, 2]


def test_number_after_continues_per_group(spark):
    rows_in = spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "uf_id long, g long")
    taken = spark.createDataFrame([(10, 5), (10, 9)], "g long, numero long")
    got = numbering.number_after(rows_in, taken, "g", "numero", ["uf_id"])
    assert sorted((r.uf_id, r.numero) for r in got.collect()) == [(1, 10), (2, 11), (3, 1)]


def test_join_by_position(spark):
    left = spark.createDataFrame([("x",), ("y",), ("z",)], "a string")
    right = spark.createDataFrame([(30,), (10,)], "b int")
    got = numbering.join_by_position(left, right, ["a"], ["b"])
    assert sorted((r.a, r.b) for r in got.collect()) == [("x", 10), ("y", 30)]


def test_upsert_keeps_old_values_where_the_new_are_null(spark, rows):
    current = spark.createDataFrame([(1, "Norte", "vieja", 5), (2, "Sur", None, None)], "id int, nombre string, dir string, m2 int")
    incoming = spark.createDataFrame(
        [(" NORTE ", None, 9), ("Este", "nueva", 3), ("Este ", "nueva", 3), (None, "x", 1), (" ", "y", 2)],
        "nombre string, dir string, m2 int",
    )
    once = m.upsert(current, incoming, "nombre", ["dir", "m2"])
    assert rows(once) == [(1, "Norte", "vieja", 9), (2, "Sur", None, None), (None, "Este", "nueva", 3)]
    assert rows(m.upsert(once, incoming, "nombre", ["dir", "m2"])) == rows(once)


def test_fill_nulls_never_overwrites_or_multiplies(spark, rows):
    current = spark.createDataFrame([(1, None, "a"), (2, 7, None), (3, None, None)], "k int, x int, y string")
    source = spark.createDataFrame([(1, 4, "z"), (1, 5, "z"), (2, 8, "w")], "k int, x int, y string")
    assert rows(m.fill_nulls_from(current, source, ["k"], ["x", "y"])) == [(1, 5, "a"), (2, 7, "w"), (3, None, None)]


def test_seed_discover_lookup(spark, rows):
    existing = spark.createDataFrame([("A", "x")], "descripcion string, confirmacion string")
    seeds = spark.createDataFrame([("A", "y"), ("B", "z")], "descripcion string, confirmacion string")
    assert rows(m.seed_if_absent(existing, seeds, "descripcion")) == [("A", "x"), ("B", "z")]
    children = spark.createDataFrame([(" Sur",), ("Sur",), ("norte ",), ("",), (None,)], "nombre string")
    parents = spark.createDataFrame([(1, "Norte")], "id int, nombre string")
    assert rows(m.discover_parents(children, parents, "nombre", "?")) == [("Sur", "?")]
    found = m.scalar_lookup(children, parents, "nombre", "id")
    assert sorted(str(r.id) for r in found.collect()) == ["1", "None", "None", "None", "None"]


def test_drop_all_duplicates_keeps_null_keys(spark, rows):
    df = spark.createDataFrame(
        [(1, "a"), (2, "a "), (3, "b"), (4, None), (5, None)], "id int, k string"
    )
    assert rows(m.drop_all_duplicates(df, "k")) == [(3, "b"), (4, None), (5, None)]


def test_drop_all_duplicates_with_a_hot_key(spark):
    df = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert m.drop_all_duplicates(df.repartition(8), "k").count() == 20000


def test_blank_rows(spark, rows):
    df = spark.createDataFrame([(None, " "), (1, ""), (2, "x"), (None, None)], "i int, s string")
    assert rows(m.drop_blank_rows(df)) == [(1, ""), (2, "x")]
    assert rows(m.require_keys(df, ["s"])) == [(2, "x")]


def test_quality_rules(spark, rows):
    df = spark.createDataFrame(
        [(1, "a", "0012505001"), (2, "a", "0000000000"), (3, None, "12")], "id int, k string, f string"
    )
    parent = spark.createDataFrame([("b",)], "k string")
    found = [
        quality.not_null(df, "n", "k", "id"), quality.unique(df, "u", "k"),
        quality.references(df, "r", "k", parent, "k"),
        quality.check(df, "c", quality.valid_invoice(F.col("f")), "id"),
    ]
    assert [rows(v) for v in found] == [[("n", "3")], [("u", "a")], [("r", "a")], [("c", "2"), ("c", "3")]]
    assert rows(quality.summarize(found)) == [("c", 2), ("n", 1), ("r", 1), ("u", 1)]


def test_payment_gaps_match_lag(spark):
    """Against a plain window, with ties on the date and a unit that holds most payments."""
    from pyspark.sql import Window

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50).alias("uf_id"),
        F.col("id").alias("id_pago"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") * 37 % 200).cast("int")).alias("fecha"),
    )
    w = Window.partitionBy("uf_id").orderBy("fecha", "id_pago")
    plain = df.select(
        "uf_id", "id_pago", F.datediff("fecha", F.lag("fecha").over(w)).alias("dias"),
        F.lag("fecha").over(w).isNull().alias("primero"), F.lead("fecha").over(w).isNull().alias("ultimo"),
    )
    got = gaps.payment_gaps(df).select("uf_id", "id_pago", "dias", "primero", "ultimo")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([("Norte",)], "consorcio string")
    for i, s in enumerate(SERVICES):
        df = df.withColumn(s, F.lit(None if i == 0 else str(i)).cast("string"))
    got = {r.tipo_servicio: r.importe_texto for r in unpivot_services(df, ["consorcio"]).collect()}
    assert got == {s: (None if i == 0 else str(i)) for i, s in enumerate(SERVICES)}


def test_largest_breaks_ties(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "k string, v int")
    assert [r.k for r in ranking.largest(df, 2, "v", ["k"]).collect()] == ["c", "a"]


def test_spread_join_equals_a_plain_join(spark, rows):
    big = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7 % 3).alias("k"))
    per_key = spark.createDataFrame([(1, "a"), (2, "b"), (9, "z")], "k long, v string")
    for how in ("inner", "left"):
        got = spread_join(big, per_key, ["k"], ["id"], how).select("id", "k", "v")
        assert rows(got) == rows(big.join(per_key, "k", how).select("id", "k", "v"))


def test_rules_counted_in_one_pass(spark, rows):
    units = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "x"), (5, "x")] + [(6, "hot")] * 1, "id int, cvu string")
    payments = spark.createDataFrame([("a", 1), ("a", None), ("z", -1), (None, 2), ("z", -5)], "cvu string, v int")
    cvu = F.col("cvu")
    checked = [
        (units, [quality.must_be_unique("unica", cvu), quality.must_exist("paga", cvu), quality.gives("conocida", cvu),
                 quality.must_hold("con id", F.col("id").isNotNull())]),
        (payments, [quality.gives("paga", cvu, F.col("v") > 0), quality.must_exist("conocida", cvu), quality.must_hold("positivo", F.col("v") > 0)]),
    ]
    want = quality.summarize([
        quality.unique(units, "unica", "cvu"), quality.references(units, "paga", "cvu", payments.filter("v > 0"), "cvu"),
        quality.references(payments, "conocida", "cvu", units, "cvu"), quality.check(payments, "positivo", F.col("v") > 0, "cvu"),
    ])
    got = quality.count_violations(checked)
    assert rows(got) == rows(want) == [("conocida", 1), ("paga", 2), ("positivo", 2), ("unica", 2)]
    assert quality.count_violations([(df.limit(0), r) for df, r in checked]).isEmpty()


def test_counts_of_a_join_without_the_join(spark):
    left = spark.createDataFrame([(1,)] * 300 + [(2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(1,)] * 1000 + [(3,), (3,), (None,)], "k int")
    assert quality.joined_count([left, right], "k").first()[0] == left.join(right, "k").count() == 300_002
    assert quality.joined_count([left, right.limit(0)], "k").first()[0] == 0
    counts = quality.audit_counts({"a": left}, {"b": quality.joined_count([left, right], "k")})
    assert {r.tabla: r.registros for r in counts.collect()} == {"a": 303, "b": 300_002}
