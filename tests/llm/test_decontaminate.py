import pytest
from pyspark.sql import functions as F

from condoflow.llm.decontaminate import find_benchmark, op10_decontaminate
from tests.llm import brute

ITEMS = [
    (1, brute.passage(1, 30)), (2, "One,TWO"), (3, None), (4, "  --  "), (None, "the the the the the the the the the the the"),
    (10, brute.passage(2, 11)), (11, brute.passage(1, 30)), (12, "ÉÉÉÉ"), (13, "word"), (2, brute.passage(3, 12)),
]


def test_awkward_rows(spark, rows):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA)
    out = op10_decontaminate(docs, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert rows(out) == sorted(brute.op10([r[:2] for r in data], ITEMS), key=repr)


@pytest.mark.parametrize("items", [[], [(1, None)], [(1, "-")]])
def test_nothing_to_look_for(spark, rows, items):
    data = brute.awkward()
    out = op10_decontaminate(spark.createDataFrame(data, brute.SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(out) == sorted(brute.op10([r[:2] for r in data], []), key=repr)


def test_blocks_give_the_same(spark, rows):
    docs = spark.createDataFrame(brute.awkward(), brute.SCHEMA)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    sides = [find_benchmark(docs, items, block_bytes=n).select("doc", "n_words", "spans", F.array_sort("items")) for n in (1 << 20, 150)]
    assert rows(sides[0]) == rows(sides[1])


def test_empty_table(spark):
    docs, items = spark.createDataFrame([], brute.SCHEMA), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert op10_decontaminate(docs, items).collect() == []


def test_table_against_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    out = rows(op10_decontaminate(docs, items))
    assert out == sorted(brute.op10(given, [tuple(r) for r in items.collect()]), key=repr)
    assert any(r[-1] for r in out)


def test_different_long_words_are_no_hit(spark, rows):
    one, other = brute.thue_morse(2048)
    rest = " ".join(f"w{k}" for k in range(9))
    docs = [(1, f"{one} {rest}"), (2, f"{other} {rest}")]
    items = [(7, f"{one} {rest}")] * 3
    out = op10_decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_hit, r.n_items) for r in out.collect()} == {1: (10, 1), 2: (0, 0)}
