import numpy as np

from condoflow.llm.suffix_dedup import deep_shallow_sort, op1_suffix_dedup
from tests.llm import brute


def test_order_is_that_of_the_suffixes():
    data = np.frombuffer((b"abracadabra" * 40 + b"abracadabrb" * 3) * 2, np.uint8)
    starts = np.arange(0, len(data) - 64)
    order, same = deep_shallow_sort(data, starts, 64)
    cut = [data[s : s + 64].tobytes() for s in starts]
    got = [cut[i] for i in order]
    assert got == sorted(cut)
    assert same.tolist() == [False] + [x == y for x, y in zip(got, got[1:])]


def test_awkward_rows(spark, rows):
    data = brute.awkward()
    out = op1_suffix_dedup(spark.createDataFrame(data, brute.SCHEMA).repartition(5))
    assert rows(out) == sorted(brute.op1([r[:2] for r in data]), key=repr)


def test_empty_table(spark):
    assert op1_suffix_dedup(spark.createDataFrame([], brute.SCHEMA)).collect() == []


def test_table_against_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(op1_suffix_dedup(docs)) == sorted(brute.op1(given), key=repr)


def test_many_segments_of_one_anchor(spark, rows):
    line = brute.passage(11, 12)
    data = [(i, f"{brute.passage(100 + i, 40)} {line} {brute.passage(300 + i % 30, 40)}") for i in range(150)]
    out = op1_suffix_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(20))
    assert rows(out) == sorted(brute.op1(data), key=repr)
