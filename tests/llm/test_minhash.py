import random

from condoflow.llm.minhash import op5_minhash_dedup
from tests.llm import brute


def test_awkward_rows(spark, rows):
    data = brute.awkward() + [(30 + i, brute.passage(1, 90).replace(f"w{i}", "z"), None, None, None, 1, "", "") for i in range(9)]
    out = op5_minhash_dedup(spark.createDataFrame(data, brute.SCHEMA).repartition(5))
    assert rows(out) == sorted(brute.op5([r[:2] for r in data]), key=repr)


def test_empty_table(spark):
    assert op5_minhash_dedup(spark.createDataFrame([], brute.SCHEMA)).collect() == []


def test_table_against_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(op5_minhash_dedup(docs)) == sorted(brute.op5(given), key=repr)


def test_chains_of_edits(spark, rows):
    random.seed(5)
    data = []
    for g in range(6):
        words = brute.passage(g, (30, 60, 150, 400)[g % 4]).split()
        for i in range(25):
            data.append((g * 100 + i, " ".join(words)))
            words = list(words)
            for _ in range(1 + len(words) // 60):
                words[random.randrange(len(words))] = f"q{random.randrange(10**6)}"
    out = op5_minhash_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    assert rows(out) == sorted(brute.op5(data), key=repr)


def test_different_long_words_link_nothing(spark):
    one, other = brute.thue_morse(2048)
    rest = " ".join(f"w{k}" for k in range(4))
    docs = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} {rest}")]
    out = op5_minhash_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in out} == {1: 1, 2: 2, 3: 1}
