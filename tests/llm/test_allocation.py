import time
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from condoflow.llm.mixing import op7_mixing
from condoflow.llm.quality_rules import op6_quality_rules
from condoflow.llm.sharding import group_ends, op9_sharding, smallest_capacity
from tests.llm import brute


def test_quality_counts_of_awkward_rows(spark):
    data = brute.awkward()
    out = op6_quality_rules(spark.createDataFrame(data, brute.SCHEMA)).collect()
    got = Counter(tuple(r)[:7] for r in out)
    want = Counter()
    for i, t, *_ in data:
        t = t or ""
        w = brute.WORD.findall(t)
        seen = Counter(tuple(w[p : p + 3]) for p in range(len(w) - 2))
        hit = {p + k for p in range(len(w) - 2) if seen[tuple(w[p : p + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if brute.WORD.search(x)]
        want[(i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit),
              len(w) < 50 or 100 * len(hit) > 50 * len(w))] += 1
    assert got == want
    assert not any(r.kept and r.base_failed for r in out)


def test_quality_keeps_good_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = op6_quality_rules(docs).join(labels, "doc_id").where("not base_failed").collect()
    assert all(r.kept == (r.quality == 1) for r in out)


def test_quality_can_be_filtered(spark):
    text = " ".join(f"word{(i * i) % 977} the" for i in range(10_000))
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    out = op6_quality_rules(docs)
    for condition in ("kept", "not base_failed", "n_words > 3 and not kept"):
        for name in ("sort_array(", "split(", "xxhash64("):
            assert plan(out.where(condition)).count(name) == plan(out).count(name)
    timed = lambda df: (time.time(), df.collect(), time.time())
    timed(out)
    (a, _, b), (c, kept, d) = timed(out), timed(out.where("kept or not kept"))
    assert len(kept) == 4 and d - c < 1.2 * (b - a) + 1


def test_quality_of_nothing(spark):
    assert op6_quality_rules(spark.createDataFrame([], brute.SCHEMA)).where("kept").collect() == []


def test_mixing_of_awkward_rows(spark):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA).repartition(4)
    out = op7_mixing(docs).collect()
    assert len(out) == len(data) and sorted(out, key=repr) == sorted(op7_mixing(docs.repartition(2)).collect(), key=repr)
    total = sum(r.size for r in out)
    assert all(r.taken in (0, r.size, 2 * r.size) for r in out)
    assert total * 1.5 - max(r.size for r in out) <= sum(r.taken for r in out) <= total * 1.5
    assert abs(sum({(r.source_size, r.target) for r in out} and {r.target: 0 for r in out}) - 1.5 * total) < 1
    assert op7_mixing(docs.limit(0)).collect() == []


def test_mixing_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op7_mixing(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r)
    for rows in by.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 2 * max(r.size for r in rows)


def test_shards_of_awkward_rows(spark):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA).repartition(4)
    out = op9_sharding(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in data)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(24))
    of = defaultdict(set)
    for r in out:
        of[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    assert op9_sharding(docs.limit(0)).collect() == []


@pytest.mark.parametrize("shards", [1, 5, 24])
def test_capacity_is_the_smallest(spark, shards):
    rows = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("key"), (F.pmod(F.xxhash64("id"), F.lit(97)) + 1).alias("size"))
    sizes = [r["size"] for r in rows.orderBy("key").collect()]

    def needed(capacity):
        n, room = 1, capacity
        for s in sizes:
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    capacity, cuts = smallest_capacity(group_ends(rows), shards)
    assert needed(capacity) <= shards and (capacity == max(sizes) or needed(capacity - 1) > shards)
    assert cuts[-1] == sum(sizes) and len(cuts) == needed(capacity)


def test_shards_are_near_equal(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = [r[0] for r in op9_sharding(docs).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(out) == 24 and max(out) < 1.2 * min(out)
