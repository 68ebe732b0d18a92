import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from condoflow.llm.ranked_search import Block, op13_ranked_search, search
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
ITEMS = [
    (1, brute.passage(1, 30)), (2, "One,TWO"), (3, None), (4, "  --  "), (None, "the THE word"), (10, brute.passage(2, 90)),
    (12, "É" * 10 + " ÉÉ"), (13, "nowhere"), (2, brute.passage(3, 12)), (14, brute.passage(7, 1500)), (15, "ab the the"),
]


def plain(docs, items, most=10):
    words = [(i, TERM.findall((t or "").translate(LOW))) for i, t in docs]
    counts = [(i, len(w), Counter(w)) for i, w in words if w]
    n_docs, n_terms = len(counts), sum(n for _, n, _ in counts)
    df = Counter(t for _, _, c in counts for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall((t or "").translate(LOW)))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, n, c in counts:
            m = 10 + 90 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        out += [(item, rank + 1, i, s) for rank, (_, _, i, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:most])]
    return sorted(out, key=repr)


def frames(spark, docs, items=ITEMS):
    return spark.createDataFrame(docs, brute.SCHEMA), spark.createDataFrame([(*i, 1, "x", "y") for i in items], "item_id long, text string, w int, term string, block string")


def test_awkward_rows(spark, rows):
    data = brute.awkward()
    docs, items = frames(spark, data)
    want = plain([r[:2] for r in data], ITEMS)
    assert rows(op13_ranked_search(docs, items)) == want
    assert rows(op13_ranked_search(docs.repartition(9), items.repartition(3))) == want


def test_small_blocks_and_groups_give_the_same(spark, rows):
    data = brute.awkward()
    docs, items = frames(spark, data)
    assert rows(search(items, docs, most=3, block_text=2000, group=2)) == plain([r[:2] for r in data], ITEMS, 3)


def test_given_tables_against_brute_force(spark, rows):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(op13_ranked_search(docs, items)) == plain(given, [tuple(r) for r in items.select("item_id", "text").collect()])


def test_hot_term_and_many_copies(spark, rows):
    data = [(i, "common " * (i % 3 + 1) + ("rare" if i % 50 == 0 else f"own{i}")) + (None,) * 6 for i in range(600)]
    items = [(1, "common rare"), (2, "common"), (3, "own7 own8 rare")]
    docs, asked = frames(spark, data, items)
    assert rows(op13_ranked_search(docs.repartition(20), asked)) == plain([r[:2] for r in data], items)


@pytest.mark.parametrize("docs, items", [([], ITEMS), (brute.awkward(), []), ([(1, None) + (None,) * 6, (2, " - ") + (None,) * 6], ITEMS), ([], [])])
def test_nothing_to_find(spark, docs, items):
    assert op13_ranked_search(*frames(spark, docs, items)).collect() == []


def test_masks_and_bounds_hold():
    rng = np.random.default_rng(5)
    block = Block(list(range(300)), rng.integers(1, 400, 300).tolist(), 300, 60000)
    for _ in range(70):
        docs = np.sort(rng.choice(300, rng.integers(1, 120), replace=False)).astype(np.int32)
        block.docs.append(docs)
        block.tfs.append(rng.integers(1, 9, len(docs)).astype(np.int32))
        block.w.append(int(rng.integers(1, 5000)))
    terms = list(range(70))
    bits, order, first = block.masks(terms)
    assert sorted(order) == list(range(300)) and len({b.tobytes() for b in bits}) == len(bits)
    bound = block.bounds(terms, bits, np.minimum.reduceat(block.m[order], first))
    for g, (a, b) in enumerate(zip(first, [*first[1:], 300])):
        assert all([int(d in set(block.docs[t].tolist())) for t in terms] == bits[g].tolist() for d in order[a:b][:2])
        assert (block.scores(terms, order[a:b]) <= bound[g]).all()
    assert set(block.best(terms, 10)[1]) <= set(np.sort(block.scores(terms, np.arange(300)))[-10:])
