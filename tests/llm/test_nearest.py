import numpy as np
import pytest
from pyspark.sql import functions as F

from condoflow.llm.nearest import Graph, levels, nearest, op11_nearest_neighbours, spread_out, unit

SCHEMA = "vec_id long, embedding array<float>, label int, v string, d string, shard string, ids string"


def cosines(a, b):
    """Cosines of all pairs, in doubles."""
    return unit(a) @ unit(b).T


def brute(rows, k=5, every=50):
    """The k best other rows of each query, ties to the smaller id."""
    ids, v = np.array([i for i, _ in rows]), np.array([x for _, x in rows], float)
    out = {}
    for q in np.nonzero(ids % every == 0)[0]:
        s = cosines(v[q : q + 1], v)[0]
        order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[j]), s[j]) for j in order]
    return out


def answered(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items()])


@pytest.mark.parametrize("shard", [4096, 300])
def test_recall_on_the_given_table(spark, shard):
    given = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in given.collect()])
    got = answered(nearest(given, F.col("id") % 50 == 0, shard=shard, block=16).withColumnsRenamed({"query": "query_id", "id": "vec_id"}))
    assert got.keys() == want.keys() and recall(got, want) >= 0.97
    for q, w in want.items():
        right = dict(w)
        assert all(abs(right[i] - s) < 1e-12 for i, s in got[q] if i in right)


def test_graph_on_crowded_vectors():
    """Tight clusters of unlike size: all must stay reachable."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    which = np.minimum(rng.geometric(0.25, 3000) - 1, 11)
    v = unit(centres[which] + 0.05 * rng.normal(size=(3000, 24))).astype(np.float32)
    level = levels(np.arange(3000))
    order = np.argsort(-level, kind="stable")
    v, sizes = v[order], [int((level >= k).sum()) for k in range(level.max() + 1)]
    assert len(sizes) > 2 and sizes[0] == 3000
    graph = Graph.build(v, sizes)
    asked = v[:: 10]
    best = np.argsort(-(asked @ v.T), axis=1)[:, :6]
    found = graph.search(asked, 96)
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(best.tolist(), found.tolist())]) > 0.97
    for k, links in enumerate(graph.links):
        assert ((links >= -1) & (links < sizes[k])).all() and (links != np.arange(sizes[k])[:, None]).all()
        assert all(len(set(x[x >= 0])) == (x >= 0).sum() for x in links)


def test_neighbours_are_spread_out():
    near = np.array([[0.9, 0.8, 0.7, 0.1]])
    among = np.array([[[1, 0.95, 0.2, 0], [0.95, 1, 0.2, 0], [0.2, 0.2, 1, 0], [0, 0, 0, 1.0]]])
    assert spread_out(near, among, np.ones((1, 4), bool), 2).tolist() == [[True, False, True, False]]
    assert spread_out(near, among, np.ones((1, 4), bool), 4).tolist() == [[True] * 4]


def test_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4)]) for i in range(1, 60)]
    rows += [(100 + i, rows[0][1]) for i in range(40)] + [(150, [3e38, 0.0, 0.0, 0.0]), (200, [1e-40, 0.0, 0.0, 0.0])]
    odd = [(250, None), (300, [0.0] * 4), (350, [1.0, None, 0.0, 0.0]), (400, [float("nan")] * 4), (450, [float("inf")] + [0.0] * 3), (500, []),
           (None, [1.0] * 4), (550, [1.0, 2.0]), (600, [2.0, 1.0]), (50, rows[49][1])]
    df = spark.createDataFrame([(i, x, 1, "v", "d", "s", "i") for i, x in rows + odd], SCHEMA).repartition(6)
    got = answered(op11_nearest_neighbours(df))
    want = brute([(i, np.array(x, np.float32).astype(float)) for i, x in rows])
    assert got.keys() == want.keys() | {550, 600}
    for q, w in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in w] and np.allclose([s for _, s in got[q]], [s for _, s in w], atol=1e-12)
    assert [i for i, _ in got[100]] == [1, 101, 102, 103, 104]
    assert [i for i, _ in got[550]] == [600] and abs(got[600][0][1] - 0.8) < 1e-12


def test_repeated_id_counts_once(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r)[:3] for r in op11_nearest_neighbours(df).collect()] == [(0, 1, 1)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0])], [(1, [1.0]), (2, [1.0])]])
def test_nothing_to_find(spark, rows):
    assert op11_nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_order_of_rows_does_not_matter(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert answered(op11_nearest_neighbours(df)) == answered(op11_nearest_neighbours(df.orderBy(F.rand(3)).repartition(5)))
