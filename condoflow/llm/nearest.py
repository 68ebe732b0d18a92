"""Approximate nearest neighbours by cosine: one hierarchical navigable small-world graph for each shard of the vectors.

Equal vectors are indexed once, with the few smallest ids that an answer can need.  The distinct vectors are dealt to shards by
hash; a task builds the graph of a shard and writes it as flat arrays.  Vectors stand in the order of falling level, so that
the vectors of a layer are a prefix and a layer is one matrix of neighbours, -1 where there is none.  Vectors are inserted in
batches that grow with the graph: a beam search of the whole batch finds candidates, which join those of the batch itself, and of
them each vector keeps those that are nearer to it than to a neighbour kept before; then neighbours link back under the same rule.
Each block of queries meets each graph in one task, candidates are scored in doubles on the original vectors, and the answers of
all shards are merged.

Defined results: rows whose id is null and vectors that are null, empty, all zero, or hold null or non-finite entries take no part;
a row that repeats an id counts once, with the smallest vector of that id; vectors are compared with those of their own length
only; a query with fewer candidates than asked for gets all; equal scores go by id; extra columns are ignored whatever their
names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import mix, staged

SHARD = 4096  # vectors of a graph
QUERIES = 2048  # queries that meet a graph at once
NEIGHBOURS = 16  # kept for a vector in the upper layers; twice as many in the lowest
EXPLORE = 80  # candidates of a search while building
BEAM = 160  # candidates of a search for an answer
FIRST = 64  # vectors linked by comparing all of them
BATCH = 256
SPREAD = 4  # partitions for each shard, so that few share one


def unit(v: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; first by a power of two, so that no square leaves the range of doubles."""
    _, power = np.frexp(np.abs(v).max(axis=1, initial=0))
    v = np.ldexp(v, -power[:, None])
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def spread_out(near: np.ndarray, among: np.ndarray, valid: np.ndarray, most: int) -> np.ndarray:
    """Which candidates each row keeps, at most ``most``: candidates stand in falling similarity ``near``, ``among`` is theirs to each other.

    A candidate is kept if it is nearer to the row than to any kept one; free places go to the nearest of the rest.
    """
    rows, width = near.shape
    kept = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -2.0, near.dtype)  # each candidate's similarity to the kept ones
    count = np.zeros(rows, np.int64)
    for c in range(width):
        good = valid[:, c] & (count < most) & (closest[:, c] < near[:, c])
        kept[:, c] = good
        count += good
        np.maximum(closest, np.where(good[:, None], among[:, c], -2.0), out=closest)
    rest = valid & ~kept
    return kept | rest & (np.cumsum(rest, axis=1) <= (most - count)[:, None])


class Graph:
    """Layers over unit vectors in order of falling level; ``sizes[k]`` vectors are in layer k, ``links[k]`` are their neighbours."""

    def __init__(self, vectors: np.ndarray, sizes: list[int], links: list[np.ndarray]):
        self.vectors, self.sizes, self.links = vectors, sizes, links

    @classmethod
    def build(cls, vectors: np.ndarray, sizes: list[int], neighbours: int = NEIGHBOURS, explore: int = EXPLORE) -> Graph:
        links = [np.full((n, neighbours * (1 if k else 2)), -1, np.int32) for k, n in enumerate(sizes)]
        graph, done, total = cls(vectors, sizes, links), 0, len(vectors)
        while done < total:
            upto = min(total, max(FIRST, done + min(done, BATCH)))
            graph.insert(done, upto, explore)
            done = upto
        return graph

    def insert(self, done: int, upto: int, explore: int) -> None:
        """Links the vectors from ``done`` to ``upto`` with each other and with the graph of those before."""
        new = np.arange(done, upto)
        enter = np.zeros(len(new), np.int64)
        for k in range(len(self.sizes) - 1, -1, -1):
            before, here = min(done, self.sizes[k]), new[new < self.sizes[k]]
            ids = np.full((len(new), 0), -1, np.int64)
            if before:
                ids, sims = self.walk(self.vectors[new], enter[:, None], k, explore if len(here) else 1, before)
                enter = ids[:, 0]
            if not len(here):
                continue
            ids = ids[: len(here)]
            batch = self.vectors[here] @ self.vectors[here].T
            np.fill_diagonal(batch, -3)
            own = np.argsort(-batch, axis=1, kind="stable")[:, : min(explore, len(here) - 1)]
            ids = np.concatenate([ids, here[own]], axis=1)
            if ids.shape[1]:
                self.choose(here, ids, k)

    def choose(self, rows: np.ndarray, ids: np.ndarray, k: int) -> None:
        """Gives rows their neighbours among candidates ``ids`` and links those back."""
        width = self.links[k].shape[1]
        most = width if k else width // 2
        near = np.where(ids >= 0, np.einsum("rd,rcd->rc", self.vectors[rows], self.vectors[ids]), -3)
        order = np.argsort(-near, axis=1, kind="stable")[:, : 2 * width]
        ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
        kept = self.kept(ids, near, most)
        place = np.cumsum(kept, axis=1) - 1
        r, c = np.nonzero(kept)
        self.links[k][rows[r], place[r, c]] = ids[r, c]
        self.link_back(ids[r, c], rows[r], near[r, c], k)

    def kept(self, ids: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
        v = self.vectors[ids]
        return spread_out(near, v @ v.transpose(0, 2, 1), ids >= 0, most)

    def link_back(self, to: np.ndarray, new: np.ndarray, near: np.ndarray, k: int) -> None:
        """Adds ``new`` to the neighbours of ``to``; where there are too many, the rule of ``choose`` decides among the nearest."""
        links, width = self.links[k], self.links[k].shape[1]
        once = ~(links[to] == new[:, None]).any(axis=1)
        to, new, near = to[once], new[once], near[once]
        if not len(to):
            return
        order = np.lexsort((-near, to))
        to, new = to[order], new[order]
        rows, first, count = np.unique(to, return_index=True, return_counts=True)
        at = np.arange(len(to)) - np.repeat(first, count)
        extra = np.full((len(rows), min(int(count.max()), width)), -1, np.int64)
        fits = at < extra.shape[1]
        extra[np.repeat(np.arange(len(rows)), count)[fits], at[fits]] = new[fits]
        free = (links[rows] < 0).sum(axis=1)
        roomy = count <= free
        for j in range(int(count[roomy].max(initial=0))):
            add = roomy & (count > j)
            links[rows[add], width - free[add] + j] = extra[add, j]
        full, extra = rows[~roomy], extra[~roomy]
        for i in range(0, len(full), BATCH):
            part = full[i : i + BATCH]
            ids = np.concatenate([links[part], extra[i : i + BATCH]], axis=1)
            near = np.where(ids >= 0, np.einsum("rd,rcd->rc", self.vectors[part], self.vectors[ids]), -3)
            best = np.argsort(-near, axis=1, kind="stable")
            ids, near = np.take_along_axis(ids, best, 1), np.take_along_axis(near, best, 1)
            kept = self.kept(ids, near, width)
            place = np.cumsum(kept, axis=1) - 1
            r, c = np.nonzero(kept)
            links[part] = -1
            links[part[r], place[r, c]] = ids[r, c]

    def walk(self, asked: np.ndarray, enter: np.ndarray, k: int, beam: int, size: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest vectors found in layer k for each asked vector, nearest first, -1 where there are fewer.

        Every step opens the ``at_once`` nearest vectors of each beam that are still closed, until all of it are open.
        """
        n, links = len(asked), self.links[k]
        row = np.arange(n)[:, None]
        seen = np.zeros((n, size + 1), bool)  # the last column stands for no vector
        seen[row, enter] = seen[:, size] = True
        ids = np.concatenate([enter, np.full((n, max(0, beam - enter.shape[1])), size)], axis=1)
        sims = np.where(ids < size, np.einsum("rd,rcd->rc", asked, self.vectors[np.minimum(ids, size - 1)]), np.float32(-3))
        opened = ids >= size
        active = np.arange(n)
        while len(active):
            i, s, o, q = ids[active], sims[active], opened[active], active[:, None]
            pick = np.argsort(np.where(o, np.float32(4), -s), axis=1, kind="stable")[:, :at_once]
            there = ~np.take_along_axis(o, pick, 1)
            from_ = np.where(there, np.take_along_axis(i, pick, 1), size)
            np.put_along_axis(o, pick, True, 1)
            found = np.where((from_ < size)[:, :, None], links[np.minimum(from_, size - 1)], -1).reshape(len(active), -1).astype(np.int64)
            found = np.where((found >= 0) & (found < size), found, size)
            found.sort(axis=1)
            found[:, 1:][found[:, 1:] == found[:, :-1]] = size
            found = np.where(seen[q, found], size, found)
            seen[q, found] = True
            near = np.full(found.shape, -3, np.float32)
            a, b = np.nonzero(found < size)
            near[a, b] = np.einsum("pd,pd->p", asked[active[a]], self.vectors[found[a, b]])
            i, s, o = np.concatenate([i, found], 1), np.concatenate([s, near], 1), np.concatenate([o, found >= size], 1)
            best = np.argpartition(-s, beam - 1, axis=1)[:, :beam] if s.shape[1] > beam else np.broadcast_to(np.arange(s.shape[1]), s.shape)
            ids[active], sims[active], opened[active] = np.take_along_axis(i, best, 1), np.take_along_axis(s, best, 1), np.take_along_axis(o, best, 1)
            active = active[~opened[active].all(axis=1)]
        best = np.argsort(-sims, axis=1, kind="stable")
        ids = np.take_along_axis(ids, best, 1)
        return np.where(ids < size, ids, -1), np.take_along_axis(sims, best, 1)

    def search(self, asked: np.ndarray, beam: int) -> np.ndarray:
        """Numbers of the ``beam`` nearest vectors found, -1 where there are fewer."""
        enter = np.zeros((len(asked), 1), np.int64)
        for k in range(len(self.sizes) - 1, 0, -1):
            enter = self.walk(asked, enter, k, 1, self.sizes[k], 1)[0][:, :1]
        return self.walk(asked, enter, 0, beam, len(self.vectors))[0]


def levels(hashes: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Level of each vector, geometric by its hash."""
    u = (mix(hashes.astype(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    return np.minimum((-np.log(1 - u) / np.log(neighbours)).astype(np.int64), 12)


def usable(v: Column) -> Column:
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda c: c != 0)


def vectors_of(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """One row (id, v) for each id that takes part."""
    given = embeddings.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return given.where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v"))


def distinct_vectors(rows: DataFrame, copies: int) -> DataFrame:
    """Each vector once, with its smallest ids; only so many of an equal group leave a task."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = rows.withColumn("nth", nth).where(F.col("nth") <= copies)
    return few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


GRAPHS = "d int, shard int, vectors binary, ids array<array<long>>, sizes array<int>, links array<binary>"


def build_graph(table: pa.Table) -> pa.Table:
    """The graph of a shard as one row of flat arrays; its order and levels depend on the vectors only."""
    hashes = table["h"].to_numpy()
    level = levels(hashes)
    order = np.lexsort((hashes, -level))
    v = matrix(table["v"])[order]
    sizes = [int((level >= k).sum()) for k in range(int(level.max()) + 1)]
    graph = Graph.build(unit(v).astype(np.float32), sizes)
    return pa.table({
        "d": pa.array([v.shape[1]], pa.int32()), "shard": table["shard"][:1], "vectors": pa.array([v.tobytes()]),
        "ids": pa.array([table["ids"].take(pa.array(order)).to_pylist()], pa.list_(pa.list_(pa.int64()))),
        "sizes": pa.array([sizes], pa.list_(pa.int32())), "links": pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary()))})


def graphs(distinct: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row for each shard: original vectors in doubles, ids, sizes of layers and neighbours.

    Building takes much time for few bytes, so the shards are dealt to partitions of a stated number, which Spark does not merge.
    """
    count = distinct.groupBy(F.size("v").alias("d")).agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    tasks = SPREAD * (count.agg(F.sum("shards")).first()[0] or 1)
    h = F.xxhash64("v")
    dealt = distinct.withColumn("d", F.size("v")).join(count, "d").select("d", F.pmod(h, "shards").cast("int").alias("shard"), h.alias("h"), "v", "ids")
    return dealt.repartition(tasks, "d", "shard").groupBy("d", "shard").applyInArrow(build_graph, GRAPHS)


def answers(index: pa.Table, queries: pa.Table, k: int, beam: int) -> pa.Table:
    """The k best of one shard for each of a block of queries."""
    out = {"query": [], "id": [], "score": []}
    schema = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
    if not len(index) or not len(queries):
        return pa.table(out, schema)
    d = index["d"][0].as_py()
    original = unit(np.frombuffer(index["vectors"][0].as_buffer(), np.float64).reshape(-1, d))
    links = [np.frombuffer(b.as_buffer(), np.int32) for b in index["links"][0]]
    sizes = index["sizes"][0].as_py()
    graph = Graph(original.astype(np.float32), sizes, [x.reshape(n, -1) for x, n in zip(links, sizes)])
    ids, asked, names = index["ids"][0].as_py(), unit(matrix(queries["v"])), queries["id"].to_pylist()
    for i in range(0, len(asked), BATCH):
        found = graph.search(asked[i : i + BATCH].astype(np.float32), beam)
        score = np.clip(np.einsum("rd,rcd->rc", asked[i : i + BATCH], original[found]), -1, 1)
        score[found < 0] = -2
        best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
        # One vector more than asked for, as the query's own may hold no other id; ties at the end are rounded alike.
        for name, row, s in zip(names[i : i + BATCH], np.take_along_axis(found, best, 1).tolist(), np.take_along_axis(score, best, 1).tolist()):
            near = sorted((-x, j) for f, x in zip(row, s) if f >= 0 for j in ids[f] if j != name)[:k]
            out["query"] += [name] * len(near)
            out["id"] += [j for _, j in near]
            out["score"] += [-x for x, _ in near]
    return pa.table(out, schema)


def nearest(embeddings: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            shard: int = SHARD, beam: int = BEAM, block: int = QUERIES) -> DataFrame:
    """``query``, ``rank`` from 1, ``id`` and ``score`` of the k nearest other rows of each row of which ``query`` (on ``id``) holds."""
    rows = staged(vectors_of(embeddings, id_col, vector_col))
    index = staged(graphs(staged(distinct_vectors(rows, k + 1)), shard))
    asked = rows.where(query)
    parts = -(-asked.count() // block) or 1
    shards = index.groupBy("d").agg(F.max("shard").alias("last"))
    each = lambda last: F.explode(F.sequence(F.lit(0), last))
    queries = asked.withColumn("d", F.size("v")).join(shards, "d").select(
        "d", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "v", each(F.col("last")).alias("shard"))
    left = index.withColumn("part", each(F.lit(parts - 1))).groupBy("d", "shard", "part")
    found = left.cogroup(queries.groupBy("d", "shard", "part")).applyInArrow(
        lambda a, b: answers(a, b, k, beam), "query long, id long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query", "rank", "id", "score")


def op11_nearest_neighbours(embeddings: DataFrame) -> DataFrame:
    """Five nearest rows of every row whose id is divisible by 50."""
    return nearest(embeddings, F.col("id") % 50 == 0).select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
