"""Ranked lexical search: the best documents of every item, by presence masks over an inverted index.

Tasks index the documents block by block: for each term of a block the places of the documents that hold it and how often.  Only
terms of some item are kept, by a join.  A block meets a group of items in one task; there the postings of an item become bitmaps
of the block's documents, one bit for each term, and documents with equal masks form a group.  No document of a group can score
more than its mask with the most occurrences of each term and the shortest document; groups are scored by falling bound until the
last place of the item's list beats the next bound, so nothing that could enter the list is left out.  The lists of all blocks are
merged by item.

The score of a document is the sum over the item's terms, once each, of w * ((10**9 * tf) div (1000 * tf + 8 * m)); w falls with
the number of documents that hold the term, m = 10 + (90 * n * N) div L grows with the length n of the document.  Terms of weight 0
add nothing and are left out before the join.

Defined results: null and empty texts hold no terms, do not count in N and are never found; an item without terms, or of which no
document holds a term, has no rows; rows of one item id are one item with the terms of all, a null id is an item too; rows of
one document id are documents of their own, each with its own rank; equal scores go by document id, null last; extra columns are
ignored whatever their names; empty tables give no rows.  Texts of any length are indexed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import LOWER, blocks, staged, text_bytes, words_in

BLOCK_TEXT = 8 << 20  # bytes of text in a block of documents; a longer document is a block of its own
GROUP = 256  # items searched together in a block
CELLS = 1 << 20  # entries of a matrix of masks and terms handled at once
IS_TERM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
HEADER = "\0"  # first character of the key of a block's own row; no term holds it


def terms_of(data: np.ndarray, offs: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct terms of some texts, and the number of the term and the text of every occurrence."""
    data = LOWER[data]
    starts, ends, row = words_in(data, offs, IS_TERM)
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=at[1:])
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at), pa.py_buffer(data[IS_TERM[data]])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), row


def texts_in(batch: pa.RecordBatch, limit: int):
    """(first row, rows, bytes, offsets) of ranges of a batch of (id, text)."""
    data, offs = text_bytes(batch.column(1))
    for i, j in blocks(offs, limit):
        yield i, j - i, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]


INDEX = "block long, term string, df long, total long, docs binary, tfs binary, ids array<long>, ns array<long>"


def index(documents: DataFrame, id_col: str, text_col: str, block_text: int) -> DataFrame:
    """One row for each term of a block, and one header for the block with the ids and lengths of its documents."""

    def build(batches):
        seq, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            for i, n_rows, data, offs in texts_in(batch, block_text):
                block, seq = (part << 32) + seq, seq + 1
                terms, code, row = terms_of(data, offs)
                ns = np.bincount(row, minlength=n_rows)
                pairs, tf = np.unique(code.astype(np.int64) * n_rows + row, return_counts=True)
                first = np.searchsorted(pairs, np.arange(len(terms) + 1, dtype=np.int64) * n_rows)
                cut = pa.py_buffer((4 * first).astype(np.int64))
                binary = lambda x: pa.Array.from_buffers(pa.large_binary(), len(terms), [None, cut, pa.py_buffer(x.astype(np.int32))])
                empty = pa.nulls(len(terms), pa.list_(pa.int64()))
                yield out([np.full(len(terms), block), terms, np.diff(first), np.zeros(len(terms), np.int64), binary(pairs % n_rows), binary(tf), empty, empty])
                yield out([[block], [f"{HEADER}{block}"], [int((ns > 0).sum())], [int(ns.sum())], [None], [None],
                           [batch.column(0).slice(i, n_rows).to_pylist()], [ns.tolist()]])

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def out(columns):
        arrays = [c.cast(k) if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["block", "term", "df", "total", "docs", "tfs", "ids", "ns"])

    return documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(build, INDEX)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, term) of the items."""
    given = items.select(F.col(f"`{id_col}`").alias("item"), F.col(f"`{text_col}`").alias("text"))

    def cut(batches):
        for batch in batches:
            for i, n_rows, data, offs in texts_in(batch, BLOCK_TEXT):
                terms, code, row = terms_of(data, offs)
                pairs = np.unique(code.astype(np.int64) * n_rows + row)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(pairs % n_rows + i)), terms.take(pa.array(pairs // n_rows)).cast(pa.string())], names=["item", "term"])

    return given.mapInArrow(cut, f"item {given.schema['item'].dataType.simpleString()}, term string").distinct()


class Block:
    """Documents of a block with the postings of a group's terms."""

    def __init__(self, ids: list, ns: list[int], n_docs: int, n_terms: int):
        self.ids, self.size = ids, len(ids)
        self.rank = np.empty(self.size, np.int64)  # place of each document in order of ids, null last
        self.rank[sorted(range(self.size), key=lambda k: (ids[k] is None, ids[k]))] = np.arange(self.size)
        wide = 90 * max(ns, default=0) * n_docs >= 2**63
        n = np.array(ns, object if wide else np.int64)
        self.m = (10 + 90 * n * n_docs // n_terms).astype(np.int64)
        self.docs: list[np.ndarray] = []
        self.tfs: list[np.ndarray] = []
        self.w: list[int] = []

    def masks(self, terms: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct presence masks as rows of bits, the documents ordered by mask, and where each mask begins."""
        words = np.zeros((self.size, (len(terms) + 63) // 64), np.uint64)
        for t, k in enumerate(terms):
            words[self.docs[k], t >> 6] |= np.uint64(1 << (t & 63))
        one = words[:, 0] if words.shape[1] == 1 else np.ascontiguousarray(words).view(f"V{8 * words.shape[1]}")[:, 0]
        _, inverse, count = np.unique(one, return_inverse=True, return_counts=True)
        order = np.argsort(inverse, kind="stable")
        first = np.cumsum(count) - count
        bits = np.unpackbits(words[order[first]].view(np.uint8), axis=1, bitorder="little")[:, : len(terms)]
        return bits, order, first

    def bounds(self, terms: list[int], bits: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The most a document of each mask can score: every term as often as anywhere in the block, in the mask's shortest one."""
        tf = np.array([self.tfs[k].max() for k in terms], np.int64)
        w = np.array([self.w[k] for k in terms], np.int64)
        step = max(1, CELLS // max(len(terms), 1))
        return np.concatenate([
            (bits[i : i + step] * (10**9 * tf // (1000 * tf + 8 * least[i : i + step, None]))) @ w for i in range(0, len(bits), step)])

    def scores(self, terms: list[int], docs: np.ndarray) -> np.ndarray:
        total = np.zeros(len(docs), np.int64)
        for k in terms:
            at = np.minimum(np.searchsorted(self.docs[k], docs), len(self.docs[k]) - 1)
            tf = np.where(self.docs[k][at] == docs, self.tfs[k][at], 0).astype(np.int64)
            total += self.w[k] * (10**9 * tf // (1000 * tf + 8 * self.m[docs]))
        return total

    def best(self, terms: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best ``most`` with a score above 0, best first."""
        bits, order, first = self.masks(terms)
        bound = self.bounds(terms, bits, np.minimum.reduceat(self.m[order], first))
        last = np.append(first[1:], self.size)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        queue, taken = np.argsort(-bound, kind="stable"), 0
        size = np.cumsum((last - first)[queue])
        while taken < len(queue):
            top = bound[queue[taken]]
            if top <= 0 or len(docs) == most and scores[-1] > top:
                break
            upto = int(np.searchsorted(size, (size[taken - 1] if taken else 0) + 4 * most)) + 1
            new = np.concatenate([order[first[g] : last[g]] for g in queue[taken:upto]])
            docs, scores, taken = np.append(docs, new), np.append(scores, self.scores(terms, new)), upto
            keep = np.lexsort((self.rank[docs], -scores))[:most]
            docs, scores = docs[keep], scores[keep]
        return docs[scores > 0], scores[scores > 0]


def search(items: DataFrame, documents: DataFrame, most: int = 10, item_col: str = "item_id", item_text: str = "text",
           id_col: str = "doc_id", text_col: str = "text", block_text: int = BLOCK_TEXT, group: int = GROUP) -> DataFrame:
    """``item``, ``rank`` from 1, ``doc`` and ``score`` of the best documents of each item."""
    asked = staged(item_terms(items, item_col, item_text))
    found = index(documents, id_col, text_col, block_text).join(asked.select("term").distinct().withColumn("asked", F.lit(True)), "term", "left")
    postings = staged(found.where(F.col("asked") | F.col("term").startswith(HEADER)).drop("asked"))
    header = F.col("term").startswith(HEADER)
    n_docs, n_terms = postings.where(header).agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    groups = -(-asked.select("item").distinct().count() // group) or 1

    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))
    weights = postings.where(~header).groupBy("term").agg(F.sum("df").alias("df")).select("term", weight.alias("w")).where("w > 0")
    uses = asked.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)).cast("int")).join(weights, "term")
    uses = uses.groupBy("term", "group", "w").agg(F.collect_list(F.struct("item")).alias("items"))
    parts = postings.where(~header).join(uses, "term").select("block", "group", "w", "docs", "tfs", "items", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<long>").alias("ns"))
    own = postings.where(header).select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), F.lit(None).cast("long").alias("w"), "docs", "tfs",
        F.lit(None).cast(uses.schema["items"].dataType).alias("items"), "ids", "ns")
    kind = items.schema[item_col].dataType.simpleString()

    def lists(table: pa.Table) -> pa.Table:
        head = table.filter(pa.compute.is_valid(table["ids"]))
        block = Block(head["ids"][0].as_py(), head["ns"][0].as_py(), n_docs, n_terms)
        of: dict = {}
        rest = table.filter(pa.compute.is_valid(table["w"]))
        for k, (w, docs, tfs, using) in enumerate(zip(*(rest[c] for c in ("w", "docs", "tfs", "items")))):
            block.w.append(w.as_py())
            block.docs.append(np.frombuffer(docs.as_buffer(), np.int32))
            block.tfs.append(np.frombuffer(tfs.as_buffer(), np.int32))
            for use in using.as_py():
                of.setdefault(use["item"], []).append(k)
        rows = []
        for item, terms in of.items():
            docs, scores = block.best(terms, most)
            rows += [(item, block.ids[d], s) for d, s in zip(docs.tolist(), scores.tolist())]
        names, docs, scores = zip(*rows) if rows else ([], [], [])
        return pa.table({"item": pa.array(names, table.schema.field("items").type.value_type.field("item").type), "doc": pa.array(docs, pa.int64()), "score": pa.array(scores, pa.int64())})

    local = own.unionByName(parts).groupBy("block", "group").applyInArrow(lists, f"item {kind}, doc long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= most).select("item", "rank", "doc", "score")


def op13_ranked_search(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Ten best documents of each benchmark item."""
    return search(benchmark, documents).select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents WHERE text IS NOT NULL),
stats AS (SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM docs WHERE len(words) > 0),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL),
spot AS (SELECT r, doc_id, len(words) AS n, unnest(words) AS term FROM docs),
postings AS (SELECT r, doc_id, n, term, count(*) AS tf FROM spot WHERE term IN (SELECT term FROM items) GROUP BY r, doc_id, n, term),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, stats GROUP BY term, n_docs),
scored AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM postings JOIN items USING (term) JOIN weights USING (term), stats GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
