"""Near-duplicate documents: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document is its set of word shingles.  Equal sets are merged first, so that copies never meet in a bucket.  Sets of more
than SMALL shingles get one value per bin of a single permutation; an empty bin takes over a filled one that a universal hash
picks, and bands of bins become bucket keys.  Smaller sets use the least shingles that a partner must share (an exact
prefix), because few distinct shingles cannot fill the bins independently.  In each bucket every member is paired with one
centre only.  Candidate pairs are confirmed on full sets.  Buckets whose members then still belong to several components go
on with further centres, GROWTH times as many each round, pairing only members of different components, until every bucket is either
in one component or exhausted.  Such a pair is formed only if bitmaps of both sets allow the similarity: a bit that one has and
the other lacks is a shingle they do not share.  No true link that a bucket holds is lost.

Defined results: null text and text without words form an empty set, linked with nothing; the component of rows without an id
that are linked only among themselves is null; null ids come last; rows of equal sets are always in one component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import (
    LOWER, NO_ID, U, RangeHash, blocks, mix, rows_of, staged, text_bytes, word_codes, words_in,
)

ROWS, BANDS = 5, 40  # a pair of similarity 0.75 shares no band with probability 0.00002
GROWTH = 16  # times as many centres in each further round
BITS = 1024  # size of a set's bitmap; large sets fill it and are then told apart by their full sets only
SMALL = 32  # largest set that is looked up by exact prefixes alone


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int):
    """Row and hash of the distinct shingles of each text, ordered by both."""
    data = LOWER[data]
    starts, ends, row = words_in(data, offs)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    spell = RangeHash(word_codes(data, starts, ends))
    n = np.bincount(row, minlength=len(offs) - 1)
    first = np.cumsum(n) - n
    at = np.arange(len(row) - words + 1) if len(row) >= words else np.zeros(0, np.int64)
    at = at[row[at] == row[np.minimum(at + words - 1, len(row) - 1)]]
    few = np.nonzero((n > 0) & (n < words))[0]
    owner = np.concatenate([row[at], few])
    code = np.concatenate([spell(at, at + words), spell(first[few], first[few] + n[few])])
    order = np.lexsort((code, owner))
    owner, code = owner[order], code[order]
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (code[1:] != code[:-1])])
    return owner[new], code[new]


def band_keys(owner: np.ndarray, code: np.ndarray, n_rows: int) -> np.ndarray:
    """Bucket keys, one column per band, of sets given as ordered (row, hash); every row has at least one hash."""
    bins = ROWS * BANDS
    slot = (((code >> U(32)) * U(bins)) >> U(32)).astype(np.int64)
    first = np.concatenate([[True], (owner[1:] != owner[:-1]) | (slot[1:] != slot[:-1])])
    values = np.zeros((n_rows, bins), np.uint64)
    filled = np.zeros((n_rows, bins), bool)
    values[owner[first], slot[first]] = code[first]  # hashes ascend, so the first of a bin is its minimum
    filled[owner[first], slot[first]] = True
    empty_row, empty_bin = np.nonzero(~filled)
    turn = 0
    while len(empty_row):
        donor = (mix(empty_bin.astype(np.uint64) * U(1_000_003) + U(turn)) % U(bins)).astype(np.int64)
        found = filled[empty_row, donor]
        values[empty_row[found], empty_bin[found]] = values[empty_row[found], donor[found]]
        empty_row, empty_bin = empty_row[~found], empty_bin[~found]
        turn += 1
    keys = np.zeros((n_rows, BANDS), np.uint64)
    values = values.reshape(n_rows, BANDS, ROWS)
    for r in range(ROWS):
        keys = mix(keys * U(31) + values[:, :, r])
    return mix(keys + np.arange(BANDS, dtype=np.uint64))


SET = "doc long, d long, th long, n long, s1 long, s2 long, keys array<long>"


def describe_sets(words: int, percent: int):
    """Task: size, two hashes of the whole set, and bucket keys of each text."""

    def of_block(data, offs):
        rows = len(offs) - 1
        owner, code = shingle_sets(data, offs, words)
        n = np.bincount(owner, minlength=rows)
        first = np.cumsum(n) - n
        s1 = RangeHash(code)(first, first + n)
        s2 = RangeHash(mix(code))(first, first + n)
        place = np.arange(len(code)) - first[owner]
        prefix = n - -(-percent * n // 100) + 1
        exact = (n <= SMALL * 100 // percent + 1)[owner] & (place < prefix[owner])
        banded = np.nonzero(n > SMALL)[0]
        renumber = np.full(rows, -1)
        renumber[banded] = np.arange(len(banded))
        mine = renumber[owner] >= 0
        bands = band_keys(renumber[owner[mine]], code[mine], len(banded)) if len(banded) else np.zeros((0, BANDS), np.uint64)
        key = np.concatenate([mix(code[exact] + U(77)), bands.reshape(-1)])
        of = np.concatenate([owner[exact], np.repeat(banded, BANDS)])
        order = np.argsort(of, kind="stable")
        return n, s1, s2, key[order], np.bincount(of, minlength=rows)

    def run(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            parts = [of_block(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) for i, j in blocks(offs)]
            if not parts:
                continue
            n, s1, s2, key, counts = (np.concatenate(x) for x in zip(*parts))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.record_batch(
                [b.column("doc"), b.column("d"), b.column("th"), pa.array(n.astype(np.int64)), pa.array(s1.view(np.int64)),
                 pa.array(s2.view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(key.view(np.int64)))],
                names=["doc", "d", "th", "n", "s1", "s2", "keys"],
            )

    return run


def bitmaps(owner: np.ndarray, code: np.ndarray, n_rows: int) -> np.ndarray:
    """One row of 64-bit words per set, with the bit of each of its hashes."""
    bit = ((code >> U(32)) % U(BITS)).astype(np.int64)
    out = np.zeros((n_rows, BITS // 64), np.uint64)
    np.bitwise_or.at(out, (owner, bit >> 6), U(1) << (bit & 63).astype(np.uint64))
    return out


ONES = "aggregate(bits, 0, (n, x) -> n + bit_count(x))"


def may_be_close(percent: int) -> str:
    """Condition on sizes (``nu``, ``nv``), bitmaps (``bu``, ``bv``) and their numbers of ones (``ou``, ``ov``) that every pair
    of ``percent`` similarity meets.  A loop over the words: written out as one long expression the test was slow, probably too large a method to compile."""
    both = "aggregate(zip_with(bu, bv, (x, y) -> bit_count(x & y)), 0, (n, x) -> n + x)"
    return f"(least(nu - ou, nv - ov) + {both}) * {100 + percent} >= {percent} * (nu + nv)"


def full_sets(words: int):
    """Task: the set of each text as a list of hashes, and its bitmap."""

    def run(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            lists, counts, maps = [], [], []
            for i, j in blocks(offs):
                owner, code = shingle_sets(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], words)
                lists.append(code)
                counts.append(np.bincount(owner, minlength=j - i))
                maps.append(bitmaps(owner, code, j - i).reshape(-1))
            if lists:
                offsets = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
                values = pa.array(np.concatenate(lists).view(np.int64))
                bits = pa.array(np.concatenate(maps).view(np.int64))
                each = pa.array(np.arange(len(offsets), dtype=np.int32) * (BITS // 64))
                yield pa.record_batch(
                    [b.column("node"), pa.ListArray.from_arrays(pa.array(offsets), values), pa.ListArray.from_arrays(each, bits)],
                    names=["node", "shingles", "bits"])

    return run


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (least node reachable) of every node of the links (``u``, ``v``): labels spread along the links and
    jump to the label's own label until nothing changes."""
    both = staged(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = staged(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label"))
                    .select("node", F.least("node", "label").alias("label")))
    while True:
        step = labels
        for hop in ("first", "second"):  # two hops and a jump in one job
            old = step.select(F.col("node").alias("u"), F.col("label" if hop == "first" else "next").alias("far"))
            near = both.join(old, "u").groupBy(F.col("v").alias("node")).agg(F.min("far").alias("near"))
            step = step.join(near, "node").select("node", "label", F.least("label" if hop == "first" else "next", "near").alias("next"))
        own = step.select(F.col("node").alias("next"), F.col("next").alias("jump"))
        step = step.join(own, "next", "left").select("node", "label", F.least("next", F.coalesce("jump", "next")).alias("next"))
        step = staged(step)
        changed = not step.where(F.col("next") != F.col("label")).isEmpty()
        labels = step.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def near_duplicates(
    documents: DataFrame, words: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc`` (its id), ``n_shingles``, ``component`` (least id linked to it), ``d`` and ``th`` (id to order by and hash
    of the text) and ``leads`` (the first of its component by these two; rows equal in both lead together).

    Two documents are linked if their sets of ``words``-word shingles share at least ``percent`` per cent of their union.
    """
    rows = rows_of(documents, id_col, text_col)
    described = staged(rows.mapInArrow(describe_sets(words, percent), SET))
    classes = staged(
        described.where("n > 0").groupBy("s1", "s2").agg(
            F.min(F.struct("d", "th")).alias("rep"), F.first("n").alias("n"), F.first("keys").alias("keys"))
        .select("s1", "s2", F.struct("rep.d", "rep.th").alias("node"), "n", "keys")
    )
    member = classes.select(F.explode("keys").alias("bucket"), "node", F.col("n").cast("int").alias("n"))
    shared = member.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    # members of the buckets that hold several sets
    buckets = staged(member.join(shared, "bucket").distinct())
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
    centre = buckets.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"))
    needed = buckets.select("node").distinct()
    mine = (F.col("d") == F.col("node.d")) & (F.col("th") == F.col("node.th"))
    sets = staged(
        rows.select("d", "th", "text").join(needed, mine).select("node", "text").dropDuplicates(["node"])
        .mapInArrow(full_sets(words), "node struct<d:long,th:long>, shingles array<long>, bits array<long>")
    )
    close = f"100 * least(nu, nv) >= {percent} * greatest(nu, nv)"

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("su"))
        right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv"))
        both = F.size(F.array_intersect("su", "sv"))
        return (
            pairs.join(right, "v").join(left, "u")
            .where(100 * both >= percent * (F.size("su") + F.size("sv") - both)).select("u", "v")
        )

    tested = staged(
        buckets.join(centre, "bucket").where(F.col("node") != F.col("c.node"))
        .select(F.col("c.node").alias("u"), F.col("node").alias("v"), F.col("c.n").alias("nu"), F.col("n").alias("nv")).distinct()
        .where(close).select("u", "v")
    )
    links = staged(confirmed(tested))
    labels = components(links)
    done, active = 1, staged(buckets.where("size > 2").withColumn("rank", rank))
    while True:
        named = active.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.max("rank").alias("last"))
        mixed = mixed.where((F.col("low") != F.col("high")) & (F.col("last") > done + 1)).select("bucket")
        named = staged(named.join(mixed, "bucket").join(sets.select("node", "bits", F.expr(ONES).alias("ones")), "node"))
        if named.isEmpty():
            break
        more = GROWTH * (done + 1)
        centres = named.where(F.col("rank").between(done + 1, more)).select(
            "bucket", F.col("node").alias("u"), F.col("n").alias("nu"), F.col("label").alias("lu"), F.col("rank").alias("ru"),
            F.col("bits").alias("bu"), F.col("ones").alias("ou"))
        pairs = (
            named.select("bucket", F.col("node").alias("v"), F.col("n").alias("nv"), F.col("label").alias("lv"), F.col("rank").alias("rv"),
                         F.col("bits").alias("bv"), F.col("ones").alias("ov"))
            .join(centres, "bucket").where((F.col("rv") > F.col("ru")) & (F.col("lu") != F.col("lv"))).where(close)
            .where(may_be_close(percent))
            .select("u", "v").distinct().join(tested, ["u", "v"], "left_anti")
        )
        pairs = staged(pairs)
        tested = tested.unionByName(pairs)
        found = staged(confirmed(pairs))
        if not found.isEmpty():
            links = links.unionByName(found)
            labels = components(links)
        done, active = more, named.drop("label", "bits", "ones")
    of_class = classes.join(labels, "node", "left").select("s1", "s2", F.coalesce("label", "node").alias("first"))
    filled = described.where("n > 0").join(of_class, ["s1", "s2"]).select(
        "doc", "n", F.col("first.d").alias("component"), "d", "th", ((F.col("d") == F.col("first.d")) & (F.col("th") == F.col("first.th"))).alias("leads"))
    empty = described.where("n = 0").select("doc", "n", F.col("d").alias("component"), "d", "th", F.lit(True).alias("leads"))
    out = filled.unionByName(empty).withColumnRenamed("n", "n_shingles")
    return out.withColumn("component", F.when(F.col("component") != NO_ID, F.col("component")))


def op5_minhash_dedup(documents: DataFrame) -> DataFrame:
    """Component of each document over five-word shingles at similarity 0.75; the least id of a component is kept."""
    return near_duplicates(documents, 5, 75).select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        F.col("doc").eqNullSafe(F.col("component")).alias("kept"),
    )
