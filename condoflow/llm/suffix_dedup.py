"""Exact removal of byte strings that occur more than once, found by suffix sorting.

Two equal strings of ``window`` bytes share the byte gram that a sliding minimum picks inside them (their anchor).  Each
anchor stands for the run of windows that picked it, its segment.  Anchors met once cannot belong to a repeat.  Segments
that are equal as a whole are settled by counting.  What is left are segments that share an anchor but differ at an edge:
their suffixes are ordered by deep-shallow sorting, a multikey quicksort to a shallow depth and blind tries for the groups
that still share a prefix, and neighbours that agree over the whole window are repeats.  Anchors with very many different
segments are settled by the hash of each window instead of one sort.

Defined results: null text counts as empty; texts shorter than the window keep every byte; rows that are equal in id and
text count as separate documents; ids may be null or repeated; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import (
    BYTE_CODES, U, RangeHash, blocks, mix, rows_of, staged, text_bytes, union_runs, window_min,
)

GRAM = 32  # bytes of an anchor
SHALLOW = 16  # depth of the quicksort in bytes
FLUSH = 2_000_000  # anchors of a task compared with each other at a time
HOT = 64  # segments of one anchor beyond which its windows are settled by hash
SORT_BYTES = 1 << 20  # text sorted at once; whole groups only
LOW32 = U(0xFFFFFFFF)

ANCHOR = "key long, seg long, cnt int, d long, th long, pos long, n int"


def gram_codes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every gram, by doubling; ``gram`` is a power of two."""
    codes, reach = BYTE_CODES[data], 1
    while reach < gram:
        codes = mix(codes[:-reach] * U(0x9E3779B97F4A7C15) + codes[reach:])
        reach *= 2
    return codes


def anchors(data: np.ndarray, offs: np.ndarray, window: int):
    """Anchor name, segment hash, row, first window and number of windows of every segment of the texts."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    lengths = np.diff(offs)
    long = lengths >= window
    if not long.any():
        return none
    grams = gram_codes(data, GRAM)
    keyed = (grams & ~LOW32) | np.arange(len(grams), dtype=np.uint64)
    least = window_min(keyed, window - GRAM + 1)
    step = np.zeros(len(data) + 1, np.int8)
    np.add.at(step, offs[:-1][long], 1)
    np.add.at(step, offs[1:][long] - window + 1, -1)
    inside = np.cumsum(step, dtype=np.int8)[: len(least)] > 0
    starts = np.nonzero(inside)[0]
    chosen = (least[starts] & LOW32).astype(np.int64)
    cut = np.nonzero((chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1))[0] + 1
    first = np.concatenate([[0], cut])
    s, e, a = starts[first], starts[np.concatenate([cut - 1, [len(starts) - 1]])], chosen[first]
    ranges = RangeHash(BYTE_CODES[data])
    seg = mix(ranges(s, e + window) + (a - s).astype(np.uint64) * U(0x2127599BF4325C37))
    row = np.searchsorted(offs, s, side="right") - 1
    return mix(grams[a]), seg, row, s - offs[row], e - s + 1


def anchor_rows(window: int):
    """Task: anchors of whole partitions; segments repeated inside the task leave one representative with its count."""

    def settle(parts):
        key, seg, d, th, pos, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((seg, key))
        key, seg, d, th, pos, n = (x[order] for x in (key, seg, d, th, pos, n))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])])
        count = np.bincount(np.cumsum(new) - 1)
        yield batch(key[new], seg[new], count, d[new], th[new], pos[new], n[new])
        rest = ~new
        d, th, pos, n = d[rest], th[rest], pos[rest], n[rest]
        order = np.lexsort((pos, th, d))
        d, th, pos, n = (x[order] for x in (d, th, pos, n))
        if len(d):  # settled already: runs of windows, dealt out at random
            end = pos + n
            cut = np.concatenate([[True], (d[1:] != d[:-1]) | (th[1:] != th[:-1]) | (pos[1:] > end[:-1])])
            first = np.nonzero(cut)[0]
            last = np.maximum.reduceat(end, first)
            d, th, pos = d[first], th[first], pos[first]
            zero = np.zeros(len(d), np.int64)
            key = mix(th.view(np.uint64) + pos.astype(np.uint64) * U(0x9E3779B97F4A7C15))
            yield batch(key, zero.view(np.uint64), zero, d, th, pos, last - pos)

    def batch(key, seg, count, d, th, pos, n):
        return pa.record_batch([
            pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(count.astype(np.int32)), pa.array(d),
            pa.array(th), pa.array(pos), pa.array(n.astype(np.int32)),
        ], names=["key", "seg", "cnt", "d", "th", "pos", "n"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            d, th = b.column("d").to_numpy(zero_copy_only=False), b.column("th").to_numpy(zero_copy_only=False)
            for i, j in blocks(offs):
                name, seg, row, pos, n = anchors(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], window)
                if len(name):
                    parts.append((name, seg, d[i + row], th[i + row], pos, n))
                    held += len(name)
                if held >= FLUSH:
                    yield from settle(parts)
                    parts, held = [], 0
        if parts:
            yield from settle(parts)

    return run


def big_words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes at every position as one number that orders like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for shift, reach in ((8, 1), (16, 2), (32, 4)):
        padded = (padded[:-reach] << U(shift)) | padded[reach:]
    return padded[: len(data)]


def deep_shallow_sort(data: np.ndarray, starts: np.ndarray, depth: int):
    """Order of the suffixes at ``starts`` by their first ``depth`` bytes (a multiple of 8), and for each, in that order,
    whether it agrees with the one before over the whole depth.

    Shallow part: multikey quicksort on 8-byte characters down to SHALLOW bytes; only ties are split further.
    Deep part: groups that still tie become blind tries built level by level.  A node skips to the first character in which
    one of its members differs from the node's leader, splits there, and looks at nothing else; all nodes of a level go
    through numpy together.
    """
    words = big_words(data)
    order = np.argsort(words[starts], kind="stable")
    code = words[starts[order]]
    new = np.concatenate([[True], code[1:] != code[:-1]]) if len(order) else np.zeros(0, bool)
    active = np.nonzero(tied(new))[0]
    for at in range(8, min(SHALLOW, depth), 8):
        active = split(words, starts, order, new, active, at, False)
    for at in range(SHALLOW, depth, 8):
        if not len(active):
            break
        active = split(words, starts, order, new, active, at, True)
    return order, ~new


def tied(new: np.ndarray) -> np.ndarray:
    """Members of groups of two or more, where ``new`` marks the first of each group."""
    return ~(new & np.concatenate([new[1:], [True]]))


def split(words, starts, order, new, active, at, blind):
    """Orders the tied groups by their character at ``at``; a blind node without a difference there is passed over."""
    here = words[starts[order[active]] + at]
    lead = new[active]
    group = np.cumsum(lead) - 1
    differs = here != here[np.nonzero(lead)[0]][group]
    if blind:
        branch = np.zeros(group[-1] + 1 if len(group) else 0, bool)
        branch[group[differs]] = True
        chosen = branch[group]
    else:
        chosen = np.ones(len(active), bool)
    if not chosen.any():
        return active
    slots, codes, groups = active[chosen], here[chosen], group[chosen]
    by = np.lexsort((codes, groups))
    order[slots] = order[slots[by]]
    codes = codes[by]
    new[slots] = np.concatenate([[True], (groups[1:] != groups[:-1]) | (codes[1:] != codes[:-1])])
    follows = np.concatenate([new, [True]])[active + 1]
    return active[~(new[active] & follows)]  # a member alone in its group needs no more work


def repeated_windows(window: int):
    """Task: suffix sort of the segments of whole anchor groups, and the runs of windows that have an equal elsewhere."""
    def settle(parts):
        d, th, pos, pieces = zip(*parts)
        sizes = np.array([len(p) for p in pieces])
        data = np.frombuffer(b"".join(pieces), np.uint8)
        base = np.cumsum(sizes) - sizes
        counts = sizes - window + 1
        owner = np.repeat(np.arange(len(pieces)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        order, same = deep_shallow_sort(data, base[owner] + within, window)
        hit = np.zeros(len(owner), bool)
        hit[order] = same | np.concatenate([same[1:], [False]])
        other = owner[1:] != owner[:-1]
        first = np.nonzero(hit & (np.concatenate([[True], other]) | ~np.concatenate([[False], hit[:-1]])))[0]
        last = np.nonzero(hit & (np.concatenate([other, [True]]) | ~np.concatenate([hit[1:], [False]])))[0]
        own = owner[first]
        yield pa.record_batch([
            pa.array(np.array(d)[own]), pa.array(np.array(th)[own]), pa.array(np.array(pos)[own] + within[first]),
            pa.array((last - first + 1).astype(np.int32)),
        ], names=["d", "th", "pos", "n"])

    def run(batches):
        parts, held, last = [], 0, None
        for b in batches:
            for key, d, th, pos, piece in zip(*(b.column(c).to_pylist() for c in ("key", "d", "th", "pos", "piece"))):
                if key != last and held >= SORT_BYTES:
                    yield from settle(parts)
                    parts, held = [], 0
                parts.append((d, th, pos, piece))
                held += len(piece)
                last = key
        if parts:
            yield from settle(parts)

    return run


WORK = (
    "doc long, d long, th long, text binary, kept binary, spans array<struct<start:long,stop:long>>, "
    "segs array<struct<key:long,pos:long,piece:binary>>, wins array<struct<a:long,b:long,pos:long>>"
)
DONE = "doc long, n_bytes long, kept binary, spans array<struct<start:long,stop:long>>"


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans."""
    kept, at = [], 0
    for start, stop in spans:
        kept.append(text[at:start])
        at = stop
    kept.append(text[at:])
    return b"".join(kept)


def first_pass(window: int):
    """Task: texts that counting settles are cut; the others pass on with the segments that need sorting."""

    def run(batches):
        for b in batches:
            columns = {c: b.column(c).to_pylist() for c in ("doc", "d", "th", "text", "marks")}
            out = {k: [] for k in ("text", "kept", "spans", "segs", "wins")}
            for text, marks in zip(columns["text"], columns["marks"]):
                text, marks = text or b"", marks or []
                sure = [m for m in marks if m["covered"]]
                spans = union_runs(np.array([m["pos"] for m in sure]), np.array([m["pos"] + m["n"] - 1 + window for m in sure]))
                segs = [{"key": m["key"], "pos": m["pos"], "piece": text[m["pos"] : m["pos"] + m["n"] - 1 + window]}
                        for m in marks if m["want"] == 1]
                wins = []
                hot = [m for m in marks if m["want"] == 2]
                if hot:
                    codes = BYTE_CODES[np.frombuffer(text, np.uint8)]
                    one, two = RangeHash(codes), RangeHash(mix(codes))
                    at = np.concatenate([np.arange(m["pos"], m["pos"] + m["n"]) for m in hot])
                    a, c = one(at, at + window).view(np.int64), two(at, at + window).view(np.int64)
                    wins = [{"a": x, "b": y, "pos": p} for x, y, p in zip(a.tolist(), c.tolist(), at.tolist())]
                open_ = bool(segs or wins)
                out["text"].append(text if open_ else None)
                out["kept"].append(None if open_ else cut_out(text, spans))
                out["spans"].append([{"start": s, "stop": e} for s, e in spans])
                out["segs"].append(segs)
                out["wins"].append(wins)
            arrays = [b.column(c) for c in ("doc", "d", "th")]
            arrays += [pa.array(out["text"], pa.binary()), pa.array(out["kept"], pa.binary())]
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            arrays.append(pa.array(out["spans"], span))
            arrays.append(pa.array(out["segs"], pa.list_(pa.struct([("key", pa.int64()), ("pos", pa.int64()), ("piece", pa.binary())]))))
            arrays.append(pa.array(out["wins"], pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("pos", pa.int64())]))))
            yield pa.record_batch(arrays, names=["doc", "d", "th", "text", "kept", "spans", "segs", "wins"])

    return run


def last_pass(window: int):
    """Task: the spans found by sorting join those found by counting, and the text is cut."""

    def run(batches):
        for b in batches:
            kept, all_spans, sizes = [], [], []
            for text, sure, found in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "found"))):
                found = found or []
                start = [s["start"] for s in sure] + [m["pos"] for m in found]
                stop = [s["stop"] for s in sure] + [m["pos"] + m["n"] - 1 + window for m in found]
                spans = union_runs(np.array(start, np.int64), np.array(stop, np.int64))
                kept.append(cut_out(text, spans))
                all_spans.append([{"start": s, "stop": e} for s, e in spans])
                sizes.append(len(text))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.record_batch(
                [b.column("doc"), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(all_spans, span)],
                names=["doc", "n_bytes", "kept", "spans"],
            )

    return run


def remove_repeats(documents: DataFrame, window: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc`` (its id), ``n_bytes``, ``kept`` (the bytes left) and ``spans`` (maximal removed runs).

    A byte goes if a string of ``window`` bytes that covers it also starts anywhere else.
    """
    if window < GRAM * 2 or window % 8:
        raise ValueError(f"window must be a multiple of 8 and at least {GRAM * 2} bytes")
    rows = rows_of(documents, id_col, text_col)
    # a segment met once in a task stands for itself; several stand behind one representative with their number
    found = rows.select("d", "th", "text").mapInArrow(anchor_rows(window), ANCHOR).repartition("key")
    of_class, of_key = Window.partitionBy("key", "seg"), Window.partitionBy("key")
    found = (
        found.withColumn("total", F.sum("cnt").over(of_class))
        .withColumn("nth", F.row_number().over(of_class.orderBy("d", "th", "pos")))
        .withColumn("least", F.min("total").over(of_key))
        .withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(of_key))
        .withColumn("covered", (F.col("cnt") == 0) | (F.col("total") > 1))
        .withColumn("want", F.when((F.col("nth") > 1) | (F.col("kinds") < 2) | (F.col("least") != 1), 0)
                    .when(F.col("kinds") > HOT, 2).otherwise(1))
        .where("covered or want > 0")
    )
    marks = found.groupBy("d", "th").agg(
        F.collect_set(F.struct("pos", "n", "covered", "want", F.when(F.col("want") == 1, F.col("key")).alias("key"))).alias("marks")
    ).withColumnRenamed("d", "md").withColumnRenamed("th", "mth")
    joined = rows.join(marks, (F.col("d") == F.col("md")) & F.col("th").eqNullSafe(F.col("mth")), "left").select(
        "doc", "d", "th", F.col("text").cast("binary").alias("text"), "marks")
    work = staged(joined.mapInArrow(first_pass(window), WORK))
    closed = work.where("text is null").select(
        "doc", (F.length("kept") + F.aggregate("spans", F.lit(0).cast("long"), lambda t, s: t + s["stop"] - s["start"])).cast("long")
        .alias("n_bytes"), "kept", "spans")
    pending = work.where("text is not null")
    sorted_ = (
        pending.select("d", "th", F.explode("segs").alias("s")).select("s.key", "d", "th", "s.pos", "s.piece")
        .dropDuplicates(["key", "d", "th", "pos"])
        .repartition("key").sortWithinPartitions("key").mapInArrow(repeated_windows(window), "d long, th long, pos long, n int")
    )
    hashed = (
        pending.select("d", "th", F.explode("wins").alias("w")).select("d", "th", "w.a", "w.b", "w.pos").distinct()
        .withColumn("times", F.count("*").over(Window.partitionBy("a", "b"))).where("times > 1")
        .select("d", "th", "pos", F.lit(1).alias("n"))
    )
    hits = sorted_.unionByName(hashed).groupBy("d", "th").agg(F.collect_list(F.struct("pos", "n")).alias("found"))
    hits = hits.withColumnRenamed("d", "md").withColumnRenamed("th", "mth")
    opened = (
        pending.join(hits, (F.col("d") == F.col("md")) & F.col("th").eqNullSafe(F.col("mth")), "left")
        .select("doc", "text", "spans", "found").mapInArrow(last_pass(window), DONE)
    )
    return closed.unionByName(opened)


def op1_suffix_dedup(documents: DataFrame) -> DataFrame:
    """Digest of the kept bytes of each document; strings of 200 bytes that occur twice go."""
    out = remove_repeats(documents, 200)
    return out.select(
        F.col("doc").alias("doc_id"), "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"),
    )
