"""Removal of word windows that occur earlier in the corpus, found by recompression.

Words become 64-bit symbols.  Two rounds of recompression shorten every document: runs of equal neighbours become one
symbol, then each pair of a "left" symbol followed by a "right" one, where a bit of the symbol's own name says which it is.
Whether a border survives a round depends on the few words around it, so equal word sequences get the same symbols in their
interior whatever surrounds them.  Names are hashes of what a symbol spells, which makes them agree across all tasks and
documents without an exchange.  Every window is represented by the least-named symbol of its interior; the windows in a row
that share a representative form a segment.  Spark groups the segments by symbol: a symbol met once rules out a repeat,
segments that are equal as a whole are settled by the earliest of them, and only where a symbol stands in unlike segments
are the windows themselves compared.

Defined results: null text has no words; the order is by id, null ids last, then by the hash of the text for rows of one id;
rows equal in id and text are the same place, so neither precedes the other; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import (
    U, RangeHash, blocks, mix, rows_of, staged, text_bytes, union_runs, window_min, word_codes, words_in,
)

ROUNDS = (1, 2)  # words a symbol may have to take part in the round
MARGIN = sum(ROUNDS)  # words at either edge of a window whose symbols depend on what lies outside
LONGEST = 4  # words of a representative
FLUSH = 2_000_000  # segments of a task compared with each other at a time
LOW32 = U(0xFFFFFFFF)

SEGMENT = "key long, seg long, done boolean, d long, th long, pos long, n int"


def recompress(spell: RangeHash, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word count and name of every symbol after the rounds; ``row`` has the document of each word."""
    n = len(row)
    first, size = np.arange(n), np.ones(n, np.int64)
    for turn, most in enumerate(ROUNDS):
        name = spell(first, first + size)
        right_hand = (mix(name + U(turn + 1)) & U(1)).astype(bool)
        same = name[1:] == name[:-1]
        pair = ~right_hand[:-1] & right_hand[1:]
        short = size <= most
        joined = (same | pair) & short[1:] & short[:-1] & (row[first[1:]] == row[first[:-1]])
        first = first[np.concatenate([[True], ~joined])] if n else first
        size = np.diff(np.concatenate([first, [n]]))
    return first, size, spell(first, first + size)


def segments(data: np.ndarray, offs: np.ndarray, window: int):
    """Name of the representative, segment hash, row, first window and number of windows of every segment."""
    starts, ends, row = words_in(data, offs)
    n = len(starts)
    at = np.arange(max(0, n - window + 1))
    at = at[row[at] == row[at + window - 1]]
    if not len(at):
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    spell = RangeHash(word_codes(data, starts, ends))
    first, size, name = recompress(spell, row)
    short = size <= LONGEST
    keyed = np.full(n, ~U(0))
    keyed[first[short]] = (name[short] & ~LOW32) | first[short].astype(np.uint64)
    least = window_min(keyed, window - 2 * MARGIN - LONGEST + 1)[at + MARGIN]
    lone = least == ~U(0)  # inside a long run: the window stands for itself
    chosen = np.where(lone, -1 - at, (least & LOW32).astype(np.int64))
    cut = np.nonzero((chosen[1:] != chosen[:-1]) | (at[1:] != at[:-1] + 1))[0] + 1
    head = np.concatenate([[0], cut])
    s, e, a = at[head], at[np.concatenate([cut - 1, [len(at) - 1]])], chosen[head]
    seg = mix(spell(s, e + window) + np.where(a < 0, 0, a - s).astype(np.uint64) * U(0x2127599BF4325C37))
    width = np.zeros(n, np.int64)
    width[first] = size
    own = a >= 0
    a = np.where(own, a, s)
    # the margin on either side of the representative lies in each of its windows and tells frequent symbols apart
    key = mix(spell(a - MARGIN * own, a + np.where(own, width[a] + MARGIN, window)) + own.astype(np.uint64))
    head_of_row = np.searchsorted(row, np.arange(len(offs) - 1))
    return key, seg, row[s], s - head_of_row[row[s]], e - s + 1


def segment_rows(window: int):
    """Task: segments of whole partitions; of equal ones inside the task only the earliest goes on to be compared."""

    def settle(parts):
        key, seg, d, th, pos, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((pos, th, d, seg, key))
        key, seg, d, th, pos, n = (x[order] for x in (key, seg, d, th, pos, n))
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (seg[1:] != seg[:-1])])
        lead = np.nonzero(new)[0][np.cumsum(new) - 1]
        later = (d != d[lead]) | (th != th[lead]) | (pos != pos[lead])
        yield batch(key[new], seg[new], False, d[new], th[new], pos[new], n[new])
        d, th, pos, n = d[later], th[later], pos[later], n[later]
        if len(d):
            order = np.lexsort((pos, th, d))
            d, th, pos, n = (x[order] for x in (d, th, pos, n))
            end = pos + n
            first = np.nonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (th[1:] != th[:-1]) | (pos[1:] > end[:-1])]))[0]
            last = np.maximum.reduceat(end, first)
            d, th, pos = d[first], th[first], pos[first]
            key = mix(th.view(np.uint64) + pos.astype(np.uint64) * U(0x9E3779B97F4A7C15))  # dealt out at random
            yield batch(key, key, True, d, th, pos, last - pos)

    def batch(key, seg, done, d, th, pos, n):
        return pa.record_batch([
            pa.array(key.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(np.full(len(d), done)), pa.array(d),
            pa.array(th), pa.array(pos), pa.array(n.astype(np.int32)),
        ], names=["key", "seg", "done", "d", "th", "pos", "n"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            d, th = (b.column(c).to_numpy(zero_copy_only=False) for c in ("d", "th"))
            for i, j in blocks(offs):
                key, seg, row, pos, n = segments(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], window)
                if len(key):
                    parts.append((key, seg, d[i + row], th[i + row], pos, n))
                    held += len(key)
                if held >= FLUSH:
                    yield from settle(parts)
                    parts, held = [], 0
        if parts:
            yield from settle(parts)

    return run


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
WINS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("pos", pa.int64())]))
WORK = (
    "doc long, d long, th long, text binary, n_words long, kept binary, spans array<struct<start:long,stop:long>>, "
    "wins array<struct<a:long,b:long,pos:long>>"
)
DONE = "doc long, n_words long, kept binary, spans array<struct<start:long,stop:long>>"


def without(words: list[bytes], spans: list[tuple[int, int]]) -> bytes:
    """The words outside the spans, joined by one space."""
    kept, at = [], 0
    for start, stop in spans:
        kept += words[at:start]
        at = stop
    return b" ".join(kept + words[at:])


def window_codes(words: list[bytes], marks: list[dict], window: int) -> list[dict]:
    """Two hashes of every window of the marked segments."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = words_in(data, np.array([0, len(data)]))
    codes = word_codes(data, starts, ends)
    one, two = RangeHash(codes), RangeHash(mix(codes))
    at = np.concatenate([np.arange(m["pos"], m["pos"] + m["n"]) for m in marks])
    a, b = one(at, at + window).view(np.int64), two(at, at + window).view(np.int64)
    return [{"a": x, "b": y, "pos": p} for x, y, p in zip(a.tolist(), b.tolist(), at.tolist())]


def first_pass(window: int):
    """Task: texts that equal segments settle are cut; the others pass on with the windows that need comparing."""

    def run(batches):
        for b in batches:
            out = {k: [] for k in ("text", "n_words", "kept", "spans", "wins")}
            for text, marks in zip(b.column("text").to_pylist(), b.column("marks").to_pylist()):
                words, marks = (text or b"").split(), marks or []
                sure = [m for m in marks if m["covered"]]
                spans = union_runs(np.array([m["pos"] for m in sure]), np.array([m["pos"] + m["n"] - 1 + window for m in sure]))
                open_ = [m for m in marks if not m["covered"]]
                out["wins"].append(window_codes(words, open_, window) if open_ else [])
                out["text"].append(text if open_ else None)
                out["n_words"].append(len(words))
                out["kept"].append(None if open_ else without(words, spans))
                out["spans"].append([{"start": s, "stop": e} for s, e in spans])
            yield pa.record_batch(
                [*(b.column(c) for c in ("doc", "d", "th")), pa.array(out["text"], pa.binary()), pa.array(out["n_words"], pa.int64()),
                 pa.array(out["kept"], pa.binary()), pa.array(out["spans"], SPANS), pa.array(out["wins"], WINS)],
                names=["doc", "d", "th", "text", "n_words", "kept", "spans", "wins"],
            )

    return run


def last_pass(window: int):
    """Task: windows found by comparison join the settled spans, and the text is cut."""

    def run(batches):
        for b in batches:
            kept, all_spans = [], []
            for text, sure, found in zip(*(b.column(c).to_pylist() for c in ("text", "spans", "found"))):
                found = found or []
                start = [s["start"] for s in sure] + found
                stop = [s["stop"] for s in sure] + [p + window for p in found]
                spans = union_runs(np.array(start, np.int64), np.array(stop, np.int64))
                kept.append(without(text.split(), spans))
                all_spans.append([{"start": s, "stop": e} for s, e in spans])
            yield pa.record_batch(
                [b.column("doc"), b.column("n_words"), pa.array(kept, pa.binary()), pa.array(all_spans, SPANS)],
                names=["doc", "n_words", "kept", "spans"],
            )

    return run


def remove_later_copies(documents: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc`` (its id), ``n_words``, ``kept`` (words left, joined by one space, UTF-8) and ``spans``
    (maximal removed runs of words).  A word goes if a window that covers it also starts earlier."""
    if window < 2 * MARGIN + LONGEST:
        raise ValueError(f"window must have at least {2 * MARGIN + LONGEST} words")
    rows = rows_of(documents, id_col, text_col)
    place = F.struct("d", "th", "pos")
    of_class, of_key = Window.partitionBy("key", "seg"), Window.partitionBy("key")
    found = (
        rows.select("d", "th", "text").mapInArrow(segment_rows(window), SEGMENT).repartition("key")
        .withColumn("covered", F.col("done") | (place > F.min(place).over(of_class)))
        .withColumn("mixed", F.min("seg").over(of_key) != F.max("seg").over(of_key))
        .where("covered or mixed")
    )
    marks = found.groupBy(F.col("d").alias("md"), F.col("th").alias("mth")).agg(
        F.collect_set(F.struct("pos", "n", "covered")).alias("marks"))
    mine = (F.col("d") == F.col("md")) & F.col("th").eqNullSafe(F.col("mth"))
    joined = rows.join(marks, mine, "left").select("doc", "d", "th", F.col("text").cast("binary").alias("text"), "marks")
    work = staged(joined.mapInArrow(first_pass(window), WORK), free=True)
    pending = work.where("text is not null")
    hits = (
        pending.select("d", "th", F.explode("wins").alias("w")).select("d", "th", "w.a", "w.b", "w.pos")
        .withColumn("later", place > F.min(place).over(Window.partitionBy("a", "b"))).where("later")
        .groupBy(F.col("d").alias("md"), F.col("th").alias("mth")).agg(F.collect_list("pos").alias("found"))
    )
    opened = (
        pending.join(hits, mine, "left").select("doc", "text", "n_words", "spans", "found").mapInArrow(last_pass(window), DONE)
    )
    return work.where("text is null").select("doc", "n_words", "kept", "spans").unionByName(opened)


def op4_substring_dedup(documents: DataFrame) -> DataFrame:
    """Digest of the kept words of each document; windows of 20 words that start earlier elsewhere go."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return remove_later_copies(documents, 20).select(
        F.col("doc").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))
