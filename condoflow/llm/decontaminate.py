"""Benchmark passages inside documents, found by a prefix-filtered set join.

Every item is cut into windows of consecutive words.  The words of a window are ordered by rarity, counted over all documents.
Containment asks for every word of a window, so the necessary prefix is its rarest word: only documents that hold this
word are candidates.  Where it stands gives the one place the window could begin; length and position bounds drop places
that would leave the document, and the words from there on are compared one by one.

The benchmark goes to the tasks in blocks of bounded size, so a large one costs more passes over the documents, not memory.

Defined results: null text has no words; items without words occur nowhere; a null item id counts as an item and is written as
an empty string; repeated items count once per id; extra columns are ignored.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from condoflow.llm.common import LOWER, blocks, staged, text_bytes, word_codes, words_in

BLOCK = 16 << 20  # bytes of benchmark text that one pass over the documents looks for
CANDIDATES = 1 << 20  # places compared at a time in a task
IS_ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def coded(data: np.ndarray, offs: np.ndarray):
    """Hash and row of every lower-case word."""
    data = LOWER[data]
    starts, ends, row = words_in(data, offs, IS_ALNUM)
    return word_codes(data, starts, ends), row


class Windows:
    """The distinct windows of a block of items, one row of word hashes each, filled up with zeros."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        column = pa.array([t for _, t in items], pa.large_string())
        data, offs = text_bytes(column)
        code, row = coded(data[offs[0] : offs[-1]], offs - offs[0])
        n = np.bincount(row, minlength=len(items))
        first = np.cumsum(n) - n
        seen: dict[bytes, int] = {}
        self.names = sorted({name for name, _ in items})
        number = {name: k for k, name in enumerate(self.names)}
        rows, owners = [], []
        for k, (name, _) in enumerate(items):
            words = code[first[k] : first[k] + n[k]]
            for at in range(max(1, n[k] - width + 1) if n[k] else 0):
                window = words[at : at + width]
                w = seen.setdefault(window.tobytes(), len(seen))
                if w == len(rows):
                    rows.append(window)
                    owners.append(set())
                owners[w].add(number[name])
        self.size = np.array([len(w) for w in rows], np.int64)
        self.words = np.zeros((len(rows), width), np.uint64)
        for k, w in enumerate(rows):
            self.words[k, : len(w)] = w
        self.owners = [sorted(o) for o in owners]
        self.vocabulary = np.unique(code)

    def order_by_rarity(self, counts: np.ndarray) -> None:
        """Index the windows by their rarest word; equal counts fall back on the hash."""
        place = np.searchsorted(self.vocabulary, self.words).clip(max=max(0, len(self.vocabulary) - 1))
        rank = np.argsort(np.lexsort((self.vocabulary, counts)))
        ranked = np.where(np.arange(self.words.shape[1]) < self.size[:, None], rank[place], len(rank))
        self.offset = ranked.argmin(axis=1)
        token = self.words[np.arange(len(self.words)), self.offset]
        self.by_token = np.argsort(token, kind="stable")
        self.tokens, self.first, self.number = np.unique(token[self.by_token], return_index=True, return_counts=True)


def count_words(vocabulary):
    """Task: how often each word of the vocabulary occurs."""

    def run(batches):
        total = np.zeros(len(vocabulary.value), np.int64)
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in blocks(offs):
                code, _ = coded(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                place = np.searchsorted(vocabulary.value, code)
                place[place == len(total)] = 0
                total += np.bincount(place[vocabulary.value[place] == code], minlength=len(total))
        at = np.nonzero(total)[0]
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["word", "n"])

    return run


def find_windows(shared):
    """Task: number of words, runs of hit words and items of each text."""

    def of_block(w: Windows, data, offs):
        code, row = coded(data, offs)
        n = np.bincount(row, minlength=len(offs) - 1)
        first = np.cumsum(n) - n
        slot = np.searchsorted(w.tokens, code)
        slot[slot == len(w.tokens)] = 0
        at = np.nonzero(w.tokens[slot] == code)[0]
        found_row, found_at, found_window = [], [], []
        several = np.cumsum(w.number[slot[at]])
        cuts = np.searchsorted(several, np.arange(CANDIDATES, (several[-1] if len(several) else 0) + CANDIDATES, CANDIDATES), "right")
        begin = 0
        for stop in np.unique(np.concatenate([cuts, [len(at)]])):
            here = at[begin:stop]
            begin = stop
            many = w.number[slot[here]]
            turn = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            window = w.by_token[np.repeat(w.first[slot[here]], many) + turn]
            own = np.repeat(row[here], many)
            start = np.repeat(here, many) - w.offset[window]
            inside = (start >= first[own]) & (start + w.size[window] <= first[own] + n[own])
            window, own, start = window[inside], own[inside], start[inside]
            for k in range(w.words.shape[1]):
                there = k < w.size[window]
                same = ~there | (code[np.where(there, start + k, 0)] == w.words[window, k])
                window, own, start = window[same], own[same], start[same]
            found_row.append(own)
            found_at.append(start - first[own])
            found_window.append(window)
        return n, np.concatenate(found_row), np.concatenate(found_at), np.concatenate(found_window)

    def run(batches):
        w = SimpleNamespace(**shared.value)
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            size = np.zeros(b.num_rows, np.int64)
            spans: list[list] = [[] for _ in range(b.num_rows)]
            items: list[list] = [[] for _ in range(b.num_rows)]
            for i, j in blocks(offs):
                n, row, at, window = of_block(w, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                size[i:j] = n
                order = np.lexsort((at, row))
                row, at, window = row[order], at[order], window[order]
                for r in np.unique(row):
                    lo, hi = np.searchsorted(row, [r, r + 1])
                    runs: list[list[int]] = []
                    for s, e in zip(at[lo:hi].tolist(), (at[lo:hi] + w.size[window[lo:hi]]).tolist()):
                        if runs and s <= runs[-1][1]:
                            runs[-1][1] = max(runs[-1][1], e)
                        else:
                            runs.append([s, e])
                    spans[i + r] = [{"start": s, "stop": e} for s, e in runs]
                    items[i + r] = sorted({w.names[o] for x in set(window[lo:hi].tolist()) for o in w.owners[x]})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.record_batch(
                [*(b.column(c) for c in rest), pa.array(size), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                names=[*rest, "n_words", "spans", "items"],
            )

    return run


FOUND = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"


def find_benchmark(
    documents: DataFrame, benchmark: DataFrame, width: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK,
) -> DataFrame:
    """One row per document: ``doc`` (its id), ``th`` (hash of its text), ``n_words``, ``spans`` (runs of words inside an occurrence of
    a window of ``width`` item words; a shorter item is one window) and ``items`` (ids of the items with such windows, as strings)."""
    spark = documents.sparkSession
    asked = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{item_text_col}`").alias("text")
    ).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    text = F.col(f"`{text_col}`")
    rows = documents.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))
    parts = []
    for k in range(n_blocks):
        block = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == k) if n_blocks > 1 else asked
        w = Windows([tuple(r) for r in block.collect()], width)  # at most about block_bytes
        if not len(w.words):
            continue
        vocabulary = spark.sparkContext.broadcast(w.vocabulary)
        counted = rows.select("text").mapInArrow(count_words(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(w.vocabulary), np.int64)
        for word, n in counted.collect():  # at most the words of the block
            counts[word] = n
        w.order_by_rarity(counts)
        kind = f"doc {rows.schema['doc'].dataType.simpleString()}, th long, {FOUND}"
        parts.append(rows.mapInArrow(find_windows(spark.sparkContext.broadcast(vars(w))), kind))
    if len(parts) == 1:
        return parts[0]
    if not parts:  # no item has a word
        spans = "cast(array() as array<struct<start:long,stop:long>>)"
        count = F.regexp_count("text", F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"))
        return rows.select(
            "doc", "th", F.coalesce(count, F.lit(0)).cast("long").alias("n_words"), F.expr(spans).alias("spans"),
            F.expr("cast(array() as array<string>)").alias("items"))
    several = parts[0]
    for p in parts[1:]:
        several = several.unionByName(p)
    several = staged(several)
    # equal rows give equal finds, so they are merged and multiplied back by their number
    times = several.groupBy("doc", "th").agg(
        F.max("n_words").alias("n_words"), F.collect_set("spans").alias("many"), F.collect_set("items").alias("owners"),
        (F.count("*") / len(parts)).cast("int").alias("times"))
    runs = F.array_sort(F.array_distinct(F.flatten("many")))
    joined = F.aggregate(
        runs, F.expr("cast(array() as array<struct<start:long,stop:long>>)"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (F.element_at(a, -1)["stop"] >= s["start"]),
            F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.named_struct(
                F.lit("start"), F.element_at(a, -1)["start"],
                F.lit("stop"), F.greatest(F.element_at(a, -1)["stop"], s["stop"])))),
        ).otherwise(F.concat(a, F.array(s))))
    return times.select(
        "doc", "th", "n_words", joined.alias("spans"), F.array_sort(F.array_distinct(F.flatten("owners"))).alias("items"),
        F.explode(F.sequence(F.lit(1), "times")).alias("copy")).drop("copy")


def op10_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of each document inside 10-word windows of the benchmark, and the items they come from."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return find_benchmark(documents, benchmark, 10).select(
        F.col("doc").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )
