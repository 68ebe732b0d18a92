"""Language of a text from a bidirectional gated recurrent network over its bytes.

The network reads pieces of PIECE bytes in both directions, labels every position with a probability per language, and a document's
probabilities are the means over all its positions.  It is trained in numpy by backpropagation through time on pieces of a bounded
sample of each known language (``rows`` rows of every language, those with the least hash of their id), so that a language is learned
however rare it is.  Languages have about equally many pieces: the fewer rows one has, the more of each text is read, up to the whole.

Defined results: null texts and texts without a letter are ``und`` with score 0, and so is every text if no language is known; null
languages are not learned from; a null id counts as empty text for the fold; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from condoflow.llm.common import blocks, text_bytes

LANGUAGE_ROWS = 1_000  # rows of each language that are learned from
PIECES_PER_ROW = 4  # of a language that has all its rows
LEARN_BYTES = 48  # length of a piece in training
PIECE = 128  # length of a piece in prediction
HIDDEN = 12
EPOCHS, BATCH, RATE = 4, 256, 0.02
SEED = 7


def start_weights(n_languages: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    h, w = HIDDEN, {}
    for side in ("f", "b"):
        w[f"x{side}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)  # input weights of each byte, biases included
        w[f"u{side}"] = rng.normal(0, 1 / np.sqrt(h), (h, 3 * h)).astype(np.float32)
    w["o"] = rng.normal(0, 0.3, (2 * h, n_languages)).astype(np.float32)
    w["c"] = np.zeros(n_languages, np.float32)
    return w


def read(x: np.ndarray, u: np.ndarray, steps: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States after each step of one direction; ``steps`` holds the bytes, one row per step.

    Gates: update z, reset r, and candidate n = tanh(x + r * (u h)).  Each gate lies in one stretch of memory, which numpy needs to be fast,
    and the sigmoids of z and r are made of tanh(x / 2), whose half is taken from the weights beforehand, without rounding.
    """
    h, n_pieces = HIDDEN, steps.shape[1]
    half = np.repeat(np.array([0.5, 0.5, 1], x.dtype), h)
    x = np.ascontiguousarray((x * half).reshape(-1, 3, h).swapaxes(0, 1))
    u = u * half
    by_gate = np.arange(3 * n_pieces).reshape(n_pieces, 3).T
    product = np.empty((n_pieces, 3 * h), x.dtype)
    rows = product.reshape(-1, h)
    given, own = np.empty((2, 3, n_pieces, h), x.dtype)
    state = np.zeros((n_pieces, h), x.dtype)
    states = np.empty((*steps.shape, h), x.dtype)
    for t, byte in enumerate(steps):
        if keep is not None:
            given, own = np.empty((2, 3, n_pieces, h), x.dtype)
        np.matmul(state, u, out=product)
        # no index is out of range; in any other mode numpy makes a copy first
        x.take(byte, axis=1, out=given, mode="clip")
        rows.take(by_gate, axis=0, out=own, mode="clip")
        gates, n = given[:2], given[2]
        gates += own[:2]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates
        n += r * own[2]
        np.tanh(n, out=n)
        if keep is not None:
            keep.append((state, z, r, n, own[2]))
        state = np.subtract(state, n, out=states[t])
        state *= z
        state += n
    return states


def read_back(x, u, steps, keep, grad, gx, gu):
    """Backpropagation through time: adds the gradients of one direction to ``gx`` and ``gu``."""
    h = HIDDEN
    later = np.zeros((steps.shape[1], h), np.float32)
    for t in range(len(steps) - 1, -1, -1):
        before, z, r, n, own = keep[t]
        d = grad[t] + later
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (before - n) * z * (1 - z)
        dr = dn * own * r * (1 - r)
        given = np.concatenate([dz, dr, dn], axis=1)
        through = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(gx, steps[t], given)
        gu += before.T @ through
        later = d * z + through @ u.T


def probabilities(w: dict, steps: np.ndarray) -> np.ndarray:
    """Probability of each language at every position; ``steps`` is (position, piece).

    In memory the languages come first: sums over a few neighbouring numbers are slow in numpy.
    """
    there = read(w["xf"], w["uf"], steps)
    back = read(w["xb"], w["ub"], steps[::-1])[::-1]
    score = np.ascontiguousarray(np.moveaxis(there @ w["o"][:HIDDEN] + back @ w["o"][HIDDEN:], -1, 0))
    score += w["c"][:, None, None]
    score -= score.max(axis=0)
    np.exp(score, out=score)
    score /= score.sum(axis=0)
    return np.moveaxis(score, 0, -1)


def train(pieces: np.ndarray, language: np.ndarray, n_languages: int) -> dict[str, np.ndarray]:
    """Weights after EPOCHS passes of Adam over the pieces (one row each); every position carries its text's language."""
    w = start_weights(n_languages)
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    rng, turn = np.random.default_rng(SEED), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(pieces))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            steps, y = pieces[some].T, language[some]
            keep_f, keep_b = [], []
            there = read(w["xf"], w["uf"], steps, keep_f)
            back = read(w["xb"], w["ub"], steps[::-1], keep_b)[::-1]
            score = there @ w["o"][:HIDDEN] + back @ w["o"][HIDDEN:] + w["c"]
            p = np.exp(score - score.max(axis=-1, keepdims=True))
            p /= p.sum(axis=-1, keepdims=True)
            p[:, np.arange(len(y)), y] -= 1
            p /= p.shape[0] * p.shape[1]
            both = np.concatenate([there, back], axis=2)
            g = {k: np.zeros_like(v) for k, v in w.items()}
            g["o"] = np.tensordot(both, p, axes=([0, 1], [0, 1]))
            g["c"] = p.sum(axis=(0, 1))
            grad = p @ w["o"].T
            read_back(w["xf"], w["uf"], steps, keep_f, grad[:, :, :HIDDEN], g["xf"], g["uf"])
            read_back(w["xb"], w["ub"], steps[::-1], keep_b, grad[::-1, :, HIDDEN:], g["xb"], g["ub"])
            turn += 1
            for k in w:
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.001 * (g[k] * g[k] - second[k])
                w[k] -= (RATE * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)).astype(np.float32)
    return w


def cut_pieces():
    """Task: ``pieces`` pieces of each text, spread evenly over its whole length; at most as many as it takes to cover the text."""

    def run(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            wanted = b.column("pieces").to_pylist()
            found, of = [], []
            for k in range(b.num_rows):
                text = data[offs[k] : offs[k + 1]]
                if not len(text):
                    continue
                text = np.resize(text, max(len(text), LEARN_BYTES))  # a short text is repeated
                for at in np.unique(np.linspace(0, len(text) - LEARN_BYTES, min(wanted[k], max(PIECES_PER_ROW, -(-len(text) // LEARN_BYTES)))).astype(int)):
                    found.append(text[at : at + LEARN_BYTES].tobytes())
                    of.append(k)
            yield pa.record_batch([b.column("lang").take(pa.array(of, pa.int32())), pa.array(found, pa.binary())], names=["lang", "piece"])

    return run


def label_texts(shared):
    """Task: mean probabilities of all positions of each text."""

    def run(batches):
        w, languages = shared.value
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            best, score = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for i, j in blocks(offs):
                sizes = np.diff(offs[i : j + 1])
                counts = -(-sizes // PIECE)
                if not counts.sum():
                    continue
                owner = np.repeat(np.arange(j - i), counts)
                nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = offs[i:j][owner] + nth * PIECE
                length = np.minimum(PIECE, offs[i + 1 : j + 1][owner] - start)
                # pieces by length, so that the short ones at the ends of texts are read apart from the full ones
                total = np.zeros((j - i, len(languages)))
                for full in (True, False):
                    pick = np.nonzero((length == PIECE) == full)[0]
                    for at in range(0, len(pick), 2048):
                        some = pick[at : at + 2048]
                        width = int(length[some].max())
                        place = np.arange(width)[:, None]
                        inside = place < length[some]
                        # a short piece is repeated up to the width; the repetition is not counted
                        steps = data[start[some] + (place if full else place % length[some])]
                        p = probabilities(w, steps)
                        if not full:
                            p = p * inside[:, :, None]
                        np.add.at(total, owner[some], p.sum(axis=0))
                total /= np.maximum(sizes, 1)[:, None]
                best[i:j] = total.argmax(axis=1)
                score[i:j] = total.max(axis=1)
            rest = [c for c in b.schema.names if c != "text"]
            names = pa.array(languages, pa.string()).take(pa.array(best))
            yield pa.record_batch([*(b.column(c) for c in rest), names, pa.array(np.clip(score, 0, 1))], names=[*rest, "lang", "score"])

    return run


def fit(documents: DataFrame, learn: Column, rows: int = LANGUAGE_ROWS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"):
    """Weights and languages learned from rows where ``learn`` holds, ``rows`` of each language; None without any."""
    text = documents.where(learn).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    text = text.where("lang is not null").withColumn("th", F.xxhash64("text"))
    keys = text.select("id", "lang", "th", F.xxhash64("id", "th").alias("rank"))
    # of a frequent language only the hashes below a bound, which about 2 * rows rows have, are put in order
    bound = keys.groupBy("lang").agg((F.lit(2.0 * rows) / F.approx_count_distinct("rank") - 0.5).alias("bound"))
    low = keys.join(F.broadcast(bound), "lang").where(F.col("rank") / F.lit(2.0**64) <= F.col("bound")).drop("bound").distinct()
    of_language = Window.partitionBy("lang")
    sample = (
        low.withColumn("nth", F.row_number().over(of_language.orderBy("rank", "id", "th"))).where(F.col("nth") <= rows)
        .withColumn("pieces", F.ceil(F.lit(PIECES_PER_ROW * rows) / F.count("*").over(of_language)).cast("int")).select("id", "lang", "th", "pieces")
    )
    # at most ``rows`` rows of four values for each language go to the tasks
    chosen = F.broadcast(sample.select(F.col("id").alias("i"), F.col("lang").alias("l"), F.col("th").alias("t"), "pieces"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("lang") == F.col("l")) & (F.col("th") == F.col("t"))
    known = text.join(chosen, same).dropDuplicates(["id", "lang", "th"])
    found = known.select("lang", "pieces", "text").mapInArrow(cut_pieces(), "lang string, piece binary").toArrow()
    if not found.num_rows:
        return None
    lang = found.column("lang").to_pylist()
    languages = sorted(set(lang))
    pieces = np.frombuffer(b"".join(found.column("piece").to_pylist()), np.uint8).reshape(-1, LEARN_BYTES)
    order = np.lexsort((*pieces.T[::-1], np.array(lang)))  # the order of arrival must not matter
    return train(pieces[order], np.searchsorted(languages, np.array(lang)[order]), len(languages)), languages


def identify(documents: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (id), ``lang`` (predicted) and ``score`` (its probability) of each document."""
    text = F.col(f"`{text_col}`")
    rows = documents.select(F.col(f"`{id_col}`").alias("doc"), text.alias("text"), F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("any"))
    if model is None:
        return rows.select("doc", F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
    kind = f"doc {rows.schema['doc'].dataType.simpleString()}, any boolean, lang string, score double"
    shared = documents.sparkSession.sparkContext.broadcast(model)
    out = rows.select("doc", "any", "text").mapInArrow(label_texts(shared), kind)
    return out.select("doc", F.when(F.col("any"), F.col("lang")).otherwise("und").alias("lang"), F.when(F.col("any"), F.col("score")).otherwise(0.0).alias("score"))


def op8_language_id(documents: DataFrame) -> DataFrame:
    """Language of each document; one quarter of the ids, by crc32, is never learned from."""
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
    out = identify(documents, fit(documents, ~held_out)).withColumnRenamed("doc", "doc_id")
    return out.select("doc_id", held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score")
