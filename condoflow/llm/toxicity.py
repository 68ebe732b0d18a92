"""Toxicity scores from class-conditional Kneser-Ney bigram models.

A text is read as the beginning of each word followed by the word.  One model is fitted to the toxic and one to the ordinary
labelled rows.  Both smooth through the same continuation counts (after how many different beginnings a word's beginning occurs in
all documents, labelled or not; a whole word follows its own beginning alone), so an expression rare in either class is judged by
what the classes share.  A text's score is the difference of its length-normalised log-likelihoods, put on a 0 to 1 scale by a logistic
curve fitted to a quarter of the sample by models of the other three; the models that score are of all four.

Labels are read from a bounded sample (``rows`` labelled rows, those with the least hash of their id); every text is scored in full,
and every text of the corpus counts for the contexts.  Nothing is cut by frequency: every word and every bigram of the sample is
tested for what it tells, in Spark, and those that pass are kept; all others have the same probability in both models.  A bigram
counts once for each text that has it: a passage that one text repeats is one observation, not many.

Defined results: null and empty texts and texts without letters get the score of an undecided text; labels that are null and ids
without a row are ignored; a null id counts as empty text for the fold; extra columns are ignored; an empty table gives none.
Copies of a text are one observation of each class they are labelled with, and the text alone says whether it fits the models or
the curve, so the order of rows changes nothing.  Without rows of both classes all texts of equal length score the same.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from condoflow.llm.common import BYTE_CODES, LOWER, U, RangeHash, blocks, staged, text_bytes, words_in

SAMPLE_ROWS = 40_000  # labelled rows the models are fitted to
STEM = 5  # bytes of the beginning of a word, which a rare or inflected word backs off to
DISCOUNT = 0.75
EVIDENCE = 15.1  # likelihood-ratio statistic (chance 0.0001) below which the classes share an expression's probability
SIDES = ("f0", "f1", "n0", "n1")
CONTEXT_BYTES = 1 << 22  # text whose equal bigrams are put together at once
KNOWN_CONTEXT = 20  # a word is a context of its own if both classes met it this often
IS_LETTER = np.array([97 <= b <= 122 or b >= 128 for b in range(256)])


def letters(data: np.ndarray, offs: np.ndarray):
    """Hash and row of the tokens: of every run of letters (A-Z as a-z) its beginning, then the whole if that is longer."""
    data = LOWER[data]
    starts, ends, row = words_in(data, offs, IS_LETTER)
    if not len(starts):
        return np.zeros(0, np.uint64), row
    spell = RangeHash(BYTE_CODES[data])
    code = np.empty(2 * len(starts), np.uint64)
    code[0::2] = spell(starts, np.minimum(ends, starts + STEM)) ^ U(STEM)
    code[1::2] = spell(starts, ends)
    there = np.ones(len(code), bool)
    there[1::2] = ends - starts > STEM
    return code[there], np.repeat(row, 2)[there]


def beginnings(data: np.ndarray, offs: np.ndarray):
    """Hash and row of the beginning of every run of letters."""
    data = LOWER[data]
    starts, ends, row = words_in(data, offs, IS_LETTER)
    if not len(starts):
        return np.zeros(0, np.uint64), row
    return RangeHash(BYTE_CODES[data])(starts, np.minimum(ends, starts + STEM)) ^ U(STEM), row


def numbers(vocabulary: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Place of each word in the ordered vocabulary, counted from 1; 0 for the others."""
    if not len(vocabulary):
        return np.zeros(len(code), np.int64)
    place = np.searchsorted(vocabulary, code)
    place[place == len(vocabulary)] = 0
    return np.where(vocabulary[place] == code, place + 1, 0)


def bigrams_of(vocabulary: np.ndarray, data: np.ndarray, offs: np.ndarray, tokens=letters):
    """Previous word (len(vocabulary) + 1 at the start), word and row."""
    code, row = tokens(data, offs)
    word = numbers(vocabulary, code)
    before = np.concatenate([[0], word[:-1]])[: len(word)]
    before[np.concatenate([[True], row[1:] != row[:-1]])[: len(word)]] = len(vocabulary) + 1
    return before, word, row


def see_words():
    """Task: the different words of each batch of texts."""

    def run(batches):
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in blocks(offs, CONTEXT_BYTES):
                code, _ = letters(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                yield pa.record_batch([pa.array(np.unique(code).view(np.int64))], names=["word"])

    return run


def count_bigrams(vocabulary):
    """Task: number of texts with each bigram by class, ``f0`` and ``f1`` without the texts set apart, ``n0`` and ``n1`` with them."""

    def run(batches):
        width = len(vocabulary.value) + 2
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            toxic, apart = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("toxic", "apart"))
            for i, j in blocks(offs, CONTEXT_BYTES):
                before, word, row = bigrams_of(vocabulary.value, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                code = before * width + word
                order = np.lexsort((row, code))
                code, row = code[order], row[order]
                new = np.concatenate([[True], (code[1:] != code[:-1]) | (row[1:] != row[:-1])])[: len(code)]
                pair, at = np.unique(code[new], return_inverse=True)
                row = row[new]
                of = np.bincount(at * 4 + 2 * apart[i + row] + toxic[i + row], minlength=4 * len(pair)).reshape(-1, 4)
                yield pa.record_batch(
                    [pa.array(x) for x in (pair, of[:, 0], of[:, 1], of[:, 0] + of[:, 2], of[:, 1] + of[:, 3])], names=["pair", *SIDES])

    return run


def see_contexts(vocabulary):
    """Task: the different pairs of neighbouring beginnings of each batch of texts."""

    def run(batches):
        width = len(vocabulary.value) + 2
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            for i, j in blocks(offs, CONTEXT_BYTES):
                before, word, _ = bigrams_of(vocabulary.value, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], beginnings)
                yield pa.record_batch([pa.array(np.unique(before * width + word))], names=["pair"])

    return run


def evidence(n0: np.ndarray, n1: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Likelihood-ratio statistic of two counts against the share expected in the second."""
    both = n0 + n1
    g = np.zeros(len(both))
    for n, q in ((n1, share), (n0, 1 - share)):
        some = n > 0
        g[some] += 2 * n[some] * np.log(n[some] / np.maximum(both[some] * q[some], 1e-12))
    return g


def of_words(of_word: np.ndarray, context: np.ndarray) -> dict:
    """Probability of each word by class, and what the bigrams of a context leave to it.

    ``of_word`` has the counts of each word by class and its different contexts in the corpus, ``context`` the counts of each context by class
    and its different words by class.  An expression whose counts do not tell the classes apart falls back on the shared counts
    in both, so it adds nothing.
    """
    shared = of_word[2] + 0.5
    shared = shared / shared.sum()
    of_word, context, kinds = of_word[:2], context[:2], context[2:]
    total = [max(1.0, x.sum()) for x in of_word]
    tells = evidence(*of_word, np.full(len(shared), total[1] / sum(total))) >= EVIDENCE
    alone = [
        (np.maximum(of_word[c] - DISCOUNT, 0) + DISCOUNT * max(1, (of_word[c] > 0).sum()) * shared) / total[c] for c in (0, 1)
    ]
    pooled = (of_word[0] + of_word[1] + shared) / (sum(total) + 1)
    alone = np.stack([np.where(tells, x, pooled) for x in alone])
    return {"alone": alone, "context": context, "back": DISCOUNT * kinds / np.maximum(context, 1)}


def telling(m: dict, pair: np.ndarray, counts: np.ndarray):
    """The bigrams that deviate from their word, and the differences of the two models' log-probabilities for them."""
    alone, context, back = m["alone"], m["context"], m["back"]
    known = (np.minimum(*context) >= KNOWN_CONTEXT)[pair // alone.shape[1]]
    pair, counts = pair[known], counts[known]
    before, word = pair // alone.shape[1], pair % alone.shape[1]
    n = [counts[:, c].astype(float) for c in (0, 1)]
    expected = [context[c][before] * alone[c][word] for c in (0, 1)]
    kept = evidence(*n, expected[1] / np.maximum(expected[0] + expected[1], 1e-300)) >= EVIDENCE
    seen = [np.maximum(n[c] - DISCOUNT, 0) / np.maximum(context[c][before], 1) + back[c][before] * alone[c][word] for c in (0, 1)]
    return pair[kept], np.log(np.maximum(seen[1][kept], 1e-300)) - np.log(np.maximum(seen[0][kept], 1e-300))


def tell_bigrams(shared):
    """Task: of bigrams and their counts in both classes those that tell, with their difference."""

    def run(batches):
        for b in batches:
            counts = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in (1, 2)], axis=1)
            pair, ratio = telling(shared.value, b.column("pair").to_numpy(zero_copy_only=False), counts)
            yield pa.record_batch([pa.array(pair), pa.array(ratio)], names=["pair", "ratio"])

    return run


def model_of(vocabulary: np.ndarray, words: dict, pair: np.ndarray, ratio: np.ndarray) -> dict:
    """Differences of the two models' log-probabilities, for the words and bigrams that have one; other words are as good as unknown."""
    each = np.log(words["alone"][1]) - np.log(words["alone"][0])
    before, word = pair // len(each), pair % len(each)
    used = each != 0
    used[[0, -1]] = used[before] = used[word] = True
    place = np.cumsum(used) - 1
    pair = place[before] * used.sum() + place[word]
    order = np.argsort(pair)
    return {"vocabulary": vocabulary[used[1:-1]], "word": each[used], "pair": pair[order], "ratio": ratio[order]}


def per_text(m: SimpleNamespace, data: np.ndarray, offs: np.ndarray):
    """Number of tokens and mean log-likelihood difference of each text."""
    before, word, row = bigrams_of(m.vocabulary, data, offs)
    each = m.word[word]
    if len(m.pair):
        key = before * (len(m.vocabulary) + 2) + word
        place = np.searchsorted(m.pair, key)
        place[place == len(m.pair)] = 0
        each = np.where(m.pair[place] == key, m.ratio[place], each)
    n = np.bincount(row, minlength=len(offs) - 1)
    return n, np.bincount(row, weights=each, minlength=len(offs) - 1) / np.maximum(n, 1)


def score_texts(shared):
    def run(batches):
        m = SimpleNamespace(**shared.value)
        for b in batches:
            data, offs = text_bytes(b.column("text"))
            n, mean = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for i, j in blocks(offs):
                n[i:j], mean[i:j] = per_text(m, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.record_batch([*(b.column(c) for c in rest), pa.array(n), pa.array(mean)], names=[*rest, "n_tokens", "ratio"])

    return run


def features(n: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The difference per token, and per root of the number of tokens, which says how far chance can carry it."""
    return np.stack([ratio, ratio * np.sqrt(n)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray) -> dict:
    """Centre, scale and weights per feature and the bias of a logistic curve, by Newton steps with a little ridge."""
    plain = {"centre": [0.0] * x.shape[1], "scale": [1.0] * x.shape[1], "weight": [1.0] + [0.0] * (x.shape[1] - 1), "bias": 0.0}
    if len(x) == 0 or y.min() == y.max():
        return plain | ({"bias": 4.0 if y[0] else -4.0} if len(x) else {})
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    a = np.concatenate([(x - centre) / scale, np.ones((len(x), 1))], axis=1)
    w = np.zeros(a.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(len(w)), a.T @ (y - p) - 0.01 * w)
    return {"centre": centre.tolist(), "scale": scale.tolist(), "weight": w[:-1].tolist(), "bias": float(w[-1])}


def crc_of_id(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary"))


def fit(documents: DataFrame, labels: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic"):
    """Models and curve from the labelled rows where ``learn`` holds, and from the contexts of words in all documents."""
    spark = documents.sparkSession
    sample = (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
        .where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(learn).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(rows)
    )
    corpus = documents.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # at most ``rows`` rows of two numbers go to the tasks; copies are one observation
    texts = corpus.join(F.broadcast(sample), "doc_id").select("toxic", "text").distinct()
    texts = staged(texts.withColumn("apart", F.pmod(F.xxhash64("text", F.lit("apart")), F.lit(4)) == 0))  # for the curve
    words = texts.select("text").mapInArrow(see_words(), "word long").distinct().toArrow()
    vocabulary = np.sort(words.column("word").to_numpy().astype(np.int64).view(np.uint64))
    width, known = len(vocabulary) + 2, spark.sparkContext.broadcast(vocabulary)
    word, before = f"pair % {width}", f"pair div {width}"
    kind = "pair long, " + ", ".join(f"{n} long" for n in SIDES)
    counted = staged(texts.mapInArrow(count_bigrams(known), kind).groupBy("pair").agg(*(F.sum(n).alias(n) for n in SIDES)))

    def margins(rows: DataFrame, by: str, **sums: Column) -> np.ndarray:
        """Sums over the bigrams of each word or context, as one row per sum; at most the vocabulary."""
        found = rows.groupBy(F.expr(by).alias("at")).agg(*(F.sum(c).alias(k) for k, c in sums.items())).toArrow()
        out = np.zeros((len(sums), width))
        out[:, found.column("at").to_numpy()] = [found.column(k).to_numpy() for k in sums]
        return out

    contexts = margins(corpus.select("text").mapInArrow(see_contexts(known), "pair long").distinct(), word, c=F.lit(1))
    contexts[:, 1:-1] = np.maximum(contexts[:, 1:-1], 1)  # words longer than a beginning

    def model(*sides: str):
        """Model from two columns of counts, one for each class."""
        rows = counted.select("pair", *sides).where(F.greatest(*sides) > 0)
        n = [F.col(c) for c in sides]
        of_word = margins(rows, word, a=n[0], b=n[1])
        of_context = margins(rows, before, a=n[0], b=n[1], c=(n[0] > 0).cast("int"), d=(n[1] > 0).cast("int"))
        tested = of_words(np.concatenate([of_word, contexts]), of_context)
        told = rows.mapInArrow(tell_bigrams(spark.sparkContext.broadcast(tested)), "pair long, ratio double").toArrow()
        found = model_of(vocabulary, tested, told.column("pair").to_numpy().astype(np.int64), told.column("ratio").to_numpy())
        return spark.sparkContext.broadcast(found)

    # the curve is fitted to texts its model has not seen; the model that scores has seen all of the sample
    seen = texts.where("apart").select("toxic", "text").mapInArrow(score_texts(model("f0", "f1")), "toxic int, n_tokens long, ratio double").toArrow()
    x, y = features(seen.column("n_tokens").to_numpy(), seen.column("ratio").to_numpy()), seen.column("toxic").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # sums must not depend on the order of arrival
    return model("n0", "n1"), logistic(x[order], y[order])


def score_toxicity(documents: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc`` (id), ``th`` (hash of the text), ``n_tokens``, ``ratio`` (mean log-likelihood difference) and ``score`` (0 to 1)."""
    shared, curve = model
    text = F.col(f"`{text_col}`")
    rows = documents.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("th"), text.alias("text"))
    kind = f"doc {rows.schema['doc'].dataType.simpleString()}, th long, n_tokens long, ratio double"
    x = curve["bias"]
    for value, centre, scale, weight in zip(
        (F.col("ratio"), F.col("ratio") * F.sqrt("n_tokens")), curve["centre"], curve["scale"], curve["weight"]
    ):
        x = x + weight * (value - centre) / scale
    return rows.mapInArrow(score_texts(shared), kind).withColumn("score", 1 / (1 + F.exp(-x)))


def op2_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Score of each document; one fifth of the ids, by crc32, is never learned from."""
    held_out = F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0
    scored = score_toxicity(documents, fit(documents, labels, ~held_out))
    return scored.withColumnRenamed("doc", "doc_id").select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
