import glob
import os
import tempfile

import numpy as np

from condoflow.llm.common import FREED, RangeHash, word_codes
from condoflow.llm.recompression import op4_substring_dedup, recompress, remove_later_copies
from tests.llm import brute


def test_equal_parts_share_interior_symbols():
    rng = np.random.default_rng(3)
    part = rng.integers(0, 9, 40).astype(np.uint64) + np.uint64(1)
    seen = []
    for edge in range(30):
        codes = np.concatenate([rng.integers(1, 9, edge).astype(np.uint64), part, rng.integers(1, 9, 9).astype(np.uint64)])
        first, size, name = recompress(RangeHash(codes), np.zeros(len(codes), int))
        assert size.sum() == len(codes)
        seen.append({(f - edge, s, n) for f, s, n in zip(first.tolist(), size.tolist(), name.tolist())
                     if f - edge >= 12 and f - edge + s <= 28})
    assert seen[0] and all(s == seen[0] for s in seen)


def test_awkward_rows(spark, rows):
    data = brute.awkward()
    out = op4_substring_dedup(spark.createDataFrame(data, brute.SCHEMA).repartition(5))
    assert rows(out) == sorted(brute.op4([r[:2] for r in data]), key=repr)


def test_empty_table(spark):
    assert op4_substring_dedup(spark.createDataFrame([], brute.SCHEMA)).collect() == []


def test_table_against_brute_force(spark, rows):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    given = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows(op4_substring_dedup(docs)) == sorted(brute.op4(given), key=repr)


def test_runs_and_periods(spark, rows):
    data = [(1, "a " * 90), (2, "b a b a " * 30), (3, "x " + "a " * 25), (4, "a b " * 12 + "z"), (5, "a a b " * 20), (6, "c a a b " * 14)]
    out = op4_substring_dedup(spark.createDataFrame(data, "doc_id long, text string").repartition(4))
    assert rows(out) == sorted(brute.op4(data), key=repr)


def test_different_long_words_are_no_repeat(spark):
    one, other = brute.thue_morse(1024)
    rest = " ".join(f"w{k}" for k in range(19))
    docs = [(1, f"{one} {rest}"), (2, f"{other} {rest}"), (3, f"{one} {rest}")]
    out = op4_substring_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_removed for r in out} == {1: 0, 2: 0, 3: 20}


def test_word_codes_tell_words_by_their_bytes():
    words = [b"a" * n for n in (1, 7, 8, 9, 16, 17, 255, 256, 257, 5000)] + [b"a\x00", b"a\x00\x00", b"\x00", b"b" * 8, b"a" * 8 + b"b", b"a" * 7 + b"b"]
    words += [w.encode() for n in (1024, 2048) for w in brute.thue_morse(n)]
    data = np.frombuffer(b"xyz".join(words + words), np.uint8)
    size = np.array([len(w) for w in words + words])
    starts = np.cumsum(size + 3) - size - 3
    code = word_codes(data, starts, starts + size)
    assert (code[: len(words)] == code[len(words) :]).all() and len(set(code.tolist())) == len(words)
    assert len(word_codes(data[:0], starts[:0], starts[:0])) == 0


def test_shuffle_files_of_the_first_pass_are_gone_when_it_is_staged(spark):
    """They used to lie on disk beside those of the second pass."""
    root = spark.sparkContext.getConf().get("spark.local.dir", tempfile.gettempdir())

    def files():
        return {f for f in glob.glob(f"{root}/blockmgr-*/*/shuffle_*.data") if os.path.getsize(f)}

    before, was = files(), spark.conf.get(FREED, None)
    frame = spark.createDataFrame([(k, " ".join(f"w{(k * 7 + j) % 90}" for j in range(60))) for k in range(40)], "doc_id long, text string")
    out = remove_later_copies(frame.repartition(3))
    assert files() <= before and spark.conf.get(FREED, None) == was
    assert out.count() == 40
