"""Helpers of the text operators: hashing of byte and word ranges in numpy, Arrow access, staged tables."""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U = np.uint64
NO_ID = 2**63 - 1  # stands for a null id: such rows come last in any order
LONG_WORD = 256  # bytes of a word that is hashed on its own
BLOCK_BYTES = 1 << 18  # text handled at once by the numpy code, so that its arrays stay in the cache


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of 64-bit words (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BYTE_CODES = mix(np.arange(256, dtype=np.uint64))
BASE = 0x2545F4914F6CDD1D
INVERSE = pow(BASE, -1, 2**64)
_SPACE = b" \t\n\x0b\x0c\r"
IS_WORD = np.array([b not in _SPACE for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z to a-z
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the hash base and of its inverse modulo 2**64, kept between calls."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 2 * BLOCK_BYTES)
        for name, base in (("up", BASE), ("down", INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class RangeHash:
    """Hash of any range of a sequence of 64-bit codes, equal for equal content wherever it stands."""

    def __init__(self, codes: np.ndarray):
        up, self.down = powers(len(codes) + 1)
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word: eight bytes after the other are mixed into it, so no arrangement of equal parts cancels out.

    Words of more than LONG_WORD bytes are hashed one by one.
    """
    length = ends - starts
    code = mix(length.astype(U))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))  # the eight bytes from each place on
    left = np.nonzero((length > 0) & (length <= LONG_WORD))[0]
    done = 0
    while len(left):
        inside = np.minimum(length[left] - done, 8)
        value = eight[starts[left] + done] & (U(2**64 - 1) >> (U(64) - U(8) * inside.astype(U)))
        code[left] = mix(code[left] ^ value)
        done += 8
        left = left[length[left] > done]
    for k in np.nonzero(length > LONG_WORD)[0]:
        code[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return code


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text or binary column without copying, and the offsets of its rows; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offs = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offs


def blocks(offs: np.ndarray, limit: int = BLOCK_BYTES):
    """Ranges of rows whose texts hold about ``limit`` bytes; a longer text is a range of its own."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words_in(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray = IS_WORD):
    """Start, end and row of each word of the texts at ``offs``; words never cross rows."""
    mask = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[offs] = True
    before = np.concatenate([[False], mask[:-1]]) & ~first[:-1]
    after = np.concatenate([mask[1:], [False]]) & ~first[1:]
    starts = np.nonzero(mask & ~before)[0]
    ends = np.nonzero(mask & ~after)[0] + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    reach = 1
    while reach * 2 <= width and len(values) > reach:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    if rest and len(values) > rest:
        values = np.minimum(values[:-rest], values[rest:])
        reach += rest
    return values if reach == width else values[:0]


def union_runs(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by half-open intervals; touching ones join."""
    if not len(start):
        return []
    order = np.argsort(start, kind="stable")
    start, end = np.asarray(start)[order], np.maximum.accumulate(np.asarray(end)[order])
    cut = np.nonzero(start[1:] > end[:-1])[0]
    return list(zip(start[np.concatenate([[0], cut + 1])].tolist(), end[np.concatenate([cut, [len(end) - 1]])].tolist()))


def id_key(name: str = "doc_id") -> Column:
    """Id to group and order by; null ids share the last place."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def rows_of(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (id, null allowed), ``d`` (id to order by), ``th`` (hash of the text) and ``text`` of each row."""
    text = F.col(f"`{text_col}`")
    return documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc"), id_key(f"`{id_col}`").alias("d"),
        F.xxhash64(text).alias("th"), text.alias("text"),
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: ``spark.checkpoint.dir``, or the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, free: bool = False) -> DataFrame:
    """The frame written once to the shared folder and read again: its lineage ends there, so a lost executor costs a read.

    With ``free`` the shuffle files behind it are deleted as soon as it is written, instead of some time after the driver has
    dropped them, so that they do not lie beside those of the steps that follow.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    was = spark.conf.get(FREED, None)
    try:
        if free:
            spark.conf.set(FREED, "true")
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if free and was is None:
            spark.conf.unset(FREED)
        elif free:
            spark.conf.set(FREED, was)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
