"""Helpers shared by the training-data operators: Arrow text buffers, hashes of words and n-grams, folds, lineage."""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.plans.session import cut_lineage

#: Bytes of text that one numpy step handles; a longer document is a step of its own.
STEP_BYTES = 4 << 20

#: White space of the word definition: bytes 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: The same and every other ASCII sign: bytes that are no part of a letter or digit.
SIGNS = np.arange(256) < 128
SIGNS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
#: A-Z to a-z on bytes; everything else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every bit of a 64-bit value over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def odd_powers(n: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """seed^0 .. seed^(n-1) modulo 2^64."""
    powers = np.full(max(n, 1), np.uint64(seed))
    powers[0] = 1
    return np.multiply.accumulate(powers)


#: One random 64-bit value for each byte value, from the finaliser.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the n+1 offsets into them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def steps(data: np.ndarray, offsets: np.ndarray, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents of at most `limit` bytes: first, behind last, bytes, offsets."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash of each word (A-Z lowered), its byte start and end, and per document the range of its words (n+1)."""
    inside = ~space[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    starts[edges] = inside[edges]
    begin = np.flatnonzero(starts)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, begin, np.zeros(len(offsets), np.int64)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | starts[1:]
    end = np.flatnonzero(stops) + 1
    where = np.flatnonzero(inside)
    lengths = end - begin
    at = where - np.repeat(begin, lengths)
    part = BYTE_CODE[LOWER[data[where]]] * odd_powers(int(lengths.max()))[at]
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    codes = mix(np.add.reduceat(part, first) + lengths.astype(np.uint64))
    return codes, begin, end, np.searchsorted(begin, offsets)


def ngrams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n word hashes."""
    k = len(codes) - n + 1
    if k <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(k, np.uint64)
    for j, power in enumerate(odd_powers(n + 1, 0xD1342543DE82EF95)[1:]):
        out += codes[j : j + k] * power
    return mix(out)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def parallel(spark: SparkSession) -> int:
    """Partitions of a wide exchange: what the session sets."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now rather than when the driver next collects garbage.

    Python's objects let go of the JVM's with the next call, so the JVM is asked twice.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


__all__ = [
    "BYTE_CODE", "LOWER", "SIGNS", "SPACE", "STEP_BYTES", "cut_lineage", "held_out", "mix", "ngrams", "odd_powers", "parallel", "release", "steps", "table",
    "text_bytes", "words",
]
