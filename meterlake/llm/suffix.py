"""Removal of repeated text by a sparse suffix array over all documents.

A byte goes if a LENGTH-byte string that covers it also starts in a document with a smaller id. Indexing every suffix would multiply the
corpus, so only sampled suffixes are: of the GRAM-byte strings inside each window of LENGTH bytes the one with the least hash marks a
suffix, and equal windows mark the same one. Suffixes are ranged by the hash of their leading GRAM bytes into buckets, which the hash
keeps even without sampling splitters.

1. Every task sends the distinct leading hashes of its texts, with the group of documents they are for; a bucket sorts them and tells each
   group which of its hashes another document has too. Nothing else of unique text travels.
2. Each group's suffixes with such a hash are sent with the text of the windows they mark, equal ones once. A bucket sorts the windows and
   learns the smallest document of each; windows of larger documents go back as spans.
3. Groups cut the spans out of their texts.

Exact copies of a document with a smaller id need no suffixes: they go whole, found by their SHA-256.

Defined cases: null text is empty; texts shorter than LENGTH bytes lose nothing; rows of one id are never compared with each other; a null
id counts as larger than all; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import BYTE_CODE, cut_lineage, mix, parallel, release, steps, table, text_bytes

LENGTH = 50
GRAM = 20
STEP = 2 << 20
LAST_ID = 2**63 - 1
FACTOR = 0x9E3779B97F4A7C15


def rolling(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hash of each string of `length` bytes, built from those of half the length."""
    if length == 1:
        return BYTE_CODE[data]
    half = length // 2
    part = rolling(data, half)
    n = len(data) - length + 1
    out = part[:n] + part[half : half + n] * np.uint64(pow(FACTOR, half, 1 << 64))
    if length % 2:
        out = out + BYTE_CODE[data[length - 1 : length - 1 + n]] * np.uint64(pow(FACTOR, length - 1, 1 << 64))
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def sampled(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sampled suffixes of all texts: leading hash, number of the text, first and last start of the windows that mark it."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none
    grams = mix(rolling(data, GRAM))
    bits = np.uint64(len(grams).bit_length())
    # Hash above, place below: the least is the leftmost of equal ones, and tells its place.
    places = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_min(places, LENGTH - GRAM + 1) & np.uint64((1 << int(bits)) - 1)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = np.flatnonzero(text[: len(least)] == text[LENGTH - 1 :])
    if not len(starts):
        return none.astype(np.uint64), none, none, none
    place = least[starts].astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (text[starts[1:]] != text[starts[:-1]]))))
    last = np.append(first[1:], len(starts)) - 1
    return grams[place[first]], text[starts[first]], starts[first], starts[last]


def ranges_of(sorted_values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and n+1 bounds of their runs."""
    first = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1]))) if len(sorted_values) else np.zeros(0, np.int64)
    return sorted_values[first], np.append(first, len(sorted_values))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def shared_hashes(docs: DataFrame, buckets: int) -> DataFrame:
    """part, hashes: the leading hashes that documents of a group share with any other document."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(0).to_numpy()
            data, offsets = text_bytes(batch.column(1))
            for first, last, piece, own in steps(data, offsets, STEP):
                hashes, text, _, _ = sampled(piece, own)
                order = np.lexsort((text, hashes))
                hashes, text = hashes[order], text[order]
                keep = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1]))) if len(hashes) else np.zeros(0, bool)
                hashes, text = hashes[keep], text[keep]
                part = parts[first:last][text].astype("<u4")
                keys, bounds = ranges_of(bucket_of(hashes, buckets))
                rows = [(int(k), hashes[a:b].tobytes(), part[a:b].tobytes()) for k, a, b in zip(keys, bounds[:-1], bounds[1:], strict=True)]
                if rows:
                    k, h, p = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(h, pa.binary()), pa.array(p, pa.binary())], names=["bucket", "hashes", "parts"])

    def meet(rows: pa.Table) -> pa.Table:
        hashes = np.frombuffer(b"".join(rows.column("hashes").to_pylist()), np.uint64)
        parts = np.frombuffer(b"".join(rows.column("parts").to_pylist()), "<u4")
        order = np.argsort(hashes, kind="stable")
        hashes, parts = hashes[order], parts[order]
        _, bounds = ranges_of(hashes)
        many = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        hashes, parts = hashes[many], parts[many]
        order = np.lexsort((hashes, parts))
        hashes, parts = hashes[order], parts[order]
        keep = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (parts[1:] != parts[:-1]))) if len(hashes) else np.zeros(0, bool)
        hashes, parts = hashes[keep], parts[keep]
        keys, bounds = ranges_of(parts)
        return pa.table(
            {
                "part": pa.array(keys.astype(np.int32)),
                "hashes": pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
            }
        )

    sent = docs.select("part", "text").mapInArrow(send, "bucket int, hashes binary, parts binary")
    return sent.groupBy("bucket").applyInArrow(meet, "part int, hashes binary")


def ordered(rows: pa.Table) -> pa.Table:
    """A group's documents in the order that numbers them."""
    return rows.sort_by([("doc_id", "ascending"), ("uid", "ascending")])


def copies_in(rows: pa.Table, notes: pa.Table) -> np.ndarray:
    """Which of the ordered documents are exact copies of one with a smaller id."""
    known = set(zip(notes.column("doc_id").to_pylist(), notes.column("uid").to_pylist(), strict=True))
    return np.array([x in known for x in zip(rows.column("doc_id").to_pylist(), rows.column("uid").to_pylist(), strict=True)], bool)


SENT = "bucket int, part int, texts binary, lengths binary, which binary, ids binary, numbers binary, starts binary"


def small(data: np.ndarray | bytes) -> bytes:
    """Compressed bytes, for rows between groups and buckets."""
    import zstandard

    return zstandard.ZstdCompressor(1).compress(data if isinstance(data, bytes) else data.tobytes())


def large(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def windows_sent(docs: DataFrame, notes: DataFrame, buckets: int) -> DataFrame:
    """For every bucket and group: the distinct texts of the windows of shared suffixes, and where they occur."""

    def send(rows: pa.Table, notes: pa.Table) -> pa.Table:
        rows = ordered(rows)
        shared = np.unique(np.frombuffer(b"".join(x for x in notes.column("hashes").to_pylist() if x), np.uint64))
        copy = copies_in(rows, notes) if rows.num_rows else np.zeros(0, bool)
        ids = rows.column("doc_id").to_numpy()
        part = rows.column("part")[0].as_py() if rows.num_rows else 0
        data, offsets = text_bytes(rows.column("text"))
        found: list[tuple] = []
        for first, _, piece, own in steps(data, offsets, STEP):
            hashes, text, begin, last = sampled(piece, own)
            at = np.minimum(np.searchsorted(shared, hashes), max(len(shared) - 1, 0))
            keep = (shared[at] == hashes if len(shared) else np.zeros(len(hashes), bool)) & ~copy[first + text]
            found.append((hashes[keep], first + text[keep], begin[keep] + offsets[first], last[keep] + offsets[first]))
        hashes, text, begin, last = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4))
        order = np.argsort(hashes, kind="stable")
        hashes, text, begin, last = hashes[order].astype(np.uint64), text[order], begin[order], last[order]
        out: list[tuple] = []
        keys, bounds = ranges_of(bucket_of(hashes, buckets))
        whole = data.tobytes()
        for key, a, b in zip(keys.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            distinct: dict[bytes, int] = {}
            which = [distinct.setdefault(whole[x : y + LENGTH], len(distinct)) for x, y in zip(begin[a:b].tolist(), last[a:b].tolist(), strict=True)]
            own = text[a:b]
            out.append(
                (
                    key, part, small(b"".join(distinct)), small(np.array([len(x) for x in distinct], "<u4")), small(np.array(which, "<u4")),
                    small(ids[own].astype("<i8")), small(own.astype("<u4")), small((begin[a:b] - offsets[own]).astype("<u4")),
                )
            )
        columns = list(zip(*out, strict=True)) if out else [[]] * 8
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6]
        names = ["bucket", "part", "texts", "lengths", "which", "ids", "numbers", "starts"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)})

    return docs.groupBy("part").cogroup(notes.groupBy("part")).applyInArrow(send, SENT)


def repeated_spans(sent: DataFrame) -> DataFrame:
    """part, numbers, starts, ends: bytes of each group's documents that windows of documents with smaller ids cover."""

    def meet(rows: pa.Table) -> pa.Table:
        n = rows.num_rows
        column = lambda name: [large(x) for x in rows.column(name).to_pylist()]
        lengths = [np.frombuffer(x, "<u4").astype(np.int64) for x in column("lengths")]
        counts = np.array([len(x) for x in lengths])
        length = np.concatenate(lengths)
        data = np.frombuffer(b"".join(column("texts")), np.uint8)
        base = np.concatenate(([0], np.cumsum(counts)[:-1]))
        whiches = [np.frombuffer(x, "<u4").astype(np.int64) for x in column("which")]
        which = np.concatenate([w + b for w, b in zip(whiches, base, strict=True)])
        row = np.repeat(np.arange(n), [len(w) for w in whiches])
        ids = np.frombuffer(b"".join(column("ids")), "<i8")
        number = np.frombuffer(b"".join(column("numbers")), "<u4")
        start = np.frombuffer(b"".join(column("starts")), "<u4").astype(np.int64)
        # The smallest document of each text, then of each window of all texts.
        least = np.full(len(length), LAST_ID)
        np.minimum.at(least, which, ids)
        size = length - LENGTH + 1
        hashed = []
        for first, last, piece, ends in steps(data, np.concatenate(([0], np.cumsum(length))), 1 << 20):
            wide = size[first:last]
            at = np.arange(wide.sum()) + np.repeat(ends[:-1] - np.cumsum(wide) + wide, wide)
            hashed.append(mix(rolling(piece, LENGTH))[at])
        hashes = np.concatenate(hashed)
        own = np.repeat(least, size)
        order = np.lexsort((own, hashes))
        _, bounds = ranges_of(hashes[order])
        smallest = np.empty(len(own), np.int64)
        smallest[order] = np.repeat(own[order][bounds[:-1]], np.diff(bounds))
        del hashed, hashes, own, order, data
        # Occurrences again: their windows, and which of them a smaller document has.
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        wide = size[which]
        place = np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
        covered = smallest[np.repeat(first[which], wide) + place] < np.repeat(ids, wide)
        opens = covered.copy()
        opens[1:] &= ~covered[:-1] | (place[1:] == 0)
        closes = covered.copy()
        closes[:-1] &= ~covered[1:] | (place[1:] == 0)
        who = np.repeat(np.arange(len(which)), wide)[opens]
        begin, end = start[who] + place[opens], start[who] + place[closes] + LENGTH
        part = rows.column("part").to_numpy()[row[who]]
        order = np.argsort(part, kind="stable")
        keys, bounds = ranges_of(part[order])
        packed = [
            pa.array([x[order][a:b].astype("<u4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())
            for x in (number[who], begin, end)
        ]
        return pa.table({"part": pa.array(keys.astype(np.int32)), "numbers": packed[0], "starts": packed[1], "ends": packed[2]})

    return sent.groupBy("bucket").applyInArrow(meet, "part int, numbers binary, starts binary, ends binary")


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def cut_spans(docs: DataFrame, notes: DataFrame, with_bytes: bool) -> DataFrame:
    """Counts, digest and (if wanted) bytes of what is left of every document."""

    def cut(rows: pa.Table, notes: pa.Table) -> pa.Table:
        rows = ordered(rows)
        n = rows.num_rows
        copy = copies_in(rows, notes) if n else np.zeros(0, bool)
        number, begin, end = (
            np.frombuffer(b"".join(x for x in notes.column(c).to_pylist() if x), "<u4").astype(np.int64) for c in ("numbers", "starts", "ends")
        )
        data, offsets = text_bytes(rows.column("text"))
        # +1 where a span of the group's bytes begins, -1 where it ends.
        depth = np.zeros(len(data) + 1, np.int32)
        np.add.at(depth, offsets[number] + begin, 1)
        np.add.at(depth, offsets[number] + end, -1)
        gone = np.cumsum(depth[:-1]) > 0
        out = []
        ids = rows.column("doc_id").to_pylist()
        for i in range(n):
            own, mark = data[offsets[i] : offsets[i + 1]], gone[offsets[i] : offsets[i + 1]]
            if copy[i] and len(own) >= LENGTH:
                mark = np.ones(len(own), bool)
            kept = own[~mark].tobytes()
            runs = int(mark[:1].sum() + (mark[1:] & ~mark[:-1]).sum())
            doc = ids[i] if ids[i] != LAST_ID else None
            out.append((doc, len(own), int(mark.sum()), runs, hashlib.sha256(kept).hexdigest(), kept if with_bytes else None))
        columns = list(zip(*out, strict=True)) if out else [[]] * 6
        kinds = [*[pa.int64()] * 4, pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        return pa.table({m: pa.array(c, k) for m, c, k in zip(names, columns, kinds, strict=True)})

    return docs.groupBy("part").cogroup(notes.groupBy("part")).applyInArrow(cut, KEPT)


def remove_repeats(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept of every document (doc_id, text)."""
    spark = docs.sparkSession
    # A group sends a row to each bucket it has something for, so neither number is more than memory asks for.
    parts, buckets = 2 * parallel(spark), 16 * parallel(spark)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    rows = rows.withColumn("uid", F.xxhash64("doc_id", "text"))
    rows = rows.withColumn("part", F.pmod("uid", F.lit(parts)).cast("int"))
    keys = rows.select("part", "doc_id", "uid", F.unhex(F.sha2("text", 256)).alias("sha"))
    first = keys.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = keys.join(first, "sha").filter("doc_id > first").select("part", "doc_id", "uid").distinct()
    copies = cut_lineage(copies)
    shared = cut_lineage(shared_hashes(rows, buckets))
    release(spark)
    notes = shared.unionByName(copies, allowMissingColumns=True)
    spans = cut_lineage(repeated_spans(windows_sent(rows, notes, buckets)))
    release(spark)
    return cut_spans(rows, spans.unionByName(copies, allowMissingColumns=True), with_bytes)


def op2_suffix(spark, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"), with_bytes=False).drop("kept")
