"""Best-fit packing of token pieces into sequences of a fixed size, by minimum bin slack.

The plan needs only how many pieces there are of each length: at most `size` numbers, whatever the corpus holds. For one
sequence after another the largest length left is fixed, and a subset-sum over bitsets finds the fullest combination of the
other lengths; that combination is then removed as often as the counts allow. So the number of distinct combinations depends
on `size`, not on the number of pieces. Every piece gets a rank among those of its length, from counts per bucket of its key,
and finds its place by a binary search in the plan. No group of pieces is ever gathered.

Defined cases: null text is empty; an empty text is the end token alone; an empty table gives no rows; repeated rows are packed
each; pieces of a null document id are packed like others; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import BYTE_CODE, cut_lineage, mix, odd_powers, steps, table, text_bytes

SIZE = 4096
END = 1
#: Buckets of a length's pieces in which ranks are counted; a hot length is spread over all of them.
BUCKETS = 512
WORD_MEMORY = 400_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters for which lower case, composition and the word pattern are plain; other texts go to the tokenizer whole.
PLAIN = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿŒœŸ]")
#: Classes of the bytes of such texts: 0 space, 1 letter, 2 digit, 3 any other.
KIND = np.full(256, 3, np.uint8)
KIND[[9, 10, 13, 32]] = 0
KIND[np.r_[97:123, 128:256]] = 1
KIND[48:58] = 2


class Encoder:
    """Token ids of many texts at once, equal to the tokenizer's own.

    Texts of plain characters are cut into the vocabulary's words (letters; one digit; anything else; 's 't 're 've 'm 'll 'd) on
    byte classes; each distinct word, known by its 64-bit hash, is encoded once, and the ids are gathered. Memory is bounded: all
    words are forgotten when there are `memory` of them.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)")
        words = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(words.values()) + 1, bool)
        self.ends[[i for w, i in words.items() if w.endswith("</w>")]] = True
        self.memory = WORD_MEMORY
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)  # sorted hashes of the words
        self.at = self.lengths = np.zeros(0, np.int64)  # of each word, into ids
        self.ids = np.zeros(0, np.uint32)

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        """keys rise and are new."""
        if len(self.keys) + len(keys) > self.memory:
            self.forget()
        chunks = [" ".join(words[i : i + 1000]) for i in range(0, len(words), 1000)]
        ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        begins = np.concatenate(([0], stops[:-1]))
        place = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, place, keys)
        self.at = np.insert(self.at, place, begins + len(self.ids))
        self.lengths = np.insert(self.lengths, place, stops - begins)
        self.ids = np.concatenate((self.ids, ids))

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        data = np.frombuffer("".join([t.lower() + "\n" for t in texts]).encode(), np.uint8)
        kind = KIND[data]
        starts = kind > 0
        starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        for i in np.flatnonzero(starts & (data == 39)):
            tail = bytes(data[i + 1 : i + 3])
            n = 1 if tail[:1] in (b"s", b"t", b"m", b"d") else 2 if tail in (b"re", b"ve", b"ll") else 0
            if n:
                starts[i + 1] = False
                starts[i + 1 + n] = kind[i + 1 + n] > 0
        begin = np.flatnonzero(starts)
        docs = np.searchsorted(begin, np.concatenate(([0], np.flatnonzero(data == 10) + 1)))
        if not len(begin):
            return [np.zeros(0, np.uint32) for _ in texts]
        where = np.flatnonzero(kind)
        first = np.searchsorted(where, begin)
        size = np.diff(np.append(first, len(where)))
        part = BYTE_CODE[data[where]] * odd_powers(int(size.max()))[np.arange(len(where)) - np.repeat(first, size)]
        codes = mix(np.add.reduceat(part, first) + size.astype(np.uint64))
        distinct, some, back = np.unique(codes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        new = np.ones(len(distinct), bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != distinct[inside]
        if new.any():
            if len(self.keys) + int(new.sum()) > self.memory:
                self.forget()
                new[:] = True
            at = some[new]
            self.learn(distinct[new], [data[b : b + n].tobytes().decode() for b, n in zip(begin[at], size[at], strict=True)])
            place = np.searchsorted(self.keys, distinct)
        word = place[back]
        lengths = self.lengths[word]
        ends = np.cumsum(lengths)
        flat = self.ids[np.repeat(self.at[word] - ends + lengths, lengths) + np.arange(ends[-1])]
        edges = np.concatenate(([0], ends))[docs]
        return [flat[edges[i] : edges[i + 1]] for i in range(len(texts))]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        simple = [not (PLAIN.search(t) or self.special.search(t)) for t in texts]
        done = iter(self.plain([t.replace("\n", " ") for t, ok in zip(texts, simple, strict=True) if ok]))
        return [
            next(done) if ok else np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32)
            for t, ok in zip(texts, simple, strict=True)
        ]


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document's ids followed by `end`, cut after every `size` ids."""
    tail = np.array([end], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            _, offsets = text_bytes(batch.column(1))
            rows: list[tuple] = []
            for first, last, _, _ in steps(np.zeros(0, np.uint8), offsets):
                texts = [t or "" for t in batch.column(1).slice(first, last - first).to_pylist()]
                for doc, tokens in zip(ids[first:last], encoder.encode(texts), strict=True):
                    tokens = np.concatenate((tokens, tail)).astype("<u4")
                    for k, at in enumerate(range(0, len(tokens), size)):
                        part = tokens[at : at + size]
                        rows.append((doc, k, at, len(part), zlib.crc32(part)))
            doc, piece, start, length, crc = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def fullest(counts: np.ndarray, room: int, lengths: list[int]) -> list[tuple[int, int]]:
    """Lengths and copies whose sum is the largest up to `room`; `lengths` falls and holds those with counts."""
    reach, layers = 1, []
    mask = (1 << (room + 1)) - 1
    for length in lengths:
        if length > room:
            continue
        layers.append((length, reach))
        copies, unit = min(int(counts[length]), room // length), 1
        while copies > 0:
            take = min(unit, copies)
            reach |= (reach << (take * length)) & mask
            copies -= take
            unit *= 2
        if reach >> room & 1:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(layers):
        used = 0
        while not before >> left & 1:
            left -= length
            used += 1
        if used:
            chosen.append((length, used))
    return chosen


def plan_bins(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(how many sequences, [(length, pieces of it in each)]) until no piece is left."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    lengths = [int(x) for x in np.flatnonzero(left)[::-1]]
    while lengths:
        largest = lengths[0]
        left[largest] -= 1
        combo = dict(fullest(left, size - largest, lengths if left[largest] else lengths[1:]))
        left[largest] += 1
        combo[largest] = combo.get(largest, 0) + 1
        times = min(int(left[x]) // k for x, k in combo.items())
        for x, k in combo.items():
            left[x] -= times * k
        out.append((times, sorted(combo.items(), reverse=True)))
        lengths = [x for x in lengths if left[x]]
    return out


def slots(plan: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, copies in a sequence, first sequence, offset), sorted by length and rank."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, combo in plan:
        offset = 0
        for length, copies in combo:
            rows.append((length, rank.get(length, 0), copies, sequence, offset))
            rank[length] = rank.get(length, 0) + times * copies
            offset += length * copies
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def ranked(pieces: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Adds `rank`, from 0, among the pieces of a length: counts of the buckets before, then places within the bucket."""
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    sums = sums.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*keys)
    return (
        dealt.withColumn("_at", F.row_number().over(inside) - 1)
        .join(sums, ["length", "_bucket"])
        .withColumn("rank", F.col("_at") + F.col("_before"))
        .drop("_at", "_before", "_bucket")
    )


def pack(pieces: DataFrame, keys: list[str], size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` from 1 to `size`. `pieces` is read twice: cut its lineage first."""
    spark = pieces.sparkSession
    # At most `size` rows, whatever the corpus holds.
    counts = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    places = spark.sparkContext.broadcast(slots(plan_bins(counts, size)))
    names = list(pieces.columns)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = places.value
        shift = 1 << 48
        firsts = rows[:, 0] * shift + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
            at = rows[np.searchsorted(firsts, length * shift + rank, "right") - 1] if len(rank) else rows[:0]
            past = rank - at[:, 1]
            sequence, offset = at[:, 3] + past // at[:, 2], at[:, 4] + past % at[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    return ranked(pieces, keys).select(*names, "rank").mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = END) -> DataFrame:
    """Pieces of all documents with their places. The piece table (no ids, 40 bytes a piece) is written once."""
    pieces = cut_lineage(token_pieces(docs, vocabulary, size, end))
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], size)


def op4_packing(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
