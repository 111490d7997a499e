"""Token-id files: documents as token ids in ascending id order, each shard compressed by Re-Pair and open to random access.

Rows are dealt by range of (doc_id, hash of the text, place in the input), so files follow each other in order, a hot id is cut too, and no
task gathers more than its range. A task encodes its texts, closes a shard after SHARD ids (between documents; a longer document is a
shard of its own) and writes one row for each shard: where it stands, how much it holds, and its image. Spark's committer writes the
table, so a lost executor's tasks are simply run again.

Image, little endian: header, documents (null flags, ids, numbers of tokens, numbers of symbols), rules (left and right symbol), expansion
length of each rule, symbols. Re-Pair: pairs that occur often become nonterminals, round after round, until none is frequent or a round
gains next to nothing; a round replaces every pair above its threshold at once, the commoner one where two overlap. Documents end with the
end id, and no pair reaches over it. Expansion lengths tell which symbols hold a stretch of ids, so only those are expanded (`ids_between`).

Defined cases: null and empty texts are the end id alone; a null id comes first and is kept as null; repeated rows are documents each, in
the order of their texts' hashes; an empty table gives an empty table of files; further columns are ignored.
"""

from __future__ import annotations

import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import parallel, steps, table, text_bytes
from meterlake.llm.packing import Encoder
from meterlake.plans.session import checkpoint_folder

END = 2
#: Words that a worker process remembers, about 60 bytes each.
WORDS_KEPT = 1_500_000
#: Bytes of text that are encoded at once: numpy takes about 35 times as much meanwhile, and an executor's workers keep what they once took.
STEP = 1 << 20
#: Ids after which a shard is closed.
SHARD = 1 << 20
#: A pair is frequent from so many uses in a shard: a rule costs about four symbols.
FREQUENT = 12
#: A round takes the pairs within this factor of the commonest one, and the last round is one that removes less than this share.
SPREAD, LEAST_GAIN, ROUNDS = 256, 0.02, 24
#: Slots of the table that a round looks pairs up in; of pairs that meet in a slot the commoner is first, the others wait for a later round.
SLOT_BITS = 18
GAP = np.uint32(0xFFFFFFFF)

HEAD = "<4sIIIIQ"
MAGIC = b"RPG1"
FILES = "part int, shard int, first long, n_docs long, n_tokens long, image binary"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


class FastEncoder(Encoder):
    """The same ids; plain words, already lower case and cut, skip the normaliser and the pattern of the vocabulary file."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        super().__init__(vocabulary)
        self.whole = self.tokenizer
        self.of_words = Tokenizer.from_file(vocabulary)
        self.of_words.normalizer = normalizers.Sequence([])
        self.of_words.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )

    def learn(self, keys: np.ndarray, words: list[str]) -> None:
        self.tokenizer = self.of_words
        try:
            super().learn(keys, words)
        finally:
            self.tokenizer = self.whole


def frequent_pairs(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys that occur `least` times or more, and how often, commonest first; ties by key."""
    ordered = np.sort(keys)
    edges = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1, [len(ordered)]))
    counts = np.diff(edges)
    some = np.flatnonzero(counts >= least)
    keys, counts = ordered[edges[some]], counts[some]
    by = np.lexsort((keys, -counts))
    return keys[by], counts[by]


def re_pair(symbols: np.ndarray, base: int, frequent: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Compressed symbols and rules (n x 2); nonterminal base + i stands for rule i. GAP is never part of a pair.

    Where terminals leave room below 2^16, symbols have 16 bits and there are as many rules as fit; otherwise they have 32.
    """
    small = base < 1 << 15 or base + (1 << 12) < 1 << 16
    kind, wide, bits = (np.uint16, np.uint32, 16) if small else (np.uint32, np.uint64, 32)
    none = kind((1 << bits) - 1)
    odd, shift = wide(0x9E3779B1 if small else 0x9E3779B97F4A7C15), wide(2 * bits - SLOT_BITS)
    gap = symbols == GAP
    symbols = symbols.astype(kind)
    symbols[gap] = none
    rules = np.zeros((0, 2), np.uint32)
    for _ in range(ROUNDS):
        room = int(none) - base - len(rules)
        if len(symbols) < 2 or room <= 0:
            break
        keys = (symbols[:-1].astype(wide) << wide(bits)) | symbols[1:]
        gap = symbols == none
        free = ~(gap[:-1] | gap[1:])
        found, counts = frequent_pairs(keys[free], frequent)
        if not len(found):
            break
        found = found[counts >= max(frequent, int(counts[0]) // SPREAD)][:room]
        # The first of a slot is the commonest: written last, from the back.
        rank_of = np.full(1 << SLOT_BITS, len(found), np.int32)
        rank_of[((found * odd) >> shift)[::-1]] = np.arange(len(found) - 1, -1, -1, dtype=np.int32)
        rank = rank_of[(keys * odd) >> shift]
        rank[np.append(found, wide(0))[rank] != keys] = len(found)
        rank[~free] = len(found)
        # A place is taken if its pair comes before both neighbours', the left one of equals.
        taken = rank < len(found)
        taken[1:] &= rank[1:] < rank[:-1]
        taken[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(taken)
        uses = np.bincount(rank[at], minlength=len(found))
        worth = np.flatnonzero(uses >= frequent)
        if not len(worth):
            break
        number = np.zeros(len(found), np.int64)
        number[worth] = base + len(rules) + np.arange(len(worth))
        new = number[rank[at]]
        at, new = at[new > 0], new[new > 0]
        pairs = found[worth]
        rules = np.concatenate((rules, np.stack((pairs >> wide(bits), pairs & wide(none)), 1).astype(np.uint32)))
        symbols[at] = new
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        few = len(at) < LEAST_GAIN * len(symbols)
        symbols = symbols[keep]
        if few:
            break
    out = symbols.astype(np.uint32)
    out[symbols == none] = GAP
    return out, rules


def kept_encoder(vocabulary: str) -> FastEncoder:
    """The worker process's encoder: words that a task has learnt serve the next one."""
    kept = sys.__dict__.setdefault("_token_encoders", {})
    if vocabulary not in kept:
        kept[vocabulary] = FastEncoder(vocabulary)
        kept[vocabulary].memory = WORDS_KEPT
    return kept[vocabulary]


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule stands for; rules name earlier ones only."""
    out = np.ones(len(rules), np.int64)
    pairs = rules.astype(np.int64) - base
    # Rules of a round name rules of earlier rounds, so a few passes settle all.
    while True:
        parts = np.where(pairs >= 0, out[np.maximum(pairs, 0)], 1) if len(rules) else np.zeros((0, 2), np.int64)
        new = parts.sum(1)
        if np.array_equal(new, out):
            return out
        out = new


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids behind symbols: every pass replaces the nonterminals by their pairs."""
    symbols = symbols.astype(np.uint32)
    while True:
        high = symbols >= base
        if not high.any():
            return symbols
        ends = np.cumsum(np.where(high, 2, 1))
        out = np.empty(int(ends[-1]), np.uint32)
        pairs = rules[symbols[high] - base]
        out[ends[high] - 2] = pairs[:, 0]
        out[ends[high] - 1] = pairs[:, 1]
        out[ends[~high] - 1] = symbols[~high]
        symbols = out


def shard_image(ids: list[int | None], tokens: list[np.ndarray], end: int, base: int) -> bytes:
    """Documents' tokens (without the end id) as an image."""
    counts = np.array([len(t) for t in tokens], np.int64)
    flat = np.full(int(counts.sum()) + len(tokens), GAP, np.uint32)
    inside = np.ones(len(flat), bool)
    inside[np.cumsum(counts + 1) - 1] = False
    if len(flat) > len(tokens):
        flat[inside] = np.concatenate(tokens)
    symbols, rules = re_pair(flat, base)
    ends = np.flatnonzero(symbols == GAP)
    symbols[ends] = end
    kind = np.uint16 if base + len(rules) <= 1 << 16 else np.uint32
    head = struct.pack(HEAD, MAGIC, base, len(tokens), len(rules), len(symbols), len(flat))
    null = np.array([i is None for i in ids], np.uint8)
    parts = (
        null, np.array([i or 0 for i in ids], "<i8"), (counts + 1).astype("<u4"), np.diff(ends, prepend=-1).astype("<u4"),
        rules.astype("<u4"), expansion_lengths(rules, base).astype("<u4"), symbols.astype(kind),
    )
    return head + b"".join(p.tobytes() for p in parts)


class Shard:
    """An image, read; nothing is expanded before it is asked for."""

    def __init__(self, image: bytes):
        magic, self.base, docs, rules, symbols, self.n_tokens = struct.unpack_from(HEAD, image)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(HEAD)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(image, kind, n, at)
            at += out.nbytes
            return out

        null, ids = take("u1", docs), take("<i8", docs)
        self.ids = [None if n else int(i) for n, i in zip(null, ids, strict=True)]
        self.counts, self.widths = take("<u4", docs).astype(np.int64), take("<u4", docs).astype(np.int64)
        self.rules, self.lengths = take("<u4", 2 * rules).reshape(-1, 2), take("<u4", rules).astype(np.int64)
        self.symbols = take("<u2" if self.base + rules <= 1 << 16 else "<u4", symbols)

    def sizes(self) -> np.ndarray:
        """Ids that each symbol stands for."""
        return np.concatenate((np.ones(self.base, np.int64), self.lengths))[self.symbols]

    def all_ids(self) -> np.ndarray:
        """Every rule is expanded once, and the ids of all symbols are gathered from there."""
        flat = np.concatenate((np.arange(self.base, dtype=np.uint32), expand(np.arange(len(self.rules)) + self.base, self.rules, self.base)))
        begins = np.concatenate((np.arange(self.base), self.base + np.cumsum(self.lengths) - self.lengths))
        sizes = self.sizes()
        ends = np.cumsum(sizes)
        return flat[np.repeat(begins[self.symbols] - ends + sizes, sizes) + np.arange(self.n_tokens)]

    def ids_between(self, first: int, last: int) -> np.ndarray:
        """Ids first .. last - 1 of the shard; only the symbols that hold them are expanded."""
        sizes = self.sizes()
        ends = np.cumsum(sizes)
        a, b = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last, "left")) + 1
        if first >= last or a >= len(ends):
            return np.zeros(0, np.uint32)
        skipped = int(ends[a] - sizes[a])
        return expand(self.symbols[a:b], self.rules, self.base)[first - skipped : last - skipped]

    def document(self, k: int) -> np.ndarray:
        """Ids of the shard's document k, end id included."""
        before = int(self.counts[:k].sum())
        return self.ids_between(before, before + int(self.counts[k]))


def in_order(docs: DataFrame) -> DataFrame:
    """doc_id and text, dealt by ranges and sorted inside them."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_place", F.monotonically_increasing_id())
    keys = ["doc_id", "_hash", "_place"]
    return rows.repartitionByRange(parallel(spark), *keys).sortWithinPartitions(*keys).select("doc_id", "text", F.spark_partition_id().alias("part"))


def token_shards(docs: DataFrame, vocabulary: str, end: int = END, shard: int = SHARD) -> DataFrame:
    """One row for each shard, documents in ascending order of (part, shard, place in it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(vocabulary)
        base = max(len(encoder.ends), end + 1)
        ids: list = []
        tokens: list = []
        part = number = first = held = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, tokens, number, first, held
            row = (part, number, first, len(ids), held, shard_image(ids, tokens, end, base))
            number, first, held, ids, tokens = number + 1, first + held, 0, [], []
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "shard", "first", "n_docs", "n_tokens", "image"])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            if len(keys):
                part = batch.column(2)[0].as_py()
            _, offsets = text_bytes(batch.column(1))
            for a, b, _, _ in steps(np.zeros(0, np.uint8), offsets, STEP):
                texts = [t or "" for t in batch.column(1).slice(a, b - a).to_pylist()]
                for key, own in zip(keys[a:b], encoder.encode(texts), strict=True):
                    if ids and held + len(own) + 1 > shard:
                        yield close()
                    ids.append(key)
                    tokens.append(own)
                    held += len(own) + 1
        if ids:
            yield close()

    return in_order(docs).mapInArrow(run, FILES)


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end: int = END) -> None:
    token_shards(docs, vocabulary, end).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    `start` counts the ids of all documents before it. One total for each part (a partition of the writing job) goes through the driver.
    """
    files = spark.read.schema(FILES).parquet(path)
    totals = {r[0]: r[1] for r in files.groupBy("part").agg(F.sum("n_tokens")).collect()}
    before, base = 0, {}
    for part in sorted(totals):
        base[part] = before
        before += totals[part]
    bases = spark.sparkContext.broadcast(base)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, image in zip(*(batch.column(i) for i in range(3)), strict=True):
                shard = Shard(image.as_py())
                flat = memoryview(shard.all_ids().astype("<u4")).cast("B")
                stops = np.cumsum(shard.counts)
                starts = stops - shard.counts
                crc = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.ids, pa.int64()), pa.array(starts + first.as_py() + bases.value[part.as_py()]),
                        pa.array(shard.counts), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return files.select("part", "first", "image").mapInArrow(run, TOKENS)


def op12_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = f"{checkpoint_folder(spark)}/token-files-{uuid.uuid4().hex}"
    write_token_files(table(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path)
