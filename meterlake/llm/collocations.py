"""Phrase collocations of each language: contiguous phrases of two to five words, counted by multikey quicksort of suffix pointers.

1. Words: counts of (language, word), summed over all tasks. A word's symbol is a 64-bit hash of language and word; if two of all distinct
   words share a symbol, the pass is repeated with the next seed, so equal symbols are equal words.
2. Suffixes: every place with at least two words before the end of its piece is a suffix, of which five words matter. A task sorts the
   suffixes of about FLUSH words, merges equal ones into one with a count, and routes them by the hash of their leading two words. A
   leading pair (triple, quadruple) that a routing sample of places finds in more than about half a group's share of the text is hot: its
   count is sent on its own, already summed, and its suffixes go by one leading word more. No word, pair or copied passage fills a group.
3. Groups: three-way partitions of the suffix pointers by the word at the current depth, down to five words. The sum of an equal
   partition is the count of its phrase; partitions below the least count are abandoned at once.
4. Scores: counts of the parts are looked up by shuffled joins on the phrases' symbols; score = floor(1000 a n / (l r)) in 38-digit decimals.

The routing sample decides only where a suffix goes, never what is counted. Defined cases: null and empty texts have no words; a null
language is `und`; words are cut at tab and space, pieces at .,;:!? and the line ends 0x0A-0x0D; only A-Z is lowered; repeated rows count
each; an empty table gives no rows; ids play no part, and further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.llm.common import cut_lineage, mix, parallel, table

LEAST, DEPTH, TOP = 100, 5, 2000
UNKNOWN = "und"
#: Words whose suffixes a task sorts and sends at once.
FLUSH = 1 << 20
#: Suffixes that a group is meant to hold.
GROUP = 2_000_000
#: One in so many documents, and of these one in so many places, is looked at for hot leading words; and a prefix is hot from this share of
#: all at most: so there are never more than three times 2^20 hot prefixes, 8 bytes each.
SAMPLED, RAREST_HOT = 16, 1 << 20
#: Words and symbols that a task keeps before it hands its counts on.
KEPT = 1 << 18
#: Byte 0xFF never occurs in UTF-8: it stands for the end of a piece.
CUT = b"\xff"
TABLE = bytearray(range(256))
TABLE[0x41:0x5B] = range(0x61, 0x7B)
TABLE[0x09] = 0x20
for _sign in b".,;:!?\n\x0b\x0c\r":
    TABLE[_sign] = CUT[0]
TABLE = bytes(TABLE)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)]

COUNTS = "lang string, word string, symbol long, n long"
RUNS = "home int, suffixes binary"
PHRASES = "symbols array<long>, a long"


def words_of(text: str) -> list[bytes]:
    """Words with only A-Z lowered; CUT between pieces and at the end."""
    out = text.encode("utf-8", "surrogatepass").translate(TABLE).replace(CUT, b" \xff ").split()
    out.append(CUT)
    return out


def symbol_of(lang: str, word: bytes, seed: int) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(lang.encode() + b"\x00" + word, seed)


def in_languages(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("string").alias("text"))


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """lang, word, symbol and n of every distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}

        def close() -> Iterator[pa.RecordBatch]:
            for lang, own in counts.items():
                own.pop(CUT, None)
                keys = list(own)
                symbols = np.fromiter([symbol_of(lang, w, seed) for w in keys], np.uint64, len(keys)).view(np.int64)
                columns = [pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.binary()).cast(pa.string()), pa.array(symbols), pa.array(list(own.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "word", "symbol", "n"])
            counts.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                counts.setdefault(lang, Counter()).update(words_of(text.as_py() or ""))
                if sum(map(len, counts.values())) > KEPT:
                    yield from close()
        yield from close()

    return in_languages(docs).mapInArrow(run, COUNTS).groupBy("lang", "word", "symbol").agg(F.sum("n").alias("n"))


def distinct_symbols(docs: DataFrame) -> tuple[DataFrame, int]:
    """Word counts, written, and a seed for which no two words share a symbol."""
    seed = 0
    while True:
        counts = cut_lineage(word_counts(docs, seed))
        if counts.groupBy("symbol").count().filter("count > 1").isEmpty():
            return counts, seed
        seed += 1


class Numbers(dict):
    """Word of one language -> number in this task, from 1; the numbers' symbols go to a list that all languages share."""

    def __init__(self, lang: str, seed: int, symbols: list[int]):
        super().__init__({CUT: 0})
        self.lang, self.seed, self.symbols = lang, seed, symbols

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.symbols)
        self.symbols.append(symbol_of(self.lang, word, self.seed))
        return number


def numbered(batches: Iterator[pa.RecordBatch], seed: int, flush: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word numbers of about `flush` words, 0 at ends of pieces; symbol of each number), until the texts are done."""
    symbols, numbers, parts, held = [0], {}, [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = words_of(text.as_py() or "")
            own = numbers.get(lang)
            if own is None:
                own = numbers[lang] = Numbers(lang, seed, symbols)
            parts.append(np.fromiter(map(own.__getitem__, words), np.int32, len(words)))
            held += len(words)
            full = len(symbols) > KEPT
            if held >= flush or full:
                yield np.concatenate(parts), np.array(symbols, np.uint64)
                parts, held = [], 0
                if full:
                    symbols, numbers = [0], {}
    if parts:
        yield np.concatenate(parts), np.array(symbols, np.uint64)


def suffixes(numbers: np.ndarray) -> np.ndarray:
    """DEPTH x places: the words from each place on, 0 from the end of its piece; places with fewer than two words are left out."""
    padded = np.concatenate((numbers, np.zeros(DEPTH, numbers.dtype)))
    n = len(numbers)
    at = np.flatnonzero((padded[:n] > 0) & (padded[1 : n + 1] > 0))
    out = np.empty((DEPTH, len(at)), np.int32)
    alive = np.ones(len(at), bool)
    for d in range(DEPTH):
        out[d] = padded[at + d]
        alive &= out[d] > 0
        out[d][~alive] = 0
    return out


def prefix_hash(places: np.ndarray, symbols: np.ndarray) -> list[np.ndarray]:
    """Hashes of the prefixes of two, three .. words of suffixes (DEPTH x places), from the symbols of their words."""
    out, so_far = [], symbols[places[0]] * ODD[0]
    for d in range(1, len(places)):
        so_far = mix(so_far + symbols[places[d]] * ODD[d])
        out.append(so_far)
    return out


def merged(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, and how often each occurs."""
    keys = list(places)
    bits = int(places.max(initial=1)).bit_length()
    if 3 * bits <= 64:  # three words to a key
        keys = []
        for first, last in ((0, 3), (3, DEPTH)):
            key = places[first].astype(np.uint64)
            for column in places[first + 1 : last]:
                key = (key << np.uint64(bits)) | column.astype(np.uint64)
            keys.append(key)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        own = key[order]
        new[1:] |= own[1:] != own[:-1]
    at = np.flatnonzero(new)
    return places[:, order[at]], np.diff(np.append(at, len(order)))


def routed(places: np.ndarray, counts: np.ndarray, symbols: np.ndarray, hot: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Suffixes with the hash that they go by, and the shortest phrase that they count for.

    A suffix goes by its shortest prefix that is not hot, and counts for phrases of that length or more. A hot prefix goes as a suffix of its
    own, with the sum of all that begin with it, and counts for that phrase alone. `places` are in order, so a prefix is a run.
    """
    hashes = prefix_hash(places, symbols)
    home, least = hashes[0].copy(), np.full(places.shape[1], 2, np.uint8)
    extra = []
    open_ = np.ones(places.shape[1], bool)
    for d, heavy in enumerate(hot, 2):
        if not len(heavy):
            break
        open_ &= (places[d - 1] > 0) & np.isin(hashes[d - 2], heavy)
        at = np.flatnonzero(open_)
        if not len(at):
            break
        begins = np.flatnonzero(np.append(True, (places[:d, at[1:]] != places[:d, at[:-1]]).any(0)))
        short = places[:, at[begins]].copy()
        short[d:] = 0
        extra.append((short, np.add.reduceat(counts[at], begins), hashes[d - 2][at[begins]], np.full(len(begins), d, np.uint8)))
        home[at], least[at] = hashes[d - 1][at], d + 1
    # A suffix that is over before a prefix of it is not hot has been counted with its hot prefixes.
    keep = np.ones(places.shape[1], bool)
    deep = np.flatnonzero(least > 2)
    keep[deep] = places[least[deep] - 1, deep] > 0
    parts = [(places[:, keep], counts[keep], home[keep], least[keep]), *extra]
    return tuple(np.concatenate(p, axis=-1) for p in zip(*parts, strict=True))


def packed(places: np.ndarray, counts: np.ndarray, least: np.ndarray, symbols: np.ndarray) -> bytes:
    """Suffixes as one row: the symbols in use, then columns of numbers into them, counts, lengths."""
    import zstandard

    used = np.flatnonzero(np.bincount(places.ravel(), minlength=1))
    used = used[used > 0]
    number = np.zeros(int(used[-1]) + 1, np.uint32)
    number[used] = np.arange(1, len(used) + 1)
    codes = number[places].astype(np.uint16 if len(used) < 1 << 16 else np.uint32)
    parts = (np.array([len(used), places.shape[1], codes.itemsize], "<i8"), symbols[used], codes, counts.astype("<u4"), least)
    return zstandard.ZstdCompressor(1).compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts))


def unpacked(image: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (rising numbers from 1), suffixes, counts, lengths."""
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(image)
    used, n, size = np.frombuffer(data, "<i8", 3)
    symbols = np.frombuffer(data, np.uint64, used, 24)
    at = 24 + 8 * used
    codes = np.frombuffer(data, np.uint16 if size == 2 else np.uint32, DEPTH * n, at).reshape(DEPTH, n)
    at += DEPTH * n * size
    return symbols, codes, np.frombuffer(data, "<u4", n, at).astype(np.int64), np.frombuffer(data, np.uint8, n, at + 4 * n)


def hot_prefixes(docs: DataFrame, seed: int, total: int, groups: int, sampled: int = SAMPLED) -> list[np.ndarray]:
    """Sorted hashes of the prefixes of two, three and four words that would take more than half a group's share; sampled places only."""
    floor = max(total / groups / 2, total / RAREST_HOT) / sampled**2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, symbols in numbered(batches, seed, FLUSH):
            places = suffixes(numbers)[:, ::sampled]
            hashes = prefix_hash(places, symbols)
            for d in range(2, DEPTH):
                own = np.sort(hashes[d - 2][places[d - 1] > 0])
                if not len(own):
                    continue
                at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                n = np.diff(np.append(at, len(own)))
                columns = [pa.array(np.full(len(at), d, np.int32)), pa.array(own[at].view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, names=["depth", "prefix", "n"])

    rows = in_languages(docs).sample(1 / sampled, seed=1).mapInArrow(run, "depth int, prefix long, n long").groupBy("depth", "prefix").agg(F.sum("n").alias("n"))
    found = rows.filter(F.col("n") >= floor).select("depth", "prefix").collect()
    return [np.sort(np.array([r[1] for r in found if r[0] == d], np.int64).view(np.uint64)) for d in range(2, DEPTH)]


def suffix_runs(docs: DataFrame, seed: int, groups: int, hot: list[np.ndarray], flush: int = FLUSH) -> DataFrame:
    """home, suffixes: a task's merged suffixes of a stretch of text, one row for each group that they go to."""
    hot_sets = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for numbers, symbols in numbered(batches, seed, flush):
            places = suffixes(numbers)
            if not places.shape[1]:
                continue
            places, counts, home, least = routed(*merged(places), symbols, hot_sets.value)
            home = (home % np.uint64(groups)).astype(np.int32)
            order = np.argsort(home, kind="stable")
            ordered = home[order]
            begins = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            rows = [packed(places[:, o], counts[o], least[o], symbols) for o in np.split(order, begins[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ordered[begins]), pa.array(rows, pa.binary())], names=["home", "suffixes"])

    return in_languages(docs).mapInArrow(run, RUNS)


def quicksort_counts(places: np.ndarray, counts: np.ndarray, least: np.ndarray, floor: int) -> Iterator[tuple[int, int, int]]:
    """(any pointer to it, length, count) of every phrase of two words or more with at least `floor` occurrences."""
    work = [(np.arange(places.shape[1]), 0)]
    while work:
        pointers, depth = work.pop()
        if len(pointers) < floor and counts[pointers].sum() < floor:
            continue
        words = places[depth][pointers]
        sample = np.sort(words[:: max(1, len(words) // 31)])
        pivot = sample[len(sample) // 2]
        below, above = words < pivot, words > pivot
        equal = pointers[~(below | above)]
        for side in (pointers[below], pointers[above]):
            if len(side):
                work.append((side, depth))
        if not pivot:
            continue
        length = depth + 1
        own = counts[equal]
        if own.sum() < floor:
            continue
        if length > 1:
            a = int(own[least[equal] <= length].sum())
            if a >= floor:
                yield int(equal[0]), length, a
        if length < DEPTH:
            work.append((equal, length))


def frequent_phrases(runs: DataFrame, floor: int = LEAST) -> DataFrame:
    """symbols, a of every phrase of two to five words that occurs `floor` times."""

    def run(rows: pa.Table) -> pa.Table:
        blocks = [unpacked(v.as_py()) for v in rows.column("suffixes")]
        symbols = np.sort(np.concatenate([b[0] for b in blocks]))
        symbols = symbols[np.append(True, symbols[1:] != symbols[:-1])]
        place = [np.append(0, np.searchsorted(symbols, b[0]) + 1).astype(np.int32) for b in blocks]
        places = np.concatenate([p[b[1]] for p, b in zip(place, blocks, strict=True)], axis=1)
        counts, least = np.concatenate([b[2] for b in blocks]), np.concatenate([b[3] for b in blocks])
        names = np.append(np.uint64(0), symbols).view(np.int64)
        del blocks, place
        found = list(quicksort_counts(places, counts, least, floor))
        phrases = [names[places[:length, at]].tolist() for at, length, _ in found]
        return pa.table([pa.array(phrases, pa.list_(pa.int64())), pa.array([a for *_, a in found], pa.int64())], names=["symbols", "a"])

    return runs.groupBy("home").applyInArrow(run, PHRASES)


def scored(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases that no longer one stands for. `phrases` and `words` are read more than once."""
    size = F.size("symbols")
    known = phrases.unionByName(words.select(F.array("symbol").alias("symbols"), F.col("n").alias("a")))
    known = known.select(F.col("symbols").alias("part"), F.col("a").alias("f"))
    cuts = phrases.select("symbols", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    sides = F.array(
        F.struct(F.lit(True).alias("first"), F.slice("symbols", 1, F.col("k")).alias("part")),
        F.struct(F.lit(False).alias("first"), F.slice("symbols", F.col("k") + 1, size - F.col("k")).alias("part")),
    )
    parts = cuts.select("symbols", "a", "k", F.explode(sides).alias("_side")).select("symbols", "a", "k", "_side.*")
    counted = parts.join(known, "part").groupBy("symbols", "a", "k")
    counted = counted.agg(F.max(F.when(F.col("first"), F.col("f"))).alias("l"), F.max(F.when(~F.col("first"), F.col("f"))).alias("r"))
    # A phrase inside a longer one that occurs as often is inside one that is longer by one word and occurs as often.
    inner = F.explode(F.array(F.slice("symbols", 1, size - 1), F.slice("symbols", 2, size - 1)))
    longer = phrases.filter(size > 2).select(inner.alias("symbols"), F.col("a").alias("longer")).groupBy("symbols").agg(F.max("longer").alias("longer"))
    covered = longer.join(phrases, "symbols").filter(100 * F.col("longer") >= 100 * F.col("a")).select("symbols")
    named = phrases.join(covered, "symbols", "left_anti").select("symbols", F.posexplode("symbols").alias("_at", "symbol"))
    named = named.join(words.select("symbol", "lang", "word"), "symbol").groupBy("symbols")
    named = named.agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_words"))
    named = named.select("symbols", "lang", F.array_join(F.col("_words.word"), " ").alias("phrase"))
    whole = named.join(counted, "symbols").join(words.groupBy("lang").agg(F.max("total").alias("n")), "lang")
    wide = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    top, under = (F.lit(1000).cast("decimal(4,0)") * wide["a"]).cast("decimal(22,0)") * wide["n"], wide["l"] * wide["r"]
    whole = whole.withColumns({"_top": top.cast("decimal(38,0)"), "_under": under.cast("decimal(38,0)")}).withColumn("score", F.expr("_top div _under"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("_cut")
    return whole.groupBy("lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "_cut.l", "_cut.r", "n", "_cut.score")


def collocations(docs: DataFrame, floor: int = LEAST, top: int = TOP, group: int = GROUP, flush: int = FLUSH) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    spark = docs.sparkSession
    counts, seed = distinct_symbols(docs)
    words = cut_lineage(counts.filter(F.col("n") >= floor).join(counts.groupBy("lang").agg(F.sum("n").alias("total")), "lang"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    groups = max(parallel(spark), -(-total // group))
    hot = hot_prefixes(docs, seed, total, groups)
    phrases = cut_lineage(frequent_phrases(suffix_runs(docs, seed, groups, hot, flush), floor))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored(phrases, words).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
