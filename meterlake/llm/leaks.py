"""Benchmark decontamination: seeds that no copy can be without, then local alignment.

Words are runs of letters and digits in lower case. Items are aligned with documents word by word (Smith-Waterman: match +2, mismatch and
gap -1), so edited copies with changed, dropped or added words are scored too; a match's score is the share of the item's own score. An
item of LONG words or more is found at the share `leak`; the share rises to 1 for items of SURE words or fewer, and LEAST_WORDS words must
match. An item of fewer words is no evidence inside a text and is found only where it is the whole document.

Seeds are exact. Let an alignment of a score of T or more have m matched words and e edits: 2 m - e >= T, and the edits cut the matches
into e + 1 runs at most, so T - m - 1 or more adjacent pairs of the item's words stand in it. With m <= T - 2 that is one pair at least:
every pair of an item is a seed. Beyond that all but L - T + 1 of the item's L words match: its L - T + 2 words that are rarest in the
corpus are seeds. Of the documents with a seed only those are aligned that hold enough of the item's words and pairs to reach T.

The benchmark is sent to the tasks in blocks of at most BLOCK_BYTES, and documents are read once more for every block; documents are
never shuffled, so neither copies nor hot sources matter.

Defined cases: null and empty texts match nothing, nor do items without a word; items with the same text each match; repeated rows each get their row; an empty benchmark finds nothing; extra columns stay.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import SIGNS, ngrams, steps, table, text_bytes, words

LEAK = 0.5
#: Items of LONG words are found at LEAK, those of SURE words or fewer only whole, in between the share falls evenly.
SURE, LONG = 8, 15
#: So many words must match; shorter items count only as whole documents.
LEAST_WORDS = 6
MATCH, MISS, GAP = 2, -1, -1
BLOCK_BYTES = 16 << 20
#: Hits of seeds, and words looked up, that are in memory at once.
HITS = 1 << 20
HIT = "array<struct<item_id:long,score:double,start:int,end:int>>"


def least_score(length: int, leak: float = LEAK) -> int:
    """The score from which an alignment with an item of `length` words counts."""
    fall = min(max((length - SURE) / (LONG - SURE), 0), 1)
    return max(math.ceil(MATCH * length * (1 - (1 - leak) * fall) - 1e-9), MATCH * LEAST_WORDS)


def item_codes(texts: list[str | None]) -> list[np.ndarray]:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    codes, _, _, ranges = words(data, offsets, SIGNS)
    return [codes[a:b] for a, b in zip(ranges[:-1], ranges[1:], strict=True)]


def found_at(codes: np.ndarray, n: int, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams of `codes` are among the sorted `sought`: positions, and which."""
    grams = ngrams(codes, n)
    if not len(grams) or not len(sought):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A bitmap over 16 bits of the hash turns most of them away before the search.
    likely = np.zeros(1 << 16, bool)
    likely[(sought >> np.uint64(48)).astype(np.int64)] = True
    at = np.flatnonzero(likely[(grams >> np.uint64(48)).astype(np.int64)])
    which = np.minimum(np.searchsorted(sought, grams[at]), len(sought) - 1)
    same = sought[which] == grams[at]
    return at[same], which[same]


def corpus_counts(docs: DataFrame, sought: dict[int, np.ndarray], text: str = "text") -> dict[int, np.ndarray]:
    """Occurrences in all documents of the sorted n-grams in `sought`, by n."""
    shared = docs.sparkSession.sparkContext.broadcast(sought)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        sums = {n: np.zeros(len(grams), np.int64) for n, grams in own.items()}
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for _, _, part, ends in steps(data, offsets):
                codes, _, _, ranges = words(part, ends, SIGNS)
                owner = np.repeat(np.arange(len(ends) - 1), np.diff(ranges))
                for n, grams in own.items():
                    at, which = found_at(codes, n, grams)
                    sums[n] += np.bincount(which[owner[at] == owner[at + n - 1]], minlength=len(grams))
        for n, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([n] * len(at), pa.int32()), pa.array(at.astype(np.int32)), pa.array(total[at])], names=["n", "gram", "times"]
            )

    counted = docs.select(F.lower(text)).mapInArrow(run, "n int, gram int, times long").groupBy("n", "gram").agg(F.sum("times").alias("times"))
    out = {n: np.zeros(len(grams), np.int64) for n, grams in sought.items()}
    for n, gram, times in counted.collect():  # as many rows as the block has n-grams, at most
        out[n][gram] = times
    return out


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman: best score, and where in `window` that alignment ends (exclusive)."""
    slope = GAP * np.arange(len(window) + 1)
    above, score, end = np.zeros(len(window) + 1, np.int64), 0, 0
    for code in item:
        row = np.zeros(len(window) + 1, np.int64)
        row[1:] = np.maximum(np.maximum(above[:-1] + np.where(window == code, MATCH, MISS), above[1:] + GAP), 0)
        row = np.maximum.accumulate(row - slope) + slope
        at = int(row.argmax())
        if row[at] > score:
            score, end = int(row[at]), at
        above = row
    return score, end


def spread(first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every list in `which` (lists laid end to end, from `first`): the place in `which`, and the places of its members."""
    counts = np.diff(first)[which]
    owner = np.repeat(np.arange(len(which)), counts)
    return owner, np.arange(len(owner)) + np.repeat(first[which] - np.cumsum(counts) + counts, counts)


@dataclass
class Seeds:
    """The n-grams that are sought, sorted, and laid end to end the items and places of each."""

    n: int
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray


def seeds_of(n: int, grams: list[np.ndarray], items: list[int], places: list[np.ndarray]) -> Seeds:
    whole = np.concatenate([np.zeros(0, np.uint64), *grams])
    order = np.argsort(whole, kind="stable")
    keys, first = np.unique(whole[order], return_index=True)
    item = np.repeat(np.array(items, np.int64), [len(g) for g in grams])
    place = np.concatenate([np.zeros(0, np.int64), *places])
    return Seeds(n, keys, np.append(first, len(whole)), item[order], place[order])


def parts(weights: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of entries whose weights sum to `limit` at most, or single entries."""
    sums, first = np.concatenate(([0], np.cumsum(weights))), 0
    while first < len(weights):
        last = max(first + 1, int(np.searchsorted(sums, sums[first] + limit, "right")) - 1)
        yield first, last
        first = last


@dataclass
class Block:
    """A block of items as the tasks need it."""

    ids: list
    codes: list[np.ndarray]
    least: np.ndarray
    pairs: Seeds
    rare: Seeds
    vocabulary: np.ndarray  # sorted hashes of all words of the items
    first: np.ndarray  # of each item, where its words begin in `own`
    own: np.ndarray  # numbers of the words
    short: dict[bytes, list[int]]

    def candidates(self, codes: np.ndarray, ranges: np.ndarray) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
        """Document, item, and the stretches of the document that may hold the item."""
        n_docs, n_items = len(ranges) - 1, len(self.codes)
        owner = np.repeat(np.arange(n_docs), np.diff(ranges))
        hits = []
        for seeds in (self.pairs, self.rare):
            at, which = found_at(codes, seeds.n, seeds.keys)
            inside = owner[at] == owner[at + seeds.n - 1]
            hits.append((at[inside], which[inside]))
        weights = sum(np.bincount(owner[at], np.diff(s.first)[which], n_docs) for s, (at, which) in zip((self.pairs, self.rare), hits, strict=True))
        at, which = found_at(codes, 1, self.vocabulary)
        held = np.unique(owner[at] * len(self.vocabulary) + which)
        numbers = np.full(len(codes), len(self.vocabulary))
        numbers[at] = which
        for a, b in parts(weights, HITS):
            places, items, words_at, paired = [], [], [], []
            for seeds, (at, which) in zip((self.pairs, self.rare), hits, strict=True):
                some = slice(*np.searchsorted(at, (ranges[a], ranges[b])))
                entry, member = spread(seeds.first, which[some])
                words_at.append(at[some][entry])
                items.append(seeds.item[member])
                places.append(seeds.place[member])
                paired.append(np.full(len(entry), seeds.n > 1))
            word, item, place, pair = (np.concatenate(x) for x in (words_at, items, places, paired))
            keys, back = np.unique(owner[word] * n_items + item, return_inverse=True)
            if not len(keys):
                continue
            found = np.zeros(len(keys), np.int64)
            for first, last in parts(np.diff(self.first)[keys % n_items], HITS):
                entry, member = spread(self.first, keys[first:last] % n_items)
                sought = (keys[first:last] // n_items)[entry] * len(self.vocabulary) + self.own[member]
                near = np.minimum(np.searchsorted(held, sought), len(held) - 1)
                found[first:last] = np.bincount(entry[held[near] == sought], minlength=last - first)
            least = self.least[keys % n_items]
            enough = (MATCH * found >= least) & (found + np.bincount(back[pair], minlength=len(keys)) >= least - 1)
            chosen = np.flatnonzero(enough[back])
            chosen = chosen[np.argsort(back[chosen], kind="stable")]
            cuts = np.flatnonzero(np.diff(back[chosen])) + 1
            for own in np.split(chosen, cuts) if len(chosen) else ():
                doc, one = int(keys[back[own[0]]] // n_items), int(item[own[0]])
                some = self.stretches(numbers[ranges[doc] : ranges[doc + 1]], one, word[own] - ranges[doc], place[own], pair[own])
                if some:
                    yield doc, one, some

    def stretches(self, numbers: np.ndarray, item: int, at: np.ndarray, place: np.ndarray, pair: np.ndarray) -> list[tuple[int, int]]:
        """Stretches of a document that the item may cover, from seeds at words `at` and at `place` in the item.

        An alignment has 2 L - T edits at most, so it lies that near to where its seeds put the item. m matched words and T - m - 1
        pairs of them are in there, or m > T - 2 words."""
        length, least = len(self.codes[item]), int(self.least[item])
        slack = max(0, MATCH * length - least)
        begins = np.unique(at - place)
        begin, stop = np.maximum(begins - slack, 0), np.minimum(begins + length + slack, len(numbers))
        words_of, times = np.unique(self.own[self.first[item] : self.first[item + 1]], return_counts=True)
        near = np.minimum(np.searchsorted(words_of, numbers), len(words_of) - 1)
        where = np.flatnonzero(words_of[near] == numbers)
        near, cut = near[where], np.searchsorted(where, (begin, stop))
        merged: list[tuple[int, int]] = []
        for a, b, first, last in zip(begin.tolist(), stop.tolist(), *cut.tolist(), strict=True):
            if MATCH * (last - first) < least:
                continue
            words_in = int(np.minimum(np.bincount(near[first:last], minlength=len(times)), times).sum())
            if MATCH * words_in < least:
                continue
            pairs_in = len(set(place[pair & (at >= a) & (at < b)].tolist()))
            if words_in + pairs_in < least - 1:
                continue
            if merged and a <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
            else:
                merged.append((a, b))
        return merged


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", leak: float = LEAK) -> DataFrame:
    """Adds `leaks`: (item_id, score, start, end in words) of every benchmark item that the document holds at `leak` or more."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).head()[0]
    blocks = max(1, -(-size // BLOCK_BYTES))
    names = [n for n in docs.columns if n not in ("leaks", "_words")]
    out = docs.select(*names, F.lower(text).alias("_words"), F.array().cast(HIT).alias("leaks"))
    for block in range(blocks):
        items = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", F.lower("text")).collect()
        out = add_leaks(out, docs, items, text, leak)
    return out.drop("_words")


def block_of(docs: DataFrame, items: list, text: str, leak: float) -> Block | None:
    codes = item_codes([r[1] for r in items])
    short: dict[bytes, list[int]] = defaultdict(list)
    for i, own in enumerate(codes):
        if 0 < len(own) < LEAST_WORDS:
            short[own.tobytes()].append(i)
    long = [i for i, own in enumerate(codes) if len(own) >= LEAST_WORDS]
    if not long and not short:
        return None
    single = {i: ngrams(codes[i], 1) for i in long}
    vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *single.values()]))
    numbers = [np.searchsorted(vocabulary, single[i]) if i in single else np.zeros(0, np.int64) for i in range(len(codes))]
    least = np.array([least_score(len(own), leak) for own in codes], np.int64)
    times = corpus_counts(docs, {1: vocabulary}, text)[1] if long else np.zeros(0, np.int64)
    rare = [np.argsort(times[numbers[i]], kind="stable")[: max(0, len(codes[i]) - int(least[i]) + 2)] for i in long]
    pairs = seeds_of(2, [ngrams(codes[i], 2) for i in long], long, [np.arange(len(codes[i]) - 1) for i in long])
    words_of = seeds_of(1, [single[i][r] for i, r in zip(long, rare, strict=True)], long, rare)
    first = np.concatenate(([0], np.cumsum([len(x) for x in numbers])))
    return Block([r[0] for r in items], codes, least, pairs, words_of, vocabulary, first, np.concatenate(numbers), dict(short))


def add_leaks(out: DataFrame, docs: DataFrame, items: list, text: str, leak: float) -> DataFrame:
    """Appends to `leaks` the matches of one block of items."""
    block = block_of(docs, items, text, leak)
    if block is None:
        return out
    shared = docs.sparkSession.sparkContext.broadcast(vars(block) | {"pairs": vars(block.pairs), "rare": vars(block.rare)})
    hit = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]))
    names, schema = out.columns, out.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        own_block = Block(**held | {k: Seeds(**held[k]) for k in ("pairs", "rare")})
        for batch in batches:
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            data, offsets = text_bytes(batch.column(len(names) - 2))
            for first, last, part, ends in steps(data, offsets):
                words_of, _, _, ranges = words(part, ends, SIGNS)
                for doc in np.flatnonzero(np.diff(ranges) < LEAST_WORDS).tolist() if own_block.short else ():
                    n = int(ranges[doc + 1] - ranges[doc])
                    for item in own_block.short.get(words_of[ranges[doc] : ranges[doc + 1]].tobytes(), ()):
                        hits[first + doc].append({"item_id": own_block.ids[item], "score": 1.0, "start": 0, "end": n})
                for doc, item, some in own_block.candidates(words_of, ranges):
                    begin, own, least = ranges[doc], own_block.codes[item], int(own_block.least[item])
                    best = (0, 0)
                    for a, b in some:
                        window = words_of[begin + a : begin + b]
                        score, end = align(own, window)
                        best = max(best, (score, a + end))
                    if best[0] >= least:
                        hits[first + doc].append(
                            {"item_id": own_block.ids[item], "score": best[0] / (MATCH * len(own)), "start": max(0, best[1] - len(own)), "end": best[1]}
                        )
            both = [a + b for a, b in zip(batch.column(len(names) - 1).to_pylist(), hits, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(both, hit)], names=names)

    return out.mapInArrow(run, schema)


def op7_decontamination(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, folder, "benchmark"))
    top = F.array_max(F.transform("leaks", lambda x: F.struct(x["score"], (-x["item_id"]).alias("item"))))
    return found.select(
        "doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size("leaks").cast("long").alias("n_items"),
        (-top["item"]).alias("item_id"), top["score"].alias("score"), F.array_sort(F.transform("leaks", lambda x: x["item_id"])).alias("item_ids"),
    )
