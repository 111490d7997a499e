"""Spelling variants: pairs of vocabulary words at one edit, found by search schemes on bidirectional FM-indexes, and the forms they follow.

1. Vocabulary: runs of letters, some with one letter lost (a rule of the run and its document, so repeats of the input agree), counted in the
   tasks and summed by shuffle.
2. Groups: one edit leaves the first three letters of two words of seven letters or more alike, or the last three. Every word goes to the
   group of its first three letters and to that of its last three (there both words are turned round, so one scheme serves both). An anchor
   of more than HOT words is dealt to several groups: each word is in one of these indexes and asks all of them.
3. Search in a group: the text $w1$w2$..$ has an FM-index for either reading direction. Half a word is matched exactly by extending to the
   left, with the interval of the other direction kept in step; from there the search extends to the right, allowing one error. All words of
   a group advance together, a letter at a time. Children of an interval are listed once for all words that share it. An edit has one
   canonical place (an inserted letter differs from the next one, as does a deleted letter), so a near word is met once. What the first
   half's edit makes is left to one of the two groups, so counts add up.
4. Forms: the near word of largest count, kept if it is ten times the word's; roots by pointer jumping (a form's count grows tenfold, so
   chains are short).

Defined cases: null and empty texts have no runs; a null id counts as empty text before the colon; only A-Z is lowered; ties go to the
smaller word in code-point order; repeated rows count each; words of any length are handled; an empty table gives no rows; further columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm.common import cut_lineage, parallel, table

SHORTEST, FEWEST, LARGER, LOSES = 7, 2, 10, 31
ANCHOR = 3
#: Words that a group is meant to hold, and from which an anchor is dealt to several.
GROUP, HOT = 50_000, 100_000
#: Distinct words that a task keeps before it hands its counts on; words that search together.
KEPT, TOGETHER = 1 << 20, 20_000
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % SHORTEST)
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}

#: Codes in code-point order: 0 ends the text, 1 is the sign between words, letters follow.
END, SIGN, CODES = 0, 1, 2 + 26 + 64
CODE = np.zeros(256, np.uint8)
CODE[0x61:0x7B] = np.arange(2, 28)
CODE[0xC0:] = np.arange(28, CODES)
BLOCK = 64


def kept_word(doc_id: int | None, run: str, crc: int | None = None) -> str:
    """The run, or what is left of it where its hash says that it lost a letter."""
    crc = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) if crc is None else crc
    if crc % LOSES:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n of all words of SHORTEST letters that occur FEWEST times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for own, n in Counter(RUN.findall((text.as_py() or "").translate(UPPER))).items():
                    crc = zlib.crc32(own.encode(), start)
                    if crc % LOSES:
                        counts[own] += n
                    elif len(own) > SHORTEST:
                        counts[kept_word(doc_id, own, crc)] += n
                if len(counts) > KEPT:
                    yield pa.RecordBatch.from_pydict({"word": list(counts), "n": pa.array(counts.values(), pa.int64())})
                    counts.clear()
        if counts:
            yield pa.RecordBatch.from_pydict({"word": list(counts), "n": pa.array(counts.values(), pa.int64())})

    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= FEWEST)


def suffix_order(codes: np.ndarray) -> np.ndarray:
    """Suffix array: nine codes at first, then twice as many each time."""
    n = len(codes)
    padded = np.concatenate((codes, np.zeros(9, np.uint8)))
    key = np.zeros(n, np.uint64)
    for j in range(9):
        key = (key << np.uint64(7)) | padded[j : j + n]
    width = 9
    while True:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.append(False, ordered[1:] != ordered[:-1]).astype(np.int64)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if new.sum() == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        behind[: n - width] = rank[width:] + 1 if width < n else 0
        key = (rank * (n + 1) + behind).astype(np.uint64)
        width *= 2


class Direction:
    """FM-index of a text for steps to the left: suffix-rank intervals."""

    def __init__(self, codes: np.ndarray):
        self.n = len(codes)
        order = suffix_order(codes)
        self.last = codes[order - 1]
        pos = np.argsort(self.last, kind="stable")
        self.lf = self.last[pos].astype(np.int64) * self.n + pos
        first = int((codes < SIGN).sum())
        self.first_sign, self.at_sign = first, order[first : first + int((codes == SIGN).sum())]
        blocks = self.n // BLOCK + 1
        self.rows = np.full(blocks * BLOCK, CODES, np.uint8)
        self.rows[: self.n] = self.last
        where = np.arange(self.n) // BLOCK * (CODES + 1) + self.last + 1
        counts = np.bincount(where, minlength=blocks * (CODES + 1)).reshape(blocks, CODES + 1)
        before = np.cumsum(counts, 0) - counts
        self.smaller = np.cumsum(before, 1).astype(np.int32)
        self.rows = self.rows.reshape(blocks, BLOCK)
        # The same sign's place before, for the children of an interval.
        self.previous = np.full(self.n, -1)
        same = np.append(False, self.last[pos][1:] == self.last[pos][:-1])
        self.previous[pos[same]] = pos[np.flatnonzero(same) - 1]

    def step(self, code: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = code.astype(np.int64) * self.n
        return np.searchsorted(self.lf, base + low), np.searchsorted(self.lf, base + high)

    def below(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first `at` signs are smaller than the code."""
        block, rest = at // BLOCK, at % BLOCK
        inside = (self.rows[block] < code[:, None]) & (np.arange(BLOCK) < rest[:, None])
        return self.smaller[block, code] + inside.sum(1)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(interval, code) of every different sign before the suffixes of each interval."""
        sizes = high - low
        owner = np.repeat(np.arange(len(low)), sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]
        new = self.previous[at] < low[owner]
        return owner[new], self.last[at[new]]


class Index:
    """Both directions over the words (a list of code arrays)."""

    def __init__(self, words: list[np.ndarray]):
        lengths = np.array([len(w) for w in words])
        text = np.full(int(lengths.sum()) + len(words) + 1, SIGN, np.uint8)
        inside = np.ones(len(text), bool)
        signs = np.concatenate(([0], np.cumsum(lengths + 1)))
        inside[signs] = False
        if len(words):
            text[inside] = np.concatenate(words)
        self.left = Direction(np.append(text, np.uint8(END)))
        self.right = Direction(np.append(text[::-1], np.uint8(END)))
        # The sign at place p of the turned text closes word number: signs from the front, less one.
        number = np.cumsum(text == SIGN) - 2
        self.word_of = number[len(text) - 1 - self.right.at_sign]

    def near(self, flat: np.ndarray, begins: np.ndarray, lengths: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for all words that differ by one edit behind the query's first `exact` letters."""
        left, right, n = self.left, self.right, len(lengths)
        # The exact part, to the left from its last letter to the sign before it; `turned` is the interval in the other direction.
        low, high = np.zeros(n, np.int64), np.full(n, left.n, np.int64)
        turned = low.copy()
        active = np.arange(n)
        for t in range(int(exact.max(initial=-1)) + 1):
            active = active[(exact[active] >= t) & (high[active] > low[active])]
            if not len(active):
                break
            at = exact[active] - 1 - t
            code = np.where(at < 0, SIGN, flat[begins[active] + np.maximum(at, 0)])
            turned[active] += left.below(code, high[active]) - left.below(code, low[active])
            low[active], high[active] = left.step(code, low[active], high[active])
        query = np.flatnonzero(high > low)
        low, high = turned[query], turned[query] + (high - low)[query]
        # To the right: without an error yet (query, low, high), and with one (also the letter that comes next).
        done_query, done_at = [], []
        wrong = [np.zeros(0, np.int64)] * 4
        t = 0
        while len(query) or len(wrong[0]):
            w_query, w_low, w_high, w_next = wrong
            if len(w_query):
                ends = w_next >= lengths[w_query]
                code = np.where(ends, SIGN, flat[begins[w_query] + np.minimum(w_next, lengths[w_query] - 1)])
                w_low, w_high = right.step(code, w_low, w_high)
                alive = w_high > w_low
                done_query.append(w_query[alive & ends])
                done_at.append(w_low[alive & ends])
                alive &= ~ends
                w_query, w_low, w_high, w_next = w_query[alive], w_low[alive], w_high[alive], w_next[alive] + 1
            parts = [[w_query], [w_low], [w_high], [w_next]]
            if len(query):
                place = exact[query] + t
                ends = place >= lengths[query]
                code = np.where(ends, SIGN, flat[begins[query] + np.minimum(place, lengths[query] - 1)])
                # A lost letter: the next one differs.
                follows = np.where(place + 1 >= lengths[query], SIGN, flat[begins[query] + np.minimum(place + 1, lengths[query] - 1)])
                lost = ~ends & (code != follows)
                # Another or one more letter: children of each different interval, dealt to the words that share it.
                key = low * (right.n + 1) + high
                by = np.argsort(key, kind="stable")
                starts = np.flatnonzero(np.append(True, key[by][1:] != key[by][:-1]))
                owner, child = right.children(low[by[starts]], high[by[starts]])
                letters = child > SIGN
                owner, child = owner[letters], child[letters]
                c_low, c_high = right.step(child, low[by[starts]][owner], high[by[starts]][owner])
                count = np.bincount(owner, minlength=len(starts))
                first = np.cumsum(count) - count
                interval = np.empty(len(by), np.int64)
                interval[by] = np.cumsum(np.append(0, key[by][1:] != key[by][:-1]))
                many = count[interval]
                row = np.repeat(np.arange(len(query)), many)
                at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + first[interval[row]]
                other = child[at] != code[row]
                row, at = row[other], at[other]
                swaps = ~ends[row]
                for rows, lows, highs, after in (
                    (np.flatnonzero(lost), low[lost], high[lost], 1),
                    (row[swaps], c_low[at[swaps]], c_high[at[swaps]], 1),
                    (row, c_low[at], c_high[at], 0),
                ):
                    for part, values in zip(parts, (query[rows], lows, highs, place[rows] + after), strict=True):
                        part.append(values)
                low, high = right.step(code, low, high)
                alive = (high > low) & ~ends
                query, low, high = query[alive], low[alive], high[alive]
            wrong = [np.concatenate(p) for p in parts]
            t += 1
        if not done_query:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(done_query), self.word_of[np.concatenate(done_at) - right.first_sign]


def coded(words: list[str], turned: bool) -> list[np.ndarray]:
    out = [CODE[np.frombuffer(w.encode("latin-1"), np.uint8)] for w in words]
    return [w[::-1] for w in out] if turned else out


def search_group(queries: list[str], held: dict[str, int], turned: bool) -> tuple[list[str], list[int], list[int], list[str]]:
    """Of each query: near words among the held ones (and their n) with an edit behind (turned: only before) the middle, their number, the best."""
    names = sorted(held)
    sizes = np.array([held[w] for w in names], np.int64)
    index = Index(coded(names, turned))
    ends = np.cumsum([len(w) for w in names])
    letters = np.concatenate(coded(names, turned)) if names else np.zeros(0, np.uint8)
    out: tuple[list, list, list, list] = ([], [], [], [])
    for a in range(0, len(queries), TOGETHER):
        some = queries[a : a + TOGETHER]
        codes = coded(some, turned)
        flat, lengths = np.concatenate(codes), np.array([len(w) for w in some])
        begins, halves = np.cumsum(lengths) - lengths, lengths // 2
        exact = lengths - halves if turned else halves
        query, word = index.near(flat, begins, lengths, exact)
        if turned and len(query):
            # Words whose first halves are alike are found in the group of their first letters.
            width = halves[query]
            row = np.repeat(np.arange(len(query)), width)
            back = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width) + 1
            last = begins[query[row]] + lengths[query[row]]
            differs = np.zeros(len(query), bool)
            differs[row[flat[last - back] != letters[ends[word[row]] - back]]] = True
            query, word = query[differs], word[differs]
        by = np.lexsort((word, -sizes[word], query))
        query, word = query[by], word[by]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.zeros(0, np.int64)
        counts = np.diff(np.append(first, len(query)))
        for part, values in zip(out, ([some[i] for i in query[first]], counts.tolist(), sizes[word[first]].tolist(), [names[i] for i in word[first]]), strict=True):
            part.extend(values)
    return out


def near_words(words: DataFrame, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """word, n_near, best (n, word) of every word with near words. `words` (word, n) is read more than once: cut its lineage first."""
    total = words.count()
    groups = max(parallel(words.sparkSession), -(-2 * total // group))
    sides = F.array(
        F.struct(F.lit(False).alias("turned"), F.substring("word", 1, ANCHOR).alias("anchor")),
        F.struct(F.lit(True).alias("turned"), F.expr(f"right(word, {ANCHOR})").alias("anchor")),
    )
    routed = words.select("word", "n", F.explode(sides).alias("_side")).select("word", "n", "_side.*")
    # One row for each anchor of more than `hot` words: 2 * total / hot at most, and never more than there are anchors (2 * 90^3).
    sizes = routed.groupBy("turned", "anchor").count().filter(F.col("count") > hot)
    parts = F.ceil(F.col("count") / hot).cast("int")
    routed = routed.join(F.broadcast(sizes.select("turned", "anchor", parts.alias("parts"))), ["turned", "anchor"], "left")
    own = F.pmod(F.xxhash64("word"), F.coalesce("parts", F.lit(1))).cast("int")
    routed = routed.withColumn("own", own).withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    home = F.pmod(F.xxhash64("turned", "anchor", "part"), F.lit(groups)).cast("int")
    routed = routed.select(home.alias("home"), "turned", "word", "n", (F.col("own") == F.col("part")).alias("held"))

    def run(rows: pa.Table) -> pa.Table:
        found: tuple[list, list, list, list] = ([], [], [], [])
        turned = rows.column("turned").to_numpy(zero_copy_only=False)
        for side in (False, True):
            own = rows.filter(pa.array(turned == side))
            if len(own):
                word, n, held = (own.column(c).to_pylist() for c in ("word", "n", "held"))
                # Parts of one anchor may share a group; a word then asks once.
                index = {w: k for w, k, h in zip(word, n, held, strict=True) if h}
                for part, values in zip(found, search_group(list(dict.fromkeys(word)), index, side), strict=True):
                    part.extend(values)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(v, k) for v, k in zip(found, kinds, strict=True)], names=["word", "n_near", "best_n", "best"])

    found = routed.groupBy("home").applyInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("_best")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best"))


def rooted(forms: DataFrame) -> DataFrame:
    """word, root from (word, form), all forms non-null: pointers jump until none moves."""
    state = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = cut_lineage(state.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        state = moved.select("word", "root")
        if moved.filter("_moved").isEmpty():
            return state


def spelling_variants(docs: DataFrame, group: int = GROUP, hot: int = HOT) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = cut_lineage(vocabulary(docs))
    near = cut_lineage(words.join(near_words(words, group, hot), "word", "left"))
    takes = F.col("best_n") >= LARGER * F.col("n")
    named = near.select(
        "word", F.when(takes, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("best_n")).alias("form_n")
    )
    roots = rooted(named.filter(F.col("form").isNotNull()))
    return named.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))
