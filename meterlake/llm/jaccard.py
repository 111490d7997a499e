"""Exact Jaccard join of shingle sets in their metric space, and the groups of linked documents.

The Jaccard distance is a metric, but distances between unrelated documents are all 1, so pivots drawn from the documents divide nothing.
The pivots are therefore fixed points of the space of sets, in four levels of recursion, all exact:

1. The corpus as a pivot. A set that links to another one shares num / den of its shingles with it, so with the rest of the corpus. Tasks
   send shortened hashes of shingles to buckets, which tell how many of a set's shingles occur elsewhere too; sets with too few are done.
   Shortened hashes can only say "elsewhere too" once too often. A shingle of several sets of a task is sent once, so a line that a third
   of all documents hold stays small.
2. Rings around the empty set. For linked sets A and B the symmetric difference is at most (den - num) / (den + num) of |A| + |B|, and by
   the triangle inequality their sizes differ by no more. Ring i holds a stretch of sizes whose partners lie in ring i or i + 1; a document
   is replicated to the window below its own.
3. Cells of a ring. Shingles are dealt by hash to more cells than the ring's linked pairs can differ in, so linked sets agree on whole
   cells; sets that agree on a cell are at distance 0 from the same projected pivot and share its region. A cell without shingles counts
   only for sets with so many empty cells that linked sets might agree on those alone. Neighbours in the regions are chained, and the
   chains' components are the candidates.
4. Within a component (in blocks of pairs where it is large), real pivots: a pivot's distances to all that hold one of its rarest shingles
   are computed (no other is within twice the link distance); those within the link distance join its group; those beyond twice that
   cannot link to the group; the ring between is compared with the group's members, and all outside the group go on to the next pivot.

Copies (equal sets) are one representative throughout. Sets are compared by 64-bit hashes of their shingles; words are runs of bytes
other than white space, A-Z lowered. A row is known by its id and the SHA-256 of its text, so rows without an id or with the same one are
rows of their own everywhere.

Defined cases: null, empty and blank texts have the empty set and are linked with nothing; fewer words than a shingle has are one shingle;
rows of one id are rows of their own, linked if their texts are; a null id never names a group; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import cut_lineage, mix, ngrams, parallel, release, steps, table, text_bytes, words

STEP = 2 << 20
#: Shingles that a task sends to the buckets at once.
SENT_AT_ONCE = 1_000_000
#: Shingles of the representatives that one task compares at once.
BLOCK_SHINGLES = 3_000_000


#: How often shingles are dealt to cells anew at most, where a candidate group is larger than that.
DEALT_ANEW = 4


#: Stands for a null id inside.
NO_ID = -(2**63)


@dataclass(frozen=True)
class Link:
    """Sets of `words`-word shingles link when den * |A and B| >= num * |A or B|; the similarity is above one half."""

    words: int = 4
    num: int = 85
    den: int = 100

    def __post_init__(self) -> None:
        if not self.den < 2 * self.num <= 2 * self.den:
            raise ValueError("the similarity must be above one half and at most one")

    def apart(self, a: int, b: int) -> int:
        """Most elements that only one of two linked sets of these sizes can have."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def rings(self, size: int) -> list[int]:
        """Smallest sizes of the rings, up to the one that holds `size`; partners lie in the same ring or the next."""
        edges = [1]
        while edges[-1] <= size:
            edges.append(edges[-1] * self.den // self.num + 1)
        return edges

    def cells(self, edge: int, beyond: int) -> tuple[int, int]:
        """For pairs whose smaller set lies in [edge, beyond): how much they differ at most, and the number of cells."""
        largest = beyond - 1
        most = self.apart(largest, largest * self.den // self.num)
        return most, most + 1 + max(1, most // 20) if most else 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    codes, _, _, ranges = words(data, offsets)
    grams = ngrams(codes, n)
    out = []
    for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        else:
            out.append(ngrams(codes[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def print_of(shingles: np.ndarray) -> bytes:
    """16 bytes that stand for a set."""
    if not len(shingles):
        return b""
    sums = [np.add.reduce(mix(shingles ^ np.uint64(s))) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    return (np.array(sums, np.uint64) + np.uint64(len(shingles))).tobytes()


def signatures(shingles: np.ndarray, link: Link, edges: list[int]) -> np.ndarray:
    """Regions of a set: one value per cell of its ring and of the ring below."""
    size = len(shingles)
    if not size:
        return np.zeros(0, np.uint64)
    while edges[-1] <= size:
        edges.append(edges[-1] * link.den // link.num + 1)
    ring = int(np.searchsorted(edges, size, "right")) - 1
    out = []
    for i in {ring, ring - 1} - {-1}:
        most, cells = link.cells(edges[i], edges[i + 1])
        if not most:
            continue  # only equal sets can link here
        cell = ((mix(shingles + np.uint64(2 * i + 1)) >> np.uint64(32)) % np.uint64(cells)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        used = cell[order]
        first = np.flatnonzero(np.concatenate(([True], used[1:] != used[:-1])))
        content = np.add.reduceat(mix(shingles[order] ^ np.uint64(0xA0761D6478BD642F)), first)
        own = used[first]
        if cells - len(own) >= cells - most:  # so many empty cells that a linked set may agree on these alone
            own = np.concatenate((own, np.setdiff1d(np.arange(cells), own)))
            content = np.concatenate((content, np.zeros(cells - len(content), np.uint64)))
        out.append(mix(content + mix(own.astype(np.uint64) + np.uint64(i << 40))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def row_keys(docs: DataFrame) -> DataFrame:
    """doc_id, sha, text: the id (NO_ID for null) and the SHA-256 of the text tell rows apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("sha"), text.alias("text"))


PRINTS = "doc_id long, sha binary, n_shingles long, print binary, tag long"


def prints_of(rows: DataFrame, link: Link) -> DataFrame:
    """Size, print and tag (the print's first bytes) of the set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            for first, last, part, own in steps(data, offsets, STEP):
                sets = shingle_sets(part, own, link.words)
                prints = [print_of(s) for s in sets]
                keys = [batch.column(i).slice(first, last - first) for i in (0, 1)]
                tags = [int.from_bytes(p[:8], "little", signed=True) for p in prints]
                columns = [*keys, pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary()), pa.array(tags, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "sha", "n_shingles", "print", "tag"])

    return rows.mapInArrow(run, PRINTS)


SENT = "bucket int, task long, owners binary, hashes binary, tags binary, known binary"


def gap_bytes(numbers: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending numbers as the gaps between them, a byte each (255: and 255 more), and where each number's bytes end; `first` begins a row anew."""
    gaps = np.diff(numbers, prepend=0)
    gaps[first] = numbers[first]
    ends = np.cumsum(gaps // 255 + 1)
    out = np.full(ends[-1] if len(ends) else 0, 255, np.uint8)
    out[ends - 1] = gaps % 255
    return out, np.append(0, ends)


def from_gaps(row: bytes) -> np.ndarray:
    gaps = np.frombuffer(row, np.uint8)
    return np.cumsum(gaps, dtype=np.int64)[gaps < 255]


def sent_to_buckets(rows: DataFrame, link: Link, buckets: int) -> DataFrame:
    """The shingles of all rows by buckets of their hash: 4 bytes of the hash and about one that tells whose it is.

    Sets have numbers in what a task sends at once, so the bytes of a shingle do not depend on the number of buckets, which grows with the input.
    """

    def flushed(task: int, sets: dict[bytes, np.ndarray]) -> pa.RecordBatch:
        tags = np.frombuffer(b"".join(p[:8] for p in sets), np.int64)
        sizes = np.array([len(s) for s in sets.values()])
        flat = mix(np.concatenate(list(sets.values())))
        owner = np.repeat(np.arange(len(sets), dtype=np.int64), sizes)
        order = np.argsort(flat)
        flat, owner = flat[order], owner[order]
        first = np.append(True, flat[1:] != flat[:-1])
        runs = np.diff(np.append(np.flatnonzero(first), len(flat)))
        known = np.bincount(owner[np.repeat(runs > 1, runs)], minlength=len(sets))
        # What several sets here have goes once and for none of them; the last owner number stands for that.
        flat, owner = flat[first], np.where(runs > 1, len(sets), owner[first])
        bucket = ((flat >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((owner, bucket))
        flat, owner, bucket = flat[order].astype("<u4"), owner[order], bucket[order]
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        homes = bucket[starts]
        some = owner < len(sets)
        named, place = owner[some], bucket[some]
        gaps, ends = gap_bytes(named, np.append(True, place[1:] != place[:-1])[: len(place)])
        low, high = (ends[np.searchsorted(place, homes, side)].tolist() for side in ("left", "right"))
        edges = np.append(starts, len(flat)).tolist()
        owners = [gaps[a:b].tobytes() for a, b in zip(low, high, strict=True)]
        hashes = [flat[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
        # The tags and what is known already ride along with the first bucket.
        rest = [b""] * (len(homes) - 1)
        columns = [owners, hashes, [tags.tobytes(), *rest], [known.astype("<i8").tobytes(), *rest]]
        numbers = [pa.array(homes, pa.int32()), pa.array(np.full(len(homes), task, np.int64))]
        return pa.RecordBatch.from_arrays([*numbers, *(pa.array(c, pa.binary()) for c in columns)], names=[x.split()[0] for x in SENT.split(", ")])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        held: dict[bytes, np.ndarray] = {}
        size = 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for _, _, part, own in steps(data, offsets, STEP):
                for s in shingle_sets(part, own, link.words):
                    if len(s) and (key := print_of(s)) not in held:
                        held[key] = s
                        size += len(s)
                if size >= SENT_AT_ONCE:
                    yield flushed(task, held)
                    held, size, task = {}, 0, task + 1
        if held:
            yield flushed(task, held)

    return rows.select("text").mapInArrow(send, SENT)


def supported(rows: DataFrame, link: Link, buckets: int) -> DataFrame:
    """tag, n: at least as many shingles as sets with this tag share with others; a copy in another task counts as another set.

    The buckets answer with about a byte for each shingle that they found elsewhere too, and the answers go back to where sets have numbers.
    """

    def meet(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u4") for x in rows.column("hashes").to_pylist()]
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        runs = np.diff(np.append(np.flatnonzero(np.append(True, flat[order][1:] != flat[order][:-1])), len(flat)))
        shared = np.zeros(len(flat), bool)
        shared[order] = np.repeat(runs > 1, runs)
        base = np.cumsum([0] + [len(h) for h in hashes]).tolist()
        answers = []
        for at, row in zip(base, rows.column("owners").to_pylist(), strict=False):
            own = from_gaps(row)
            own = own[shared[at : at + len(own)]]
            answers.append(gap_bytes(own, np.zeros(0, np.int64))[0].tobytes())
        return pa.table([rows.column("task"), pa.array(answers, pa.binary()), rows.column("tags"), rows.column("known")], names=["task", "owners", "tags", "known"])

    def total(rows: pa.Table) -> pa.Table:
        tag, n = (np.frombuffer(b"".join(rows.column(c).to_pylist()), "<i8") for c in ("tags", "known"))
        n = n + np.bincount(np.concatenate([from_gaps(row) for row in rows.column("owners").to_pylist()]), minlength=len(tag))
        return pa.table([pa.array(tag[n > 0]), pa.array(n[n > 0], pa.int64())], names=["tag", "n"])

    met = sent_to_buckets(rows, link, buckets).groupBy("bucket").applyInArrow(meet, "task long, owners binary, tags binary, known binary")
    return met.groupBy("task").applyInArrow(total, "tag long, n long").groupBy("tag").agg(F.max("n").alias("n"))


def regions_of(rows: DataFrame, link: Link, seed: int = 0) -> DataFrame:
    """tag and regions of the set of every row; each seed deals shingles to cells anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = link.rings(1)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for _, _, part, own in steps(data, offsets, STEP):
                # Copies within a step are sent once.
                some = {print_of(s): signatures(mix(s + np.uint64(seed)) if seed else s, link, edges) for s in shingle_sets(part, own, link.words) if len(s)}
                ends = np.concatenate(([0], np.cumsum([len(r) for r in some.values()]))).astype(np.int32)
                flat = np.concatenate([np.zeros(0, np.uint64), *some.values()]).view(np.int64)
                tags = np.frombuffer(b"".join(p[:8] for p in some), np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
                yield pa.RecordBatch.from_arrays([pa.array(tags), lists], names=["tag", "regions"])

    return rows.select("text").mapInArrow(run, "tag long, regions array<long>")


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node) of an undirected graph (a, b): large-star and small-star rounds until nothing changes."""
    edges = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Large star: larger neighbours to the smallest one; partial minima keep hot nodes small, the join splits skewed ones.
        large = both.join(near, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        edges = cut_lineage(small.filter("a <> b").distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).head()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state


def tied(texts: DataFrame, link: Link, seed: int = 0) -> DataFrame:
    """node, root of the sets (tag, text) that share a region with another one, directly or by others; linked sets have one root."""
    # Chains: in every region each set is tied to the one before it, so a region of any size costs a row a member.
    spread = regions_of(texts, link, seed).select(F.explode("regions").alias("region"), "tag")
    before = F.lag("tag").over(Window.partitionBy("region").orderBy("tag"))
    found = components(spread.select(F.col("tag").alias("a"), before.alias("b")).filter("a <> b"))
    return found.unionByName(found.select(F.col("root").alias("node"), "root")).distinct()


def candidates(texts: DataFrame, link: Link) -> DataFrame:
    """print, n_shingles, node, root of the sets that may link to others, which then have the same root.

    Chains tie sets that are not linked, the more the larger the corpus. Linked sets share a region however shingles are dealt to cells, so
    the groups that are too large for one task are parted by dealing anew: only what is tied each time stays together.
    """
    sets = texts.select("print", "n_shingles", F.col("tag").alias("node"))
    members = cut_lineage(sets.join(tied(texts, link), "node"))
    before = None
    for seed in range(1, DEALT_ANEW + 1):
        large = members.groupBy("root").agg(F.sum("n_shingles").alias("size")).filter(F.col("size") > BLOCK_SHINGLES)
        size = large.agg(F.sum("size")).first()[0] or 0
        if not size or before and size > 0.9 * before:
            break
        before = size
        parted = cut_lineage(members.join(large, "root", "left_semi"))
        again = tied(texts.join(parted.select("print"), "print").select("tag", "text"), link, seed).withColumnRenamed("root", "_again")
        finer = parted.join(again, "node").withColumn("root", F.xxhash64("root", "_again")).drop("_again")
        members = cut_lineage(members.join(large, "root", "left_anti").unionByName(finer))
    return members


class Sets:
    """Shingle sets laid end to end, with the places of every shingle, for distances of one to many."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        self.ends = np.concatenate(([0], np.cumsum(self.sizes)))
        distinct, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(distinct), bool)
        order = np.argsort(self.flat, kind="stable")
        self.holders = np.repeat(np.arange(len(sets)), self.sizes)[order]
        self.counts = np.bincount(self.flat, minlength=len(distinct))
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def near(self, pivot: int, num: int, den: int) -> np.ndarray:
        """All sets that may have num / den of the union in common with the pivot: those that hold one of its rarest shingles."""
        own = self.flat[self.ends[pivot] : self.ends[pivot + 1]]
        needed = -(-num * len(own) // den)  # a set without all but `needed` - 1 of the pivot's shingles is too far
        rare = own[np.argsort(self.counts[own], kind="stable")[: len(own) - needed + 1]]
        counts = self.counts[rare]
        at = np.arange(counts.sum()) + np.repeat(self.first[rare] - np.cumsum(counts) + counts, counts)
        return np.unique(self.holders[at])

    def links(self, pivot: int, others: np.ndarray, link: Link) -> tuple[np.ndarray, np.ndarray]:
        """Of each other set: does it link to the pivot; may it link to one that links to the pivot (distance at most twice)."""
        own = self.flat[self.ends[pivot] : self.ends[pivot + 1]]
        self.mark[own] = True
        sizes = self.sizes[others]
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.arange(sizes.sum()) + np.repeat(self.ends[others] - starts, sizes)
        shared = np.add.reduceat(self.mark[self.flat[at]].astype(np.int64), starts)
        self.mark[own] = False
        union = len(own) + sizes - shared
        return link.den * shared >= link.num * union, link.den * shared >= (2 * link.num - link.den) * union


def metric_join(sets: list[np.ndarray], link: Link) -> np.ndarray:
    """For each set the smallest number of a set in its linked group."""
    n = len(sets)
    if n == 1:
        return np.zeros(1, np.int64)
    space, group, left = Sets(sets), np.arange(n), np.ones(n, bool)

    def find(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = int(group[i])
        return i

    def union(i: int, j: int) -> None:
        i, j = find(i), find(j)
        group[max(i, j)] = min(i, j)

    for pivot in np.argsort(space.sizes, kind="stable").tolist():
        if not left[pivot]:
            continue
        left[pivot] = False
        # Sets beyond twice the link distance link neither to the pivot nor to its ball.
        others = space.near(pivot, 2 * link.num - link.den, link.den)
        others = others[left[others]]
        if not len(others):
            continue
        near, window = space.links(pivot, others, link)
        ball, ring = others[near], others[window & ~near]
        for j in ball.tolist():
            union(pivot, j)
        left[ball] = False
        for r in ring.tolist() if len(ball) else ():
            if find(r) != find(pivot) and space.links(r, ball, link)[0].any():
                union(r, pivot)
    return np.array([find(i) for i in range(n)])


def compare(members: DataFrame, link: Link) -> DataFrame:
    """Edges (a, b) between linked representatives, from rows (task, print, text); the rows of a task are compared together."""
    rows = members.select("task", "print", "text").repartition(4 * parallel(members.sparkSession), "task").sortWithinPartitions("task", "print")

    def edges(held: pa.Table) -> pa.RecordBatch:
        tasks = held.column("task").combine_chunks().to_numpy()
        prints = held.column("print").to_pylist()
        data, offsets = text_bytes(held.column("text"))
        sets: list[np.ndarray] = []
        for _, _, piece, own in steps(data, offsets, STEP):
            sets += shingle_sets(piece, own, link.words)
        a, b = [], []
        starts = np.flatnonzero(np.concatenate(([True], tasks[1:] != tasks[:-1], [True])))
        for first, last in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            own = {prints[i]: sets[i] for i in range(first, last)}
            names = list(own)
            if len(names) > 1:
                group = metric_join(list(own.values()), link)
                for i in np.flatnonzero(group != np.arange(len(group))):
                    a.append(names[i])
                    b.append(names[group[i]])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            fresh = pa.Table.from_batches([batch])
            held = fresh if held is None else pa.concat_tables([held, fresh])
            tasks = held.column("task").to_numpy()
            cut = int(np.searchsorted(tasks, tasks[-1])) if len(tasks) else 0  # the last task may go on
            if cut:
                yield edges(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield edges(held)

    return rows.mapInArrow(run, "a binary, b binary")


def named_rows(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """doc_id, sha, n_shingles and root (null for empty sets, else equal for linked ones) of every document (doc_id, text); null ids are NO_ID."""
    spark = docs.sparkSession
    rows = row_keys(docs)
    ids = cut_lineage(prints_of(rows, link))
    # One document of each set shows it.
    shown = ids.groupBy("print").agg(
        F.min(F.struct("doc_id", "sha")).alias("_row"), F.first("n_shingles").alias("n_shingles"), F.first("tag").alias("tag"), (F.count("*") > 1).alias("copied")
    )

    def backed(sets: DataFrame, held: DataFrame) -> DataFrame:
        return sets.join(supported(held, link, parallel(spark)), "tag").filter(F.col("n") * link.den >= link.num * F.col("n_shingles"))

    near = cut_lineage(backed(shown, rows).select("print", "tag", "n_shingles", "copied", "_row.*"))
    release(spark)
    texts = cut_lineage(rows.join(near, ["doc_id", "sha"]).dropDuplicates(["print"]).select("print", "tag", "n_shingles", "copied", "text"))
    release(spark)
    # Copies back each other. Where many sets have copies, all are asked again with one row each.
    most = texts.agg(F.count("*").alias("n"), F.count_if("copied").alias("copied")).first()
    if most["copied"] * 4 > most["n"]:
        texts = cut_lineage(texts.join(backed(texts.drop("text"), texts).select("print"), "print"))
        release(spark)
    members = candidates(texts, link).select("print", "n_shingles", "root")
    total = members.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int").alias("own")
    # Every pair of blocks of a large candidate group meets in one task; a small group is one block.
    dealt = members.join(total, "root").select("print", "root", own, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    task = F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("task")
    linked = components(compare(texts.select("print", "text").join(dealt.select("print", task), "print"), link))
    release(spark)
    named = ids.join(linked, F.col("print") == F.col("node"), "left")
    return cut_lineage(named.select("doc_id", "sha", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("root", "print")).alias("root")))


def groups(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """doc_id, n_shingles, component_id of every document (doc_id, text)."""
    named = named_rows(docs, link)
    known = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    smallest = named.filter("root IS NOT NULL").groupBy("root").agg(F.min(known).alias("component_id"))
    return named.join(smallest, "root", "left").select(known.alias("doc_id"), "n_shingles", F.coalesce("component_id", known).alias("component_id"))


def first_of_groups(docs: DataFrame, link: Link = Link()) -> DataFrame:
    """doc_id (NO_ID for null) and sha of the rows to keep: of every group the smallest id's (no id comes last), and all without a shingle."""
    named = named_rows(docs, link)
    order = F.struct((F.col("doc_id") == NO_ID).alias("last"), "doc_id", "sha")
    first = named.filter("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("_row")).select("_row.doc_id", "_row.sha")
    return first.unionByName(named.filter("root IS NULL").select("doc_id", "sha")).distinct()


def op5_jaccard(spark, folder: str) -> DataFrame:
    return groups(table(spark, folder, "documents"))
