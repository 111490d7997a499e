"""Exact top-k inner-product search with MaxScore over shards of integer vectors.

A dimension is a term: its posting list in a shard holds the components of the shard's vectors. The bound of a term for a query is the
largest product it can give in the shard. Terms are taken by falling bound; those that can still lift a vector over the query's k-th
best score are essential and their postings are traversed for all vectors; the others are probed only for vectors whose partial score
plus the bounds left still reaches it. Shards are merged by rank. Nothing is approximate and no candidate is capped.

Queries are packed in blocks, and every block meets every shard once, as rows of packed vectors: an all-against-a-stated-set search in
blocks, with neither side broadcast.

Defined cases: a vector that is null, or holds a null or non-finite component, takes no part, nor does a null id; a shorter vector counts as
padded with zeros; ties go to the smaller id; repeated rows are rows of their own, and only the query's own row is left out; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import cut_lineage, table

SHARD_ROWS = 4096
BLOCK_ROWS = 1024


def integer_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """id and vec (array of long, floor(scale * x)) of the rows that take part."""
    usable = F.col(vector).isNotNull() & F.col(key).isNotNull()
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")))
    return vectors.filter(usable).filter(finite).select(F.col(key).cast("long").alias("id"), whole.alias("vec"))


def packed(vectors: DataFrame, rows: int = SHARD_ROWS) -> DataFrame:
    """Shards of at most `rows` vectors in the order they come: ids and a matrix as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists = part.column(1)
                lengths = np.diff(np.asarray(lists.offsets))
                width = int(lengths.max()) if len(lengths) else 0
                matrix = np.zeros((part.num_rows, width), np.int64)
                matrix[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], t) for n, t in ((part.num_rows, pa.int32()), (width, pa.int32()))]
                    + [pa.array([ids.tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary())],
                    names=["n", "width", "ids", "rows"],
                )

    out = vectors.select("id", "vec").mapInArrow(run, "n int, width int, ids binary, rows binary")
    return out.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("shard"), "*")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        edge = np.partition(scores, -k)[-k]
        some = np.flatnonzero(scores >= edge)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def max_score(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query: its number, positions and scores of its k best rows; own: the row that is the query itself, or -1."""
    high, low = rows.max(0), rows.min(0)
    # Products and sums of this size are exact in doubles; otherwise whole numbers are used.
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    kind = np.float64 if largest < 2**53 else object
    lists = np.ascontiguousarray(rows.T).astype(kind)
    for q, query in enumerate(queries.astype(kind)):
        bounds = np.maximum(query * high, query * low)
        order = np.argsort(-(bounds - np.minimum(query * high, query * low)).astype(float), kind="stable")
        left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # the most that the terms from here on give
        skip = own[q]
        # Threshold: exact scores of a first few rows.
        head = np.flatnonzero(np.arange(len(ids)) != skip)[: 16 * k]
        first = (query[:, None] * lists[:, head]).sum(0) if kind is object else query @ lists[:, head]
        floor = np.sort(first)[-k] if len(first) >= k else None
        alive, score, at, step = np.arange(len(ids)), np.zeros(len(ids), kind), 0, 8
        if skip >= 0:
            alive, score = np.delete(alive, skip), np.delete(score, skip)
        while at < len(order):
            terms = order[at : at + step]
            own_lists = lists[terms] if len(alive) == lists.shape[1] else lists[np.ix_(terms, alive)]
            score = score + ((query[terms][:, None] * own_lists).sum(0) if kind is object else query[terms] @ own_lists)
            at += len(terms)
            if floor is not None and at < len(order):
                if len(alive) > 4 * k:
                    rest = np.minimum(query * high, query * low)[order[at:]].sum()
                    floor = max(floor, np.partition(score, -k)[-k] + rest)
                keep = score + left[at] >= floor
                alive, score = alive[keep], score[keep]
        top = best(score, ids[alive], k)
        yield q, alive[top], score[top]


def search(vectors: DataFrame, is_query: Column, k: int = 5, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score over vectors (id, vec); is_query is a condition on `id`."""
    shards = cut_lineage(packed(vectors, shard_rows))
    last = shards.agg(F.max("part")).head()[0]  # shards are numbered within the partitions they were packed in

    def queries_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, n, width, ids, rows in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(ids, np.int64)
                matrix = np.frombuffer(rows, np.int64).reshape(n, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array([shard] * n, pa.int64()), pa.array(np.arange(n)), pa.array(list(matrix), pa.list_(pa.int64()))],
                    names=["id", "home", "place", "vec"],
                )

    queries = shards.select("shard", "n", "width", "ids", "rows").mapInArrow(queries_of, "id long, home long, place long, vec array<long>").filter(is_query)
    spread = F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("part")
    blocks = (
        queries.withColumn("block", F.monotonically_increasing_id() / block_rows)
        .groupBy(F.spark_partition_id().alias("source"), F.floor("block").alias("block"))
        .agg(F.collect_list(F.struct("id", "home", "place", "vec")).alias("queries"))
        .select("queries", spread)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, n, width, ids, rows, asked in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys = np.frombuffer(ids, np.int64)
                matrix = np.frombuffer(rows, np.int64).reshape(n, width)
                wide = max([width, *(len(q["vec"]) for q in asked)])
                matrix = np.pad(matrix, ((0, 0), (0, wide - width)))
                some = np.array([q["vec"] + [0] * (wide - len(q["vec"])) for q in asked], np.int64).reshape(len(asked), wide)
                own = np.array([q["place"] if q["home"] == shard else -1 for q in asked])
                out: list[tuple] = []
                for q, at, score in max_score(some, own, keys, matrix, k):
                    out += [(asked[q]["id"], asked[q]["home"], asked[q]["place"], int(keys[i]), int(s)) for i, s in zip(at, score, strict=True)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "home", "place", "vec_id", "score"]
                    )

    met = shards.join(blocks, "part").select("shard", "n", "width", "ids", "rows", "queries")
    found = met.mapInArrow(run, "query_id long, home long, place long, vec_id long, score long")
    order = Window.partitionBy("query_id", "home", "place").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op8_search(spark, folder: str) -> DataFrame:
    vectors = integer_vectors(table(spark, folder, "embeddings"))
    # Rows are dealt by id, so that shards are even whatever the files hold.
    return search(vectors.repartition("id"), F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
