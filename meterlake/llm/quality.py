"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features of a text are its words and word pairs (A-Z lowered) and its runs of one to three word shapes (letter case, digits and
signs, repeats collapsed), hashed to 2^18 places and weighted by their share of the text. Training takes at most LABELLED_ROWS
labelled rows, the first by hash of their id; shards of them are trained in parallel and their weights averaged. A score is the
sparse dot product through the logistic function.

Defined cases: null text is empty; a text without words gets the score of the bias; without labelled rows of both kinds the score is
the share of label 1, or 0.5; null labels are not learned; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import BYTE_CODE, SPACE, held_out, mix, ngrams, odd_powers, steps, table, text_bytes, words

BITS = 18
#: Bound of the labelled rows that training takes.
LABELLED_ROWS = 24_000
SHARDS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 1e-4, 1e-4
SCALE = 100.0
STEP = 1 << 20

SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[65:91] = 65
SHAPE[97:123] = 97
SHAPE[128:] = 97
SHAPE[48:58] = 48


def shapes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word's shape: classes of its bytes, repeats collapsed."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    kind = SHAPE[data]
    keep = ~SPACE[data]
    keep[1:] &= kind[1:] != kind[:-1]
    keep[begin] = True
    where = np.flatnonzero(keep)
    first = np.searchsorted(where, begin)
    size = np.diff(np.append(first, len(where)))
    part = BYTE_CODE[kind[where]] * odd_powers(int(size.max()))[np.arange(len(where)) - np.repeat(first, size)]
    return mix(np.add.reduceat(part, first) + size.astype(np.uint64))


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of all features of all texts, and the n+1 offsets; n-grams never cross texts."""
    codes, begin, end, ranges = words(data, offsets)
    forms = shapes(data, begin, end)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(ranges))
    places, owners = [], []
    for salt, (values, n) in enumerate(((codes, 1), (codes, 2), (forms, 1), (forms, 2), (forms, 3))):
        grams = ngrams(values, n)
        whole = owner[n - 1 :] == owner[: len(owner) - n + 1] if len(owner) >= n else np.zeros(0, bool)
        places.append((mix(grams[whole] + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int32))
        owners.append(owner[: len(whole)][whole])
    at = np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    return np.concatenate(places)[order], np.searchsorted(at[order], np.arange(len(offsets)))


def logistic(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(data: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) after EPOCHS passes of FTRL-proximal updates, one text at a time."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)
    texts = []
    for first, last, part, own in steps(data, offsets, STEP):
        places, ends = features(part, own)
        for i in range(last - first):
            at, count = np.unique(places[ends[i] : ends[i + 1]], return_counts=True)
            texts.append((np.append(at, size - 1), np.append(SCALE * count / max(1, count.sum()), 1.0)))

    def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(texts)):
            at, x = texts[i]
            zi, ni = z[at], n[at]
            w = weights(zi, ni)
            g = (logistic(float(w @ x)) - labels[i]) * x
            more = ni + g * g
            z[at] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
            n[at] = more
    return weights(z, n)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = LABELLED_ROWS, shards: int = SHARDS) -> np.ndarray:
    """Averaged weights from documents (doc_id, text) and labels (doc_id, `label` 0 or 1)."""
    taken = labels.filter(F.col(label).isin(0, 1)).select("doc_id", F.col(label).cast("int").alias("label"))
    order = F.xxhash64("doc_id")
    taken = taken.orderBy(order, "doc_id").limit(rows).select("doc_id", "label", F.pmod(order, F.lit(shards)).cast("int").alias("shard"))
    # At most `rows` ids of 16 bytes are sent to the tasks that read the documents.
    sample = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["doc_id", "label"])
        data, offsets = text_bytes(pa.array(part["text"], pa.string(), from_pandas=True))
        w = ftrl(data, offsets, part["label"].to_numpy(float))
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at.astype(np.int32), "weight": w[at]})

    fitted = sample.groupBy("shard").applyInPandas(fit, "place int, weight double")
    parts = fitted.groupBy("place").agg(F.sum("weight").alias("weight")).toPandas()  # at most 2^18 + 1 rows
    used = taken.select("shard").distinct().count()
    weights = np.zeros((1 << BITS) + 1)
    weights[parts["place"].to_numpy(np.int64)] = parts["weight"].to_numpy(float) / max(1, used)
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of documents (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    schema = docs.select("doc_id", F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            out = np.full(batch.num_rows, float(own[-1]))
            for first, last, part, ends in steps(data, offsets, STEP):
                places, at = features(part, ends)
                sums = np.concatenate(([0.0], np.cumsum(own[places], dtype=np.float64)))[at]
                out[first:last] += SCALE * np.diff(sums) / np.maximum(1, np.diff(at))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(logistic(out))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op9_quality(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").filter(~held_out(F.col("doc_id")))
    out = score(docs, train(docs, labels))
    predicted: Column = (F.col("score") >= 0.3).cast("int")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))
