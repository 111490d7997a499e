"""Language identification with interpolated Kneser-Ney character trigram models.

Letters and marks fall into 63 classes (a-z alone, all others by code point), everything else is one gap symbol, so a trigram is an
18-bit code and a language's model has at most 2^18 entries, whatever the corpus holds. Trigrams of all training documents are
counted in the tasks and summed by Spark; the lower orders follow from the trigram table. The model is a sorted array of the codes
seen with their log probabilities per language, plus back-off weights and bigrams; a task unfolds it to a table addressed by code.
A text gets the language of the lowest cross-entropy per symbol. It is rejected where that is further from the language's own
cross-entropy than half the way to the nearest other language, beyond six standard errors of a text of this length.

Defined cases: null text, or a text without a letter, is `und` with score 0 and rejected; without any training row every document is
`und`; null languages are not learned; repeated rows each count; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import held_out, steps, table, text_bytes

CLASSES = 64
CODES = CLASSES**3
KNOWN = 0x3000
#: More languages than this are refused: the model's size is CODES times their number.
MAX_LANGUAGES = 256
STEP = 2 << 20
UNKNOWN = "und"


def letter_class(point: int) -> int:
    """0 no letter or mark; 1-26 a-z; 27-63 any other."""
    if unicodedata.category(chr(point))[0] not in "LM":
        return 0
    return point - 96 if 97 <= point <= 122 else 27 + point % 37


class Symbols:
    """Class symbols of many texts: gaps collapsed, a gap after each word."""

    def __init__(self) -> None:
        self.table = np.array([letter_class(p) for p in range(KNOWN)], np.uint8)

    def codes(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Trigram codes of all texts, and the n+1 offsets of the texts in them."""
        lowered = [t.lower() + "\n" for t in texts]
        points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        low = np.minimum(points, KNOWN - 1)
        symbols = self.table[low]
        high = np.flatnonzero(points >= KNOWN)
        if len(high):
            distinct, back = np.unique(points[high], return_inverse=True)
            symbols[high] = np.array([letter_class(int(p)) for p in distinct], np.uint8)[back]
        keep = symbols > 0
        keep[1:] |= keep[:-1].copy()
        ends = np.concatenate(([0], np.cumsum([len(t) for t in lowered])))
        kept = np.concatenate(([0], np.cumsum(keep)))[ends]
        symbols = symbols[keep].astype(np.int32)
        codes = symbols.copy()
        codes[1:] += symbols[:-1] << 6
        codes[2:] += symbols[:-2] << 12
        firsts = kept[:-1][kept[:-1] < kept[1:]]
        codes[firsts] = symbols[firsts]
        return codes, kept


def trigram_counts(training: DataFrame) -> DataFrame:
    """lang, code, n over all training documents (lang, text); each task adds up before it sends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, seen, sums = Symbols(), {}, []
        for batch in batches:
            langs = batch.column(0).to_pylist()
            _, offsets = text_bytes(batch.column(1))
            for first, last, _, _ in steps(np.zeros(0, np.uint8), offsets, STEP):
                codes, ends = symbols.codes([t or "" for t in batch.column(1).slice(first, last - first).to_pylist()])
                own = np.array([seen.setdefault(x, len(seen)) for x in langs[first:last]], np.int64)
                if len(seen) > MAX_LANGUAGES:
                    raise ValueError(f"more than {MAX_LANGUAGES} languages")
                sums.extend(np.zeros(CODES, np.int64) for _ in range(len(seen) - len(sums)))
                spread = np.repeat(own, np.diff(ends))
                for k in np.unique(own):
                    sums[k] += np.bincount(codes[spread == k], minlength=CODES)
        for lang, k in seen.items():
            at = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(sums[k][at])], names=["lang", "code", "n"]
            )

    counted = training.select("lang", "text").mapInArrow(run, "lang string, code int, n long")
    return counted.groupBy("lang", "code").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # sorted
    seen: np.ndarray  # negative log probability of each code (rows) in each language
    backoff: np.ndarray  # of each pair, negative log weight
    pairs: np.ndarray  # of each pair, negative log probability of its second symbol
    limits: np.ndarray  # rows: own cross-entropy, its deviation per symbol, margin

    def unfolded(self) -> np.ndarray:
        code = np.arange(CODES)
        costs = self.backoff[code >> 6] + self.pairs[code & 4095]
        costs[self.codes] = self.seen
        return costs.astype(np.float32)


def discount(counts: np.ndarray) -> float:
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return ones / (ones + 2 * twos) if ones and twos else 0.5


def kneser_ney(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of trigrams, back-off weight of pairs, and probabilities of bigrams, from a cube of trigram counts."""

    def level(c: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = discount(c)
        total = c.sum(-1, keepdims=True)
        weight = np.where(total > 0, d * (c > 0).sum(-1, keepdims=True) / np.maximum(total, 1), 1.0)
        return np.maximum(c - d, 0) / np.maximum(total, 1) + weight * lower, weight[..., 0]

    pairs = (counts > 0).sum(0).astype(float)  # how many symbols stand before the pair
    singles = (pairs > 0).sum(0).astype(float)
    one, _ = level(singles, np.full(CLASSES, 1 / CLASSES))
    two, _ = level(pairs, one)
    three, weight = level(counts, two[None])
    return three, weight, two


def build_model(counts: DataFrame) -> Model:
    """From lang, code, n: at most CODES rows a language come to the driver."""
    rows = counts.toPandas()
    languages = sorted(rows["lang"].unique())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    codes = np.unique(rows["code"].to_numpy(np.int64))
    cubes, costs, backoff, pairs = [], [], [], []
    for lang in languages:
        own = rows[rows["lang"] == lang]
        cube = np.zeros(CODES)
        cube[own["code"].to_numpy(np.int64)] = own["n"].to_numpy(float)
        three, weight, two = kneser_ney(cube.reshape(CLASSES, CLASSES, CLASSES))
        cubes.append(cube)
        costs.append(-np.log(three.reshape(-1)))
        backoff.append(-np.log(weight.reshape(-1)))
        pairs.append(-np.log(two.reshape(-1)))
    limits = np.zeros((3, len(languages)))
    for k, cube in enumerate(cubes):
        share = cube / cube.sum()
        mean = [float(share @ c) for c in costs]
        limits[0, k] = mean[k]
        limits[1, k] = math.sqrt(float(share @ (costs[k] - mean[k]) ** 2))
        limits[2, k] = (min([m for j, m in enumerate(mean) if j != k] or [math.log(CLASSES)]) - mean[k]) / 2
    stack = [np.stack(x, 1) if languages else np.zeros((n, 0)) for x, n in ((costs, CODES), (backoff, CLASSES**2), (pairs, CLASSES**2))]
    return Model(languages, codes, stack[0][codes], stack[1], stack[2], limits)


def train(docs: DataFrame, learned: Column) -> Model:
    """From the documents (text, lang) where `learned` holds."""
    return build_model(trigram_counts(docs.filter(learned & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")))


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (0 to 1, share of the winner), cross_entropy and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    names = [n for n in docs.columns if n not in ("lang_pred", "score", "cross_entropy", "rejected")]
    kept = docs.select(*names)
    added = (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("cross_entropy", T.DoubleType()), ("rejected", T.BooleanType()))
    schema = T.StructType([*kept.schema.fields, *[T.StructField(n, t) for n, t in added]])
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        costs, symbols = own.unfolded(), Symbols()
        choices = np.array([*own.languages, UNKNOWN], object)
        for batch in batches:
            n = batch.num_rows
            best, score, entropy, rejected = np.full(n, len(own.languages)), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
            _, offsets = text_bytes(batch.column(at))
            for first, last, _, _ in steps(np.zeros(0, np.uint8), offsets, STEP):
                texts = [t or "" for t in batch.column(at).slice(first, last - first).to_pylist()]
                codes, ends = symbols.codes(texts)
                full = np.flatnonzero((np.diff(ends) > 0) & [any(map(str.isalpha, t)) for t in texts])
                if not len(full) or not own.languages:
                    continue
                length = np.diff(ends)[full]
                sums = np.add.reduceat(costs[codes], ends[:-1][np.diff(ends) > 0], axis=0, dtype=np.float64)
                sums = sums[np.isin(np.flatnonzero(np.diff(ends) > 0), full)]
                mean = sums / length[:, None]
                win = mean.argmin(1)
                low = mean[np.arange(len(win)), win]
                rows = first + full
                best[rows], entropy[rows] = win, low
                score[rows] = 1 / np.exp(-np.minimum((mean - low[:, None]) * np.minimum(length, 200)[:, None], 700)).sum(1)
                own_mean, deviation, margin = own.limits[:, win]
                rejected[rows] = low > own_mean + margin + 6 * deviation / np.sqrt(length)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(choices[best], pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(rejected)],
                names=[*names, "lang_pred", "score", "cross_entropy", "rejected"],
            )

    return kept.mapInArrow(run, schema)


def op6_language(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, ~held_out(F.col("doc_id")))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
