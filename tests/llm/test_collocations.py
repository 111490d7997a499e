"""Phrase collocations against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import collocations as col

DOC = "doc_id long, text string, lang string"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_hand(rows, floor, top):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", lowered(text or "")):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals["und" if lang is None else lang] += len(words)
            for i in range(len(words)):
                for m in range(1, 6):
                    if i + m <= len(words):
                        own[tuple(words[i : i + m])] += 1
    out = []
    for lang, own in counts.items():
        n = totals[lang]
        chosen = {p: a for p, a in own.items() if len(p) >= 2 and a >= floor}
        covered = set()
        for p, a in chosen.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= 100 * chosen[p[i : i + m]]:
                        covered.add(p[i : i + m])
        best = []
        for p, a in chosen.items():
            if p not in covered:
                cuts = [(1000 * a * n // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                best.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, docs=250, hot=False):
    rng = random.Random(seed)
    base = ["The", "of", "und", "Ábc", "x", "y", "z", "\x00n", "w.w", "Q q", "é", "1,5"]
    rows = []
    for i in range(docs):
        n = rng.choice([0, 1, 2, 5, 30, 80])
        words = [rng.choice(base[: rng.randint(1, len(base))]) for _ in range(n)]
        text = "".join(w + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " "]) for w in words)
        if hot:
            text += "hot pair " * rng.randint(0, 40) + "one passage that all documents hold whole; "
        rows.append((rng.randint(0, 99), text, rng.choice(["en", "de", None, "und", ""])))
    return [*rows, (1, None, "en"), (None, "", None), (5, "a b", "de")]


def answer(docs, **options):
    return sorted(tuple(r) for r in col.collocations(docs, **options).collect())


@pytest.mark.parametrize("seed", range(2))
def test_collocations_match_plain_counts(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOC).select("*", *[F.lit(1).alias(c) for c in ("symbol", "a", "n", "rank", "home", "word")])
    for floor, top in ((5, 2000), (12, 7)):
        expected = by_hand(rows, floor, top)
        assert expected and answer(docs, floor=floor, top=top) == expected


def test_hot_prefixes_change_where_suffixes_go_and_nothing_else(spark, monkeypatch):
    rows = corpus(3, hot=True)
    docs = spark.createDataFrame(rows, DOC).repartition(6)
    expected = by_hand(rows, 10, 2000)
    total = 10_000
    hot = col.hot_prefixes(docs, 0, total, 100, 1)
    assert all(len(h) for h in hot)
    # Every place looked at, groups of a few suffixes, runs of a few words.
    monkeypatch.setattr(col, "hot_prefixes", lambda *_: hot)
    assert answer(docs, floor=10, group=100, flush=300) == expected


def test_symbols_that_meet_are_dealt_anew(spark, monkeypatch):
    rows = corpus(1, 40)
    real = col.symbol_of
    monkeypatch.setattr(col, "symbol_of", lambda lang, word, seed: real(lang, word, seed) % (8 if seed < 2 else 2**64))
    docs = spark.createDataFrame(rows, DOC)
    assert col.distinct_symbols(docs)[1] == 2
    assert answer(docs, floor=5) == by_hand(rows, 5, 2000)


def test_empty_tables_and_large_numbers(spark):
    assert answer(spark.createDataFrame([], DOC)) == []
    assert answer(spark.createDataFrame([(1, None, None)], DOC)) == []
    # Products beyond 64 bits.
    n = 10**13
    words = spark.createDataFrame([(1, "en", "a", n // 3, n), (2, "en", "b", n // 7, n)], "symbol long, lang string, word string, n long, total long")
    phrases = spark.createDataFrame([([1, 2], n // 9)], "symbols array<long>, a long")
    assert col.scored(phrases, words).first()["score"] == 1000 * (n // 9) * n // ((n // 3) * (n // 7))


def test_quicksort_counts_prefixes():
    rng = np.random.default_rng(2)
    places = rng.integers(0, 4, (5, 4000)).astype(np.int32)
    places[0] = np.maximum(places[0], 1)
    for d in range(1, 5):
        places[d][places[d - 1] == 0] = 0
    counts = rng.integers(1, 5, 4000)
    expected = Counter()
    for p, c in zip(places.T.tolist(), counts.tolist(), strict=True):
        for m in range(2, 6):
            if all(p[:m]):
                expected[tuple(p[:m])] += c
    expected = {p: c for p, c in expected.items() if c >= 50}
    got = {tuple(places[:m, at].tolist()): a for at, m, a in col.quicksort_counts(places, counts, np.full(4000, 2, np.uint8), 50)}
    assert got == expected
