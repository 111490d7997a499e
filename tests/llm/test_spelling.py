"""Spelling variants against comparing all words with all words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import spelling

DOC = "doc_id long, text string"


def edits(word, letters):
    """All strings at one edit."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    return out - {word}


def by_hand(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = sorted({c for w in words for c in w})
    near = {w: [v for v in edits(w, letters) if v in words] for w in words}
    form = {}
    for w, n in words.items():
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 10 * n:
                form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


def answer(docs, **options):
    return sorted(tuple(r) for r in spelling.spelling_variants(docs, **options).collect())


def corpus(seed, size=400):
    rng = random.Random(seed)
    stems = ["Aaaaaaa", "aaaaaaaa", "Abababab", "international", "Ünîversité", "xyzxyzxyz", "connection", "connections", "commotion", "Þorgerður", "straße÷x"]
    rows = []
    for i in range(size):
        words = []
        for _ in range(rng.randint(0, 40)):
            w = rng.choice(stems) if rng.random() < 0.8 else stems[0]
            for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1 :], w[:p] + rng.choice("abxÿ") + w[p:], w[:p] + rng.choice("abxÿ") + w[p + 1 :]])
            words.append(w)
        rows.append((rng.choice([None, i, i, 7]), rng.choice([" ", "-", "1"]).join(words)))
    rows += [(500 + i, "chainword " * 10 + "chainwrd " * (i < 30) + "chanwrd " * (i < 2)) for i in range(60)]
    return [*rows, (1, None), (2, ""), (3, "z" * 3000 + " " + "z" * 3000), (4, "z" * 2999 + " " + "z" * 2999)]


@pytest.mark.parametrize("seed", range(2))
def test_variants_match_comparing_all(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, DOC).select("*", *[F.lit("x").alias(c) for c in ("word", "n", "home", "part", "anchor", "root")])
    expected = by_hand(rows)
    assert any(r[1] for r in expected) and any(r[2] != r[1] and r[1] for r in expected)
    assert answer(docs) == expected
    # Small groups, and anchors dealt to several of them.
    assert answer(docs, group=7, hot=5) == expected


def test_index_intervals_are_counts():
    rng = np.random.default_rng(1)
    words = [rng.integers(2, 5, rng.integers(1, 9)).astype(np.uint8) for _ in range(60)]
    text = np.concatenate([np.concatenate(([1], w)) for w in words] + [[1, 0]]).astype(np.uint8)
    order = spelling.suffix_order(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
    index = spelling.Direction(text)
    for code in range(5):
        for at in (0, 1, 17, 64, 65, len(text)):
            assert index.below(np.array([code]), np.array([at]))[0] == (index.last[:at] < code).sum()


def test_empty_tables(spark):
    assert answer(spark.createDataFrame([], DOC)) == []
    assert answer(spark.createDataFrame([(1, None), (2, "short words only"), (3, "singleton")], DOC)) == []
