"""Token-id files: exact round trip against the tokenizer, random access, odd inputs."""

from __future__ import annotations

import random
import tracemalloc
import uuid
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from meterlake.llm import token_files as files

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOC = "doc_id long, text string"


def by_hand(rows):
    """Rows with different ids (None first): doc_id, start, n_tokens, crc."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read_back(spark, docs, tmp_path):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    files.write_token_files(docs, path, VOCABULARY)
    rows = [tuple(r) for r in files.read_token_files(spark, path).collect()]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


@pytest.mark.parametrize("seed", range(4))
def test_re_pair_is_reversible_and_never_crosses_a_gap(seed):
    rng = np.random.default_rng(seed)
    symbols = rng.zipf(1.3, 5000).clip(0, 900).astype(np.uint32)
    symbols[rng.integers(0, 5000, 60)] = files.GAP
    symbols[200:400] = 7
    for base in (1000, 49408, 65000, 1 << 20):
        packed, rules = files.re_pair(symbols.copy(), base, 4)
        assert len(packed) < len(symbols) and len(rules)
        assert (rules != files.GAP).all()
        gaps = packed == files.GAP
        assert gaps.sum() == (symbols == files.GAP).sum()
        whole = packed.copy()
        whole[gaps] = 999
        expected = np.where(symbols == files.GAP, 999, symbols)
        assert np.array_equal(files.expand(whole, rules, base), expected)
        lengths = files.expansion_lengths(rules, base)
        assert [len(files.expand(np.array([base + i]), rules, base)) for i in range(len(rules))] == lengths.tolist()


def test_images_open_anywhere():
    rng = np.random.default_rng(5)
    docs = [rng.zipf(1.4, n).clip(0, 300).astype(np.uint32) for n in (0, 1, 700, 50, 0, 3000)]
    shard = files.Shard(files.shard_image([None, 1, 2, 2, 3, 4], docs, 2, 400))
    flat = np.concatenate([np.append(d, 2) for d in docs])
    assert shard.ids == [None, 1, 2, 2, 3, 4] and np.array_equal(shard.all_ids(), flat)
    for k, d in enumerate(docs):
        assert np.array_equal(shard.document(k), np.append(d, 2))
    for a, b in ((0, 0), (0, 1), (5, 600), (700, 760), (len(flat) - 1, len(flat)), (0, len(flat)), (len(flat), len(flat) + 3)):
        assert np.array_equal(shard.ids_between(a, b), flat[a:b])
    with pytest.raises(ValueError):
        files.Shard(b"other" + bytes(60))


def test_files_match_the_tokenizer(spark, tmp_path):
    rng = random.Random(12)
    words = ["the", "Thé", "don't", "x1y22", "<|endoftext|>", "😀", "\x1c", "ΣΑΣ", "naïve", " ", "#", "a" * 50, "word\nnext", "I'll"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(-20, 150)]
    rows += [(None, "null id"), (1000, None), (1001, ""), (1002, "the quick brown fox " * 6000)]
    docs = spark.createDataFrame(rows, DOC).select("*", F.lit("x").alias("part"), F.lit("y").alias("shard"))
    expected = by_hand(rows)
    assert read_back(spark, docs, tmp_path) == expected
    # Small shards: several in a part, a long document in one of its own.
    assert files.token_shards(docs, VOCABULARY, shard=500).count() > 10
    path = f"{tmp_path}/small"
    files.token_shards(docs, VOCABULARY, shard=500).write.parquet(path)
    small = [tuple(r) for r in files.read_token_files(spark, path).collect()]
    assert sorted(small, key=lambda r: (r[0] is not None, r[0] or 0)) == expected


def test_repeated_and_hot_ids_keep_every_row(spark, tmp_path):
    rows = [(7, f"copy {i % 3}") for i in range(300)] + [(3, "first"), (9, "last")]
    got = read_back(spark, spark.createDataFrame(rows, DOC), tmp_path)
    assert len(got) == 302 and got[0][:2] == (3, 0) and got[-1][0] == 9
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got[:-1]]).tolist()
    assert read_back(spark, spark.createDataFrame([], DOC), tmp_path) == []


def test_a_task_encodes_a_large_batch_in_small_steps(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x")], DOC)
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    run = files.token_shards(docs, VOCABULARY)
    rng = random.Random(3)
    words = ["the", "quick", "brown", "fox", "naïve", "don't", "x1y22", "window", "reading", "meter"]
    texts = [" ".join(rng.choice(words) for _ in range(400)) for _ in range(2400)]
    batch = pa.record_batch([pa.array(range(2400), pa.int64()), pa.array(texts), pa.array([0] * 2400, pa.int32())], names=["doc_id", "text", "part"])
    assert batch.nbytes > 5 << 20
    list(run(iter([batch.slice(0, 10)])))  # the encoder itself is not counted
    tracemalloc.start()
    try:
        rows = [row for out in run(iter([batch])) for row in out.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100 << 20
    counts = [len(e.ids) + 1 for e in Tokenizer.from_file(VOCABULARY).encode_batch(texts, add_special_tokens=False)]
    assert [n for r in rows for n in files.Shard(r["image"]).counts.tolist()] == counts
