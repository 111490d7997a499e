"""The pipeline's stages on planted documents."""

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F


def run_stages(spark, docs, folder, path, until=5):
    for name, stage in corpus_pipeline.STAGES[:until]:
        stage(spark, docs, folder).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs


def test_stages_catch_what_is_planted_and_keep_clean_documents(spark, tmp_path):
    rng = random.Random(9)
    words = {"en": [f"the{i}ing" for i in range(400)], "de": [f"ßch{i}ung" for i in range(400)]}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(i, text(lang, 120), lang) for i in range(40) for lang in [("en", "de")[i % 2]]]
    near = rows[4][1].split()
    near[60] = "changed"
    item = text("en", 30)
    rows += [
        (100, " ".join(near), "en"), (101, rows[5][1], "de"), (101, rows[5][1], "de"), (102, f"{text('en', 50)} {item.upper()} {text('en', 50)}", "en"),
        (103, text("en", 60) + " token=abcdefghijkl0123 " + text("en", 10), "en"), (104, "12 !! 34", "en"), (105, None, "en"), (106, "", None), (None, text("de", 40), None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").select(
        "*", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"), F.lit(1).alias("leaks"), F.lit(2).alias("_copy"), F.lit(3).alias("rejected")
    )
    folder = str(tmp_path / "sf")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = run_stages(spark, docs, folder, str(tmp_path / "out"), until=4)
    assert out.columns == docs.columns
    kept = {r.doc_id: r for r in out.collect()}
    assert set(kept) == {*range(40), 103, None}
    assert "[SECRET]" in kept[103].text and kept[103].n_chars == len(kept[103].text)
    assert all(kept[i].text == rows[i][1] for i in range(40))
    packed = corpus_pipeline.best_fit_packing(spark, out, folder)
    assert {r.doc_id for r in packed.collect()} == set(kept)


def test_rows_without_an_id_or_with_the_same_one_are_rows_of_their_own(spark):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))

    def near(t):
        words = t.split()
        words[30] = f"w{rng.randrange(10**6)}"
        return " ".join(words)

    bases = [text() for _ in range(25)]
    x, y, n = text(), text(), text()
    rows = [(3, x), (7, near(x)), (7, y), (None, n), (None, near(n)), (None, ""), (None, ""), (8, " \n")]
    rows += [(None, near(bases[i % 25])) for i in range(1000)] + [(9, near(bases[i % 20])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(t for i, t in kept if i in (3, 7)) == sorted([x, y])
    assert sum(i == 9 for i, _ in kept) == 20  # one of each group, of the rows with an id
    own = [t for i, t in kept if i is None]
    assert len(own) == 2 + 1 + 5 and own.count("") == 2


def test_pipeline_runs_on_tables_and_on_none(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, folder).toPandas()
    assert (rows.groupby("sequence_id")["length"].sum() <= 4096).all()
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    assert run_stages(spark, none, folder, str(tmp_path / "none")).count() == 0
