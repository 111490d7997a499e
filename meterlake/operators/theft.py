"""Theft probability, status, candidate promotion, sampling, split and classifier metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numeric import clip, column_or, order_hash
from meterlake.plans.radix import running_totals
from meterlake.plans.ranges import ranked_by_hash
from meterlake.plans.session import cut_lineage
from meterlake.schema import ANOMALY, NORMAL, THEFT, THEFT_CUT, WASTAGE, WASTAGE_CUT


def blend_probability(forest: str = "random_forest_probability", boost: str = "xgboost_probability") -> Column:
    return F.lit(0.45) * F.col(forest) + F.lit(0.55) * F.col(boost)


def status_of(df: DataFrame) -> Column:
    """First match wins: theft, anomaly, wastage, normal."""
    return (
        F.when(F.col("theft_probability") >= THEFT_CUT, F.lit(THEFT))
        .when(column_or(df, "is_anomaly") == 1, F.lit(ANOMALY))
        .when(column_or(df, "wastage_score") >= WASTAGE_CUT, F.lit(WASTAGE))
        .otherwise(F.lit(NORMAL))
    )


def classify(df: DataFrame) -> DataFrame:
    """Add `theft_probability` and `status` from the two model probabilities."""
    df = df.withColumn("theft_probability", blend_probability())
    return df.withColumn("status", status_of(df))


def promote_candidate(df: DataFrame, time_col: str = "timestamp", tie: str = "reading_id") -> DataFrame:
    """Mark the likeliest row of every timestamp that has no theft row (a demonstration aid).

    The best row comes from an aggregate with map-side combine, so a timestamp with very many rows
    is never sorted in one task.
    """
    score = (
        F.lit(0.45) * column_or(df, "seeded_theft_probability")
        + F.lit(0.3) * clip(column_or(df, "theft_probability"), low=0.0)
        + F.lit(0.2) * clip(column_or(df, "anomaly_score"), low=0.0)
        + F.lit(0.05) * clip(column_or(df, "wastage_score"), 0.0, 1.0)
    )
    best = (
        df.groupBy(F.col(time_col).alias("_tick"))
        .agg(
            F.min(F.struct((-score).alias("s"), F.col(tie).alias("k"))).alias("_best"),
            F.max((F.col("status") == THEFT).cast("int")).alias("_has"),
        )
        .where(F.col("_has") == 0)
        .select("_tick", F.col("_best.k").alias("_chosen"))
    )
    joined = df.join(best, (F.col(time_col) == F.col("_tick")) & (F.col(tie) == F.col("_chosen")), "left")
    chosen = F.col("_chosen").isNotNull()
    floors = {"theft_probability": 0.81, "random_forest_probability": 0.79, "xgboost_probability": 0.83}
    out = {c: F.when(chosen, F.greatest(c, F.lit(v))).otherwise(F.col(c)) for c, v in floors.items() if c in df.columns}
    out["status"] = F.when(chosen, F.lit(THEFT)).otherwise(F.col("status"))
    return joined.withColumns(out).drop("_tick", "_chosen")


def rank_tick(df: DataFrame, tie: str = "reading_id") -> DataFrame:
    return df.orderBy(F.desc("theft_probability"), F.desc("anomaly_score"), tie)


def _lowest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def balanced_sample(df: DataFrame, max_rows: int, label: str = "is_theft", key: str = "reading_id", seed: int = 42) -> DataFrame:
    """At most `max_rows` training rows, up to a third of them positive, the rest negative.

    Rows come in the order of a seeded hash of their key. Counts and the hash up to which rows can be due are found over key and label alone,
    so what computes the other columns runs once, for the rows that may be taken. A frame that already fits is returned whole.
    """
    place = order_hash(F.col(key), seed)
    order = [place, F.col(key)]
    cap = max_rows // 3
    narrow = df.select(F.col(label).alias("_label"), place.alias("_place"))
    counts = narrow.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("_label") == 1).cast("bigint")), F.lit(0)).alias("positives")).first()
    if counts["n"] <= max_rows:
        return df
    # Negatives fill what the positives leave.
    due = {1: cap, 0: max_rows - min(counts["positives"], cap)}

    def upto(value: int) -> Column:
        last = _lowest(narrow.where(F.col("_label") == value).select("_place"), [F.col("_place")], due[value]).agg(F.max("_place")).first()[0]
        return (F.col(label) == value) & (place.isNull() | (place <= F.lit(-1 if last is None else last)))

    # Copies of a key share their place, so a few more rows than are due may remain.
    near = cut_lineage(df.where(upto(1) | upto(0)))
    return _lowest(near.where(F.col(label) == 1), order, due[1]).unionByName(_lowest(near.where(F.col(label) == 0), order, due[0]))


def stratified_split(
    df: DataFrame, test_share: float = 0.2, label: str = "is_theft", key: str = "reading_id", seed: int = 42
) -> DataFrame:
    """Add `is_test`: per class, the first `test_share` of the rows in seeded hash order."""
    ranked = ranked_by_hash(df, label, key, seed)
    return ranked.withColumn("is_test", (F.col("_rank") <= F.col("_size") * F.lit(test_share)).cast("int")).drop("_rank", "_size")


def block_sample(df: DataFrame, block: str, take: int, key: str = "reading_id", seed: int = 42) -> DataFrame:
    """At most `take` rows of every block (a group of meters), in seeded hash order."""
    nearest = Window.partitionBy(block).orderBy(order_hash(F.col(key), seed), key)
    # A top-n per block: every task keeps `take` rows of a block before the exchange.
    return df.withColumn("_nth", F.row_number().over(nearest)).where(F.col("_nth") <= take).drop("_nth")


def class_weights(df: DataFrame, label: str = "is_theft", weight: str = "class_weight") -> DataFrame:
    """Balanced weights n / (classes * n_class); the class counts are one small aggregate."""
    counts = df.agg(
        F.struct(
            F.count("*").cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("pos")
        ).alias("s")
    ).scalar()
    share = F.when(F.col(label) == 1, counts["pos"]).otherwise(counts["n"] - counts["pos"])
    return df.withColumn(weight, F.coalesce(counts["n"] / (F.lit(2e0) * F.nullif(share, F.lit(0e0))), F.lit(1e0)))


def _totals(df: DataFrame, score: str, label: str) -> DataFrame:
    """Counts of rows (`n`) and of real positives (`pos`) per distinct score, with their running totals; one read of the rows."""
    positive = F.coalesce(F.sum((F.col(label) == 1).cast("bigint")), F.lit(0))
    return running_totals(df.select(F.col(score).cast("double").alias("_s"), label), "_s", {"n": F.count("*"), "pos": positive})


def _auc(r2: Column, positives: Column, rows: Column) -> Column:
    """From twice the rank sum of the positives; 0.5 with one class."""
    p, q = positives.cast("double"), (rows - positives).cast("double")
    return F.coalesce((r2.cast("double") / 2e0 - p * (p + 1e0) / 2e0) / F.nullif(p * q, F.lit(0e0)), F.lit(0.5))


def roc_auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under the ROC curve by rank sums with average ranks for ties; 0.5 with one class. Rows without a score have no rank."""
    sums = _totals(df, score, label).agg(_rank_sum().alias("r2"), F.sum("pos").alias("p"), F.sum("n").alias("n"))
    return sums.select(_auc(F.col("r2"), F.col("p"), F.col("n")).alias("roc_auc"))


def _rank_sum() -> Column:
    """Twice the rank sum of the positives: the mean rank of a group of ties ending at cum_n is cum_n - (n - 1) / 2."""
    return F.sum((F.col("pos") * (F.lit(2) * F.col("cum_n") - F.col("n") + F.lit(1))).cast("decimal(38,0)"))


def classifier_metrics(df: DataFrame, probability: str = "theft_probability", label: str = "is_theft", cut: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall, F1 at the cut, ROC-AUC and the row count, as one row, all from the counts per distinct score."""
    hit = F.col("_s") >= cut
    negative = F.col("n") - F.col("pos")
    count = lambda where, column: F.coalesce(F.sum(F.when(where, column)), F.lit(0))
    counts = _totals(df.where(F.col(label).isNotNull()), probability, label).agg(
        count(hit, F.col("pos")).alias("tp"),
        count(hit, negative).alias("fp"),
        count(~hit, F.col("pos")).alias("fn"),
        count(~hit, negative).alias("tn"),
        _rank_sum().alias("_r2"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))

    def share(num: Column, den: Column) -> Column:
        return F.coalesce(num / F.nullif(den, F.lit(0e0)), F.lit(0e0))

    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(
        "tp",
        "fp",
        "fn",
        "tn",
        rows.alias("rows"),
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(2e0 * tp, 2e0 * tp + fp + fn).alias("f1_score"),
        _auc(F.col("_r2"), F.col("tp") + F.col("fn"), rows).alias("roc_auc"),
    )
