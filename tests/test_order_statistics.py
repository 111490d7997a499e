"""Digits, exact quantiles, AUC and distribution drift against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.operators.drift import distribution_drift
from meterlake.operators.theft import classifier_metrics, roc_auc
from meterlake.plans import radix


def values_of(seed):
    rng = random.Random(seed)
    out = [rng.choice([0.0, -0.0, 1.0, 2.0, 0.5, 1e-310, -1e-310, 5e-324, 1e300, -1e300, math.inf, -math.inf]) for _ in range(60)]
    out += [rng.gauss(0, 1) * 10 ** rng.randint(-20, 20) for _ in range(300)]
    out += [2.0 ** rng.randint(-1074, 1023) * rng.choice([1, -1]) for _ in range(100)]
    base = rng.random()
    for _ in range(200):  # neighbours
        base = math.nextafter(base, 2.0)
        out.append(base)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_digits_rise_with_the_value(spark, seed):
    df = spark.createDataFrame([(v,) for v in values_of(seed)], "v double")
    for bits in (6, radix.BITS):
        rows = df.select("v", radix.digit(F.col("v"), bits).alias("a"), radix.finer_digit(F.col("v"), bits).alias("b")).collect()
        rows.sort(key=lambda r: r.v)
        codes = [(r.a, r.b) for r in rows]
        assert codes == sorted(codes)
    odd = spark.createDataFrame([(None,), (math.nan,), (math.inf,)], "v double").select(radix.digit(F.col("v")).alias("d")).collect()
    assert odd[0].d is None and odd[1].d > odd[2].d


@pytest.mark.parametrize("p", [0.0, 0.03, 0.5, 0.85, 0.97, 1.0])
def test_quantiles_are_exact(spark, p):
    for seed in range(2):
        values = [v for v in values_of(seed) if math.isfinite(v) and abs(v) < 1e299]
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(3)
        assert radix.exact_quantile(df, "v", p).first()["quantile"] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-320)
    assert radix.exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", p).first()["quantile"] is None
    assert radix.exact_quantile(spark.createDataFrame([(7.5,)], "v double"), "v", p).first()["quantile"] == 7.5


def test_a_hot_value_and_few_values_take_no_window_over_rows(spark):
    # 2 M rows of 200 values, half of them one value.
    df = spark.range(2_000_000, numPartitions=8).select(F.when(F.col("id") % 2 == 0, F.lit(0.25)).otherwise((F.col("id") % 199) / 199.0).alias("v"))
    ids = np.arange(2_000_000)
    expected = np.where(ids % 2 == 0, 0.25, (ids % 199) / 199.0)
    for p in (0.2, 0.85):
        assert radix.exact_quantile(df, "v", p).first()["quantile"] == np.quantile(expected, p)
    totals = radix.running_totals(df, "v", {"n": F.count("*")}).orderBy("v").collect()
    assert len(totals) <= 200 and totals[-1].cum_n == 2_000_000
    assert all(b.cum_n == a.cum_n + b.n for a, b in zip(totals, totals[1:], strict=False))


def test_running_totals_keep_groups_apart(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([None, *[rng.gauss(0, 1) for _ in range(3)], 1.0, 2.0])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.v): r.cum_n for r in radix.running_totals(df, "v", {"n": F.count("*")}, ["g"]).collect()}
    assert got == {(g, v): sum(h == g and w is not None and w <= v for h, w in rows) for g, v in set(rows) if v is not None}


def test_auc_and_metrics_match_pairs(spark):
    rng = random.Random(6)
    rows = [(round(rng.random(), rng.choice([1, 2, 9])), int(rng.random() < 0.3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, y int").repartition(4)
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert roc_auc(df, "s", "y").first()["roc_auc"] == pytest.approx(auc, abs=1e-12)
    row = classifier_metrics(df, "s", "y", 0.5).first()
    tp, fp = sum(s >= 0.5 for s in pos), sum(s >= 0.5 for s in neg)
    assert (row.tp, row.fp, row.fn, row.tn, row.rows) == (tp, fp, len(pos) - tp, len(neg) - fp, 400)
    assert row.precision == tp / (tp + fp) and row.recall == tp / len(pos) and row.roc_auc == pytest.approx(auc, abs=1e-12)
    for one in (0, 1, None):
        few = classifier_metrics(spark.createDataFrame([(0.7, one)], "s double, y int"), "s", "y").first()
        assert few.roc_auc == 0.5 and few.rows == (one is not None)


def ks_by_hand(old, new):
    points = sorted(set(old) | set(new))
    gaps = [abs(sum(x <= v for x in old) / len(old) - sum(x <= v for x in new) / len(new)) for v in points]
    bins = {}
    for v in points:
        k = min(sum(x < v for x in old) * 10 // len(old), 9)
        o, n = bins.get(k, (0, 0))
        bins[k] = (o + old.count(v), n + new.count(v))
    psi = 0.0
    for o, n in bins.values():
        p, q = max(o / len(old), 1e-4), max(n / len(new), 1e-4)
        psi += round((q - p) * math.log(q / p) * 1e9)
    return round(max(gaps), 6), round(psi / 1e9, 6)


def test_drift_refines_what_may_hold_the_greatest_gap(spark):
    rng = random.Random(8)
    old = [(rng.gauss(0, 1), 1.0 + rng.random() * 1e-6, rng.choice([1, 2, 3]), 5.0, rng.choice([None, 1.0])) for _ in range(300)]
    new = [(rng.gauss(0.2, 1), 1.0 + rng.random() ** 2 * 1e-6, rng.choice([2, 3, 9]), 5.0, 2.0) for _ in range(250)]
    schema = "a double, narrow double, few int, same double, `gone` double"
    result = distribution_drift(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema))
    got = {r.feature: (r.ks, r.psi) for r in result.collect()}
    for i, name in enumerate(("a", "narrow", "few", "same", "gone")):
        left, right = ([float(r[i]) for r in rows if r[i] is not None] for rows in (old, new))
        assert got[name] == pytest.approx(ks_by_hand(left, right), abs=2e-6), name
