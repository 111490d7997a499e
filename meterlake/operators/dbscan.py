"""Exact density clustering without comparing all points.

The points are cut into parts by a k-d tree, and each part also receives the points within twice `eps` of its box: so it knows which points
within `eps` are core, clusters its own points in arrays, and says which clusters the core points at its edges belong to. Parts' clusters
that share a core point are one; that union is taken once, over clusters, not points.

Where points crowd, as they do in many dimensions, what is near a part is nearly everything. Then parts keep their own points only, and pairs
of parts within `eps` of each other settle the rest: counts of points that are not core by their own part, and ties of clusters.
"""

from __future__ import annotations

import functools
import operator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators.density_parts import Blocks, cluster_part, least_near, near_counts, point_gaps, squared, ties
from meterlake.plans.ranges import in_order
from meterlake.plans.session import cut_lineage


#: Pairs of points that a task compares at once: it bounds memory.
PAIR_LIMIT = 1 << 16


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest node id (`label`) of the component of every node.

    Every round takes the smallest label of the neighbours and then jumps to that label's own label,
    so long chains halve; it ends when no label changes.
    """
    both = cut_lineage(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = cut_lineage(nodes.select("unit", F.col("unit").alias("label")))
    while True:
        heard = (
            both.join(labels, both["b"] == labels["unit"])
            .groupBy("a")
            .agg(F.min("label").alias("heard"))
        )
        met = labels.join(heard, labels["unit"] == heard["a"], "left").select(
            "unit", "label", F.least("label", F.coalesce("heard", "label")).alias("lower")
        )
        roots = met.select(F.col("unit").alias("_root"), F.col("lower").alias("_jump"))
        jumped = met.join(roots, met["lower"] == roots["_root"], "left").select(
            "unit", "label", F.least("lower", F.coalesce("_jump", "lower")).alias("next")
        )
        step = cut_lineage(jumped)
        if step.where(F.col("next") != F.col("label")).limit(1).count() == 0:
            return step.select("unit", "label")
        labels = step.select("unit", F.col("next").alias("label"))


#: Points that a part is meant to hold, and that it may hold together with those near it; beyond, all go by boxes.
PART_POINTS, MOST_POINTS = 20_000, 60_000
#: Parts where points crowd: pairs of them are compared, so that a point goes to this many tasks at most, and the pairs share the work.
CROWDED_PARTS = 32
#: Sampled points that parts are cut by: it bounds the number of parts, and tells how even they are, never what the result is.
SPLIT_SAMPLE = 65_536


def _split_parts(points: DataFrame, dims: list[str], rows: int, parts: int | None = None) -> list[tuple]:
    """A k-d tree: inner nodes (axis, cut, left, right), leaves (part,)."""
    parts = parts or min(-(-rows // PART_POINTS), SPLIT_SAMPLE // 16)
    if parts == 1:
        return [(0,)]
    rate = max(1, rows // SPLIT_SAMPLE)
    sample = points.where(F.pmod(F.xxhash64("id"), F.lit(rate)) == 0).select(*dims).limit(4 * SPLIT_SAMPLE).toPandas().to_numpy()
    tree: list[tuple] = [()]
    work, leaves = [(0, sample, parts)], 0
    while work:
        at, held, n = work.pop()
        widths = held.max(0) - held.min(0) if len(held) else np.zeros(1)
        axis = int(np.argmax(widths))
        cut = float(np.quantile(held[:, axis], (n // 2) / n)) if n > 1 and widths[axis] > 0 else None
        below = held[:, axis] < cut if cut is not None else None
        if cut is None or not below.any() or below.all():
            tree[at] = (leaves,)
            leaves += 1
            continue
        tree[at] = (axis, cut, len(tree), len(tree) + 1)
        work += [(len(tree), held[below], n // 2), (len(tree) + 1, held[~below], n - n // 2)]
        tree += [(), ()]
    return tree


def _deal(points: DataFrame, dims: list[str], tree: list[tuple], eps: float) -> DataFrame:
    """Every point for its own part, and for all parts whose box is within twice eps (`close`: within eps)."""
    shared = points.sparkSession.sparkContext.broadcast(tree)
    kind = points.schema["id"].dataType
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("id", kind), *[T.StructField(c, T.DoubleType()) for c in dims]])
    schema = schema.add("own", "boolean").add("close", "boolean")

    def run(frames):
        for frame in frames:
            values = frame[dims].to_numpy()
            work = [(0, np.arange(len(frame)), np.ones(len(frame), bool), np.zeros((len(frame), len(dims))))]
            while work:
                at, rows, own, gap = work.pop()
                node = shared.value[at]
                if len(node) == 1:
                    out = frame.iloc[rows].copy()
                    out.insert(0, "part", node[0])
                    yield out.assign(own=own, close=squared(gap) <= eps * eps)[schema.names]
                    continue
                axis, cut, left, right = node
                here = values[rows, axis]
                for child, inside, beyond in ((left, here < cut, here - cut), (right, here >= cut, cut - here)):
                    far = gap.copy()
                    far[:, axis] = np.where(inside, gap[:, axis], np.maximum(gap[:, axis], beyond))
                    keep = squared(far) <= 4 * eps * eps
                    if keep.any():
                        work.append((child, rows[keep], (own & inside)[keep], far[keep]))

    return points.mapInPandas(run, schema)


def _in_parts(dealt: DataFrame, dims: list[str], eps: float, min_points: int) -> DataFrame:
    """id, dbscan_cluster, is_core: clusters of the parts, tied together once by the core points that several parts see."""
    kind = dealt.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("label", kind)]).add("core", "boolean").add("own", "boolean")

    def run(frame):
        rows = cluster_part(frame[dims].to_numpy(), frame["id"].to_numpy(), frame["own"].to_numpy(), frame["close"].to_numpy(), eps, min_points)
        return pd.DataFrame(rows, columns=schema.names)

    found = cut_lineage(dealt.groupBy("part").applyInPandas(run, schema))
    cores = found.where("core")
    labels = cores.select(F.col("label").alias("unit")).distinct()
    both = cores.groupBy("id").agg(F.min("label").alias("a"), F.collect_set("label").alias("all"))
    same = both.where(F.size("all") > 1).select("a", F.explode("all").alias("b")).where("a <> b")
    roots = connected_components(labels, same) if not same.isEmpty() else labels.select("unit", F.col("unit").alias("label"))
    numbered = in_order(roots.select("label").distinct(), "label").select(F.col("label").alias("_root"), F.col("place").cast("int").alias("number"))
    numbers = roots.join(numbered, F.col("label") == F.col("_root")).select(F.col("unit").alias("_unit"), "number")
    return (
        found.where("own")
        .join(numbers, F.col("label") == F.col("_unit"), "left")
        .groupBy("id")
        .agg(F.coalesce(F.min("number"), F.lit(-1)).alias("dbscan_cluster"), F.max(F.col("core").cast("int")).alias("is_core"))
    )


def _by_pairs(points: DataFrame, dims: list[str], rows: int, eps: float, min_points: int) -> DataFrame:
    """id, dbscan_cluster, is_core: parts without their surroundings; what one part cannot know it asks the parts within eps, a pair at a time.

    A part counts neighbours among its own points. Points that are not core by these alone are counted in the other parts as well. Then each
    part clusters its core points, pairs of parts say which of their clusters touch, and the other points take the least cluster number among
    the core points near them. Only boxes of parts (few) come to the driver.
    """
    width, pairs = len(dims), PAIR_LIMIT
    parts = max(1, min(CROWDED_PARTS, -(-rows // max(1, PART_POINTS // 4))))
    tree = _split_parts(points, dims, rows, parts)
    own = _deal(points, dims, tree, 0.0).where("own").select("part", "id", *dims)
    own = cut_lineage(own.withColumn("row", F.monotonically_increasing_id()))
    xs = ", ".join(f"{x} double" for x in dims)

    def boxes(held: DataFrame):
        """Part numbers, and corners of their tight boxes."""
        found = held.groupBy("part").agg(*[F.min(x).alias(f"lo_{x}") for x in dims], *[F.max(x).alias(f"hi_{x}") for x in dims]).collect()
        table = np.array([list(r) for r in found], dtype=float).reshape(-1, 1 + 2 * width)
        return table[:, 0].astype(int), table[:, 1 : 1 + width], table[:, 1 + width :]

    def send(held: DataFrame, number: str, to, itself: bool) -> DataFrame:
        """(part, row, number) with the point for every part whose box is within eps, its own one too if asked; `home` is its own."""
        names, low, high = to

        def run(frames):
            for frame in frames:
                near = point_gaps(frame[dims].to_numpy(), low, high) <= eps * eps
                if not itself:
                    near &= frame["home"].to_numpy()[:, None] != names[None, :]
                i, j = np.nonzero(near)
                out = frame.iloc[i].copy()
                out.insert(0, "part", names[j])
                yield out

        return held.select(F.col("part").alias("home"), "row", F.col(number).cast("bigint").alias(number), *dims).mapInPandas(
            run, f"part int, home int, row long, {number} long, {xs}"
        )

    # Neighbours in the own part.
    def count_own(frame):
        blocks = Blocks(frame[dims].to_numpy(), eps)
        counts = np.empty(len(frame), np.int64)
        counts[blocks.order] = blocks.neighbours()
        return pd.DataFrame({"row": frame["row"], "part": frame["part"], "n": counts}).join(frame[dims])

    counted = cut_lineage(own.select("part", "row", *dims).groupBy("part").applyInPandas(count_own, f"row long, part int, n long, {xs}"))

    # The others', where they can make a point core.
    def count_there(asking, held):
        if not len(asking) or not len(held):
            return pd.DataFrame({"row": [], "n": []}).astype("int64")
        return pd.DataFrame({"row": asking["row"], "n": near_counts(asking[dims].to_numpy(), held[dims].to_numpy(), eps, pairs)})

    asking = send(counted.where(F.col("n") < min_points), "n", boxes(counted), False)
    more = asking.groupBy("part").cogroup(own.select("part", *dims).groupBy("part")).applyInPandas(count_there, "row long, n long")
    raised = more.groupBy("row").agg(F.sum("n").alias("_more"))
    total = F.col("n") + F.coalesce("_more", F.lit(0))
    flagged = counted.join(raised, "row", "left").select("row", "part", *dims, (total >= min_points).alias("core"))

    # Clusters of each part's core points, named by part and place.
    def cluster_own(frame):
        core = frame["core"].to_numpy()
        label = np.full(len(frame), -1, np.int64)
        if core.any():
            blocks = Blocks(frame.loc[core, dims].to_numpy(), eps)
            here = np.empty(len(blocks.order), np.int64)
            here[blocks.order] = blocks.components(np.ones(len(blocks.order), bool)) + (int(frame["part"].iloc[0]) << 40)
            label[core] = here
        return frame[["row", "part", *dims]].assign(cluster=label)

    clustered = cut_lineage(flagged.groupBy("part").applyInPandas(cluster_own, f"row long, part int, {xs}, cluster long"))
    cores = clustered.where("cluster >= 0")
    corners = boxes(cores)

    # Clusters that touch, by pairs of parts; each side sends what is within eps of the other's box.
    def touch(frame):
        first = (frame["part"] < frame["home"]).to_numpy()
        a, b = frame[~first], frame[first]
        found = ties(a[dims].to_numpy(), a["cluster"].to_numpy(), b[dims].to_numpy(), b["cluster"].to_numpy(), eps, pairs) if len(a) and len(b) else []
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    met = send(cores, "cluster", corners, False).withColumns({"_low": F.least("part", "home"), "_high": F.greatest("part", "home")})
    edges = cut_lineage(met.groupBy("_low", "_high").applyInPandas(touch, "a long, b long").distinct())
    labels = cores.select(F.col("cluster").alias("unit")).distinct()
    roots = connected_components(labels, edges) if not edges.isEmpty() else labels.select("unit", F.col("unit").alias("label"))

    # Numbers by the smallest core id.
    ids = own.select("row", "id")
    known = cut_lineage(cores.join(roots, F.col("cluster") == F.col("unit")).select("row", "part", *dims, "label"))
    first = known.join(ids, "row").groupBy("label").agg(F.min("id").alias("_first"))
    numbers = in_order(first, "_first").select("label", F.col("place").alias("number"))
    numbered = cut_lineage(known.join(numbers, "label").select("row", "part", *dims, "number"))

    # The least number that reaches a point that is not core.
    def reach(asking, held):
        if not len(asking) or not len(held):
            return pd.DataFrame({"row": [], "number": []}).astype("int64")
        best = least_near(asking[dims].to_numpy(), held[dims].to_numpy(), held["number"].to_numpy(), eps, pairs)
        out = pd.DataFrame({"row": asking["row"], "number": best})
        return out[best < np.iinfo(np.int64).max]

    rest = clustered.where("cluster < 0")
    asking = send(rest, "cluster", corners, True)
    border = asking.groupBy("part").cogroup(numbered.select("part", *dims, "number").groupBy("part")).applyInPandas(reach, "row long, number long")
    outcome = numbered.select("row", "number", F.lit(1).alias("is_core")).unionByName(
        rest.select("row").join(border.groupBy("row").agg(F.min("number").alias("number")), "row", "left").select("row", "number", F.lit(0).alias("is_core"))
    )
    return ids.join(outcome, "row").select("id", F.coalesce("number", F.lit(-1)).cast("int").alias("dbscan_cluster"), "is_core")


def dbscan(df: DataFrame, columns: list[str], key: str, eps: float = 1.15, min_points: int | None = None) -> DataFrame:
    """Cluster number (-1 is noise) of every row, as (key, `dbscan_cluster`, `is_core`).

    Clusters are numbered by their smallest core key; a border point takes the smallest number among
    the clusters that reach it. `min_points` defaults to max(2, min(4, rows // 3)), and fewer than
    three rows are all noise, as are rows with a null or NaN coordinate.
    """
    rows = df.count()
    if rows < 3:
        return df.select(key, F.lit(-1).alias("dbscan_cluster"), F.lit(0).alias("is_core"))
    min_points = min_points or max(2, min(4, rows // 3))
    dims = [f"x{i}" for i in range(len(columns))]
    points = df.select(F.col(key).alias("id"), *[F.col(c).cast("double").alias(x) for c, x in zip(columns, dims)])
    placed = points.dropna(subset=dims)  # NaN too
    dealt = _deal(placed, dims, _split_parts(placed, dims, rows), eps)
    fullest = dealt.groupBy("part").count().agg(F.max("count")).first()[0] or 0
    # A part that many points crowd into whichever way it is cut: the same result by pairs of parts.
    found = _in_parts(dealt, dims, eps, min_points) if fullest <= MOST_POINTS else _by_pairs(placed, dims, rows, eps, min_points)
    missing = functools.reduce(operator.or_, [F.isnan(x) | F.col(x).isNull() for x in dims])
    noise = points.where(missing).select("id", F.lit(-1).alias("dbscan_cluster"), F.lit(0).alias("is_core"))
    return found.unionByName(noise).withColumnRenamed("id", key)
