"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """(node, root) of every node that has an edge (a, b); the root is the component's smallest node.

    ``start`` are components (node, root) found before: the new edges then only
    join these, and edges within one are left out. Each round every node goes to
    the first of itself and its neighbours, in an order drawn anew, and the edges
    to those between where their ends went: a share of the nodes is left, and
    fewer edges, so that all rounds together read few times the edges and their
    number grows with the logarithm of the nodes. The steps are then put
    together from the last round to the first.
    """
    pair = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    ends = pair.select("u").unionAll(pair.select("v")).distinct()
    if start is not None:
        for end in ("u", "v"):
            root = start.select(F.col("node").alias(end), F.col("root").alias("r"))
            pair = pair.join(root, end, "left").withColumn(end, F.coalesce("r", end)).drop("r")
    pair = pair.where("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    pair = stored(pair, "edges")
    steps: list[DataFrame] = []
    while not pair.isEmpty():
        both = pair.unionAll(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        first = F.min(F.struct(F.xxhash64("v", F.lit(len(steps))).alias("h"), F.col("v").alias("n")))
        own = F.struct(F.xxhash64("u", F.lit(len(steps))).alias("h"), F.col("u").alias("n"))
        steps.append(stored(both.groupBy("u").agg(first.alias("m")).select("u", F.least(own, "m")["n"].alias("l")), f"labels-{len(steps)}"))
        left = pair
        for end in ("u", "v"):
            left = left.join(steps[-1].select(F.col("u").alias(end), F.col("l").alias(f"l{end}")), end)
        left = left.where("lu != lv").select(F.least("lu", "lv").alias("u"), F.greatest("lu", "lv").alias("v")).distinct()
        left = stored(left, "edges")
        discard(pair)
        pair = left
    if not steps:  # no edges
        labels = pair.select("u", F.col("u").alias("l"))
    else:
        discard(pair)
        gone = steps[-1]
        for step in reversed(steps[:-1]):
            gone = step.join(gone.select(F.col("u").alias("l"), F.col("l").alias("g")), "l", "left").select("u", F.coalesce("g", "l").alias("l"))
        smallest = gone.groupBy("l").agg(F.min("u").alias("s"))
        labels = stored(gone.join(smallest, "l").select("u", F.col("s").alias("l")), "labels")
        discard(*steps)
    if start is None:
        return labels.select(F.col("u").alias("node"), F.col("l").alias("root"))
    nodes = start.unionAll(ends.join(start.select(F.col("node").alias("u")), "u", "left_anti").select("u", "u"))
    moved = labels.select(F.col("u").alias("root"), "l")
    roots = stored(nodes.join(moved, "root", "left").select("node", F.coalesce("l", "root").alias("root")), "roots")
    discard(labels)
    return roots
