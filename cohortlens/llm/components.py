"""Connected components of a link table, by joins and aggregations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.sources.scratch import written

#: Rounds after which the iteration is given up; each one at least halves the longest chain of labels.
_MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) with a != b gives (node, component) with the smallest reachable node, for all linked nodes.

    Alternates the large-star and small-star steps: every node hands its smallest neighbour to its larger neighbours,
    then to its smaller ones, until each node points at the smallest node of its component. Each round is written to
    the shared folder, so a lost executor costs one round at most. Minima are aggregated before they are joined back,
    and a hub's rows are split by adaptive execution. No links give an empty table.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    for _ in range(_MOST_ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        changed = after.exceptAll(edges).limit(1).count()
        edges = after
        if not changed:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) after further links (a, b): only the components that a link joins are looked at again."""
    own = labels.select(F.col("node").alias("a"), F.col("component").alias("x"))
    other = labels.select(F.col("node").alias("b"), F.col("component").alias("y"))
    between = links.join(own, "a", "left").join(other, "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b"))
    joined = written(components(between), "joined")
    again = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("lower")), "component", "left")
    new = joined.join(labels, "node", "left_anti").select("node", "component")
    return again.select("node", F.coalesce("lower", "component").alias("component")).unionByName(new)
