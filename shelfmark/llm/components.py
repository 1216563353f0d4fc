"""Connected components of a link table, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.tables import staged


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round hangs every node's neighbours under the smallest of them (large star, then
    small star), by a minimum per node and a join, so a hub is never gathered. Rounds grow
    with the logarithm of the longest chain; each is a staged table. Links of a node with
    itself, repeated links and nulls are dropped.
    """
    edges = links.where("a <> b").selectExpr("greatest(a, b) AS u", "least(a, b) AS v").distinct()
    edges = staged(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) AS m")
        large = both.join(least, "u").where("v > u").selectExpr("v AS u", "m AS v")
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        hung = moved.unionByName(least.withColumnRenamed("m", "v"))
        edges = staged(hung.where("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.groupBy("v").agg(F.min("v").alias("root")).selectExpr("v AS node", "root")
    return edges.selectExpr("u AS node", "v AS root").unionByName(roots)
