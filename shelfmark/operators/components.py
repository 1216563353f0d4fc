"""Connected components of a table of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.staging import staging_dir, unsent, written


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b); root is the smallest node reachable.

    Each round a node takes the smallest root among its neighbours', then that root's own, so
    ways shorten by more than half. Minima are added up before they are shuffled, so a hub is
    never gathered. Rounds are tables below ``name`` in the staging folder.
    """
    spark = links.sparkSession

    def staged(df, step):
        return written(df, staging_dir(spark, f"{name}/{step}"))

    real = links.where("a <> b")
    edges = staged(real.select("a", "b").union(real.select("b", "a")).distinct(), "edges")
    roots = edges.groupBy("a").agg(F.min("b").alias("b")).selectExpr("a AS node", "least(a, b) AS root")
    roots, step = staged(roots, "roots-0"), 0
    while True:
        step += 1
        near = edges.join(unsent(roots.selectExpr("node AS b", "root")), "b").groupBy("a").agg(
            F.min("root").alias("near")
        ).withColumnRenamed("a", "node")
        taken = staged(
            roots.join(unsent(near), "node").selectExpr("node", "least(root, near) AS root", "root AS before"),
            f"taken-{step}",
        )
        jump = taken.selectExpr("node AS root", "root AS further")
        roots = staged(
            taken.join(unsent(jump), "root").selectExpr("node", "least(root, further) AS root", "before"),
            f"roots-{step}",
        )
        if roots.where("root <> before").isEmpty():
            return roots.select("node", "root")
        roots = roots.select("node", "root")
