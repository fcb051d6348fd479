"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweir.storage import drop_path, new_path, write_at


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) links of non-null longs to (node, root): root is the smallest node of the component.

    Each half-round writes the smallest neighbour of every node and joins it back to the
    links, both sides as scans, so that the engine can split a node with very many links.
    Rounds end when count and checksum of the links stay the same; links then form stars.
    Nodes without a link to another node are not in the result.
    """
    spark = edges.sparkSession

    def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
        path = new_path(spark, name)
        return write_at(df, path), path

    def star(pairs: DataFrame, large: bool) -> tuple[DataFrame, str]:
        """pairs (x, y) of neighbours; links the neighbours of each x to the smallest of them and x."""
        lowest, lowest_path = written(
            pairs.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "cc-lowest"
        )
        joined = pairs.join(lowest, "x")
        if large:
            links = joined.where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        else:
            links = joined.select(F.col("y").alias("u"), F.col("m").alias("v")).union(lowest.select("x", "m"))
        out = written(links.where("u != v").distinct(), "cc-links")
        drop_path(spark, lowest_path)
        return out

    def are_stars(links: DataFrame) -> bool:
        """Whether every node has one smaller neighbour or none, and nodes with one are nobody's smaller neighbour."""
        ends = links.select(F.col("u").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("above"))
        ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
        sums = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
        return not sums.where("below > 1 OR (below = 1 AND above = 1)").agg(F.count("n")).first()[0]

    links, path = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "cc-links"
    )
    while not are_stars(links):
        both = links.select(F.col("u").alias("x"), F.col("v").alias("y")).union(links.select("v", "u"))
        large, large_path = star(both, large=True)
        new, new_path_ = star(large.select(F.col("u").alias("x"), F.col("v").alias("y")), large=False)
        drop_path(spark, large_path)
        drop_path(spark, path)
        links, path = new, new_path_
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
