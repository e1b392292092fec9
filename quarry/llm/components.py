"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (or smaller) neighbours of each node u, and u, to the least of them all."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    near = both.join(least, "u")
    if large:
        out = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return out.where("u <> v")  # a row an edge at most, and one a node


def _unfinished(edges: DataFrame) -> bool:
    """Whether some node is not the centre or a leaf of one star. Edges lead down, so that each centre of a star is its least node."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    )
    nodes = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return nodes.agg(F.count_if((F.col("down") > 1) | ((F.col("down") > 0) & (F.col("up") > 0)))).first()[0] > 0


def components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of longs -> (node, label) of every node that has an edge; label is the least node it reaches.

    Each round is written to the shared folder. Rounds grow with the logarithm of the
    longest path; the loop ends as soon as the edges are stars, one for each component. A null
    end has no component; repeated edges and loops change nothing; no edges give no rows.
    """
    spark = edges.sparkSession
    now, path = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    while _unfinished(now):
        new, new_path = written(_star(_star(now, True), False).distinct(), "components")
        remove(spark, path)
        now, path = new, new_path
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(centres)
