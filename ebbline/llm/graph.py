"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of ``edges`` (columns ``a`` and ``b``, long): equal roots are connected.

    Each round every node joins the one of its neighbours (itself included) that a hash of the round ranks first;
    edges between joined nodes go, the others move to the joined ones.  The hash makes the number of nodes shrink by
    a constant factor whatever their order, so a long chain takes as few rounds as a star.  Rounds are written to
    the shared folder.  Minima are combined before the shuffle and joins have one row per node on one side, so that
    a node with many links is no hot spot.  No edges give no rows; repeated, reversed and looping edges change
    nothing.
    """
    edges = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = stored(edges, "edges")
    ends = F.explode(F.array("a", "b"))
    found = edges.select(ends.alias("node")).distinct().withColumn("root", F.col("node"))
    turn = 0
    while not edges.isEmpty():
        turn += 1
        rank = lambda name: F.struct(F.xxhash64(F.col(name), F.lit(turn)), F.col(name).alias("at"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.least(F.min(rank("b")), F.min(rank("a")))
        chosen = both.groupBy("a").agg(first.alias("first"))
        joined = stored(chosen.select(F.col("a").alias("old"), F.col("first.at").alias("new")), "joined")
        found = stored(
            found.join(joined, F.col("root") == F.col("old"), "left")
            .select("node", F.coalesce("new", "root").alias("root")),
            "found",
        )
        left = joined.select(F.col("old").alias("a"), F.col("new").alias("na"))
        right = joined.select(F.col("old").alias("b"), F.col("new").alias("nb"))
        edges = stored(
            edges.join(left, "a").join(right, "b").where("na <> nb")
            .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(),
            "edges",
        )
    return found
