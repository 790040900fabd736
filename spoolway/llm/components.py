"""Connected components of a distributed edge list, by alternating stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import stored


def _turned(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node onto the node's smallest neighbour."""
    both = _turned(edges)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours onto the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
    moved = down.join(least, F.col("a") == F.col("n")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b, both long), root the least node reachable.

    Each round writes its edges to the shared folder, which cuts the lineage. A round
    aggregates before it joins, so a node with very many neighbours is met by partial
    minima and by a join whose skewed side Spark splits. The edges never leave the
    executors; only a count and a checksum do.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or tuple(seen) == mark:
            break
        mark = tuple(seen)
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "edges")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
