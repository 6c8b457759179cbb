"""Connected components of a link table, as Spark jobs that alternate two star steps.

Large-star hangs every larger neighbour on the least one of a node's neighbourhood, small-star does so with the
smaller ones and the node itself. Both keep connectivity; the links end as one star per component. Each round is
written to the shared folder, so lineage stays short. A node with very many links only meets a minimum that
is computed map-side, and a join that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuebreaks.sources.staging import Stage


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger node ``a`` to the smaller ``b``."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def component_roots(links: DataFrame, stage: Stage) -> DataFrame:
    """``node, root`` for every node with a link, ``root`` the least node of its component.

    ``links`` has two columns of numbers; direction, repeats and loops do not matter.
    """
    first, second = links.columns
    pairs = links.select(F.greatest(first, second).alias("a"), F.least(first, second).alias("b"))
    pairs = stage.write(pairs.filter("a > b").distinct(), "links")
    state = None
    while True:
        starred = _small_star(_large_star(pairs).distinct()).distinct()
        pairs = stage.write(starred, "links")
        mark = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b") % 1000003)).first()
        if mark == state:
            break
        state = mark
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
