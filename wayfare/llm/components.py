"""Connected components of a table of links, by stars.

Each round hangs every node of a component on ever smaller nodes: first all larger neighbours of a
node on its smallest neighbour, then all smaller ones. The number of links never grows. It ends
when every node has one link at most to a smaller one, and that leads to a node without any.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.text import stored


def connected(links: DataFrame) -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    ``links`` has two columns of one ordered type. Links with a null end and of a node to itself
    count for nothing. A node with very many neighbours is a group of one minimum per task, and a
    skewed join that Spark may split: both sides of every join are stored tables.
    """
    a, b = links.columns
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where("u > v")
        .distinct(),
        "links",
    )
    while True:
        both = edges.union(edges.select("v", "u"))
        least = stored(
            both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "nearest"
        )
        up = stored(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "links",
        )
        least = stored(up.groupBy("u").agg(F.min("v").alias("m")), "nearest")
        down = (
            up.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v")
            .union(least)
            .distinct()
        )
        edges = stored(down, "links")
        inner = edges.select(F.col("v").alias("u")).distinct().join(edges, "u", "left_semi")
        # A node on two roots joins them: another round must hang one on the other.
        forked = edges.groupBy("u").count().where("count > 1")
        if inner.isEmpty() and forked.isEmpty():
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.toDF("node", "component").union(roots)
