"""Connected components of a graph that is only ever held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import staged


def _open(links: DataFrame) -> bool:
    """Whether a node has two roots, or is a root and has one."""
    roles = links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("node"), F.col("b").alias("root")),
                F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("root")),
            )
        ).alias("x")
    )
    return not (
        roles.groupBy("x.node")
        .agg(
            F.min("x.root").alias("low"),
            F.max("x.root").alias("high"),
            F.count_if(F.col("x.root").isNull()).alias("is_root"),
        )
        .where("low <> high or (low is not null and is_root > 0)")
        .isEmpty()
    )


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``; the root is the
    smallest node that can be reached.

    Every node hangs its larger neighbours, then itself and its smaller ones,
    under the smallest node it knows, until all hang under a root: about the
    logarithm of the longest path many rounds. Each round groups before it
    shuffles, so that a node with very many links is one partial minimum per
    task, and is written down, so that a lost executor costs one round.
    """
    now = staged(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    while _open(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        up = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        up = up.distinct()
        least = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(least, "a")
        down = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = staged(
            down.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links"
        )
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
