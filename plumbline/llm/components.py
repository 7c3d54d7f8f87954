"""Connected components by repeated star contraction on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumbline.llm.tables import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node`` and ``label`` (least node of its component) for every node with a link.

    ``links`` has columns ``a`` and ``b``; order, loops and repeats do not
    matter. Every round first hangs the larger neighbours of a node on its
    least neighbour, then the smaller ones; both keep what is connected, and
    the rounds end when nothing changes. Each round is stored, so a lost
    executor repeats one round at most. No group is ever collected: a star
    with many leaves is many rows with one key, reduced by a minimum.
    """
    edges = stored(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )

    def measure(rows: DataFrame) -> tuple:
        # Sums of hashes wrap in decimals, not in 64 bits; order does not matter.
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = measure(edges)
    for _ in range(most_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        large = large.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        centre = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(centre, "u")
        small = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(centre.select("u", F.col("m").alias("v"))).distinct(), "links")
        now = measure(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
