"""Connected components; ``stage`` and ``shared_dir`` stand here for the other modules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import shared_dir, stage  # noqa: F401


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (a, b); root is the smallest node of the component.

    Alternating large-star and small-star; windows keep each hub's neighbours in sorted, spillable partitions. No edges: no
    rows. Loops and repeated edges do no harm."""
    def kept(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        seen = Observation()
        out = stage(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), name)
        return out, (seen.get["n"], seen.get["h"])

    star, before = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    if not before[0]:
        return star.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(rounds):
        both = star.unionAll(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        small = low.select("u", F.col("m").alias("v")).unionAll(low.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        star, now = kept(small.where("u <> v").distinct(), "star")
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return star.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(star.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
