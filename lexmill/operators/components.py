"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import stored, unstore


def _mark(df: DataFrame) -> tuple:
    r = df.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return tuple(r)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component) of every node of ``edges`` (undirected, null ends and loops ignored); component is the smallest node reachable.

    Each round is two joins on node keys, whose hub side AQE may split, and ends in a written table, so that neither
    lineage nor any single task grows with a component. Nodes without an edge to another node are not returned; an empty input gives no rows.
    Raises where ``max_rounds`` do not suffice; what is not finished is never returned.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    e = stored(e, "cc")
    mark = _mark(e)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        # written, so that the join below has an exchange on either side and AQE may split the rows of a hub
        least = stored(e.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m")), "least")
        large = e.join(least, e["v"] == F.col("x"), "left").select("u", F.coalesce("m", "v").alias("v")).distinct()
        lows = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lows, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(lows.select("u", F.col("m").alias("v"))).distinct()
        nxt = stored(small, "cc")
        now = _mark(nxt)
        unstore(e)
        unstore(least)
        e = nxt
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components are not complete after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
