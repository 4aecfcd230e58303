"""Connected components over an edge table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize, scope


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id of the edges (u, v), by alternating large and small stars.

    Minima are pre-aggregated and written before they are joined, so that Spark can split the
    edges of a hub, and every round is written to the shared folder. Null ends are left out.
    """
    ordered = lambda e: e.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    with scope(edges.sparkSession):
        now, mark = materialize(ordered(edges)), None
        while True:
            both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
            large = materialize(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
            low = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
            small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            now = materialize(ordered(small.union(low.select("u", F.col("m").alias("v")))))
            seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if seen == mark:
                return materialize(now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(now.select("v", "v").distinct()), keep=True)
            mark = seen
