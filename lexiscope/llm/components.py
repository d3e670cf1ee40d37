"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is written to the shared folder, so that a lost executor costs that round at most, and
no part of the graph is collected to the driver. Minima are pre-aggregated before the shuffle, and
the joins back to the edges can be split where one vertex has a large part of all edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiscope.llm.common import staged, with_totals


def _state(edges: DataFrame) -> tuple[int, int]:
    """Count and digest of distinct edges; a sum of hashes would overflow on long tables."""
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    return row[0], row[1] or 0


def star_components(edges: DataFrame) -> DataFrame:
    """(id, comp) for each vertex of edges (u long, v long): comp is the smallest vertex that it reaches."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = staged(e, "edges")
    state = _state(e)
    while True:
        both = e.union(e.select("v", "u"))
        large = with_totals(both, ["u"], "v", F.least(F.min("v"), F.first("u")).alias("m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        joined = with_totals(large, ["u"], "v", F.min("v").alias("m"))
        small = joined.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = staged(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        before, state = state, _state(e)
        if before == state:
            return e.select(F.col("u").alias("id"), F.col("v").alias("comp")).union(e.select("v", "v").distinct())
