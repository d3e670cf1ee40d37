"""Row numbers of a whole table without bringing it to one task."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiscope.staging import written


def numbered(df: DataFrame, *order: Column, groups: tuple[str, ...] = (), name: str = "number") -> DataFrame:
    """df with ``name``: the place of a row, from 1, in ``order``; with ``groups``, within its group.

    Rows are range-partitioned by group and order and numbered within their task; the rows of each
    task (and group) are counted, counts summed up over the tasks before, and the sum added. Rows
    that tie are spread over tasks too, so their order among each other is arbitrary; a null group is
    a group. The table is written to the shared folder on the way, so numbers stay the same when
    tasks run again.
    """
    keys = [F.col(g).asc_nulls_first() for g in groups] + [*order, F.col("_tie")]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    counts = placed.groupBy("_task", *groups).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    if not groups:  # a row for each task
        rows = {r["_task"]: r["_n"] for r in counts.collect()}
        sizes = [rows.get(k, 0) for k in range(max(rows, default=0) + 1)]
        before = F.get(F.lit([0, *accumulate(sizes)][:-1]).cast("array<long>"), F.col("_task").cast("int"))
        return placed.withColumn(name, F.col("_at") - F.shiftleft("_task", 33) + before + 1).drop("_at", "_task")
    earlier = Window.partitionBy(*groups).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    moves = counts.select("_task", *groups, (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_move"))
    moves = moves.withColumnsRenamed({g: f"_of_{g}" for g in groups} | {"_task": "_of_task"})
    same = F.col("_task") == F.col("_of_task")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return placed.join(moves, same).withColumn(name, F.col("_at") + F.col("_move")).drop("_at", "_task", "_move", *moves.columns)
