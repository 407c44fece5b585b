"""Places in an order, counted on from task to task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import written


def in_order(rows: DataFrame, groups: list[str], order: list[Column | str], name: str) -> DataFrame:
    """The rows with ``pos``: their place from 1 in their group, in the given order.

    Rows are dealt by ranges of groups and order, so a group with any share of them spreads over many
    tasks, and no task holds one. Ids that count up within a task give places there; a group that
    goes on in the next task goes on counting. Which of rows alike in groups and order is first is
    open, but all are counted. Groups must not be null.
    """
    spread = [*groups, *order]
    dealt = rows.repartitionByRange(*spread).sortWithinPartitions(*spread)
    dealt = written(dealt.withColumn("at", F.monotonically_increasing_id()), name)
    # the number of the task is in the bits from the 33rd on
    dealt = dealt.withColumn("task", F.shiftright("at", 33))
    runs = dealt.groupBy("task", *groups).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    runs = written(runs, "runs")
    several = runs.groupBy(*groups).agg(F.count("*").alias("tasks")).where("tasks > 1").select(*groups)
    # a group is cut by the borders of tasks only, so these are few rows, whatever the table
    before = Window.partitionBy(*groups).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        runs.join(several, groups)
        .withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select("task", *groups, "earlier")
    )
    begins = runs.join(earlier, ["task", *groups], "left").select(
        "task", *groups, (F.col("first") - F.coalesce("earlier", F.lit(0))).alias("begin")
    )
    begins = written(begins, "run-begins")
    placed = dealt.join(begins, ["task", *groups])
    return placed.withColumn("pos", F.col("at") - F.col("begin") + 1).drop("at", "task", "begin")
