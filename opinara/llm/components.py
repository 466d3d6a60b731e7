"""Connected components of a link table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinara.llm.common import keep_table, shuffled


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the smallest node it can reach.

    Each round takes the smallest label among the neighbours, then the label of
    that label, so long chains shorten by more than half; it ends when no label
    moves. Every round is read again from files, which cuts its lineage and
    gives Spark their size: a checkpoint hands on the estimate of its plan, the
    product of all joined tables, a number that each round would double the
    digits of, until the driver plans for longer than the tasks run. Nodes meet
    in aggregates with partial sums and in joins that Spark can split, never in
    one group.
    Each node is a neighbour of its own, so one aggregate also finds its old
    label. The result is stored; keeping it again is of no use.
    """
    ends = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x in "ab" for y in "ab"])
    both = keep_table(links.select(F.explode(ends).alias("end")).select("end.a", "end.b").distinct())
    # Not stored: one aggregate of a stored table, which only the first round reads.
    labels = both.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    moved = True
    while moved:
        stepped = both.join(shuffled(labels), F.col("b") == F.col("node")).groupBy("a").agg(
            F.max(F.when(F.col("a") == F.col("b"), F.col("root"))).alias("old"), F.min("root").alias("root")
        )
        # A root is a node too; its own label at the round's start is as good a jump as any later one.
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = keep_table(stepped.join(shuffled(jump), "root", "left").select(F.col("a").alias("node"), "old", F.least("root", "far").alias("root")))
        moved = not after.filter("root < old").isEmpty()
        labels = after.select("node", "root")
    return labels
