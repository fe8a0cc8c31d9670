"""Connected components of an edge list, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spectrail.llm._shared import tasks, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every node of an edge: the label is the smallest node reachable.

    Each round takes the least label among a node and its neighbours, hands it to the label that the node had
    before too, and then follows labels one step further; so components merge in a number of rounds that grows with the
    logarithm of a component, chains included. Tables are written to the shared folder; nothing is collected but whether a
    label changed. Minima are combined before the shuffle; a hub's or a large component's rows are a skewed join key of plain
    tables, which AQE splits. A shuffle's partitions are read by as many tasks as the edges need.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
    both = written(both.where("u <> v").distinct(), "edges")
    few = tasks(both.count())
    labels = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("label")).withColumnRenamed("u", "node").coalesce(few), "labels")
    while True:
        near = both.join(labels, F.col("v") == F.col("node")).select(F.col("u").alias("node"), "label", F.lit(None).cast("long").alias("old"))
        own = labels.select("node", "label", F.col("label").alias("old"))
        least = written(near.unionByName(own).groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")).coalesce(few), "least")
        if least.where("label < old").isEmpty():
            return labels
        up = least.select(F.col("node").alias("up"), F.col("label").alias("top")).unionByName(least.where("label < old").select(F.col("old").alias("up"), F.col("label").alias("top")))
        up = written(up.groupBy("up").agg(F.min("top").alias("top")).coalesce(few), "up")
        labels = written(least.join(up, F.col("label") == F.col("up")).select("node", F.least("label", "top").alias("label")).coalesce(few), "labels")
