"""Connected components of a link table, as Spark joins (no collected group)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import staged
from strata.sinks.staging import stage_observed


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """Staged ``(node, label)`` for every node of ``links`` (columns ``a``, ``b``).

    ``label`` is the smallest node of the component. Each step takes the
    smallest label of the neighbours, passes it on to the label's own node and
    shortens the path by one jump, so the steps grow with the logarithm of the
    longest path. Every step is written to the shared folder.
    """
    both = staged(spark, links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = staged(spark, both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        step = staged(spark, labels.join(near, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")), "labels")
        # the label's own node takes the least label that any of its nodes has seen, and all follow it there
        hook = step.groupBy(F.col("old").alias("label")).agg(F.min("label").alias("hook"))
        own = step.select(F.col("node").alias("label"), F.col("label").alias("own"))
        far = own.join(hook, "label", "left").select("label", F.least("own", F.coalesce("hook", "own")).alias("far"))
        new = step.join(far, "label", "left").select(
            "node", F.least("label", F.coalesce("far", "label")).alias("label"), "old")
        out, seen = stage_observed(spark, new, "labels", {
            "changed": F.count_if(F.col("old") != F.col("label"))})
        labels = out.select("node", "label")
        if not seen["changed"]:
            return labels
