"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerotrace.session import drop_staged, stage_table

#: Rows that a task of a step takes at least, on average.
TASK_ROWS = 1 << 12


def labels_of_others(links: DataFrame, rows: int | None = None, jumps: int = 2) -> DataFrame:
    """``links(a, b)`` (long ids) -> ``(node, component)`` for every linked
    node but the smallest of each component, where the component is the
    smallest id reachable.  ``rows``: at least as many as ``links`` has, where
    that is known.

    Each round lets every node adopt its smallest smaller neighbour, follows
    those pointers over ``2 ** jumps`` steps, relabels the links by the result
    and drops the links that became loops; it ends when no link is left.  All
    steps are aggregates and joins over tables of the size of the links, on no
    more tasks than the links left need; nothing is collected.  Null ends and loops are ignored; an empty table
    gives an empty result; repeated links count once.
    """
    files = lambda n: 1 + n // TASK_ROWS
    edges = stage_table(
        links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .where("a IS NOT NULL AND b IS NOT NULL AND lo <> hi").distinct(), "cc-links", None if rows is None else files(rows))
    left, labels, n_labels = edges.count(), None, 0
    if not left:
        return stage_table(edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")), "cc-labels", 1)
    while left:
        near = stage_table(edges.groupBy(F.col("hi").alias("id")).agg(F.min("lo").alias("parent")), "cc-parents", files(left))
        up = near.select(F.col("id").alias("parent"), F.col("parent").alias("above"))
        far = near
        for _ in range(2 ** jumps - 1):
            far = far.join(up, "parent", "left").select("id", F.coalesce("above", "parent").alias("parent"))
        parents = stage_table(far, "cc-parents", files(left))
        lo = parents.select(F.col("id").alias("lo"), F.col("parent").alias("lo2"))
        hi = parents.select(F.col("id").alias("hi"), F.col("parent").alias("hi2"))
        ends = (edges.join(hi, "hi", "left").join(lo, "lo", "left")
                .select(F.coalesce("lo2", "lo").alias("x"), F.coalesce("hi2", "hi").alias("y")).where("x <> y")
                .select(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).distinct())
        rest = stage_table(ends, "cc-links", files(left))
        drop_staged(edges, near)
        adopted = parents.select(F.col("id").alias("node"), F.col("parent").alias("component"))
        n_labels += left
        if labels is None:
            labels = stage_table(adopted, "cc-labels", files(n_labels))
        else:
            moved = labels.join(parents.withColumnRenamed("id", "component"), "component", "left").select(
                "node", F.coalesce("parent", "component").alias("component"))
            # long chains keep nodes that have a label in the links
            new = adopted.join(labels.select("node"), "node", "left_anti")
            old, labels = labels, stage_table(moved.unionByName(new), "cc-labels", files(n_labels))
            drop_staged(old)
        drop_staged(parents)
        edges, left = rest, rest.count()
    drop_staged(edges)
    return labels


def connected_components(links: DataFrame, jumps: int = 2) -> DataFrame:
    """``labels_of_others`` and, under its own id, the smallest node of each
    component: ``(node, component)`` for every linked node."""
    labels = labels_of_others(links, jumps=jumps)
    return labels.unionByName(labels.select(F.col("component").alias("node"), "component").distinct())
