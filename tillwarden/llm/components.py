"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwarden.llm.shared import written


def _toward_minimum(edges: DataFrame, both_ways: bool) -> DataFrame:
    """One step: each node's neighbours are linked with the least of them.

    ``both_ways`` links larger neighbours (a large step), else smaller ones (a small step).  The
    least neighbour combines on the map side, so a hub of any size is one row of that side.
    """
    if both_ways:
        pairs = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    low = F.least("low", "node")
    joined = pairs.join(least, F.col("a") == F.col("node"))
    if both_ways:
        moved = joined.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), low.alias("b"))
    else:
        moved = joined.select(F.explode(F.array("a", "b")).alias("a"), low.alias("b"))
    return moved.filter(F.col("a") != F.col("b")).distinct()


def joined_components(labels: DataFrame, links: DataFrame, name: str = "components") -> DataFrame:
    """Labels from ``components`` after further links (a, b), a written table.

    Only the links' own components take part: links are drawn between component ids, which are then
    renamed, so the work follows the new links and one pass over the labels.
    """
    if links.isEmpty():
        return labels
    ends = links
    for side in ("a", "b"):
        known = labels.select(F.col("doc_id").alias("node"), F.col("component_id").alias("comp"))
        ends = ends.join(known, F.col(side) == F.col("node"), "left").withColumn(side, F.coalesce("comp", side))
        ends = ends.drop("node", "comp")
    renamed = components(ends, name).select(F.col("doc_id").alias("old"), F.col("component_id").alias("new"))
    kept = labels.join(renamed, F.col("component_id") == F.col("old"), "left").select(
        "doc_id", F.coalesce("new", "component_id").alias("component_id")
    )
    # component ids that had no label of their own: documents without a link so far
    fresh = renamed.join(labels.select("doc_id"), F.col("old") == F.col("doc_id"), "left_anti")
    return written(kept.union(fresh.select("old", "new")), name)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(doc_id, component_id) of every node with an edge; the id is the least node reached.

    ``edges`` has two long columns a and b.  Alternates large and small steps over tables in
    the shared folder until they no longer change: O(log(n) ** 2) rounds, rows never exceed the
    number of edges and nodes.  No edges give no rows; self loops and repeated edges do no harm.
    """
    one_way = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(one_way.filter("a != b").distinct(), name)
    seen = None
    while True:
        now = written(_toward_minimum(_toward_minimum(now, True), False), name)
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return now.select(F.col("a").alias("doc_id"), F.col("b").alias("component_id")).union(
                now.select(F.col("b").alias("doc_id"), F.col("b").alias("component_id")).distinct()
            )
        seen = state
