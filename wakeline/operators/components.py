"""Connected components by contraction.

Every round each vertex hooks to its smallest neighbour, the hook chains are
halved until every vertex points at its root, and the edges are rewritten
between roots. A round leaves at most half of the vertices that still have an
edge, so the number of rounds is logarithmic and there is no cap. All steps are
map-side combined minima and joins against a table with one row per vertex, so
a vertex with a third of all edges is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.scratch import Scratch


def _roots(scratch: Scratch, parent: DataFrame) -> DataFrame:
    """Point every node of ``parent`` (node, up, done) at the end of its chain."""

    while parent.filter("NOT done").limit(1).count():
        up = parent.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        step = parent.join(up, "up", "left").select(
            "node", F.coalesce("up2", "up").alias("up"), (F.coalesce("up2", "up") == F.col("up")).alias("done")
        )
        nxt = scratch.write(step, "jump")
        scratch.drop(parent)
        parent = nxt
    return parent


def connected_components(spark: SparkSession, edges: DataFrame, name: str = "components") -> DataFrame:
    """Label the vertices of ``edges`` (a, b: any one orderable type).

    Returns (node, root): one row per vertex that has an edge to another
    vertex; root is the smallest vertex of its component. Self loops, repeated
    and reversed edges and nulls are allowed; vertices with no edge are not
    returned. An empty table gives an empty result.
    """

    scratch = Scratch(spark, name)
    cur = scratch.write(
        edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    label: DataFrame | None = None
    while label is None or cur.limit(1).count():
        both = cur.union(cur.select("b", "a"))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("up"), F.lit(False).alias("done"))
        roots = _roots(scratch, scratch.write(hook, "hook")).select("node", "up")
        ra = roots.select(F.col("node").alias("a"), F.col("up").alias("ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("up").alias("rb"))
        step = cur.join(ra, "a").join(rb, "b").filter("ra <> rb").select(
            F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct()
        nxt = scratch.write(step, "edges")
        scratch.drop(cur)
        cur = nxt
        if label is None:
            label = roots.select("node", F.col("up").alias("root"))
        else:
            more = roots.select(F.col("node").alias("root"), F.col("up").alias("top"))
            label = scratch.write(
                label.join(more, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "label")
    return label
