"""Connected components of a link table by repeated hooking and contraction, all on the cluster.

Each round hooks every node to its smallest neighbour, halves the paths that arise, renames the links
by it and drops those within a node. A node's name only ever falls, and the smallest node of a
component keeps its own, so the last name is the smallest node. The rounds grow with the logarithm of
the number of links. Every table of a round is written to the shared folder: joins are between plain
tables there, so that AQE can split the links of a node that many others hang on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from setlake.llm.common import at_path, drop_scratch, materialise


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b; long, in any direction, repeats allowed) to (node, component) for every node that has a link to another."""
    edges = materialise(links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    names = None
    while edges.limit(1).count():
        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e")).select("e.*")
        hooked = materialise(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p")), "hooked")
        # the parent's parent; two halvings a round
        for _ in range(2):
            up = hooked.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            hooked, old = materialise(hooked.join(up, "p").select("u", F.col("pp").alias("p")), "halved"), hooked
            drop_scratch(old.sparkSession, old)
        a = hooked.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        b = hooked.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        renamed = edges.join(a, "a").join(b, "b").filter("pa <> pb")
        shrunk = materialise(renamed.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "links")
        if names is None:
            names, old = at_path(hooked.select(F.col("u").alias("node"), F.col("p").alias("component")), vars(hooked)["_scratch_path"]), []
        else:
            to = hooked.select(F.col("u").alias("component"), F.col("p").alias("to"))
            new = materialise(names.join(to, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "names")
            names, old = new, [hooked, names]
        drop_scratch(edges.sparkSession, edges, *old)
        edges = shrunk
    return names if names is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
