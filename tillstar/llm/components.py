"""Connected components of a table of links by repeated contraction: nothing is collected to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.scratch import temporary, written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (its component's smallest node) of every node in ``links`` (``a``, ``b``: long).

    Each round joins every node to its smallest neighbour and contracts what was joined, so a component at least halves;
    the rounds are written to the shared folder, and the number of rounds is the logarithm of the longest chain.
    """
    with temporary(links.sparkSession) as write:
        edges = write(links.where("a <> b").select("a", "b").distinct(), "links")
        names = edges.select(F.col("a").alias("node"), F.col("b").alias("label")).where("false")
        first = True
        while not edges.isEmpty():
            both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
            # the smallest neighbour may itself move to a smaller one: two hops a round
            hop = write(both.groupBy("a").agg(F.min("b").alias("m"))
                        .select(F.col("a").alias("node"), F.least("a", "m").alias("to")), "hops")
            hop = write(hop.join(hop.select(F.col("node").alias("to"), F.col("to").alias("label")), "to")
                        .select("node", "label"), "hops")
            left = hop.select(F.col("node").alias("a"), F.col("label").alias("x"))
            right = hop.select(F.col("node").alias("b"), F.col("label").alias("y"))
            edges = write(edges.join(left, "a").join(right, "b").where("x <> y")
                          .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
            if first:
                names, first = hop, False
            else:
                later = hop.select(F.col("node").alias("label"), F.col("label").alias("next"))
                names = write(names.join(later, "label", "left")
                              .select("node", F.coalesce("next", "label").alias("label")), "names")
        return written(names, "components")
