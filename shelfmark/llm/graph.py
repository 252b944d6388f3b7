"""Connected components of a graph given by its edges."""

from pyspark.sql import functions as F

from .scratch import stored


def components(edges, label="components"):
    """(`node`, `root`) for every node with an edge; the root is the smallest node reachable.

    `edges` has two columns of long ids. Alternates two steps until nothing changes: every node
    hands its larger neighbours to its smallest one, then its smaller ones. Both reduce to one
    minimum for each node, so that a node with very many edges is a partial minimum and a skewed
    join, never a list. The number of rounds grows with the logarithm of the longest path.
    """
    a, b = edges.columns
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = stored(links.filter("a <> b").distinct(), label)
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        links = stored(small.filter("a <> b").unionByName(own).distinct(), label)
        now = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 65521)).first()
        if now == before:
            break
        before = now
    own = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(own)
