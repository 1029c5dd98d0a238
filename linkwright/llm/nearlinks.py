"""From band keys to components of near-equal sets, in time linear in the group sizes.

A group of near copies may hold a third of all rows, so the members of a band's
bucket are never paired with each other.  Instead

1. each node is compared with one hub, the member of its buckets that shares the
   most buckets with other nodes (a group's least edited text), and verified links
   give first components;
2. only buckets that still hold several components are looked at again.  Two members
   of different components can be linked only if enough of their elements occur in
   another such text at all: |a & b| >= t / (1 + t) * (|a| + |b|), and |a & b| is
   at most the number of shared elements of either.  If both have the same hub, it is
   also at most what both share with the hub at most, and the rarer shared elements that
   the hub lacks.  Texts with random edits fail this, as what they changed occurs
   nowhere else; who passes is compared.

Step 2 has no cap: every pair that the bound and the bands allow is verified.
All operations are DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.common import drop, stage
from linkwright.llm.components import components

#: Buckets up to this many members are compared without the bound of step 2.
SMALL_BUCKET = 16


def enough(both: Column, total: Column, num: int, den: int) -> Column:
    """den * both >= num * (total - both): sets with so many elements in common are similar."""
    return (both > 0) & (den * both >= num * (total - both))


def itself(items: Column) -> Column:
    return items


def compared(pairs: DataFrame, sets: DataFrame, of=itself) -> DataFrame:
    """pairs (a, b) with x and y, their sets, and both, the number of common elements; sets: node, items.

    The set of a node is of(items), made after the joins, so that a short form travels.
    """
    left = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("x")), "a")
    right = left.join(sets.select(F.col("node").alias("b"), F.col("items").alias("y")), "b")
    right = right.withColumns({"x": of(F.col("x")), "y": of(F.col("y"))})
    return right.withColumn("both", F.size(F.array_intersect("x", "y")).cast("long"))


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, of=itself) -> DataFrame:
    """The pairs (a, b) whose sets are similar, exactly."""
    total = F.size("x").cast("long") + F.size("y").cast("long")
    return compared(pairs, sets, of).where(enough(F.col("both"), total, num, den)).select("a", "b")


def members(bands: DataFrame) -> DataFrame:
    """(key, node, size) of the buckets with at least two nodes; bands: key, node without repeats."""
    counts = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return bands.join(counts, "key")


def hubs(found: DataFrame) -> DataFrame:
    """(a, b) pairs: each node with the hub of its buckets, if that is another node."""
    weight = found.groupBy("node").agg(F.sum("size").alias("w"))
    weighed = found.join(weight, "node")
    best = weighed.groupBy("key").agg(F.max(F.struct("w", "node")).alias("top"))
    near = weighed.join(best, "key").where("node <> top.node")
    return near.groupBy("node").agg(F.max("top").alias("top")).select(F.col("node").alias("a"), F.col("top.node").alias("b"))


def leftovers(found, labels, sets, near, num: int, den: int, sketches=None, likely=None, of=itself, sizes=None) -> DataFrame:
    """(a, b) pairs of different components that a bucket and the bounds of step 2 allow, once each.

    near: node, hub, inhub (elements that the hub has too), novel (the others), and lacks (the hub's
    others), if pairs with one hub are to be compared exactly, by these differences, before they are made.
    """
    marked = found.join(labels.select("node", F.col("component").alias("c")), "node", "left").withColumn("c", F.coalesce("c", "node"))
    mixed = marked.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n"))
    mixed = mixed.where("c0 <> c1")
    # two nodes alone in a bucket, one of them the other's hub, have been compared
    told = near.select(F.col("node").alias("lo"), F.col("hub").alias("of_lo")), near.select(F.col("node").alias("hi"), F.col("hub").alias("of_hi"))
    mixed = mixed.join(told[0], "lo", "left").join(told[1], "hi", "left")
    mixed = mixed.where((F.col("n") > 2) | ~(F.col("of_lo").eqNullSafe(F.col("hi")) | F.col("of_hi").eqNullSafe(F.col("lo")))).select("key")
    left = stage(marked.join(mixed, "key"), "left")
    if sizes is None:
        sizes = sets.join(left.select("node").distinct(), "node").select("node", F.size(of(F.col("items"))).alias("n"))
    open_ = stage(left.join(sizes, "node"), "open")
    large = open_.where(F.col("size") > SMALL_BUCKET)
    crowd = large.select("node").distinct()
    items = sets.join(crowd, "node").select("node", F.explode(of(F.col("items"))).alias("item"))
    twice = items.groupBy("item").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("item")
    shared = items.join(twice, "item").groupBy("node").agg(F.count("*").alias("s"))
    novel = near.join(crowd, "node").select("node", "hub", F.explode("novel").alias("item"))
    again = novel.groupBy("hub", "item").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("hub", "item")
    beyond = novel.join(again, ["hub", "item"]).groupBy("node").agg(F.count("*").alias("sn"))
    known = near.select("node", "hub", "inhub").join(beyond, "node", "left")
    # a may have partners of den * n / num elements at most and num * n / den at least
    fit = large.join(shared, "node").where((F.col("s") * den >= F.col("n") * num)).join(known, "node", "left")
    fit = fit.select(
        "key",
        "node",
        "c",
        "n",
        F.col("s").cast("long").alias("s"),
        F.coalesce("hub", "node").alias("hub"),
        F.coalesce("inhub", F.col("n").cast("long")).alias("inhub"),
        F.coalesce("sn", F.lit(0)).cast("long").alias("sn"),
    )
    exact = "lacks" in near.columns
    if exact:
        fit = fit.join(near.select("node", "novel", "lacks"), "node", "left")
    n = F.col("n").cast("long")
    small = open_.where(F.col("size") <= SMALL_BUCKET)
    small = small.select("key", "node", "c", "n", n.alias("s"), F.col("node").alias("hub"), n.alias("inhub"), F.lit(0).cast("long").alias("sn"))
    rows = small.unionByName(fit, allowMissingColumns=True)
    keys = rows.groupBy("node").agg(F.collect_set("key").alias("keys"))  # as many as there are bands at most
    rows = rows.join(keys, "node")
    rows = stage(rows if sketches is None else rows.join(sketches, "node"), "fit")
    x, y = rows.alias("x"), rows.alias("y")
    total = F.col("x.n") + F.col("y.n")
    most = F.least("x.s", "y.s")
    by_hub = F.least("x.inhub", "y.inhub") + F.least("x.sn", "y.sn")
    most = F.when(F.col("x.hub") == F.col("y.hub"), F.least(most, by_hub)).otherwise(most)

    def similar() -> Column:
        """For two nodes of one hub, whose elements are the hub's without lacks and with novel; rows of small buckets have none."""
        inhub = F.col("x.inhub") - F.size("y.lacks") + F.size(F.array_intersect("x.lacks", "y.lacks"))
        both = inhub + F.size(F.array_intersect("x.novel", "y.novel"))
        return F.coalesce((F.col("x.hub") != F.col("y.hub")) | enough(both, total, num, den), F.lit(True))

    pairs = x.join(
        y,
        (F.col("x.key") == F.col("y.key"))
        & (F.col("x.node") < F.col("y.node"))
        & (F.col("x.c") != F.col("y.c"))
        & (F.least("x.n", "y.n") * den >= F.greatest("x.n", "y.n") * num)
        & (most * (num + den) >= total * num)
        & (F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key"))
        & (F.lit(True) if likely is None else likely(F.col("x.sig"), F.col("y.sig")))
        & (similar() if exact else F.lit(True)),
    )
    out = stage(pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "pairs")
    drop(left, open_, rows)
    return out


def merged(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Components of what labels (node, component) and the pairs more (a, b) connect: only components are linked again."""
    ends = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left")
    ends = ends.select("node", F.coalesce("component", "node").alias("component"))
    a, b = ends.select(F.col("node").alias("a"), F.col("component").alias("x")), ends.select(F.col("node").alias("b"), F.col("component").alias("y"))
    roots = components(more.join(a, "a").join(b, "b").select("x", "y"), "x", "y").select(F.col("node").alias("component"), F.col("component").alias("root"))
    every = labels.unionByName(ends).distinct()
    return every.join(roots, "component", "left").select("node", F.coalesce("root", "component").alias("component"))


def link(found: DataFrame, sets_of, num: int, den: int, sketches=None, likely=None, of=itself, exact: bool = False, sizes=None) -> DataFrame:
    """Components (node, component) of the nodes that verified links connect.

    found: members(); sets_of(nodes) gives node, items for the asked nodes, from a staged
    table.  With sketches (node, sig) all pairs are dropped whose likely(sig, sig) is
    false: those that an estimate rules out.  A node's set is
    of(items); sizes (node, n), if given, has their numbers of elements.  With exact, pairs of step 2 with one hub are compared by what sets them
    apart from it, in the join itself.
    """
    sets = sets_of(found.select("node").distinct())
    pairs = hubs(found)
    if sketches is not None:
        a, b = (sketches.select(F.col("node").alias(c), F.col("sig").alias(f"{c}_sig")) for c in ("a", "b"))
        pairs = pairs.join(a, "a").join(b, "b").where(likely(F.col("a_sig"), F.col("b_sig"))).select("a", "b")
    first = compared(pairs, sets, of)
    apart = [F.array_except("x", "y").alias("novel"), *([F.array_except("y", "x").alias("lacks")] if exact else [])]
    near = stage(first.select(F.col("a").alias("node"), F.col("b").alias("hub"), F.col("both").alias("inhub"), *apart, F.size("y").alias("hub_n")), "near")
    total = F.col("inhub") + F.size("novel") + F.col("hub_n")
    edges = stage(near.where(enough(F.col("inhub"), total, num, den)).select(F.col("node").alias("a"), F.col("hub").alias("b")), "links")
    labels = stage(components(edges), "labels")
    rest = leftovers(found, labels, sets, near, num, den, sketches, likely, of, sizes)
    more = stage(verified(rest, sets, num, den, of), "links")
    drop(edges, near, rest)
    if more.isEmpty():
        return labels
    return merged(labels, more)
