"""Connected components of an edge table by alternating large-star and small-star steps.

Hubs never gather: every step is a partial minimum per node and a join back. Each round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour (or to itself)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them. Edges run from larger (a) to smaller (b)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    return edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """node and root (the smallest node reachable) of every node of ``edges`` (a, b) but the roots themselves. Loops and repeats are harmless."""
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{purpose}-edges")
    before = None
    while True:
        n, mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (n, mark) == before or not n:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = n, mark
        current = stage(_small_star(_large_star(current)).distinct(), f"{purpose}-round")


def meetings(members: DataFrame, size: int) -> DataFrame:
    """head, x, y, block, node, group: the circles (head, node, group) cut into blocks of about ``size`` nodes that meet in cells (x, y).

    The largest group of a circle and all others are cut apart. Blocks of others meet one another and those of the largest
    group, so every pair between two groups has a cell, and no cell holds more than two blocks.
    """
    by_group = members.groupBy("head", "group").count()
    shape = by_group.groupBy("head").agg(F.max_by("group", F.struct("count", "group")).alias("main"), F.max("count").alias("most"), F.sum("count").alias("total"))
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(size))).cast("int")
    shape = shape.select("head", "main", blocks(F.col("total") - F.col("most")).alias("others"), blocks(F.col("most")).alias("mains"))
    rows = members.select("head", "node", "group").join(shape, "head").withColumn("main", F.col("group") == F.col("main"))
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    rows = rows.withColumn("block", F.when(F.col("main"), F.col("others") + part("mains")).otherwise(part("others")).cast("int"))
    last = F.when(F.col("main"), F.col("others")).otherwise(F.col("others") + F.col("mains")) - 1
    cells = rows.withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return cells.select("head", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "node", "group")


def link_groups(
    keys: DataFrame, traits: DataFrame, near: Callable[[DataFrame], DataFrame], links_of: Callable[[DataFrame, str], DataFrame], purpose: str, between: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """node and root of all nodes linked to another one; nodes are candidates if they share a key.

    keys: key, node (made twice, never kept: most keys are met once and go no further). traits: node and columns x that
    ``near`` needs. near: keeps the rows (a, b, x_a, x_b) worth testing, without a shuffle. links_of(pairs, purpose): the
    pairs (a, b) that are truly linked.

    In each list every node is first tested against its head, the smallest one. Only lists whose nodes are then still in
    different groups go on, to ``between(members, purpose)``, which gets circles (head, node, group), the lists of each head as
    one, and returns links. So a group of alike nodes costs its size, not its square, and no link that could join two groups
    stays untested.
    """
    kept = [c for c in traits.columns if c != "node"]
    with_traits = lambda pairs, s: pairs.join(traits.select(F.col("node").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in kept)), s)
    heads = keys.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("members")).where("members > 1").select("key", "a")
    lists = keys.join(heads, "key").select("key", "a", "node")
    star = stage(lists.where("node <> a").select("a", F.col("node").alias("b")).distinct(), f"{purpose}-star")
    links = stage(links_of(near(with_traits(with_traits(star, "b"), "a")).select("a", "b"), f"{purpose}-star"), f"{purpose}-links")
    root = keys.select("node", F.col("node").alias("root")).limit(0) if links.isEmpty() else components(links, purpose)
    circles = star.select(F.col("a").alias("head"), F.col("b").alias("node")).union(star.select(F.col("a").alias("head"), F.col("a").alias("node")).distinct())
    grouped = circles.join(root.withColumnRenamed("node", "linked_node"), F.col("linked_node") == F.col("node"), "left").withColumn("group", F.coalesce("root", "node")).drop("linked_node", "root")
    mixed = grouped.groupBy("head").agg(F.min("group").alias("low"), F.max("group").alias("high"), F.count("*").alias("members")).where("low < high and members > 2").select("head")
    rest = stage(grouped.join(mixed, "head"), f"{purpose}-mixed")
    if rest.isEmpty():
        return root
    further = stage(between(rest, f"{purpose}-between"), f"{purpose}-further")
    return root if further.isEmpty() else components(links.union(further), f"{purpose}-all")
