"""Links within buckets of likely similar items, without comparing all with all.

An item's own members (those no other candidate has) can be shared with nobody, so its
common ones bound any overlap: an item links only with partners up to a certain size. Items that no
partner in the bucket can suit take no part. The first round compares the rest of a bucket with the one that
has the smallest share of own members, the likeliest centre. Links
found join items into components. Later rounds take items outside the
largest component of their bucket as hubs, ever more of them, and compare these with the
items of other components, until no bucket holds an uncompared pair that may link two
components. A bucket of n copies of one thing costs about n comparisons; no link between components is missed,
whatever the shape of the groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.llm.components import connected_components
from ledgerlight.llm.storage import Workspace


def shared_buckets(keyed: DataFrame) -> DataFrame:
    """Of ``keyed(key, item)`` the rows in buckets of two or more different items."""
    buckets = keyed.groupBy("key").agg(F.min("item").alias("low"), F.max("item").alias("high")).where("low < high")
    return keyed.join(buckets.select("key").hint("shuffle_hash"), "key").select(*keyed.columns)


def partner_bounds(sets: DataFrame, percent: int) -> DataFrame:
    """``(item, n, top, own)`` of those ``sets(item, members)`` that may have a partner at all.

    ``n`` is a set's size, ``top`` the largest size a partner may have, ``own`` the share of members that no other set holds, in millionths.
    """
    members = sets.select("item", F.explode("members").alias("member"))
    single = members.groupBy("member").agg(F.count("*").alias("c"), F.min("item").alias("item")).where("c = 1")
    own = single.groupBy("item").agg(F.count("*").alias("single"))
    n, single_count = F.col("n"), F.coalesce("single", F.lit(0))
    bounds = sets.select("item", F.size("members").cast("long").alias("n")).join(own, "item", "left")
    # An overlap of at most the common members c has to reach percent of the union: size <= c (100 + p) / p - n.
    top = F.floor((n - single_count) * (100 + percent) / percent) - n
    bounds = bounds.select("item", "n", top.alias("top"), F.floor(single_count * 1_000_000 / n).alias("own"))
    return bounds.where(100 * F.col("top") >= percent * n)


def hub_members(shared: DataFrame, bounds: DataFrame) -> DataFrame:
    """``(key, item, n, top, own, hub, hub_n, hub_top)``: buckets of items that may link, with their first hub."""
    held = shared.join(bounds, "item")
    rank = F.col("own") * 1024 + F.pmod(F.xxhash64("item"), F.lit(1024))
    buckets = held.groupBy("key").agg(
        F.min("item").alias("low"), F.max("item").alias("high"), F.min_by("item", rank).alias("hub")
    )
    hubs = buckets.where("low < high").select("key", "hub")
    sizes = bounds.select(F.col("item").alias("hub"), F.col("n").alias("hub_n"), F.col("top").alias("hub_top"))
    return held.join(hubs.join(sizes, "hub"), "key")


def _may_link(n: str, top: str, other_n: str, other_top: str) -> Column:
    return (F.col(n) <= F.col(other_top)) & (F.col(other_n) <= F.col(top))


def link_members(
    members: DataFrame,
    links_of: Callable[[DataFrame, str], DataFrame],
    work: Workspace,
    sketches: DataFrame | None = None,
    plausible: Callable[[str, str, str, str], Column] | None = None,
    first_shared: Callable[[str, str, str], Column] | None = None,
    confirm: Callable[[DataFrame, str], DataFrame] | None = None,
    also: DataFrame | None = None,
) -> DataFrame:
    """``(node, component)`` of all linked items.

    ``members`` is a written table as of ``hub_members``; ``links_of`` takes candidate
    pairs (a < b) and a name and gives a written table of those that are links. With ``sketches(item, sketch)`` later rounds
    keep only pairs that ``plausible`` (columns of two sketches and two sizes) lets through, before they become rows;
    ``confirm`` then takes the place of ``links_of``. ``first_shared`` (columns of two sketches and the bucket's band) tells whether
    a bucket is the first that two items share: a pair is compared in that one only, when one of the two becomes a hub there.
    ``members`` then have a column ``band``. ``also`` are further pairs (a < b) for the first round, of buckets that are not among the members.
    """
    ends = [F.least("hub", "item").alias("a"), F.greatest("hub", "item").alias("b")]
    first = members.where("item <> hub").where(_may_link("n", "top", "hub_n", "hub_top"))
    first = first.select(*ends)
    compared = work.write((first.unionByName(also) if also is not None else first).distinct(), "pairs-0")
    links = links_of(compared, "round-0")
    labels = connected_components(links, work, "round-0")
    size_class = F.floor(F.log("n") / F.log(F.lit(1.01)))
    band, turn = (["band"] if first_shared is not None else []), 0
    # Both ends of an uncompared pair that may link two components wait, and labels only merge: who does not wait now never will.
    left = members.where("item <> hub")
    while True:
        turn += 1
        left = left.select("key", *band, "item", "n", "top", "own")
        left = left.join(labels.withColumnRenamed("node", "item"), "item", "left")
        left = left.select("key", *band, "item", "n", "top", "own", F.coalesce("component", "item").alias("label"))
        # What a bucket offers, by size: an item waits only if some size suits it, with another component.
        offers = left.groupBy("key", size_class.alias("size_class")).agg(
            F.min("n").alias("least_n"), F.max("top").alias("most_top"), F.min("label").alias("low"), F.max("label").alias("high")
        )
        suits = F.expr("key = offer_key AND least_n <= top AND n <= most_top AND (low <> label OR high <> label)")
        suited = left.join(offers.withColumnRenamed("key", "offer_key"), suits, "left_semi")
        # Both ends of a possible link wait, so a bucket with a single component is done.
        sizes = suited.groupBy("key", "label").agg(F.count("*").alias("c"))
        mixed = sizes.groupBy("key").agg(F.count("*").alias("labels"), F.max_by("label", "c").alias("major")).where("labels > 1")
        waiting = suited.join(mixed.drop("labels"), "key")
        if sketches is not None:
            waiting = waiting.join(sketches, "item")
        waiting = work.write(waiting, f"waiting-{turn}")
        if waiting.isEmpty():
            return labels
        rank = F.row_number().over(Window.partitionBy("key").orderBy("own", "item"))
        hubs = waiting.where("label <> major").withColumn("rank", rank).where(F.col("rank") <= 8 ** min(turn, 8))
        carried = ["n", "top", "label"] + (["sketch"] if sketches is not None else [])
        hubs = hubs.select("key", F.col("item").alias("hub"), *[F.col(c).alias(f"hub_{c}") for c in carried])
        hubs = work.write(hubs, f"hubs-{turn}")
        meets = _may_link("n", "top", "hub_n", "hub_top") & (F.col("label") != F.col("hub_label"))
        if first_shared is not None:
            meets &= first_shared("sketch", "hub_sketch", "band")
        if plausible is not None:
            meets &= plausible("sketch", "hub_sketch", "n", "hub_n")
        cross = waiting.join(hubs, "key").where(meets)
        pairs = work.write(cross.select(*ends).distinct().join(compared, ["a", "b"], "left_anti"), f"pairs-{turn}")
        compared = compared.unionByName(pairs)
        left = waiting.join(hubs.select("key", F.col("hub").alias("item")), ["key", "item"], "left_anti")
        found = (confirm or links_of)(pairs, f"round-{turn}")
        if not found.isEmpty():
            labels = _joined(labels, found, work, f"round-{turn}")


def _joined(labels: DataFrame, links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Labels after further links: components of the components that these connect."""
    known = labels.select(F.col("node").alias("item"), F.col("component").alias("label"))

    def end(side: str) -> DataFrame:
        return known.withColumnsRenamed({"item": side, "label": f"of_{side}"})

    ends = links.join(end("a"), "a", "left").join(end("b"), "b", "left")
    ends = ends.select("a", "b", F.coalesce("of_a", "a").alias("x"), F.coalesce("of_b", "b").alias("y"))
    ends = work.write(ends, f"{name}-ends")
    merged = connected_components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), work, name)
    nodes = known.unionByName(ends.select(F.col("a").alias("item"), F.col("x").alias("label")))
    nodes = nodes.unionByName(ends.select(F.col("b").alias("item"), F.col("y").alias("label"))).distinct()
    moved = nodes.join(merged.withColumnsRenamed({"node": "label"}), "label", "left")
    return work.write(moved.select(F.col("item").alias("node"), F.coalesce("component", "label").alias("component")), f"{name}-labels")


def alike(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose ``sets(item, members)`` share at least so much of their union."""
    full = {s: sets.select(F.col("item").alias(s), F.col("members").alias(f"s{s}")) for s in "ab"}
    both = pairs.join(full["a"], "a").join(full["b"], "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(100 * common >= percent * union).select("a", "b").distinct()
