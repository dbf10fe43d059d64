"""Connected components of a link table, by star contraction."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import Scratch

#: How many times more pivots a token has in the next round.
GROWTH = 32


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (a, b) edges."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    large = (
        both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        .filter("a <> b").distinct()
    )
    least = large.groupBy("a").agg(F.min("b").alias("low"))
    return (
        large.join(least, "a")
        .select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        .select(F.col("e.a").alias("a"), F.col("e.low").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def components(scratch: Scratch, name: str, links: DataFrame) -> DataFrame:
    """(node, label) for every node of (a, b) links; label is the smallest node.

    Hubs are joined on plain keys, so adaptive execution splits them; each
    step is written, and only a checksum of the edges reaches the driver.
    """
    edges = scratch.store(f"{name}-edges-0", links.select("a", "b").filter("a <> b").distinct())
    seen, step = None, 0
    while True:
        step += 1
        following = scratch.store(f"{name}-edges-{step}", _stars(edges))
        scratch.drop(f"{name}-edges-{step - 1}")
        edges = following
        mark = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if mark == seen:
            break
        seen = mark
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)


def link_rounds(
    scratch: Scratch,
    name: str,
    postings: DataFrame,
    signed: DataFrame,
    alike: Column,
    verify: Callable[[DataFrame], DataFrame],
) -> DataFrame | None:
    """Labels (node, label) of items linked through postings (token, c, pivot).

    In each round every token met by more than one component names pivots;
    the pairs of a pivot and an item of another component whose signatures m
    of ``signed`` (c, m) are ``alike`` (columns m and pivot_m) go to ``verify``,
    which returns the links (a, b). Pivots then leave their postings, as they
    have met everyone there. The pivots of a token grow ``GROWTH`` times a round,
    so every such pair ends in one component or has been verified, after few
    rounds and without the pairs inside a component. None if nothing shares a token.

    The pivots of the first round come with the postings: ``pivot`` is the
    smallest item of the token.
    """
    if postings.isEmpty():
        return None
    pivot_signed = signed.select(F.col("c").alias("pivot"), F.col("m").alias("pivot_m"))
    others = postings.filter("c <> pivot")
    pairs = others.select("pivot", "c").distinct().join(signed, "c").join(pivot_signed, "pivot")
    pairs = scratch.store(f"{name}-pairs-0", pairs.filter(alike).select("pivot", "c"))
    links = scratch.store(f"{name}-links-0", verify(pairs))
    labels = scratch.store(f"{name}-labels-0", components(scratch, f"{name}-round-0", links))
    scratch.drop(*[n for n in scratch.paths if n.startswith((f"{name}-pairs-0", f"{name}-links-0", f"{name}-round-0-"))])
    postings, step = others.select("token", "c"), 1
    while True:
        known = postings.join(labels, postings["c"] == labels["node"], "left").select(
            "token", "c", F.coalesce("label", "c").alias("label")
        )
        mixed = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        live = scratch.store(
            f"{name}-live-{step}",
            known.join(mixed.filter("low <> high").select("token"), "token").join(signed, "c"),
        )
        if live.isEmpty():
            break
        group = F.pmod(F.xxhash64("c", F.lit(step)), F.lit(GROWTH**step))
        first = live.groupBy("token", group.alias("g")).agg(F.min("c").alias("c")).select("token", "c")
        met = scratch.store(f"{name}-met-pivots-{step}", first)
        pivots = live.join(met, ["token", "c"]).select(
            "token", F.col("c").alias("pivot"), F.col("m").alias("pivot_m"), F.col("label").alias("pivot_label")
        )
        pairs = scratch.store(
            f"{name}-pairs-{step}",
            live.join(pivots, "token")
            .filter("label <> pivot_label")
            .filter(alike)
            .select(F.least("pivot", "c").alias("pivot"), F.greatest("pivot", "c").alias("c"))
            .distinct(),
        )
        links = scratch.store(f"{name}-links-{step}", verify(pairs))
        if not links.isEmpty():
            edges = links.unionByName(labels.select(F.col("node").alias("a"), F.col("label").alias("b")))
            labels = scratch.store(f"{name}-labels-{step}", components(scratch, f"{name}-round-{step}", edges))
        postings = scratch.store(
            f"{name}-postings-{step}", live.select("token", "c").join(met, ["token", "c"], "left_anti")
        )
        used = [f"{name}-{kind}-{step}" for kind in ("live", "met-pivots", "pairs", "links")]
        scratch.drop(*used, *[n for n in scratch.paths if n.startswith(f"{name}-round-{step}-edges-")])
        step += 1
    return labels
