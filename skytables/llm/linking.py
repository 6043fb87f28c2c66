"""Linking similar texts: candidate keys to verified links to connected components.

``postings`` list every node under candidate keys; nodes that share a key may be similar. Comparing all members of a key
with each other would grow with the square of a group of near copies, so candidates are drawn in rounds and a pair whose
nodes already share a component is skipped:

1. every member against the key's least member;
2. in keys that still hold several components, every member of another component against one more member, another for
   each key;
3. in keys that still hold several components, all pairs across components that could be linked.

For the last round, the sets of the nodes in question are counted: a member that no other of them has is in no intersection
and in every union, and bitmaps of the members bound the intersection of two sets from above. Both bounds are exact, so
noisy copies of one text, which resemble each other but are no links, fall away where they meet, and a pair that shares
several keys arises under one of them. No round leaves out a pair that could be a link. Each posting carries a 128-bit sketch, and pairs that differ in more than ``max_bits`` bits
are dropped where they arise. Verified pairs are not verified again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytables.llm.shingles import overlap
from skytables.session import materialise

_FILTER_SLOTS = 1 << 20
_EDGES_PER_TASK = 200_000
_MAP_WORDS = 32
Check = Callable[[list, list], list[bool]]


def _bits(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.bit_count(a0.bitwiseXOR(b0)) + F.bit_count(a1.bitwiseXOR(b1))


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in an edge (a, b); the label is the least node of its component.

    Alternates two star steps until nothing changes: hang larger neighbours on the least neighbour, then smaller ones.
    """
    edges = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct())
    tasks = 1 + edges.count() // _EDGES_PER_TASK
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = materialise(large.coalesce(tasks))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
        edges = materialise(small.filter("a <> b").distinct().coalesce(tasks))
        found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if found == state:
            break
        state = found
    roots = edges.select(F.col("b").alias("node")).distinct()
    return materialise(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots.select("node", F.col("node").alias("label"))))


def _texts_of(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts of the nodes in pairs. A bitmap of fixed size leaves out most others before the shuffle."""
    nodes = materialise(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    slot = F.pmod(F.xxhash64("node"), F.lit(_FILTER_SLOTS)).cast("int").alias("slot")
    taken = np.zeros(_FILTER_SLOTS, bool)
    taken[nodes.select(slot).distinct().toPandas()["slot"].to_numpy(int)] = True
    shared = texts.sparkSession.sparkContext.broadcast(taken)

    @F.pandas_udf("boolean")
    def wanted(slots: pd.Series) -> pd.Series:
        return pd.Series(shared.value[slots.to_numpy()])

    near = texts.filter(F.col("node").isNotNull()).withColumn("slot", slot)
    return materialise(near.filter(wanted("slot")).drop("slot").join(nodes, "node", "left_semi").dropDuplicates(["node", "text"]))


def _verified(pairs: DataFrame, texts: DataFrame, check: Check) -> DataFrame:
    """The pairs (a, b) whose texts pass the check."""
    own = _texts_of(pairs, texts)
    rows = pairs.join(own.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(own.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                yield part.loc[check(part["text_a"].tolist(), part["text_b"].tolist()), ["a", "b"]]

    kind = pairs.schema["a"].dataType.simpleString()
    return materialise(rows.mapInPandas(run, f"a {kind}, b {kind}").distinct())


def _with_private(nodes: DataFrame, texts: DataFrame, sets_of: Callable[[list], list[np.ndarray]]) -> DataFrame:
    """(node, size, private, map, taken, one): the size of each node's set, how many of its members no other of the nodes
    has, a bitmap of its members by hash and the places taken in it; ``one`` is false for a node of several texts, to which
    no bound applies."""
    own = _texts_of(nodes.select(F.col("node").alias("a"), F.col("node").alias("b")), texts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                sets = sets_of(part["text"].tolist())
                yield pd.DataFrame(
                    {
                        "node": np.repeat(part["node"].to_numpy(), [len(s) for s in sets]),
                        "item": np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64),
                    }
                )

    def bitmaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                flags = np.zeros((len(part), 64 * _MAP_WORDS), bool)
                for row, items in zip(flags, sets_of(part["text"].tolist())):
                    row[(items % np.uint64(64 * _MAP_WORDS)).astype(np.int64)] = True
                words = np.packbits(flags, axis=1).view(np.int64)
                yield pd.DataFrame({"node": part["node"].to_numpy(), "map": list(words), "taken": flags.sum(axis=1)})

    kind = nodes.schema["node"].dataType.simpleString()
    members = own.mapInPandas(run, f"node {kind}, item long")
    held = members.groupBy("item").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    private = held.filter("node = last").groupBy("node").agg(F.count("*").alias("private"))
    sizes = members.distinct().groupBy("node").agg(F.count("*").alias("size"))
    maps = own.mapInPandas(bitmaps, f"node {kind}, map array<long>, taken long").groupBy("node")
    maps = maps.agg((F.count("*") == 1).alias("one"), F.max("map").alias("map"), F.max("taken").alias("taken"))
    return materialise(sizes.join(maps, "node").join(private, "node", "left").fillna(0, ["private"]))


def _most_in_common() -> Column:
    """Upper bound of the intersection of the sets of x and y.

    Members no other node has are in none. Of the rest, each place that both bitmaps have taken can hold one common member,
    and more only where members of the same set fell on one place.
    """
    both = F.zip_with("x.map", "y.map", lambda a, b: F.bit_count(a.bitwiseAND(b)))
    places = F.aggregate(both, F.lit(0), lambda s, n: s + n)
    doubled = F.least(F.col("x.size") - F.col("x.taken"), F.col("y.size") - F.col("y.taken"))
    return F.least(places + doubled, F.col("x.size") - F.col("x.private"), F.col("y.size") - F.col("y.private"))


def link(
    postings: DataFrame,
    texts: DataFrame,
    sets_of: Callable[[list], list[np.ndarray]],
    percent: int,
    max_bits: int,
    known: DataFrame | None = None,
) -> DataFrame:
    """(node, label) for every node linked with another. ``postings``: key, node, s0, s1; ``texts``: node, text; ``known``:
    links (a, b) that need no check. Nodes are linked if 100 * intersection >= percent * union of their texts' sets."""
    check = _jaccard_check(sets_of, percent)
    sizes = postings.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("key")
    live = materialise(postings.join(sizes, "key"))
    member = F.struct("node", "s0", "s1")
    centres = live.groupBy("key").agg(F.min(member).alias("c"))
    near = _bits(F.col("c.s0"), F.col("c.s1"), F.col("s0"), F.col("s1")) <= max_bits
    pairs = live.join(centres, "key").filter((F.col("node") != F.col("c.node")) & near)
    tried = materialise(pairs.select(F.col("c.node").alias("a"), F.col("node").alias("b")).distinct())
    links = _verified(tried, texts, check)
    if known is not None:
        links = links.unionByName(known.select("a", "b"))

    labels = components(links)
    placed = _unsettled(live, labels)
    drawn = placed.groupBy("key").agg(
        F.min_by(F.struct("node", "s0", "s1", "label"), F.struct(F.xxhash64("key", "node"), "node")).alias("c")
    )
    both = placed.join(drawn, "key").filter((F.col("label") != F.col("c.label")) & near).select("node", F.col("c.node").alias("other"))
    new = materialise(_ordered(both).join(tried, ["a", "b"], "left_anti"))
    links = materialise(links.unionByName(_verified(new, texts, check)))
    tried = tried.unionByName(new)

    labels = components(links)
    placed = _unsettled(live, labels)
    left, right = placed.alias("x"), placed.alias("y")
    apart = (F.col("x.key") == F.col("y.key")) & (
        _bits(F.col("x.s0"), F.col("x.s1"), F.col("y.s0"), F.col("y.s1")) <= max_bits
    )
    nodes = materialise(left.join(right, apart & (F.col("x.label") != F.col("y.label")), "left_semi").select("node").distinct())
    placed = placed.join(_with_private(nodes, texts, sets_of), "node")
    keys = placed.groupBy("node").agg(F.collect_set("key").alias("keys"))  # a node has as many as the signature join posts
    placed = materialise(placed.join(keys, "node"))
    left, right = placed.alias("x"), placed.alias("y")
    few = F.least(F.col("x.size") - F.col("x.private"), F.col("y.size") - F.col("y.private"))
    many = F.greatest(F.col("x.size") + F.col("y.private"), F.col("y.size") + F.col("x.private"))
    most = _most_in_common()
    bound = (100 * few >= percent * many) & ((100 + percent) * most >= percent * (F.col("x.size") + F.col("y.size")))
    possible = bound | ~F.col("x.one") | ~F.col("y.one")
    once = F.array_min(F.array_intersect("x.keys", "y.keys")) == F.col("x.key")  # of the keys two nodes share, one pairs them
    both = left.join(right, apart & (F.col("x.label") < F.col("y.label")) & possible & once)
    new = _ordered(both.select(F.col("x.node").alias("node"), F.col("y.node").alias("other")))
    new = materialise(new.join(tried, ["a", "b"], "left_anti"))
    return components(links.unionByName(_verified(new, texts, check)))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _unsettled(live: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings, with their labels, of keys that hold several components."""
    placed = live.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    placed = materialise(placed.select("key", "node", "s0", "s1", "label"))
    several = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("key")
    return materialise(placed.join(several, "key"))


def _jaccard_check(sets_of: Callable[[list], list[np.ndarray]], percent: int) -> Check:
    def check(left: list, right: list) -> list[bool]:
        texts = list(dict.fromkeys(left + right))
        sets = dict(zip(texts, sets_of(texts)))
        out = []
        for a, b in zip(left, right):
            x, y = sets[a], sets[b]
            common = overlap(x, y) if min(len(x), len(y)) * 100 >= percent * max(len(x), len(y)) else 0
            out.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
        return out

    return check
