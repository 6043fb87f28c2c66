"""Mixing sources to target weights by hierarchical budgets.

Leaves are the combinations of the tree's levels (domain, language, source). A token budget goes down the tree: every node
splits what it gets among its children by weight, but no child takes more than its leaves can give (their tokens times the
largest number of epochs). What one child cannot take goes to its siblings by weight; only what none of them can take is
left to the level above, whose own split already counts on it. Each leaf then reads its documents in seeded order, epoch by
epoch, and keeps the prefix that fits its budget.

Token sums are integers. A prefix is found in two steps: sums over 4,096 digest buckets, then the order inside the one
bucket the budget ends in, so no leaf is ever ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytables.llm.columns import text_of, words
from skytables.session import materialise

_BUCKET_DIGITS = 3


def natural_weights(supply: DataFrame, levels: list[str], exponent: float) -> DataFrame:
    """Weights of all nodes as their share of tokens to a power: below 1, small children gain."""
    out = None
    for depth in range(1, len(levels) + 1):
        path = levels[:depth]
        at = supply.groupBy(*path).agg(F.sum("supply").alias("t"))
        weight = F.greatest(F.floor(F.pow(F.col("t"), F.lit(exponent)) * 1000), F.lit(1)).cast("long")
        row = at.select(*path, *[F.lit(None).cast("string").alias(c) for c in levels[depth:]], weight.alias("weight"))
        out = row if out is None else out.unionByName(row)
    return out


def split_budget(supply: DataFrame, weights: DataFrame, levels: list[str], budget: int | Column, max_epochs: int) -> DataFrame:
    """Leaves (levels, supply) with their ``allotted`` tokens.

    ``weights`` has a row for a node of any depth: its path in the levels (NULL below it) and a positive whole ``weight``;
    nodes without a row weigh 1. Children are taken in the order of what they can hold per weight: as long as a child's
    fill level lies below the level at which all that remain would share the rest, it is full and the rest go on without it.
    """
    leaves = materialise(supply.withColumn("_cap", F.col("supply") * max_epochs))
    total = F.lit(budget) if isinstance(budget, int) else budget
    nodes = None
    for depth in range(1, len(levels) + 1):
        path, parent = levels[:depth], levels[: depth - 1]
        weigh = weights.filter(F.col(levels[depth - 1]).isNotNull())
        for c in levels[depth:]:
            weigh = weigh.filter(F.col(c).isNull())
        own = leaves.groupBy(*path).agg(F.sum("_cap").alias("_cap"), F.sum("supply").alias("supply"))
        own = own.join(weigh.select(*path, "weight"), path, "left").withColumn("weight", F.coalesce("weight", F.lit(1)))
        if nodes is None:
            own = own.withColumn("_give", total)
        else:
            own = own.join(nodes.select(*parent, F.col("allotted").alias("_give")), parent)
        order = Window.partitionBy(*parent).orderBy(F.col("_cap") / F.col("weight"), *path)
        before = F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        weight_left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
        level = F.greatest(F.col("_give") - before, F.lit(0)) / weight_left
        own = own.withColumn("_full", F.col("_cap") / F.col("weight") <= level).withColumn("_level", level)
        # the level of the first child in the window's order that is not full; equal cap/weight fall to the path,
        # as in the order, so that of equal siblings the first decides and none is left out
        shared = F.min(F.when(~F.col("_full"), F.struct(F.col("_cap") / F.col("weight"), *path, "_level"))).over(
            Window.partitionBy(*parent)
        )["_level"]
        got = F.when(F.col("_full"), F.col("_cap")).otherwise(F.floor(shared * F.col("weight")))
        nodes = materialise(own.select(*path, "supply", got.cast("long").alias("allotted")))
    return nodes


def mix(
    documents: DataFrame,
    *,
    levels: dict[str, Column],
    weights: DataFrame | None = None,
    exponent: float = 0.9,
    budget: int | None = None,
    max_epochs: int = 2,
    seed: int = 7,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per selected document and epoch: ``_row`` (the whole document), the levels, ``n_tokens`` and ``epoch`` (from 0).

    ``levels`` names the tree's levels from the root down, with their expressions; NULL is the node ``(none)``. Without
    ``weights``, nodes weigh their natural share of tokens to the power ``exponent``. Without ``budget``, it is the least one
    that reads every leaf once in whole at those weights, so that no document is lost (bounded by ``max_epochs``). Tokens are
    the words of the text; NULL and empty texts have none: they cost nothing and stand in every epoch read from its start.
    The order depends on the seed, epoch and key alone; rows with equal keys are ordered by their texts and are kept or left
    one by one. An empty table gives an empty result.
    """
    names = list(levels)
    tokens, digest, tie, cum = "n_tokens", "_digest", "_tie", "_cum"
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"),
        *[F.coalesce(v.cast("string"), F.lit("(none)")).alias(n) for n, v in levels.items()],
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("_key"),
        F.size(words(text_of(text))).cast("long").alias(tokens),
        F.md5(text_of(text).cast("binary")).alias(tie),
    )
    narrow = materialise(rows.select(*names, "_key", tokens, tie))
    supply = materialise(narrow.groupBy(*names).agg(F.sum(tokens).alias("supply"), F.count("*").alias("rows")))
    total = supply.agg(F.sum("supply")).first()[0] or 0
    weights = materialise(natural_weights(supply, names, exponent)) if weights is None else weights
    if budget is None:
        budget = _one_whole_epoch(supply, weights, names, total)
    leaves = split_budget(supply.select(*names, "supply"), weights, names, budget, max_epochs)
    leaves = leaves.select(
        *names,
        F.when(F.col("supply") > 0, F.floor(F.col("allotted") / F.col("supply"))).otherwise(max_epochs).cast("int").alias("_whole"),
        F.when(F.col("supply") > 0, F.col("allotted") % F.col("supply")).otherwise(0).alias("_rest"),
    )
    leaves = materialise(leaves)

    # The epoch the budget ends in: bucket sums first, then the rows of the last bucket.
    partial = narrow.join(leaves.filter("_rest > 0"), names).withColumn(digest, _digest(seed, F.col("_whole"), F.col("_key")))
    partial = materialise(partial.withColumn("_bucket", F.substring(digest, 1, _BUCKET_DIGITS)).drop("_whole"))
    in_leaf = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = partial.groupBy(*names, "_bucket", "_rest").agg(F.sum(tokens).alias("t"))
    buckets = buckets.withColumn("_before", F.coalesce(F.sum("t").over(in_leaf), F.lit(0)))
    last = materialise(buckets.filter((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("t") > F.col("_rest"))))
    first_after = buckets.filter(F.col("_before") + F.col("t") > F.col("_rest")).groupBy(*names).agg(F.min("_bucket").alias("_end"))
    edge = partial.drop("_rest").join(last.select(*names, "_bucket", "_before", "_rest"), [*names, "_bucket"])
    order = Window.partitionBy(*names, "_bucket").orderBy(digest, tie)
    edge = edge.withColumn(cum, F.col("_before") + F.sum(tokens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stop = edge.filter(F.col(cum) > F.col("_rest")).groupBy(*names).agg(F.min(F.struct(digest, tie)).alias("_stop"))
    ends = materialise(leaves.join(first_after, names, "left").join(stop, names, "left"))

    here = rows.join(ends, names)
    here = here.withColumn("_mine", F.struct(_digest(seed, F.col("_whole"), F.col("_key")).alias(digest), F.col(tie)))
    in_part = (F.col("_rest") > 0) & (
        F.col("_end").isNull()
        | (F.substring(f"_mine.{digest}", 1, _BUCKET_DIGITS) < F.col("_end"))
        | F.coalesce(F.col("_mine") < F.col("_stop"), F.lit(False))
    )
    here = here.withColumn("_epochs", F.col("_whole") + in_part.cast("int")).filter("_epochs > 0")
    return here.select("_row", *names, tokens, F.explode(F.sequence(F.lit(0), F.col("_epochs") - 1)).alias("epoch"))


def _digest(seed: int, epoch: Column, key: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key).cast("binary"))


def _one_whole_epoch(supply: DataFrame, weights: DataFrame, names: list[str], total: int) -> int:
    """The least budget at which every leaf's share by weight covers its supply."""
    share = supply.filter("supply > 0").withColumn("_share", F.lit(1.0))
    for depth in range(1, len(names) + 1):
        path = names[:depth]
        at = supply.groupBy(*path).agg(F.sum("supply").alias("_t"))
        weigh = weights.filter(F.col(path[-1]).isNotNull())
        for c in names[depth:]:
            weigh = weigh.filter(F.col(c).isNull())
        at = at.join(weigh.select(*path, "weight"), path, "left").withColumn("weight", F.coalesce("weight", F.lit(1)))
        part = F.col("weight") / F.sum("weight").over(Window.partitionBy(*path[:-1]))
        share = share.join(at.select(*path, part.alias("_part")), path).withColumn("_share", F.col("_share") * F.col("_part")).drop("_part")
    # Each level rounds down, and shares are floating point: a few tokens more than the supply must arrive at the leaf.
    enough = F.col("supply") * (1 + 1e-9) + len(names) + 1
    need = share.agg(F.max(F.ceil(enough / F.col("_share")))).first()[0]
    return int(max(total, need or 0))


def mixed_rows(documents: DataFrame, **options) -> DataFrame:
    """The selected documents with their own columns, a row for each epoch."""
    return mix(documents, **options).select("_row.*")
