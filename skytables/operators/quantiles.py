"""Quantiles, by sketch or exact, and slices of a job by key."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytables.operators.filters import in_range
from skytables.session import materialise

_BUCKETS = 256


def quantiles(
    df: DataFrame, column: str, levels: list[float], by: list[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Quantiles of a column, per group with ``by``: one array column ``quantiles`` in the order of ``levels``.

    The sketch merges map-side partial results, so neither a group nor the table is gathered in one place. Rank error
    is at most count / accuracy; the values are elements of the column. For exact ones see :func:`exact_quantiles`.
    """
    summary = F.percentile_approx(column, [float(q) for q in levels], accuracy).alias("quantiles")
    return df.groupBy(*(by or [])).agg(summary)


def exact_quantiles(df: DataFrame, column: str, levels: list[float], by: list[str] | None = None) -> DataFrame:
    """As :func:`quantiles`, but the smallest value with at least the level's share of the rows at or below it.

    Equal values are counted together first. A sketch cuts each group in buckets, bucket counts tell which of them holds a
    level's rank, and only those are put in order. NULL values do not count; groups without values are left out.
    """
    keys = by or ["_all"]
    if not by:
        df = df.withColumn("_all", F.lit(0))
    values = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("_v")).agg(F.count("*").alias("_n"))
    values = materialise(values)
    cuts = [i / _BUCKETS for i in range(1, _BUCKETS)]
    edges = values.groupBy(*keys).agg(F.percentile_approx("_v", cuts, 10_000).alias("_edges"), F.sum("_n").alias("_total"))
    edges = materialise(edges)
    bucket = F.size(F.filter("_edges", lambda e: e < F.col("_v"))).alias("_bucket")
    placed = materialise(values.join(edges, keys).select(*keys, bucket, "_v", "_n", "_total"))

    sizes = placed.groupBy(*keys, "_total", "_bucket").agg(F.sum("_n").alias("_rows"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    level = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(q)).alias("q")) for i, q in enumerate(levels)]))
    ranks = sizes.select("*", level.alias("_l"))
    # Written with floor, since q * n may round to just above a whole number.
    rank = F.greatest(F.col("_total") - F.floor(F.col("_total") - F.col("_l.q") * F.col("_total")), F.lit(1))
    ranks = ranks.withColumn("_rank", rank - F.col("_before")).where("_rank BETWEEN 1 AND _rows")
    inside = placed.join(ranks.select(*keys, "_bucket").distinct(), [*keys, "_bucket"])
    upto = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.select(*keys, "_bucket", "_v", F.sum("_n").over(upto).alias("_upto"))
    hits = inside.join(ranks.select(*keys, "_bucket", "_l.i", "_rank"), [*keys, "_bucket"]).where(F.col("_upto") >= F.col("_rank"))
    chosen = hits.groupBy(*keys, "i").agg(F.min("_v").alias("v"))
    ordered = F.sort_array(F.collect_list(F.struct("i", "v")))
    return chosen.groupBy(*keys).agg(F.transform(ordered, lambda x: x["v"]).alias("quantiles")).drop("_all")


def check_monotonic(edges: list) -> None:
    flat = [i for i in range(1, len(edges)) if not edges[i - 1] < edges[i]]
    if flat:
        raise ValueError(f"slice edges are not increasing at {flat}: {edges}; use fewer slices")


def quantile_grid(df: DataFrame, column: str, parts: int, exact: bool = False, accuracy: int = 10_000) -> list:
    """Edges of ``parts`` slices with near equal rows, open at both ends."""
    if parts < 1:
        raise ValueError(f"the number of slices should be positive: {parts}")
    inner: list = []
    if parts > 1:
        shares = [k / parts for k in range(1, parts)]
        summary = exact_quantiles(df, column, shares) if exact else quantiles(df, column, shares, accuracy=accuracy)
        row = summary.first()
        inner = (row and row["quantiles"]) or []
        check_monotonic(inner)
    return [-math.inf, *inner, math.inf]


def slice_of(df: DataFrame, column: str, parts: int, number: int, edges: list | None = None) -> DataFrame:
    """Rows of one key slice; rows without a key are in the first. Edges are exact, so they are the same in every run;
    pass ``edges`` (of :func:`quantile_grid`) to cut several slices by one computation of them."""
    if not 0 <= number < parts:
        raise ValueError(f"slice {number} is not one of {parts}")
    edges = edges or quantile_grid(df, column, parts, exact=True)
    if len(edges) != parts + 1:
        raise ValueError(f"{len(edges)} edges do not make {parts} slices")
    mine = in_range(column, edges[number], edges[number + 1])
    return df.where(mine | F.col(column).isNull() if number == 0 else mine)


def partitioned_run(
    df: DataFrame,
    column: str,
    job: Callable[[DataFrame], DataFrame],
    parts: int = 1,
    interval: int | str = "all",
) -> DataFrame:
    """Run ``job`` on one key slice of ``df``, or once on all of it.

    For rerunning a part of a large job; Spark's own partitioning already bounds memory. ``job`` must treat rows with
    different keys on their own, so that its results over all slices add up to the whole.
    """
    return job(df if interval == "all" else slice_of(df, column, parts, interval))


def kll_rank_error(k: int) -> float:
    """A priori bound (99 % confidence) of a KLL sketch's normalised rank error for its parameter ``k``."""
    return 2.296 / k**0.9723


def stored_sketches(df: DataFrame, column: str, by: list[str], k: int = 1000) -> DataFrame:
    """One mergeable KLL sketch of ``column`` (as double) and the row count per group of ``by``: to be written at load
    beside the table, so that later quantiles of any union of groups read the sketches, not the rows. NULLs are left out."""
    values = F.col(column).cast("double")
    return df.where(values.isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(values, k).alias("sketch"), F.count("*").alias("rows"))


def sketch_quantiles(sketches: DataFrame, levels: list[float], by: list[str] | None = None) -> DataFrame:
    """Quantiles from stored sketches, merged over the groups that ``by`` joins (all without it): ``quantiles`` in the
    order of ``levels`` and ``rows``. Reads only the sketch table; the rank error is that of the sketch's ``k``."""
    merged = sketches.groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch").alias("_merged"), F.sum("rows").alias("rows"))
    wanted = F.array(*[F.lit(float(q)) for q in levels])
    return merged.select(*(by or []), F.kll_sketch_get_quantile_double("_merged", wanted).alias("quantiles"), "rows")
