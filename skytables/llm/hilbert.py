"""Sharding along a Hilbert curve.

Language, source and size are quantised at their quantiles; a row's cell on the curve through that cube orders it, and the
order is cut into runs of near equal bytes. Neighbours on the curve are close in every dimension, so a shard has narrow
ranges in each and readers can skip files by any of them.

Rows with equal texts form a group that is never split: it takes the smallest language and source of its members, and the
groups of a cell follow each other by text digest. Positions are exact prefix sums in three levels (cells, digest buckets of
a cell, groups of a bucket), so no task orders more than one bucket; within a group, rows are numbered in salted parts. A
hot source is cut by digest, a hot text by salt.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytables.llm.columns import text_of
from skytables.session import materialise

def curve_place(point: list[int], bits: int) -> int:
    """Place of a cell along the Hilbert curve of a cube with 2**bits cells a side."""
    x = list(point)
    for bit in range(bits - 1, 0, -1):  # undo the turns of each level, from the largest cubes down
        low = (1 << bit) - 1
        for i in range(len(x)):
            if x[i] >> bit & 1:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = 0
    for bit in range(bits - 1, 0, -1):
        flip ^= ((1 << bit) - 1) * (x[-1] >> bit & 1)
    place = 0
    for bit in range(bits - 1, -1, -1):
        for v in x:
            place = place << 1 | (v ^ flip) >> bit & 1
    return place


def curve_of(levels: list[Column], bits: int) -> Column:
    """Place of a row's cell; the table of all cells, of a size the parameters fix, is a literal of the plan."""
    side = 1 << bits
    table = ",".join(str(curve_place(list(cell), bits)) for cell in product(range(side), repeat=len(levels)))
    cell = reduce(lambda a, b: a * side + b, levels)
    return F.get(F.split(F.lit(table), ","), cell.cast("int")).cast("long")


def _edges(groups: DataFrame, column: str, steps: int) -> list[str | None]:
    """The values at which the rows, ordered by their whole values, reach each step; NULL before all."""
    values = groups.groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"), F.lit(0).alias("b"))
    # Ranges of values first, so that no task orders more than one of them.
    values = materialise(values.repartitionByRange(F.col("v").asc_nulls_first()).withColumn("part", F.spark_partition_id()))
    parts = _before(values.groupBy("part").agg(F.sum("n").alias("n"), F.lit(0).alias("b")), [], ["part"], "p")
    within = _before(values, ["part"], ["v"], "v").join(parts.select("part", "n_p"), "part")
    total = groups.count()
    reached = F.col("n") + F.col("n_v") + F.col("n_p")
    step = F.explode(F.sequence(F.lit(1), F.lit(steps - 1))).alias("k")
    found = within.select("v", reached.alias("upto"), (reached - F.col("n")).alias("from")).select("*", step)
    at = F.col("k") * F.lit(total)
    found = found.filter((F.col("from") * steps < at) & (F.col("upto") * steps >= at))
    return [r.v for r in found.orderBy("k").collect()]


def _level(column: str, edges: list) -> Column:
    beyond = [F.col(column).isNotNull() if e is None else F.coalesce(F.col(column) > F.lit(e), F.lit(False)) for e in edges]
    return reduce(add, [b.cast("int") for b in beyond], F.lit(0))


def hilbert_shards(
    documents: DataFrame,
    *,
    columns: list[str] | None = None,
    shards: int = 8,
    key: str = "doc_id",
    text: str = "text",
    by: tuple[str, str] = ("lang", "source"),
    bits: int = 4,
    rows_per_bucket: int = 50_000,
    salts: int = 64,
) -> DataFrame:
    """The given columns (default: all) of each row with size, text_crc32, law, shard, slot, grown_shard and curve.

    ``size`` is the UTF-8 bytes of the text plus 1; a NULL text counts as empty. Shards have near equal bytes, up to half a
    group of equal texts at each cut. Rows that are equal in every way get neighbouring slots. NULL languages, sources and
    keys order first. An empty table gives an empty result. A column of the input that is named like a result gives way.
    """
    results = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")
    own = [c for c in (documents.columns if columns is None else columns) if c.lower() not in results]
    row = F.struct(*[F.col(f"`{c}`") for c in own]).alias("_row")
    rows = documents.select(
        row,
        F.col(key).cast("string").alias("_key"),
        F.md5(text_of(text).cast("binary")).alias("_fp"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(salts)).alias("_salt"),
        (F.octet_length(text_of(text)) + 1).cast("long").alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
        *[F.col(c).alias(f"_d{i}") for i, c in enumerate(by)],
    )
    units = materialise(
        rows.groupBy("_fp", "_salt").agg(
            F.count("*").alias("n"), F.sum("size").alias("b"), F.max("size").alias("_d2"), F.min("_d0").alias("_d0"), F.min("_d1").alias("_d1")
        )
    )
    placed = _unit_positions(units, shards, bits, rows_per_bucket)
    return _numbered(rows, placed).select(
        "_row.*",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def _unit_positions(units: DataFrame, shards: int, bits: int, rows_per_bucket: int) -> DataFrame:
    """Shard, place on the curve and first slot of each salted part of a group."""
    groups = units.groupBy("_fp").agg(
        F.sum("n").alias("n"), F.sum("b").alias("b"), F.max("_d2").alias("_d2"), F.min("_d0").alias("_d0"), F.min("_d1").alias("_d1")
    )
    groups = materialise(groups.select("_fp", "n", "b", F.col("_d0").cast("string"), F.col("_d1").cast("string"), "_d2"))
    steps = 1 << bits
    shares = F.array(*[F.lit(k / steps) for k in range(1, steps)])
    found = groups.agg(F.percentile_approx("_d2", shares, 10_000).alias("_d2"), F.count("*").alias("g"), F.sum("b").alias("b")).first()
    edges = {"_d0": _edges(groups, "_d0", steps), "_d1": _edges(groups, "_d1", steps), "_d2": found["_d2"] or ()}
    levels = [_level(d, e) for d, e in edges.items()]
    digits = max(1, min(7, -(-(max(1, found["g"] // rows_per_bucket)).bit_length() // 4)))
    groups = groups.select("_fp", "n", "b", curve_of(levels, bits).alias("curve"), F.substring("_fp", 1, digits).alias("bucket"))

    buckets = materialise(groups.groupBy("curve", "bucket").agg(F.sum("n").alias("n"), F.sum("b").alias("b")))
    cells = _before(buckets.groupBy("curve").agg(F.sum("n").alias("n"), F.sum("b").alias("b")), [], ["curve"], "c")
    buckets = _before(buckets, ["curve"], ["bucket"], "k").join(cells.select("curve", "n_c", "b_c"), "curve")
    buckets = materialise(
        buckets.select("curve", "bucket", (F.col("n_k") + F.col("n_c")).alias("n_k"), (F.col("b_k") + F.col("b_c")).alias("b_k"))
    )
    groups = _before(groups, ["curve", "bucket"], ["_fp"], "g").join(buckets, ["curve", "bucket"])
    middle = F.col("b_g") + F.col("b_k") + F.col("b") / 2
    shard = F.least(F.floor(middle * shards / F.lit(found["b"] or 1)), F.lit(shards - 1)).cast("int")
    groups = materialise(groups.select("_fp", "curve", (F.col("n_g") + F.col("n_k")).alias("first"), shard.alias("shard")))
    starts = materialise(groups.groupBy("shard").agg(F.min("first").alias("start")))
    groups = groups.join(starts, "shard").select("_fp", "curve", "shard", (F.col("first") - F.col("start")).alias("first"))
    units = _before(units.select("_fp", "_salt", "n", "b"), ["_fp"], ["_salt"], "u").join(groups, "_fp")
    return units.select("_fp", "_salt", "curve", "shard", (F.col("first") + F.col("n_u")).alias("first"))


def _before(df: DataFrame, within: list[str], order: list[str], suffix: str) -> DataFrame:
    """Adds the rows and bytes that come before a row."""
    w = Window.partitionBy(*within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns({f"{c}_{suffix}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in ("n", "b")})


def _numbered(rows: DataFrame, units: DataFrame) -> DataFrame:
    number = F.row_number().over(Window.partitionBy("_fp", "_salt").orderBy("_key"))
    joined = rows.join(materialise(units), ["_fp", "_salt"])
    return joined.withColumn("slot", (F.col("first") + number - 1).cast("long"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, files in curve order, so that readers skip files by language, source or size."""
    sharded.repartition("shard", F.floor(F.col("slot") / 1_000_000)).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
