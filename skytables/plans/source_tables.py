"""Object metadata and observations to merged sources."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.operators.match import circle_match, nearest_matches, nearest_per_group
from skytables.operators.merge import source_members, source_observations
from skytables.operators.quantiles import partitioned_run, quantile_grid, slice_of
from skytables.operators.summary import source_meta, source_meta_of_members, source_meta_short
from skytables.session import materialise
from skytables.sources.tables import create_database, drop_table, table_exists, write_table


@dataclass
class Sources:
    xmatch: DataFrame
    members: DataFrame
    observations: DataFrame
    meta: DataFrame


# What the match reads of an object; the rest of the metadata is not carried along.
_MATCH_COLUMNS = ("oid", "band", "fieldid", "ra", "dec", "cell", "ngoodobs")


def build_sources(meta: DataFrame, obs: DataFrame, radius_arcsec: float = 0.2, store_xmatch: bool = True) -> Sources:
    """The whole chain as DataFrames. Both sides of the match read the metadata and several branches the match, so both are
    stored once: a lazy ``meta`` is computed from the epochs a single time."""
    objects = meta.select(*[c for c in _MATCH_COLUMNS if c in meta.columns])
    xmatch = nearest_matches(materialise(objects) if store_xmatch else objects, radius_arcsec=radius_arcsec)
    if store_xmatch:
        xmatch = materialise(xmatch)
    members = source_members(xmatch)
    return Sources(xmatch, members, source_observations(obs, members), source_meta_of_members(obs, members))


def circle_match_in_parts(
    meta: DataFrame, radius_arcsec: float = 0.2, parts: int = 1, interval: int | str = "all"
) -> DataFrame:
    """The circle match by slices of ``oid1``, all or one of them, each against the whole table."""
    return partitioned_run(meta, "oid", lambda part: circle_match(part, meta, radius_arcsec), parts, interval)


def source_observations_in_parts(
    obs: DataFrame, members: DataFrame, parts: int = 1, interval: int | str = "all"
) -> DataFrame:
    """Source observations by slices of ``sid``. Roots are those of the whole match, so slices add up to the whole."""
    return partitioned_run(members, "sid", lambda part: source_observations(obs, part), parts, interval)


_PARTS = "skytables.parts"
_EDGES = "skytables.edges"


def _property(spark: SparkSession, name: str, key: str) -> str | None:
    found = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == key).collect()
    return found[0]["value"] if found else None


def _parts_of(spark: SparkSession, name: str) -> str | None:
    return _property(spark, name, _PARTS)


def _store_slices(
    df: DataFrame,
    key: str,
    job: Callable[[DataFrame], DataFrame],
    name: str,
    on_exists: str,
    sort_by: list[str],
    parts: int,
    interval: int | str,
    edges: list | None = None,
) -> DataFrame:
    """The job's result as a table; with several parts, one slice of keys after the other, each a partition of its own.

    For all slices, ``on_exists`` holds as for one write: an existing table fails, is kept, is dropped first, or has its
    slices replaced. One slice replaces its own partition, emptied first. The number of parts is kept with the table, and
    a write by another number of parts is refused unless the table is dropped: slices of two cuts would overlap.
    Slice edges are computed once for all slices, unless given, and kept with the table: a slice written later, or again,
    is cut by the same edges, so slices never overlap, and the keys are not ranked again for each.
    """
    spark = df.sparkSession
    if parts == 1:
        return write_table(job(df), name, on_exists, sort_by=sort_by)
    exists = table_exists(spark, name)
    if exists and interval == "all":
        if on_exists == "fail":
            raise ValueError(f"table {name} exists")
        if on_exists == "keep":
            return spark.table(name)
        if on_exists == "drop":
            drop_table(spark, name)
            exists = False
    if exists and _parts_of(spark, name) != str(parts):
        raise ValueError(f"table {name} was written in {_parts_of(spark, name)} parts, not {parts}; drop it to cut it anew")
    if edges is None:
        kept = _property(spark, name, _EDGES) if exists and interval != "all" else None
        inner = json.loads(kept) if kept else quantile_grid(df, key, parts, exact=True)[1:-1]
        edges = [-math.inf, *inner, math.inf]
    for number in range(parts) if interval == "all" else [interval]:
        rows = job(slice_of(df, key, parts, number, edges)).withColumn("slice", F.lit(number))
        write_table(rows, name, "replace", partition_by=["slice"], sort_by=sort_by, covers=[{"slice": number}])
    inner = json.dumps(edges[1:-1])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PARTS}' = '{parts}', '{_EDGES}' = '{inner}')")
    return spark.table(name)


def _summary_of_slice(summary: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
    return summary(rows.drop("slice"))


def source_tables(
    spark: SparkSession,
    meta: str,
    obs: str,
    database: str,
    release: int,
    radius_arcsec: float = 0.2,
    on_exists: str = "fail",
    store_circle: bool = False,
    short: bool = False,
    parts: int = 1,
    interval: int | str = "all",
) -> dict[str, str]:
    """Write the cross match, source observations and source metadata; returns the table names.

    ``store_circle`` also writes the full pair list, ``short`` the metadata of the release's private interval. With
    ``parts``, pairs, source observations and source metadata are written by slices of their ids, all or the one numbered
    ``interval``; a slice that is written again replaces itself, and the tables have a column ``slice``. The cross match is
    always whole, and kept if a single slice is asked for.
    """
    create_database(spark, database)
    suffix = f"{radius_arcsec:g}".replace(".", "p")
    kinds = ["xmatch", "source_obs", "source_meta"]
    kinds += ["circle_match"] * store_circle + ["source_meta_short"] * short
    names = {kind: f"{database}.dr{release}_{kind}_{suffix}" for kind in kinds}
    objects, epochs = spark.table(meta), spark.table(obs)
    nearest = nearest_matches(objects, radius_arcsec=radius_arcsec)
    if store_circle:
        circle = _store_slices(
            objects,
            "oid",
            lambda part: circle_match(part, objects, radius_arcsec),
            names["circle_match"],
            on_exists,
            ["oid2"],
            parts,
            interval,
        )
        if interval == "all":
            nearest = nearest_per_group(circle)
    one_slice = parts > 1 and interval != "all"
    xmatch = write_table(nearest, names["xmatch"], "keep" if one_slice else on_exists, sort_by=["oid2"])
    source_obs = _store_slices(
        source_members(xmatch),
        "sid",
        lambda part: source_observations(epochs, part),
        names["source_obs"],
        on_exists,
        ["sid", "mjd"],
        parts,
        interval,
    )
    summaries = {"source_meta": source_meta}
    if short:
        summaries["source_meta_short"] = lambda rows: source_meta_short(rows, release)
    by_slice = [-math.inf, *range(1, parts), math.inf]  # a source lies in one slice: its own partition tells all of it
    for kind, summary in summaries.items():
        job = partial(_summary_of_slice, summary)
        _store_slices(source_obs, "slice", job, names[kind], on_exists, ["cell"], parts, interval, by_slice)
    return names
