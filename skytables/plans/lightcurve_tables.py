"""Light-curve releases to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytables.operators.filters import in_range
from skytables.operators.lightcurve import (
    build_olc,
    create_observations_view,
    object_meta_from_olc,
    to_observations,
)
from skytables.sources.lightcurves import read_lightcurves, read_text_lightcurves
from skytables.sources.tables import create_database, write_table

FIRST_PARQUET_RELEASE = 8
TEXT_RELEASES = range(1, 5)


def lightcurve_tables(
    spark: SparkSession,
    path: str,
    database: str,
    release: int,
    on_exists: str = "fail",
    fields: tuple[int | None, int | None] | None = None,
) -> dict[str, str]:
    """Raw Parquet to the light-curve table, its observations view and the object metadata; returns their names.

    With ``on_exists="replace"``, the fields read replace themselves in existing tables: a release can be loaded by ranges
    of fields, and a range again.
    """
    create_database(spark, database)
    names = {kind: f"{database}.dr{release}_{kind}" for kind in ("olc", "obs_view", "meta")}
    olc = build_olc(read_lightcurves(spark, path, fields))
    stored = write_table(olc, names["olc"], on_exists, partition_by=["fieldid"], sort_by=["cell", "oid"])
    create_observations_view(spark, names["olc"], names["obs_view"], replace=on_exists == "drop")
    begin, end = fields or (None, None)
    loaded = stored.where(in_range("fieldid", begin, None if end is None else end + 1))
    write_table(object_meta_from_olc(loaded), names["meta"], on_exists, partition_by=["fieldid"], sort_by=["oid"])
    return names


def observations_for_release(
    spark: SparkSession, path: str, release: int, fields: tuple[int | None, int | None] | None = None
) -> DataFrame:
    """Observations of a release from its own format: text up to release 4, Parquet from release 8."""
    if release in TEXT_RELEASES:
        return read_text_lightcurves(spark, path, fields)
    if release >= FIRST_PARQUET_RELEASE:
        return to_observations(read_lightcurves(spark, path, fields))
    raise ValueError(f"release {release} is not supported")


def observation_table(
    spark: SparkSession,
    path: str,
    database: str,
    release: int,
    on_exists: str = "fail",
    fields: tuple[int | None, int | None] | None = None,
) -> str:
    """Observations of a release as a table partitioned by field."""
    obs = observations_for_release(spark, path, release, fields)
    create_database(spark, database)
    name = f"{database}.dr{release}_obs"
    write_table(obs, name, on_exists, partition_by=["fieldid"], sort_by=["cell", "oid", "mjd"])
    return name
