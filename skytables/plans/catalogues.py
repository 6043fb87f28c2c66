"""External catalogues: reader, derived columns and table layout of each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.functions.packing import BANDS, explode_bands, pack_flags, pack_objid
from skytables.functions.sky import COARSE, position_hash, radians_to_degrees, sky_cell
from skytables.operators.filters import resolve_position_columns
from skytables.operators.quality import check_control_sums
from skytables.schemas import PSC_CONTROL_SUMS
from skytables.sources.binary_tables import read_fits_table, read_fixed_width
from skytables.sources.catalogue_csv import read_ecsv, read_otmo_csv, read_psc, read_strm_csv
from skytables.sources.tables import create_database, write_table


def with_cell(df: DataFrame, ra: str = "ra", dec: str = "dec") -> DataFrame:
    return df.withColumn("cell", sky_cell(ra, dec))


def prepare_mean_object(df: DataFrame) -> DataFrame:
    """PS1 tables keep their position in the mean-position columns."""
    return with_cell(df, "raMean", "decMean")


def prepare_photo_object(df: DataFrame) -> DataFrame:
    """SDSS rows: one column per band, packed object id and flags, coarse and fine cells."""
    vectors = [f.name for f in df.schema if isinstance(f.dataType, T.ArrayType)]
    flat = explode_bands(df, vectors)
    flags = {"long_objc_flags": pack_flags("objc_flags2", "objc_flags")}
    flags |= {f"long_flags_{b}": pack_flags(f"flags2_{b}", f"flags_{b}") for b in BANDS}
    cells = {"coarse_cell": sky_cell("ra", "dec", COARSE), "cell": sky_cell("ra", "dec")}
    return flat.withColumns({"objid": pack_objid(), **flags, **cells})


def prepare_radian_catalogue(df: DataFrame, catalogue: str | None = None) -> DataFrame:
    """Fixed-width catalogues: unique lower-case names, positions in degrees, position key and cell."""
    named = df.toDF(*resolve_position_columns(df.columns, catalogue))
    return with_cell(radians_to_degrees(named).withColumn("position_hash", position_hash()))


@dataclass(frozen=True)
class Catalogue:
    read: Callable[..., DataFrame]
    prepare: Callable[[DataFrame], DataFrame]
    sort_by: tuple[str, ...] = ("cell",)
    control_sums: dict | None = None


CATALOGUES = {
    "ps1": Catalogue(read_otmo_csv, prepare_mean_object),
    "ps1_strm": Catalogue(read_strm_csv, prepare_mean_object, ("objID",)),
    "gaia": Catalogue(read_ecsv, with_cell),
    "des": Catalogue(read_fits_table, with_cell),
    "sdss": Catalogue(read_fits_table, prepare_photo_object),
    "twomass": Catalogue(read_psc, with_cell, control_sums=PSC_CONTROL_SUMS),
}


def load_catalogue(
    spark: SparkSession,
    name: str,
    path: str,
    table: str,
    on_exists: str = "fail",
    verify: bool = True,
    control_sums: dict | None = None,
    **reader,
) -> DataFrame:
    """Read, extend and store a catalogue. ``reader`` goes to its reader (``schema`` for ``gaia``, ``des``, ``sdss``).

    The stored table is held against its control sums, the published ones unless others are given (for a part of the
    catalogue), and a difference raises. ``verify=False`` leaves that out.
    """
    if name not in CATALOGUES:
        raise ValueError(f"unknown catalogue {name!r}; known: {sorted(CATALOGUES)}")
    catalogue = CATALOGUES[name]
    rows = catalogue.prepare(catalogue.read(spark, path, **reader))
    sums = (control_sums or catalogue.control_sums) if verify else None
    return _store(spark, rows, table, on_exists, catalogue.sort_by, sums)


def load_fixed_width(
    spark: SparkSession, path: str, columns: list[str], table: str, catalogue: str | None = None, on_exists: str = "fail"
) -> DataFrame:
    """Store a fixed-width catalogue of radian positions."""
    numbered = read_fixed_width(spark, path, [f"c{i}" for i in range(len(columns))])
    rows = prepare_radian_catalogue(numbered.toDF(*columns), catalogue)
    return _store(spark, rows, table, on_exists, ("cell",), None)


def _store(spark, rows, table, on_exists, sort_by, sums) -> DataFrame:
    if "." in table:
        create_database(spark, table.split(".")[0])
    stored = write_table(rows, table, on_exists, sort_by=list(sort_by))
    if sums:
        wrong = check_control_sums(stored, sums).where(~F.col("ok")).collect()  # at most one row per control sum
        if wrong:
            raise ValueError(f"control sums differ: {wrong}")
    return stored
