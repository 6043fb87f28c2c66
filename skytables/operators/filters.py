"""Row filters and column renames."""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Position columns that are not called ra and dec, in order of appearance, with their new names.
_POSITION_NAMES = {
    "AKARI": {"ra": ("ra_rad", "ra_arcsec"), "dec": ("dec_rad", "dec_arcsec")},
    "HSCv2": {"matchra": ("ra_rad",), "matchdec": ("dec_rad",)},
}
_DEFAULT_POSITION_NAMES = {"ra": ("ra_rad",), "dec": ("dec_rad",)}


def mjd_window(df: DataFrame, lo: float, hi: float) -> DataFrame:
    """Rows inside the closed time interval."""
    return df.where(F.col("mjd").between(lo, hi))


def _bounded(value) -> bool:
    return value is not None and not math.isinf(value)


def in_range(column: str, begin=None, end=None) -> Column:
    """Half-open ``[begin, end)``; ``None`` or an infinity leaves an end open."""
    condition = F.lit(True)
    if _bounded(begin):
        condition = condition & (F.col(column) >= begin)
    if _bounded(end):
        condition = condition & (F.col(column) < end)
    return condition


# Object ids begin with their field: oid = fieldid * 10^12 + band * 10^10 + number.
OID_FIELD_UNIT = 10**12


def oid_range(
    df: DataFrame, begin=None, end=None, column: str = "oid", field_column: str | None = "fieldid", field_unit: int = OID_FIELD_UNIT
) -> DataFrame:
    """Rows with ``column`` in ``[begin, end)``.

    Where ``df`` has ``field_column`` (a table partitioned by field), the range of fields the ids imply is stated too:
    ``fieldid`` from ``begin // unit`` to ``(end - 1) // unit``. Spark cannot derive it from the ids, but given it, it
    prunes the partitions, so a slice of ids reads only the folders of its fields. The rows are the same either way.
    """
    condition = in_range(column, begin, end)
    if field_column is not None and field_column in df.columns:
        first = math.floor(begin) // field_unit if _bounded(begin) else None
        last = (math.ceil(end) - 1) // field_unit + 1 if _bounded(end) else None
        condition = condition & in_range(field_column, first, last)
    return df.where(condition)


def check_unique_columns(columns: list[str]) -> None:
    repeated = sorted(c for c, n in Counter(columns).items() if n > 1)
    if repeated:
        raise ValueError(f"repeated columns: {repeated}")


def resolve_position_columns(columns: list[str], catalogue: str | None = None) -> list[str]:
    """Lower-case names with the position columns renamed to ``ra_rad`` and ``dec_rad``; duplicates raise."""
    names = [c.lower() for c in columns]
    for old, new_names in _POSITION_NAMES.get(catalogue, _DEFAULT_POSITION_NAMES).items():
        places = [i for i, c in enumerate(names) if c == old]
        if len(places) < len(new_names):
            raise ValueError(f"column {old} should appear {len(new_names)} times in {catalogue or 'the catalogue'}")
        for place, new in zip(places, new_names):
            names[place] = new
    check_unique_columns(names)
    return names
