"""Bit-packed 64-bit identifiers. A pack that uses bit 63 keeps its bit pattern in a signed BIGINT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BANDS = ("u", "g", "r", "i", "z")


def _long(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def pack_objid(rerun="rerun", run="run", camcol="camcol", field="field", id="id") -> Column:
    """Object id: version 2 in bits 59 and up, then rerun, run, camcol, field, id."""
    return (
        F.shiftleft(F.lit(2).cast("bigint"), 59)
        + F.shiftleft(_long(rerun), 48)
        + F.shiftleft(_long(run), 32)
        + F.shiftleft(_long(camcol), 29)
        + F.shiftleft(_long(field), 16)
        + _long(id)
    )


def pack_flags(high, low) -> Column:
    """``high`` in the upper 32 bits, the unsigned value of ``low`` in the lower ones."""
    return F.shiftleft(_long(high), 32) + _long(low).bitwiseAND(F.lit(0xFFFFFFFF))


def explode_bands(df: DataFrame, columns: list[str], bands: tuple[str, ...] = BANDS) -> DataFrame:
    """Each listed vector column becomes one column per band, in place.

    A vector with another number of elements fails the job; a NULL vector gives NULLs.
    """
    out = []
    for name in df.columns:
        if name in columns:
            size = F.size(name).cast("string")
            wrong = F.raise_error(F.concat(F.lit(f"{name} should have {len(bands)} elements, not "), size))
            vector = F.when(F.col(name).isNull() | (F.size(name) == len(bands)), F.col(name)).otherwise(
                wrong.cast(df.schema[name].dataType)
            )
            out += [F.get(vector, F.lit(i)).alias(f"{name}_{band}") for i, band in enumerate(bands)]
        else:
            out.append(F.col(name))
    return df.select(*out)
