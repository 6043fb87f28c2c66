"""Operators over parallel epoch arrays, as Column expressions: no explode, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_good(magerr="magerr", catflags="catflags") -> Column:
    """The quality predicate of one epoch: positive error and no flag."""
    magerr, catflags = (F.col(c) if isinstance(c, str) else c for c in (magerr, catflags))
    return (magerr > 0) & (catflags == 0)


def good_mask(magerr="magerr", catflags="catflags") -> Column:
    return F.zip_with(magerr, catflags, is_good)


def filter_by_mask(arr, mask) -> Column:
    """Elements of ``arr`` whose mask is true."""
    pairs = F.filter(F.arrays_zip(F.col(arr).alias("v"), mask.alias("ok")), lambda p: p["ok"])
    return F.transform(pairs, lambda p: p["v"])


def good_elements(arr: str, magerr: str = "magerr", catflags: str = "catflags") -> Column:
    """Elements of ``arr`` at the good epochs; reads the two arrays by place, without building a mask or structs.

    For stored columns: an expression in their stead would be evaluated anew for each element.
    """
    return F.filter(arr, lambda _, i: is_good(F.get(magerr, i), F.get(catflags, i)))


def has_good_epoch(magerr: str = "magerr", catflags: str = "catflags") -> Column:
    """Whether some epoch is good; stops at the first one."""
    return F.exists(F.arrays_zip(magerr, catflags), lambda e: is_good(e[magerr], e[catflags]))


def masked_reduce(values, mask: Column, how: str) -> Column:
    """``count``, ``min``, ``max`` or ``avg`` of the masked elements; NULL when none is left (0 for ``count``)."""
    kept = filter_by_mask(values, mask)
    if how == "count":
        return F.size(kept)
    if how == "min":
        return F.array_min(kept)
    if how == "max":
        return F.array_max(kept)
    if how == "avg":
        return array_mean(kept)
    raise ValueError(f"how must be count, min, max or avg, not {how!r}")


def array_mean(arr) -> Column:
    """Mean as DOUBLE, NULL for an empty array."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(arr) > 0, total / F.size(arr))


def has_any(arr, predicate: Callable[[Column], Column]) -> Column:
    return F.exists(arr, predicate)


def adjacent_differences(arr) -> Column:
    """Differences to the element before; the first is 0 by definition."""
    arr = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(arr, lambda x, i: F.when(i == 0, x - x).otherwise(x - F.get(arr, i - 1)))


def count_equal(arr: Column, value) -> Column:
    return F.size(F.filter(arr, lambda x: x == value))


def array_extrema(values: list[Column], how: str) -> Column:
    """Minimum or maximum of a literal list in which a missing value counts as 0."""
    filled = [F.coalesce(v, F.lit(0).cast("double")) for v in values]
    return F.least(*filled) if how == "min" else F.greatest(*filled)


def sorted_unique(col) -> Column:
    """Aggregate: sorted distinct values. For groups whose number of distinct values is bounded."""
    return F.array_sort(F.collect_set(col))


def equal_sizes(arrays: list[str]) -> Column:
    first, *rest = arrays
    same = F.lit(True)
    for other in rest:
        same = same & (F.size(first) == F.size(other))
    return same


def array_join(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Unroll parallel arrays to one row per element; unequal lengths stop the job instead of padding with NULL."""
    zipped = F.when(equal_sizes(arrays), F.arrays_zip(*arrays)).otherwise(
        F.raise_error(F.lit(f"arrays {', '.join(arrays)} have different lengths"))
    )
    keep = [c for c in df.columns if c not in arrays]
    return df.select(*keep, F.inline(zipped))
