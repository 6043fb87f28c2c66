"""Quality rules: robust multivariate outliers by the minimum covariance determinant.

Every text becomes a vector of transformed statistics. For each language and source the subset of ``subset`` of the rows
whose covariance has the smallest determinant is sought by concentration steps from three deterministic starts; a
reweighting step follows, and rows far from the estimate by Mahalanobis distance are rejected.

The vectors are integers (a fixed grid), so all sums are exact and a verdict does not depend on partitioning, order or
retries. A step is one pass: rows are summed by group and distance bin before the shuffle, so a group of any size arrives
as a few hundred rows; the subset is the nearest bins that hold at least its share.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations_with_replacement
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skytables.llm.columns import text_of, words
from skytables.session import materialise

GRID = 1024
STARTS = 3
STATISTICS = ("word_length", "symbols", "repeats", "dup_lines", "capitals")
# Spread, in feature units, below which a difference says nothing: regularises groups that share one value.
FLOORS = (0.08, 0.12, 0.12, 0.15, 0.06)
_P = len(STATISTICS)
_PAIRS = list(combinations_with_replacement(range(_P), 2))
_BINS_PER_OCTAVE, _LAST_BIN = 16, 400


def _chi2_cdf(x: float, k: int) -> float:
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-15:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a))


def chi2_quantile(q: float, k: int) -> float:
    low, high = 1e-9, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if _chi2_cdf(mid, k) < q else (low, mid)
    return low


def _consistency(q: float) -> float:
    """Factor that makes the covariance of the nearest ``q`` of normal rows that of all."""
    return q / _chi2_cdf(chi2_quantile(q, _P), _P + 2)


_PLACE_BITS = 30
_HASH_PART = -(1 << _PLACE_BITS)


def text_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds counts of the whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals.

    A NULL text counts as empty. ``n_repeat_words`` counts the words inside three-word windows found twice or more. Window
    hashes are sorted with their places packed below them, so windows that may be equal are neighbours; those alone are then
    compared as text, which makes the count exact. Kept places are at most three words apart where windows overlap.
    """
    t = text_of(text)
    w, h, at = "_stat_words", "_stat_windows", "_stat_at"
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = documents.withColumns({w: words(t), "_stat_lines": lines})
    places = F.when(F.size(w) >= 3, F.sequence(F.lit(0), F.size(w) - 3)).otherwise(F.array().cast("array<int>"))
    packed = F.transform(
        places, lambda i: F.xxhash64(_at(w, i), _at(w, i + 1), _at(w, i + 2)).bitwiseAND(F.lit(_HASH_PART)).bitwiseOR(i)
    )
    out = out.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.concat_ws("", F.col(w))).cast("long"),
            "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, "[#*$%&|<>]+", ""))).cast("long"),
            "n_capitals": (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}+", ""))).cast("long"),
            "n_lines": F.size("_stat_lines").cast("long"),
            "n_dup_lines": (F.size("_stat_lines") - F.size(F.array_distinct("_stat_lines"))).cast("long"),
            h: F.sort_array(packed),
        }
    )

    def alike(x: Column, i: Column) -> Column:
        return x.bitwiseXOR(_at(h, i)).bitwiseAND(F.lit(_HASH_PART)) == 0

    suspects = F.filter(h, lambda x, i: alike(x, i + 1) | ((i > 0) & alike(x, F.greatest(i - 1, F.lit(0)))))
    place = F.transform(suspects, lambda x: x.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int"))
    out = out.withColumn(at, place).withColumn(
        at,
        F.sort_array(
            F.transform(at, lambda i: F.struct(F.concat_ws(" ", _at(w, i), _at(w, i + 1), _at(w, i + 2)).alias("w"), i.alias("i")))
        ),
    )

    def same(x: Column, i: Column) -> Column:
        return x["w"] == _at(at, i)["w"]

    repeated = F.filter(at, lambda x, i: same(x, i + 1) | ((i > 0) & same(x, F.greatest(i - 1, F.lit(0)))))
    out = out.withColumn(at, F.sort_array(F.transform(repeated, lambda x: x["i"])))
    gaps = F.transform(at, lambda x, i: F.least(F.coalesce(_at(at, i + 1) - x, F.lit(3)), F.lit(3)))
    total = F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)
    return out.withColumn("n_repeat_words", total).drop(w, h, at, "_stat_lines")


def _at(array: str, i: Column) -> Column:
    return F.get(F.col(array), i)


def _features() -> list[Column]:
    n, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    values = (
        F.log(chars / n),
        F.log(1 + 10 * F.col("n_symbols") / n),
        F.col("n_repeat_words") / n,
        F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        F.sqrt(F.col("n_capitals") / chars),
    )
    return [F.floor(v * GRID + 0.5).cast("long") for v in values]


def _table(groups: DataFrame) -> DataFrame:
    """A stored table of a few rows for each group, in one file: the planner then sees its true size, and broadcasts it as
    long as it is small instead of dealing the rows by group."""
    return materialise(groups.repartition(1))


def _groups(rows: DataFrame, smallest: int) -> DataFrame:
    """Group names: language and source; all small sources of a language together; all that is still small together; else
    NULL, which gets no verdict."""
    sizes = rows.groupBy("_l", "_s").agg(F.count_if(~F.col("base_failed")).alias("_n"))
    rest = F.sum(F.when(F.col("_n") < smallest, F.col("_n"))).over(Window.partitionBy("_l"))
    own = F.when(F.col("_n") >= smallest, F.concat_ws("\x01", "_l", "_s")).when(rest >= smallest, F.col("_l"))
    named = _table(sizes.select("_l", "_s", "_n", own.alias("_g")))
    left = named.filter(F.col("_g").isNull()).agg(F.sum("_n")).first()[0] or 0
    other = F.lit("all" if left >= smallest else None).cast("string")
    return named.select("_l", "_s", F.coalesce("_g", other).alias("_g"))


def _distance(estimate: str) -> Column:
    """Squared Mahalanobis distance of ``_x`` under an estimate: forward substitution with the Cholesky factor."""
    solved: list[Column] = []
    for i in range(_P):
        rest = F.get(F.col("_x"), F.lit(i)) - F.col(f"{estimate}.m{i}")
        for j in range(i):
            rest = rest - F.col(f"{estimate}.l{i}{j}") * solved[j]
        solved.append(rest / F.col(f"{estimate}.l{i}{i}"))
    return reduce(add, [z * z for z in solved])


def _estimates(sums: DataFrame, factor: float) -> DataFrame:
    """Means and Cholesky factors from exact sums, with the floors added to the variances; units of the grid."""
    out = sums.select("*", *[(F.col(f"s{i}") / F.col("n")).alias(f"m{i}") for i in range(_P)])
    cov = {}
    for i, j in _PAIRS:
        value = (F.col(f"s{i}{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) * factor
        if i == j:
            value = F.greatest(value, F.lit(0.0)) + (FLOORS[i] * GRID) ** 2
        cov[f"c{i}{j}"] = value
    out = out.withColumns(cov)
    for j in range(_P):
        done = [F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)]
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(reduce(lambda a, b: a - b, done, F.col(f"c{j}{j}")), F.lit(1.0))))
        column = {}
        for i in range(j + 1, _P):
            value = reduce(lambda a, b: a - b, [F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)], F.col(f"c{j}{i}"))
            column[f"l{i}{j}"] = value / F.col(f"l{j}{j}")
        out = out.withColumns(column)
    det = reduce(add, [F.log(F.col(f"l{i}{i}")) for i in range(_P)])
    lower = [f"l{i}{j}" for i in range(_P) for j in range(i + 1)]
    return out.select(
        "_g", "start", det.alias("log_det"), F.struct(*[f"m{i}" for i in range(_P)], *lower).alias("e")
    )


def _sums() -> list[Column]:
    x = [F.get(F.col("_x"), F.lit(i)) for i in range(_P)]
    return [
        F.count("*").alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(_P)],
        *[F.sum(x[i] * x[j]).alias(f"s{i}{j}") for i, j in _PAIRS],
    ]


def _nearest(binned: DataFrame, share: float) -> DataFrame:
    """Sums over the nearest bins of each group and start that hold at least ``share`` of its rows."""
    order = Window.partitionBy("_g", "start").orderBy("bin")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("n").over(Window.partitionBy("_g", "start"))
    names = ["n", *[f"s{i}" for i in range(_P)], *[f"s{i}{j}" for i, j in _PAIRS]]
    marked = binned.withColumns({"_before": before, "_total": total}).filter(F.col("_before") < share * F.col("_total"))
    return marked.groupBy("_g", "start").agg(*[F.sum(c).alias(c) for c in names])


def _bin(d2: Column) -> Column:
    return F.least(F.floor(F.log2(1 + d2) * _BINS_PER_OCTAVE), F.lit(_LAST_BIN)).cast("int")


def _starts(fit: DataFrame) -> DataFrame:
    """Sums of three first subsets: nearest to the medians, nearest the medians per axis, and the ones with least symbols
    and repeats. Medians are of integers on the grid: a group's state is bounded by the grid's values."""
    per_group = fit.groupBy("_g").agg(
        *[F.percentile(F.get(F.col("_x"), F.lit(i)), 0.5).alias(f"med{i}") for i in range(_P)]
    )
    near = fit.join(_table(per_group), "_g")
    z = [F.abs(F.get(F.col("_x"), F.lit(i)) - F.col(f"med{i}")) / (FLOORS[i] * GRID) for i in range(_P)]
    euclid = reduce(add, [v * v for v in z])
    largest = F.greatest(*z) * F.greatest(*z)
    plain = reduce(add, [F.pow(F.get(F.col("_x"), F.lit(i)) / (FLOORS[i] * GRID), F.lit(2)) for i in (1, 2, 3)])
    starts = F.array(*[F.struct(F.lit(k).alias("start"), _bin(d).alias("bin")) for k, d in enumerate((euclid, largest, plain))])
    return near.select("_g", "_x", F.inline(starts)).groupBy("_g", "start", "bin").agg(*_sums())


RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", "kept")


def reject_outliers(documents: DataFrame, *, columns: list[str] | None = None, **options) -> DataFrame:
    """The given columns (default: all) with counts, ``base_failed``, ``distance`` (squared; NULL without verdict), ``kept``.

    Options are those of ``judge``. A NULL or empty text has no words and fails the base rules; rows that fail take no part
    in the estimates. NULL languages and sources form groups of their own. Repeated rows count each and get the same
    verdict; an empty table gives an empty result. A column of the input that is named like a result gives way to it.
    """
    own = [c for c in (documents.columns if columns is None else columns) if c.lower() not in RESULTS]
    return judge(documents, own, **options).select("_row.*", *RESULTS)


def keep_regular(documents: DataFrame, **options) -> DataFrame:
    """The rows that ``judge`` keeps, whole and with their own columns."""
    return judge(documents, documents.columns, **options).filter("kept").select("_row.*")


def judge(
    documents: DataFrame,
    columns: list[str],
    *,
    text: str = "text",
    by: tuple[str, str] = ("lang", "source"),
    subset: float = 0.75,
    steps: int = 4,
    cutoff: float = 1 - 1e-7,
    smallest_group: int = 60,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """``_row`` (the named columns) and the results for each row.

    A text fails the base rules with fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of its
    words in repeated windows. ``subset`` is the share of a group the determinant is taken over, ``steps`` the number of
    concentration steps, ``cutoff`` the chi-squared quantile beyond which a row is rejected. Groups with fewer than
    ``smallest_group`` rows are joined: sources of a language, then all; what is still too small is kept.
    """
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in by)
    row = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.struct(F.lit(0).alias("_"))
    rows = text_statistics(
        documents.select(row.alias("_row"), lang.alias("_l"), source.alias("_s"), text_of(text).alias("_text")), "_text"
    )
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed).drop("_text")
    rows = materialise(rows.withColumn("_x", F.when(~F.col("base_failed"), F.array(*_features()))))
    groups = _groups(rows, smallest_group)
    fit = rows.filter(~F.col("base_failed")).select("_l", "_s", "_x").join(groups, ["_l", "_s"])
    fit = materialise(fit.filter(F.col("_g").isNotNull()).select("_g", "_x"))

    estimates = _table(_estimates(_nearest(_starts(fit), subset), _consistency(subset)))
    for _ in range(steps):
        placed = fit.join(estimates.select("_g", "start", "e"), "_g").select("_g", "start", "_x", _bin(_distance("e")).alias("bin"))
        sums = placed.groupBy("_g", "start", "bin").agg(*_sums())
        estimates = _table(_estimates(_nearest(sums, subset), _consistency(subset)))
    best = _table(estimates.groupBy("_g").agg(F.min_by("e", F.struct("log_det", "start")).alias("e")))
    inside = fit.join(best, "_g").filter(_distance("e") <= chi2_quantile(0.975, _P))
    sums = inside.groupBy("_g").agg(*_sums()).withColumn("start", F.lit(0))
    final = _table(groups.join(_estimates(sums, _consistency(0.975)).select("_g", "e"), "_g").select("_l", "_s", "e"))

    out = rows.join(final, ["_l", "_s"], "left").withColumn("distance", F.when(~F.col("base_failed"), _distance("e")))
    far = F.coalesce(F.col("distance") > chi2_quantile(cutoff, _P), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~far)
