"""Data-quality checks. Each returns counts as a DataFrame; none gathers rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.functions.arrays import adjacent_differences, count_equal


def control_sums(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and the BIGINT sum of every listed integer column, in one pass."""
    sums = [F.sum(F.col(c).cast("bigint")).alias(f"sum_{c}") for c in columns]
    return df.agg(F.count("*").alias("rows"), *sums)


def check_control_sums(df: DataFrame, expected: dict[str, int] | DataFrame) -> DataFrame:
    """Compare control sums with golden values: (name, actual, expected, ok).

    ``expected`` maps ``rows`` and column names to integers, or is itself a one-row :func:`control_sums` result.
    """
    if isinstance(expected, dict):
        columns = [c for c in expected if c != "rows"]
        golden = df.sparkSession.createDataFrame(list(expected.items()), "name STRING, expected BIGINT")
    else:
        columns = [c.removeprefix("sum_") for c in expected.columns if c != "rows"]
        golden = _by_name(expected, columns, "expected")
    actual = _by_name(control_sums(df, columns), columns, "actual")
    return actual.join(golden, "name", "full_outer").select(
        "name", "actual", "expected", F.col("actual").eqNullSafe(F.col("expected")).alias("ok")
    )


def _by_name(sums: DataFrame, columns: list[str], value: str) -> DataFrame:
    pairs = [F.struct(F.lit("rows").alias("name"), F.col("rows").alias(value))]
    pairs += [F.struct(F.lit(c).alias("name"), F.col(f"sum_{c}").alias(value)) for c in columns]
    return sums.select(F.inline(F.array(*pairs)))


def violations_length(olc: DataFrame) -> DataFrame:
    """How many light curves hold an array whose length is not the stored count."""
    wrong = F.lit(False)
    for name in ("mjd", "mag", "magerr", "clrcoeff"):
        wrong = wrong | (F.size(name) != F.col("ngoodobs"))
    return olc.agg(F.count("*").alias("objects"), F.count_if(wrong).alias("violations"))


def violations_order(olc: DataFrame, strict: bool = False) -> DataFrame:
    """How many light curves repeat a time in neighbouring epochs; with ``strict``, are not ascending."""
    steps = adjacent_differences("mjd")
    if strict:
        wrong = F.exists(F.slice(steps, 2, F.greatest(F.size(steps), F.lit(1))), lambda d: d <= 0)
    else:
        wrong = count_equal(steps, 0) != 1
    return olc.agg(F.count("*").alias("objects"), F.count_if(wrong).alias("violations"))


def check_nullability(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Nulls per declared NOT NULL column: (name, nulls, ok). A declared column that does not exist raises."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"declared columns not found: {missing}")
    required = [f.name for f in schema if not f.nullable]
    if not required:
        return df.sparkSession.createDataFrame([], "name STRING, nulls BIGINT, ok BOOLEAN")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    rows = [F.struct(F.lit(c).alias("name"), F.col(c).alias("nulls")) for c in required]
    return counts.select(F.inline(F.array(*rows))).withColumn("ok", F.col("nulls") == 0)


def row_count(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with a row counter attached: read ``observation.get["rows"]`` after the load has run."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation
