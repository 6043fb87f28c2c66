"""Catalogues in CSV variants, each with a declared schema; a malformed row stops the job."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.schemas import OTMO, PSC, STRM, STRM_CLASSES
from skytables.sources.files import first_file

# ECSV datatype names and the Spark types that hold them.
_ECSV_TYPES = {
    "bool": T.BooleanType(),
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "uint8": T.ShortType(),
    "uint16": T.IntegerType(),
    "uint32": T.LongType(),
    "uint64": T.LongType(),
    "float32": T.FloatType(),
    "float64": T.DoubleType(),
    "string": T.StringType(),
}


def _reader(spark: SparkSession, schema: T.StructType, **options):
    return spark.read.schema(schema).options(mode="FAILFAST", **options)


def read_otmo_csv(spark: SparkSession, path: str) -> DataFrame:
    """PS1 object means: headerless, positional, ``\\N`` for a missing value."""
    return _reader(spark, OTMO, nullValue="\\N").csv(path)


def read_strm_csv(spark: SparkSession, path: str) -> DataFrame:
    """PS1 source classification: ``null`` for a missing value, a closed set of classes."""
    rows = _reader(spark, STRM, nullValue="null").csv(path)
    known = F.col("class").isNull() | F.col("class").isin(*STRM_CLASSES)
    bad = F.raise_error(F.concat(F.lit("unknown class "), F.col("class"))).cast("string")
    return rows.withColumn("class", F.when(known, F.col("class")).otherwise(bad))


def ecsv_schema(spark: SparkSession, path: str, glob: str = "*.csv*") -> T.StructType:
    """Schema declared in the comment header of the first ECSV file. To be run once and kept, not as a job step."""
    lines = spark.read.text(first_file(spark, path, glob)).where(F.col("value").rlike(r"^#\s*- *\{"))
    fields = []
    for line in (row["value"] for row in lines.toLocalIterator()):
        name = re.search(r"\bname: *([^,}]+)", line).group(1).strip().strip("'\"")
        datatype = re.search(r"\bdatatype: *([^,}]+)", line).group(1).strip()
        fields.append(T.StructField(name, _ECSV_TYPES[datatype]))
    return T.StructType(fields)


def read_ecsv(spark: SparkSession, path: str, schema: T.StructType, by_name: bool = False) -> DataFrame:
    """ECSV such as Gaia source files: comment preamble, header row, quotes, ``True``/``False``, ``null``.

    A file whose header row differs from the schema fails the job. With ``by_name``, files may hold the columns in any
    order: the header rows are found by one scan for lines made of the column names, and files with equal headers are
    read together, each with its own order.
    """
    options = {"comment": "#", "header": True, "nullValue": "null", "enforceSchema": False}
    if not by_name:
        return _reader(spark, schema, **options).csv(path)
    names = F.split(F.regexp_replace("value", r"[\s\"]", ""), ",")
    known = F.array(*map(F.lit, sorted(schema.names)))
    headers = spark.read.text(path).select(names.alias("names"), F.col("_metadata.file_path").alias("file"))
    found = headers.where(F.sort_array("names") == known).groupBy("names").agg(F.collect_set("file").alias("files"))
    parts = []
    for row in found.collect():  # one row per order of columns; the file names are what a reader lists anyway
        ordered = T.StructType([schema[n] for n in row["names"]])
        parts.append(_reader(spark, ordered, **options).csv(sorted(row["files"])).select(*schema.names))
    if not parts:
        raise ValueError(f"no header with the columns {schema.names} below {path}")
    return reduce(DataFrame.unionByName, parts)


def read_psc(spark: SparkSession, path: str) -> DataFrame:
    """2MASS point sources: headerless, separated by bars, ``\\N`` for a missing value."""
    return _reader(spark, PSC, sep="|", nullValue="\\N").csv(path)
