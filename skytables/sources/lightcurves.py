"""Light-curve inputs: field directories of Parquet, and text archives with header lines."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skytables.functions.sky import sky_cell
from skytables.schemas import OBSERVATIONS, RAW_LIGHTCURVES
from skytables.sources.files import binary_files

_FIELD_NUMBER = r"(?:^|/)field[=_]?(\d+)"
_BATCH_LINES = 50_000
# What the header line and the epoch lines hold, in order.
_HEADER_FIELDS = ("oid", "nobs", "band", "fieldid", "rcid", "ra", "dec")
_EPOCH_FIELDS = ("mjd", "mag", "magerr", "clrcoeff", "catflags")


def read_lightcurves(spark: SparkSession, path: str, fields: tuple[int | None, int | None] | None = None) -> DataFrame:
    """Raw light curves from ``<path>/*/field*/**/*.parquet``; files without rows add nothing.

    ``fields`` keeps an inclusive range of field numbers.
    """
    raw = (
        spark.read.schema(RAW_LIGHTCURVES)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .parquet(f"{path.rstrip('/')}/*/field*")
    )
    return raw if fields is None else select_fields(raw, *fields, F.col("_metadata.file_path"))


def field_number(file_name: Column) -> Column:
    """Field number in a file or directory name such as ``field0202.tar.gz``; NULL if there is none."""
    return F.nullif(F.regexp_extract(file_name, _FIELD_NUMBER, 1), F.lit("")).cast("int")


def select_fields(
    df: DataFrame, start: int | None = None, end: int | None = None, file_name: Column | None = None
) -> DataFrame:
    """Rows of files whose field number lies in the inclusive range; a missing bound leaves that end open."""
    number = field_number(F.col("_metadata.file_name") if file_name is None else file_name)
    condition = F.lit(True)
    if start is not None:
        condition = condition & (number >= start)
    if end is not None:
        condition = condition & (number <= end)
    return df.where(condition)


def _archive_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of every member of each tar archive, read as a stream, with the header line last seen."""
    schema = pa.schema([("path", pa.string()), ("header", pa.string()), ("value", pa.string())])

    def batch(path: str, headers: list, values: list) -> pa.RecordBatch:
        return pa.record_batch([pa.array([path] * len(values), pa.string()), headers, values], schema=schema)

    for files in batches:
        for path, content in zip(files.column("path"), files.column("content")):
            path, header, headers, values = path.as_py(), None, [], []
            with tarfile.open(fileobj=pa.BufferReader(content.as_buffer()), mode="r:gz") as archive:
                for member in archive:
                    if not member.isfile():
                        continue
                    for line in io.TextIOWrapper(archive.extractfile(member), encoding="utf-8"):
                        line = line.strip()
                        if line.startswith("#"):
                            header = line
                        elif line:
                            headers.append(header)
                            values.append(line)
                        if len(values) >= _BATCH_LINES:
                            yield batch(path, headers, values)
                            headers, values = [], []
            yield batch(path, headers, values)


def read_text_lightcurves(
    spark: SparkSession, path: str, fields: tuple[int | None, int | None] | None = None
) -> DataFrame:
    """Observations from ``field*.tar.gz`` text archives, of an inclusive range of fields with ``fields``.

    An archive does not split, so each is one task; it is read as a stream, where the header in force is known
    without sorting lines. Splitting and casting stay in the JVM.
    """
    archives = binary_files(spark, path, "field*.tar.gz")
    if fields is not None:
        archives = select_fields(archives, *fields, F.col("path"))
    lines = archives.mapInArrow(_archive_lines, "path STRING, header STRING, value STRING")
    return parse_text_observations(lines)


def parse_text_observations(lines: DataFrame) -> DataFrame:
    """(header, value) text lines to observation rows; a malformed number stops the job."""
    head = F.split(F.trim(F.regexp_replace("header", r"^#\s*", "")), r"\s+")
    epoch = F.split(F.trim("value"), r"\s+")
    columns = {name: F.get(head, F.lit(i)) for i, name in enumerate(_HEADER_FIELDS)}
    columns |= {name: F.get(epoch, F.lit(i)) for i, name in enumerate(_EPOCH_FIELDS)}
    typed = {name: c.cast(OBSERVATIONS[name].dataType) for name, c in columns.items()}
    rows = lines.select(*[c.alias(name) for name, c in typed.items()])
    return rows.withColumn("cell", sky_cell("ra", "dec")).select(*OBSERVATIONS.names)


def attach_header_lines(
    lines: DataFrame, path: str = "path", line_no: str = "line_no", value: str = "value", block: int = 65_536
) -> DataFrame:
    """Give each line that is not a header (``#``) the latest header above it in its file.

    For lines that are already rows. A file may hold any share of them, so it is cut in blocks of line numbers: the
    window runs inside a block, and only one row per block, its last header, takes part in carrying headers across
    blocks. A header carried into a block becomes a row before the block's lines, so nothing is joined: a join here
    would be broadcast by the size of the unread input, and the driver hold a row per block of every file.
    """
    is_header = F.col(value).startswith("#")
    blocked = lines.withColumn("_block", F.floor(F.col(line_no) / block))
    last_of_block = blocked.groupBy(path, "_block").agg(
        F.max_by(F.when(is_header, F.col(value)), F.when(is_header, F.col(line_no))).alias("_last")
    )
    before = Window.partitionBy(path).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_of_block.select(
        path, "_block", F.lit(False).alias("_is_line"), F.last("_last", ignorenulls=True).over(before).alias("_own")
    )
    own = blocked.withColumns({"_is_line": F.lit(True), "_own": F.when(is_header, F.col(value))})
    rows = own.unionByName(carried.where("_own IS NOT NULL"), allowMissingColumns=True)
    in_block = Window.partitionBy(path, "_block").orderBy("_is_line", line_no)
    filled = rows.withColumn("header", F.last("_own", ignorenulls=True).over(in_block))
    return filled.where(F.col("_is_line") & ~is_header).select(*lines.columns, "header")


def write_flat_csv(df: DataFrame, path: str) -> None:
    """Flat CSV export of observations, without a header row."""
    df.write.mode("errorifexists").csv(path)
