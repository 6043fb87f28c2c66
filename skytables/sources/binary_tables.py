"""FITS binary tables and fixed-width records, read by byte ranges and decoded with numpy inside tasks.

Both are Python data sources (``pyspark.sql.datasource``). The driver plans partitions from file headers and sizes
alone: a FITS table is cut into runs of whole rows of about ``split_bytes`` each, a file of fixed-width records into
record-aligned ranges. Each task reads its own range (``pyarrow.fs``, so local, HDFS or object stores alike) and yields
Arrow batches of ``_BATCH_ROWS`` rows, so neither the size of a file nor of a task's share is bounded by 2 GB or by
memory. Gzipped files cannot be cut: each is one partition, decompressed as a stream.

The heap of a FITS table (variable-length ``P``/``Q`` columns) is read by range too: for a batch, the spans its
descriptors point to are merged where close and read once each.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema


_BLOCK = 2880
_CARD = 80
_BATCH_ROWS = 65_536
# FITS binary-table format letters as big-endian numpy types.
_FITS_TYPES = {
    "L": "S1", "B": "u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8", "A": "S",
    "X": "u1", "C": ">f4", "M": ">f8", "P": ">i4", "Q": ">i8",
}
_SPARK_TYPES = {
    "L": T.BooleanType(), "B": T.ShortType(), "I": T.ShortType(), "J": T.IntegerType(), "K": T.LongType(),
    "E": T.FloatType(), "D": T.DoubleType(), "A": T.StringType(), "X": T.BooleanType(),
    "C": T.StructType([T.StructField("re", T.FloatType()), T.StructField("im", T.FloatType())]),
    "M": T.StructType([T.StructField("re", T.DoubleType()), T.StructField("im", T.DoubleType())]),
}
# Heap descriptors: count and offset of the elements, as two 32-bit (P) or 64-bit (Q) numbers.
_DESCRIPTORS = {"P": ">i4", "Q": ">i8"}
# Whole numbers with an offset need one step more. Unsigned 64-bit values stay BIGINT and fail where they do not fit.
_WIDER_TYPES = {"B": T.ShortType(), "I": T.IntegerType(), "J": T.LongType(), "K": T.LongType()}


def _read_header(data: bytes, start: int) -> tuple[dict, int]:
    """Keywords of the header unit at ``start`` and the offset just after it."""
    cards = {}
    while True:
        card = bytes(data[start : start + _CARD]).decode("ascii")
        start += _CARD
        key = card[:8].strip()
        if key == "END":
            break
        if card[8:10] == "= ":
            text = re.match(r"\s*('(?:[^']|'')*'|[^/]*)", card[10:]).group(1).strip()
            cards[key] = text[1:-1].rstrip() if text.startswith("'") else text
    return cards, -(-start // _BLOCK) * _BLOCK


def _data_size(cards: dict) -> int:
    axes = [int(cards[f"NAXIS{i}"]) for i in range(1, int(cards.get("NAXIS", 0)) + 1)]
    if not axes:
        return 0
    items = int(np.prod(axes)) + int(cards.get("PCOUNT", 0))
    size = abs(int(cards["BITPIX"])) // 8 * items * int(cards.get("GCOUNT", 1))
    return -(-size // _BLOCK) * _BLOCK


def _table_unit(data: bytes) -> tuple[dict, int]:
    """Header and data offset of the first binary table."""
    start = 0
    while start < len(data):
        cards, body = _read_header(data, start)
        if cards.get("XTENSION") == "BINTABLE":
            return cards, body
        start = body + _data_size(cards)
    raise ValueError("no binary table in file")


class _Field(NamedTuple):
    """One table column: stored values times ``scale`` plus ``zero``; a stored ``null`` means no value.

    ``element`` is the type letter of a heap column's elements (``letter`` is then P or Q).
    """

    name: str
    repeat: int
    letter: str
    scale: float = 1.0
    zero: float = 0.0
    null: int | None = None
    element: str | None = None

    def spark_type(self) -> T.DataType:
        if self.letter in _DESCRIPTORS:
            inner = _Field(self.name, 1, self.element, self.scale, self.zero, self.null)
            return T.StringType() if self.element == "A" else T.ArrayType(inner.spark_type())
        if (self.scale, self.zero) == (1.0, 0.0) or self.letter in "XCMAL":
            return _SPARK_TYPES[self.letter]
        return _WIDER_TYPES[self.letter] if self.is_whole() else T.DoubleType()

    def column_type(self) -> T.DataType:
        """The type of the whole column: vectors of ``repeat`` values are arrays, text and heap columns are not."""
        base = self.spark_type()
        return T.ArrayType(base) if self.repeat != 1 and self.letter not in "APQ" else base

    def is_whole(self) -> bool:
        """Integers with a whole offset: unsigned ones are stored that way."""
        return self.letter in _WIDER_TYPES and self.scale == 1.0 and self.zero.is_integer()


def _columns(cards: dict) -> list[_Field]:
    out = []
    for i in range(1, int(cards["TFIELDS"]) + 1):
        form = cards[f"TFORM{i}"].strip()
        found = re.match(r"(\d*)([A-Z])([A-Z]?)(?:\((\d+)\))?$", form)
        if not found or found.group(2) not in _FITS_TYPES or (found.group(2) in _DESCRIPTORS) != bool(found.group(3)):
            raise ValueError(f"column format {form} is not supported")
        repeat, letter, element = int(found.group(1) or 1), found.group(2), found.group(3) or None
        if element is not None and (element not in _FITS_TYPES or element in "PQXCM"):
            raise ValueError(f"column format {form} is not supported")
        scale, zero = (float(cards.get(f"{key}{i}", default).replace("D", "E")) for key, default in (("TSCAL", "1"), ("TZERO", "0")))
        null = cards.get(f"TNULL{i}")
        out.append(_Field(cards[f"TTYPE{i}"].lower(), repeat, letter, scale, zero, None if null is None else int(null), element))
    return out


def _row_dtype(columns: list[_Field]) -> np.dtype:
    parts = []
    for field in columns:
        name, repeat, letter = field.name, field.repeat, field.letter
        if letter == "A":
            parts.append((name, f"S{repeat}"))
        elif letter == "X":
            parts.append((name, "u1", (-(-repeat // 8),)))
        elif letter in "CM":
            parts.append((name, _FITS_TYPES[letter], (2 * repeat,)))
        elif letter in _DESCRIPTORS:
            parts.append((name, _DESCRIPTORS[letter], (2,)))
        else:
            parts.append((name, _FITS_TYPES[letter], (repeat,)) if repeat != 1 else (name, _FITS_TYPES[letter]))
    return np.dtype(parts)


def _scalars(flat: np.ndarray, field: _Field, target: pa.DataType) -> pa.Array:
    """Stored numbers (or logical bytes) of one column, flattened, as Arrow values of ``target``."""
    letter = field.letter
    flat = flat == b"T" if letter == "L" else flat.astype(flat.dtype.newbyteorder("="))
    missing = None if field.null is None else flat == field.null
    if (field.scale, field.zero) != (1.0, 0.0) and letter != "L":
        if not field.is_whole():
            flat = flat * field.scale + field.zero
        elif letter == "K":  # the sum of two 64-bit numbers: modulo 2**64, as unsigned
            flat = flat.view(np.uint64) + np.uint64(int(field.zero) % 2**64)
        else:
            flat = flat.astype(np.int64) + int(field.zero)
    return pa.array(flat, mask=missing).cast(target)


def _lists(values: pa.Array, sizes: np.ndarray, target: pa.DataType) -> pa.Array:
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values).cast(target)


def _to_arrow(values: np.ndarray, field: _Field, target: pa.DataType, heap=None) -> pa.Array:
    """One column as Arrow in native byte order; vectors become lists, text loses its padding.

    A value that the target type cannot hold fails the job. ``heap(descriptors, dtype)`` gives the elements of
    heap columns.
    """
    letter = field.letter
    if letter == "A":
        text = pa.array(np.ascontiguousarray(values), pa.binary()).cast(pa.string())
        return pc.utf8_rtrim(text, " \0")
    if letter == "X":
        bits = np.unpackbits(values.reshape(len(values), -1), axis=1)[:, : field.repeat].astype(bool)
        flat = pa.array(bits.reshape(-1))
        return flat if field.repeat == 1 else _lists(flat, np.full(len(values), field.repeat), target)
    if letter in "CM":
        pairs = values.reshape(-1, 2).astype(values.dtype.newbyteorder("="))
        inner = target.value_type if pa.types.is_list(target) else target
        flat = pa.StructArray.from_arrays([pa.array(pairs[:, 0]).cast(inner[0].type), pa.array(pairs[:, 1]).cast(inner[1].type)], fields=list(inner))
        return flat if field.repeat == 1 else _lists(flat, np.full(len(values), field.repeat), target)
    if letter in _DESCRIPTORS:
        counts, offsets = values[:, 0].astype(np.int64), values[:, 1].astype(np.int64)
        element = _Field(field.name, 1, field.element, field.scale, field.zero, field.null)
        dtype = np.dtype(_FITS_TYPES[field.element] if field.element != "A" else "S1")
        flat = heap(counts, offsets, dtype)
        if field.element == "A":
            data = flat.tobytes()
            ends = np.concatenate(([0], np.cumsum(counts)))
            return pc.utf8_rtrim(pa.array([data[a:b] for a, b in zip(ends, ends[1:])], pa.binary()).cast(pa.string()), " \0")
        return _lists(_scalars(flat, element, target.value_type), counts, target)
    if pa.types.is_list(target):
        return _lists(_scalars(values.reshape(-1), field, target.value_type), np.full(len(values), values.shape[1]), target)
    return _scalars(values.reshape(-1), field, target)


class _Gzipped:
    """Positioned reads of a gzipped file by decompressing forward; a read behind the cursor starts over."""

    def __init__(self, fs, path: str):
        self.fs, self.path, self.stream, self.position = fs, path, None, 0

    def read_at(self, size: int, offset: int) -> bytes:
        if self.stream is None or offset < self.position:
            self.stream = gzip.GzipFile(fileobj=self.fs.open_input_stream(self.path, compression=None))
            self.position = 0
        while self.position < offset:
            skipped = len(self.stream.read(min(offset - self.position, 1 << 24)))
            if not skipped:
                break
            self.position += skipped
        data = self.stream.read(size)
        self.position += len(data)
        return data


def _filesystem(path: str):
    """The file system of ``path`` and the path inside it: local paths and ``file:`` URIs locally, others by scheme."""
    import pyarrow.fs as pafs

    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def _open(fs, path: str):
    """Something with ``read_at(size, offset)``: the file itself, or a stream over its decompressed bytes."""
    with fs.open_input_stream(path, compression=None) as probe:
        gzipped = probe.read(2) == b"\x1f\x8b"
    return _Gzipped(fs, path) if gzipped else fs.open_input_file(path)


def _list_files(path: str, glob: str) -> list[tuple[str, int]]:
    """(path, size) of the matching files below ``path`` (or ``path`` itself), sorted by path."""
    import fnmatch

    import pyarrow.fs as pafs

    fs, inner = _filesystem(path)
    info = fs.get_file_info(inner)
    if info.type == pafs.FileType.File:
        found = [info]
    elif info.type == pafs.FileType.Directory:
        found = [f for f in fs.get_file_info(pafs.FileSelector(inner, recursive=True)) if f.type == pafs.FileType.File]
        found = [f for f in found if fnmatch.fnmatch(f.base_name, glob) and not f.base_name.startswith((".", "_"))]
    else:
        raise FileNotFoundError(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    return sorted((prefix + f.path, f.size) for f in found)


def _header_at(source, start: int) -> tuple[dict, int]:
    """Keywords of the header unit at ``start`` and the offset after it, reading a block at a time."""
    data = b""
    while True:
        block = source.read_at(_BLOCK, start + len(data))
        if len(block) < _CARD:
            raise ValueError("no binary table in file")
        data += block
        cards = [data[i : i + 8] for i in range(0, len(data) - _CARD + 1, _CARD)]
        if b"END     " in cards or any(c.rstrip() == b"END" for c in cards):
            cards, end = _read_header(data, 0)
            return cards, start + end


def _table_at(source) -> tuple[dict, int]:
    start = 0
    while True:
        cards, body = _header_at(source, start)
        if cards.get("XTENSION") == "BINTABLE":
            return cards, body
        start = body + _data_size(cards)


def _heap_reader(source, heap_start: int, gap: int = 1 << 16):
    """Elements of heap descriptors: the spans they point to, merged where less than ``gap`` apart, read once."""

    def read(counts: np.ndarray, offsets: np.ndarray, dtype: np.dtype) -> np.ndarray:
        sizes = counts * dtype.itemsize
        used = np.flatnonzero(sizes > 0)
        out = np.empty(int(counts.sum()), dtype)
        if not len(used):
            return out
        order = used[np.argsort(offsets[used], kind="stable")]
        ends = np.concatenate(([0], np.cumsum(counts)))
        i = 0
        while i < len(order):
            lo, hi, j = offsets[order[i]], offsets[order[i]] + sizes[order[i]], i + 1
            while j < len(order) and offsets[order[j]] <= hi + gap:
                hi = max(hi, offsets[order[j]] + sizes[order[j]])
                j += 1
            span = source.read_at(int(hi - lo), int(heap_start + lo))
            for r in order[i:j]:
                out[ends[r] : ends[r + 1]] = np.frombuffer(span, dtype, int(counts[r]), int(offsets[r] - lo))
            i = j
        return out

    return read


class _FitsPart(NamedTuple):
    path: str
    first: int
    rows: int


def _decode_range(source, cards: dict, body: int, first: int, rows: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    columns = _columns(cards)
    fields = {c.name: c for c in columns}
    missing = [f.name for f in schema if f.name not in fields]
    if missing:
        raise ValueError(f"columns {missing} are not in the table")
    dtype = _row_dtype(columns)
    width = int(cards["NAXIS1"])
    if dtype.itemsize != width:
        raise ValueError(f"row width {width} does not match the column formats ({dtype.itemsize} bytes)")
    heap = _heap_reader(source, body + int(cards.get("THEAP", width * int(cards["NAXIS2"]))))
    for at in range(first, first + rows, _BATCH_ROWS):
        count = min(_BATCH_ROWS, first + rows - at)
        data = source.read_at(count * width, body + at * width)
        part = np.frombuffer(data, dtype, count=count)
        yield pa.record_batch([_to_arrow(part[f.name], fields[f.name], f.type, heap) for f in schema], schema=schema)


def _decode_fits(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    class _Bytes:
        def __init__(self, data):
            self.data = data

        def read_at(self, size, offset):
            return bytes(self.data[offset : offset + size])

    for files in batches:
        for content in files.column("content"):
            data = memoryview(content.as_buffer())
            if bytes(data[:2]) == b"\x1f\x8b":
                data = memoryview(gzip.decompress(data))
            source = _Bytes(data)
            cards, body = _table_at(source)
            yield from _decode_range(source, cards, body, 0, int(cards["NAXIS2"]), schema)


def decode_fits_tables(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the first binary table in each file of a (path, content) table; ``schema`` may name a subset."""
    return files.select("content").mapInArrow(partial(_decode_fits, schema=to_arrow_schema(schema)), schema)


class FitsTables(DataSource):
    """``spark.read.format("fits_tables")``: options ``path``, ``glob`` (``*.fits*``), ``split_bytes`` (128 MB)."""

    @classmethod
    def name(cls) -> str:
        return "fits_tables"

    def schema(self) -> T.StructType:
        files = _list_files(self.options["path"], self.options.get("glob", "*.fits*"))
        if not files:
            raise FileNotFoundError(f"no FITS files in {self.options['path']}")
        fs, inner = _filesystem(files[0][0])
        cards, _ = _table_at(_open(fs, inner))
        return T.StructType([T.StructField(c.name, c.column_type()) for c in _columns(cards)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FitsReader(self.options, schema)


class _FitsReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.glob = options["path"], options.get("glob", "*.fits*")
        self.split = int(options.get("split_bytes", 128 << 20))
        self.schema = schema

    def partitions(self) -> list[InputPartition]:
        """Runs of rows of about ``split_bytes``; small files and tails share a partition up to that size."""
        ranges = []
        for path, size in _list_files(self.path, self.glob):
            fs, inner = _filesystem(path)
            source = _open(fs, inner)
            if isinstance(source, _Gzipped):
                ranges.append((_FitsPart(path, 0, -1), size))
                continue
            cards, _ = _table_at(source)
            rows, width = int(cards["NAXIS2"]), max(int(cards["NAXIS1"]), 1)
            step = max(1, self.split // width)
            ranges.extend((_FitsPart(path, first, min(step, rows - first)), min(step, rows - first) * width) for first in range(0, rows, step))
        return _packed(ranges, self.split)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        for part in partition.value:
            fs, inner = _filesystem(part.path)
            source = _open(fs, inner)
            cards, body = _table_at(source)
            rows = int(cards["NAXIS2"]) if part.rows < 0 else part.rows
            yield from _decode_range(source, cards, body, part.first, rows, schema)


def _packed(ranges: list[tuple], split: int) -> list[InputPartition]:
    """Consecutive ranges gathered into partitions of at most ``split`` bytes (one range at least)."""
    out, group, held = [], [], 0
    for part, size in ranges:
        if group and held + size > split:
            out.append(InputPartition(group))
            group, held = [], 0
        group.append(part)
        held += size
    if group or not out:
        out.append(InputPartition(group))
    return out


def _register(spark: SparkSession) -> None:
    spark.dataSource.register(FitsTables)
    spark.dataSource.register(FixedWidthRecords)


def read_fits_table(spark: SparkSession, path: str, schema: T.StructType, glob: str = "*.fits*", split_bytes: int = 128 << 20) -> DataFrame:
    """Binary tables of all FITS files below ``path``: runs of rows of about ``split_bytes`` a task; gzipped files one
    task each, streamed."""
    _register(spark)
    reader = spark.read.format("fits_tables").schema(schema)
    return reader.option("path", path).option("glob", glob).option("split_bytes", str(split_bytes)).load()


def fits_schema(spark: SparkSession, path: str, glob: str = "*.fits*") -> T.StructType:
    """Schema of the binary table in the first file, from its header alone. To be run once and kept."""
    return FitsTables({"path": path, "glob": glob}).schema()


class FixedWidthRecords(DataSource):
    """``spark.read.format("fixed_width")``: little-endian Float64 records of the schema's width; options ``path``,
    ``glob`` (``*``), ``split_bytes`` (128 MB). A file whose size is not whole records fails."""

    @classmethod
    def name(cls) -> str:
        return "fixed_width"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _FixedReader(self.options, schema)


class _FixedReader(DataSourceReader):
    def __init__(self, options, schema: T.StructType):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.split = int(options.get("split_bytes", 128 << 20))
        self.schema = schema
        self.record = 8 * len(schema.fields)

    def partitions(self) -> list[InputPartition]:
        ranges = []
        step = max(1, self.split // self.record) * self.record
        for path, size in _list_files(self.path, self.glob):
            if size % self.record:
                raise ValueError(f"{path}: {size} bytes are not whole records of {self.record}")
            ranges.extend(((path, start, min(step, size - start)), min(step, size - start)) for start in range(0, size, step))
        return _packed(ranges, self.split)

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        width = len(schema)
        for path, start, size in partition.value:
            fs, inner = _filesystem(path)
            with fs.open_input_file(inner) as source:
                for at in range(start, start + size, _BATCH_ROWS * self.record):
                    data = source.read_at(min(_BATCH_ROWS * self.record, start + size - at), at)
                    values = np.frombuffer(data, "<f8").reshape(-1, width)
                    yield pa.record_batch([pa.array(values[:, i]) for i in range(width)], schema=schema)


def read_fixed_width(spark: SparkSession, path: str, columns: list[str], split_bytes: int = 128 << 20) -> DataFrame:
    """Rows of little-endian Float64 values; record-aligned ranges of about ``split_bytes`` a task."""
    _register(spark)
    schema = T.StructType([T.StructField(c, T.DoubleType()) for c in columns])
    return spark.read.format("fixed_width").schema(schema).option("path", path).option("split_bytes", str(split_bytes)).load()
