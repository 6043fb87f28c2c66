"""Writes derived tables as survey files into shared storage, for the queries that read such files."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skytables.session import shared_dir


def stage_csv(df: DataFrame, **options) -> str:
    path = shared_dir(df.sparkSession)
    df.write.options(**options).csv(path)
    return path


def _write_batches(
    batches: Iterator[pa.RecordBatch], folder: str, name: str, encode: Callable[[pa.RecordBatch], bytes]
) -> Iterator[pa.RecordBatch]:
    """One file per batch; its name depends on the task only, so that a retry writes over what the first try left."""
    task = TaskContext.get().partitionId()
    filesystem, base = pa.fs.FileSystem.from_uri(folder)
    filesystem.create_dir(base, recursive=True)
    for i, batch in enumerate(batches):
        with filesystem.open_output_stream(f"{base}/{name.format(task, i)}", compression=None) as out:
            out.write(encode(batch))
        yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["rows"])


def stage_encoded(df: DataFrame, name: str, encode: Callable[[pa.RecordBatch], bytes]) -> str:
    """Encode each Arrow batch as one file ``name`` (a format of task and batch number)."""
    folder = shared_dir(df.sparkSession)
    uri = folder if "://" in folder else folder.removeprefix("file:")
    writer = partial(_write_batches, folder=uri, name=name, encode=encode)
    df.mapInArrow(writer, "rows BIGINT").write.format("noop").mode("overwrite").save()
    return folder


def _write_rows(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    filesystem, base = pa.fs.FileSystem.from_uri(folder)
    for batch in batches:
        for name, text in zip(*(c.to_pylist() for c in batch.columns)):
            filesystem.create_dir(f"{base}/{name}".rpartition("/")[0], recursive=True)
            with filesystem.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(text.encode())
        yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["rows"])


def stage_files(df: DataFrame) -> str:
    """One file per row (name, text); names may have folders."""
    folder = shared_dir(df.sparkSession)
    uri = folder if "://" in folder else folder.removeprefix("file:")
    df.mapInArrow(partial(_write_rows, folder=uri), "rows BIGINT").write.format("noop").mode("overwrite").save()
    return folder


def encode_records(batch: pa.RecordBatch) -> bytes:
    """Little-endian Float64 records."""
    columns = [c.to_numpy(zero_copy_only=False).astype("<f8") for c in batch.columns]
    return np.column_stack(columns).tobytes()


def encode_fits(batch: pa.RecordBatch, zipped: bool = False, keywords: dict[str, dict[str, str]] | None = None) -> bytes:
    """A FITS file with one binary table; text columns take 12 bytes, list columns must have equal lengths.

    ``keywords`` adds header keywords such as TZERO to columns, whose values are those to be stored.
    """
    fields, forms = [], []
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_string(column.type):
            fields.append((name, "S12", np.array([s.encode() for s in column.to_pylist()], "S12")))
            forms.append("12A")
        elif pa.types.is_boolean(column.type):
            fields.append((name, "S1", np.where(column.to_numpy(zero_copy_only=False), b"T", b"F")))
            forms.append("L")
        else:
            is_list = pa.types.is_list(column.type)
            flat = (column.flatten() if is_list else column).to_numpy(zero_copy_only=False)
            values = flat.reshape(batch.num_rows, -1) if is_list else flat
            target = column.type.value_type if is_list else column.type
            big_endian = target.to_pandas_dtype()(0).dtype.newbyteorder(">")
            shape = values.shape[1:]
            letter = {"i2": "I", "i4": "J", "i8": "K", "f4": "E", "f8": "D"}[big_endian.str[1:]]
            fields.append((name, (big_endian, shape), values))
            forms.append(f"{shape[0] if shape else 1}{letter}")
    rows = np.zeros(batch.num_rows, np.dtype([(n, *t) if isinstance(t, tuple) else (n, t) for n, t, _ in fields]))
    for name, _, values in fields:
        rows[name] = values

    def unit(cards: list[tuple[str, str]]) -> bytes:
        text = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in cards) + "END".ljust(80)
        return text.ljust(-(-len(text) // 2880) * 2880).encode("ascii")

    primary = unit([("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0"), ("EXTEND", "T")])
    cards = [("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", str(rows.itemsize))]
    cards += [("NAXIS2", str(len(rows))), ("PCOUNT", "0"), ("GCOUNT", "1"), ("TFIELDS", str(len(fields)))]
    for i, (field, form) in enumerate(zip(fields, forms), 1):
        cards += [(f"TTYPE{i}", f"'{field[0].upper()}'"), (f"TFORM{i}", f"'{form}'")]
        cards += [(f"{k}{i}", v) for k, v in (keywords or {}).get(field[0], {}).items()]
    body = rows.tobytes()
    content = primary + unit(cards) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")
    return gzip.compress(content, compresslevel=1) if zipped else content


def encode_archive(batch: pa.RecordBatch) -> bytes:
    """A gzipped tar with the text column ``value`` as one member."""
    text = "\n".join(batch.column("value").to_pylist()).encode() + b"\n"
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        info = tarfile.TarInfo("field.txt")
        info.size = len(text)
        archive.addfile(info, io.BytesIO(text))
    return out.getvalue()


def encode_fits_heap(batch: pa.RecordBatch) -> bytes:
    """A FITS binary table with heap columns, from a batch of: id (long), sizes (list of int, ``PJ``), name (text,
    ``PA``), prices (list of double, ``QD``), bits (10 booleans, ``10X``), z (one complex of floats, ``C``), w (two
    complexes of doubles, ``2M``)."""
    rows = batch.to_pylist()
    heap = bytearray()

    def put(data: bytes, count: int) -> tuple[int, int]:
        at = len(heap)
        heap.extend(data)
        return count, at

    dtype = np.dtype(
        [("ID", ">i8"), ("SIZES", ">i4", (2,)), ("NAME", ">i4", (2,)), ("PRICES", ">i8", (2,)), ("BITS", "u1", (2,)),
         ("Z", ">f4", (2,)), ("W", ">f8", (4,))]
    )
    table = np.zeros(len(rows), dtype)
    longest = {"SIZES": 0, "NAME": 0, "PRICES": 0}
    for i, row in enumerate(rows):
        table["ID"][i] = row["id"]
        table["SIZES"][i] = put(np.array(row["sizes"], ">i4").tobytes(), len(row["sizes"]))
        name = row["name"].encode()
        table["NAME"][i] = put(name, len(name))
        table["PRICES"][i] = put(np.array(row["prices"], ">f8").tobytes(), len(row["prices"]))
        table["BITS"][i] = np.packbits(np.array(row["bits"], bool), bitorder="big").tolist() + [0] * (2 - -(-len(row["bits"]) // 8))
        table["Z"][i] = (row["z"]["re"], row["z"]["im"])
        table["W"][i] = [v for c in row["w"] for v in (c["re"], c["im"])]
        for key, n in (("SIZES", len(row["sizes"])), ("NAME", len(name)), ("PRICES", len(row["prices"]))):
            longest[key] = max(longest[key], n)
    forms = [("ID", "K"), ("SIZES", f"PJ({longest['SIZES']})"), ("NAME", f"PA({longest['NAME']})"), ("PRICES", f"QD({longest['PRICES']})"),
             ("BITS", "10X"), ("Z", "C"), ("W", "2M")]

    def unit(cards: list[tuple[str, str]]) -> bytes:
        text = "".join(f"{k:<8}= {v:>20}".ljust(80) for k, v in cards) + "END".ljust(80)
        return text.ljust(-(-len(text) // 2880) * 2880).encode("ascii")

    gap = 100  # a gap between the rows and the heap, as THEAP allows
    primary = unit([("SIMPLE", "T"), ("BITPIX", "8"), ("NAXIS", "0"), ("EXTEND", "T")])
    cards = [("XTENSION", "'BINTABLE'"), ("BITPIX", "8"), ("NAXIS", "2"), ("NAXIS1", str(dtype.itemsize))]
    cards += [("NAXIS2", str(len(rows))), ("PCOUNT", str(gap + len(heap))), ("GCOUNT", "1"), ("TFIELDS", str(len(forms)))]
    cards += [("THEAP", str(dtype.itemsize * len(rows) + gap))]
    for i, (name, form) in enumerate(forms, 1):
        cards += [(f"TTYPE{i}", f"'{name}'"), (f"TFORM{i}", f"'{form}'")]
    body = table.tobytes() + bytes(gap) + bytes(heap)
    return primary + unit(cards) + body.ljust(-(-len(body) // 2880) * 2880, b"\0")
