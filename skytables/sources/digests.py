"""File digests computed as a stream, by a Python data source: no file is held whole, whatever its size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from skytables.sources.binary_tables import _filesystem, _list_files, _packed

_CHUNK = 8 << 20


class FileDigests(DataSource):
    """``spark.read.format("file_digests")``: (filename, md5) of the files below ``path`` matching ``glob``; the name is
    the path below the folder. Files are packed into partitions of about ``split_bytes`` and read in 8 MB chunks."""

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    def schema(self) -> str:
        return "filename string, md5 string"

    def reader(self, schema) -> DataSourceReader:
        return _DigestReader(self.options)


class _DigestReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.glob = options["path"], options.get("glob", "*")
        self.split = int(options.get("split_bytes", 1 << 30))

    def partitions(self) -> list[InputPartition]:
        root = self.path.rstrip("/")
        files = _list_files(self.path, self.glob)
        _, inner_root = _filesystem(root)
        named = []
        for path, size in files:
            _, inner = _filesystem(path)
            named.append(((path, inner[len(inner_root.rstrip("/")) + 1 :] if inner != inner_root else inner.rsplit("/", 1)[-1]), size))
        return _packed(named, self.split)

    def read(self, partition: InputPartition) -> Iterator[tuple[str, str]]:
        for path, name in partition.value:
            fs, inner = _filesystem(path)
            digest = hashlib.md5()
            with fs.open_input_stream(inner, compression=None) as stream:
                while chunk := stream.read(_CHUNK):
                    digest.update(chunk)
            yield name, digest.hexdigest()


def file_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    spark.dataSource.register(FileDigests)
    return spark.read.format("file_digests").option("path", path).option("glob", glob).load()
