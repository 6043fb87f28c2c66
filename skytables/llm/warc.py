"""WARC archives with a two-level capture index.

Each task writes its pages as gzip members of one archive in shared storage. The captures, keyed by reversed-host URL, are
then sorted into index files of compressed blocks, and a directory holds one row per block. A lookup finds the index file by
its first key, the block by binary search in the file's part of the directory, the capture by binary search in the block,
and reads the record by its range. Only the first key of each index file is ever gathered; their number is a parameter.

Files go through ``pyarrow.fs``, so the folder may be any store it knows. A task that is run again writes another file, and
only the files of the attempt whose rows were committed are referred to.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import json
import math
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytables.llm.columns import text_of
from skytables.session import materialise, shared_dir

_ENTRY = "surt string, id string, file string, start long, length long, kind string"
_CRLF = b"\r\n"


def surt(url: str | None) -> str:
    """Sort key of a URL: host labels from the top down, then path and query; scheme, ``www.``, port and fragment fall away."""
    try:
        parts = urlsplit((url or "").strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return (url or "").strip()
    query = f"?{parts.query}" if parts.query else ""
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + query


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store, path


def _record(kind: str, key: str | None, url: str | None, refers: str | None, digest: str, payload: bytes, date: str) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{key}>",
        f"WARC-Date: {date}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers}>"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return _CRLF.join(h.encode("utf-8") for h in head) + 2 * _CRLF + payload + 2 * _CRLF


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 100,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Writes a record for each page and returns its capture (surt, id, file, start, length, kind).

    Of pages with equal payloads of ``least_bytes`` or more, the one with the least key is a response and the others revisit
    it; rows that repeat that key are responses too, and so are pages without a key. A NULL payload is empty.
    """
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), text_of(payload).cast("binary").alias("body")
    ).withColumn("digest", F.sha2("body", 256))
    first = rows.filter(F.octet_length("body") >= least_bytes).groupBy("digest").agg(F.min("key").alias("first"))
    rows = rows.join(first, "digest", "left")
    rows = rows.withColumn("first", F.when(F.col("key") != F.col("first"), F.col("first").cast("string")))
    rows = rows.withColumn("key", F.col("key").cast("string"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _open(folder)
        name = f"{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        try:
            for batch in batches:
                captures = []
                for row in batch.itertuples(index=False):
                    out = out or store.open_output_stream(f"{path}/{name}", compression=None)
                    kind = "revisit" if isinstance(row.first, str) else "response"
                    id_ = row.key if isinstance(row.key, str) else None
                    data = gzip.compress(_record(kind, id_, row.url, row.first, row.digest, bytes(row.body), date), 6, mtime=0)
                    out.write(data)
                    captures.append((surt(row.url), id_, name, at, len(data), kind))
                    at += len(data)
                yield pd.DataFrame(captures, columns=["surt", "id", "file", "start", "length", "kind"])
        finally:
            if out is not None:
                out.close()

    return materialise(rows.select("key", "url", "body", "digest", "first").mapInPandas(run, _ENTRY))


def _line(surt_key: str, id_: str | None, *rest) -> str:
    return json.dumps([surt_key, id_ or "", *rest], ensure_ascii=True)


def build_index(captures: DataFrame, folder: str, *, block_lines: int = 300, captures_per_file: int = 500_000) -> DataFrame:
    """Writes the sorted index and returns its directory: index_file, first (its first key), start, length, number.

    Captures are dealt by URL key and id, so one URL with many captures spans several files.
    """
    spark = captures.sparkSession
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(captures.count() / captures_per_file))
    by_key = captures.repartitionByRange(files, "surt", "id", "file", "start").sortWithinPartitions("surt", F.coalesce("id", F.lit("")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _open(folder)
        name, at, number, out, lines, keys = f"{uuid.uuid4().hex}.cdx.gz", 0, 0, None, [], []

        def flush() -> pd.DataFrame:
            nonlocal at, number, out
            out = out or store.open_output_stream(f"{path}/{name}", compression=None)
            data = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            out.write(data)
            row = (name, json.dumps(keys[0]), at, len(data), number)
            at, number = at + len(data), number + 1
            lines.clear()
            keys.clear()
            return pd.DataFrame([row], columns=["index_file", "first", "start", "length", "number"])

        try:
            for batch in batches:
                for row in batch.itertuples(index=False):
                    id_ = row.id if isinstance(row.id, str) else None
                    lines.append(_line(row.surt, id_, row.file, row.start, row.length, row.kind))
                    keys.append([row.surt, id_ or ""])
                    if len(lines) == block_lines:
                        yield flush()
            if lines:
                yield flush()
        finally:
            if out is not None:
                out.close()

    return materialise(by_key.mapInPandas(run, "index_file string, first string, start long, length long, number long"))


def _key_of(first: str) -> list[str]:
    return json.loads(first)


def look_up(queries: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """Captures of each query. ``queries`` has ``url`` and ``id`` (NULL: every capture of the URL); both come back with
    file, start, length and kind. A query that nothing answers gives no row."""
    heads = directory.filter("number = 0").select("first", "index_file").toPandas()
    heads = sorted((_key_of(f), n) for f, n in zip(heads["first"], heads["index_file"]))
    firsts = [h[0] for h in heads]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, id_ in zip(batch["url"], batch["id"]):
                id_ = id_ if isinstance(id_, str) else None
                key = surt(url)
                low = max(bisect.bisect_left(firsts, [key, id_ or ""]) - 1, 0)
                high = bisect.bisect_right(firsts, [key, id_ if id_ is not None else "\U0010ffff"])
                out += [(url, id_, key, heads[k][1]) for k in range(low, high)]
            yield pd.DataFrame(out, columns=["url", "id", "surt", "index_file"])

    asked = queries.select(F.col("url").cast("string"), F.col("id").cast("string")).mapInPandas(
        assign, "url string, id string, surt string, index_file string"
    )

    def search(asked: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        names = ["url", "id", "file", "start", "length", "kind"]
        if asked.empty or blocks.empty:
            return pd.DataFrame([], columns=names)
        store, path = _open(folder)
        blocks = blocks.sort_values("number")
        starts = [_key_of(f) for f in blocks["first"]]
        held, out = {}, []
        with store.open_input_file(f"{path}/{blocks['index_file'].iloc[0]}") as source:

            def lines(k: int) -> list[list]:
                if k not in held:
                    held.clear() if len(held) > 8 else None
                    raw = source.read_at(int(blocks["length"].iloc[k]), int(blocks["start"].iloc[k]))
                    held[k] = [json.loads(x) for x in gzip.decompress(raw).decode().split("\n")]
                return held[k]

            wanted = sorted(zip(asked["surt"], asked["id"], asked["url"]), key=lambda q: (q[0], q[1] if isinstance(q[1], str) else ""))
            for key, id_, url in wanted:
                id_ = id_ if isinstance(id_, str) else None
                low = [key, id_ or ""]
                k = max(bisect.bisect_left(starts, low) - 1, 0)
                done = False
                while k < len(starts) and not done and starts[k][:1] <= [key]:
                    block = lines(k)
                    for j in range(bisect.bisect_left(block, low), len(block)):
                        if block[j][0] != key or id_ is not None and block[j][1] != id_:
                            done = True
                            break
                        out.append((url, id_, *block[j][2:]))
                    k += 1
        return pd.DataFrame(out, columns=names)

    kind = "url string, id string, file string, start long, length long, kind string"
    return asked.groupBy("index_file").cogroup(directory.groupBy("index_file")).applyInPandas(search, kind)


def _parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = zlib.decompress(data, 31).partition(2 * _CRLF)
    fields = dict(h.split(": ", 1) for h in head.decode("utf-8").split("\r\n")[1:])
    return fields, body[: int(fields["Content-Length"])]


def read_records(captures: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """(id, url, kind, digest, refers_to, payload_bytes, payload) of each capture, by range reads in file order.

    A response whose payload does not have the digest of its header fails the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = _open(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.file != name:
                    if source is not None:
                        source.close()
                    name, source = row.file, store.open_input_file(f"{path}/{row.file}")
                fields, body = _parse(source.read_at(row.length, row.start))
                digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                revisit = fields["WARC-Type"] == "revisit"
                if not revisit and hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"damaged record in {row.file} at {row.start}")
                refers = fields.get("WARC-Refers-To")
                ids = [x and x.removeprefix("<urn:page:").removesuffix(">") for x in (fields["WARC-Record-ID"], refers)]
                ids[0] = None if ids[0] == "None" else ids[0]
                size = None if revisit else len(body)
                out.append((ids[0], fields["WARC-Target-URI"], fields["WARC-Type"], digest, ids[1], size, body if with_payload else None))
            yield pd.DataFrame(out, columns=["id", "url", "kind", "digest", "refers_to", "payload_bytes", "payload"]).astype(
                {"payload_bytes": "Int64"}
            )

    near = captures.repartition("file", F.floor(F.col("start") / (16 << 20))).sortWithinPartitions("file", "start")
    return near.select("file", "start", "length").mapInPandas(
        run, "id string, url string, kind string, digest string, refers_to string, payload_bytes long, payload binary"
    )


def archive_round_trip(pages: DataFrame, *, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes and indexes archives of all pages, looks each page up and reads its record back.

    Returns (key, payload_bytes, payload_digest, record_type, refers_to). Pages without a key are looked up by URL. Repeated
    rows each come back; an empty table gives an empty result. Other columns are not archived.
    """
    folder = shared_dir(pages.sparkSession)
    captures = write_archives(pages, folder, key=key, url=url, payload=payload)
    directory = build_index(captures, folder)
    asked = pages.select(F.col(url).cast("string").alias("url"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id")).distinct()
    found = materialise(look_up(asked, directory, folder).select("file", "start", "length").distinct())
    records = materialise(read_records(found, folder, with_payload=False).drop("payload"))
    kind = pages.schema[key].dataType
    # a revisit's size is that of the response it names with its digest: one id may hold several payloads
    sizes = records.filter("kind = 'response'").select(F.col("id").alias("refers_to"), "digest", F.col("payload_bytes").alias("full"))
    out = records.join(sizes.dropDuplicates(["refers_to", "digest"]), ["refers_to", "digest"], "left")
    return out.select(
        F.col("id").cast(kind).alias(key),
        F.coalesce("payload_bytes", "full").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
