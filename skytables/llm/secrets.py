"""Secret scans through encoded layers.

A worklist starts with the text. Each layer is scanned, then everything in it that decodes (percent and Unicode escapes
anywhere, base64 runs, also over line ends, gzip and zlib data inside them) becomes a further layer, until none is new.
Bytes that are no characters stay as they are and hide nothing beside them. Every character of a
layer carries the range of the original text it came from, so spans found in any depth are spans of the text. A layer is
known by its content and its place; meeting it again ends that branch, which also stops data that unpacks to itself.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+")
_ONE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
_BASE64_PART = re.compile(r"[A-Za-z0-9]{16,}={0,2}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+(?:\r\n?|\n)[\x20\t]*+[A-Za-z0-9+/_-]++)+={0,2}")
_PACKED_HEADS = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
# Every secret and every escape has or comes from so many readable ASCII characters in a row; bytes without them hold none.
_STRETCH = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
_WIDE_STRETCH = re.compile(rb"(?:[\t\n\r\x20-\x7e]\x00){12,}")
_TEXT_STRETCH = re.compile(r"[\t\n\r\x20-\x7e]{12,}")
# Places that no secret, escape or run of base64 reaches across: a text can be cut behind them.
_BORDER = re.compile(r"""[^A-Za-z0-9+/_.=\-%\\&#;'":\s]|(?<=[^\s:='"])\x20(?=[A-Za-z0-9])|(?<=\n)\n(?=\S)|(?<=[.=%\\&#;'":])\n""")
_PIECE = 1 << 22
_PEEK = 1 << 16


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets of a text, leftmost and non-overlapping in each kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


class _Layer:
    """A text whose character i came from the range start[i]:end[i] of the original; no arrays: it is the original; numbers:
    all of it came from start:end. ``first`` is unset in all but the first piece of a text that is taken in pieces."""

    def __init__(self, text: str, start: np.ndarray | int | None = None, end: np.ndarray | int | None = None, first: bool = True):
        self.text, self.start, self.end, self.first = text, start, end, first

    def origin(self, begin: int, stop: int) -> tuple[int, int]:
        if self.start is None:
            return begin, stop
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[begin:stop].min()), int(self.end[begin:stop].max())

    def name(self) -> tuple:
        place = self.origin(0, len(self.text))
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), place


def _placed(layer: _Layer, pieces: list[tuple[str, int, int]]) -> _Layer:
    """A layer of pieces (text, begin, stop); a piece as long as its range maps one to one, others map to all of it."""
    if isinstance(layer.start, int):
        return _Layer("".join(p[0] for p in pieces), layer.start, layer.end)
    starts, ends = [], []
    for text, begin, stop in pieces:
        if len(text) == stop - begin:
            starts.append(np.arange(begin, stop) if layer.start is None else layer.start[begin:stop])
            ends.append(np.arange(begin + 1, stop + 1) if layer.end is None else layer.end[begin:stop])
        else:
            first, last = layer.origin(begin, stop)
            starts.append(np.full(len(text), first))
            ends.append(np.full(len(text), last))
    return _Layer("".join(p[0] for p in pieces), np.concatenate(starts), np.concatenate(ends))


def _percent_pieces(run: str, at: int) -> list[tuple[str, int, int]] | None:
    """Decoded characters; bytes that are not UTF-8 stay as they are written. None if all of them are so."""
    out, changed, i = [], False, 0
    for c in bytes.fromhex(run.replace("%", "")).decode("utf-8", "surrogateescape"):
        if 0xD800 <= ord(c) < 0xE000:
            n = 3
            out.append((run[i : i + n], at + i, at + i + n))
        else:
            n, changed = 3 * len(c.encode("utf-8")), True
            out.append((c, at + i, at + i + n))
        i += n
    return out if changed else None


def _escape_pieces(run: str, at: int) -> list[tuple[str, int, int]] | None:
    """Decoded characters; numbers that are none, lone surrogates too, stay as they are written. None if all are so."""
    out, changed, high = [], False, None  # high: the code before, if it waits for its second half
    for m in _ONE_ESCAPE.finditer(run):
        hexed, decimal = m[1] or m[2] or m[3] or m[5], m[4]
        code = int(hexed, 16) if hexed else int(decimal)
        before, high = high, None
        if 0xDC00 <= code < 0xE000 and before is not None:
            code = 0x10000 + ((before - 0xD800) << 10) + code - 0xDC00
            out[-1], changed = (chr(code), out[-1][1], at + m.end()), True
        elif code > 0x10FFFF or 0xD800 <= code < 0xE000:
            out.append((m[0], at + m.start(), at + m.end()))
            high = code if code < 0xDC00 else None
        else:
            out.append((chr(code), at + m.start(), at + m.end()))
            changed = True
    return out if changed else None


def _unescaped(layer: _Layer, pattern: re.Pattern, decode) -> _Layer | None:
    """The whole layer with its escapes decoded; None if there are none."""
    pieces, at, changed = [], 0, False
    for m in pattern.finditer(layer.text):
        inner = decode(m[0], m.start())
        if inner:
            pieces.append((layer.text[at : m.start()], at, m.start()))
            pieces += inner
            at, changed = m.end(), True
    if not changed:
        return None
    pieces.append((layer.text[at:], at, len(layer.text)))
    return _placed(layer, [p for p in pieces if p[0]])


def _inflate(source) -> Iterator[bytes]:
    """Unpacked bytes of the gzip and zlib members that follow each other, up to damage, and what follows the last as it is."""
    unpack, held, plain = zlib.decompressobj(47), b"", False
    try:
        for data in source():
            data, held = held + data, b""
            while data and not plain:
                if unpack is None:
                    data = data.lstrip(b"\0")
                    if len(data) < 2:
                        held, data = data, b""
                    elif data[:2] in _PACKED_HEADS:
                        unpack = zlib.decompressobj(47)
                    else:
                        plain = True
                    continue
                out = unpack.decompress(data, _PIECE)
                if out:
                    yield out
                data = unpack.unused_data if unpack.eof else unpack.unconsumed_tail
                if unpack.eof:
                    unpack = None
            if plain:
                yield data
        if unpack is not None:
            held = unpack.flush()
        if held:
            yield held
    except zlib.error:
        return


def _peek(chunks: Iterator[bytes]) -> bytes:
    out = b""
    for data in chunks:
        out += data
        if len(out) >= _PEEK:
            break
    return out[:_PEEK]


def _texts(chunks: Iterator[bytes], codec: str, skip: int) -> Iterator[str]:
    """The decoded text in pieces of about ``_PIECE`` characters, cut where nothing reaches across; longer if nowhere."""
    wide = codec != "utf-8"
    decoder = codecs.getincrementaldecoder(codec)("surrogatepass" if wide else "surrogateescape")
    held, done = "", 0
    for data in chunks:
        held += decoder.decode(data[skip:])
        skip = 0
        if len(held) < _PIECE:
            continue
        cut, window = 0, 1 << 12
        while not cut:
            at = max(done, len(held) - window)
            for m in _BORDER.finditer(held, at):
                cut = m.end()
            if at == done:
                break
            window *= 8
        if cut:
            yield held[:cut]
            held, done = held[cut:], 0
        else:
            held = re.sub("\x20{2,}", "\x20", held)  # many spaces are to every pattern what one is
            done = max(len(held) - 2, 0)
    held += "" if wide else decoder.decode(b"", True)
    if held:
        yield held


def _unpacked(raw: bytes, first: int, last: int, most: int | None, cut: list[int]) -> Iterator[_Layer]:
    """Layers of packed bytes, all from first:last: what they unpack to, and on while that is packed again."""
    source, before = (lambda: iter([raw])), raw[:_PEEK]
    while before[:2] in _PACKED_HEADS:
        source = partial(_inflate, source)
        head = _peek(source())
        if not head or head == before:  # damaged, or unpacks to itself
            return
        wide = False

        def chunks(source=source) -> Iterator[bytes]:
            nonlocal wide
            left = most
            for data in source():
                wide = wide or b"\0" in data
                if left is not None and len(data) > left:
                    cut.append(len(data))
                    yield data[:left]
                    return
                yield data
                left = None if left is None else left - len(data)

        for codec, skip in (("utf-8", 0), ("utf-16-le", 0), ("utf-16-le", 1)):
            if codec != "utf-8" and not wide:
                break
            new, counted = True, len(cut)
            for text in _texts(chunks(), codec, skip):
                if _TEXT_STRETCH.search(text):
                    yield _Layer(text, first, last, new)
                    new = False
            if codec != "utf-8":
                del cut[counted:]  # each layer counts once
        before = head


def _from_base64(layer: _Layer, run: str, places: np.ndarray | int, starts: list[int], most: int | None, cut: list[int]) -> Iterator[_Layer]:
    """Layers of a run of base64 whose characters are at ``places`` (or from there on) and that may begin at each of ``starts``.

    What begins at a multiple of four characters behind another start is in the other's bytes.
    """
    bare = run.rstrip("=").replace("-", "+").replace("_", "/")

    def ranges(begin, stop):  # of the layer, for ranges of the run
        if isinstance(places, int):
            return begin + places, stop + places
        return places[begin], places[stop - 1] + 1

    for phase in sorted({s % 4 for s in starts}):
        some = bare[phase:]
        some = some[: len(some) - (len(some) % 4 == 1)]
        raw = base64.b64decode(some + "=" * (-len(some) % 4))
        for s in starts:
            at = (s - phase) // 4 * 3
            if s % 4 == phase and raw[at : at + 2] in _PACKED_HEADS:
                first, last = layer.origin(*map(int, ranges(s, len(run))))
                yield from _unpacked(raw[at:], first, last, most, cut)
        found = [("utf-8", "surrogateescape", 0)] if _STRETCH.search(raw) else []
        if b"\0" in raw:
            found += [("utf-16-le", "surrogatepass", k) for k in sorted({m.start() % 2 for m in _WIDE_STRETCH.finditer(raw)})]
        for codec, errors, skip in found:
            odd = (len(raw) - skip) % 2 if codec != "utf-8" else 0
            text = raw[skip : len(raw) - odd].decode(codec, errors)
            if isinstance(layer.start, int):
                yield _Layer(text, layer.start, layer.end)
                continue
            if text.isascii() and codec == "utf-8":
                size = np.ones(len(text), int)
            else:
                code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                if codec == "utf-8":  # a byte that is not UTF-8 is a surrogate here
                    size = np.where((code >= 0xD800) & (code < 0xE000), 1, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF))
                else:
                    size = np.where(code > 0xFFFF, 4, 2)
            stop = np.cumsum(size) + skip
            first, last = ranges(phase + (stop - size) * 4 // 3, np.minimum(phase + -(-stop * 4 // 3), len(bare)))
            if layer.start is None:
                yield _Layer(text, first, last)
            else:
                yield _Layer(text, layer.start[first], layer.end[last - 1])


def _starts(run: str) -> list[int]:
    return [0] + [m.end() for m in re.finditer("[/_+-]", run) if m.end() < len(run.rstrip("="))]


def _inner(layer: _Layer, most: int | None, cut: list[int]) -> Iterator[_Layer]:
    """Everything in a layer that decodes."""
    text = layer.text
    if "%" in text:
        yield from (x for x in [_unescaped(layer, _PERCENT, _percent_pieces)] if x)
    if "\\" in text or "&#" in text:
        yield from (x for x in [_unescaped(layer, _ESCAPE, _escape_pieces)] if x)
    for m in _BASE64.finditer(text):
        starts = _starts(m[0])
        yield from _from_base64(layer, m[0], m.start(), starts, most, cut)
        if len(starts) > 1:
            for part in _BASE64_PART.finditer(text, m.start(), m.end()):
                yield from _from_base64(layer, part[0], part.start(), [0], most, cut)
    for m in _WRAPPED.finditer(text):
        lines = list(_RUN.finditer(text, m.start(), m.end()))
        run = "".join(line[0] for line in lines)
        if len(run) >= 16:
            places = np.concatenate([np.arange(line.start(), line.end()) for line in lines])
            begins = np.cumsum([0] + [len(line[0]) for line in lines[:-1]]).tolist()
            yield from _from_base64(layer, run, places, sorted({*begins, *_starts(run)}), most, cut)


def unwrap(text: str, most: int | None = None) -> tuple[set[tuple[int, int, int]], int, int]:
    """Spans found in decoded layers, the number of those layers, and of those with data beyond ``most`` bytes, if it is given."""
    found, seen, layers, cut = set(), set(), 0, []
    todo = [_inner(_Layer(text), most, cut)]
    while todo:  # depth first, so that no more than a piece of a long layer is held
        layer = next(todo[-1], None)
        if layer is None:
            todo.pop()
            continue
        name = layer.name()
        if name in seen:
            continue
        seen.add(name)
        layers += layer.first
        for begin, kind, stop in scan(layer.text):
            first, last = layer.origin(begin, stop)
            found.add((first, kind, last))
        todo.append(_inner(layer, most, cut))
    return found, layers, len(cut)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(documents: DataFrame, *, key: str = "doc_id", text: str = "text", max_unpacked: int | None = None) -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_layers, n_cut) for each row.

    The counts and the digest are of the plain text; ``spans`` has these and the spans found in decoded layers, as
    kind:start:end in code points of the text, by start, kind and end. A NULL or empty text has none. Packed layers are
    unpacked and scanned in pieces, all of them; a piece is longer than usual only where a text has no place to cut, as in one
    run of base64. If ``max_unpacked`` is given, the scan of a layer ends after so many bytes and ``n_cut`` counts it. Repeated rows each give a row; an empty table gives an empty result; other columns are dropped.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for one in batch["text"]:
                one = one if isinstance(one, str) else ""
                base = scan(one)
                extra, layers, cut = unwrap(one, max_unpacked)
                every = sorted(set(base) | extra)
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                out.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every), layers, cut))
            made = pd.DataFrame(out, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_cut"])
            made.insert(0, "key", batch["key"].to_numpy())
            yield made

    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    found = rows.mapInPandas(
        run, "key string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_layers long, n_cut long"
    )
    return found.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
