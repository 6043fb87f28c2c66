"""Packing: documents into sequences of at most ``window`` tokens, in their order, by dynamic programming.

Each document becomes its token ids (a byte-level BPE, no special tokens added) followed by the end id 0. The ids of
a run of documents form one stream; a packing is a choice of cut positions in it, and each stretch between two cuts
is a sequence. The cost of a packing is the padding of its sequences plus a penalty for each cut: none at a document
boundary, ``sentence_penalty`` at a sentence end inside a document, ``cut_penalty`` anywhere else. A sequence is
padded to ``window`` tokens unless its length is a power of two. Cut candidates are document boundaries, sentence ends
(after a token whose text ends in ``.``, ``!`` or ``?``) and, inside stretches longer than ``window`` without either,
the places ``window`` apart counted from both ends of the stretch.

The optimum comes from one left-to-right pass: f(j) = pen(j) + min(min over i in the last ``window`` tokens of
f(i) + window - (b_j - b_i), min over k of f(at b_j - 2^k)). The first term is a sliding-window minimum of f(i) + b_i,
kept by a monotone queue, so a block of n candidates costs O(n) plus eleven look-ups per candidate.

Spark plan: no shuffle. Each scan partition is sorted by doc_id and streamed through ``mapInArrow``: documents are
tokenized a batch at a time and gathered into blocks of about ``block_tokens`` tokens that end at a document boundary;
each block is packed and emitted before the next is read, so a task holds one block (and one document, however long).
Blocks cost at most one partly filled sequence each. Sequence ids are the partition number in the high bits and a
running count in the low ones: deterministic for a given input, so a lost task is recomputed to the same rows.

Edge cases: NULL text packs as the empty text (one id, the end id); very long texts are cut every ``window`` tokens
where they have no sentence end; repeated rows are packed as separate documents; ties of cost take the longest last
sequence (the earliest start); an empty table gives no rows; other input columns are not read.
"""

from __future__ import annotations

import collections
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.llm.columns import slices

WINDOW = 1024
END_ID = 0
SENTENCE_PENALTY = 8
CUT_PENALTY = 64
BLOCK_TOKENS = 1 << 20
TOKENIZER_FILE = "byte_bpe_50k.json"

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("padded_length", T.LongType()),
    ]
)
_ARROW = pa.schema([(f.name, pa.int64()) for f in PIECES.fields])
_CACHE: dict = {}


def tokenizer_path(name: str = TOKENIZER_FILE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _tokenizer(path: str):
    """The encoder and a table of which ids end a sentence, loaded once per Python worker.

    The ids are those of the ``tokenizers`` file at ``path``; they are computed by tiktoken from the same vocabulary
    given as ranks (the ``.tiktoken`` file beside it) and the same split pattern, which yields the same ids at about a
    third of the CPU time (the tests compare both). Special-token strings in a text are plain text.
    """
    if path not in _CACHE:
        import base64

        import public_tokenizers
        import tiktoken

        ranks_path = path[: -len(".json")] + ".tiktoken"
        with open(ranks_path, "rb") as ranks_file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file) if a}
        enc = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        ends = np.zeros(max(ranks.values()) + 2, dtype=bool)
        for piece, i in ranks.items():
            ends[i] = piece.rstrip()[-1:] in (b".", b"!", b"?")
        _CACHE[path] = (enc, ends)
    return _CACHE[path]


def padded(length: int, window: int = WINDOW) -> int:
    return length if length & (length - 1) == 0 else window


def plan_cuts(positions: list[int], penalties: list[int], window: int = WINDOW) -> tuple[list[int], int]:
    """Indices of the chosen cuts among increasing ``positions`` (first and last are always cut) and the least cost.

    Every gap between consecutive positions must be at most ``window``.
    """
    n = len(positions)
    if n == 1:
        return [0], 0
    at = {p: i for i, p in enumerate(positions)}
    best = [0] * n
    back = [0] * n
    queue: collections.deque[int] = collections.deque([0])  # indices, values best[i] + positions[i] increasing
    powers = [1 << k for k in range(window.bit_length()) if 1 << k <= window]
    for j in range(1, n):
        b = positions[j]
        while positions[queue[0]] < b - window:
            queue.popleft()
        i = queue[0]
        cost, arg = best[i] + positions[i] + window - b, i
        for p in powers:
            k = at.get(b - p)
            if k is not None and best[k] < cost:
                cost, arg = best[k], k
        best[j], back[j] = cost + penalties[j], arg
        value = best[j] + b
        while queue and best[queue[-1]] + positions[queue[-1]] > value:
            queue.pop()
        queue.append(j)
    cuts = [n - 1]
    while cuts[-1] != 0:
        cuts.append(back[cuts[-1]])
    cuts.reverse()
    return cuts, best[n - 1]


def candidates(lengths: list[int], sentence_ends: list[np.ndarray], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Cut positions and their penalties in a block of documents with the given token counts."""
    natural: dict[int, int] = {0: 0}
    base = 0
    for n, ends in zip(lengths, sentence_ends):
        for e in ends.tolist():
            if 0 < e < n:
                natural.setdefault(base + e, SENTENCE_PENALTY)
        base += n
        natural[base] = 0
    keys = sorted(natural)
    out = {p: natural[p] for p in keys}
    for a, b in zip(keys, keys[1:]):
        if b - a > window:
            for p in list(range(a + window, b, window)) + list(range(b - window, a, -window)):
                out.setdefault(p, CUT_PENALTY)
    positions = sorted(out)
    return positions, [out[p] for p in positions]


def _pack_block(docs: list[tuple], window: int, sequence_base: int) -> tuple[dict[str, list], int]:
    """docs: (doc_id, ids array, sentence-end offsets). Returns the piece columns and the number of sequences."""
    positions, penalties = candidates([len(d[1]) for d in docs], [d[2] for d in docs], window)
    cuts, _ = plan_cuts(positions, penalties, window)
    bounds = [positions[c] for c in cuts]
    out: dict[str, list] = {f.name: [] for f in PIECES.fields}
    doc_starts = np.cumsum([0] + [len(d[1]) for d in docs])
    d = 0
    for s, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        pos = lo
        while pos < hi:
            while doc_starts[d + 1] <= pos:
                d += 1
            doc_id, ids, _ = docs[d]
            start = pos - int(doc_starts[d])
            length = min(hi, int(doc_starts[d + 1])) - pos
            out["doc_id"].append(doc_id)
            out["start"].append(start)
            out["length"].append(length)
            out["ids_crc32"].append(zlib.crc32(ids[start : start + length].astype("<u4").tobytes()))
            out["doc_tokens"].append(len(ids))
            out["sequence_id"].append(sequence_base + s)
            out["offset"].append(pos - lo)
            out["padded_length"].append(padded(hi - lo, window))
            pos += length
    return out, len(bounds) - 1


def _packer(path: str, window: int, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tok, ends_table = _tokenizer(path)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        block: list[tuple] = []
        held = 0
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = [t if t is not None else "" for t in batch.column("text").to_pylist()]
            for lo, hi in slices(texts):
                encoded = tok.encode_ordinary_batch(texts[lo:hi], num_threads=1)
                for doc_id, enc in zip(doc_ids[lo:hi], encoded):
                    ids = np.append(np.asarray(enc, dtype=np.int32), np.int32(END_ID))
                    ends = np.flatnonzero(ends_table[ids[:-1]]) + 1
                    block.append((doc_id, ids, ends))
                    held += len(ids)
                    if held >= block_tokens:
                        out, used = _pack_block(block, window, sequence)
                        sequence += used
                        yield pa.RecordBatch.from_pydict(out, schema=_ARROW)
                        block, held = [], 0
                del encoded
        if block:
            out, _ = _pack_block(block, window, sequence)
            yield pa.RecordBatch.from_pydict(out, schema=_ARROW)

    return run


def pack_documents(
    documents: DataFrame, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS, tokenizer: str | None = None
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length."""
    path = tokenizer or tokenizer_path()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.sortWithinPartitions("doc_id").mapInArrow(_packer(path, window, block_tokens), PIECES)
