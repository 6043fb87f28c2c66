"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text, and how often.

Tokenizer A (byte-level BPE) encodes ``" " + text``, tokenizer B (sentencepiece BPE, which adds the space itself)
encodes ``text``; neither adds special tokens, and special-token strings inside a text are plain text. Each token
stands for bytes: A's vocabulary entry mapped back through the byte-level alphabet, B's piece in UTF-8 with U+2581 as
a space and ``<0xHH>`` byte pieces as the byte. A text whose A or B bytes, joined, are not the bytes of
``" " + text`` (sentencepiece normalised it, or dropped characters) is left without tokens.

Per document, in numpy, with matrices in compressed sparse rows built by hand:

* the token-byte incidence of A and of B (one row per token occurrence, its bytes as columns); the Gustavson row
  product A·Bᵀ gives the overlap links, the pairs of occurrences sharing a byte (``n_overlaps``);
* the byte offsets where an A token and a B token both end cut the text into groups; the token-group incidences
  Ga and Gb give by the product Ga·Gbᵀ the shared-group links, all A-B occurrence pairs of a group (``n_links``).

Across documents Spark counts, for each (A id, B id), the documents that hold it linked (a partial aggregate, so a
pair in every document costs one row per task before the shuffle), the highest count of each A id, and joins both
back to the links of each document. The table of pairs is broadcast only when its counted size is under a bound;
beyond it the join is a shuffle that AQE splits where a pair is hot.

Edge cases: NULL or empty text, and texts whose bytes do not join up, give zeros and an empty ``groups_sha256``;
repeated rows are separate documents (each counts); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skytables.llm.columns import slices
from skytables.session import materialise

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
BROADCAST_PAIRS = 2_000_000

_PAIR = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("m", T.LongType())])
ALIGNED = T.StructType(
    [
        T.StructField("_row", T.LongType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("n_overlaps", T.LongType()),
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("pairs", T.ArrayType(_PAIR)),
    ]
)
_ARROW = pa.schema(
    [(f.name, pa.int64()) for f in ALIGNED.fields[:7]]
    + [("groups_sha256", pa.string()), ("pairs", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("m", pa.int64())])))]
)
_CACHE: dict = {}
_DECIMAL = np.array([str(i) for i in range(1 << 16)], dtype=object)  # ids as decimal text
_NO_PAIRS = (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64))


def _byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's printable stand-in for each byte: printable Latin-1 bytes stand for themselves, the others
    (0-32, 127-160, 173) take the code points from 256 on, in byte order."""
    keep = set(range(ord("!"), ord("~") + 1)) | set(range(ord("¡"), ord("¬") + 1)) | set(range(ord("®"), ord("ÿ") + 1))
    out, extra = {}, 0
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


def _ranked_encoder(path: str):
    """A's ids computed by tiktoken from the same vocabulary as ranks (the ``.tiktoken`` file beside the ``.json``)
    and the same split pattern: the same ids as the ``tokenizers`` file at about a third of the CPU time (the tests
    compare both); special-token strings are plain text."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path[: -len(".json")] + ".tiktoken", "rb") as ranks_file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file) if a}
    return tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """The two tokenizers and the bytes of every id, loaded once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(a_path)
        self.a = _ranked_encoder(a_path)
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = _byte_alphabet()
        self.a_bytes = []
        for i in range(tokenizer.get_vocab_size()):
            token = tokenizer.id_to_token(i) or ""
            self.a_bytes.append(bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode("utf-8"))
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode("utf-8"))
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        # all entries' bytes in one buffer, so that a text's bytes are gathered by one numpy index
        self.a_buf, self.a_at = np.frombuffer(b"".join(self.a_bytes), np.uint8), np.concatenate(([0], np.cumsum(self.a_len)[:-1]))
        self.b_buf, self.b_at = np.frombuffer(b"".join(self.b_bytes), np.uint8), np.concatenate(([0], np.cumsum(self.b_len)[:-1]))


def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    key = (a_path, b_path)
    if key not in _CACHE:
        _CACHE[key] = Vocabularies(a_path, b_path)
    return _CACHE[key]


class CSR:
    """A 0/1 sparse matrix in compressed sparse rows: row r holds columns ``indices[indptr[r]:indptr[r + 1]]``."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, n_cols: int):
        self.indptr, self.indices, self.n_cols = indptr, indices, n_cols

    @classmethod
    def from_lengths(cls, lengths: np.ndarray, n_cols: int) -> CSR:
        """Consecutive runs of columns: row r covers the next ``lengths[r]`` columns (tokens over bytes)."""
        indptr = np.concatenate(([0], np.cumsum(lengths)))
        return cls(indptr, np.arange(indptr[-1], dtype=np.int64), n_cols)

    @classmethod
    def from_labels(cls, labels: np.ndarray, n_cols: int) -> CSR:
        """One column per row (tokens over groups)."""
        return cls(np.arange(len(labels) + 1, dtype=np.int64), labels.astype(np.int64), n_cols)

    def transpose(self) -> CSR:
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        if np.all(self.indices[1:] >= self.indices[:-1]):  # columns already in order: rows stay as they are
            order = np.arange(len(self.indices))
        else:
            order = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.n_cols)
        return CSR(np.concatenate(([0], np.cumsum(counts))), rows[order], len(self.indptr) - 1)

    def times_transpose(self, other: CSR) -> tuple[np.ndarray, np.ndarray]:
        """Gustavson's row-wise product self · otherᵀ, as the (row, column) pairs of its non-zeros.

        For each row r of self and each column k in it, row k of otherᵀ is scattered into the result row r; the
        scatter of all rows is done at once, and equal pairs are merged.
        """
        other_t = other.transpose()
        rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))
        fan = np.diff(other_t.indptr)[self.indices]
        left = np.repeat(rows, fan)
        starts = np.repeat(other_t.indptr[self.indices], fan)
        within = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
        right = other_t.indices[starts + within]
        if len(left) == 0:
            return left, right
        key = left.astype(np.int64) * (other_t.n_cols + 1) + right
        if np.all(key[1:] >= key[:-1]):  # rows scattered in order (interval incidences): equal pairs are adjacent
            key = key[np.append(True, key[1:] != key[:-1])]
        else:
            key = np.unique(key)
        return key // (other_t.n_cols + 1), key % (other_t.n_cols + 1)


_CHUNK_BYTES = 1 << 20


def _gathered(buf: np.ndarray, at: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of the ids one after the other."""
    total = int(lengths.sum())
    starts = np.repeat(at[ids] - (np.cumsum(lengths) - lengths), lengths)
    return buf[starts + np.arange(total)].tobytes()


def _joins_up(buf: np.ndarray, at: np.ndarray, lengths: np.ndarray, ids: np.ndarray, target: bytes) -> bool:
    """Whether the ids' bytes, joined, are ``target``; compared a stretch of about 1 MB at a time."""
    ends = np.cumsum(lengths)
    first, done = 0, 0
    while first < len(ids):
        last = max(int(np.searchsorted(ends, done + _CHUNK_BYTES, side="right")), first + 1)
        size = int(ends[last - 1]) - done
        if _gathered(buf, at, lengths[first:last], ids[first:last]) != target[done : done + size]:
            return False
        first, done = last, done + size
    return True


def _overlaps(lengths_a: np.ndarray, lengths_b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray, cuts: np.ndarray) -> int:
    """Pairs of A and B occurrences that share a byte: the non-zeros of A·Bᵀ over the token-byte incidences, computed
    for stretches of about 1 MB that end at common cuts (no token crosses one), so memory stays bounded."""
    total = int(cuts[-1])
    stops = np.unique(np.append(cuts[np.minimum(np.searchsorted(cuts, np.arange(_CHUNK_BYTES, total, _CHUNK_BYTES)), len(cuts) - 1)], total))
    count, lo, ia, ib = 0, 0, 0, 0
    for hi in stops.tolist():
        ja = int(np.searchsorted(ends_a, hi, side="right"))
        jb = int(np.searchsorted(ends_b, hi, side="right"))
        bytes_a = CSR.from_lengths(lengths_a[ia:ja], hi - lo)
        bytes_b = CSR.from_lengths(lengths_b[ib:jb], hi - lo)
        count += len(bytes_a.times_transpose(bytes_b)[0])
        lo, ia, ib = hi, ja, jb
    return count


def _described(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2,b3``: each group's A ids, then its B ids, in order; built by one join."""
    same_a = np.append(group_a[1:] == group_a[:-1], False)
    same_b = np.append(group_b[1:] == group_b[:-1], False)
    sep_a = np.where(same_a, ",", "|")
    sep_b = np.where(same_b, ",", ";")
    sep_b[-1] = ""
    # groups are consecutive runs of both: A token i goes after the B tokens of earlier groups, B token j after the
    # A tokens of its group and of earlier ones
    groups = int(group_a[-1]) + 1
    b_before = np.searchsorted(group_b, np.arange(groups))
    a_through = np.searchsorted(group_a, np.arange(groups), side="right")
    place = np.empty(len(a) + len(b), dtype=np.int64)
    place[: len(a)] = np.arange(len(a)) + b_before[group_a]
    place[len(a) :] = np.arange(len(b)) + a_through[group_b]
    out = np.empty(2 * len(place), dtype=object)
    out[2 * place] = _DECIMAL[np.concatenate((a, b))]
    out[2 * place + 1] = np.concatenate((sep_a, sep_b))
    return "".join(out.tolist())


def align(v: Vocabularies, text: str | None, a_ids: list[int], b_ids: list[int]) -> dict | None:
    """Groups, links and id pairs (arrays a, b, m) of one text; None when it has no tokens."""
    if not text:
        return None
    target = (" " + text).encode("utf-8")
    a = np.asarray(a_ids, dtype=np.int64)
    b = np.asarray(b_ids, dtype=np.int64)
    if not len(a) or not len(b):
        return None
    la, lb = v.a_len[a], v.b_len[b]
    if la.sum() != len(target) or lb.sum() != len(target):
        return None
    if not _joins_up(v.a_buf, v.a_at, la, a, target) or not _joins_up(v.b_buf, v.b_at, lb, b, target):
        return None
    ends_a, ends_b = np.cumsum(la), np.cumsum(lb)
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)  # ends strictly increase
    overlaps = _overlaps(la, lb, ends_a, ends_b, cuts)
    group_a = np.searchsorted(cuts, ends_a, side="left")
    group_b = np.searchsorted(cuts, ends_b, side="left")
    left, right = CSR.from_labels(group_a, len(cuts)).times_transpose(CSR.from_labels(group_b, len(cuts)))
    pair_key, mult = np.unique(a[left] * 65536 + b[right], return_counts=True)
    return {
        "n_a": len(a),
        "n_b": len(b),
        "n_groups": len(cuts),
        "n_links": len(left),
        "n_overlaps": overlaps,
        "groups_sha256": hashlib.sha256(_described(a, b, group_a, group_b).encode()).hexdigest(),
        "pairs": ((pair_key // 65536).astype(np.int32), (pair_key % 65536).astype(np.int32), mult.astype(np.int64)),
    }


def _aligner(a_path: str, b_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = vocabularies(a_path, b_path)
        context = TaskContext.get()
        row = (context.partitionId() if context else 0) << 33
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            texts = batch.column("text").to_pylist()
            present = [t or "" for t in texts]
            for lo, hi in slices(present):
                a_enc = v.a.encode_ordinary_batch([" " + t for t in present[lo:hi]], num_threads=1)
                b_enc = v.b.encode(present[lo:hi], out_type=int, num_threads=1)
                out = {name: [] for name in _ARROW.names if name != "pairs"}
                parts: list[tuple] = []
                for doc_id, text, ea, eb in zip(doc_ids[lo:hi], texts[lo:hi], a_enc, b_enc):
                    found = align(v, text, ea, eb)
                    out["_row"].append(row)
                    out["doc_id"].append(doc_id)
                    row += 1
                    for key in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps"):
                        out[key].append(found[key] if found else 0)
                    out["groups_sha256"].append(found["groups_sha256"] if found else "")
                    parts.append(found["pairs"] if found else _NO_PAIRS)
                del a_enc, b_enc
                sizes = np.array([len(p[0]) for p in parts], dtype=np.int32)
                flat = pa.StructArray.from_arrays(
                    [pa.array(np.concatenate([p[k] for p in parts])) for k in range(3)], names=["a", "b", "m"]
                )
                pairs = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), flat)
                columns = [pa.array(out[name], type=field.type) for name, field in zip(_ARROW.names, _ARROW) if name != "pairs"]
                yield pa.RecordBatch.from_arrays(columns + [pairs.cast(_ARROW.field("pairs").type)], schema=_ARROW)

    return run


def align_tokenizers(documents: DataFrame, a_path: str | None = None, b_path: str | None = None, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path = a_path or public_tokenizers.path(A_FILE)
        b_path = b_path or public_tokenizers.path(B_FILE)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned = materialise(rows.mapInArrow(_aligner(a_path, b_path), ALIGNED))
    links = aligned.select("_row", F.explode("pairs").alias("p")).select("_row", "p.a", "p.b", "p.m")
    counts = links.groupBy("a", "b").agg(F.count(F.lit(1)).alias("docs"))
    best = counts.groupBy(F.col("a").alias("best_a")).agg(F.max("docs").alias("best"))
    table = materialise(counts.join(best, counts.a == best.best_a).select("a", "b", "docs", (F.col("docs") == F.col("best")).alias("is_best")))
    if table.count() <= broadcast_pairs:
        table = F.broadcast(table)
    per_doc = (
        links.join(table, ["a", "b"])
        .groupBy("_row")
        .agg(F.sum(F.when(F.col("is_best"), F.col("m")).otherwise(0)).alias("n_best"), F.sum(F.col("m") * F.col("docs")).alias("count_sum"))
        .withColumnRenamed("_row", "_linked_row")
    )
    zero = F.lit(0).cast("long")
    return aligned.join(per_doc, aligned["_row"] == per_doc["_linked_row"], "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
        "n_overlaps",
    )
