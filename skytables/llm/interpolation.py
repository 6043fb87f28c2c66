"""Language-model scoring by deleted interpolation.

The probability of a token after another mixes the maximum-likelihood estimates of the pair, of the token alone and a uniform
floor. Weights depend on how often the context was seen, one set for each power of two, and are learned by expectation
maximisation: one fold of the training documents is deleted from the counts and predicted from the rest.

Texts are dealt into blocks, each of one task's size. A block asks for each of its distinct tokens and pairs once; requests
meet by key, where counts are summed over all blocks, and every block gets its answers in the order of its requests. So a
frequent token crosses the network once per block, and neither vocabulary nor counts are ever gathered in one place. Only a
summary of fixed size (context class by probability class) reaches the driver, for the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytables.llm.columns import text_of
from skytables.llm.shingles import mixed, word_hashes
from skytables.session import materialise

FOLDS, HELD_OUT, DELETED = 10, 0, 1
_START, _END = np.uint64(0x51A27), np.uint64(0xE4D)
_CLASSES = 40
_STEPS_PER_OCTAVE = 4


def _pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: high bytes are mostly zero."""
    return zlib.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed(rows: DataFrame) -> DataFrame:
    """The rows (block, key, fold, text) in compressed pieces, one for each block and batch, for a lighter shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for block, part in batch.groupby("block"):
                table = pa.table({"key": pa.array(part["key"], pa.string(), from_pandas=True), "fold": part["fold"], "text": part["text"]})
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                    writer.write_table(table)
                out.append((block, sink.getvalue().to_pybytes()))
            yield pd.DataFrame(out, columns=["block", "docs"])

    return rows.select("block", "key", "fold", "text").mapInPandas(run, "block long, docs binary")


def _unpacked(pieces: pd.DataFrame) -> pd.DataFrame:
    return pa.concat_tables([pa.ipc.open_stream(d).read_all() for d in pieces["docs"]]).to_pandas()


def _tokens(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (words, then one end), the token before each, and the number of tokens of each text."""
    words, ends = word_hashes(texts)
    lengths = np.diff(ends, prepend=0) + 1
    stops = np.cumsum(lengths)
    tokens = np.empty(int(stops[-1]) if len(stops) else 0, np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[stops - 1] = True
    tokens[~is_end] = words
    tokens[is_end] = _END
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[stops - lengths] = _START
    return tokens, before, lengths


def _pairs(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mixed(before * np.uint64(0x9E3779B97F4A7C15) + mixed(tokens))


def _requests(pieces: pd.DataFrame, parts: int) -> pd.DataFrame:
    """A block's distinct keys with their training and deleted counts, by kind (0: token, 1: pair) and part."""
    block = _unpacked(pieces)
    tokens, before, lengths = _tokens(block["text"].tolist())
    fold = np.repeat(block["fold"].to_numpy(), lengths)
    name, out = int(pieces["block"].iloc[0]), []
    for kind, keys in enumerate((tokens, _pairs(before, tokens))):
        distinct, place = np.unique(keys, return_inverse=True)
        trained = np.bincount(place, fold != HELD_OUT, len(distinct)).astype(np.uint32)
        deleted = np.bincount(place, fold == DELETED, len(distinct)).astype(np.uint32)
        part = ((distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        cuts = np.searchsorted(part, np.arange(parts + 1))
        for p in range(parts):
            at = slice(cuts[p], cuts[p + 1])
            if cuts[p] < cuts[p + 1]:
                out.append((p, kind, name, _pack(np.diff(distinct[at], prepend=np.uint64(0))), _pack(trained[at]), _pack(deleted[at])))
    return pd.DataFrame(out, columns=["part", "kind", "block", "keys", "trained", "deleted"])


def _answers(part: pd.DataFrame) -> pd.DataFrame:
    """Counts over all blocks for each block's keys, and one row with the part's totals (block -1)."""
    keys = [np.cumsum(_unpack(k, np.uint64), dtype=np.uint64) for k in part["keys"]]
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    totals = [
        np.bincount(place, np.concatenate([_unpack(c, np.uint32) for c in part[name]]), len(distinct)).astype(np.int64)
        for name in ("trained", "deleted")
    ]
    p, kind = int(part["part"].iloc[0]), int(part["kind"].iloc[0])
    out, at = [(-1, kind, p, None, None, int((totals[0] > 0).sum()), int(totals[0].sum()), int(totals[1].sum()))], 0
    for block, own in zip(part["block"], keys):
        mine = place[at : at + len(own)]
        at += len(own)
        out.append((int(block), kind, p, _pack(totals[0][mine]), _pack(totals[1][mine]), None, None, None))
    columns = ["block", "kind", "part", "trained", "deleted", "n_distinct", "n_trained", "n_deleted"]
    return pd.DataFrame(out, columns=columns).astype({c: "Int64" for c in columns[5:]})


class _Counts:
    """Counts of a block's tokens, pairs and contexts, in text order."""

    def __init__(self, docs: pd.DataFrame, answers: pd.DataFrame, docs_total: int, deleted_docs: int, without_deleted: bool):
        tokens, before, self.lengths = _tokens(docs["text"].tolist())
        got = []
        for kind, keys in enumerate((tokens, _pairs(before, tokens))):
            own = answers[answers["kind"] == kind].sort_values("part")
            count = np.concatenate([_unpack(c, np.int64) for c in own["trained"]])
            if without_deleted:
                count = count - np.concatenate([_unpack(c, np.int64) for c in own["deleted"]])
            got.append(count[np.unique(keys, return_inverse=True)[1]])
        self.token, self.pair = got
        first = np.cumsum(self.lengths) - self.lengths
        self.context = np.empty_like(self.token)
        self.context[1:] = self.token[:-1]
        self.context[first] = docs_total - (deleted_docs if without_deleted else 0)

    def classes(self) -> np.ndarray:
        return np.where(self.context > 0, 1 + np.log2(np.maximum(self.context, 1)).astype(int), 0).clip(0, _CLASSES - 1)

    def estimates(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return self.pair / np.maximum(self.context, 1), self.token / max(n, 1)


def _grade(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, 1 + np.floor(-np.log2(np.maximum(p, 1e-300)) * _STEPS_PER_OCTAVE), 0).clip(0, 400).astype(int)


def learn_weights(cells: pd.DataFrame, floor: float, rounds: int = 60) -> np.ndarray:
    """Mixture weights (pair, token, floor) by context class, from counts ``n`` of events with mean estimates f2 and f1.

    A class starts from the weights of all events, which also count as ten events of its own, so no weight becomes zero.
    """

    def maximise(f: np.ndarray, n: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
        weights = prior.copy()
        for _ in range(rounds):
            part = f * weights
            part = part / part.sum(axis=1, keepdims=True) * n[:, None]
            weights = part.sum(axis=0) + strength * prior
            weights /= weights.sum()
        return weights

    f = np.stack([cells["f2"], cells["f1"], np.full(len(cells), floor)], axis=1).astype(float)
    n = cells["n"].to_numpy(float)
    start = np.array([0.3, 0.6, 0.1])
    common = maximise(f, n, start, 10.0) if len(cells) else start
    out = np.tile(common, (_CLASSES, 1))
    for k in sorted(set(cells["class"])):
        own = (cells["class"] == k).to_numpy()
        out[k] = maximise(f[own], n[own], common, 10.0)
    return out.round(12)


def interpolated_scores(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", block_bytes: int = 24 << 20, least_blocks: int = 96
) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row.

    Documents are dealt into ten folds by the CRC-32 of their key as text (NULL as empty); fold 0 is held out, the others
    train, and fold 1 is the part deleted for learning the weights. Tokens are words (A-Z lower-cased) and one end; a NULL or
    empty text has the end alone. ``base_score`` is the add-0.1 unigram, ``score`` the interpolated model, both log10.
    Repeated rows count and are scored each. With no training documents all counts are 0. An empty table gives an empty
    result. Other columns are dropped. Blocks grow with the square root of the corpus, so that requests of one block stay
    large enough to be packed.
    """
    fold = (F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).cast("string").alias("key"), text_of(text).alias("text"), fold.alias("fold"))
    train, dropped = F.col("fold") != HELD_OUT, F.col("fold") == DELETED
    size, trained_docs, deleted_docs = rows.agg(F.sum(F.octet_length("text") + 1), F.count_if(train), F.count_if(dropped)).first()
    size = size or 0
    blocks = max(math.ceil(size / max(block_bytes, math.isqrt(size * 10_000))), least_blocks)
    small = max(blocks // (FOLDS - 1), 1)
    place = F.xxhash64("key", "text")
    block = F.when(dropped, F.pmod(place, F.lit(small))).otherwise(F.lit(small) + F.pmod(place, F.lit(blocks)))
    rows = rows.withColumn("block", block)

    asked = _packed(rows).groupBy("block").applyInPandas(
        lambda pieces: _requests(pieces, blocks), "part int, kind int, block long, keys binary, trained binary, deleted binary"
    )
    answers = materialise(
        asked.groupBy("part", "kind").applyInPandas(
            _answers,
            "block long, kind int, part int, trained binary, deleted binary, n_distinct long, n_trained long, n_deleted long",
        )
    )
    totals = answers.filter("block < 0 and kind = 0").agg(F.sum("n_distinct"), F.sum("n_trained"), F.sum("n_deleted")).first()
    v, n, n_deleted = (x or 0 for x in totals)
    answers = answers.filter("block >= 0").select("block", "kind", "part", "trained", "deleted")

    def events(pieces: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if pieces.empty:
            return pd.DataFrame([], columns=["class", "q2", "q1", "n", "f2", "f1"])
        counts = _Counts(_unpacked(pieces), answers, trained_docs, deleted_docs, True)
        f2, f1 = counts.estimates(n - n_deleted)
        each = pd.DataFrame({"class": counts.classes(), "q2": _grade(f2), "q1": _grade(f1), "n": 1, "f2": f2, "f1": f1})
        return each.groupby(["class", "q2", "q1"], as_index=False).sum()

    deleted = _packed(rows.filter(dropped)).groupBy("block").cogroup(answers.filter(F.col("block") < small).groupBy("block"))
    cells = deleted.applyInPandas(events, "class int, q2 int, q1 int, n long, f2 double, f1 double").groupBy("class", "q2", "q1")
    cells = cells.agg(F.sum("n").alias("n"), F.sum("f2").alias("f2"), F.sum("f1").alias("f1")).toPandas()
    cells[["f2", "f1"]] = cells[["f2", "f1"]].div(cells["n"], axis=0)
    weights = learn_weights(cells.sort_values(["class", "q2", "q1"]), 1 / (v + 1))

    def scores(pieces: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if pieces.empty:
            return pd.DataFrame([], columns=names)
        docs = _unpacked(pieces)
        counts = _Counts(docs, answers, trained_docs, deleted_docs, False)
        first = np.cumsum(counts.lengths) - counts.lengths
        base = np.log10((counts.token + 0.1) / (n + 0.1 * (v + 1)))
        f2, f1 = counts.estimates(n)
        w = weights[counts.classes()]
        model = np.log10(w[:, 0] * f2 + w[:, 1] * f1 + w[:, 2] / (v + 1))
        out = [
            docs["key"].to_numpy(),
            docs["fold"].to_numpy() == HELD_OUT,
            counts.lengths,
            np.add.reduceat((counts.token > 0).astype(np.int64), first),
            np.full(len(docs), n),
            np.add.reduceat(base, first),
            np.add.reduceat(model, first),
        ]
        return pd.DataFrame(dict(zip(names, out)))

    scored = _packed(rows).groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(
        scores, "key string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
    return scored.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
