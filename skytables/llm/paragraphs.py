"""Repeated passages: paragraph MinHash banding.

Paragraphs (lines of a text) of enough words get a MinHash signature of their five-word shingles. Paragraphs that agree in
all rows of a band are candidates; bands are tuned for recall: with ``rows`` values a band, a pair at the threshold is missed
by all bands with probability (1 - threshold ** rows) ** bands, and the number of bands is the least that keeps this under
``miss``. Candidates are confirmed by their exact Jaccard similarity, linked paragraphs form clusters (connected components),
and all but the first paragraph of a cluster are marked for removal.

Equal shingle sets are folded before anything is paired, so a passage in a third of all documents is one paragraph here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skytables.llm.linking import link
from skytables.llm.shingles import digest, minhashes, mixed, rolling, sets_of_words, shingle_sets, word_hashes, word_spans
from skytables.llm.signature_join import COORDINATES, MAX_BITS
from skytables.session import materialise

SHINGLE = 5
_RUN = 25  # words of a run, and runs of which the least is posted
_STRETCH = 1 << 20


def tuned_bands(percent: int, rows: int, miss: float) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def _node(fp: bytes) -> int:
    return int.from_bytes(fp[:8], "big", signed=True)


def _cut(texts: list, least_words: int) -> tuple[list, list, list]:
    """Paragraphs of the texts with enough words, (text number, paragraph number, start, end, words) and shingle set of each."""
    parts, where = [], []
    for i, text in enumerate(texts):
        at = 0
        for k, part in enumerate((text if isinstance(text, str) else "").split("\n")):
            parts.append(part)
            where.append((i, k, at, at + len(part)))
            at += len(part) + 1
    words, ends = word_hashes(parts)
    counts = np.diff(ends, prepend=0)
    keep = np.flatnonzero(counts >= max(least_words, 1)).tolist()
    sets = sets_of_words(words, ends, SHINGLE, max(least_words, 1))
    return [parts[j] for j in keep], [(*where[j], int(counts[j])) for j in keep], sets


def _stretches(texts: list) -> Iterator[slice]:
    """Slices of at most 256 texts and about ``_STRETCH`` characters, or of one longer text."""
    begin = chars = 0
    for i, text in enumerate(texts):
        chars += len(text) if isinstance(text, str) else 0
        if chars >= _STRETCH or i + 1 - begin == 256:
            yield slice(begin, i + 1)
            begin, chars = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def _paragraph_rows(documents: DataFrame, least_words: int, bands: int, rows: int) -> DataFrame:
    """(doc, para, start, end, n_words, fp, node, sketch, keys, text) of each long enough paragraph."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, texts = batch["doc"].to_numpy(), batch["text"].tolist()
            for some in _stretches(texts):
                parts, where, sets = _cut(texts[some], least_words)
                if not parts:
                    continue
                signature = minhashes(sets, COORDINATES, seed=3)
                banded = signature[:, : bands * rows].astype(np.uint64).reshape(-1, bands, rows)
                key = np.arange(bands, dtype=np.uint64)[None, :]
                for r in range(rows):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + banded[:, :, r])
                sketch = np.packbits((signature & np.uint32(1)).astype(bool), axis=1)
                text_no, para, start, end, n_words = np.array(where, np.int64).T
                fps = [digest(s) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc": docs[some][text_no],
                        "para": para,
                        "start": start,
                        "end": end,
                        "n_words": n_words,
                        "fp": fps,
                        "node": [_node(fp) for fp in fps],
                        "sketch": [s.tobytes() for s in sketch],
                        "keys": [k.tobytes() for k in key],
                        "text": parts,
                    }
                )

    return documents.mapInPandas(
        run,
        "doc long, para long, start long, end long, n_words long, fp binary, node long, sketch binary, keys binary, text string",
    )


def _postings(folds: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            keys = np.frombuffer(b"".join(batch["keys"]), np.int64)
            sketch = np.frombuffer(b"".join(batch["sketch"]), ">i8").astype(np.int64).reshape(-1, 2)
            n = len(keys) // len(batch)
            yield pd.DataFrame(
                {
                    "key": keys,
                    "node": np.repeat(batch["node"].to_numpy(np.int64), n),
                    "s0": np.repeat(sketch[:, 0], n),
                    "s1": np.repeat(sketch[:, 1], n),
                }
            )

    return folds.select("node", "sketch", "keys").mapInPandas(run, "key long, node long, s0 long, s1 long")


def repeated_paragraphs(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    percent: int = 80,
    least_words: int = 20,
    rows: int = 3,
    miss: float = 0.005,
) -> DataFrame:
    """A row for each paragraph that has a copy or near copy anywhere: its key, paragraph number, start and end (code
    points), n_words, the first paragraph of its cluster (first_doc, first_paragraph), the cluster's size and ``kept``.

    Paragraphs of fewer than ``least_words`` words are lines, not passages: they are never marked. Similarity is of sets of
    five-word shingles, A-Z lower-cased, at least ``percent`` hundredths. NULL and empty texts have no paragraphs. NULL keys
    order last. Repeated rows are copies like any other; where key and number are equal too, all of them are kept or none. An
    empty table gives an empty result; other columns are dropped.
    """
    docs = documents.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    # NULL keys would turn numbers to floats in pandas; they travel as the largest key.
    docs = docs.withColumn("doc", F.coalesce("doc", F.lit(2**63 - 1)))
    found = materialise(_paragraph_rows(docs, least_words, tuned_bands(percent, rows, miss), rows), "zstd")
    folds = found.groupBy("fp").agg(
        F.min(F.struct("doc", "para")).alias("first"), F.count("*").alias("n"), F.min("sketch").alias("sketch"), F.min("keys").alias("keys"),
        F.min("node").alias("node"),
    )
    folds = materialise(folds)
    labels = link(_postings(folds), found.select("node", "text"), partial(shingle_sets, size=SHINGLE), percent, MAX_BITS)
    grouped = folds.select("fp", "node", "first", "n").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    grouped = materialise(grouped.select("fp", "label", "first", "n"))
    clusters = grouped.groupBy("label").agg(F.min("first").alias("first"), F.sum("n").alias("copies")).filter("copies > 1")
    marks = materialise(grouped.select("fp", "label").join(clusters, "label").select("fp", "first", "copies"))
    none = F.lit(2**63 - 1)
    return found.select("doc", "para", "start", "end", "n_words", "fp").join(marks, "fp").select(
        F.nullif(F.col("doc"), none).alias(key),
        F.col("para").alias("paragraph"),
        "start",
        "end",
        "n_words",
        F.nullif(F.col("first.doc"), none).alias("first_doc"),
        F.col("first.para").alias("first_paragraph"),
        "copies",
        (F.struct("doc", "para") == F.col("first")).alias("kept"),
    )


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    span = 1
    while 2 * span <= width:
        values = least(values[:-span], values[span:])
        span *= 2
    return least(values[: span - width], values[width - span :]) if span < width else values


def _winnowed(values: np.ndarray, width: int) -> np.ndarray:
    """Places of the values that are the least of some ``width`` neighbours, all of equal ones."""
    if len(values) <= width:
        return np.flatnonzero(values == values.min()) if len(values) else np.zeros(0, int)
    edge = np.zeros(width - 1, values.dtype)
    return np.flatnonzero(_sliding(np.concatenate((edge, _sliding(values, width, np.minimum), edge)), width, np.maximum) == values)


def _run_rows(documents: DataFrame, size: int) -> DataFrame:
    """(doc, body, run, word, start, end) of the winnowed runs of ``size`` words; ``body`` tells texts apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, texts = batch["doc"].to_numpy(np.int64), batch["text"].tolist()
            for some in _stretches(texts):
                out = []
                for doc, text in zip(docs[some], texts[some]):
                    words, starts, ends = word_spans(text if isinstance(text, str) else None)
                    values = rolling(words, size)
                    at = _winnowed(values, size)
                    if len(at):
                        body = np.full(len(at), _node(digest(words)))
                        out.append((np.full(len(at), doc), body, values[at].view(np.int64), at, starts[at], ends[at + size - 1]))
                if out:
                    columns = ("doc", "body", "run", "word", "start", "end")
                    yield pd.DataFrame({name: np.concatenate(c) for name, c in zip(columns, zip(*out))})

    return documents.mapInPandas(run, "doc long, body long, run long, word long, start long, end long")


def repeated_spans(documents: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = _RUN) -> DataFrame:
    """A row for each stretch of words of which every run of ``size`` is word for word in another text too, whatever the lines:
    its key, start and end (code points), n_words, first_doc (the least key that has one of its runs), copies (the most
    places of one run) and ``kept`` (no run is in a lesser key).

    Of any ``size`` neighbouring runs the one with the least hash is posted, so two texts that share ``2 * size - 1`` words
    in a row always post one of the same runs, and posted runs leave no gap; a span may begin or end up to ``size - 1``
    words inside what is shared. A-Z count as a-z. NULL keys order last and are one key; rows equal in key and text are one
    text.
    """
    none = F.lit(2**63 - 1)
    docs = documents.select(F.coalesce(F.col(key).cast("long"), none).alias("doc"), F.col(text).alias("text"))
    runs = materialise(_run_rows(docs, size), "zstd")
    holders = runs.groupBy("run").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("body").alias("lo"), F.max("body").alias("hi"), F.count("*").alias("n")
    )
    shared = holders.filter("first <> last OR lo <> hi").select("run", "first", "n")
    of_text = Window.partitionBy("doc", "body").orderBy("word")
    before = F.lag("word").over(of_text)
    marked = runs.join(shared, "run").withColumn("_new", F.coalesce(F.col("word") > before + size, F.lit(True)).cast("long"))
    spans = marked.withColumn("_span", F.sum("_new").over(of_text.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc", "body", "_span").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("word") - F.min("word") + size).alias("n_words"),
        F.min("first").alias("first"),
        F.max("n").alias("copies"),
    )
    return spans.select(
        F.nullif("doc", none).alias(key), "start", "end", "n_words", F.nullif("first", none).alias("first_doc"), "copies",
        (F.col("first") == F.col("doc")).alias("kept"),
    )


def repeated_passages(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of :func:`repeated_paragraphs` and, with paragraph numbers NULL, those of :func:`repeated_spans`: passages
    broken into short lines or inside of unlike paragraphs have no paragraph to be found by."""
    paragraphs = repeated_paragraphs(documents, key=key, text=text, **options)
    return paragraphs.unionByName(repeated_spans(documents, key=key, text=text), allowMissingColumns=True)


def without_repeats(documents: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents with the marked paragraphs cut out of their texts; a text that is cut loses their line breaks too."""
    marks = repeated_paragraphs(documents, key=key, text=text, **options)
    cuts = marks.filter(~F.col("kept") & F.col(key).isNotNull()).groupBy(F.col(key).alias("_cut_key"))
    cuts = materialise(cuts.agg(F.collect_set("paragraph").alias("_cuts")))
    lines = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains("_cuts", i.cast("long")))
    kept = F.when(F.col("_cuts").isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))
    joined = documents.join(cuts, documents[key] == cuts["_cut_key"], "left")
    return joined.withColumn(text, kept).select(*documents.columns)
