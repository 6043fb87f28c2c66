"""Near-duplicates by an inverted join over signature coordinates.

A text's set of shingles gets a MinHash signature. Two sets are candidates when their signatures agree in at least
``matches`` of ``coordinates`` places, so they agree in one of any ``coordinates - matches + 1``: each text is posted under
that many (coordinate, value) pairs only, its rarest ones. The long lists, those of values that many texts share, are thus
skipped by all texts that have enough rare values. Rarity comes from a table of fixed size, counts by hash of the pair.
Agreement over all coordinates is counted at one bit each, which every posting carries; what is left is confirmed on the
full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skytables.llm.columns import unused
from skytables.llm.linking import link
from skytables.llm.shingles import digest, minhash, mixed, shingle_sets
from skytables.session import materialise

COORDINATES = 128
_LOAD_BITS = 16
# A coordinate of two sets at similarity s differs at one bit with probability (1 - s) / 2: 12.8 of 128 at 0.8; 30 lies five
# standard deviations above.
MAX_BITS = 30


def _tokens(signature: np.ndarray) -> np.ndarray:
    """A hash for each (coordinate, value) pair of signatures, one row each."""
    place = np.arange(signature.shape[1], dtype=np.uint64) << np.uint64(32)
    return mixed(signature.astype(np.uint64) | place[None, :])


def _signatures(batch: pd.DataFrame) -> np.ndarray:
    return np.stack([np.frombuffer(s, np.uint32) for s in batch["sig"]]) if len(batch) else np.zeros((0, COORDINATES), np.uint32)


def sets_and_signatures(documents: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(doc, n_shingles, fp, sig): the set's size, digest and signature; fp and sig are NULL for an empty set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                sets = shingle_sets(part["text"].tolist(), size)
                yield pd.DataFrame(
                    {
                        "doc": part["doc"].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "fp": [digest(s) if len(s) else None for s in sets],
                        "sig": [minhash(s, COORDINATES).tobytes() if len(s) else None for s in sets],
                    }
                )

    # As text, since pandas would turn numbers beside NULLs to floats.
    rows = documents.select(F.col(key).cast("long").cast("string").alias("doc"), F.col(text).alias("text"))
    found = rows.mapInPandas(run, "doc string, n_shingles long, fp binary, sig binary")
    return found.withColumn("doc", F.col("doc").cast("long"))


def _list_loads(reps: DataFrame) -> np.ndarray:
    """How many texts have a (coordinate, value) pair in each of the hash classes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        load = np.zeros(1 << _LOAD_BITS, np.int64)
        for batch in batches:
            load += np.bincount((_tokens(_signatures(batch)) >> np.uint64(64 - _LOAD_BITS)).astype(np.int64).ravel(), minlength=len(load))
        (used,) = np.nonzero(load)
        yield pd.DataFrame({"slot": used, "n": load[used]})

    counts = reps.select("sig").mapInPandas(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << _LOAD_BITS, np.int64)
    out[counts["slot"].to_numpy(int)] = counts["n"].to_numpy(int)
    return out


def _postings(reps: DataFrame, matches: int) -> DataFrame:
    """(key, node, s0, s1) for the rarest coordinate-value pairs of each signature."""
    loads = reps.sparkSession.sparkContext.broadcast(_list_loads(reps))
    prefix = COORDINATES - matches + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048]
                signature = _signatures(part)
                tokens = _tokens(signature)
                rarity = loads.value[(tokens >> np.uint64(64 - _LOAD_BITS)).astype(np.int64)]
                chosen = np.argsort(rarity, axis=1, kind="stable")[:, :prefix]  # equal loads: the lower coordinate
                sketch = np.packbits((signature & np.uint32(1)).astype(bool), axis=1).view(">i8").astype(np.int64)
                yield pd.DataFrame(
                    {
                        "key": np.take_along_axis(tokens, chosen, 1).ravel().view(np.int64),
                        "node": np.repeat(part["doc"].to_numpy(np.int64), prefix),
                        "s0": np.repeat(sketch[:, 0], prefix),
                        "s1": np.repeat(sketch[:, 1], prefix),
                    }
                )

    return reps.select("doc", "sig").mapInPandas(run, "key long, node long, s0 long, s1 long")


def near_duplicates(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 80, matches: int = 80
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row.

    Texts whose shingle sets have a Jaccard similarity of at least ``percent`` hundredths are linked; ``component_id`` is the
    least key reachable and ``kept`` marks its row. Lower-cased A-Z; words between spaces and 0x09-0x0D. A NULL or empty text
    has an empty set and no link. Rows with equal keys are one document: links of either hold for both, and all of them are
    kept or none. A NULL key cannot be named by a link: its component is NULL and it is kept. An empty table gives an empty
    result. Equal sets are folded to their least key before anything is paired.
    """
    sets = materialise(sets_and_signatures(documents, key, text, size))
    named = sets.filter(F.col("doc").isNotNull() & F.col("fp").isNotNull())
    folds = materialise(named.groupBy("fp").agg(F.min("doc").alias("rep")))
    reps = materialise(named.join(folds.select("fp", F.col("rep").alias("doc")), ["fp", "doc"], "left_semi").select("doc", "sig"))
    texts = documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    several = named.groupBy("doc").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi")
    same_key = materialise(named.join(several.select("doc"), "doc", "left_semi").select("doc", "fp"))
    known = same_key.join(folds, "fp").select(F.col("doc").alias("a"), F.col("rep").alias("b")).filter("a <> b")
    labels = link(_postings(reps, matches), texts, partial(shingle_sets, size=size), percent, MAX_BITS, known)

    found = folds.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    found = found.select("fp", F.coalesce("label", "rep").alias("component"))
    rows = sets.select("doc", "n_shingles", "fp").join(found, "fp", "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc"))
    return rows.select(
        F.col("doc").alias(key), "n_shingles", component.alias("component_id"), F.col("doc").eqNullSafe(component).alias("kept")
    )


def drop_near_duplicates(documents: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """One row of each group of near duplicates, whole; rows with a NULL key stay."""
    (mark,) = unused(documents, "_kept")
    result = near_duplicates(documents, key=key, **options)
    kept = materialise(result.filter(F.col("kept") & F.col(key).isNotNull()).select(F.col(key).alias(mark)).distinct())
    one = documents.join(kept, documents[key] == kept[mark], "left_semi").dropDuplicates([key])
    return one.unionByName(documents.filter(documents[key].isNull()))
