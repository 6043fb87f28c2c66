import random
import zlib

import numpy as np
import pytest

from skytables.llm.packing import END_ID, padded, pack_documents, plan_cuts, tokenizer_path


def _naive(positions, penalties, window):
    """Plain DP over all earlier candidates in reach."""
    n = len(positions)
    best = [0] + [float("inf")] * (n - 1)
    for j in range(1, n):
        for i in range(j):
            length = positions[j] - positions[i]
            if length <= window:
                best[j] = min(best[j], best[i] + padded(length, window) - length + penalties[j])
    return best[-1]


@pytest.mark.parametrize("seed", range(60))
def test_monotone_queue_equals_plain_dp(seed):
    rnd = random.Random(seed)
    window = rnd.choice([8, 16, 64])
    positions = [0]
    while len(positions) < rnd.randrange(2, 60):
        positions.append(positions[-1] + rnd.randrange(1, window + 1))
    penalties = [0] + [rnd.choice([0, 8, 64]) for _ in positions[1:]]
    cuts, cost = plan_cuts(positions, penalties, window)
    assert cost == _naive(positions, penalties, window)
    assert cuts[0] == 0 and cuts[-1] == len(positions) - 1
    again = sum(padded(positions[b] - positions[a], window) - (positions[b] - positions[a]) + penalties[b] for a, b in zip(cuts, cuts[1:]))
    assert again == cost and all(positions[b] - positions[a] <= window for a, b in zip(cuts, cuts[1:]))


def _check(df, texts, window):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    tok.encode_special_tokens = True
    rows = df.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for parts in seqs.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
        total = sum(p.length for p in parts)
        assert 0 < total <= window and all(p.padded_length == padded(total, window) for p in parts)
    for doc_id, text in texts:
        ids = np.append(np.asarray(tok.encode(text or "", add_special_tokens=False).ids, dtype=np.int64), END_ID)
        parts = sorted(by_doc.pop(doc_id), key=lambda r: r.start)
        assert [p.start for p in parts] == list(np.cumsum([0] + [p.length for p in parts[:-1]]))
        assert sum(p.length for p in parts) == len(ids) and all(p.doc_tokens == len(ids) for p in parts)
        for p in parts:
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].astype("<u4").tobytes())
    assert not by_doc
    return rows


def test_documents_are_whole_and_little_padded(spark, sample):
    texts = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    rows = _check(pack_documents(sample, block_tokens=1 << 14), texts, 1024)
    seqs = {}
    for r in rows:
        seqs[r.sequence_id] = r.padded_length
    tokens = sum(r.length for r in rows)
    assert sum(seqs.values()) - tokens < 0.05 * tokens


def test_nulls_long_repeated_and_clashing(spark, documents):
    long = "word " * 5000 + "end. " * 3
    rows = [(1, None), (2, ""), (3, long), (4, "Same text here."), (5, "Same text here."), (6, "<|endoftext|> x")]
    from pyspark.sql import functions as F

    df = documents(rows).withColumn("length", F.lit(1)).withColumnRenamed("lang", "offset")
    _check(pack_documents(df, window=64, block_tokens=256), rows, 64)


def test_empty_table(spark, documents):
    assert pack_documents(documents([]).limit(0)).count() == 0
