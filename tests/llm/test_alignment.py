import hashlib
from collections import Counter, defaultdict

import numpy as np

from skytables.llm.alignment import CSR, align_tokenizers, vocabularies


def _paths():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _twin(rows):
    """Byte by byte: token ends, groups as runs between common ends, links as all pairs of a group."""
    from tokenizers import Tokenizer

    v = vocabularies(*_paths())
    hf = Tokenizer.from_file(_paths()[0])
    hf.encode_special_tokens = True
    per_doc, holders = {}, defaultdict(set)
    for key, (doc_id, text) in enumerate(rows):
        zero = (doc_id, 0, 0, 0, 0, "")
        if not text:
            per_doc[key] = (zero, Counter())
            continue
        a = hf.encode(" " + text, add_special_tokens=False).ids
        b = v.b.encode(text, out_type=int)
        target = (" " + text).encode()
        if b"".join(v.a_bytes[i] for i in a) != target or b"".join(v.b_bytes[i] for i in b) != target or not a or not b:
            per_doc[key] = (zero, Counter())
            continue
        ends_a, ends_b, pos = [], [], 0
        for i in a:
            pos += len(v.a_bytes[i])
            ends_a.append(pos)
        pos = 0
        for i in b:
            pos += len(v.b_bytes[i])
            ends_b.append(pos)
        common = sorted(set(ends_a) & set(ends_b))
        groups, ia, ib = [], 0, 0
        for c in common:
            ga, gb = [], []
            while ia < len(a) and ends_a[ia] <= c:
                ga.append(a[ia])
                ia += 1
            while ib < len(b) and ends_b[ib] <= c:
                gb.append(b[ib])
                ib += 1
            groups.append((ga, gb))
        links = Counter((x, y) for ga, gb in groups for x in ga for y in gb)
        for pair in links:
            holders[pair].add(key)
        text_of = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        per_doc[key] = ((doc_id, len(a), len(b), len(groups), sum(links.values()), hashlib.sha256(text_of.encode()).hexdigest()), links)
    best = defaultdict(int)
    for (x, _), docs in holders.items():
        best[x] = max(best[x], len(docs))
    out = []
    for base, links in per_doc.values():
        n_best = sum(m for p, m in links.items() if len(holders[p]) == best[p[0]])
        count_sum = sum(m * len(holders[p]) for p, m in links.items())
        out.append((*base[:5], n_best, count_sum, base[5]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_sample_equals_the_twin(spark, sample):
    rows = [(r.doc_id, r.text) for r in sample.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in align_tokenizers(sample).select(*COLUMNS).collect()), key=str)
    assert got == _twin(rows)
    assert sum(r[3] > 0 for r in got) > 0.5 * len(got)


def test_nulls_repeats_special_strings_and_clashes(spark, documents):
    rows = [(1, None), (2, ""), (3, "Hello world. Hello world."), (3, "Hello world. Hello world."), (4, "a  b\tc"), (5, "x <|endoftext|> <s> y"), (6, "naïve café " * 300)]
    df = documents(rows).withColumnRenamed("lang", "pairs").withColumnRenamed("source", "_row")
    got = sorted((tuple(r) for r in align_tokenizers(df, broadcast_pairs=0).select(*COLUMNS).collect()), key=str)
    assert got == _twin(rows)


def test_empty_table(spark, documents):
    assert align_tokenizers(documents([]).limit(0)).count() == 0


def test_gustavson_product_equals_dense():
    rng = np.random.default_rng(3)
    la, lb = rng.integers(1, 5, 30), None
    total = int(la.sum())
    cuts = np.sort(rng.choice(np.arange(1, total), size=12, replace=False))
    lb = np.diff(np.concatenate(([0], cuts, [total])))
    A, B = CSR.from_lengths(la, total), CSR.from_lengths(lb, total)
    dense_a = np.zeros((len(la), total), int)
    dense_b = np.zeros((len(lb), total), int)
    for r in range(len(la)):
        dense_a[r, A.indices[A.indptr[r] : A.indptr[r + 1]]] = 1
    for r in range(len(lb)):
        dense_b[r, B.indices[B.indptr[r] : B.indptr[r + 1]]] = 1
    rows, cols = A.times_transpose(B)
    want = np.argwhere(dense_a @ dense_b.T > 0)
    assert sorted(zip(rows.tolist(), cols.tolist())) == sorted(map(tuple, want.tolist()))


def test_stretches_of_bytes_give_the_same_counts(sample, monkeypatch):
    from skytables.llm import alignment

    v = vocabularies(*_paths())
    texts = [r.text for r in sample.select("text").limit(40).collect()] + ["x" * 5000, "ab " * 3000]
    enc = [(t, v.a.encode_ordinary(" " + (t or "")), v.b.encode(t or "", out_type=int)) for t in texts]
    whole = [alignment.align(v, t, a, b) for t, a, b in enc]
    monkeypatch.setattr(alignment, "_CHUNK_BYTES", 50)
    cut = [alignment.align(v, t, a, b) for t, a, b in enc]
    for w, c in zip(whole, cut):
        assert (w is None) == (c is None)
        if w:
            assert (w["n_overlaps"], w["n_links"], w["groups_sha256"]) == (c["n_overlaps"], c["n_links"], c["groups_sha256"])
