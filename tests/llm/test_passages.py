"""Passages that lines do not show, and signatures of many sets at once."""

import random

import numpy as np

from skytables.llm.paragraphs import _winnowed, repeated_passages
from skytables.llm.shingles import minhash, minhashes


def test_minhashes_are_those_of_one_set():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(1 << 63, size=n, dtype=np.uint64)) for n in (1, 5, 3000, 2)]
    assert (minhashes(sets, 128, seed=3) == np.stack([minhash(s, 128, seed=3) for s in sets])).all()


def test_passages_in_short_lines_and_in_unlike_lines_are_found(documents):
    rng = random.Random(5)
    vocabulary = [f"vé{i}" for i in range(20_000)]
    wrapped = rng.sample(vocabulary, 120)
    span = rng.sample(vocabulary, 49)

    def lines(words, n):
        return "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))

    def inside(n):
        return " ".join(rng.sample(vocabulary, n) + span + rng.sample(vocabulary, 90 - n))

    rows = [(0, lines(wrapped, 12)), (1, lines(wrapped, 7)), (2, inside(30)), (3, "x\n" + inside(60))]
    rows += [(4, " ".join(rng.sample(vocabulary, 400))), (5, None), (None, inside(10))]
    found = repeated_passages(documents(rows)).collect()
    texts = dict(rows)
    assert sorted((r.doc_id is None, r.doc_id) for r in found) == [(False, 0), (False, 1), (False, 2), (False, 3), (True, None)]
    for r in found:
        part = texts[r.doc_id][r.start : r.end].split()
        whole = wrapped if r.doc_id in (0, 1) else span
        assert r.paragraph is None and len(part) == r.n_words >= 25
        assert any(whole[i : i + len(part)] == part for i in range(len(whole)))
        assert r.first_doc == (0 if whole is wrapped else 2) and r.kept == (r.doc_id == r.first_doc)
        assert r.copies == (2 if whole is wrapped else 3)


def test_shared_runs_of_49_words_are_always_posted():
    rng = np.random.default_rng(6)
    for n in (25, 49, 60, 300):
        values = rng.integers(1 << 63, size=n, dtype=np.uint64)
        at = _winnowed(values, 25)
        assert all(((at >= i) & (at < i + 25)).any() for i in range(max(n - 24, 1)))
