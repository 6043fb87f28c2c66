from collections import Counter

import pytest
from tests.llm.brute_force import words
from pyspark.sql import functions as F

from skytables.llm.outliers import RESULTS, chi2_quantile, keep_regular, reject_outliers


def expected_counts(text):
    text = text or ""
    w = words(text)
    seen, cover = Counter(zip(w, w[1:], w[2:])), set()
    for i in range(len(w) - 2):
        if seen[tuple(w[i : i + 3])] > 1:
            cover |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(cover)


def test_quantile():
    assert chi2_quantile(0.975, 5) == pytest.approx(12.8325, abs=1e-4)


def test_counts_match_brute_force(sample):
    for r in reject_outliers(sample, columns=["doc_id", "text"]).collect():
        want = expected_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_edge_texts(documents):
    texts = [None, "", " \t\n", "a b a b a b a b", "x\ny\nx\n\n", "é # ß" * 3, "w " * 70_000]
    rows = reject_outliers(documents(list(enumerate(texts))), columns=["doc_id"]).collect()
    by_id = {r.doc_id: r for r in rows}
    for i, text in enumerate(texts):
        r = by_id[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected_counts(text)


def regular(n, lang="en", source="s0", start=0):
    vocabulary = [f"{'abcdefgh'[i % 8] * (1 + i % 7)}{i}" for i in range(500)]
    return [(start + k, " ".join(vocabulary[(k * 37 + j * (k % 11 * 20 + 7)) % 500] for j in range(120)), lang, source) for k in range(n)]


def test_outliers_go_and_regular_rows_stay(documents):
    rows = regular(100) + regular(20, None, None, 200) + [(900, " ".join(f"w{i}***" for i in range(100)), "en", "s0")]
    kept = {r.doc_id: r.kept for r in reject_outliers(documents(rows), columns=["doc_id"]).collect()}
    assert not kept.pop(900) and all(kept.values())


def test_stage_keeps_columns_and_repeats(documents):
    rows = regular(80)
    df = documents(rows + rows[:2]).withColumns({c: F.lit("mine") for c in ("kept", "n_words", "_row", "_text", "_x")})
    out = keep_regular(df)
    assert out.columns == df.columns and out.count() == 82 and {r.kept for r in out.collect()} == {"mine"}


def test_empty_table(documents):
    out = reject_outliers(documents([]), columns=["doc_id"])
    assert out.columns == ["doc_id", *RESULTS] and out.count() == 0


def test_verdicts_do_not_depend_on_partitioning(sample):
    one = reject_outliers(sample.coalesce(1), columns=["doc_id"]).collect()
    many = reject_outliers(sample.repartition(7), columns=["doc_id"]).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
