import random

import pytest
from pyspark.sql import functions as F

from skytables.llm.linking import components
from skytables.llm.paragraphs import repeated_paragraphs, tuned_bands, without_repeats
from skytables.llm.shingles import word_hashes
from skytables.llm.signature_join import drop_near_duplicates, near_duplicates
from tests.llm.brute_force import components as brute_components
from tests.llm.brute_force import shingles


def planted(seed=5):
    """Texts at all distances from a few originals, chains of copies, and passages that many texts share."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.sample(vocabulary, 40)
    rows = []
    for base in range(6):
        original = rng.sample(vocabulary, 120)
        for copy in range(25):
            text = list(original)
            for _ in range(rng.choice([0, 1, 2, 3, 4, 6, 9])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(text)
        for step in range(12):  # a chain whose ends are no longer alike
            original = original[4:] + rng.sample(vocabulary, 4)
            rows.append(original)
    for _ in range(120):
        rows.append(rng.sample(vocabulary, rng.randrange(10, 60)) + passage)
    rng.shuffle(rows)
    return [(i, " ".join(w)) for i, w in enumerate(rows)]


def test_components_match_brute_force(documents):
    rows = planted()
    out = near_duplicates(documents(rows)).collect()
    sets = {i: shingles(t, 4) for i, t in rows}
    want = brute_components(sets, 80)
    assert {r.doc_id: r.component_id for r in out} == want
    assert {r.doc_id: r.n_shingles for r in out} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_edge_rows(documents):
    rows = [(5, None), (6, ""), (7, "one two"), (8, "ONE\ttwo "), (9, "two one"), (None, "one two"), (3, "x " * 60_000), (7, "one two")]
    out = near_duplicates(documents(rows)).collect()
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept) for r in out)
    assert got == sorted(
        [("5", 0, 5, True), ("6", 0, 6, True), ("7", 1, 7, True), ("7", 1, 7, True), ("8", 1, 7, False), ("9", 1, 9, True)]
        + [("None", 1, None, True), ("3", 1, 3, True)]
    )


def test_rows_with_one_key_are_one_document(documents):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (2, "g h i j k l"), (3, "g h i j k l")]
    assert {r.component_id for r in near_duplicates(documents(rows)).collect()} == {1}


def test_empty_table(documents):
    assert near_duplicates(documents([])).count() == 0
    assert repeated_paragraphs(documents([])).count() == 0


def test_stage_keeps_one_of_each_group_and_all_columns(documents):
    df = documents([(1, "a b c d e f"), (2, "A b c d e f"), (3, "z"), (3, "z"), (None, "q")]).withColumn("_kept", F.lit(1)).withColumn("doc", F.lit(2))
    out = drop_near_duplicates(df, size=5)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 7), (200, 201), (201, 202), (200, 202), (5, 5)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200}


@pytest.mark.parametrize("texts", [["a b", "A  B\n"], ["é ß x", "É ß x"], ["", None], ["a" * 5000 + " b", "a" * 5001 + " b"]])
def test_word_hashes_tell_words_apart(texts):
    hashes, ends = word_hashes(texts)
    left, right = hashes[: ends[0]].tolist(), hashes[ends[0] :].tolist()
    split = [[w.encode().lower() if w.isascii() else w for w in (t or "").split()] for t in texts]
    assert (left == right) == (split[0] == split[1])
    assert len(set(word_hashes([" ".join(f"w{i}" for i in range(300_000))])[0].tolist())) == 300_000


def test_paragraphs_match_brute_force(documents):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(4000)]
    pool = [rng.sample(vocabulary, 60) for _ in range(12)]
    rows = []
    for i in range(60):
        parts = [" ".join(rng.sample(vocabulary, rng.randrange(5, 40))) for _ in range(3)]
        shared = list(rng.choice(pool))
        for _ in range(rng.randrange(3)):
            shared[rng.randrange(60)] = rng.choice(vocabulary)
        parts.insert(rng.randrange(4), " ".join(shared))
        rows.append((i, "\n".join(parts)))
    rows += [(60, None), (61, ""), (62, "short line\n\nshort line")]
    sets, where = {}, {}
    for i, text in rows:
        at = 0
        for k, part in enumerate((text or "").split("\n")):
            if len(part.split()) >= 20:
                sets[i, k], where[i, k] = shingles(part, 5), (at, at + len(part))
            at += len(part) + 1
    label = brute_components(sets, 80)
    sizes = {}
    for k, v in label.items():
        sizes[v] = sizes.get(v, 0) + 1
    want = {(*k, *where[k], *v, sizes[v], k == v) for k, v in label.items() if sizes[v] > 1}
    df = documents(rows)
    got = repeated_paragraphs(df).collect()
    assert {(r.doc_id, r.paragraph, r.start, r.end, r.first_doc, r.first_paragraph, r.copies, r.kept) for r in got} == want
    texts = {r.doc_id: r.text for r in without_repeats(df).collect()}
    gone = {(i, k) for i, k, *_, kept in want if not kept}
    for i, text in rows:
        parts = None if text is None else text.split("\n")
        assert texts[i] == (parts if parts is None else "\n".join(p for k, p in enumerate(parts) if (i, k) not in gone))


def test_bands_are_tuned_for_recall():
    for percent, rows in ((80, 3), (80, 5), (90, 4)):
        bands = tuned_bands(percent, rows, 0.005)
        assert (1 - (percent / 100) ** rows) ** bands <= 0.005 < (1 - (percent / 100) ** rows) ** (bands - 1)
