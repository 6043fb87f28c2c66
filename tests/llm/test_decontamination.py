import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from skytables.llm.winnowing import contamination, drop_contaminated
from tests.llm.brute_force import LOWER


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def expected(docs, items):
    windows = []
    for item, text in items:
        w = words(text)
        n = min(len(w), 10)
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, span in windows:
            for i in range(len(w) - len(span) + 1):
                if tuple(w[i : i + len(span)]) == span:
                    hit |= set(range(i, i + len(span)))
                    ids.add(item)
        named = sorted(str(i) for i in ids if i is not None)
        out.append((doc, len(w), len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), bool(hit)))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(8, 40)))) for i in range(12)]
    items += [(20, "Short Item here"), (21, "one"), (22, None), (23, ""), (None, " ".join(f"n{i}" for i in range(12)))]
    items += [(24, "rep " * 14), items[0], (25, items[1][1])]
    docs = []
    for i in range(60):
        parts = [rng.choices(vocabulary, k=rng.randrange(0, 30))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            a = rng.randrange(max(len(w) - 9, 1))
            parts += [w[a : a + rng.choice([9, 10, 11, 15, 40])], rng.choices(vocabulary, k=3)]
        docs.append((i, ", ".join(" ".join(p) for p in parts)))
    docs += [(90, None), (91, ""), (92, "!!!"), (93, "a short, ITEM here? short item HERE"), (94, "rep " * 50_000), (95, docs[3][1])]
    docs += [(96, " ".join(f"n{i}" for i in range(12))), (None, docs[4][1]), docs[5]]
    return docs, items


def test_hits_match_brute_force(spark, documents, case):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("w", F.lit(1))
    got = [tuple(r) for r in contamination(documents(docs).withColumn("fp", F.lit("x")), benchmark).collect()]
    assert sorted(got, key=str) == sorted(expected(docs, items), key=str)


def test_empty_sides(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = contamination(documents([(1, "a b"), (2, None)]), none).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows) == [(1, 2, 0, 0, False), (2, 0, 0, 0, False)]
    some = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert contamination(documents([]), some).count() == 0


def test_stage_drops_hit_documents_alone(spark, documents, case):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = documents(docs).withColumn("_fp", F.lit("mine"))
    clean = sorted(str(r[0]) for r in expected(docs, items) if not r[5])
    out = drop_contaminated(df, benchmark)
    assert out.columns == df.columns and sorted(str(r.doc_id) for r in out.collect()) == clean
