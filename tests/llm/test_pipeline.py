"""The pipeline's stages on a small corpus, each held against a plain version run on the same input."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skytables.llm.outliers import reject_outliers
from skytables.llm.queries import ORACLE, QUERIES
from tests.llm.brute_force import components, shingles
from tests.llm.test_decontamination import expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of every stage, written and read again."""
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF_DIR).write.parquet(path)
        out[name] = (docs, docs := spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_are_named_and_keep_their_columns(stages):
    assert list(stages) == [n for n, _ in corpus_pipeline.STAGES]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns, name


def test_quality(stages):
    before, after = stages["quality_rules"]
    assert ids(after) == ids(reject_outliers(before, columns=["doc_id"]).filter("kept"))


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    label = components({r.doc_id: shingles(r.text, 5) for r in before.collect()}, 80)
    assert ids(after) == sorted(k for k, v in label.items() if k == v)


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    clean = sorted(r[0] for r in expected(rows, items) if not r[5])
    assert ids(after) == clean and len(clean) < len(rows)


def test_mixture_loses_nothing_and_repeats_at_most_once(stages):
    before, after = stages["mixture"]
    counts = after.groupBy("doc_id").count().collect()
    assert {r.doc_id for r in counts} == set(ids(before)) and max(r["count"] for r in counts) <= 2


def test_shards_hold_every_row(stages):
    before, after = stages["sharding"]
    assert ids(after) == ids(before)
    assert after.select("shard", "slot").distinct().count() == after.count()
    assert after.groupBy("shard").agg((F.max("slot") - F.count("*")).alias("d")).select("d").distinct().collect() == [(-1,)]


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES) and json.dumps(ORACLE)


def test_nothing_else_imports_the_package():
    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("skytables/**/*.py"), *root.glob("workload/*.py"), *root.glob("tests/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "skytables.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
