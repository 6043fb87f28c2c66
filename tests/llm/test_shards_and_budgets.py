import hashlib
import math
import zlib
from collections import Counter, defaultdict
from itertools import product

import pytest
from pyspark.sql import functions as F

from skytables.llm.budgets import mix, mixed_rows, split_budget
from skytables.llm.hilbert import curve_place, hilbert_shards, write_shards


def test_curve_visits_neighbours():
    for bits, dims in ((1, 3), (3, 3), (4, 2)):
        cells = sorted(product(range(1 << bits), repeat=dims), key=lambda c: curve_place(list(c), bits))
        assert [curve_place(list(c), bits) for c in cells] == list(range(1 << bits * dims))
        assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(cells, cells[1:]))


def check_shards(rows, shards=8):
    slots = defaultdict(list)
    places = defaultdict(set)
    for r in rows:
        text = r.text or ""
        assert r["size"] == len(text.encode()) + 1 and r.text_crc32 == zlib.crc32(text.encode()) and r.grown_shard is None
        slots[r.shard].append(r.slot)
        places[text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(shards))
    assert all(len(p) == 1 for p in places.values())  # equal texts stay together


def test_shards_have_near_equal_bytes(sample):
    rows = hilbert_shards(sample).collect()
    assert len(rows) == sample.count()
    check_shards(rows)
    size = Counter()
    for r in rows:
        size[r.shard] += r["size"]
    assert max(size.values()) - min(size.values()) <= 2 * max(r["size"] for r in rows)


def test_edge_rows(documents):
    rows = [(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b", None, None), (5, "x" * 2_000_000), *[(9 + i, "same") for i in range(200)]]
    df = documents(rows).withColumns({"shard": F.lit("mine"), "_fp": F.lit(1), "curve": F.lit(2)})
    out = hilbert_shards(df)
    assert "_fp" in out.columns and out.columns.count("shard") == 1
    check_shards(out.collect())
    assert hilbert_shards(documents([])).count() == 0


def test_written_shards_skip_by_metadata(sample, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(hilbert_shards(sample), path)
    back = sample.sparkSession.read.parquet(path)
    assert back.count() == sample.count()
    spread = back.groupBy("shard").agg(F.count_distinct("lang").alias("n")).agg(F.avg("n")).first()[0]
    assert spread < back.select("lang").distinct().count()


def levels():
    return {"domain": F.col("source"), "language": F.col("lang")}


def water(capacity, weights, budget):
    """Shares by weight, none above its capacity, what is left shared again."""
    got = dict.fromkeys(capacity, 0.0)
    open_ = set(capacity)
    while open_ and budget > 1e-9:
        total = sum(weights[k] for k in open_)
        step = min(budget / total, *((capacity[k] - got[k]) / weights[k] for k in open_))
        for k in open_:
            got[k] += step * weights[k]
        budget -= step * total
        open_ = {k for k in open_ if capacity[k] - got[k] > 1e-9}
    return got


@pytest.mark.parametrize("budget", [10, 300, 700, 5000])
def test_budget_goes_to_siblings_before_ancestors(spark, budget):
    supply = {("a", "x"): 10, ("a", "y"): 200, ("a", "z"): 40, ("b", "x"): 300, ("b", "y"): 100}
    weights = {("a", None): 3, ("b", None): 1, ("a", "x"): 5, ("b", "y"): 2}
    leaves = spark.createDataFrame([(*k, v) for k, v in supply.items()], "p string, q string, supply long")
    nodes = spark.createDataFrame([(*k, v) for k, v in weights.items()], "p string, q string, weight long")
    got = {(r.p, r.q): r.allotted for r in split_budget(leaves, nodes, ["p", "q"], budget, 1).collect()}
    tops = {p: sum(v for k, v in supply.items() if k[0] == p) for p in "ab"}
    given = water(tops, {p: weights.get((p, None), 1) for p in "ab"}, budget)
    for p in "ab":
        own = {k: v for k, v in supply.items() if k[0] == p}
        for k, v in water(own, {k: weights.get(k, 1) for k in own}, given[p]).items():
            assert abs(got[k] - v) <= 2


@pytest.mark.parametrize("budget", [150, 299, 1000])
def test_equal_siblings_get_equal_budgets(spark, budget):
    supply = {("a", "x"): 100, ("a", "y"): 100, ("a", "z"): 100, ("b", "x"): 100, ("b", "y"): 100, ("b", "z"): 100}
    leaves = spark.createDataFrame([(*k, v) for k, v in supply.items()], "p string, q string, supply long")
    nodes = spark.createDataFrame([], "p string, q string, weight long")
    got = {(r.p, r.q): r.allotted for r in split_budget(leaves, nodes, ["p", "q"], budget, 1).collect()}
    want = min(budget, 600) / 6
    assert all(abs(v - want) <= 1 for v in got.values()), got
    assert min(budget, 600) - len(got) <= sum(got.values()) <= min(budget, 600)


def test_prefixes_fit_their_budgets(sample):
    total = sample.select(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    rows = mix(sample, levels=levels(), budget=total // 2, exponent=0.5, max_epochs=3).select("_row.doc_id", "domain", "language", "n_tokens", "epoch").collect()
    used = sum(r.n_tokens for r in rows)
    longest = sample.agg(F.max(F.size(F.split("text", r"\s+")))).first()[0]
    assert total // 2 - longest * len({(r.domain, r.language) for r in rows}) <= used <= total // 2
    assert len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    again = mix(sample.repartition(5), levels=levels(), budget=total // 2, exponent=0.5, max_epochs=3).select("_row.doc_id", "epoch").collect()
    assert sorted((r.doc_id, r.epoch) for r in rows) == sorted(map(tuple, again))


def test_default_budget_reads_every_leaf_once(sample):
    out = mix(sample, levels=levels(), max_epochs=2).select("_row.doc_id", "epoch").collect()
    assert {r.doc_id for r in out if r.epoch == 0} == {r.doc_id for r in sample.collect()}
    assert max(r.epoch for r in out) <= 1


def test_mixture_edge_rows(documents):
    df = documents([(1, None), (2, ""), (None, "a b", None, None), (4, "a b"), (4, "a b"), (5, "w " * 60_000)]).withColumn("_digest", F.lit(1))
    out = mixed_rows(df.withColumn("domain", F.lit("clash")), levels=levels())
    assert out.columns == [*df.columns, "domain"] and {r.doc_id for r in out.collect()} == {1, 2, None, 4, 5}
    assert mixed_rows(documents([]), levels=levels()).count() == 0


def test_sources_with_a_common_beginning_are_told_apart(documents):
    rows = [(i, f"text {i:05}", "en", f"https://host{i % 16:02}.example.com/") for i in range(320)]
    where = defaultdict(set)
    for r in hilbert_shards(documents(rows)).collect():
        where[r.source].add(r.shard)
    assert len(where) == 16 and all(len(shards) <= 3 for shards in where.values())


def test_cuts_equal_a_brute_force_walk_along_the_curve(sample):
    # walk the groups of equal texts in the order of (curve, md5 of text), cut by the middle of each group's bytes
    shards = 8
    out = hilbert_shards(sample, shards=shards).withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(64))).collect()
    groups = defaultdict(list)
    for r in out:
        groups[hashlib.md5((r.text or "").encode()).hexdigest()].append(r)
    assert all(len({r.curve for r in rows}) == 1 for rows in groups.values())
    total = sum(r["size"] for r in out)
    expected, before_bytes, before_rows, start = Counter(), 0, 0, {}
    for fp in sorted(groups, key=lambda fp: (groups[fp][0].curve, fp)):
        rows = sorted(groups[fp], key=lambda r: (r._salt, r.doc_id is not None, str(r.doc_id)))
        b = sum(r["size"] for r in rows)
        shard = min(math.floor((before_bytes + b / 2) * shards / total), shards - 1)
        start.setdefault(shard, before_rows)
        for i, r in enumerate(rows):
            expected[(shard, before_rows - start[shard] + i, fp, r._salt, r.doc_id)] += 1
        before_bytes, before_rows = before_bytes + b, before_rows + len(rows)
    got = Counter((r.shard, r.slot, hashlib.md5((r.text or "").encode()).hexdigest(), r._salt, r.doc_id) for r in out)
    assert got == expected
    ordered = sorted(out, key=lambda r: (r.shard, r.slot))
    assert all(x.curve <= y.curve for x, y in zip(ordered, ordered[1:]))  # slots follow the curve
