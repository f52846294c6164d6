import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.llm import components, near_dedup


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def brute(docs, percent):
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))}


def corpus():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    docs = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([6, 20, 80, 200]))]
        for copy in range(rng.choice([1, 2, 12])):
            t = list(text)
            for _ in range(copy % 4):
                t[rng.randrange(len(t))] = rng.choice(words)
            docs.append((1000 - len(docs), " ".join(t).upper() if copy == 1 else "  ".join(t)))
    return docs + [(5, "one two"), (6, "ONE\ttwo"), (7, ""), (8, ""), (9, "É a b c d"), (10, "é a b c d")]


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("sets", [3, 1024])
def test_against_brute_force(spark, monkeypatch, percent, sets):
    monkeypatch.setattr(near_dedup, "GROUP_SETS", sets)
    docs = corpus()
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_groups_blocks_are_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "GROUP_SETS", 4)
    tasks, confirm = [], near_dedup._inside

    def counted(blocks, percent):
        tasks.append(confirm(blocks, percent).select(F.spark_partition_id().alias("task")).distinct().count())
        return confirm(blocks, percent)

    monkeypatch.setattr(near_dedup, "_inside", counted)
    rng = random.Random(3)
    text = [str(rng.random()) for _ in range(400)]
    docs = [(i, " ".join(text[:i] + ["x"] + text[i + 1 :])) for i in range(200)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 85).collect()
        assert {r.component_id for r in got} == {0}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks[0] >= 6


def test_sets_are_named_by_more_than_64_bits():
    a, b = np.arange(5, dtype=np.uint64), np.arange(6, dtype=np.uint64)
    one, same, other, none = near_dedup.names([a, a.copy(), b, a[:0]]).to_pylist()
    assert one == same != other and none == 0 and one > 1 << 64


@pytest.mark.parametrize("percent", [80, 85])
def test_bands_miss_as_seldom_as_stated(percent):
    bands = near_dedup.bands_for(percent / 100)
    rng, missed, trials = np.random.default_rng(3), 0, 300_000
    for _ in range(trials // 5000):
        agree = rng.random((5000, bands.max() + 1), dtype=np.float32) < percent / 100
        missed += (~agree[:, bands].all(axis=2).any(axis=1)).sum()
    # 122 and 55 were missed when bands shared registers; 0.3 are expected.
    assert missed <= 5


def test_band_registers_agree_as_often_as_sets_overlap():
    bands = near_dedup.bands_for(0.8)
    hashes, rng, agree = near_dedup.band_hashes(bands), np.random.default_rng(4), []
    for _ in range(40):
        x = rng.integers(0, 1 << 63, 900, dtype=np.uint64) * np.uint64(2)
        a, b = near_dedup.registers(x[:800], *hashes), near_dedup.registers(np.concatenate([x[:711], x[800:889]]), *hashes)
        agree.append(a == b)
    assert abs(np.mean(agree) - 711 / 889) < 0.01
    assert abs(np.mean([x[bands].all(axis=1).mean() for x in agree]) - (711 / 889) ** 8) < 0.03


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    a, b = (np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64)) for _ in range(2))
    shared = np.unique(np.concatenate([a, b[:100]]))
    assert (near_dedup.merge(near_dedup.registers(a), near_dedup.registers(b)) == near_dedup.registers(np.unique(np.concatenate([a, b])))).all()
    ra = near_dedup.registers(a)
    assert near_dedup.possible(ra, len(a), near_dedup.registers(shared)[None], np.array([len(shared)]), 0.85)[0]
    assert not near_dedup.possible(ra, len(a), near_dedup.registers(b)[None], np.array([len(b)]), 0.85)[0]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("few", [0, 1 << 16])
@pytest.mark.parametrize("kind", ["bigint", "decimal(38,0)", "string", "double"])
def test_components_at_once_and_in_rounds(spark, monkeypatch, few, kind):
    """Few edges take one task and no round; both ways give the same rows."""
    monkeypatch.setattr(components, "FEW", few)
    rounds, star = [], components._large_star
    monkeypatch.setattr(components, "_large_star", lambda e: rounds.append(1) or star(e))
    rng = random.Random(8)
    pairs = [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(130)]
    edges = spark.createDataFrame(pairs, "u bigint, v bigint").selectExpr(f"cast(u as {kind}) as u", f"cast(v as {kind}) as v")
    root = {x: x for pair in pairs for x in pair}
    for _ in root:
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = components.components(edges)
    assert {int(float(r.node)): int(float(r.root)) for r in got.collect()} == {x: y for x, y in root.items() if x != y}
    assert got.schema["node"].dataType == edges.schema["u"].dataType and bool(rounds) == (not few or kind == "double")


def test_near_duplicates_by_rounds(spark, monkeypatch):
    monkeypatch.setattr(components, "FEW", 0)
    docs = corpus()
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id bigint, text string"), 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, 85)


def test_odd_rows(spark, odd, none):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.component_id == r.doc_id and r.n_shingles == 0 for r in rows if r.doc_id in (2, 3, 4))
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(1, False)]
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("plain words in a row here") == 1 and len([t for t in texts if t]) == 7
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.deduplicate(none).count() == 0
