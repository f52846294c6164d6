import random
from collections import defaultdict

import pytest

from weftline.llm import sharding


@pytest.mark.parametrize("shards", [1, 3, 7])
def test_longest_first_against_a_plain_search(shards):
    rng = random.Random(shards)
    for _ in range(40):
        runs = [(size, rng.choice([1, 2, 5, 40, 300])) for size in rng.sample(range(1, 200), rng.randint(0, 12))]
        loads, expected = [0] * shards, []
        for size, n in sorted(runs, reverse=True):
            got = [0] * shards
            for _ in range(n):
                s = loads.index(min(loads))
                got[s] += 1
                loads[s] += size
            expected.append((size, got))
        assert sharding.longest_first(runs, shards) == expected


def _check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize(("cell", "small", "hot"), [(1 << 14, 1 << 17, 4096), (5, 0, 3)])
def test_groups_stay_together_and_slots_are_gapless(spark, monkeypatch, cell, small, hot):
    for name, value in (("CELL", cell), ("SMALL", small), ("HOT", hot)):
        monkeypatch.setattr(sharding, name, value)
    docs = spark.createDataFrame([(i, f"text {i % 37} " + "y" * (i % 37) if i % 2 else "the same") for i in range(500)], "doc_id bigint, text string")
    rows = sharding.shard_by_bytes(docs, 4).collect()
    assert len(rows) == 500
    _check(rows, 4)
    of, bytes_, loads = defaultdict(set), defaultdict(int), defaultdict(int)
    for r in rows:
        key = r.doc_id % 37 if r.doc_id % 2 else "same"
        of[key].add(r.shard)
        bytes_[key] += r.size
        loads[r.shard] += r.size
    assert all(len(s) == 1 for s in of.values())
    expected = [0] * 4
    for size in sorted(bytes_.values(), reverse=True):
        expected[expected.index(min(expected))] += size
    assert sorted(loads.values()) == sorted(expected)


def test_odd_rows(spark, odd, none):
    rows = sharding.shard_by_bytes(odd, 16).collect()
    assert len(rows) == odd.count()
    _check(rows, 16)
    by = {(r.doc_id, r.size): r for r in rows}
    assert by[2, 1].text_crc32 == 0 and by[2, 1].shard == by[3, 1].shard
    assert sharding.shard_by_bytes(none, 16).count() == 0
