"""Sharding: the table by brute force, balance, few moves."""

from collections import Counter
from hashlib import md5

import pytest

from tunelab.llm import sharding


def brute_table(names, slots):
    orders = []
    for name in names:
        n = int(md5(name.encode()).hexdigest(), 16)
        offset, step = n % slots, (n >> 64) % (slots - 1) + 1
        orders.append(iter([(offset + i * step) % slots for i in range(slots)]))
    owner = {}
    while len(owner) < slots:
        for k, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(s for s in order if s not in owner)] = k
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize("n, slots", [(1, 7), (3, 7), (5, 101), (7, 1009)])
def test_table(n, slots):
    names = tuple(f"s{i}" for i in range(n))
    table = sharding.lookup_table(names, slots)
    assert list(table) == brute_table(names, slots)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_few_keys_move_when_a_shard_goes():
    names = tuple(f"s{i}" for i in range(10))
    all_, fewer = sharding.lookup_table(names, 1009), sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(all_, fewer) if a != 9)
    assert moved < 0.2 * 1009


def test_wrong_tables():
    for names, slots in ((("a", "a"), 7), ((), 7), (("a",), 8)):
        with pytest.raises(ValueError):
            sharding.lookup_table(names, slots)


def test_shard(spark, documents, no_documents, tmp_path):
    found = sharding.shard(documents, "doc_id").collect()
    assert len(found) == documents.count()
    table = sharding.lookup_table()
    for r in found:
        key = "" if r["row"]["doc_id"] is None else str(r["row"]["doc_id"])
        assert r["slot"] == int(md5(key.encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert r["shard"] == sharding.SHARDS[table[r["slot"]]]
        assert r["row"]["shard"] == "clash"
    assert sharding.shard(no_documents, "doc_id").count() == 0
    path = str(tmp_path / "shards")
    sharding.write_shards(documents, "doc_id", path)
    back = spark.read.parquet(path)
    assert Counter(r["shard"] for r in back.collect()) == Counter(r["shard"] for r in found)


def test_plan_is_native(documents, capsys):
    sharding.shard(documents, "doc_id").explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Pandas" not in plan
