"""Operators on documents against brute force: awkward rows, whole small tables, empty tables."""

import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_cases import CLASHES, TEXTS, brute_lines, brute_mix, brute_simhash, brute_targets, rows_of, simhash_classes
from pyspark.sql import functions as F

from tunelab.llm import line_dedup, mixing, packing, simhash
from tunelab.llm.common import components, prefix_sums

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def given_rows():
    return duckdb.sql(f"SELECT doc_id, text, source FROM '{SMALL}/documents.parquet'").fetchall()


def test_lines(documents, given, given_rows):
    columns = ("doc_id", "n_lines", "n_dropped", "text")
    assert rows_of(line_dedup.line_dedup(documents), *columns) == brute_lines([x[:2] for x in TEXTS])
    assert rows_of(line_dedup.line_dedup(given), *columns) == brute_lines([x[:2] for x in given_rows])


def test_lines_keep_the_other_columns(documents):
    found = line_dedup.deduplicated(documents)
    assert found.columns == documents.columns
    assert all(r["n_chars"] == len(r["text"]) and r["key"] == "clash" for r in found.collect())
    assert rows_of(found, "doc_id", "text") == sorted(((x[0], x[3]) for x in brute_lines([x[:2] for x in TEXTS])), key=repr)


def test_simhash(documents, given, given_rows):
    for df, rows in ((documents, [x[:2] for x in TEXTS]), (given, [x[:2] for x in given_rows])):
        found = simhash.simhash_groups(df).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fp"), "component_id")
        assert rows_of(found, "doc_id", "fp", "component_id") == brute_simhash(rows)


def test_simhash_links_join_what_all_pairs_join(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    prints = np.unique([s ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for s in seeds for k in rng.integers(0, 4, 30)])
    table = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 2
    want = {int(prints[i].view(np.int64)): min(int(x) for x in prints[c].view(np.int64)) for i, c in _classes(near)}
    for tile in (16, 1024):
        roots = {r["node"]: r["root"] for r in components(simhash.links(table, tile=tile), "a", "b").collect()}
        got = {int(x): roots.get(int(x), int(x)) for x in prints.view(np.int64)}
        assert got == want


def _classes(near):
    reach = near.copy()
    while True:
        more = (reach.astype(int) @ reach.astype(int)) > 0
        if (more == reach).all():
            break
        reach = more
    return [(i, np.flatnonzero(reach[i])) for i in range(len(near))]


def test_representatives(documents):
    kept = simhash.representatives(documents)
    assert kept.columns == documents.columns
    rows = [x[:2] for x in TEXTS]
    assert kept.count() == len(set(simhash_classes(rows)[1]))
    assert {r["doc_id"] for r in kept.collect()} == {component for _, _, component in brute_simhash(rows)}


def test_components(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(path + star + [(7, 7), (2000, 1999), (1999, 2000)], "x long, y long").repartition(4)
    roots = {r["node"]: r["root"] for r in components(edges, "x", "y").collect()}
    assert roots == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}, 2000: 1999}


def test_mix(documents, given, given_rows):
    columns = ("doc_id", "size", "source_size", "target", "taken")
    for df, rows in ((documents, TEXTS), (given, given_rows)):
        got, want = rows_of(mixing.mix(df), *columns), brute_mix(rows)
        assert [x[:3] + x[4:] for x in got] == [x[:3] + x[4:] for x in want]
        assert np.allclose([x[3] for x in got], [x[3] for x in want])
        assert rows_of(mixing.mix(df.repartition(5)), *columns) == got
        assert all(taken <= 3 * size for _, size, _, _, taken in got)


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 1, "c": 10_000, None: 3}, {"a": 0, "b": 0}, {"a": 5}, {"a": 1, "b": 100, "c": 100, "d": 0, "e": 7}])
def test_targets(spark, sizes):
    rows = [(s is None, s or "", n) for s, n in sizes.items()]
    found = mixing.source_targets(spark.createDataFrame(rows, "no_source boolean, source_key string, size long")).collect()
    want = brute_targets(sizes)
    assert {(None if r["no_source"] else r["source_key"]): pytest.approx(r["target"]) for r in found} == want


def test_mixed_documents_hold_what_is_taken(documents):
    taken = Counter()
    for r in mixing.mix(documents).collect():
        taken[r["doc_id"]] += r["taken"]
    mixed = mixing.mixed_documents(documents)
    assert mixed.columns == documents.columns
    rows = mixed.select("doc_id", "text", "n_chars", mixing.words(F.col("text")).alias("n"), "size").collect()
    found = Counter()
    for r in rows:
        found[r["doc_id"]] += r["n"]
    assert found == +taken
    assert all(r["n_chars"] == len(r["text"]) and r["size"] == "clash" for r in rows)
    texts = defaultdict(list)
    for doc_id, text, _ in TEXTS:
        texts[doc_id].append(text or "")
    assert all(any(t.startswith(r["text"]) for t in texts[r["doc_id"]]) for r in rows)


def test_prefix_sums_over_many_ranges(spark):
    rows = [(i % 3, (i * 7919) % (1 << 40) * (1 << 20) % (1 << 60), i, i % 11) for i in range(5000)]
    df = spark.createDataFrame(rows, "g int, k long, id long, v long")
    got = {r["id"]: r["before"] for r in prefix_sums(df, ["g"], "k", ["id"], "v", 1 << 20).collect()}
    want, sums = {}, Counter()
    for g, _, i, v in sorted(rows):
        want[i] = sums[g]
        sums[g] += v
    assert got == want


def test_packing(spark, documents):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    special = spark.createDataFrame([(99, "a <|endoftext|> inside", "en", "z", 22)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = documents.unionByName(special, allowMissingColumns=True)
    found = packing.pack(docs).collect()
    want = Counter()
    for doc_id, text in [x[:2] for x in TEXTS] + [(99, "a <|endoftext|> inside")]:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        for start in range(0, len(ids), packing.LENGTH):
            part = ids[start : start + packing.LENGTH]
            want[doc_id, start, len(part), len(ids), part.tobytes()] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in found) == want
    _gapless(found)
    digest = packing.pack_digest(docs).collect()
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in digest) == Counter(
        {(k[0], k[1], zlib.crc32(k[4])): n for k, n in want.items()}
    )


def _gapless(found):
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.LENGTH
    return len(sequences)


def test_long_texts_are_tokenised_in_parts(monkeypatch):
    import public_tokenizers

    tokens = packing.Tokens(public_tokenizers.path(packing.TOKENIZER), public_tokenizers.path(packing.RANKS))
    text = "Some words\nof lines\n\n with  spaces \nand 123 numbers\n" * 40 + "tail"
    whole = tokens(text)
    monkeypatch.setattr(packing, "PART_CHARS", 50)
    assert np.array_equal(tokens(text), whole)


def test_packing_leaves_little_padding(spark, given):
    found = packing.pack_digest(given).collect()
    used = sum(r["length"] for r in found)
    assert used >= 0.97 * packing.LENGTH * (_gapless(found) - 1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_cutting_stock(seed):
    rng = np.random.default_rng(seed)
    demand = {int(s): int(n) for s, n in zip(rng.choice(np.arange(1, 65), 30, replace=False), rng.integers(0, 500, 30))}
    plan = packing.cutting_stock(demand, 64)
    held = Counter()
    for times, pattern in plan:
        assert sum(s * n for s, n in pattern.items()) <= 64
        for s, n in pattern.items():
            held[s] += times * n
    assert held == +Counter(demand)
    least = max(sum(s * n for s, n in demand.items()) / 64, sum(n for s, n in demand.items() if s > 32))
    assert sum(t for t, _ in plan) <= 1.05 * least + 30
    assert packing.cutting_stock({}, 64) == []


def test_knapsack():
    value, counts = packing.best_pattern(np.array([3.0, 5.0, 9.0]), np.array([2, 3, 5]), 11)
    assert value == pytest.approx(max(3 * a + 5 * b + 9 * c for a in range(6) for b in range(4) for c in range(3) if 2 * a + 3 * b + 5 * c <= 11))
    assert counts @ [2, 3, 5] <= 11


def test_empty_tables(no_documents):
    for found in (
        line_dedup.line_dedup(no_documents),
        line_dedup.deduplicated(no_documents),
        simhash.simhash_groups(no_documents),
        simhash.representatives(no_documents),
        mixing.mix(no_documents),
        mixing.mixed_documents(no_documents),
        packing.pack(no_documents),
    ):
        assert found.count() == 0
    assert set(CLASHES) <= set(mixing.mixed_documents(no_documents).columns)
