"""The pipeline's near-duplicate stage against the similarity of all pairs."""

import random

import duckdb
import test_pipeline
from llm_cases import CLASHES, TEXTS, brute_groups

from tunelab.llm import near_dup

CHECK = "/root/testdata/sf0.01"


def brute_kept(rows):
    """Smallest doc_id of each group of (doc_id, text) rows."""
    least = {}
    for group, (doc_id, _) in zip(brute_groups(rows), rows):
        least[group] = min(doc_id, least.get(group, doc_id))
    return sorted(least.values())


def edited(rng, words, edits):
    words = list(words)
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"edit{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_copies_with_edited_words_go(spark):
    rng = random.Random(5)
    rows, n = [], 0
    for size in (5, 12, 60, 200, 200):
        words = [f"w{rng.randrange(3000)}" for _ in range(size)]
        for edits in (0, 0, 1, 2, 4, 7, 12):
            rows.append((n := n + 1, edited(rng, words, min(edits, size // 4))))
    rows += [(n + 1, ""), (n + 2, None), (n + 3, "a b"), (n + 4, "A  b")]
    passage = " ".join(f"p{i}" for i in range(30))  # a common passage is no near copy
    rows += [(n + 10 + i, passage + " " + " ".join(f"own{i}x{j}" for j in range(30))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(r["doc_id"] for r in test_pipeline.corpus_pipeline.stage_near_duplicates(spark, docs, "").collect())
    assert kept == brute_kept(rows)


def test_all_pairs_of_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{CHECK}/documents.parquet' ORDER BY doc_id").fetchall()
    docs = spark.read.parquet(f"{CHECK}/documents.parquet")
    for sample in (near_dup.SAMPLE_DOCS, 50):
        assert sorted(r["doc_id"] for r in near_dup.representatives(docs, sample).collect()) == brute_kept(rows)


COLUMNS = "doc_id long, text string"


def kept_rows(spark, rows, schema=COLUMNS):
    docs = spark.createDataFrame(rows, schema).repartition(3)
    found = near_dup.representatives(docs)
    assert found.columns == docs.columns
    return sorted(map(tuple, found.collect()), key=repr)


def test_null_ids_repeated_rows_and_ties(spark):
    near = " ".join(f"w{i}" for i in range(40))
    rows = [(None, near), (None, near), (7, near + " more"), (7, near + " more"), (7, near + " tail"), (None, "alone here"), (9, None), (8, " ")]
    got = kept_rows(spark, rows)
    assert [r for r in got if r[0] != 7] == [(8, " "), (None, "alone here")]
    assert [r[0] for r in got if r[0] == 7] == [7]
    assert kept_rows(spark, [(None, near)] * 5) == [(None, near)]


def test_columns_with_the_operators_own_names(documents, no_documents):
    found = near_dup.representatives(documents)
    assert found.columns == documents.columns
    rows = [x[:2] for x in TEXTS]
    group = brute_groups(rows)
    assert found.count() == len(set(group))
    assert all(r[c] == "clash" for r in found.collect() for c in CLASHES)
    assert near_dup.representatives(no_documents).count() == 0


def test_a_shingle_that_a_third_of_all_texts_hold(spark):
    """Common passages are ordered last; short texts full of them are still compared."""
    line = " ".join(f"licence{i}" for i in range(12))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(20)) + " " + line) for i in range(200)]
    rows += [(1000 + i, line + (f" tail{i}" if i % 2 else "")) for i in range(60)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert sorted(r["doc_id"] for r in near_dup.representatives(docs).collect()) == brute_kept(rows)


def test_ranges_and_buckets_of_any_size(spark, monkeypatch):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{CHECK}/documents.parquet' ORDER BY doc_id LIMIT 300").fetchall()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    for name, value in (("RANGE", 500), ("BUCKET", 20), ("UNIT", 300), ("SEEN", 3)):
        monkeypatch.setattr(near_dup, name, value)
    assert sorted(r["doc_id"] for r in near_dup.representatives(docs).collect()) == brute_kept(rows)


def test_simhash_proposes_what_its_bits_show(spark):
    """Pairs of fingerprints within the radius are proposed, joined as all pairs join them; the rest is left to shared shingles."""
    rng = random.Random(9)
    rows = []
    for base in range(6):
        words = [f"w{rng.randrange(3000)}" for _ in range(400)]
        rows += [(10 * base + i, edited(rng, words, e)) for i, e in enumerate((0, 1, 2, 3, 12))]
    found = {i: near_dup.shingles(t) for i, t in rows}
    bits = {i: near_dup.fingerprint(f) for i, f in found.items()}
    slow = {i: sum(1 << b for b in range(64) if 2 * sum((int(h) >> b) & 1 for h in f) > len(f)) for i, f in found.items()}
    apart = {(i, j): (bits[i] ^ bits[j]).bit_count() if bits[i] ^ bits[j] >= 0 else ((bits[i] ^ bits[j]) % (1 << 64)).bit_count() for i in bits for j in bits}
    assert all(apart[i, j] == (slow[i] ^ slow[j]).bit_count() for i, j in apart)
    near = [p for p, n in apart.items() if p[0] < p[1] and n <= near_dup.RADIUS]
    assert near
    classes = spark.createDataFrame([(i, len(found[i]), bits[i]) for i in bits], "set long, size long, fp long").repartition(3)
    pairs = {(r["a"], r["b"]) for r in near_dup._by_fingerprint(classes).collect()}

    def joined(links):
        root = {i: i for i in bits}
        for _ in bits:
            for i, j in links:
                root[i] = root[j] = min(root[i], root[j])
        return root

    assert joined(pairs) == joined(near)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    assert sorted(r["doc_id"] for r in near_dup.representatives(docs).collect()) == brute_kept(rows)
