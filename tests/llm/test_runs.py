"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import TEXTS, WORD

from tunelab.llm import catalog, runs

SMALL = "/root/testdata/sf0.001"


def brute_runs(words, times=4, least=6):
    """(start, length, period), stretch by stretch for every period."""
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    n, found = len(ids), []
    for q in range(1, n // times + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = j - i + q
            if length >= max(least, times * q):
                smaller = (d for d in range(1, q) if q % d == 0)
                if not any((ids[i : i + length - d] == ids[i + d : i + length]).all() for d in smaller):
                    found.append((i, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_digest(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    most = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {i for s, length, p in found for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    sums = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed)]
    return (doc_id, len(found), *(most or (None,) * 3), most and 1000 * most[1] // most[2], *sums)


COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def digest_rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in runs.digest(runs.periodic_runs(runs.with_repeats(df))).collect()), key=repr)


units = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 7)), max_size=6)


@settings(max_examples=300, deadline=None)
@given(st.lists(units, min_size=1, max_size=4))
def test_runs_of_random_texts(texts):
    texts = [[str(x).encode() for unit, times in text for x in unit * times] for text in texts]
    for times, least in ((4, 6), (2, 2), (3, 1)):
        assert [found for found, _ in runs._found(texts, times, least)] == [brute_runs(t, times, least) for t in texts]


def test_squares_of_all_multiples_are_one_run():
    for word in (b"a", b"a b", b"a b a a b"):
        words = word.split() * 60
        assert [r for r, _ in runs._found([words], 4, 6)] == [[(0, len(words), len(word.split()))]]


def test_suffix_array():
    rng = random.Random(4)
    symbols = np.array([rng.randrange(3) for _ in range(300)] + [9])
    order, places, shared = runs.suffix_array(symbols)
    # symbols may be ranked in any order, so only neighbours are compared
    common = lambda a, b: next(k for k in range(301) if symbols[a + k] != symbols[b + k])
    assert sorted(order) == list(range(301)) and all(order[places[i]] == i for i in range(301))
    assert [common(a, b) for a, b in zip(order, order[1:])] == shared[1:].tolist()


def test_members_are_looked_at_in_steps(monkeypatch):
    rng = random.Random(8)
    words = [b"%d" % rng.randrange(2) for _ in range(400)]
    want = brute_runs(words)
    monkeypatch.setattr(runs, "MEMBERS", 7)
    monkeypatch.setattr(runs, "SORTED", 100)
    assert next(iter(runs._found([words], 4, 6)))[0] == want
    assert list(runs._groups([words] * 3)) == [(0, 1), (1, 2), (2, 3)]


def test_long_texts():
    for words in ([b"a"] * 100_000, [b"%d" % (i % 777) for i in range(100_000)]):
        period = len(set(words))
        assert next(iter(runs._found([words], 4, 6))) == ([(0, 100_000, period)], b" ".join(words[:period]))


def test_awkward_documents(documents, no_documents):
    assert digest_rows(documents) == sorted((brute_digest(d, t) for d, t, _ in TEXTS), key=repr)
    assert digest_rows(no_documents) == []


def test_null_ids_ties_and_repeated_rows(spark):
    rows = [(None, "a b " * 9), (None, None), (3, "x x x x x x y y y y y y"), (3, "x x x x x x y y y y y y"), (4, "a a a a a b"), (5, "　 a\xa0 " * 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest_rows(df) == sorted((brute_digest(*r) for r in rows), key=repr)
    found = {r["doc_id"]: r for r in runs.periodic_runs(df).where("doc_id = 3").collect()}
    assert found[3]["most"]["start"] == 0 and found[3]["collapsed"] == "x y"


@pytest.mark.parametrize("sf_dir", [SMALL])
def test_given_documents(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    got = sorted((tuple(r[c] for c in COLUMNS) for r in catalog.QUERIES["op11_periodic_runs"](spark, sf_dir).collect()), key=repr)
    want = sorted((brute_digest(*r) for r in rows if len(r[1] or "") < 40_000), key=repr)
    assert len(got) == len(rows) and set(want) <= set(got)
    assert sum(r[1] > 0 for r in got) >= len(rows) // 30
