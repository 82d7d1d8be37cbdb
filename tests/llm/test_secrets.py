"""Secret scan: candidates and features by brute force, held-out accuracy of the forest."""

import math
import re
from collections import Counter

import pytest
from llm_cases import rows_of
from pyspark.sql import functions as F

from tunelab.llm import secrets

SMALL = "/root/testdata/sf0.01"
KEY = "9f8a7b6c5d4e3f2a1b0c"
SCHEMA = "doc_id long, text string, candidate string, label string, n string, start string, word string, before string"
ROWS = [
    (1, f'token = "{KEY}" and more words'),
    (2, f"{KEY}{'x' * 3}\n/usr/lib/words/file-name-2024.html {KEY}"),
    (3, None),
    (4, ""),
    (5, "no candidates in here, longwordswithoutdigitsatall 123456"),
    (6, "größe 😀 " * 5000 + f"password={KEY}"),
    (7, f"a {KEY} b {KEY}"),
    (7, f"a {KEY} b {KEY}"),
    (None, f"key {KEY}"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame([(*r, *["clash"] * 6) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_candidates(awkward):
    pattern = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{16,}")
    want = []
    for doc_id, text in ROWS:
        found = [(m.start(), m[0], m.end()) for m in pattern.finditer(text or "")]
        ends = [0] + [e for _, _, e in found]
        starts = [s for s, _, _ in found] + [len(text or "")]
        for i, (s, c, e) in enumerate(found):
            want.append((doc_id, s, c, text[ends[i] : s][-60:], text[e : starts[i + 1]][:60]))
    assert rows_of(secrets.candidates(awkward), "doc_id", "start", "candidate", "before", "after") == sorted(want, key=repr)


def test_dictionary_and_transitions(spark, given):
    count = Counter(w for r in given.collect() for w in re.findall("[a-z]{3,}", (r["text"] or "").lower()))
    words = {w: n for w, n in count.items() if n >= secrets.MIN_COUNT}
    table = secrets.dictionary(given)
    assert {r["word"]: r["n"] for r in table.collect()} == words
    pairs = Counter()
    for w, n in words.items():
        for p in zip(w, w[1:]):
            pairs["".join(p)] += n
    first = Counter()
    for p, n in pairs.items():
        first[p[0]] += n
    found = {r["pair"]: r["logp"] for r in secrets.transitions(table).collect()}
    assert found == {p: pytest.approx(math.log(n / first[p[0]])) for p, n in pairs.items()}


def test_features(spark):
    words = spark.createDataFrame([("lib", 9), ("words", 9)], "word string, n long")
    pairs = spark.createDataFrame([("li", -1.0), ("ib", -2.0)], "pair string, logp double")
    found = spark.createDataFrame([("/lib/words-2024-aaBB", "see https://host", ".html", 1), (KEY, 'token = "', '" x', 2)], "candidate string, before string, after string, id int")
    a, b = secrets.features(found, words, pairs).orderBy("id").collect()
    assert a["chars"] == 20 and a["coverage"] == 8 / 20 and a["slashes"] == 2 and a["extension"] == 1
    assert a["transition"] == pytest.approx((-1 - 2 - 9 * 17) / 19)
    assert b["quoted"] == b["assigned"] == b["secret_word"] == 1 and b["plain_word"] == b["coverage"] == 0
    assert b["distinct_chars"] == len(set(KEY)) / len(KEY)


def test_held_out_accuracy(spark, given):
    known = secrets.made_findings(given, 600)
    words = secrets.stored(secrets.dictionary(given), "w")
    pairs = secrets.stored(secrets.transitions(words), "p")
    model = secrets.train(known.where(F.xxhash64("before") % 2 == 0), words, pairs)
    rated = model.transform(secrets.features(known.where(F.xxhash64("before") % 2 != 0), words, pairs))
    right, n = rated.agg(F.sum((F.col("prediction") == F.col("label")).cast("int")), F.count("*")).first()
    assert n > 2000 and right >= 0.97 * n


def test_scan(spark, given, awkward):
    found = secrets.scan(given).collect()
    tokens = {(r["doc_id"], m.start(1)) for r in given.collect() for m in re.finditer(r'token = "([0-9a-f]{40})"', r["text"] or "")}
    assert tokens and {(r["doc_id"], r["start"]) for r in found if r["is_secret"]} == tokens
    findings = secrets.made_findings(given)
    again = secrets.scan(awkward, findings)
    assert again.where("is_secret").where("doc_id = 1").count() == 1
    assert again.count() == secrets.candidates(awkward).count()
    assert rows_of(again, "doc_id", "start", "score") == rows_of(secrets.scan(awkward.repartition(2), findings), "doc_id", "start", "score")
    assert secrets.scan(awkward.limit(0)).count() == 0
