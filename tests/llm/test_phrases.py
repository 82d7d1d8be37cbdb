"""Phrase collocations against brute force, with samples that propose much, little and nothing."""

import random
import re
from collections import Counter

import pytest
from llm_cases import TEXTS, lower, rows_of

from tunelab.llm import phrases

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def brute_collocations(rows, least, top=2000, percent=100):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {p: n for p, n in counts.items() if n >= least}
    inside = Counter()
    for (lang, p), n in frequent.items():
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(inside[lang, p[i:j]], n)
    found = []
    for (lang, p), a in frequent.items():
        if len(p) > 1 and 100 * inside[lang, p] < percent * a:
            cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], totals[lang], score))
    out, ranks = [], Counter()
    for lang, phrase, *numbers in sorted(found, key=lambda x: (x[0], -x[6], -x[2], x[1].encode())):
        ranks[lang] += 1
        if ranks[lang] <= top:
            out.append((lang, ranks[lang], phrase, *numbers))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rng = random.Random(seed)
    fixed = [" ".join(rng.choice("abcdefgh") * 2 for _ in range(5)) for _ in range(4)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(6))))
            parts.append(rng.choice([" ", ". ", ",", "\n", "\t", "  ", "! ", "\r", "É ", "　"]))
        rows.append((i, "".join(parts), rng.choice(["en", "de", None, "und", ""])))
    return rows + [(n, "zz yy xx ww vv. " * 40, "fr"), (n + 1, "zz Yy xx ww vv\t" * 40, "fr")]


@pytest.mark.parametrize("every", [1, 2, 10**9])
@pytest.mark.parametrize("least", [5, 12])
def test_any_sample_gives_the_same(spark, every, least):
    rows = corpus(least)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    want = brute_collocations([(lang, t) for _, t, lang in rows], least)
    assert want and rows_of(phrases.collocations(df, least, every=every), *COLUMNS) == want


def test_border_failures_are_followed_until_closed(spark, monkeypatch):
    """Without any proposal every level fails in turn, and each phrase is counted in one pass only."""
    passes = []
    plain, border = phrases.counted, phrases.frequent_hashes
    monkeypatch.setattr(phrases, "counted", lambda texts, asked: passes.append(asked) or plain(texts, asked))
    monkeypatch.setattr(phrases, "frequent_hashes", lambda texts, asked, *more: passes.append(asked) or border(texts, asked, *more))
    df = spark.createDataFrame([(i, "one two three four five six. two one", "en") for i in range(9)], "doc_id long, text string, lang string")
    found = phrases.frequent_phrases(df, 9, every=10**9)
    assert found.groupBy("lang", "k", "phrase").count().where("count > 1").isEmpty()
    assert Counter(r["k"] for r in found.collect()) == {0: 1, 1: 6, 2: 6, 3: 4, 4: 3, 5: 2}
    assert [(x.shortest, x.longest, len(x.earlier), x.failed is None) for x in passes] == [
        (1, 1, 0, True), (2, 2, 0, True), (3, 5, 0, True), (2, 5, 0, True), (2, 5, 1, False), (2, 5, 2, True), (2, 5, 3, True)
    ]


def test_a_full_filter_and_small_sums_change_nothing(spark, monkeypatch):
    for name, value in (("MOST_BITS", 10), ("UNIT", 300), ("WORDS", 4), ("ADDED", 5), ("RANGE", 9)):
        monkeypatch.setattr(phrases, name, value)
    rows = corpus(3, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert rows_of(phrases.collocations(df, 4), *COLUMNS) == brute_collocations([(lang, t) for _, t, lang in rows], 4)


def test_units_cut_texts_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "UNIT", 50)
    texts = ["one two. three " * 20, "x " * 100, "", "a,b", "c " * 24 + "d", "\n" * 120]
    units = list(phrases._units(list("abcdef"), texts))
    assert {lang: b"".join(d for u in units for l, d in u if l == lang) for lang in "abde"} == {
        lang: t.encode().translate(phrases._CLEAN) for lang, t in zip("abcdef", texts) if lang in "abde"
    }
    assert max(sum(len(d) for _, d in u) for u in units) <= 260


def test_top_and_percent(spark):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for top, percent in ((3, 100), (50, 60), (50, 1000)):
        want = brute_collocations([(lang, t) for _, t, lang in rows], 6, top, percent)
        assert rows_of(phrases.collocations(df, 6, top=top, percent=percent), *COLUMNS) == want


def test_products_beyond_64_bits(spark):
    big = 3_000_000_007
    rows = [("en", 0, "", 10**13), ("en", 1, "a", big * 5), ("en", 1, "b", big * 3), ("en", 2, "a b", big)]
    found = phrases.scored(spark.createDataFrame(rows, "lang string, k int, phrase string, n long")).collect()
    assert [(r["phrase"], r["score"]) for r in found] == [("a b", 1000 * big * 10**13 // (big * 5 * big * 3))]


def test_awkward_documents(documents, no_documents):
    rows = [("en", t) for _, t, _ in TEXTS]
    assert rows_of(phrases.collocations(documents, 2), *COLUMNS) == brute_collocations(rows, 2)
    assert rows_of(phrases.collocations(no_documents), *COLUMNS) == []


def test_later_passes_count_only_around_what_failed(spark, monkeypatch):
    """Nothing is proposed, so pass after pass follows; a phrase without a fresh one in it is not counted again."""
    counted, plain = [], phrases.counted
    monkeypatch.setattr(phrases, "counted", lambda texts, asked: counted.append((asked, plain(texts, asked))) or counted[-1][1])
    rows = [(i, f"one two three four five six. two one own{i} own{i + 1}. four four", "en") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    want = brute_collocations([("en", t) for _, t, _ in rows], 9)
    assert rows_of(phrases.collocations(df, 9, every=10**9), *COLUMNS) == want
    later = [(asked, {r["phrase"] for r in found.collect()}) for asked, found in counted if len(asked.earlier) > 1]
    assert later and all(asked.fresh is not None for asked, _ in later)
    assert not any("own" in p or "four four" in p for _, found in later for p in found)


def test_phrases_of_one_hash_are_told_apart():
    hashes = phrases.np.array([7, 7, 9, 7, 7, 9], phrases.np.uint64)
    parts = [phrases.np.array(x) for x in ([1, 2, 3, 1, 2, 3], [5, 5, 6, 5, 6, 6])]
    first, counts = phrases._alike(hashes, parts)
    found = {tuple(int(p[i]) for p in parts): int(n) for i, n in zip(first, counts)}
    assert found == {(1, 5): 2, (2, 5): 1, (2, 6): 1, (3, 6): 2}
