"""Phrase collocations by Toivonen's mining: a sample proposes, full passes count, until the border holds."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.llm.common import LOWER, UPPER, bounded_batches, stored

#: Words of the longest phrase, occurrences of a frequent one, phrases reported per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: One document in so many is in the sample.
EVERY = 8
#: Bits of a filter: so many per phrase, of which two are set, but never more than the most, 8 MB.
BITS_EACH, MOST_BITS = 32, 26
#: A phrase goes that a longer one holds in so many of a hundred of its occurrences.
PERCENT = 100

#: Bytes of text whose phrases are counted at once; longer texts are cut where no phrase goes on.
UNIT = 1 << 20
#: Words that a task knows by number, and hashed phrases that it adds up, before it passes them on and starts anew: so
#: many that a worker needs some ten megabytes for each.
WORDS, ADDED = 1 << 18, 1 << 20
#: Phrases of a range whose hashes are added up at once, about.
RANGE = 1 << 22

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(UPPER.encode() + b"\t" + _BREAKS, LOWER.encode() + b" " + b"\n" * len(_BREAKS))
_MIX, _MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _longer(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    mixed = (hashes ^ last) * _MIX
    return mixed ^ (mixed >> np.uint64(29))


def _slots(hashes: np.ndarray, bits: int, mix: np.uint64) -> np.ndarray:
    """Places in a filter, by the leading 48 bits of the hashes."""
    return (((hashes >> np.uint64(16)) * mix) >> np.uint64(64 - bits)).view(np.int64)


def _phrase_hash(lang: str, phrase: str) -> int:
    seed = xxhash.xxh32_intdigest(lang)
    first, *rest = np.array([xxhash.xxh64_intdigest(w, seed) for w in phrase.encode().split(b" ")], np.uint64)[:, None]
    for word in rest:
        first = _longer(first, word)
    return int(first[0])


def _hashed(phrases: DataFrame) -> DataFrame:
    """(hash) of (lang, phrase) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([*map(_phrase_hash, batch.column(0).to_pylist(), batch.column(1).to_pylist())], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    return phrases.select("lang", "phrase").mapInArrow(run, "hash long")


class Filter:
    """The phrases of a table by their hashes, in bits that are shared with all tasks: it may hold more, never less.

    Its size has a fixed bound.  Beyond that it fills up, and more phrases than were meant are counted, each exactly as before.
    """

    def __init__(self, phrases: DataFrame):
        """``phrases`` are rows of (lang, phrase) or of (hash)."""
        hashes = phrases.select("hash") if "hash" in phrases.columns else _hashed(phrases)
        bits = min(MOST_BITS, max(10, (BITS_EACH * phrases.count()).bit_length()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                slots = np.unique(np.concatenate([_slots(own, bits, mix) for mix in (_MIX, _MIX_2)]))
                cells, first = np.unique(slots >> 6, return_index=True)
                held = np.bitwise_or.reduceat(np.int64(1) << (slots & 63), first) if len(slots) else slots
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(held)], names=["cell", "held"])

        cells = hashes.mapInArrow(run, "cell long, held long").groupBy("cell").agg(F.bit_or("held").alias("held"))
        table = cells.toPandas()
        words = np.zeros(1 << (bits - 6), np.int64)
        words[table["cell"].to_numpy(np.int64)] = table["held"].to_numpy(np.int64)
        self.bits = bits
        self.held = phrases.sparkSession.sparkContext.broadcast(words)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        words = self.held.value
        slots = _slots(hashes, self.bits, _MIX)
        found = (words[slots >> 6] >> (slots & 63)) & 1 == 1
        first = np.flatnonzero(found)
        slots = _slots(hashes[first], self.bits, _MIX_2)
        found[first] = (words[slots >> 6] >> (slots & 63)) & 1 == 1
        return found


class Asked(NamedTuple):
    """What a pass counts: phrases of ``shortest`` to ``longest`` words whose parts, without the first and the last word, are ``known``.

    Of parts longer than ``upto`` nothing is known, so all pass.  With ``hashed`` true phrases are counted by their hashes.  What ``earlier``
    passes have counted is left out, but for the hashes that turned out frequent, ``failed``.  Where phrases are ``fresh``, known since
    the last pass only, just phrases around them are counted: the others have the parts that they had before.
    """

    shortest: int
    longest: int
    known: Filter | None = None
    upto: int = 0
    hashed: bool = False
    earlier: tuple[Asked, ...] = ()
    failed: Filter | None = None
    fresh: Filter | None = None

    def passes(self, hashes: np.ndarray, k: int) -> np.ndarray:
        return np.ones(len(hashes), bool) if k > self.upto else self.known(hashes)


class _Numbers(dict):
    """Numbers of the words of one language; a new word gets a provisional one, from -2 down, until its unit is done."""

    def __init__(self, lang: str, new: list[tuple[_Numbers, bytes]]):
        self.lang, self.new = lang, new
        self[b"."] = -1

    def __missing__(self, word: bytes) -> int:
        self.new.append((self, word))
        self[word] = number = -1 - len(self.new)
        return number


class _Words:
    """Numbers and hashes of the words of a task, per language; words that are not known are breaks like those between pieces."""

    def __init__(self, asked: Asked):
        self.asked = asked
        self.words: list[bytes] = []
        self.langs: list[str] = []
        self.numbers: dict[str, _Numbers] = {}
        self.new: list[tuple[_Numbers, bytes]] = []
        self.hashes = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return sum(map(len, self.numbers.values()))

    def symbols(self, unit: list[tuple[str, bytes]]) -> np.ndarray:
        found = []
        for lang, data in unit:
            own = self.numbers.get(lang)
            if own is None:
                own = self.numbers[lang] = _Numbers(lang, self.new)
            found.append(np.array([*map(own.__getitem__, data.replace(b"\n", b" . ").split()), -1], np.int64))
        every = np.concatenate(found)
        if self.new:
            seeds = {lang: xxhash.xxh32_intdigest(lang) for lang in self.numbers}
            hashes = np.array([xxhash.xxh64_intdigest(word, seeds[own.lang]) for own, word in self.new], np.uint64)
            known = self.asked.passes(hashes, 1)
            final = np.where(known, len(self.words) + np.cumsum(known) - 1, -1)
            for (own, word), number in zip(self.new, final.tolist()):
                own[word] = number
                if number >= 0:
                    self.words.append(word)
                    self.langs.append(own.lang)
            self.hashes = np.concatenate([self.hashes, hashes[known]])
            self.new.clear()
            every = np.where(every < -1, final[np.clip(-2 - every, 0, len(final) - 1)], every)
        return every


def _units(langs: list[str], texts: list[str]) -> Iterator[list[tuple[str, bytes]]]:
    """The texts as clean bytes with line feeds between pieces, whole or cut there, in units of about ``UNIT`` bytes."""
    unit, size = [], 0
    for lang, text in zip(langs, texts):
        data, start = text.encode().translate(_CLEAN), 0
        while start < len(data):
            end = start + UNIT - size
            if end < len(data):
                cut = data.rfind(b"\n", start, end) + 1 or data.find(b"\n", end) + 1
                end = cut or len(data)
            unit.append((lang, data[start:end]))
            size += len(unit[-1][1])
            start = end
            if size >= UNIT or start < len(data):
                yield unit
                unit, size = [], 0
    if unit:
        yield unit


def _counts(langs: list, k: int, phrases: list, counts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(langs, pa.string()), pa.array(np.full(len(langs), k, np.int32)), pa.array(phrases, pa.string()), pa.array(counts.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "k", "phrase", "n"])


def _word_counts(unit: list[tuple[str, bytes]], known: dict[str, Counter]) -> None:
    for lang, data in unit:
        known.setdefault(lang, Counter()).update(data.split())


def _passed_on(known: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the words so far, and with k = 0 those of all words of a language."""
    for lang, words in known.items():
        if words:
            yield _counts([lang] * len(words), 1, [*words], np.fromiter(words.values(), np.int64, len(words)))
            yield _counts([lang], 0, [""], np.array([words.total()]))


def _around(every: np.ndarray, hashes: np.ndarray, asked: Asked) -> np.ndarray:
    """The words ``every`` with breaks for those that no phrase with a fresh one in it can hold."""
    bounds = np.zeros(len(every) + 1, np.int64)
    at = np.flatnonzero(every >= 0)
    found = hashes[every[at]]
    for k in range(2, asked.longest):
        both = np.flatnonzero(at[1:] == at[:-1] + 1)
        at = at[both]
        found = _longer(found[both], hashes[every[at + k - 1]])
        hits = at[asked.fresh(found)]
        bounds += np.bincount(np.maximum(hits + k - asked.longest, 0), minlength=len(bounds))
        bounds -= np.bincount(np.minimum(hits + asked.longest, len(every)), minlength=len(bounds))
    return np.where(np.cumsum(bounds[:-1]) > 0, every, -1)


def _alike(hashes: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places of the first, counts) of equal phrases, given by hashes and by the numbers of their words."""
    order = np.argsort(hashes)
    differ = hashes[order[1:]] != hashes[order[:-1]]
    if any(((p[order[1:]] != p[order[:-1]]) & ~differ).any() for p in parts):  # different phrases of one hash
        order = np.lexsort(parts)
        differ = np.logical_or.reduce([p[order[1:]] != p[order[:-1]] for p in parts])
    first = np.flatnonzero(np.append(True, differ))
    return order[first], np.diff(np.append(first, len(order)))


def _phrases(unit: list[tuple[str, bytes]], words: _Words, asked: Asked) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, words of the unit, places, hashes): the occurrences of phrases that are asked for."""
    every = words.symbols(unit)
    if asked.fresh:
        every = _around(every, words.hashes, asked)
    at = np.flatnonzero(every >= 0)
    hashes = words.hashes[every[at]]
    counted = [np.ones(len(at), bool) for _ in asked.earlier]
    for k in range(2, asked.longest + 1):
        keep = asked.passes(hashes, k - 1)
        both = np.flatnonzero(keep[1:] & keep[:-1] & (at[1:] == at[:-1] + 1))
        counted = [c & e.passes(hashes, k - 1) for c, e in zip(counted, asked.earlier)]
        counted = [c[both] & c[both + 1] for c in counted]
        at = at[both]
        hashes = _longer(hashes[both], words.hashes[every[at + k - 1]])
        if k < asked.shortest or not len(at):
            continue
        new = np.ones(len(at), bool)
        for c, e in zip(counted, asked.earlier):
            new &= ~c
            if e.hashed and asked.failed:  # what is frequent by its hash is counted again by its text
                of = np.flatnonzero(c)
                new[of[asked.failed(hashes[of])]] = True
        if new.any():
            yield k, every, at[new], hashes[new]


def _phrase_counts(unit: list[tuple[str, bytes]], words: _Words, asked: Asked) -> Iterator[pa.RecordBatch]:
    for k, every, at, hashes in _phrases(unit, words, asked):
        parts = [every[at + o] for o in range(k)]
        first, counts = _alike(hashes, parts)
        parts = [p[first].tolist() for p in parts]
        names = [[words.words[i] for i in part] for part in parts]
        yield _counts([words.langs[i] for i in parts[0]], k, [*map(b" ".join, zip(*names))], counts)


def counted(texts: DataFrame, asked: Asked) -> DataFrame:
    """(lang, k, phrase, n): occurrences in (lang, text) of the phrases that are asked for; with words asked for, k = 0 has those of a language.

    Each task adds up the words, and the phrases of a unit, before anything is shuffled.
    """
    bounded_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, known = _Words(asked), {}
        for unit in (unit for batch in batches for unit in _units(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            if asked.longest == 1:
                _word_counts(unit, known)
            else:
                yield from _phrase_counts(unit, words, asked)
            if len(words) >= WORDS:
                words = _Words(asked)
            if sum(map(len, known.values())) >= WORDS:
                yield from _passed_on(known)
                known = {}
        yield from _passed_on(known)

    found = texts.select("lang", "text").mapInArrow(run, "lang string, k int, phrase string, n long")
    return found.groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def frequent_hashes(texts: DataFrame, asked: Asked, least: int, bits: int) -> DataFrame:
    """(hash): those of the phrases that are asked for which occur ``least`` times or more.

    Each task adds up hashes and passes them on as ranges, ten bytes each; a range is added up at once.
    Hashes are cut to 48 bits: those that coincide are counted together, so none is missed.
    """
    bounded_batches(texts.sparkSession)

    def summed(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        if counts is None:
            hashes = np.sort(hashes)
        else:
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        return hashes[first], np.diff(np.append(first, len(hashes))) if counts is None else np.add.reduceat(counts, first)

    def packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, counts = summed(np.concatenate([h for h, _ in parts]), np.concatenate([n for _, n in parts]))
        counts = counts.astype(np.uint32)
        ranges, first = np.unique(hashes >> np.uint64(48 - bits), return_index=True)
        ends = [*first[1:].tolist(), len(hashes)]
        low = hashes.view(np.uint8).reshape(-1, 8)[:, :6]
        blobs = [pa.array([x[a:b].tobytes() for a, b in zip(first.tolist(), ends)], pa.binary()) for x in (low, counts)]
        return pa.RecordBatch.from_arrays([pa.array(ranges.astype(np.int64)), *blobs], names=["range", "hashes", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, parts, held = _Words(asked), [], 0
        for unit in (unit for batch in batches for unit in _units(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            found = [hashes for *_, hashes in _phrases(unit, words, asked)]
            if found:
                parts.append(summed(np.concatenate(found) >> np.uint64(16)))
                held += len(parts[-1][0])
            if held >= ADDED:
                yield packed(parts)
                parts, held = [], 0
            if len(words) >= WORDS:
                words = _Words(asked)
        if parts:
            yield packed(parts)

    def add_up(rows: pd.DataFrame) -> pd.DataFrame:
        size = sum(map(len, rows["hashes"])) // 6
        wide = np.zeros((size, 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(rows["hashes"]), np.uint8).reshape(-1, 6)
        hashes, n = summed(wide.reshape(-1).view(np.uint64), np.frombuffer(b"".join(rows["counts"]), np.uint32).astype(np.int64))
        return pd.DataFrame({"hash": (hashes[n >= least] << np.uint64(16)).view(np.int64)})

    found = texts.select("lang", "text").mapInArrow(run, "range long, hashes binary, counts binary")
    return found.groupBy("range").applyInPandas(add_up, "hash long")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, every: int = EVERY) -> DataFrame:
    """(lang, k, phrase, n): all phrases of one to ``longest`` words with ``least`` occurrences in a language; k = 0 has its words.

    1. Words are counted in a full pass.  2. A sample of one in ``every`` documents is mined level by level at a
    lowered threshold.  3. A full pass counts, by hashes, what the sample proposed and its negative border, the phrases that are not
    proposed themselves while both parts of them, without the first and without the last word, are.  A hash counts at least as
    often as each phrase that has it, so no frequent one is missed.  4. The next full pass counts the phrases of frequent hashes by their
    text, and what failures of the border add to it; as long as that holds frequent phrases, another pass follows.  Counts
    are exact whatever the sample holds.
    """
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")
    columns = ("lang", "k", "phrase", "n")
    words = stored(counted(texts, Asked(1, 1)).where((F.col("k") == 0) | (F.col("n") >= least)).select(*columns), "words")
    if longest == 1:
        return words
    expected = least / every
    few = max(2, int(expected - 2 * expected**0.5))
    of_words = Filter(words.where("k = 1"))
    sample = stored(texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) == 0).select("lang", "text"), "phrase-sample")
    pairs = stored(counted(sample, Asked(2, 2, of_words, 1)).where(F.col("n") >= few).select(*columns), "sample-pairs")
    proposed = words.where("k = 1").union(pairs)
    if longest > 2:
        longer = counted(sample, Asked(3, longest, Filter(proposed), 2)).where(F.col("n") >= few)
        proposed = proposed.union(stored(longer.select(*columns), "sample-phrases"))
    passes = [Asked(2, longest, Filter(proposed), longest, hashed=True)]
    total = words.where("k = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(24, ((longest - 1) * total // RANGE).bit_length())
    often = stored(frequent_hashes(texts, passes[0], least, bits), "frequent-hashes")
    found, open_ = words.where("k > 1"), often
    while not open_.isEmpty():
        known = Filter(_hashed(words.where("k = 1").union(found)).select("hash").union(often))
        failed = Filter(often) if len(passes) == 1 else None
        fresh = Filter(open_) if len(passes) > 1 else None
        asked = Asked(2, longest, known, longest, earlier=tuple(passes), failed=failed, fresh=fresh)
        new = stored(counted(texts, asked).where(F.col("n") >= least).select(*columns), "phrases")
        passes.append(asked._replace(earlier=(), failed=None, fresh=None))
        found = found.union(new)
        cut = F.shiftleft(F.shiftright("hash", 16), 16).alias("hash")
        open_ = _hashed(new.where(F.col("k") < longest)).select(cut).join(often, "hash", "left_anti")
    return words.union(found)


def _joined(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(frequent: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the phrases of two words or more that no longer one stands for.

    A phrase is cut after each of its words: with l and r the occurrences of both parts and n the words of its language, the
    score is the lowest floor(1000 a n / (l r)), the first of equal cuts.  Products are decimals of 38 digits.  A phrase goes if
    one with a word more at either end has ``percent`` of a hundred of its occurrences; a still longer one has no more.
    """
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    counts = frequent.where("k > 0").select("lang", "phrase", "n")
    listed = F.split("phrase", " ")
    cuts = frequent.where("k > 1").select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumn("first", _joined(listed, F.lit(1), F.col("cut"))).withColumn("rest", _joined(listed, F.col("cut") + 1, F.col("k") - F.col("cut")))
    for part, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(part), F.col("n").alias(name)), ["lang", part])
    cuts = cuts.join(frequent.where("k = 0").select("lang", "n"), "lang")
    score = F.expr("div(cast(1000 * a as decimal(19,0)) * cast(n as decimal(19,0)), cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cuts.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "cut", "l", "r").alias("cut"))
    best = best.groupBy("lang", "phrase", "a", "n").agg(F.min("cut").alias("cut"))
    inner = F.explode(F.array(_joined(listed, F.lit(1), F.col("k") - 1), _joined(listed, F.lit(2), F.col("k") - 1)))
    holders = frequent.where("k > 2").select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("held"))
    best = best.join(holders, ["lang", "phrase"], "left").where(F.col("held").isNull() | (100 * wide("held") < percent * wide("a")))
    return best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, percent: int = PERCENT, every: int = EVERY
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by score, occurrences and phrase.

    A-Z are lower-cased; texts are cut into pieces at ``. , ; : ! ?`` and line ends, pieces into words at spaces and tabs.  A null
    language is ``und``, a null text empty.  Rows that repeat a doc_id, or have none, are documents of their own; an
    empty table gives an empty one; other columns are ignored.

    Only filters of a fixed bound (8 MB) are sent to all tasks; phrases are counted by shuffles on (lang, phrase), summed up in the
    tasks first, so neither a language nor a phrase that a third of all rows hold is a hot spot, and ranking
    starts with the best of each partition.
    """
    best = scored(stored(frequent_phrases(docs, least, longest, every), "frequent"), percent)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")
