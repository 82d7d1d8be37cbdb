"""Periodic runs of words: branching squares of an enhanced suffix array, rotated to the left and merged."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import WORD, bounded_batches

#: A run holds its period so often, and so many words, at least.
TIMES, WORDS = 4, 6
#: Words of the texts whose suffixes are sorted at once; a longer text is sorted alone.
SORTED = 1 << 18
#: Members of smaller children that are looked at in one step.
MEMBERS = 1 << 20

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the suffixes, their places in it, and how many symbols each shares with the one before it.

    The last symbol, and one in every stretch that shall not be compared with others, must occur once only.  Prefixes of 1, 2,
    4, ... symbols are ranked, each time only those that are not told apart yet; the ranks then give the shared lengths.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    head = np.ones(n, bool)
    head[1:] = symbols[order[1:]] != symbols[order[:-1]]
    place = np.arange(n)
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(head, place, 0))
    levels, width = [rank], 1
    while True:
        alone = head & np.append(head[1:], True)
        at = np.flatnonzero(~alone)
        if not at.size:
            break
        who = order[at]
        key = rank[who].astype(np.int64) * n + rank[who + width]
        by = np.argsort(key, kind="stable")
        who, key = who[by], key[by]
        order[at] = who
        first = np.append(True, key[1:] != key[:-1])
        head[at] = first
        rank = rank.copy()
        rank[who] = np.maximum.accumulate(np.where(first, at, 0))
        levels.append(rank)
        width *= 2
    places = rank
    places[order] = place
    shared = np.zeros(n, np.int64)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b = order[at - 1], order[at]
    for level in reversed(range(len(levels) - 1)):
        same = levels[level][a] == levels[level][b]
        step = same.astype(np.int64) << level
        a, b = a + step, b + step
    shared[at] = b - order[at]
    return order, places, shared


def _bounds(shared: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each place in ``at`` the first place of the part of its LCP interval before it, and the end of the part from it on.

    Intervals come from one pass with a stack of open ones; several parts of one interval are split off one by one.
    """
    low, high = [], [0] * len(at)
    depth: list[tuple[int, int, int]] = []
    last = -1
    for k, (p, d) in enumerate(zip(at.tolist(), shared[at].tolist())):
        if p != last + 1:
            for _, _, open_ in depth[1:]:
                high[open_] = last + 1
            depth = [(0, p - 1, -1)]
        while depth[-1][0] > d:
            high[depth.pop()[2]] = p
        low.append(depth[-1][1])
        depth.append((d, p, k))
        last = p
    for _, _, open_ in depth[1:]:
        high[open_] = last + 1
    return np.array(low, np.int64), np.array(high, np.int64)


def branching_squares(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, period) of all squares that do not go on to the right: the symbol after one differs from that a period before.

    Such a square's halves start at suffixes i and i + depth in different children of an LCP interval.  Of the two parts
    beside every place the smaller one is gone through: its suffixes look whether the one ``depth`` later or earlier is
    in the other part, by their places in the order.
    """
    order, places, shared = suffix_array(symbols)
    at = np.flatnonzero(shared)
    low, high = _bounds(shared, at)
    left = at - low <= high - at
    begin, other = np.where(left, low, at), np.where(left, at, low)
    size, other_end = np.where(left, at - low, high - at), np.where(left, high, at)
    ends = np.cumsum(size)
    starts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    k = 0
    while k < len(at):
        done = ends[k] - size[k]
        to = max(k + 1, int(np.searchsorted(ends, done + MEMBERS, side="right")))
        node = np.repeat(np.arange(k, to), size[k:to])
        i = order[np.arange(len(node)) + done - (ends - size)[node] + begin[node]]
        depth = shared[at[node]]
        for first in (i, i - depth):
            partner = first + depth if first is i else first
            there = places[np.maximum(partner, 0)]
            found = (partner >= 0) & (there >= other[node]) & (there < other_end[node])
            starts.append(first[found])
            periods.append(depth[found])
        k = to
    return np.concatenate(starts), np.concatenate(periods)


def _rotated(symbols: np.ndarray, start: int, period: int) -> int:
    """The first place to which a square can be rotated to the left."""
    step = 64
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(symbols[low:start] != symbols[low + period : start + period])
        if differ.size:
            return low + int(differ[-1]) + 1
        start, step = low, 2 * step
    return 0


def runs_of(symbols: np.ndarray, times: int = TIMES, words: int = WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs, ``period`` being their smallest one, in the order of start and period.

    The squares at the right end of a run, one for each multiple of its period, are merged into the smallest.
    Only runs of ``times`` periods and ``words`` words or more are returned; a square that cannot reach that far is left out early.
    """
    starts, periods = branching_squares(symbols)
    need = np.maximum(words, times * periods) - 2 * periods
    for part in (1 / 64, 1, 1 / 2):
        back = starts - np.ceil(part * need).astype(np.int64)
        fits = (back >= 0) & (symbols[np.maximum(back, 0)] == symbols[np.maximum(back, 0) + periods])
        starts, periods, need = starts[fits], periods[fits], need[fits]
    found = []
    ends = starts + 2 * periods
    ranked = np.lexsort((periods, ends))
    for end, same in groupby(zip(ends[ranked].tolist(), starts[ranked].tolist(), periods[ranked].tolist()), lambda x: x[0]):
        here: list[tuple[int, int]] = []
        for _, start, period in same:
            if any(first <= start and period % q == 0 for first, q in here):
                continue
            first = _rotated(symbols, start, period)
            if end - first >= max(words, times * period):
                here.append((first, period))
        found += [(first, end - first, period) for first, period in here]
    return sorted(found, key=lambda r: (r[0], r[2]))


def _most(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length per period, ties to the smallest start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _groups(texts: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with ``SORTED`` words or fewer, or one text."""
    start = total = 0
    for k, words in enumerate(texts):
        if k > start and total + len(words) > SORTED:
            yield start, k
            start, total = k, 0
        total += len(words)
    if start < len(texts):
        yield start, len(texts)


def _found(texts: list[list[bytes]], times: int, words: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs and collapsed text of each text; words are numbered per text, so only words of one text are ever equal."""
    numbers, firsts, base = [], [], 0
    for text in texts:
        known: dict[bytes, int] = {}
        firsts.append(firsts[-1] + len(numbers[-1]) if firsts else 0)
        numbers.append(np.array([*[known.setdefault(w, len(known)) for w in text], len(known)], np.int64) + base)
        base += len(known) + 1
    every = runs_of(np.concatenate(numbers), times, words)
    owners = np.searchsorted(firsts, [r[0] for r in every], side="right") - 1
    own: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for k, (start, length, period) in zip(owners.tolist(), every):
        own[k].append((start - firsts[k], length, period))
    for text, runs in zip(texts, own):
        if runs:
            depth = np.zeros(len(text) + 1, np.int64)
            for start, length, period in runs:
                depth[start + period] += 1
                depth[start + length] -= 1
            text = [text[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]
        yield runs, b" ".join(text)


def periodic_runs(docs: DataFrame, times: int = TIMES, words: int = WORDS) -> DataFrame:
    """(doc_id, n_words, runs, most, collapsed): where the words of a text repeat with a period, and the text without that.

    Words are runs without ASCII white space, numbered from 0.  ``runs`` are (start, length, period) of every maximal stretch
    whose words a smallest period apart are equal and that holds the period ``times`` times and ``words`` words at least, by start, then period;
    ``most`` is the run with the greatest length per period, ties to the smallest start, then period, null without runs;
    ``collapsed`` joins the words that lie in no run behind its first period by one space.

    A null text is an empty one.  Every row is answered by itself: rows that repeat a doc_id, or have none, are no special
    case, an empty table gives an empty one, and other columns are ignored.  No row leaves its task.  Texts are whole,
    whatever their length; a worker holds the suffixes of 262,144 words, or of one longer text, with four bytes a word
    for each doubling of its longest repeat.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t.as_py() or "").encode().split() for t in batch.column(1)]
            found = [x for a, b in _groups(texts) for x in _found(texts[a:b], times, words)]
            most = [_most(runs) for runs, _ in found]
            name = lambda r: r and dict(zip(("start", "length", "period"), r))
            columns = [
                batch.column(0),
                pa.array(list(map(len, texts)), pa.int64()),
                pa.array([list(map(name, runs)) for runs, _ in found], pa.list_(_RUN)),
                pa.array(list(map(name, most)), _RUN),
                pa.array([text.decode() for _, text in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "most", "collapsed"])

    run_type = "struct<start:long,length:long,period:long>"
    schema = f"doc_id long, n_words long, runs array<{run_type}>, most {run_type}, collapsed string"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def with_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the documents, a tenth of them with a repeat that their doc_id decides.

    With h the CRC-32 of the decimal doc_id and g = floor(h / 10), a text of n words with h % 10 = 0 repeats from word a = g % n on
    the p = 1 + floor((n - a) / (3 + g % 8)) words that follow; its words are then joined by one space.  Texts without words and rows
    without doc_id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    listed = F.regexp_extract_all("text", F.lit(WORD), 0)
    n = F.size(listed)
    a = (g % n).cast("int")
    p = F.floor((n - a) / (3 + g % 8)).cast("int") + 1
    again = F.flatten(F.array_repeat(F.slice(listed, a + 1, p), F.ceil((n - a) / p).cast("int")))
    text = F.array_join(F.concat(F.slice(listed, F.lit(1), a), F.slice(again, F.lit(1), n - a)), " ")
    return docs.select("doc_id", F.when((h % 10 == 0) & F.col("text").rlike(WORD), text).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """The runs of :func:`periodic_runs` as counts and checksums."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "most.start",
        "most.length",
        "most.period",
        F.expr("(1000 * most.length) div most.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
