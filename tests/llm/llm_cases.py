"""Awkward inputs and brute-force versions of the operators."""

import re
from collections import Counter, defaultdict
from hashlib import md5

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Column names that the operators use inside, as extra columns of the input.
CLASHES = ("key", "same", "size", "pos", "line", "row", "before", "taken", "fp", "gone", "parts", "slot", "shard", "vec", "hash", "host", "of_id", "of_same", "stays", "n", "root", "set", "first", "id", "kept")

LONG = "\n".join(f"line number {i} of a very long text with some words " + "ab" * (i % 7) for i in range(4000))

TEXTS = [
    (1, "Shared line of some length\nonly in one\n\n  SHARED LINE of some length\t", "a"),
    (2, "shared line of some length\nshort\nshort", "a"),
    (3, "x\nshared line of some length \ny", None),
    (4, None, "b"),
    (5, "", "b"),
    (6, LONG, "c"),
    (7, LONG + " and a tail", "c"),
    (8, "a b", "b"),
    (8, "a b", "b"),
    (8, "another text under the id of eight\nshared line of some length", "a"),
    (None, "no id but shared line of some length\nshared line of some length", "a"),
    (None, None, None),
    (9, " \t\r\n \x0b\x0c", ""),
    (10, "Zwölf größere Boxkämpfer jagen Viktor über den Sylter Deich", "d"),
    (11, "Zwölf größere Boxkämpfer jagen Viktor über den Sylter Deich", "d"),
    (12, "one two three four five six seven eight nine ten " * 30, "e"),
    (13, "😀 emoji line that is long enough\n em spaces are no ascii spaces ", "e"),
]


def rows_of(df, *columns):
    return sorted(([tuple(r[c] for c in columns) for r in df.collect()]), key=repr)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_lines(rows):
    """(doc_id, n_lines, n_dropped, text) of (doc_id, text) rows."""
    keys = lambda t: [lower(line.strip(" \t\n\x0b\x0c\r")) for line in (t or "").split("\n")]
    holders = defaultdict(set)
    for doc_id, text in rows:
        for key in keys(text):
            if len(key) >= 20:
                holders[key].add(-1 if doc_id is None else doc_id)
    out = []
    for doc_id, text in rows:
        lines, own = (text or "").split("\n"), -1 if doc_id is None else doc_id
        kept = [line for line, key in zip(lines, keys(text)) if len(holders[key]) < 3 or max(holders[key]) == own]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def brute_fingerprint(text):
    words = WORD.findall(lower(text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(n, linked):
    """The smallest index reachable from each of n, by a function that lists the neighbours of one."""
    found = {}
    for i in range(n):
        todo = [i] if i not in found else []
        while todo:
            x = todo.pop()
            if x not in found:
                found[x] = i
                todo.extend(linked(x))
    return [found[i] for i in range(n)]


def simhash_classes(rows, radius=2):
    """Fingerprints of (doc_id, text) rows and the group of each."""
    prints = np.array([brute_fingerprint(t) for _, t in rows], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    return prints, groups(len(rows), lambda i: np.flatnonzero(near[i]).tolist())


def brute_simhash(rows, radius=2):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints, group = simhash_classes(rows, radius)
    least = defaultdict(lambda: None)
    for g, (doc_id, _) in zip(group, rows):
        if doc_id is not None:
            least[g] = doc_id if least[g] is None else min(least[g], doc_id)
    return sorted(((d, f"{int(p):016x}", least[g]) for (d, _), p, g in zip(rows, prints, group)), key=repr)


def brute_groups(rows):
    """The group of each of (doc_id, text) rows: five-word shingles, a similarity of 0.8 or more."""
    sets = []
    for _, text in rows:
        words = WORD.findall(lower(text or ""))
        sets.append({tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())

    def near(i):
        return [j for j, s in enumerate(sets) if s == sets[i] or 9 * len(s & sets[i]) >= 4 * (len(s) + len(sets[i])) > 0]

    return groups(len(rows), near)


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    """Targets of {source: words}, by resharing the excess until none is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, open_ = {}, sum(sizes.values()), list(order)
    while open_:
        share = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if most * sizes[s] < share * weight[s]]
        for s in full or open_:
            target[s] = float(most * sizes[s]) if full else share * weight[s]
        left -= sum(most * sizes[s] for s in full)
        open_ = [s for s in open_ if s not in full] if full else []
    return target


def brute_mix(rows, seed="mix"):
    """(doc_id, size, source_size, target, taken) of (doc_id, text, source) rows; equal rows at a cut share what it leaves."""
    size = lambda t: len(WORD.findall(t or ""))
    totals = Counter()
    for _, t, s in rows:
        totals[s] += size(t)
    target = brute_targets(dict(totals))
    out = []
    for source in totals:
        copies = Counter((int(md5(f"{seed}{'' if d is None else d}|{t or ''}".encode()).hexdigest()[:15], 16), -1 if d is None else d, size(t)) for d, t, s in rows if s == source)
        budget = int(np.floor(target[source] + 0.5))
        epochs, rest = divmod(budget, totals[source]) if totals[source] else (0, 0)
        for (_, d, n), c in sorted(copies.items()):
            part = n if rest >= c * n else max(0, rest) // c
            rest -= c * n
            out += [(None if d == -1 else d, n, totals[source], target[source], epochs * n + part)] * c
    return sorted(out, key=repr)


def brute_weights(rows, labels):
    """Log weights of (doc_id, text) rows: n-grams and repeated words, good documents against all, counted one by one."""
    buckets = 1 << 14

    def symbols(text):
        data, found = (text or "").encode(), Counter()
        for i in range(len(data) - 2):
            h = (data[i] * 257 + data[i + 1]) * 257 + data[i + 2]
            found["gram", (h * 0x9E3779B97F4A7C15 % (1 << 64)) >> 50] += 1
        words = data.split()
        for a, b in zip(words, words[1:]):
            found["word", a == b] += 1
        return found

    everything = [symbols(t) for _, t in rows]
    every, good = Counter(), Counter()
    for (doc_id, _), found in zip(rows, everything):
        every.update(found)
        if labels.get(doc_id, 0) >= 1:
            good.update(found)
    if not good:
        return [0.0] * len(rows)
    ratio = {}
    for kind, n in (("gram", buckets), ("word", 2)):
        sums = [sum(c for (k, _), c in counts.items() if k == kind) + n for counts in (good, every)]
        for k, x in every:
            if k == kind:
                ratio[k, x] = np.log((good[k, x] + 1) / sums[0]) - np.log((every[k, x] + 1) / sums[1])
    return [3000 * sum(c * ratio[s] for s, c in found.items()) / (300 + sum(found.values())) for found in everything]


def gumbel(doc_id, seed="gumbel"):
    n = int(md5(f"{seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)
    return -np.log(-np.log((n + 0.5) / (1 << 60)))


def brute_quality(rows, labels, caution=5):
    """Whether each of (doc_id, text) rows is drawn."""
    weights = brute_weights(rows, labels)
    good = [w for (d, _), w in zip(rows, weights) if labels.get(d) == 1]
    bad = [w for (d, _), w in zip(rows, weights) if labels.get(d) == 0]
    if not good or not bad:
        return [True] * len(rows)
    values = sorted({*good, *bad})
    cuts = [(values[0] - 1, 0.0)] + [((a + b) / 2, b - a) for a, b in zip(values, values[1:])]
    cost = {c: caution * sum(g < c for g in good) + sum(b >= c for b in bad) for c, _ in cuts}
    cut = max((gap, -c, c) for c, gap in cuts if cost[c] == min(cost.values()))[2]
    k = sum(w >= cut for w in weights)
    keys = [w + gumbel(d) for (d, _), w in zip(rows, weights)]
    last = sorted(keys, reverse=True)[k - 1]
    return [x >= last for x in keys]
