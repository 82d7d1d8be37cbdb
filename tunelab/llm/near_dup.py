"""Near duplicates by SimHash and the Jaccard similarity of word shingles: near fingerprints, exact check, prefix filter for the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, components, stored
from tunelab.llm.simhash import first_of_groups
from tunelab.llm.simhash import links as near_fingerprints

SHINGLE = 5
#: Two texts are near duplicates from a similarity of SHARE / OUT_OF.
SHARE, OUT_OF = 4, 5
#: Differing bits up to which SimHash proposes a pair; what is near beyond them is found by shared shingles.
RADIUS = 3
#: Documents whose shingles are counted to tell the common ones, occurrences that make one common, and common ones at most.
SAMPLE_DOCS, COMMON, MOST = 16_000, 3, 200_000
#: Bits of a shingle's hash that are kept below those of its range; shingles of a range and sets of a bucket, about.
HASH_BITS, RANGE, BUCKET = 40, 1 << 22, 4096
#: Shingles that a task packs at once, and sets that it knows to have passed on.
UNIT, SEEN = 1 << 20, 1 << 20
SHARED = np.dtype([("shingle", np.int64), ("set", np.int64), ("n", np.int32)])
#: Leaders that a text is compared with before its component is known.
LEADERS = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; fewer words make one shingle, no words none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.int64)
    known: dict[bytes, int] = {}
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh64_intdigest(word)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(shingle, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        mixed = (mixed ^ hashes[i : len(words) - width + 1 + i]) * _MIX
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed.view(np.int64))


def fingerprint(found: np.ndarray, block: int = 1 << 16) -> int:
    """Signed 64-bit SimHash of a text's shingles: bit set in over half of their hashes; none: 0."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(found), block):
        part = found[start : start + block]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found)).view(np.int64)[0])


def _shingle_sets(docs: DataFrame) -> DataFrame:
    """(same, shingles) of texts, ``same`` being the hash of a text."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["same", "shingles"])

    return docs.select(F.xxhash64("text").alias("same"), "text").mapInArrow(run, "same long, shingles array<long>")


def _common(docs: DataFrame, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Common shingles and their counts in a sample of the different texts.  They decide the order of shingles, never the result."""
    every = max(1, docs.count() // sample)
    texts = docs.select("text", F.xxhash64("text").alias("same")).where(F.pmod("same", F.lit(every)) == 0)
    some = _shingle_sets(texts.groupBy("same").agg(F.any_value("text").alias("text")))
    counted = some.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = counted.orderBy(F.desc("n"), "s").limit(MOST).orderBy("s").collect()
    return np.array([r["s"] for r in rows], np.int64), np.array([r["n"] for r in rows], np.int64)


def _prefix_length(size: np.ndarray) -> np.ndarray:
    """So many shingles, rare ones first, that two near duplicates share one of them."""
    return np.where(size > 0, size - (SHARE * size + OUT_OF - 1) // OUT_OF + 1, 0)


def _common_among(found: np.ndarray, common: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Counts of the shingles that are common, 0 for the others."""
    if not len(common):
        return np.zeros(len(found), np.int64)
    at = np.minimum(np.searchsorted(common, found), len(common) - 1)
    return np.where(common[at] == found, counts[at], 0)


def _texts(docs: DataFrame, common: np.ndarray, counts: np.ndarray) -> DataFrame:
    """(doc_id, same, set, size, n_common, commons, fp) of every row; ``set`` is a hash of its shingles, equal for equal sets.

    ``fp`` is the SimHash of the set.
    ``commons`` are a text's common shingles in the order of prefixes, of texts so full of them that its prefix may hold some.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(1)]
            often = [_common_among(f, common, counts) for f in found]
            size = np.array([len(f) for f in found], np.int64)
            n_common = np.array([np.count_nonzero(o) for o in often], np.int64)
            length = _prefix_length(size)
            commons = [f[np.lexsort((f, o))][-c:][:n] if c and z - c < n else None for f, o, z, c, n in zip(found, often, size, n_common, length)]
            columns = [
                batch.column(0),
                batch.column(2),
                pa.array(np.array([xxhash.xxh64_intdigest(f.tobytes()) for f in found], np.uint64).view(np.int64)),
                pa.array(size),
                pa.array(n_common),
                pa.array(commons, pa.list_(pa.int64())),
                pa.array([*map(fingerprint, found)], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "same", "set", "size", "n_common", "commons", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("same"))
    return rows.mapInArrow(run, "doc_id long, same long, set long, size long, n_common long, commons array<long>, fp long")


def _packed(docs: DataFrame, common: np.ndarray, bits: int) -> DataFrame:
    """(range, hashes, of, sets): the other shingles, by their leading bits; ``of`` is a text's place in ``sets``.

    A shingle is eleven bytes less than a row of its own: five of its hash below the leading bits and two for its text.
    A task passes on each set once, so a text of many copies comes as often as there are tasks.
    """
    bounded_batches(docs.sparkSession)

    def rows_of(found: list[np.ndarray], sets: list[int]) -> pa.RecordBatch:
        every = np.concatenate(found).view(np.uint64)
        of = np.repeat(np.arange(len(found), dtype=np.uint16), [len(f) for f in found])
        order = np.argsort(every)
        every, of = every[order], of[order]
        place = (every >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(every), np.int64)
        ranges, first = np.unique(place, return_index=True)
        ends = np.append(first[1:], len(every))
        kept = ((every << np.uint64(bits)) >> np.uint64(64 - HASH_BITS)).view(np.uint8).reshape(-1, 8)[:, : HASH_BITS // 8]
        columns = [
            pa.array(ranges),
            pa.array([kept[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            pa.array([of[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
            pa.array([np.array(sets, np.int64).tobytes()] * len(ranges), pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["range", "hashes", "of", "sets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        found, sets, total = [], [], 0
        for batch in batches:
            for text in batch.column(0):
                own = shingles(text.as_py())
                name = xxhash.xxh64_intdigest(own.tobytes())
                if name in seen or not len(own):
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(name)
                found.append(own[_common_among(own, common, common) == 0] if len(common) else own)
                sets.append(np.uint64(name).view(np.int64))
                total += len(own)
                if total >= UNIT or len(sets) == 1 << 16:
                    yield rows_of(found, sets)
                    found, sets, total = [], [], 0
        if sets:
            yield rows_of(found, sets)

    return docs.select("text").mapInArrow(run, "range long, hashes binary, of binary, sets binary")


def _shared(packed: DataFrame, buckets: int) -> DataFrame:
    """(bucket, shared): the shingles that several sets hold, with their exact number of sets, packed by the bucket of their set."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        wide = np.zeros((sum(map(len, rows["hashes"])) * 8 // HASH_BITS, 8), np.uint8)
        wide[:, : HASH_BITS // 8] = np.frombuffer(b"".join(rows["hashes"]), np.uint8).reshape(-1, HASH_BITS // 8)
        hashes = wide.reshape(-1).view(np.uint64).astype(np.int64) + (int(key[0]) << HASH_BITS)
        names = [np.frombuffer(s, np.int64)[np.frombuffer(o, np.uint16)] for s, o in zip(rows["sets"], rows["of"])]
        names = np.concatenate(names)
        order = np.lexsort((names, hashes))
        hashes, names = hashes[order], names[order]
        new = np.append(True, (hashes[1:] != hashes[:-1]) | (names[1:] != names[:-1]))[: len(hashes)]
        hashes, names = hashes[new], names[new]
        _, n = np.unique(hashes, return_counts=True)
        n = np.repeat(n, n)
        table = np.zeros(np.count_nonzero(n > 1), SHARED)
        table["shingle"], table["set"], table["n"] = hashes[n > 1], names[n > 1], n[n > 1]
        bucket = table["set"] % buckets
        order = np.argsort(bucket, kind="stable")
        table, bucket = table[order], bucket[order]
        found, first = np.unique(bucket, return_index=True)
        ends = np.append(first[1:], len(table))
        return pd.DataFrame({"bucket": found, "shared": [table[a:b].tobytes() for a, b in zip(first, ends)]})

    return packed.groupBy("range").applyInPandas(run, "bucket long, shared binary")


def _posts(classes: DataFrame, shared: DataFrame, buckets: int) -> DataFrame:
    """(shingle, set, size, pos): the shared shingles among the first ones of each set, and their places.

    Shingles are ordered by the number of sets that hold them, common ones last; those that only one set
    holds come first and need no row, since nothing can be met there.
    """

    def run(key: tuple, rows: pd.DataFrame, packed: pd.DataFrame) -> pd.DataFrame:
        found = np.frombuffer(b"".join(packed["shared"]), SHARED) if len(packed) else np.zeros(0, SHARED)
        found = found[np.lexsort((found["shingle"], found["n"], found["set"]))]
        rows = rows.sort_values("set")
        sets, size = rows["set"].to_numpy(np.int64), rows["size"].to_numpy(np.int64)
        n_common = rows["n_common"].to_numpy(np.int64)
        begin, end = np.searchsorted(found["set"], sets, "left"), np.searchsorted(found["set"], sets, "right")
        unique = size - n_common - (end - begin)
        length = _prefix_length(size)
        take = np.clip(length - unique, 0, end - begin)
        of = np.repeat(np.arange(len(sets)), take)
        rank = np.arange(len(of)) - np.repeat(np.cumsum(take) - take, take)
        posts = [pd.DataFrame({"shingle": found["shingle"][begin[of] + rank], "set": sets[of], "size": size[of], "pos": unique[of] + rank})]
        for i in np.flatnonzero(length > size - n_common):
            own = np.asarray(rows["commons"].iloc[i], np.int64)[: length[i] - (size[i] - n_common[i])]
            place = size[i] - n_common[i] + np.arange(len(own))
            posts.append(pd.DataFrame({"shingle": own, "set": sets[i], "size": size[i], "pos": place}))
        return pd.concat(posts)

    own = classes.select("set", "size", "n_common", "commons", F.pmod("set", F.lit(buckets)).alias("bucket"))
    both = own.groupBy("bucket").cogroup(shared.groupBy("bucket"))
    return both.applyInPandas(run, "shingle long, set long, size long, pos long")


def _possible(a: str, b: str) -> Column:
    """Whether two texts that share the shingle at ``pos`` as their first one can be near duplicates, by sizes and places."""
    rest = F.least(F.col(f"{a}.size") - F.col(f"{a}.pos"), F.col(f"{b}.size") - F.col(f"{b}.pos"))
    return (OUT_OF + SHARE) * rest >= SHARE * (F.col(f"{a}.size") + F.col(f"{b}.size"))


def _verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets whose similarity is large enough, counted on their whole shingles."""
    pairs = stored(pairs.distinct(), "near-pairs")
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    wanted = stored(classes.join(wanted, "set", "left_semi").select("set", "same"), "near-wanted")
    texts = docs.select("text", F.xxhash64("text").alias("same")).join(wanted.select("same"), "same", "left_semi")
    once = texts.groupBy("same").agg(F.any_value("text").alias("text"))
    sets = stored(_shingle_sets(once).join(wanted, "same").select("set", "shingles"), "near-sets")
    both = pairs
    for side in "ab":
        both = both.join(sets.select(F.col("set").alias(side), F.col("shingles").alias(f"in_{side}")), side)
    shared = F.size(F.array_intersect("in_a", "in_b"))
    enough = (OUT_OF + SHARE) * shared >= SHARE * (F.size("in_a") + F.size("in_b"))
    return stored(both.where(enough).select("a", "b"), "near-links")


def _components(classes: DataFrame, links: DataFrame) -> DataFrame:
    roots = components(links, "a", "b")
    return classes.select("set").join(roots, F.col("set") == F.col("node"), "left").select("set", F.coalesce("root", "set").alias("root"))


def _by_fingerprint(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of sets by SimHash: each with the first one of its fingerprint, and the first ones of near fingerprints."""
    own = classes.where("size > 0").select("set", "fp")
    first = stored(own.groupBy("fp").agg(F.min("set").alias("first")), "near-fingerprints")
    same = own.join(first, "fp").where("set != first").select(F.col("first").alias("a"), F.col("set").alias("b"))
    near = stored(near_fingerprints(first.select("fp"), radius), "near-bits").distinct()
    for side in "ab":
        near = near.join(first.select(F.col("fp").alias(side), F.col("first").alias(f"of_{side}")), side)
    near = near.select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
    return same.union(near)


def _led(posts: DataFrame, own: Column) -> DataFrame:
    """Pairs (a, b) of texts with a few leaders of their lists, in a mixed order."""
    met = posts.select(own.alias("x"), F.col("leader").alias("y")).where("x.set != y.set").where(_possible("x", "y"))
    mixed = F.struct(F.xxhash64("y.set"), F.col("y.set").alias("set"))
    met = met.groupBy(F.col("x.set").alias("b")).agg(F.slice(F.array_sort(F.collect_set(mixed)), 1, LEADERS).alias("a"))
    met = met.select(F.explode("a.set").alias("a"), "b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _open(posts: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """The lists whose texts are in different components, with each text's ``root`` and the list's ``largest`` one."""
    roots = stored(_components(classes, links), "near-roots")
    placed = stored(posts.select("shingle", "set", "size", "pos").join(roots, "set"), "near-placed")
    parts = placed.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    parts = parts.groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("parts"))
    return stored(placed.join(parts.where("parts > 1").drop("parts"), "shingle"), "near-open")


def _grouped(docs: DataFrame, sample: int) -> DataFrame:
    """(doc_id, same, root, component_id) of every row.

    SimHash proposes pairs, fingerprints of a few differing bits, which are checked on whole shingle sets.  It misses near ones of more
    bits; so that no link is lost, an exact way follows for what is not in one group by then: near duplicates share a shingle of
    their prefixes, so the texts of one shingle are a list of candidates.  Every shingle is counted
    once, in ranges of its hash, and goes back to its text only if another one has it.  Every text is
    first compared with a few leaders of its lists, which links large groups without their pairs.  What is then in
    different components of a list is compared pair by pair, except within the list's largest component.
    """
    common, counts = _common(docs, sample)
    found = stored(_texts(docs, common, counts), "near-texts")
    firsts = [F.min("doc_id").alias("first"), F.min("same").alias("same"), F.max("size").alias("size"), F.max("n_common").alias("n_common")]
    classes = stored(found.groupBy("set").agg(*firsts, F.max("commons").alias("commons"), F.min("fp").alias("fp")), "near-classes")
    total = classes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    bits, buckets = min(24, max(0, (total[0] // RANGE).bit_length())), 1 + total[1] // BUCKET
    posts = stored(_posts(classes, _shared(_packed(docs, common, bits), buckets), buckets), "near-posts")
    lists = posts.groupBy("shingle").agg(F.count("*").alias("n"), F.min_by(F.struct("set", "size", "pos"), F.xxhash64("set")).alias("leader"))
    lists = stored(lists.where("n > 1"), "near-lists")
    posts = stored(posts.join(lists, "shingle"), "near-listed")

    proposed = _by_fingerprint(classes).union(_led(posts, F.struct("set", "size", "pos")))
    links = _verified(proposed, docs, classes)
    open_ = _open(posts, classes, links)
    side = F.struct("set", "size", "pos", "root", (F.col("root") == F.col("largest")).alias("in_largest"))
    left = open_.where("root != largest").select("shingle", side.alias("x"))
    right = open_.select("shingle", side.alias("y"))
    rest = left.join(right, "shingle").where("x.root != y.root and (y.in_largest or x.set < y.set)").where(_possible("x", "y"))
    rest = rest.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b"))
    links = links.union(_verified(rest, docs, classes))

    member = stored(classes.select("set", "first").join(_components(classes, links), "set"), "near-members")
    least = stored(member.groupBy("root").agg(F.min("first").alias("component_id")), "near-least")
    named = stored(member.join(least, "root").select("set", "root", "component_id"), "near-named")
    return found.select("doc_id", "same", "set").join(named, "set")


def representatives(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest doc_id.

    Near duplicates are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more; groups are what
    such pairs link.  A-Z are lower-cased, words are runs without ASCII white space; texts of the same shingles, and all
    without words (null ones too), are copies.  SimHash links come first and are checked exactly; all other pairs are found too: the sample only names the common shingles, which are
    ordered last instead of being counted, so that none of them makes a hot spot; hashes of 48 bits that coincide only add
    candidates, which are counted on whole shingle sets.

    Of rows that repeat a doc_id the one with the smallest text hash stays, equal rows become one; rows without doc_id are
    linked by their texts, and of a group without any doc_id one row stays.  An empty table gives an empty one; other
    columns, whatever their names, are kept as they are.
    """
    return first_of_groups(docs, _grouped(docs, sample))
