"""SimHash near-dedup: tiled exact comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, components, stored

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a tile; two tiles are compared as one matrix.
TILE = 1024
#: A fingerprint's four quarters; the population count of each is known per tile.
QUARTERS = 4


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED, block: int = 1 << 16) -> int:
    """Signed 64-bit SimHash of a text's word shingles: bit set in over half of their XXH64; no words: 0."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    if len(tokens) < shingle:
        grams = iter([b" ".join(tokens)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(tokens[i:] for i in range(shingle))))
        n = len(tokens) - shingle + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, block):
        size = min(block, n - start)
        hashes = np.fromiter((digest(next(grams), seed) for _ in range(size)), dtype=">u8", count=size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n)
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, same, fp) of whole texts; A-Z are lower-cased, words are runs without ASCII white space.

    ``same`` is a hash of the text, which tells rows of one doc_id apart.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle, seed) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())], names=["doc_id", "same", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("same")).mapInArrow(run, "doc_id long, same long, fp long")


def _steps(radius: int) -> list[list[int]]:
    """Differences of the quarters' population counts within the radius, one of each opposite pair."""
    reach = range(-radius, radius + 1)
    near = [d for d in product(reach, repeat=QUARTERS) if sum(map(abs, d)) <= radius]
    return [list(d) for d in near if d >= (0,) * QUARTERS]


def tile_links(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same fingerprints as all pairs within ``radius`` of two tiles do, at most one for each."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    rows, cols = near.any(axis=1), near.any(axis=0)
    if not rows.any():
        return left[:0], left[:0]
    near, left, right = near[np.ix_(rows, cols)], left[rows], right[cols]
    # every fingerprint takes the smallest row number that it reaches, until nothing changes
    low = np.arange(len(left))
    while True:
        of_right = np.where(near, low[:, None], len(left)).min(axis=0)
        new = np.where(near, of_right[None, :], len(left)).min(axis=1)
        new = np.minimum(new, low)
        new = np.minimum(new, new[new])
        if (new == low).all():
            break
        low = new
    return np.concatenate([left, right]), np.concatenate([left[low], left[of_right]])


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` that join what all pairs within ``radius`` join.

    Fingerprints with the same population counts in their four quarters form a cell, at most 83,521 in all;
    hash blocks of a cell with at most about ``tile`` fingerprints form tiles.  Counts that differ by more than the radius in sum
    rule a pair of tiles out.  Every other pair meets once, in a join on the cell number, and is compared bit by bit.
    """
    count = [F.bit_count(F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF))) for q in range(QUARTERS)]
    celled = classes.select("fp", F.array(*count).cast("array<int>").alias("cell"))
    blocks = celled.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("blocks"))
    celled = celled.join(F.broadcast(blocks), "cell")
    celled = celled.withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    tiles = stored(celled.groupBy("cell", "block").agg(F.collect_list("fp").alias("fps")), "tiles")
    steps = F.array(*[F.array(*map(F.lit, s)) for s in _steps(radius)])
    here = tiles.select(F.col("cell").alias("cell_a"), F.col("block").alias("block_a"), F.explode(steps).alias("step"))
    here = here.withColumn("cell_b", F.zip_with("cell_a", "step", lambda x, y: x + y))
    there = tiles.select(F.col("cell").alias("cell_b"), F.col("block").alias("block_b"))
    met = here.join(there, "cell_b").where((F.col("cell_a") != F.col("cell_b")) | (F.col("block_a") <= F.col("block_b")))
    met = met.select("cell_a", "block_a", "cell_b", "block_b")
    for side in "ab":
        own = tiles.select(F.col("cell").alias(f"cell_{side}"), F.col("block").alias(f"block_{side}"), F.col("fps").alias(f"fps_{side}"))
        met = met.join(own, [f"cell_{side}", f"block_{side}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column(0), batch.column(1)):
                left, right = (x.values.to_numpy(zero_copy_only=False).view(np.uint64) for x in (a, b))
                found.append(tile_links(left, right, radius))
            u = np.concatenate([x for x, _ in found] or [np.zeros(0, np.uint64)]).view(np.int64)
            v = np.concatenate([x for _, x in found] or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(u[u != v]), pa.array(v[u != v])], names=["a", "b"])

    bounded_batches(classes.sparkSession)
    return met.select("fps_a", "fps_b").mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """(doc_id, fp, component_id): fingerprints and the smallest doc_id reachable by links of ``radius`` bits or fewer.

    Documents without words, null texts among them, have the fingerprint zero and are linked like any other.  Equal
    fingerprints are one class, so copies are never paired.  Rows that repeat a doc_id are linked by what
    each of them holds; a null doc_id is returned and linked, and its component is the smallest doc_id that
    is not null (null if there is none).  An empty table gives an empty one; other columns are ignored.
    """
    return _grouped(docs, shingle, radius, seed).select("doc_id", "fp", "component_id")


def _grouped(docs: DataFrame, shingle: int, radius: int, seed: int) -> DataFrame:
    found = stored(fingerprints(docs, shingle, seed), "fingerprints")
    classes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, radius), "a", "b")
    member = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    member = stored(member, "members")
    least = stored(member.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = stored(member.join(least, "root").select("fp", "root", "component_id"), "named")
    return found.join(named, "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest doc_id.

    Of rows that repeat it the one with the smallest text hash stays, equal rows become one.  In a group without any
    doc_id all rows but one go.  Only hashes of the rows that go are joined to the texts.
    """
    return first_of_groups(docs, _grouped(docs, shingle, radius, seed))


def first_of_groups(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The row of the smallest doc_id of each group, of rows ``grouped`` as (doc_id, same, root, component_id)."""
    found = stored(grouped.groupBy("component_id", "root", "doc_id", "same").agg(F.count("*").alias("n")), "grouped")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = stored(first.groupBy("root").agg(F.min("same").alias("first_same")), "first")
    judged = found.join(first, "root")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("same") == F.col("first_same"))
    judged = judged.select(F.col("doc_id").alias("of_id"), F.col("same").alias("of_same"), stays.alias("stays"), "n")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("same"))
    here = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("same") == F.col("of_same"))
    rest = rows.join(judged.where(~F.col("stays")), here, "left_anti")
    if judged.where("stays and n > 1").isEmpty():
        return rest.select("row.*")
    once = rest.join(judged.where("stays and n = 1"), here, "left_semi")
    return once.union(_one_each(rest.join(judged.where("stays and n > 1"), here, "left_semi"))).select("row.*")


def _one_each(rows: DataFrame) -> DataFrame:
    return rows.withColumn("id", F.coalesce("id", F.lit(-1))).dropDuplicates(["id", "same"])
