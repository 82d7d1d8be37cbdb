"""Embedding near-dedup: inverted lists, product-quantised residuals, table-lookup distances, exact cosine rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, components, stored

COSINE = 0.9
#: Numbers of the sample on which the index is fitted, in all: 16,384 vectors of 128 components.
SAMPLE_NUMBERS = 1 << 21
#: Vectors of a list aimed at, and lists at most.
LIST, LISTS = 512, 1024
#: Components of a subspace and its codewords.
SUB, CODES = 4, 256
#: Share of neighbours just at the threshold, in random directions, that the probes must reach.
REACH = 0.995
#: Vectors and queries of a list that one task compares.
BLOCK = 4096


@dataclass
class Index:
    centroids: np.ndarray
    codebooks: np.ndarray
    probes: int


def _padded(v: list) -> np.ndarray:
    m = np.stack(v)
    return np.pad(m, ((0, 0), (0, -m.shape[1] % SUB)))


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ c.T + (c**2).sum(axis=1), 0)


def _kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        own = _squares(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=k)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[rng.integers(len(x), size=k)])
    return centres


def fit(sample: np.ndarray, count: int, cosine: float, reach: float = REACH) -> Index:
    """Coarse centroids, residual codebooks and the number of probes, from a bounded sample of unit vectors.

    The probes are sufficient by measurement: neighbours at exactly the threshold are made in random
    directions, and as many lists are probed as ``reach`` of them need, from the nearer side of the pair.
    """
    rng = np.random.default_rng(7)
    lists = max(1, min(LISTS, count // LIST, len(sample) // 8))
    centroids = _kmeans(sample, lists, 8, rng)
    residual = (sample - centroids[_squares(sample, centroids).argmin(axis=1)])[:4096]
    subs = sample.shape[1] // SUB
    books = np.stack([_kmeans(residual[:, s * SUB : s * SUB + SUB], CODES, 5, rng) for s in range(subs)])
    x = sample[rng.choice(len(sample), min(2048, len(sample)), replace=False)]
    side = rng.standard_normal(x.shape) * (np.abs(sample).max(axis=0) > 0)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-300)
    y = cosine * x + math.sqrt(max(0.0, 1 - cosine**2)) * side
    dx, dy = _squares(x, centroids), _squares(y, centroids)
    rows = np.arange(len(x))
    there = (dx < dx[rows, dy.argmin(axis=1)][:, None]).sum(axis=1)
    back = (dy < dy[rows, dx.argmin(axis=1)][:, None]).sum(axis=1)
    probes = int(np.quantile(np.minimum(there, back), reach, method="higher")) + 1
    return Index(centroids, books, min(lists, probes))


def encode(x: np.ndarray, index: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probed lists (the first is the own one), codes and quantisation errors of unit vectors."""
    near = _squares(x, index.centroids)
    probes = np.argsort(near, axis=1, kind="stable")[:, : index.probes].astype(np.int32)
    residual = x - index.centroids[probes[:, 0]]
    codes = np.empty((len(x), len(index.codebooks)), np.uint8)
    left = np.zeros(len(x))
    for s, book in enumerate(index.codebooks):
        part = residual[:, s * SUB : s * SUB + SUB]
        codes[:, s] = _squares(part, book).argmin(axis=1)
        left += ((part - book[codes[:, s]]) ** 2).sum(axis=1)
    return probes, codes, np.sqrt(left)


def compare(members: pd.DataFrame, queries: pd.DataFrame, index: Index, cosine: float, chunk: int = 64) -> pd.DataFrame:
    """(a, b, n) of one block of a list: ``n`` vectors linked to ``a`` (b null), and links a-b that join what links join.

    The table-lookup distance to a member's code, less the member's quantisation error, bounds its distance from
    below; only members whose bound is within the threshold are compared exactly.
    """
    home = int(members["list"].iloc[0])
    ids, sizes = members["rep"].to_numpy(), members["n"].to_numpy()
    vectors, errors = _padded(members["v"].to_list()), members["error"].to_numpy()
    codes = np.frombuffer(b"".join(members["codes"]), np.uint8).reshape(len(ids), -1)
    probes = np.stack(members["probes"].to_list())
    qids, qsizes, qlists = (queries[c].to_numpy() for c in ("rep", "n", "list"))
    asked = _padded(queries["v"].to_list())
    limit = math.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9
    counts = np.zeros(len(qids), np.int64)
    back = np.zeros(len(ids), np.int64)
    parent = np.arange(len(ids))
    links = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for start in range(0, len(qids), chunk):
        q = asked[start : start + chunk]
        residual = q - index.centroids[home]
        total = np.zeros((len(q), len(ids)), np.float32)
        for s, book in enumerate(index.codebooks):
            table = _squares(residual[:, s * SUB : s * SUB + SUB], book).astype(np.float32)
            total += table[:, codes[:, s]]
        near = np.sqrt(total) <= limit + errors + 1e-3
        for k in np.flatnonzero(near.any(axis=1)):
            at = np.flatnonzero(near[k] & (ids != qids[start + k]))
            at = at[vectors[at] @ q[k] >= cosine]
            if not at.size:
                continue
            counts[start + k] = sizes[at].sum()
            unseen = ~(probes[at] == qlists[start + k]).any(axis=1)
            back[at[unseen]] += qsizes[start + k]
            roots = np.unique([root(i) for i in np.unique(parent[at])])
            parent[roots] = roots[0]
            links.append((qids[start + k], ids[at[0]]))
            if len(roots) > 1:
                links.extend((qids[start + k], ids[r]) for r in roots)
    out = []
    for owners, n in ((qids, counts), (ids, back)):
        owners, n = owners[n > 0], n[n > 0]
        out.append(pd.DataFrame({"a": owners, "b": pd.array([None] * len(owners), "Int64"), "n": n}))
    a, b = ([x[i] for x in links] for i in (0, 1))
    out.append(pd.DataFrame({"a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "n": np.zeros(len(links), np.int64)}))
    return pd.concat(out)


def _links(classes: DataFrame, count: int, cosine: float) -> DataFrame:
    """(a, b, n) over all blocks of all lists, for the distinct unit vectors of one length."""
    dim = classes.select(F.size("v")).first()[0]
    sample = classes.orderBy(F.xxhash64("v"), "k2").limit(max(256, SAMPLE_NUMBERS // max(1, dim))).select("v").toPandas()
    index = fit(_padded(sample["v"].to_list()), count, cosine)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                probes, codes, errors = encode(_padded(batch["v"].to_list()), index)
                yield batch.assign(list=probes[:, 0], probes=list(probes), codes=[c.tobytes() for c in codes], error=errors)

    schema = "rep long, n long, v array<double>, list int, probes array<int>, codes binary, error double"
    coded = classes.select("rep", "n", "v").mapInPandas(run, schema)
    coded = stored(coded, "codes")
    asked = coded.select("rep", "n", "v", "list", F.explode("probes").alias("at"))
    members = coded.withColumn("at", F.col("list"))
    parts = asked.groupBy("at").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks"))
    parts = parts.join(members.groupBy("at").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "at")
    parts = F.broadcast(stored(parts, "blocks"))
    spread = F.xxhash64("rep")
    members = members.join(parts, "at").withColumn("block", F.pmod(spread, F.col("blocks")).cast("int"))
    members = members.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    asked = asked.join(parts, "at").withColumn("query_block", F.pmod(spread, F.col("query_blocks")).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tile = ["at", "block", "query_block"]
    members = members.select(*[F.col(c).alias(c) for c in [*tile, "rep", "n", "v", "list", "probes", "codes", "error"]])
    asked = asked.select(*[F.col(c).alias(c) for c in [*tile, "rep", "n", "v", "list"]])

    def tiles(key: tuple, m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return compare(m, q, index, cosine) if len(m) and len(q) else pd.DataFrame({"a": [], "b": [], "n": []})

    return members.groupBy(*tile).cogroup(asked.groupBy(*tile)).applyInPandas(tiles, "a long, b long, n long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): linked vectors, the smallest vec_id of the component, and whether it is this one.

    Links are pairs of cosine >= ``cosine`` in double precision.  Every vector is indexed: it lies in the list of its nearest
    centroid and asks the lists nearest to it, so many that neighbours at the threshold are reached (see
    :func:`fit`); within a list nothing is lost, as the table-lookup distance only excludes what its error bound excludes.

    Equal vectors are one class, so copies are never paired; a list of many vectors is compared in blocks.  A block
    returns counts and links that join its vectors, at most a few per vector, not pairs.

    Null, empty and zero vectors, and those with null or non-finite components, link with nothing, nor do rows without
    vec_id (their component_id is null and they are kept).  Vectors of different lengths are not linked.  Rows that repeat a
    vec_id are vectors of their own.  An empty table gives an empty one; other columns are ignored.
    """
    bounded_batches(vectors.sparkSession)
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    top = F.array_max(F.transform(values, F.abs))
    rows = vectors.select(F.col("vec_id").cast("long"), values.alias("embedding"), finite.alias("finite"), top.alias("top"))
    rows = rows.withColumn("ok", F.coalesce(F.col("vec_id").isNotNull() & F.col("finite") & (F.col("top") > 0), F.lit(False)))
    rows = rows.withColumn("s", F.when(F.col("ok"), F.transform("embedding", lambda x: x / F.col("top"))))
    length = F.sqrt(F.aggregate("s", F.lit(0.0), lambda t, x: t + x * x))
    rows = rows.withColumn("length", length).withColumn("v", F.transform("s", lambda x: x / F.col("length")))
    rows = stored(rows.select("vec_id", "v", F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2")), "unit-vectors")
    classes = rows.where("v is not null").groupBy("k1", "k2", "v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    # a class has a number of its own, since a vec_id that repeats may be the first of several
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    found = None
    for r in classes.groupBy(F.size("v").alias("dim")).count().collect():
        own = _links(classes.where(F.size("v") == r["dim"]), r["count"], cosine)
        found = own if found is None else found.union(own)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(found, "vector-links")
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null"), "a", "b")
    named = classes.select("k1", "k2", "rep", "first", "n").join(counts, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    links = (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links")
    named = stored(named.select("k1", "k2", "first", links, F.coalesce("root", "rep").alias("root")), "vector-roots")
    least = stored(named.groupBy("root").agg(F.min("first").alias("component")), "vector-firsts")
    named = stored(named.join(least, "root").select("k1", "k2", "links", "component"), "vector-components")
    keyed = rows.select("vec_id", F.when(F.col("v").isNotNull(), F.col("k1")).alias("k1"), "k2")
    joined = keyed.join(named, ["k1", "k2"], "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
