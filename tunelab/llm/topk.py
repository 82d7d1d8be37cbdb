"""Exact top-k search by inner product: norm-sorted blocks, SVD-rotated partial sums, Cauchy-Schwarz bounds."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, stored

SCALE = 1024
BEST = 10
EVERY = 100
#: Vectors of a block, queries of a block, and vectors of the head that gives every query its first bound.
VECTORS, QUERIES, HEAD = 8192, 2048, 2048
#: Bands of norm at most; a band of many vectors has many blocks.
BANDS = 64
#: Leading rotated components that are summed before the bound is tried.
LEADING = 16
#: Largest product of two norms at which sums of doubles are exact integers.
EXACT = float(1 << 53)
#: Scores are 64-bit numbers; larger ones count as the largest.
MOST = float(1 << 63)


def quantised(vectors: DataFrame, is_query: Column, scale: int = SCALE) -> DataFrame:
    """(vec_id, dim, v, norm, asks): ``floor(scale * x)`` of every component, as doubles; rows that take no part are left out."""
    values = F.col("embedding").cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    whole = F.transform(values, lambda x: F.floor(x * F.lit(float(scale))).cast("double"))
    kept = [F.size(values).alias("dim"), whole.alias("v"), is_query.alias("asks"), finite.alias("finite")]
    table = vectors.select(F.col("vec_id").cast("long"), *kept)
    table = table.where("vec_id is not null and finite").drop("finite")
    return table.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))


def rotation(table: DataFrame, dim: int) -> np.ndarray:
    """Right singular vectors of all vectors of one length, from the sum of their outer products (dim x dim numbers)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if len(batch):
                m = np.stack(batch["v"].to_list())
                m = m / np.maximum(np.abs(m).max(), 1)
                total += m.T @ m
        yield pd.DataFrame({"i": range(dim), "r": list(total)})

    rows = table.select("v").mapInPandas(run, "i int, r array<double>")
    sums = rows.select("i", F.posexplode("r").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((dim, dim))
    for r in sums.collect():
        gram[r["i"], r["j"]] = r["x"]
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def best_of_block(m: pd.DataFrame, q: pd.DataFrame, turn: np.ndarray, best: int, chunk: int = 128) -> pd.DataFrame:
    """The best of a block of vectors for each query of a block, among those that can reach the query's floor.

    Vectors are taken by falling norm.  A query sees the prefix whose norms can reach its floor, and of that the
    vectors whose leading rotated components and the product of the norms of the rest reach it; those
    are scored exactly.
    """
    m = m.sort_values(["norm", "vec_id"], ascending=[False, True])
    ids, norms, vectors = m["vec_id"].to_numpy(), m["norm"].to_numpy(), np.stack(m["v"].to_list())
    qids, qnorms, asked = q["vec_id"].to_numpy(), q["norm"].to_numpy(), np.stack(q["v"].to_list())
    floor = q["floor"].to_numpy() - 1 - 1e-9 * qnorms * norms[0]
    exact = float(norms[0] * qnorms.max()) < EXACT
    rm, rq = vectors @ turn, asked @ turn
    lead = min(LEADING, vectors.shape[1])
    rest, qrest = (np.sqrt((x[:, lead:] ** 2).sum(axis=1)) for x in (rm, rq))
    found = []
    for start in range(0, len(qids), chunk):
        part = slice(start, start + chunk)
        reach = int(np.searchsorted(-norms, -np.min(floor[part] / np.maximum(qnorms[part], 1e-300)), side="right"))
        bound = rm[:reach, :lead] @ rq[part, :lead].T + rest[:reach, None] * qrest[part]
        for k, may in enumerate((bound >= floor[part]).T, start):
            at = np.flatnonzero(may & (ids[:reach] != qids[k]))
            if exact:
                scores = (vectors[at] @ asked[k]).astype(np.int64)
                order = np.lexsort((ids[at], -scores))[:best]
            else:
                whole = [int(x) for x in asked[k]]
                sums = [sum(int(a) * b for a, b in zip(row, whole)) for row in vectors[at]]
                sums = [max(-(1 << 63), min((1 << 63) - 1, x)) for x in sums]
                order = np.array(sorted(range(len(at)), key=lambda i: (-sums[i], ids[at[i]]))[:best], dtype=int)
                scores = np.array(sums, dtype=np.int64)
            found.append(pd.DataFrame({"query_id": np.full(len(order), qids[k]), "vec_id": ids[at[order]], "score": scores[order]}))
    return pd.concat(found)


def first_floors(queries: DataFrame, head: pd.DataFrame, best: int) -> DataFrame:
    """Add ``floor``: no less than so much is every query's last score, as its best scores within the head show."""
    ids, vectors = head["vec_id"].to_numpy(), np.stack(head["v"].to_list())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            low = np.full(len(batch), -np.inf)
            if len(batch) and len(ids) > best:
                scores = np.stack(batch["v"].to_list()) @ vectors.T
                scores[batch["vec_id"].to_numpy()[:, None] == ids] = -np.inf
                low = np.partition(scores, -best, axis=1)[:, -best]
                low = np.minimum(low, MOST) - 1e-9 * batch["norm"].to_numpy() * head["norm"].max()
            yield batch.assign(floor=low)

    return queries.mapInPandas(run, "vec_id long, v array<double>, norm double, floor double")


def top_k(vectors: DataFrame, is_query: Column, best: int = BEST, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``best`` vectors of highest integer inner product for every query row.

    Ties go to the smaller vec_id.  Rows with a query's own vec_id are no candidates.  Null and empty vectors, those with
    null or non-finite components and rows without vec_id take no part; vectors meet queries of their own length.  Each of
    the rows that repeat a vec_id is a candidate; of query rows that repeat one the smallest vector asks.
    Scores beyond 64 bits count as the largest (or smallest) number.  An empty table gives an empty one.

    The query set meets all vectors in blocks.  Vectors are cut into bands of falling norm and, by hash, into blocks of a
    band; queries into blocks by hash; a task compares one block of each.  The longest vectors, a bounded head, first give
    each query a floor for its last place.  Bands too short to reach it do not get the query at all; inside a
    block the floor prunes by norm and by rotated partial sums.  A block returns at most ``best`` rows per query.
    """
    bounded_batches(vectors.sparkSession)
    table = stored(quantised(vectors, is_query, scale).where("dim > 0"), "quantised")
    schema = "query_id long, vec_id long, score long"
    found = vectors.sparkSession.createDataFrame([], schema)
    for row in table.groupBy("dim").count().collect():
        found = found.union(_of_length(table.where(F.col("dim") == row["dim"]), row["dim"], row["count"], best, schema))
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= best)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _of_length(own: DataFrame, dim: int, count: int, best: int, schema: str) -> DataFrame:
    turn = rotation(own, dim)
    head = own.orderBy(F.desc("norm"), "vec_id").limit(HEAD).select("vec_id", "v", "norm").toPandas()
    asked = own.where("asks").groupBy("vec_id").agg(F.min(F.struct("v", "norm")).alias("q")).select("vec_id", "q.v", "q.norm")
    asked = stored(first_floors(asked, head, best), "floors")
    n = max(1, min(BANDS, -(-count // VECTORS)))
    cuts = own.select(F.approx_percentile("norm", [i / n for i in range(1, n)] or [1.0], 10_000)).first()[0] if n > 1 else []
    band = sum((F.col("norm") < F.lit(c)).cast("int") for c in sorted(set(cuts))) if cuts else F.lit(0)
    own = own.select("vec_id", "v", "norm", band.alias("band"))
    bands = own.groupBy("band").agg(F.max("norm").alias("longest"), F.ceil(F.count("*") / VECTORS).cast("int").alias("blocks"))
    bands = F.broadcast(bands)
    query_blocks = -(-asked.count() // QUERIES)
    own = own.join(bands, "band").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")).cast("int"))
    own = own.withColumn("query_block", F.explode(F.sequence(F.lit(1), F.lit(max(1, query_blocks))))).drop("blocks", "longest")
    asked = asked.withColumn("query_block", (F.pmod(F.xxhash64("vec_id"), F.lit(max(1, query_blocks))) + 1).cast("int"))
    asked = asked.join(bands, F.col("longest") * F.col("norm") * (1 + 1e-9) + 1 >= F.col("floor"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "longest")

    def run(key: tuple, m: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(m) or not len(q):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return best_of_block(m, q, turn, best)

    tile = ["band", "block", "query_block"]
    own, asked = (t.select(*[F.col(c).alias(c) for c in t.columns]) for t in (own, asked))
    return own.groupBy(*tile).cogroup(asked.groupBy(*tile)).applyInPandas(run, schema)
