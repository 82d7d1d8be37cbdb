"""Packing token sequences by cutting-stock column generation."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunelab.llm.common import bounded_batches, prefix_sums, stored, text_key

LENGTH = 2048
END_ID = 1
#: Lengths are planned in units of so many tokens, so the linear program has LENGTH / UNIT rows at most.
UNIT = 8
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
#: Longer texts are tokenised in parts of about so many characters.
PART_CHARS = 1 << 20

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class Tokens:
    """Ids of a text, by the public byte-level tokenizer.

    The rank file holds the same vocabulary and gives the same ids several times faster; a text that spells a special
    token goes to the tokenizer file itself.  Parts end after a single line break between two visible characters,
    where the pre-tokenizer splits anyway, so a very long text never becomes one list of Python numbers.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import base64
        import json

        import public_tokenizers
        import tiktoken

        self.path, self.whole = tokenizer, None
        with open(tokenizer, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("fast", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str, end: int = END_ID) -> np.ndarray:
        if any(s in text for s in self.special):
            if self.whole is None:  # seldom needed
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            found = [self.whole.encode(text, add_special_tokens=False).ids]
        else:
            cuts, at = [0], 0
            while len(text) - at > PART_CHARS and (m := re.compile(r"(?<=\S)\n(?=\S)").search(text, at + PART_CHARS)):
                cuts.append(at := m.end())
            found = [self.fast.encode_ordinary(text[a:b]) for a, b in zip(cuts, [*cuts[1:], len(text)])]
        return np.concatenate([*(np.asarray(x, dtype="<u4") for x in found), np.array([end], dtype="<u4")])


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): every document's ids and the end id, cut every ``length`` ids.

    ``ids`` are little-endian unsigned 32-bit numbers.  ``tokenizer`` and ``ranks`` are files of one vocabulary, by
    default the public byte-level one.  A null text is empty: its document is the end id alone.
    """
    import public_tokenizers

    tokenizer, ranks = tokenizer or public_tokenizers.path(TOKENIZER), ranks or public_tokenizers.path(RANKS)
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(tokenizer, ranks)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens(text.as_py() or "")
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    rows.append((doc_id, start, len(part), len(ids), part.tobytes()))
                if len(rows) >= 2000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 5
    types = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "start", "length", "doc_tokens", "ids"])


def best_pattern(worth: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the multiset of sizes within ``room`` that is worth most."""
    value, last = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(sizes, np.arange(room + 1), side="right")
    for r in range(1, room + 1):
        value[r] = value[r - 1]
        if fits[r]:
            tried = value[r - sizes[: fits[r]]] + worth[: fits[r]]
            k = int(tried.argmax())
            if tried[k] > value[r] + 1e-12:
                value[r], last[r] = tried[k], k
    counts, r = np.zeros(len(sizes)), room
    while r > 0:
        if last[r] < 0:
            r -= 1
        else:
            counts[last[r]] += 1
            r -= sizes[last[r]]
    return float(value[room]), counts


def cutting_stock(demand: dict[int, int], room: int, gap: float = 1e-3, most: int = 20_000) -> list[tuple[int, dict[int, int]]]:
    """Patterns with the number of times each is used: together they hold every size as often as demanded.

    The linear program over patterns is solved by column generation (revised simplex; the knapsack prices new
    columns) until the bound of the prices or the progress of a round is within ``gap``.  Uses are rounded down; what
    is then left, a few items per row of the program, goes first-fit by falling size.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0 and 0 < s <= room))
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes], dtype=float)
    fit = np.floor(room / sizes)
    basis, inverse = np.diag(fit), np.diag(1 / fit)
    uses, before = need / fit, np.inf
    for step in range(most):
        total = uses.sum()
        if step % 250 == 249:
            if before - total < gap * total:
                break
            before = total
        best, column = best_pattern(inverse.sum(axis=0), sizes, room)
        if best <= 1 + 1e-9 or total - total / best < max(0.5, gap * total):
            break
        held = np.flatnonzero(column)
        change = (inverse[:, held] * column[held]).sum(axis=1)
        ratio = np.where(change > 1e-10, np.maximum(uses, 0) / np.where(change > 1e-10, change, 1), np.inf)
        out = int(ratio.argmin())
        uses = uses - ratio[out] * change
        uses[out] = ratio[out]
        basis[:, out] = column
        row = inverse[out] / change[out]
        inverse = inverse - np.outer(change, row)
        inverse[out] = row
    times = np.floor(np.maximum(uses, 0) + 1e-7).astype(int)
    while (over := (basis * times).sum(axis=1) - need).max() > 0.5:  # only if rounding errors added up
        times[int(((basis[int(over.argmax())] > 0) * times).argmax())] -= 1
    plan: Counter = Counter()
    for k, n in enumerate(times):
        if n:
            plan[tuple((int(s), int(a)) for s, a in zip(sizes, basis[:, k]) if a)] += int(n)
    left = need - (basis * times).sum(axis=1)
    bins: list[list[int]] = []
    free: list[int] = []
    for s, n in zip(sizes[::-1].tolist(), np.rint(left[::-1]).astype(int).tolist()):
        for _ in range(n):
            k = next((k for k, f in enumerate(free) if f >= s), None)
            if k is None:
                bins.append([])
                free.append(room)
                k = len(free) - 1
            bins[k].append(s)
            free[k] -= s
    for b in bins:
        plan[tuple(sorted(Counter(b).items()))] += 1
    return [(n, dict(p)) for p, n in plan.items()]


def place(cut: DataFrame, length: int = LENGTH, unit: int = UNIT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (doc_id, start, length, doc_tokens, ...).

    The driver sees the number of pieces per length class, ``length / unit`` numbers however many pieces there are, and
    returns a pattern table bounded by them.  Pieces of a class are ranked in random order by distributed
    prefix sums, so a class that holds a third of all pieces is sorted in many ranges; a piece's rank decides its
    sequence.  Only pieces of one sequence then meet, to be laid end to end, longest class first.
    """
    spark = cut.sparkSession
    ranked = cut.withColumn("size_class", F.ceil(F.col("length") / unit).cast("int"))
    of = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    ranked = ranked.withColumn("order_key", text_key(of, F.lit(":"), F.col("start").cast("string")))
    counts = {r["size_class"]: r["count"] for r in ranked.groupBy("size_class").count().collect()}
    slots, filled, first = [], Counter(), 0
    for times, pattern in cutting_stock(counts, length // unit):
        for s, each in pattern.items():
            slots.append((s, filled[s], filled[s] + times * each, each, first))
            filled[s] += times * each
        first += times
    plan = spark.createDataFrame(slots, "of_class int, slot_from long, slot_to long, each long, first_id long")
    ties = ["doc_id", "start", "length", "doc_tokens"]
    ranked = ranked.withColumn("one", F.lit(1))
    ranked = prefix_sums(ranked, ["size_class"], "order_key", ties, "one", sum(counts.values()))
    here = (F.col("size_class") == F.col("of_class")) & F.col("before").between(F.col("slot_from"), F.col("slot_to") - 1)
    placed = ranked.join(F.broadcast(plan), here)
    nth = F.col("before") - F.col("slot_from")
    placed = placed.withColumn("sequence_id", (F.col("first_id") + F.floor(nth / F.col("each"))).cast("long"))
    along = Window.partitionBy("sequence_id").orderBy(F.desc("size_class"), "before").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)).cast("long"))
    return placed.select(*cut.columns, "sequence_id", "offset")


def pack(docs: DataFrame, length: int = LENGTH, unit: int = UNIT, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, sequence_id, offset): all documents in sequences of ``length`` ids at most.

    A document is cut every ``length`` ids; whole pieces are sequences of their own, the last pieces are
    combined by a cutting-stock plan.  Null and empty texts are the end id alone.  Rows that repeat a document are
    packed as often as they occur; rows without doc_id are packed like any other.  An empty table
    gives an empty one; other columns are ignored.
    """
    return place(stored(pieces(docs, length, tokenizer, ranks), "pieces"), length, unit)


def pack_digest(docs: DataFrame, **how) -> DataFrame:
    """As :func:`pack`, with the CRC-32 of the ids in place of the ids, which are then neither stored nor moved."""
    cut = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(stored(cut, "pieces"), **how)
