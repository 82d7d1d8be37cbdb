"""Positional operators: slice, contiguous shards, head.

Rows of a DataFrame have no position, so a position is the rank under a unique
key of one or several columns.  A global ``row_number`` would put all rows through one task, and a
sort of the keys would move all of them to find a few.  The keys at the wanted positions are
selected instead: a sample of the keys proposes pivots around each position, one
count per range between pivots tells in which range it lies, and the range is narrowed down in the
same way until the driver can sort what is left.  The rows themselves are then
picked with a plain key filter, which reaches the Parquet scan; neither keys nor rows are ever
shuffled, sorted or written.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tunelab.schemas import quoted


#: Keys of a range that the driver sorts at most, and keys of the sample that proposes pivots.
SORTED_KEYS, SAMPLED_KEYS = 20_000, 4096
#: Places in the sample, on either side of the expected one, where the pivots are: six standard deviations of a rank.
MARGIN = 192


Key = str | Sequence[str]


def _columns(key: Key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _key(key: Key) -> Column:
    """The key of a row: a column, or several compared from the left."""
    names = _columns(key)
    return quoted(names[0]) if len(names) == 1 else F.struct(*map(quoted, names))


def _literal(value) -> Column:
    """A key read back from the index as a constant."""
    if isinstance(value, Row):
        return F.struct(*[F.lit(v).alias(name) for name, v in value.asDict().items()])
    return F.lit(value)


def _first_column(value):
    return value[0] if isinstance(value, Row) else value


@dataclass(frozen=True)
class Range:
    """The ``size`` keys from ``low`` on, or only those ``above`` it, and below ``high``, ``before`` keys being smaller; None is no bound."""

    low: object
    high: object
    before: int
    size: int
    above: bool = False

    def holds(self, position: int) -> bool:
        return self.before <= position < self.before + self.size

    def keys(self, df: DataFrame, key: Key) -> DataFrame:
        """The keys of the range, the first key column tested by itself too: that test reaches the scan."""
        first = quoted(_columns(key)[0])
        kept = df.select(*map(quoted, dict.fromkeys(_columns(key))))
        if self.low is not None:
            own = _key(key) > _literal(self.low) if self.above else _key(key) >= _literal(self.low)
            kept = kept.where((first >= F.lit(_first_column(self.low))) & own)
        if self.high is not None:
            kept = kept.where((first <= F.lit(_first_column(self.high))) & (_key(key) < _literal(self.high)))
        return kept.select(_key(key).alias("key"))


def count_keys(df: DataFrame, key: Key) -> int:
    """Number of rows; a null in a key column is an error."""
    missing = reduce(or_, [quoted(name).isNull() for name in _columns(key)])
    found = df.select(missing.alias("missing")).agg(F.count(F.lit(1)).alias("n"), F.bool_or("missing").alias("missing")).first()
    if found["missing"]:
        raise ValueError(f"{key} holds nulls and cannot order the rows")
    return found["n"]


def _around(keys: DataFrame, part: Range, value: object, positions: Sequence[int]) -> list[Range]:
    """The ranges below and above a key that many rows share; a position on it is an error."""
    is_less, is_same = F.col("key") < _literal(value), F.col("key") == _literal(value)
    less, same = keys.agg(F.count_if(is_less), F.count_if(is_same)).first()
    if same > 1 and any(part.before + less <= p < part.before + less + same for p in positions):
        raise ValueError("the key is not unique and cannot cut the rows here")
    above = Range(value, part.high, part.before + less + same, part.size - less - same, above=True)
    return [r for r in (Range(part.low, value, part.before, less, part.above), above) if any(map(r.holds, positions))]


def _narrowed(df: DataFrame, key: Key, part: Range, positions: Sequence[int]) -> list[Range]:
    """Smaller ranges of a range, those that hold a position, by one sample and one count."""
    keys = part.keys(df, key)
    rows = keys.orderBy(F.rand(part.size)).limit(SAMPLED_KEYS).collect()
    sample = sorted(row["key"] for row in rows)
    pivots = set()
    for position in positions:
        place = (position - part.before) * len(sample) // part.size
        for at in (place - MARGIN, place + MARGIN):
            if 0 <= at < len(sample):
                pivots.add(sample[at])
                pivots.update(sample[bisect_right(sample, sample[at]) :][:1])
    pivots = sorted(p for p in pivots if part.low is None or p > part.low)
    if not pivots:  # one key fills the sample: it is counted by itself
        return _around(keys, part, sample[len(sample) // 2], positions)
    counted = keys.groupBy(_halves(F.col("key"), [*map(_literal, pivots)], 0, len(pivots)).alias("slot")).count().collect()
    sizes = {row["slot"]: row["count"] for row in counted}
    bounds, found, before = [part.low, *pivots, part.high], [], part.before
    for slot in range(len(pivots) + 1):
        smaller = Range(bounds[slot], bounds[slot + 1], before, sizes.get(slot, 0), part.above and slot == 0)
        before += smaller.size
        if any(map(smaller.holds, positions)):
            found.append(smaller)
    return found


def keys_at(df: DataFrame, key: Key, total: int, positions: Sequence[int]) -> list:
    """The key at each position, ``0 <= position < total``, of ``total`` rows.

    A key that several rows share cannot stand at a limit between rows, so it is an error.
    """
    found: dict[int, object] = {}
    open_ = [Range(None, None, 0, total)] if positions else []
    while open_:
        part = open_.pop()
        here = [p for p in positions if part.holds(p)]
        if part.size <= SORTED_KEYS:
            keys = sorted(row["key"] for row in part.keys(df, key).collect())
            for p in here:
                found[p] = keys[p - part.before]
                if bisect_right(keys, found[p]) - bisect_left(keys, found[p]) > 1:
                    raise ValueError("the key is not unique and cannot cut the rows here")
            continue
        open_ += _narrowed(df, key, part, here)
    return [found[p] for p in positions]


def _between(df: DataFrame, key: Key, total: int, start: int, stop: int) -> DataFrame:
    """Rows from position ``start`` to ``stop``.

    With several key columns the first is tested by itself too: that test
    reaches the scan.
    """
    if not 0 <= start <= stop <= total:
        raise IndexError(f"slice {start}:{stop} of {total} rows")
    if start == stop:
        return df.limit(0)
    inner = [p for p in (start, stop) if 0 < p < total]
    limits = dict(zip(inner, keys_at(df, key, total, inner)))
    first = quoted(_columns(key)[0])
    kept = df
    if start in limits:
        kept = kept.where((first >= F.lit(_first_column(limits[start]))) & (_key(key) >= _literal(limits[start])))
    if stop in limits:
        kept = kept.where((first <= F.lit(_first_column(limits[stop]))) & (_key(key) < _literal(limits[stop])))
    return kept


def slice_rows(df: DataFrame, key: Key, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``start`` to ``end`` (exclusive) in key order; ``end`` is the row count by default."""
    total = count_keys(df, key)
    return _between(df, key, total, start, total if end is None else end)


def shard_starts(total: int, num_shards: int) -> list[int]:
    """First position of each shard; the first ``total % num_shards`` shards hold one row more."""
    size, extra = divmod(total, num_shards)
    return [i * size + min(i, extra) for i in range(num_shards)]


def check_shard(num_shards: int, index: int) -> None:
    if num_shards < 1 or not 0 <= index < num_shards:
        raise ValueError(f"shard {index} of {num_shards} does not exist")


def shard(df: DataFrame, key: Key, num_shards: int, index: int) -> DataFrame:
    """Contiguous shard ``index`` of ``num_shards`` in key order."""
    check_shard(num_shards, index)
    total = count_keys(df, key)
    starts = [*shard_starts(total, num_shards), total]
    return _between(df, key, total, starts[index], starts[index + 1])


def _halves(key: Column, firsts: list[Column], low: int, high: int) -> Column:
    """Shard of a key among shards ``low`` to ``high``, by halving."""
    if low == high:
        return F.lit(low)
    middle = (low + high + 1) // 2
    upper = _halves(key, firsts, middle, high)
    return F.when(key >= firsts[middle - 1], upper).otherwise(_halves(key, firsts, low, middle - 1))


def with_shard(df: DataFrame, key: Key, num_shards: int, out: str = "shard") -> DataFrame:
    """Label each row with its contiguous shard, without moving rows.

    ``num_shards`` is the number of workers, so the list of first keys is
    short.
    """
    check_shard(num_shards, 0)
    total = count_keys(df, key)
    firsts = keys_at(df, key, total, [p for p in shard_starts(total, num_shards)[1:] if p < total])
    return df.withColumn(out, _halves(_key(key), [*map(_literal, firsts)], 0, len(firsts)))


def head(df: DataFrame, key: Key, n: int = 100) -> DataFrame:
    """The first ``n`` rows in key order (debug mode)."""
    return df.orderBy(*map(quoted, _columns(key))).limit(n)
