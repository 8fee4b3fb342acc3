"""Reproducible shuffle and shards by a Feistel permutation of global row numbers.

Rows are numbered by their key, nulls first.  Rows that tie, repeated ones
included, get consecutive numbers in no stated order.  An empty table stays
empty; null and very long values travel like any others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .shared import ranked, whole

ROUNDS = 6
_LOW31 = np.uint64((1 << 31) - 1)


def _keys(seed: int) -> list[tuple[int, int, int]]:
    draw = np.random.Generator(np.random.PCG64(seed))
    return [tuple(int(x) | 1 for x in draw.integers(1 << 29, 1 << 31, 3)) for _ in range(ROUNDS)]


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _scramble(half: np.ndarray, key: tuple[int, int, int], mask: np.uint64) -> np.ndarray:
    a, b, c = (np.uint64(k) for k in key)
    x = (half * a + b) & _LOW31
    x = ((x ^ (x >> np.uint64(15))) * c) & _LOW31
    return (x ^ (x >> np.uint64(13))) & mask


def _once(x: np.ndarray, n: int, keys: list, back: bool) -> np.ndarray:
    bits = np.uint64(_half_bits(n))
    mask = np.uint64((1 << int(bits)) - 1)
    left, right = x >> bits, x & mask
    for key in reversed(keys) if back else keys:
        left, right = (right ^ _scramble(left, key, mask), left) if back else (right, left ^ _scramble(right, key, mask))
    return (left << bits) | right


def permute(x: np.ndarray, n: int, seed: int = 17, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (``back``: its inverse): walk the Feistel cycle until the value is below n."""
    keys, y = _keys(seed), _once(np.asarray(x, dtype=np.uint64), n, _keys(seed), back)
    while (out := y >= np.uint64(n)).any():
        y[out] = _once(y[out], n, keys, back)
    return y.astype(np.int64)


def locate(row: int, n: int, n_shards: int, seed: int = 17) -> tuple[int, int]:
    """Shard and slot of a row number, without any data."""
    p = int(permute(np.array([row]), n, seed)[0])
    return p % n_shards, p // n_shards


def row_at(shard: int, slot: int, n: int, n_shards: int, seed: int = 17) -> int:
    """The row number that stands at a slot of a shard."""
    return int(permute(np.array([slot * n_shards + shard]), n, seed, back=True)[0])


def permuted(row: Column, n: int, seed: int = 17) -> Column:
    @F.pandas_udf(LongType())
    def feistel(x: pd.Series) -> pd.Series:
        return pd.Series(permute(x.to_numpy(), n, seed))

    return feistel(row)


def shard_rows(df: DataFrame, key: list[str], n_shards: int, seed: int = 17, shard: str = "shard", slot: str = "slot") -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` and ``slot``.

    Rows are numbered by ``key`` (nulls first; ties consecutive), permuted, and
    dealt in turn: shard sizes differ by one row at most and slots have no gaps.
    An empty table stays empty.  Columns already called ``shard`` or ``slot``
    are replaced; all others stay, whatever their names.  Rows travel once, in
    the range shuffle that numbers them.
    """
    keys = [f"k{i}" for i in range(len(key))]
    numbered, n = ranked(df.select(*[df[c].alias(k) for c, k in zip(key, keys, strict=True)], whole(df.drop(shard, slot)).alias("row")), keys, "number")
    dealt = numbered.withColumn("at", permuted(F.col("number"), max(n, 1), seed))
    return dealt.select("row.*", F.pmod(F.col("at"), F.lit(n_shards)).cast("int").alias(shard), F.expr(f"at div {n_shards}").alias(slot))
