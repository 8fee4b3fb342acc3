"""String similarity over UTF-8 bytes (SCL7-SCL10)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def jaro_winkler_bytes(a: bytes, b: bytes) -> float:
    """Winkler's similarity of two byte strings: boost of 0.1 a common leading byte, four at most, for a Jaro similarity above 0.7."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    n, m = len(a), len(b)
    reach = max(0, max(n, m) // 2 - 1)
    free = bytearray(b"\x01") * m
    left = bytearray()
    for i, x in enumerate(a):
        j, end = b.find(x, max(0, i - reach), i + reach + 1), i + reach + 1
        while j >= 0 and not free[j]:
            j = b.find(x, j + 1, end)
        if j >= 0:
            free[j] = 0
            left.append(x)
    k = len(left)
    if not k:
        return 0.0
    right = bytes(b[j] for j in range(m) if not free[j])
    half = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    jaro = (k / n + k / m + (k - half) / k) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        same += 1
    return jaro + 0.1 * same * (1 - jaro)


#: Cells of a matrix of pairs; bytes beyond which a pair is compared on its own.
_CELLS, _LONG = 1 << 16, 512


def _matrix(values: list[bytes], sizes: np.ndarray, fill: int) -> np.ndarray:
    """A row a value, filled up with a byte that no UTF-8 text holds."""
    width = int(sizes.max())
    out = np.array(values, dtype=f"S{width}").view(np.uint8).reshape(len(values), width)
    out[np.arange(width) >= sizes[:, None]] = fill
    return out


def _together(a: list[bytes], b: list[bytes], n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The similarity of pairs of about one length, byte by byte of the first side for all at once."""
    left, right = _matrix(a, n, 0xFF), _matrix(b, m, 0xFE)
    rows, places = np.arange(len(a)), np.arange(right.shape[1])
    reach = np.maximum(0, np.maximum(n, m) // 2 - 1)
    most, free, hit = int(reach.max()), places < m[:, None], np.zeros(left.shape, dtype=bool)
    for i in range(left.shape[1]):
        lo, hi = max(0, i - most), i + most + 1
        same = (right[:, lo:hi] == left[:, i : i + 1]) & free[:, lo:hi] & (np.abs(places[lo:hi] - i) <= reach[:, None])
        if not same.shape[1]:
            break
        j = same.argmax(axis=1)
        found = same[rows, j]
        hit[:, i] = found
        free[rows[found], lo + j[found]] = False
    k = hit.sum(axis=1)
    of = np.repeat(rows, k)
    half = np.bincount(of, left[hit] != right[(places < m[:, None]) & ~free], minlength=len(a)).astype(np.int64) // 2
    jaro = (k / n + k / m + (k - half) / np.maximum(k, 1)) / 3
    wide = min(4, left.shape[1], right.shape[1])
    lead = np.logical_and.accumulate(left[:, :wide] == right[:, :wide], axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + 0.1 * lead * (1 - jaro), jaro)


def jaro_winkler_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """``jaro_winkler_bytes`` of many pairs of unequal, non-empty values."""
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    out, widest = np.empty(len(a)), np.maximum(n, m)
    order, at = np.argsort(widest, kind="stable"), 0
    while at < len(order):
        some = order[at : at + max(1, _CELLS // int(widest[order[at]]))]
        some = some[widest[some] <= max(16, 2 * widest[some[0]])]
        at += len(some)
        x, y = [a[i] for i in some], [b[i] for i in some]
        out[some] = _together(x, y, n[some], m[some]) if widest[some[-1]] <= _LONG else [jaro_winkler_bytes(p, q) for p, q in zip(x, y, strict=True)]
    return out


def _jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    there = np.flatnonzero((a.notna() & b.notna()).to_numpy())
    if len(there):
        pairs = pd.DataFrame({"a": a.iloc[there].to_numpy(), "b": b.iloc[there].to_numpy()})
        which = pairs.groupby(["a", "b"], sort=False).ngroup().to_numpy()
        first = np.unique(which, return_index=True)[1]
        each = jaro_winkler_pairs([x.encode() for x in pairs["a"].iloc[first]], [x.encode() for x in pairs["b"].iloc[first]])
        out[there] = each[which]
    return pd.Series(out).astype(object).where(pd.Series(out).notna(), None)


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity; '' against anything is 0.  Only unequal, non-empty values reach Python."""
    hard = (a != b) & (a != "") & (b != "")
    scored = F.pandas_udf(_jaro_winkler, "double")(F.when(hard, a), F.when(hard, b))
    return F.when((a == "") | (b == ""), F.lit(0.0)).when(a == b, F.lit(1.0)).otherwise(scored)


def could_reach(a: Column, b: Column, least: float) -> Column:
    """False where byte lengths alone keep Jaro-Winkler below ``least``: with full boost it needs a Jaro of 1 - (1 - least) / 0.6."""
    jaro = 1 - (1 - least) / 0.6
    n, m = F.octet_length(a), F.octet_length(b)
    return F.least(n, m) >= (3 * jaro - 2 - 1e-9) * F.greatest(n, m)


def _as_bytes(x: Column) -> Column:
    return F.decode(F.encode(x, "UTF-8"), "ISO-8859-1")


def levenshtein(a: Column, b: Column, by_bytes: bool = True) -> Column:
    """Edit distance in bytes (or code points); ASCII pairs skip the recoding."""
    if not by_bytes:
        return F.levenshtein(a, b)
    plain = (F.octet_length(a) == F.length(a)) & (F.octet_length(b) == F.length(b))
    return F.when(plain, F.levenshtein(a, b)).otherwise(F.levenshtein(_as_bytes(a), _as_bytes(b)))


def contains_either(a: Column, b: Column) -> Column:
    return (a != "") & (b != "") & (F.contains(a, b) | F.contains(b, a))
