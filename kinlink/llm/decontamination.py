"""Benchmark passages in documents, found by Wu-Manber search over words.

The test strings are the windows of ``window`` consecutive words of each item;
an item with fewer words is one string.  Strings of one length share a table:
the shift of a block (two words) is the least distance from it to a string's
end, so most positions are skipped; a block of shift 0 opens the bucket of the
strings that end in it, subdivided by their first block, and every string there
is compared word for word.

Words are the runs of 0-9, a-z and non-ASCII characters after lower-casing A-Z.
Null and empty texts have no words; an item without words has no string.  An
empty benchmark hits nothing; an empty table has an empty result.  Repeated
rows and items each count; a null item id is the id "".  Texts of any length
are searched whole.  Strings that occur at one place all count, their spans
merged.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free, materialize, scratch_path, small_batches, whole

#: A-Z to a-z; every other ASCII character that is no letter or digit to a space.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"

#: Bytes of strings in one block of a benchmark, give or take an item; the tables of a block take some ten times as much.
BLOCK = 16 << 20


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def strings(text: str | None, window: int) -> Iterator[tuple[bytes, ...]]:
    w = tokens(text)
    if len(w) >= window:
        yield from (tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    elif w:
        yield tuple(w)


class Table:
    """Shift table and buckets of the strings of one length."""

    def __init__(self, length: int, found: dict[tuple, list[str]]):
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}
        for string, items in found.items():
            for j in range(self.far):
                block = string[j : j + self.block]
                self.shift[block] = min(self.shift.get(block, self.far), self.far - 1 - j)
            self.buckets.setdefault(string[-self.block :], {}).setdefault(string[: self.block], []).append((list(string), items))

    def search(self, w: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        length, size, far, shift, buckets = self.length, self.block, self.far, self.shift.get, self.buckets
        pos, last = length - size, len(w) - size
        while pos <= last:
            block = (w[pos], w[pos + 1]) if size == 2 else (w[pos],)
            if step := shift(block, far):
                pos += step
                continue
            start = pos - far + 1
            for string, of in buckets[block].get((w[start], w[start + 1]) if size == 2 else (w[start],), ()):
                if w[start : start + length] == string:
                    spans.append((start, start + length))
                    items.update(of)
            pos += 1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _tables(found: dict[tuple, list[str]]) -> list[Table]:
    by_length: dict[int, dict] = {}
    for string, items in found.items():
        by_length.setdefault(len(string), {})[string] = sorted(set(items))
    return [Table(n, by_length[n]) for n in sorted(by_length)]


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block: int) -> Iterator[tuple[dict, bool]]:
    """The strings with their items, block by block, and whether more follow; the driver holds one block at a time."""
    rows = benchmark.select(benchmark[item_id].cast("string"), benchmark[text]).toLocalIterator()
    row, found, size = next(rows, None), {}, 0
    while row is not None:
        for string in strings(row[1], window):
            found.setdefault(string, []).append("" if row[0] is None else row[0])
            size += sum(map(len, string))
        row = next(rows, None)
        if size >= block and row is not None:
            yield found, True
            found, size = {}, 0
    yield found, False


def _search(held: Broadcast) -> Callable[..., Column]:
    built: list[list[Table]] = []

    @F.pandas_udf(FOUND)
    def search(texts: pd.Series) -> pd.DataFrame:
        if not built:
            built.append(_tables(held.value))
        rows = []
        for x in texts:
            w, spans, items = tokens(x), [], set()
            for table in built[0]:
                table.search(w, spans, items)
            rows.append(_row(len(w), merged(spans), items))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return search


def _row(n_words: int, spans: list[tuple[int, int]], items: set[str]) -> tuple:
    return n_words, sum(e - s for s, e in spans), sorted(items), [{"start": s, "end": e} for s, e in spans]


def _joined(n_words: pd.Series, items: pd.Series, spans: pd.Series) -> pd.DataFrame:
    """What all blocks found in a text."""
    rows = []
    for n, i, s in zip(n_words, items, spans, strict=True):
        rows.append(_row(n, merged([(x["start"], x["end"]) for x in s]) if s is not None else [], set(i) if i is not None else set()))
    return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])


def _found(docs: DataFrame, benchmark: DataFrame, text: str, item_id: str, item_text: str, window: int, block: int) -> DataFrame:
    """``row`` (the row of ``docs``) and ``found``.

    A benchmark of one block is searched where the rows are.  Of a larger one,
    each block in turn is read, broadcast, searched and let go; what it finds is
    written by the hash of the text, and the blocks' finds are joined to the
    rows in the end.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows, parts = docs.select(whole(docs).alias("row"), docs[text].alias("text")), None
    for strings_of, more in _blocks(benchmark, item_id, item_text, window, block):
        held = spark.sparkContext.broadcast(strings_of)
        if parts is None and not more:
            return rows.select("row", _search(held)("text").alias("found"))
        parts = parts or scratch_path(spark, "found")
        hits = rows.where("text IS NOT NULL").select(F.sha2("text", 256).alias("h"), _search(held)("text").alias("f")).where("f.n_hit > 0")
        hits.groupBy("h").agg(F.first("f").alias("f")).select("h", "f.items", "f.spans").write.mode("append").parquet(parts)
        held.destroy()
    every = spark.read.schema("h string, items array<string>, spans array<struct<start:int,end:int>>").parquet(parts)
    # Written, so that the join can split the rows of a text that many share.
    every = materialize(every.groupBy("h").agg(F.flatten(F.collect_list("items")).alias("items"), F.flatten(F.collect_list("spans")).alias("spans")), "found")
    counted = rows.select("row", F.sha2("text", 256).alias("h"), _search(spark.sparkContext.broadcast({}))("text")["n_words"].alias("n_words"))
    return counted.join(every, "h", "left").select("row", F.pandas_udf(_joined, FOUND)("n_words", "items", "spans").alias("found"))


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block: int = BLOCK, out: str = "found") -> DataFrame:
    """``docs`` with a struct ``out`` (``FOUND``): words, words hit, items found and the merged word spans of each text.

    Where ``docs`` has a column of that name, ``out`` has an underscore behind it.
    """
    return _found(docs, benchmark, text, item_id, item_text, window, block).select("row.*", F.col("found").alias(free(out, docs.columns)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", most: float = 0.0, item_id: str = "item_id", item_text: str = "text", window: int = 10, block: int = BLOCK) -> DataFrame:
    """The documents whose share of words hit is at most ``most``, with their own columns only, whatever their names."""
    found = _found(docs, benchmark, text, item_id, item_text, window, block)
    return found.where(F.col("found.n_hit") <= most * F.col("found.n_words")).select("row.*")
